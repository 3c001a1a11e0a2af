"""Column names and types of the raw daily file and of the staged events."""

from __future__ import annotations

from pyspark.sql import types as T

# The public codebook's column order of the daily event file (58
# columns, no header line) with the type each column is loaded as.
RAW_FIELDS = """
GlobalEventID         bigint
Day                   int
MonthYear             int
Year                  int
FractionDate          double
Actor1Code            string
Actor1Name            string
Actor1CountryCode     string
Actor1KnownGroupCode  string
Actor1EthnicCode      string
Actor1Religion1Code   string
Actor1Religion2Code   string
Actor1Type1Code       string
Actor1Type2Code       string
Actor1Type3Code       string
Actor2Code            string
Actor2Name            string
Actor2CountryCode     string
Actor2KnownGroupCode  string
Actor2EthnicCode      string
Actor2Religion1Code   string
Actor2Religion2Code   string
Actor2Type1Code       string
Actor2Type2Code       string
Actor2Type3Code       string
IsRootEvent           int
EventCode             string
EventBaseCode         string
EventRootCode         string
QuadClass             int
GoldsteinScale        double
NumMentions           bigint
NumSources            bigint
NumArticles           bigint
AvgTone               double
Actor1Geo_Type        int
Actor1Geo_Fullname    string
Actor1Geo_CountryCode string
Actor1Geo_ADM1Code    string
Actor1Geo_Lat         double
Actor1Geo_Long        double
Actor1Geo_FeatureID   string
Actor2Geo_Type        int
Actor2Geo_Fullname    string
Actor2Geo_CountryCode string
Actor2Geo_ADM1Code    string
Actor2Geo_Lat         double
Actor2Geo_Long        double
Actor2Geo_FeatureID   string
ActionGeo_Type        int
ActionGeo_Fullname    string
ActionGeo_CountryCode string
ActionGeo_ADM1Code    string
ActionGeo_Lat         double
ActionGeo_Long        double
ActionGeo_FeatureID   string
DATEADDED             int
SOURCEURL             string
"""

RAW_TYPES: dict[str, str] = dict(line.split() for line in RAW_FIELDS.strip().splitlines())
RAW_COLUMNS: list[str] = list(RAW_TYPES)

# What the file reader sees: every field as text, typed afterwards.
RAW_TEXT_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])
