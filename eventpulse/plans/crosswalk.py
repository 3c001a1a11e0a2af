"""Country codes of the event feed and their ISO 3166-1 alpha-2 equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Feed code, ISO code. AU and MO are listed twice.
CODES = """
US US
UK GB
FR FR
GM DE
RS RU
CH CN
IN IN
BR BR
MX MX
IT IT
SP ES
PO PT
JA JP
KS KR
AU AU
CA CA
IS IL
EG EG
SA SA
IR IR
IZ IQ
SY SY
TU TR
PK PK
AF AF
NI NG
SF ZA
KE KE
ET ET
SU SD
LY LY
MO MA
AG DZ
GH GH
IV CI
SE SN
UG UG
TZ TZ
AO AO
ZI ZW
ZA ZM
MZ MZ
BC BW
WA NA
UP UA
PL PL
HU HU
RO RO
BK BA
HR HR
SI SI
GR GR
BU BG
EZ CZ
LO SK
EN EE
LG LV
LH LT
FI FI
SW SE
NO NO
DA DK
NL NL
BE BE
SZ CH
AU AT
VE VE
CO CO
AR AR
CI CL
PE PE
EC EC
BO BO
UY UY
CU CU
DR DO
HA HT
JM JM
TD TH
VM VN
MY MY
ID ID
RP PH
SN SG
NZ NZ
BD BD
CE LK
NP NP
BM MM
CB KH
LA LA
KZ KZ
UZ UZ
AJ AZ
GG GE
AM AM
MO MN
JO JO
LE LB
PA PS
KU KW
BA BH
QA QA
TC AE
YM YE
OM OM
"""

# Of the two readings of a code listed twice, the one that is not its FIPS 10-4 meaning.
MISREAD = {("AU", "AU"), ("MO", "MN")}

AS_LISTED: list[tuple[str, str]] = [tuple(line.split()) for line in CODES.strip().splitlines()]
ONE_PER_CODE: list[tuple[str, str]] = [pair for pair in AS_LISTED if pair not in MISREAD]


def values_sql(pairs: list[tuple[str, str]]) -> str:
    return ", ".join(f"('{fips}', '{iso}')" for fips, iso in pairs)


def crosswalk(spark: SparkSession, as_listed: bool = False) -> DataFrame:
    """Columns ``fips`` and ``iso``. A constant of about a hundred rows, so it is always safe to broadcast."""
    pairs = AS_LISTED if as_listed else ONE_PER_CODE
    return spark.sql(f"SELECT fips, iso FROM VALUES {values_sql(pairs)} AS t(fips, iso)")
