import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventpulse.plans import dashboard, daily
from eventpulse.plans.crosswalk import AS_LISTED, ONE_PER_CODE, crosswalk
from eventpulse.plans.marts import country_activity, daily_event_tone
from eventpulse.plans.staging import STAGED, bad_dates, stage
from eventpulse.schema import RAW_COLUMNS, RAW_TYPES

AS_OF = dt.date(2024, 1, 31)
STAGED_TYPES = (
    "global_event_id long, event_date date, quad_class int, quad_class_label string, avg_tone double,"
    " goldstein_scale double, num_mentions long, num_articles long, action_geo_country_code string,"
    " action_geo_fullname string"
)


def raw(spark, *events):
    """Raw rows from dicts; columns left out are NULL."""
    schema = ", ".join(f"`{n}` {t}" for n, t in RAW_TYPES.items())
    return spark.createDataFrame([tuple(e.get(n) for n in RAW_COLUMNS) for e in events], schema)


def event(number=1, day=dt.date(2024, 1, 30), quad=1, tone=1.0, articles=1, country="US", place="A", stability=1.0):
    return (number, day, quad, "x", tone, stability, 1, articles, country, place)


def staged(spark, *events):
    return spark.createDataFrame(list(events), STAGED_TYPES)


def test_raw_schema():
    assert len(RAW_COLUMNS) == 58
    assert len(STAGED) == 42
    assert set(STAGED.values()) <= set(RAW_COLUMNS)


def test_stage_labels_and_dates(spark):
    events = [{"GlobalEventID": i, "Day": 20240105, "DATEADDED": 20240106, "QuadClass": q} for i, q in enumerate([1, 2, 3, 4, 7, None])]
    got = stage(raw(spark, *events)).orderBy("global_event_id").collect()
    assert [r.quad_class_label for r in got] == [
        "Verbal Cooperation", "Material Cooperation", "Verbal Conflict", "Material Conflict", "Unknown", "Unknown",
    ]
    assert got[0].event_date == dt.date(2024, 1, 5) and got[0].date_added == dt.date(2024, 1, 6)
    assert len(got[0]) == 42


def test_stage_filters_days(spark):
    days = [20240105, None, 0, 19990101]
    events = [{"GlobalEventID": i, "Day": d, "DATEADDED": 20240106} for i, d in enumerate(days)]
    assert [r.global_event_id for r in stage(raw(spark, *events)).collect()] == [0]


@pytest.mark.parametrize("day", [20, 20251399])
def test_stage_with_a_bad_date(spark, day):
    frame = raw(spark, {"GlobalEventID": 1, "Day": day, "DATEADDED": 20240101}, {"GlobalEventID": 2, "Day": 20240101, "DATEADDED": 20240101})
    with pytest.raises(Exception, match="CANNOT_PARSE|could not be parsed|DateTimeException"):
        stage(frame).collect()
    assert [r.global_event_id for r in stage(frame, "quarantine").collect()] == [2]
    assert [r.GlobalEventID for r in bad_dates(frame).collect()] == [1]
    with pytest.raises(ValueError):
        stage(frame, "ignore")


def test_stage_dedupe(spark):
    frame = raw(
        spark,
        {"GlobalEventID": 1, "Day": 20240101, "DATEADDED": 20240101, "SOURCEURL": "old"},
        {"GlobalEventID": 1, "Day": 20240101, "DATEADDED": 20240102, "SOURCEURL": "new"},
    )
    assert stage(frame).count() == 2
    assert [r.source_url for r in stage(frame, dedupe=True).collect()] == ["new"]


def test_window_edges(spark):
    days = [dt.date(2023, 12, 31), dt.date(2024, 1, 1), dt.date(2024, 1, 30), dt.date(2024, 1, 31)]
    got = daily_event_tone(staged(spark, *[event(day=d) for d in days]), AS_OF)
    assert sorted(r.event_date for r in got.collect()) == days[1:3]


def test_daily_tone_numbers(spark):
    frame = staged(
        spark,
        event(1, tone=2.0, articles=3, quad=3),
        event(2, tone=None, articles=1, quad=3),
        event(3, tone=-4.0, articles=0, quad=1),
        event(4, tone=1.0005, articles=1, quad=4),
    )
    got = {r.quad_class: r for r in daily_event_tone(frame, AS_OF).collect()}
    assert (got[3].avg_tone, got[3].weighted_avg_tone, got[3].event_count) == (2.0, 1.5, 2)
    assert got[1].weighted_avg_tone is None and got[1].avg_tone == -4.0
    assert got[4].avg_tone == 1.001
    assert {q: r.conflict_pct for q, r in got.items()} == {1: 0.0, 3: 100.0, 4: 100.0}


def test_country_edges(spark):
    codes = [None, "", "XX", "AU", "MO"]
    frame = staged(spark, *[event(i, country=c) for i, c in enumerate(codes)])
    got = {r.action_geo_country_code: r.iso_country_code for r in country_activity(frame, AS_OF).collect()}
    assert got == {"XX": "XX", "AU": "AT", "MO": "MA"}
    both = country_activity(frame, AS_OF, crosswalk_as_listed=True).collect()
    assert sorted((r.action_geo_country_code, r.iso_country_code) for r in both) == [
        ("AU", "AT"), ("AU", "AU"), ("MO", "MA"), ("MO", "MN"), ("XX", "XX"),
    ]
    assert sorted(r.country_rank for r in both) == [1, 2, 3, 4, 5]


def test_common_name_and_rank_ties(spark):
    frame = staged(
        spark,
        event(1, country="US", place="b"), event(2, country="US", place="a"),
        event(3, country="FR", place=None), event(4, country="FR", place=None), event(5, country="FR", place="z"),
        event(6, country="CA", place="z"), event(7, country="CA", place=None),
    )
    got = {r.action_geo_country_code: (r.country_name_common, r.country_rank) for r in country_activity(frame, AS_OF).collect()}
    assert got == {"FR": (None, 1), "CA": ("z", 2), "US": ("a", 3)}


def test_mart_invariants(spark):
    frame = staged(spark, *[event(i, quad=i % 6, country="ABCDE"[i % 5], place=str(i % 7), tone=i / 7) for i in range(300)])
    tone, countries = daily_event_tone(frame, AS_OF), country_activity(frame, AS_OF).collect()
    assert tone.agg(F.sum("event_count")).first()[0] == 300 == sum(r.event_count for r in countries)
    assert sorted(r.country_rank for r in countries) == list(range(1, 6))
    classes = sum(r.verbal_coop_count + r.material_coop_count + r.verbal_conflict_count + r.material_conflict_count for r in countries)
    assert classes == 200


def test_crosswalk(spark):
    assert (len(AS_LISTED), len(ONE_PER_CODE)) == (106, 104)
    assert crosswalk(spark).groupBy("fips").count().where("count > 1").isEmpty()
    assert crosswalk(spark, as_listed=True).count() == 106


def test_crosswalk_is_broadcast_and_places_are_counted_before_the_shuffle(spark):
    plan = country_activity(staged(spark, event()), AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "CartesianProduct" not in plan


def test_dashboard(spark):
    frame = staged(
        spark,
        event(1, day=dt.date(2024, 1, 2), quad=3), event(2, day=dt.date(2024, 1, 2), quad=1),
        event(3, day=dt.date(2024, 1, 3), quad=4), event(4, day=dt.date(2024, 1, 3), quad=2, country="FR"),
        event(5, day=dt.date(2024, 1, 4), quad=1),
    )
    tone, countries = daily_event_tone(frame, AS_OF), country_activity(frame, AS_OF)
    day = dashboard.most_volatile_day(tone).first()
    assert (day.event_date, day.conflict_pct) == (dt.date(2024, 1, 2), 50.0)
    assert [r.action_geo_country_code for r in dashboard.top_countries(countries, 1).collect()] == ["US"]
    assert dashboard.tone_over_time(tone).columns == ["event_date", "quad_class_label", "avg_tone", "event_count"]
    assert {r.iso_country_code for r in dashboard.sentiment_map(countries).collect()} == {"US", "FR"}


def test_declared_checks(spark):
    frame = staged(spark, event(1), event(1), event(2, quad=7), event(3, quad=None), event(4, tone=-101.0))
    tone, countries = daily_event_tone(frame, AS_OF), country_activity(frame, AS_OF)
    checks = daily.model_checks(None, frame, tone, countries)
    from eventpulse.operators.checks import summarise

    got = {(r.relation, r.check_name, r.column_name): r.status for r in summarise(checks).collect()}
    assert len(got) == 15
    assert got["events", "unique", "global_event_id"] == "warn"
    assert got["events", "accepted_values", "quad_class"] == "error"
    assert got["events", "not_null", "quad_class"] == "error"
    assert got["events", "accepted_range", "avg_tone"] == "error"
    assert got["mart_country_activity", "unique", "country_rank"] == "pass"
