"""The daily run: load files, stage, build both marts, check, report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks as C
from ..sources.load import LoadResult, load_days
from ..sources.snapshots import Warehouse
from .day_states import marts_from_states, refresh_states
from .marts import country_activity, daily_event_tone
from .merge import merge_events
from .staging import bad_dates, stage


# Table and the layer it belongs to.
LAYERS = {
    "raw_events": "raw",
    "events": "staging",
    "mart_daily_event_tone": "mart",
    "mart_country_activity": "mart",
}
# Tables of a warehouse that no view is made for: check_report, bad_dates and the day states.


@dataclass(frozen=True)
class DailyResult:
    """``checks`` is the stored report, or nothing when the run stopped before building.

    ``version`` is that of the warehouse after the run, ``rewritten`` the dates whose events were stored anew.
    """

    load: LoadResult
    checks: DataFrame | None
    published: bool
    version: int = 0
    rewritten: tuple[date, ...] = ()


def create_views(spark: SparkSession, warehouse: str, prefix: str = "news") -> list[str]:
    """Views over the tables in one database per layer, so that they can be queried by name.

    A view looks up the last version when it is used, so it stays valid when its table is rebuilt: the
    short list of deliveries is broadcast and prunes the table's folders.
    """
    names = []
    root = warehouse.rstrip("/")
    listed = f"json.`{root}/_versions/*.json`"
    last = f"(SELECT max(_metadata.file_name) FROM {listed})"
    for name, layer in LAYERS.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}_{layer}")
        names.append(f"{prefix}_{layer}.{name}")
        table = Warehouse(spark, warehouse).read(name)
        if table is None:
            raise ValueError(f"{warehouse} has no table {name} yet")
        columns = ", ".join(f"t.`{c}`" for c in table.columns)
        dated = " AND CAST(t.ingest_date AS STRING) = v.part" if "ingest_date" in table.columns else ""
        spark.sql(
            f"CREATE OR REPLACE VIEW {names[-1]} AS SELECT {columns} FROM parquet.`{root}/{name}` t LEFT SEMI JOIN"
            f" (SELECT part, delivery FROM {listed} WHERE `table` = '{name}' AND _metadata.file_name = {last}) v"
            f" ON t.delivery = v.delivery{dated}"
        )
    return names


def raw_checks(raw: DataFrame) -> list[C.Check]:
    return [C.not_null(raw, column).configured(relation="raw_events") for column in ("GlobalEventID", "Day")]


def staged_checks(staged: DataFrame) -> list[C.Check]:
    found = [
        C.not_null(staged, "global_event_id"),
        C.unique(staged, "global_event_id").configured(severity="warn"),
        C.not_null(staged, "event_date"),
        C.not_null(staged, "quad_class"),
        C.accepted_values(staged, "quad_class", [1, 2, 3, 4]),
        C.accepted_range(staged, "avg_tone", -100, 100),
    ]
    return [check.configured(relation="events") for check in found]


def daily_checks(daily: DataFrame) -> list[C.Check]:
    found = [
        C.not_null(daily, "event_date"),
        C.not_null(daily, "quad_class"),
        C.accepted_values(daily, "quad_class", [1, 2, 3, 4]),
        C.not_null(daily, "event_count"),
    ]
    return [check.configured(relation="mart_daily_event_tone") for check in found]


def country_checks(countries: DataFrame) -> list[C.Check]:
    found = [
        C.not_null(countries, "action_geo_country_code"),
        C.unique(countries, "action_geo_country_code"),
        C.not_null(countries, "country_rank"),
        C.unique(countries, "country_rank"),
        C.not_null(countries, "event_count"),
    ]
    return [check.configured(relation="mart_country_activity") for check in found]


def model_checks(
    raw: DataFrame | None, staged: DataFrame, daily: DataFrame, countries: DataFrame
) -> list[C.Check]:
    """The declared checks of the source, the staged events and both marts."""
    source = raw_checks(raw) if raw is not None else []
    return [*source, *staged_checks(staged), *daily_checks(daily), *country_checks(countries)]


def run_daily(
    spark: SparkSession,
    lines: DataFrame,
    dates: Sequence[date],
    warehouse: str,
    as_of: date,
    on_bad_value: str = "fail",
    on_bad_date: str = "fail",
    gate: bool = False,
    crosswalk_as_listed: bool = False,
    present: DataFrame | None = None,
    on_failed_load: str = "stop",
    check_where: Mapping[str, str] | None = None,
    dedupe: bool = False,
    incremental: bool = False,
) -> DailyResult:
    """Load the given dates, rebuild the marts for the 30 days before ``as_of``, and check all tables.

    All that a run changes becomes visible at once, as the next version of the warehouse, when it ends; a
    run that ends midway has changed nothing. Good dates are loaded and staged in any case. When a date is
    missing or failed the run stops there and publishes no marts, unless ``on_failed_load`` is ``publish``.
    With ``gate`` the marts are only published when no check has an error. The report is a stored table of
    one row per check. ``check_where`` limits the checks of a table to rows, such as
    ``{"events": "event_date >= '2024-01-01'"}``; by default all rows are checked. ``present`` is as in
    ``load_days``. ``dedupe`` keeps an event that was delivered again once, also across dates, and rewrites
    only the dates of which a row is beaten. ``incremental`` keeps partial aggregates per day and
    builds the marts from these, so that a run reads the events of changed days only.
    """
    if on_failed_load not in ("stop", "publish"):
        raise ValueError(f"on_failed_load must be stop or publish, got {on_failed_load!r}")
    run, marts = Warehouse(spark, warehouse).begin(), ("mart_daily_event_tone", "mart_country_activity")
    load = load_days(spark, lines, dates, "raw_events", on_bad_value=on_bad_value, present=present, into=run)
    before, rewritten = run.read("events"), []
    if load.loaded:
        new = run.read("raw_events").where(F.col("ingest_date").isin(load.loaded))
        if on_bad_date == "quarantine":
            set_aside = bad_dates(new).select("GlobalEventID", "Day", "DATEADDED", "SOURCEURL", "ingest_date")
            run.replace_dates(set_aside, "bad_dates", load.loaded, "ingest_date")
        staged, rewritten = stage(new, on_bad_date, keep=["ingest_date"]), load.loaded
        if dedupe:
            staged, rewritten = merge_events(staged, before, load.loaded)
        run.replace_dates(staged, "events", rewritten, "ingest_date", ["event_date"], ["action_geo_country_code"])
    if not load.ok and on_failed_load == "stop":
        return DailyResult(load, None, False, run.commit() if load.loaded else run.base, tuple(rewritten))

    raw, events = run.read("raw_events"), run.read("events")
    if raw is None or events is None:
        raise RuntimeError(f"no events to build from: none of {len(dates)} day files could be loaded")
    if incremental:
        refresh_states(run, before, events, rewritten)
        tone, countries = marts_from_states(run, as_of, crosswalk_as_listed)
    else:
        tone, countries = daily_event_tone(events, as_of), country_activity(events, as_of, crosswalk_as_listed=crosswalk_as_listed)
    # Checks that only filter rows of a mart are counted as it is written.
    where = {name: (check_where or {}).get(name, "true") for name in LAYERS}
    rules = {marts[0]: daily_checks, marts[1]: country_checks}
    layouts = {marts[0]: (["event_date"], ["quad_class_label"]), marts[1]: ((), ["action_geo_country_code"])}
    checks = [*raw_checks(raw.where(where["raw_events"])), *staged_checks(events.where(where["events"]))]
    for name, built in zip(marts, (tone, countries)):
        seen = C.Observed(rules[name](built) if where[name] == "true" else [])
        run.replace_table(built, name, *layouts[name], observed=seen)
        stored = run.read(name).where(where[name])
        checks += seen.told(stored, rules[name]) if seen.checks else rules[name](stored)
    run.replace_table(C.summarise(checks), "check_report")
    report = run.read("check_report")
    passed = not gate or report.where("status = 'error'").isEmpty()
    if not passed:
        for name in marts:
            run.leave(name)
    return DailyResult(load, report, passed, run.commit(), tuple(rewritten))
