import datetime as dt
import zipfile

import pytest
from pyspark.sql import functions as F

from eventpulse.plans.daily import create_views, run_daily
from eventpulse.schema import RAW_COLUMNS
from eventpulse.session import work_dir
from eventpulse.sources import dayfiles, folders, lake
from eventpulse.sources.load import load_days, quarantine_path, summarise_load
from eventpulse.sources.snapshots import Warehouse
from eventpulse.sources.tables import landed_dates, read_if_present, replace_dates, replace_table
from eventpulse.streaming.dayfiles import load_new_files, stream_landed, stream_lines

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)


def line(number, day="20240101", fields=58, **values):
    row = {name: "" for name in RAW_COLUMNS}
    row.update(GlobalEventID=str(number), Day=day, DATEADDED=day, QuadClass="1", AvgTone="1.5", NumArticles="2",
               NumMentions="3", GoldsteinScale="-2.0", ActionGeo_CountryCode="US", ActionGeo_Fullname="Place", SOURCEURL="u")
    row.update(values)
    cells = list(row.values()) + ["more", "fields"]
    return "\t".join(cells[:fields])


def put(root, day, *lines):
    path = root / day.strftime("raw/%Y/%m/%d")
    path.mkdir(parents=True, exist_ok=True)
    (path / day.strftime("%Y%m%d.export.CSV")).write_text("\n".join(lines) + "\n")


def put_zip(root, day, members):
    with zipfile.ZipFile(root / day.strftime("%Y%m%d.export.CSV.zip"), "w", zipfile.ZIP_DEFLATED) as archive:
        for name, lines in members.items():
            archive.writestr(name, "\n".join(lines) + "\n")


def audit(load):
    return {r.file_date: (r.status, r.rows_inserted) for r in load.audit.collect()}


def test_backfill_dates():
    assert dayfiles.backfill_dates(dt.date(2024, 3, 2), days=3) == [dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2024, 3, 1)]
    assert dayfiles.backfill_dates(dt.date(2024, 3, 2), day=D1) == [D1]
    for bad in ({}, {"days": 1, "day": D1}, {"days": 0}):
        with pytest.raises(ValueError):
            dayfiles.backfill_dates(D1, **bad)


def test_paths():
    assert dayfiles.lake_path("/lake/", D1) == "/lake/raw/2024/01/01/20240101.export.CSV"
    assert dayfiles.archive_path("/lake", D1) == "/lake/20240101.export.CSV.zip"


def test_jagged_long_and_quoted_lines(spark, tmp_path):
    put(tmp_path, D1, line(1), line(2, fields=57), line(3, fields=40), line(4, fields=60),
        line(5, Actor1Name='"stray', Actor2Name="tab after"))
    got = {r.GlobalEventID: r for r in dayfiles.typed(dayfiles.read_day_files(spark, str(tmp_path), [D1])).collect()}
    assert len(got) == 5
    assert got[1].SOURCEURL == "u" and got[2].SOURCEURL is None and got[2].DATEADDED == 20240101
    assert got[3].DATEADDED is None and got[3].AvgTone == 1.5
    assert got[4].SOURCEURL == "u"
    assert got[5].Actor1Name == '"stray' and got[5].Actor2Name == "tab after"
    assert got[1].Actor1Code is None and got[1].file_date == D1


def test_plain_and_zipped_files_read_alike(spark, tmp_path):
    lines = [line(1), line(2, fields=40), line(3, fields=60), line(4, Actor1Name='"stray é')]
    put(tmp_path, D1, *lines)
    put_zip(tmp_path, D1, {"readme.txt": ["no data"], "20240101.export.CSV": lines, "later.CSV": [line(9)]})
    plain = dayfiles.read_day_files(spark, str(tmp_path), [D1, D2])
    zipped = dayfiles.read_archives(spark, str(tmp_path), [D1, D2])
    columns = [*RAW_COLUMNS, "file_date"]
    assert plain.columns == zipped.columns
    assert sorted(map(str, plain.select(columns).collect())) == sorted(map(str, zipped.select(columns).collect()))


def test_no_file_at_all(spark, tmp_path):
    assert dayfiles.read_day_files(spark, str(tmp_path), [D1]).count() == 0
    load = load_days(spark, dayfiles.read_archives(spark, str(tmp_path), [D1, D2]), [D1, D2], str(tmp_path / "t"))
    assert audit(load) == {D1: ("missing", 0), D2: ("missing", 0)}
    assert not load.ok and load.rows_inserted == 0 and load.table_rows() == 0


def test_load_audit_and_reload(spark, tmp_path):
    put(tmp_path, D1, line(1), line(2))
    put(tmp_path, D3, line(3, day="20240103"))
    table, dates = str(tmp_path / "table"), [D1, D2, D3]
    load = load_days(spark, dayfiles.read_day_files(spark, str(tmp_path), dates), dates, table)
    assert audit(load) == {D1: ("loaded", 2), D2: ("missing", 0), D3: ("loaded", 1)}
    assert (load.rows_inserted, load.table_rows(), load.ok) == (3, 3, False)
    assert {r.status: (r.dates, r.rows_inserted) for r in summarise_load(load.audit).collect()} == {
        "loaded": (2, 3), "missing": (1, 0),
    }

    def again(mode):
        return load_days(spark, dayfiles.read_day_files(spark, str(tmp_path), [D1]), [D1], table, mode=mode)

    assert again("replace").table_rows() == 3
    skipped = again("skip")
    assert audit(skipped) == {D1: ("skipped", 0)} and skipped.ok and skipped.table_rows() == 3
    assert again("append").table_rows() == 5
    assert landed_dates(spark, table, dates, "ingest_date") == [D1, D3]
    for bad in ({"mode": "merge"}, {"on_bad_value": "ignore"}):
        with pytest.raises(ValueError):
            load_days(spark, dayfiles.no_lines(spark), [D1], table, **bad)


def test_bad_values_fail_the_file_or_are_left_out(spark, tmp_path):
    put(tmp_path, D1, line(1), line(2, AvgTone="abc"))
    put(tmp_path, D2, line(3, day="20240102"))
    read = dayfiles.read_day_files(spark, str(tmp_path), [D1, D2])
    failed = load_days(spark, read, [D1, D2], str(tmp_path / "a"))
    assert audit(failed) == {D1: ("failed", 0), D2: ("loaded", 1)}
    assert "1 rows" in failed.audit.where("status = 'failed'").first().error
    kept = load_days(spark, read, [D1, D2], str(tmp_path / "b"), on_bad_value="quarantine")
    assert audit(kept) == {D1: ("loaded", 1), D2: ("loaded", 1)} and kept.ok
    aside = spark.read.parquet(quarantine_path(str(tmp_path / "b"))).collect()
    assert [(r.line, r.bad_columns, r.ingest_date) for r in aside] == [(line(2, AvgTone="abc"), "AvgTone", D1)]
    put(tmp_path, D1, line(1))
    load_days(spark, dayfiles.read_day_files(spark, str(tmp_path), [D1]), [D1], str(tmp_path / "b"), on_bad_value="quarantine")
    assert read_if_present(spark, quarantine_path(str(tmp_path / "b"))) is None
    put(tmp_path, D1, line(1), line(2, AvgTone="abc"))
    bad = dayfiles.quarantined(read).collect()
    assert [(r.GlobalEventID, r.AvgTone, r.bad_columns) for r in bad] == [("2", "abc", "AvgTone")]


def test_good_rows_are_written_once_and_moved(spark, tmp_path, monkeypatch):
    def again(*args, **kwargs):
        raise AssertionError("written again")

    put(tmp_path, D1, line(1), line(2))
    put(tmp_path, D2, line(3, AvgTone="abc"), line(4, day="20240102"))
    table, dates = str(tmp_path / "t"), [D1, D2]
    with monkeypatch.context() as patch:
        patch.setattr("eventpulse.sources.load.replace_dates", again)
        for _ in range(2):
            load = load_days(spark, dayfiles.read_day_files(spark, str(tmp_path), dates), dates, table)
            assert audit(load) == {D1: ("loaded", 2), D2: ("failed", 0)}
            assert spark.read.parquet(table).columns == [*RAW_COLUMNS, "ingest_date"]
            assert sorted(r.GlobalEventID for r in spark.read.parquet(table).collect()) == [1, 2]
    assert not [p.name for p in tmp_path.iterdir() if p.name.startswith("_")]


def test_a_load_of_bad_lines_only(spark, tmp_path):
    put(tmp_path, D1, line(1, AvgTone="abc"), line(2, AvgTone="abc"))
    read = dayfiles.read_day_files(spark, str(tmp_path), [D1])
    assert audit(load_days(spark, read, [D1], str(tmp_path / "a"))) == {D1: ("failed", 0)}
    assert audit(load_days(spark, read, [D1], str(tmp_path / "b"), on_bad_value="quarantine")) == {D1: ("loaded", 0)}
    assert spark.read.parquet(quarantine_path(str(tmp_path / "b"))).count() == 2


def test_dates_of_file_names(spark):
    names = ["20240101.export.CSV", "20240101", "20241301", "2024", "202401", "", "notadate", None, "2024 1 1x"]
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, name string")
    found = rows.select("i", dayfiles.file_date(F.col("name")).alias("d")).collect()
    assert {r.i: r.d for r in found if r.d is not None} == {0: D1, 1: D1}
    assert str(dayfiles.file_date(F.col("some_name"))).count("some_name") == 1


@pytest.mark.parametrize("text", ["NaN", "Infinity", "-inf", "1e400", "1,5"])
def test_numbers_must_be_finite(spark, text):
    lines = spark.createDataFrame([(line(1, AvgTone=text),), (line(2),)], "line string")
    assert [r.bad_columns for r in dayfiles.typed(dayfiles.split_lines(lines)).collect()] == ["AvgTone", ""]


def test_unreadable_archives_fail_alone(spark, tmp_path):
    put_zip(tmp_path, D1, {"20240101.export.CSV": [line(1)]})
    put_zip(tmp_path, D2, {"notes.txt": ["x"]})
    (tmp_path / "20240103.export.CSV.zip").write_bytes(b"not a zip file")
    dates = [D1, D2, D3]
    load = load_days(spark, dayfiles.read_archives(spark, str(tmp_path), dates), dates, str(tmp_path / "t"))
    assert audit(load) == {D1: ("loaded", 1), D2: ("failed", 0), D3: ("failed", 0)}


def test_a_damaged_archive_gives_no_lines(spark, tmp_path):
    path = tmp_path / "20240101.export.CSV.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as archive:
        archive.writestr("20240101.export.CSV", "\n".join(line(i) for i in range(100)))
    content = bytearray(path.read_bytes())
    content[5000] ^= 0xFF
    path.write_bytes(bytes(content))
    got = dayfiles.read_archive_lines(spark, str(tmp_path), [D1]).collect()
    assert len(got) == 1 and got[0].line is None and "CRC" in got[0].file_error


def test_landing(spark, tmp_path):
    source, root = tmp_path / "zips", str(tmp_path / "lake")
    source.mkdir()
    put_zip(source, D1, {"20240101.export.CSV": [line(1), line(2)]})
    lake.land_archives(spark, str(source), root, [D1, D2])
    assert lake.read_landed(spark, root).count() == 2
    put_zip(source, D1, {"20240101.export.CSV": [line(1)]})
    put_zip(source, D2, {"20240102.export.CSV": [line(3)]})
    lake.land_archives(spark, str(source), root, [D1, D2])
    assert lake.read_landed(spark, root).count() == 3
    lake.land_archives(spark, str(source), root, [D1, D2], overwrite=True)
    assert {(r.GlobalEventID, r.file_date) for r in lake.read_landed(spark, root).collect()} == {("1", D1), ("3", D2)}
    assert lake.read_landed(spark, root, [D2]).count() == 1
    assert lake.read_landed(spark, str(tmp_path / "none")).count() == 0


def test_empty_files_are_loaded_and_damaged_ones_failed_also_when_landed(spark, tmp_path):
    source, root = tmp_path / "zips", str(tmp_path / "lake")
    source.mkdir()
    put_zip(source, D1, {"20240101.export.CSV": []})
    (source / "20240102.export.CSV.zip").write_bytes(b"damaged")
    put_zip(source, D3, {"20240103.export.CSV": [line(3, day="20240103")]})
    dates = [D1, D2, D3, dt.date(2024, 1, 4)]
    want = {D1: ("loaded", 0), D2: ("failed", 0), D3: ("loaded", 1), dates[3]: ("missing", 0)}
    there = dayfiles.present_files(spark, str(source), dates, zipped=True)
    load = load_days(spark, dayfiles.read_archives(spark, str(source), dates), dates, str(tmp_path / "t"), present=there)
    assert audit(load) == want
    lake.land_archives(spark, str(source), root, dates)
    there = dayfiles.present_files(spark, root, dates)
    load = load_days(spark, lake.read_landed(spark, root, dates), dates, str(tmp_path / "u"), present=there)
    assert audit(load) == want
    put_zip(source, D2, {"20240102.export.CSV": [line(2, day="20240102")]})
    lake.land_archives(spark, str(source), root, dates)
    load = load_days(spark, lake.read_landed(spark, root, dates), dates, str(tmp_path / "u"), present=there)
    assert audit(load)[D2] == ("loaded", 1)
    put(tmp_path, D1, "")
    there = dayfiles.present_files(spark, str(tmp_path), [D1, D2])
    load = load_days(spark, dayfiles.read_day_files(spark, str(tmp_path), [D1, D2]), [D1, D2], str(tmp_path / "v"), present=there)
    assert audit(load) == {D1: ("loaded", 0), D2: ("missing", 0)}


def test_reloading_many_dates_is_a_few_jobs_and_one_scan(spark, tmp_path):
    dates = [dt.date(2024, 1, d) for d in range(1, 13)]
    for d in dates:
        put(tmp_path, d, line(d.day, day=d.strftime("%Y%m%d")))
    table, jobs = str(tmp_path / "t"), []
    tracker = spark.sparkContext.statusTracker()
    for n in (2, 12):
        for _ in range(2):
            group = f"load-{len(jobs)}"
            spark.sparkContext.setJobGroup(group, group)
            load_days(spark, dayfiles.read_day_files(spark, str(tmp_path), dates[:n]), dates[:n], table)
            jobs.append(len(tracker.getJobIdsForGroup(group)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(jobs) <= 10 and jobs[1] == jobs[3]
    assert spark.read.parquet(table).count() == 12


def test_swapping_folders_survives_a_crash(spark, tmp_path):
    path, staged = str(tmp_path / "t"), str(tmp_path / "_staged-t")
    spark.range(1).write.parquet(path)
    spark.range(5).write.parquet(staged)
    (tmp_path / "t").rename(tmp_path / "_replaced-t")  # as if the run ended between the two moves
    folders.restore(spark, path)
    assert spark.read.parquet(path).count() == 1
    folders.swap_in(spark, staged, path)
    assert spark.read.parquet(path).count() == 5 and not folders.exists(spark, staged)
    assert folders.children(spark, str(tmp_path)) == ["t"]


def test_a_crash_between_the_moves_of_a_date_leaves_the_table_readable(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, D1), (2, D2)], "x int, ingest_date date")
    replace_dates(rows, path, [D1, D2], "ingest_date")
    moves, real = [], folders.at

    def ends_midway(session, place):
        files, hadoop_path = real(session, place)

        class Files:
            def rename(self, a, b):
                moves.append((a, b))
                if len(moves) == 2:
                    raise OSError("the machine went away")
                return files.rename(a, b)

            def __getattr__(self, name):
                return getattr(files, name)

        return Files(), hadoop_path

    monkeypatch.setattr(folders, "at", ends_midway)
    with pytest.raises(OSError, match="went away"):
        replace_dates(rows.withColumn("x", F.col("x") + 10), path, [D1], "ingest_date")
    monkeypatch.undo()
    assert [r.x for r in spark.read.parquet(path).collect()] == [2]  # readable, and the date is set aside, not lost
    replace_dates(rows.withColumn("x", F.col("x") + 20), path, [D2], "ingest_date")
    assert sorted(r.x for r in spark.read.parquet(path).collect()) == [1, 22]


def test_stream_equals_batch_and_loads_each_file_once(spark, tmp_path):
    put(tmp_path, D1, line(1), line(2, fields=40))
    put(tmp_path, D2, line(3, day="20240102"))
    table, progress = str(tmp_path / "t"), str(tmp_path / "progress")

    def run():
        load_new_files(stream_lines(spark, str(tmp_path)), table, progress).awaitTermination()
        return sorted(map(str, spark.read.parquet(table).select(*RAW_COLUMNS, "ingest_date").collect()))

    first = run()
    batch = str(tmp_path / "batch")
    load_days(spark, dayfiles.read_day_files(spark, str(tmp_path), [D1, D2]), [D1, D2], batch)
    assert first == sorted(map(str, spark.read.parquet(batch).select(*RAW_COLUMNS, "ingest_date").collect()))
    assert run() == first
    put(tmp_path, D3, line(4, day="20240103"))
    assert len(run()) == 4


def test_stream_of_archives_with_quarantine(spark, tmp_path):
    put_zip(tmp_path, D1, {"20240101.export.CSV": [line(1), line(2, NumMentions="many")]})
    (tmp_path / "20240102.export.CSV.zip").write_bytes(b"damaged")
    table, bad = str(tmp_path / "t"), str(tmp_path / "bad")
    lines = stream_lines(spark, str(tmp_path), zipped=True)
    load_new_files(lines, table, str(tmp_path / "progress"), quarantine_path=bad).awaitTermination()
    assert [r.GlobalEventID for r in spark.read.parquet(table).collect()] == [1]
    assert spark.read.parquet(bad).count() == 2


def test_stream_stops_at_a_bad_value(spark, tmp_path):
    put(tmp_path, D1, line(1, AvgTone="abc"))
    query = load_new_files(stream_lines(spark, str(tmp_path)), str(tmp_path / "t"), str(tmp_path / "progress"))
    with pytest.raises(Exception, match="bad value in"):
        query.awaitTermination()


def test_stream_of_landed_lines(spark, tmp_path):
    lines = spark.createDataFrame([(line(1), D1), (line(2), D2)], "line string, file_date date")
    lake.land_lines(lines, str(tmp_path))
    load_new_files(stream_landed(spark, str(tmp_path)), str(tmp_path / "t"), str(tmp_path / "p")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "t"))
    assert {(r.GlobalEventID, r.ingest_date) for r in got.collect()} == {(1, D1), (2, D2)}


def test_lines_round_trip(spark, tmp_path):
    text = spark.createDataFrame([(line(7, Actor1Name="x"),)], "line string")
    fields = dayfiles.typed(dayfiles.split_lines(text)).drop("bad_columns")
    back = dayfiles.typed(dayfiles.split_lines(lake.tab_lines(fields))).drop("bad_columns")
    assert back.collect() == fields.collect()


def test_replace_table(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(D1, "b", 1), (D1, "a", 2), (D2, "c", 3)], "d date, k string, v int")
    replace_table(df, path, ["d"], ["k"])
    assert rows(spark.read.parquet(path).select("d", "k", "v")) == [(D1, "a", 2), (D1, "b", 1), (D2, "c", 3)]
    replace_table(df.where(F.col("d") == D2), path, ["d"], ["k"])
    assert spark.read.parquet(path).count() == 1


def test_replace_dates_leaves_no_old_folder(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    schema = "ingest_date date, event_date date, v int"
    first = spark.createDataFrame([(D2, D1, 1), (D2, D2, 2), (D3, D3, 3)], schema)
    replace_dates(first, path, [D2, D3], "ingest_date", ["event_date"])
    second = spark.createDataFrame([(D2, D2, 4)], schema)
    replace_dates(second, path, [D2], "ingest_date", ["event_date"])
    got = spark.read.parquet(path).select("ingest_date", "event_date", "v")
    assert rows(got) == [(D2, D2, 4), (D3, D3, 3)]


def test_daily_run(spark, tmp_path):
    put(tmp_path, D1, line(1), line(2, QuadClass="3", ActionGeo_CountryCode="GM"))
    put(tmp_path, D2, line(3, day="20240102"), line(4, day="20231220"))
    warehouse, dates, as_of = str(tmp_path / "w"), [D1, D2], D3
    for _ in range(2):
        result = run_daily(spark, dayfiles.read_day_files(spark, str(tmp_path), dates), dates, warehouse, as_of)
        tables = Warehouse(spark, warehouse)
        assert result.published and result.load.ok
        assert tables.read("events").count() == 4
        countries = tables.read("mart_country_activity").orderBy("country_rank").collect()
        assert [(r.iso_country_code, r.event_count) for r in countries] == [("US", 3), ("DE", 1)]
        assert tables.read("mart_daily_event_tone").count() == 4
        assert {r.status for r in result.checks.collect()} == {"pass"}
        assert result.checks.count() == 17


def test_views_by_layer_follow_the_tables(spark, tmp_path):
    put(tmp_path, D1, line(1), line(2, QuadClass="3"))
    warehouse = str(tmp_path / "w")
    run_daily(spark, dayfiles.read_day_files(spark, str(tmp_path), [D1]), [D1], warehouse, D3)
    names = create_views(spark, warehouse, "feed")
    assert names[1:3] == ["feed_staging.events", "feed_mart.mart_daily_event_tone"]
    by_class = "SELECT quad_class, event_count FROM feed_mart.mart_daily_event_tone ORDER BY quad_class"
    assert [tuple(r) for r in spark.sql(by_class).collect()] == [(1, 1), (3, 1)]
    put(tmp_path, D2, line(3, day="20240102", QuadClass="4"))
    run_daily(spark, dayfiles.read_day_files(spark, str(tmp_path), [D2]), [D2], warehouse, D3)
    assert [tuple(r) for r in spark.sql(by_class).collect()] == [(1, 1), (3, 1), (4, 1)]
    plan = spark.sql("SELECT count(avg_tone) FROM feed_staging.events WHERE event_date = '2024-01-02'")
    scan = next(x for x in plan._jdf.queryExecution().executedPlan().toString().splitlines() if "avg_tone" in x and "Location" in x)
    partition_filters = scan.partition("PartitionFilters: [")[2].partition("]")[0]
    assert "event_date" in partition_filters and "delivery" in partition_filters
    for layer in ("raw", "staging", "mart"):
        spark.sql(f"DROP DATABASE feed_{layer} CASCADE")


def test_daily_run_without_any_file(spark, tmp_path):
    nothing = dayfiles.read_day_files(spark, str(tmp_path), [D1])
    with pytest.raises(RuntimeError, match="no events"):
        run_daily(spark, nothing, [D1], str(tmp_path / "w"), D3, on_failed_load="publish")
    assert not run_daily(spark, nothing, [D1], str(tmp_path / "w"), D3).published


def test_daily_run_stops_at_a_failed_date(spark, tmp_path):
    put(tmp_path, D1, line(1))
    put(tmp_path, D2, line(2, AvgTone="abc"))
    warehouse, dates = str(tmp_path / "w"), [D1, D2]
    read = dayfiles.read_day_files(spark, str(tmp_path), dates)
    stopped = run_daily(spark, read, dates, warehouse, D3)
    assert (stopped.published, stopped.checks, stopped.load.ok) == (False, None, False)
    assert Warehouse(spark, warehouse).read("mart_daily_event_tone") is None
    assert Warehouse(spark, warehouse).read("events").count() == 1
    told = run_daily(spark, read, dates, warehouse, D3, on_failed_load="publish")
    assert told.published and Warehouse(spark, warehouse).read("mart_daily_event_tone").count() == 1
    with pytest.raises(ValueError):
        run_daily(spark, read, dates, warehouse, D3, on_failed_load="ignore")


def test_report_is_stored_and_rows_to_check_can_be_named(spark, tmp_path):
    put(tmp_path, D1, line(1), line(2, QuadClass="9"))
    warehouse = str(tmp_path / "w")
    read = dayfiles.read_day_files(spark, str(tmp_path), [D1])
    result = run_daily(spark, read, [D1], warehouse, D3)
    failed = {(r.relation, r.check_name) for r in result.checks.where("status = 'error'").collect()}
    assert failed == {("events", "accepted_values"), ("mart_daily_event_tone", "accepted_values")}
    before = result.checks.orderBy("relation", "check_name", "column_name").collect()
    spark.range(1).write.mode("overwrite").parquet(f"{warehouse}/raw_events")
    assert result.checks.orderBy("relation", "check_name", "column_name").collect() == before
    some = run_daily(spark, read, [D1], str(tmp_path / "x"), D3, check_where={"events": "quad_class <> 9"})
    assert {(r.relation) for r in some.checks.where("status = 'error'").collect()} == {"mart_daily_event_tone"}


def test_rows_with_bad_days_are_kept_aside(spark, tmp_path):
    put(tmp_path, D1, line(1), line(2, day="20241399"))
    warehouse = str(tmp_path / "w")
    result = run_daily(spark, dayfiles.read_day_files(spark, str(tmp_path), [D1]), [D1], warehouse, D3, on_bad_date="quarantine")
    assert result.published
    assert [(r.GlobalEventID, r.Day) for r in Warehouse(spark, warehouse).read("bad_dates").collect()] == [(2, 20241399)]


def test_daily_run_with_gate(spark, tmp_path):
    put(tmp_path, D1, line(1))
    warehouse = str(tmp_path / "w")
    good = run_daily(spark, dayfiles.read_day_files(spark, str(tmp_path), [D1]), [D1], warehouse, D3, gate=True)
    assert good.published
    put(tmp_path, D2, line(2, day="20240102", QuadClass="9"))
    held = run_daily(spark, dayfiles.read_day_files(spark, str(tmp_path), [D2]), [D2], warehouse, D3, gate=True)
    assert not held.published
    assert Warehouse(spark, warehouse).read("mart_daily_event_tone").count() == 1


class Settings:
    """Stands in for a session that has only the given settings."""

    def __init__(self, **values):
        self.conf = {key.replace("_", "."): value for key, value in values.items()}


def test_work_dir_is_shared_or_local():
    given = Settings(spark_checkpoint_dir="hdfs://somewhere/folder/", spark_master="yarn")
    assert work_dir(given, "x").startswith("hdfs://somewhere/folder/x-")
    assert work_dir(given, "x") != work_dir(given, "x")
    local = Settings(spark_master="local[2]")
    assert work_dir(local, "a").rsplit("/", 1)[0] == work_dir(local, "b").rsplit("/", 1)[0]
    with pytest.raises(RuntimeError):
        work_dir(Settings(spark_master="yarn"), "x")
