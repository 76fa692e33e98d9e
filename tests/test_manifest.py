"""Tables under a manifest: pruning, replays, compaction, crashes, pinned readers."""

import datetime as dt
import glob
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.catalogue import inputs
from millrace.operators import rules
from millrace.operators.checks import run_checks
from millrace.plans import alerts, observability
from millrace.sinks import export, manifest, tables

SF = "/root/testdata/sf0.001"


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k bigint, n bigint")


def span(spark, low, high, n=0):
    return spark.range(low, high, 1, 2).select(F.col("id").alias("k"), F.lit(n).cast("bigint").alias("n"))


def content(spark, path):
    return Counter(tuple(r) for r in tables.read_merged(spark, path).collect())


@pytest.fixture()
def opened(monkeypatch):
    """How many data files each merge opened."""
    seen, read = [], manifest.read_files

    def counted(spark, schema, listed, base=None):
        seen.append(len(listed))
        return read(spark, schema, listed, base)

    monkeypatch.setattr(manifest, "read_files", counted)
    return seen


def load(spark, path, name, df, **extra):
    tables.merge_insert_only(df, path, name, ["k"], **extra)


def test_a_load_opens_only_files_in_its_key_range(spark, folder, opened):
    for n in range(3):
        load(spark, f"{folder}/t", f"base-{n}", span(spark, 1000 * n, 1000 * n + 1000))
    assert sum(opened) == 0  # nothing overlaps: no file was opened
    load(spark, f"{folder}/t", "late", rows(spark, (1500, 1), (99_999, 1)))
    live = manifest.newest(spark, f"{folder}/t").files
    assert opened[-1] == 1 and live.count() >= 6
    assert content(spark, f"{folder}/t")[(1500, 1)] == 0 and content(spark, f"{folder}/t")[(99_999, 1)] == 1


def test_filters_leave_out_files_that_cover_a_key_but_lack_it(spark, folder, opened):
    even = span(spark, 0, 20_000).where("k % 2 = 0")
    load(spark, f"{folder}/t", "even", even)
    load(spark, f"{folder}/t", "odd", rows(spark, *((2 * n + 1, 7) for n in range(40, 44))))
    assert sum(opened) == 0  # in every range, in no filter
    load(spark, f"{folder}/t", "both", rows(spark, (81, 9), (100, 9), (19_001, 9)))
    assert 0 < opened[-1] < manifest.newest(spark, f"{folder}/t").files.count()
    got = content(spark, f"{folder}/t")
    assert got[(81, 9)] == got[(100, 9)] == 0 and got[(19_001, 9)] == 1 and sum(got.values()) == 10_005


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date", "string", "int", "double", "decimal(20,3)"])
def test_no_file_with_a_key_is_left_out(spark, folder, kind):
    """Keys of every type are found again."""
    def keyed(low, high, step, n):
        ids = spark.range(low, high, step, 3)
        if kind == "string":
            key = F.concat(F.lit("é"), F.lpad(F.col("id").cast("string"), 6, "0"))
        elif kind in ("timestamp_ntz", "timestamp", "date"):
            key = (F.lit("1960-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.col("id"), "id")).cast(kind)
        else:
            key = (F.col("id") * 1.5 - 200).cast(kind)
        return ids.select(key.alias("k"), F.lit(n).alias("n"))

    nulls = spark.range(2).select(F.lit(None).cast(kind).alias("k"), F.lit(1).alias("n"))
    for n, part in enumerate((keyed(0, 600, 3, 0), keyed(150, 162, 1, 1).unionByName(nulls))):
        load(spark, f"{folder}/t", f"load-{n}", part)
    got = tables.read_merged(spark, f"{folder}/t").groupBy("n").count().collect()
    assert sorted(map(tuple, got)) == [(0, 200), (1, 10)]


def test_two_column_keys(spark, folder):
    def pair(low, high, b):
        return spark.range(low, high).select(F.col("id").alias("k"), F.lit(b).alias("b"), F.lit(1).alias("n"))

    for n, part in enumerate((pair(0, 500, 1), pair(0, 40, 2), pair(30, 60, 1), pair(30, 60, 2))):
        tables.merge_insert_only(part, f"{folder}/t", f"l{n}", ["k", "b"])
    got = tables.read_merged(spark, f"{folder}/t").groupBy("b").count().collect()
    assert sorted(map(tuple, got)) == [(1, 500), (2, 60)]


def test_loads_leave_a_bounded_number_of_files_and_folders(spark, folder, monkeypatch):
    monkeypatch.setattr(tables.compact, "__kwdefaults__", {"small_files": 3, "file_rows": 1000})
    path = f"{folder}/t"
    for n in range(8):
        load(spark, path, f"load-{n}", rows(spark, *((20 * n + i, n) for i in range(10))).coalesce(1))
    assert sum(content(spark, path).values()) == 80
    assert manifest.newest(spark, path).files.count() <= 4
    assert len([n for n in os.listdir(f"{path}/manifest") if n.isdigit()]) == manifest.KEPT_VERSIONS
    assert len(os.listdir(f"{path}/data")) < 8 and len(os.listdir(f"{path}/filters")) < 8
    load(spark, path, "load-3", rows(spark, (60, 3), (7777, 3)))  # committed long ago: changes nothing
    assert sum(content(spark, path).values()) == 80
    assert tables.read_merged(spark, path, "load-3").count() == 10  # also out of a rewritten file
    load(spark, path, "again", rows(spark, *((k, 99) for k in range(0, 200))))
    assert sum(content(spark, path).values()) == 200


def test_a_commit_is_seen_whole_or_not_at_all(spark, folder, monkeypatch):
    path = f"{folder}/t"
    load(spark, path, "a", rows(spark, (1, 1)))
    publish = manifest.publish

    def dies(*_):
        raise RuntimeError("lost driver")

    monkeypatch.setattr(manifest, "publish", dies)
    with pytest.raises(RuntimeError, match="lost driver"):
        load(spark, path, "b", rows(spark, (2, 2), (None, 3)))
    assert content(spark, path) == Counter({(1, 1): 1})
    os.makedirs(f"{path}/manifest/0000000002")  # a version that was begun but never completed
    assert content(spark, path) == Counter({(1, 1): 1})
    monkeypatch.setattr(manifest, "publish", publish)
    for _ in range(2):
        load(spark, path, "b", rows(spark, (2, 2), (None, 3)))
    assert content(spark, path) == Counter({(1, 1): 1, (2, 2): 1, (None, 3): 1})


def test_an_empty_first_load(spark, folder):
    load(spark, f"{folder}/t", "a", rows(spark, (1, 1)).limit(0))
    assert content(spark, f"{folder}/t") == Counter()
    load(spark, f"{folder}/t", "b", rows(spark, (1, 1), (1, 2)))
    assert sum(content(spark, f"{folder}/t").values()) == 2


# --- results ---------------------------------------------------------------------


def append(spark, root, run_id, day, at="12:00:00"):
    run = run_checks(
        inputs.trips(spark, SF), [rules.range_rule()], as_of=f"{day} {at}", run_id=run_id
    ).pinned()
    tables.append_results(run.result, root)


def partition_filters(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "PartitionFilters: [" in line and "run_date" in line.split("PartitionFilters: [")[1].split("]")[0]]


def test_results_are_committed_together_and_once(spark, folder, monkeypatch):
    append(spark, folder, "r1", "2024-01-30")
    append(spark, folder, "r1", "2024-01-30")
    assert tables.read_results(spark, folder, "audit_log").count() == 1
    assert tables.read_results(spark, folder, "violations").count() == 235
    pinned = tables.read_results(spark, folder, "audit_log")

    def dies(*_):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as m:
        m.setattr(manifest, "publish", dies)
        with pytest.raises(RuntimeError):
            append(spark, folder, "r2", "2024-01-30")
    assert len(glob.glob(f"{folder}/data/commit=*")) == 3  # written, but in no manifest
    for name in ("audit_log", "metrics", "violations"):
        assert {r.run_id for r in tables.read_results(spark, folder, name).select("run_id").distinct().collect()} == {"r1"}
    append(spark, folder, "r3", "2024-01-30")
    assert pinned.count() == 1  # a reader keeps the version it has
    assert tables.read_results(spark, folder, "audit_log").count() == 2


def test_days_prune_files_and_partitions(spark, folder):
    days = [f"2024-01-{d:02d}" for d in (10, 20, 28, 30)]
    for n, day in enumerate(days):
        append(spark, folder, f"r{n}", day)
    audit, metrics = (tables.read_results(spark, folder, n) for n in ("audit_log", "metrics"))
    now = "2024-01-30 12:30:00"
    views = {
        "export": export.export_rows(audit, export.AUDIT_KEYS, dt.date(2024, 1, 30)),
        "alert": alerts.recent_failures(audit, now),
        "trend": observability.trend(metrics, now),
        "matrix": observability.gold_matrix(metrics, now),
        "recent": observability.recent_metrics(metrics, now),
        "today": observability.scorecard_today(metrics, now),
    }
    for name, view in views.items():
        assert partition_filters(view), name
    assert views["export"].count() == 1 and views["alert"].count() == 1
    assert views["matrix"].first().total_rules == 2 * metrics.where("run_id = 'r0'").count()
    some = tables.read_results(spark, folder, "audit_log", "2024-01-20", "2024-01-28")
    assert len(some.inputFiles()) == 2 and some.count() == 2
    assert tables.read_results(spark, f"{folder}/none", "metrics").count() == 0


def test_days_are_compacted_and_runs_still_replaced(spark, folder):
    for n in range(5):
        append(spark, folder, f"r{n}", "2024-01-30", f"12:0{n}:00")
    before = {n: tables.read_results(spark, folder, n).count() for n in ("audit_log", "metrics", "violations")}
    assert tables.compact_results(spark, folder, small_files=4)
    files = manifest.newest(spark, folder).files
    assert files.where("kind = 'audit_log'").count() == 1
    assert not tables.compact_results(spark, folder, small_files=4)
    append(spark, folder, "r2", "2024-01-30", "12:02:00")  # sits in a rewritten file
    assert before == {n: tables.read_results(spark, folder, n).count() for n in before}


# --- publications ----------------------------------------------------------------


def test_targets_are_published_together_or_not_at_all(spark, folder, monkeypatch):
    def frames(n):
        one = spark.createDataFrame([("a", n), (f"x{n}", n)], "k string, n int")
        return {"days": (one, ["k"]), "places": (one.withColumn("m", F.col("n") * 2), ["k"])}

    def state():
        out = {}
        for target in ("days", "places"):
            found = tables.read_published(spark, folder, target)
            out[target] = found and sorted((r.k, r.n) for r in found.collect())
        return out

    assert state() == {"days": None, "places": None}
    tables.publish_snapshots(frames(1), folder, "2024-01-01 00:00:00")
    first = state()
    assert first == {"days": [("a", 1), ("x1", 1)], "places": [("a", 1), ("x1", 1)]}

    def dies(*_):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as m:
        m.setattr(manifest, "publish", dies)
        with pytest.raises(RuntimeError):
            tables.publish_snapshots(frames(2), folder, "2024-01-02 00:00:00")
    assert state() == first
    for _ in range(2):
        tables.publish_snapshots(frames(2), folder, "2024-01-02 00:00:00")
        assert state()["places"] == [("a", 2), ("x1", 1), ("x2", 2)]
    tables.publish_snapshots({"days": frames(3)["days"]}, folder, "2024-01-03 00:00:00")
    assert len(state()["days"]) == 4 and len(state()["places"]) == 3


def test_failures_are_told_and_nothing_is_published(spark, folder):
    audit = spark.sql(
        "SELECT 1L AS log_id, 't' AS table_name, 'c' AS check_name, 'FAIL' AS status, 500L AS row_count, "
        "200L AS issue_count, TIMESTAMP_NTZ '2024-01-30 11:30:00' AS run_timestamp"
    )
    frames = lambda: {"days": (spark.createDataFrame([("a", 1)], "k string, n int"), ["k"])}
    told = alerts.alert_or_publish(audit, "2024-01-30 12:00:00", frames, folder)
    assert told.branch == "alert" and told.messages.count() == 1 and not told.published
    assert tables.read_published(spark, folder, "days") is None
    quiet = alerts.alert_or_publish(audit, "2024-01-30 13:00:00", frames, folder)
    assert quiet.branch == "publish" and list(quiet.published) == ["days"]
    assert "✅ days — rows written" in quiet.messages.first().message


def test_alert_parts_hold_the_newest_lines_first(spark):
    audit = spark.range(1300).selectExpr(
        "id AS log_id", "'t' AS table_name", "'c' AS check_name", "'FAIL' AS status", "500L AS row_count",
        "200L AS issue_count", "TIMESTAMP_NTZ '2024-01-30 11:30:00' + make_dt_interval(0, 0, 0, id div 200) AS run_timestamp",
    )
    failures = alerts.recent_failures(audit, "2024-01-30 12:00:00")
    parts = {r.part: r for r in alerts.alert_messages(failures).collect()}
    assert sorted(parts) == [0, 1, 2] and {r.failures for r in parts.values()} == {1300}
    assert [r.message.count("•") for _, r in sorted(parts.items())] == [500, 500, 300]
    assert alerts.alert_messages(failures.limit(0)).count() == 0
