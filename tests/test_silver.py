"""Merge, deduplication, reconciliation: edges, skew, replay."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.catalogue import inputs
from millrace.operators import bloom, silver, skew
from millrace.sinks import tables

SF = "/root/testdata/sf0.001"


def frame(spark, rows, schema="k bigint, n bigint"):
    return spark.createDataFrame(rows, schema)


def test_merge_edges(spark):
    target = frame(spark, [(1, 0)])
    source = frame(spark, [(1, 1), (2, 2), (None, 3), (3, 4), (3, 5)])
    got = silver.merge_rows(source, target, ["k"]).collect()
    assert sorted(r.n for r in got) == [2, 3, 4, 5]


@pytest.mark.parametrize("per_lane", [1, 100, 10_000])
def test_skewed_merge_equals_brute_force(spark, per_lane):
    rng = random.Random(5)
    keys = [7] * 2000 + [None] * 1500 + [9] * 700 + [rng.randrange(400) for _ in range(2000)]
    rows = [(k, n) for n, k in enumerate(keys)]
    known = [(k, 0) for k in [7] * 900 + list(range(0, 400, 3)) + [None] * 50]
    got = skew.left_anti_spread(
        frame(spark, rows), frame(spark, known), ["k"], spread_by=["n"], rows_per_lane=per_lane
    )
    have = {k for k, _ in known if k is not None}
    assert sorted(r.n for r in got.collect()) == [n for k, n in rows if k not in have]


def test_hot_key_is_spread(spark):
    """A key with two thirds of the rows, not in the target, reaches several tasks."""
    rows = spark.range(30_000).selectExpr("IF(id % 3 < 2, 5, id) AS k", "id AS n")
    target = spark.sql("SELECT 8L AS k")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = skew.left_anti_spread(rows, target, ["k"], spread_by=["n"], rows_per_lane=500)
        sizes = got.groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) > 1 and max(r["count"] for r in sizes) < 0.6 * 30_000
        assert got.count() == 29_999  # only k = 8 is known
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_frequent_keys_bound(spark):
    rows = spark.range(1000).selectExpr("CASE WHEN id < 400 THEN 1 WHEN id < 600 THEN 2 ELSE id END AS k")
    assert [tuple(r) for r in skew.frequent_keys(rows, ["k"], 100).collect()] == [(1, 4), (2, 2)]
    assert [r.k for r in skew.frequent_keys(rows, ["k"], 100, limit=1).collect()] == [1]
    assert skew.frequent_keys(rows, ["k"]).count() == 0


def test_mark_first_keeps_all_rows(spark):
    rng = random.Random(2)
    rows = [(4 if rng.random() < 0.4 else rng.randrange(50), n) for n in range(3000)]
    rows += [(None, n) for n in range(3000, 3200)]
    got = skew.mark_first(frame(spark, rows), ["k"], [F.col("n").asc()], ["n"]).collect()
    assert len(got) == len(rows)
    first: dict = {}
    for k, n in rows:
        first[k] = min(first.get(k, n), n)
    assert all(r.is_first == (r.k is None or first[r.k] == r.n) for r in got)


def test_hot_key_is_ranked_in_many_tasks(spark):
    """Half the rows share one key; after the second window no task holds half."""
    rows = spark.range(20_000).selectExpr("IF(id % 2 = 0, 5, id) AS k", "id AS n")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = skew.mark_first(rows, ["k"], [F.col("n").asc()], ["n"])
        sizes = got.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 0.4 * 20_000
        assert got.where("is_first").count() == 10_000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def surplus_of(rows):
    """All but the first of every complete key, by n."""
    out, seen = Counter(), set()
    for k, n in sorted((r for r in rows if r[0] is not None), key=lambda r: r[1]):
        if k in seen:
            out[(k, n)] += 1
        seen.add(k)
    return out


@pytest.mark.parametrize("rows_per_lane", [1_000_000, 40])
def test_quarantine_is_all_but_the_first(spark, monkeypatch, rows_per_lane):
    """Also where the repeated keys are dealt over lanes."""
    monkeypatch.setattr(skew, "ROWS_PER_LANE", rows_per_lane)
    rng = random.Random(4)
    rows = [(4 if rng.random() < 0.4 else rng.randrange(900), n) for n in range(2000)]
    rows += [(None, n) for n in range(3000, 3050)] + [(5000 + n, n) for n in range(4000, 4500)]
    got = silver.quarantine(frame(spark, rows), ["k"], ["n"])
    assert got.columns == ["k", "n"] and Counter(map(tuple, got.collect())) == surplus_of(rows)


def test_only_rows_of_repeated_keys_are_shuffled_whole(spark):
    rows = spark.range(20_000).selectExpr("IF(id < 60, id % 20, id) AS k", "id AS n", "repeat('x', 50) AS payload")
    repeated = rows.groupBy("k").count().where("count > 1").select("k")
    passed = bloom.may_be_among(rows, repeated, ["k"]).count()
    assert 60 <= passed < 200  # of 20,000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = silver.quarantine(rows, ["k"], ["n"])._jdf.queryExecution().executedPlan()
        exchanges = [line for line in plan.toString().splitlines() if "Exchange hashpartitioning" in line]
        whole = {line.split("hashpartitioning(")[1].split(",")[0:2][1].split("#")[0].strip() for line in exchanges}
        assert "__lane" in whole and sum("__lane" in line for line in exchanges) <= 2  # one, read twice
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert silver.quarantine(rows, ["k"], ["n"]).count() == 40


def test_a_filter_lets_every_key_pass(spark):
    keys = spark.range(0, 30_000, 3).select(F.col("id").alias("k"))
    asked = spark.range(30_000).select(F.col("id").alias("k"), F.lit(1).alias("n"))
    passed = bloom.may_be_among(asked, keys, ["k"])
    assert passed.where("k % 3 = 0").count() == 10_000 and passed.count() < 10_400
    assert bloom.may_be_among(asked, keys.limit(0), ["k"]).count() == 0


def test_quarantine_and_dedup_partition_the_rows(spark):
    rows = inputs.silver(spark, SF, lineage=True)
    kept = silver.dedup_by_key(rows).count()
    surplus = silver.quarantine(rows).count()
    assert kept + surplus == rows.count() and surplus > 0


def test_dedup_limits_groups_before_the_shuffle(spark):
    plan = (
        silver.dedup_by_key(inputs.silver(spark, SF, lineage=True))
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    assert plan.count("WindowGroupLimit") == 2  # partial in the map tasks, then final


def test_reconciliation_is_exact(spark):
    trips = inputs.trips(spark, SF)
    rows = {r.outcome: r.row_count for r in silver.silver_reconciliation(trips).collect()}
    assert sum(rows.values()) == trips.count() == 6000
    assert rows["SILVER"] == silver.silver_filter(trips).count() == 4975


def test_merge_twice_is_merge_once(spark, folder):
    rows = frame(spark, [(1, 1), (2, 2), (2, 3), (None, 4)])
    tables.merge_insert_only(frame(spark, [(1, 0)]), f"{folder}/t", "a", ["k"])
    seen = []
    for _ in range(3):
        tables.merge_insert_only(rows, f"{folder}/t", "b", ["k"])
        seen.append(Counter(tuple(r) for r in tables.read_merged(spark, f"{folder}/t").collect()))
    assert seen[0] == seen[1] == seen[2]
    assert seen[0] == Counter({(1, 0): 1, (2, 2): 1, (2, 3): 1, (None, 4): 1})


def test_distinct_rows_collapse_copies(spark):
    rows = spark.range(5000).selectExpr("IF(id % 3 = 0, 1, id) AS k", "0L AS n")
    assert silver.distinct_rows(rows).count() == rows.distinct().count()
