"""Exact clustering against the plain algorithm in Python's whole numbers."""

import hashlib
import math

import numpy as np
import pytest

from millrace.llm import centroids

KIND = "vec_id long, embedding array<double>, label int, v string, cluster string, distance long"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, 1, "v", "c", 5) for i, e in rows], KIND)


def plain(rows, clusters=40, rounds=5, length=64, seed=2):
    """``{(vec_id, vector): (cluster, distance)}`` as a list, inertias and centroids."""
    kept = [
        (i, tuple(math.floor(256 * x) for x in e))
        for i, e in rows
        if e is not None and len(e) == length and all(x is not None and math.isfinite(x) for x in e)
    ]
    order = sorted(
        kept,
        key=lambda r: (r[0] is None, "" if r[0] is None else hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]),
    )
    c = [list(v) for _, v in order[:clusters]]

    def nearest(v):
        d = [sum((a - b) ** 2 for a, b in zip(v, x)) for x in c]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        into = [[] for _ in c]
        for _, v in kept:
            into[nearest(v)[0]].append(v)
        c = [[sum(x) // len(m) for x in zip(*m)] if m else old for m, old in zip(into, c)]
    return [(i, v, *nearest(v)) for i, v in kept], c


def check(spark, rows, **options):
    want, c = plain(rows, **{k: x for k, x in options.items() if k != "group"})
    found, got_c, states = centroids.cluster_vectors(frame(spark, rows), **options)
    assert got_c.tolist() == c
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    got = sorted((tuple(r) for r in found.collect()), key=key)
    assert got == sorted(((i, j, d) for i, _, j, d in want), key=key)
    return states


def blobs(seed, n, length, spread=0.3, centres=12):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, length))
    return [(i, (middle[rng.integers(centres)] + spread * rng.normal(size=length)).tolist()) for i in range(n)]


@pytest.mark.parametrize("seed", [0, 1])
def test_clusters_equal_the_plain_algorithm(spark, seed):
    states = check(spark, blobs(seed, 700, 8), clusters=20, rounds=6, length=8, group=4)
    scans = [s.agg({"measured": "avg"}).first()[0] for s in states]
    assert scans[0] == 20 and min(scans[2:]) < 10  # bounds spare most distances


def test_ties_and_repeated_vectors(spark):
    grid = [(i, [float(i % 3), float(i // 3 % 3)]) for i in range(90)]  # whole grids of equal vectors
    check(spark, grid, clusters=12, rounds=4, length=2, group=3)
    check(spark, [(i, [0.5, 0.25]) for i in range(9)], clusters=5, length=2)


def test_awkward_rows(spark):
    rows = blobs(3, 60, 4) + [
        (100, None), (101, []), (102, [1.0] * 3), (103, [1.0] * 5), (104, [None, 1.0, 1.0, 1.0]),
        (105, [float("nan"), 1.0, 1.0, 1.0]), (106, [float("-inf"), 1.0, 1.0, 1.0]), (107, [0.0] * 4),
        (None, [0.1, -0.2, 0.3, -0.4]), (None, [9.0, 9.0, 9.0, 9.0]), (7, [1.0, 1.0, 1.0, 1.0]), (7, [1.0, 1.0, 1.0, 1.0]),
        (108, [-1e-9, 0.0, 1e-9, -0.0]),
    ]
    check(spark, rows, clusters=6, length=4, group=2)
    check(spark, rows[:3], clusters=6, length=4)


def test_wide_components(spark):
    big = [(i, [s * x * 1e5 for x in e]) for (i, e), s in zip(blobs(5, 50, 4), [1, -1] * 25)]
    check(spark, big, clusters=5, length=4)
    huge = [(i, [1e12 + i, -1e13]) for i in range(20)]  # beyond what products of 64 bits hold
    check(spark, huge, clusters=3, length=2)
    with pytest.raises(Exception, match="64 bits"):
        centroids.cluster_vectors(frame(spark, [(1, [1e300, 0.0]), (2, [1.0, 0.0])]), length=2)[0].count()


def test_distances_of_all_widths_agree():
    rng = np.random.default_rng(0)
    for most in (100, 1 << 24, 1 << 27):
        v, c = (rng.integers(-most, most, size=(30, 64)) for _ in range(2))
        want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, y)) for y in c] for x in v]
        assert centroids.squared(v, c).tolist() == want


def test_report(spark):
    rows = blobs(9, 300, 64)
    want, c = plain(rows)
    got = {r.vec_id: r for r in centroids.report(frame(spark, rows)).collect()}
    assert len(got) == len(want) == 300
    for i, _, j, d in want:
        r = got[i]
        assert (r.cluster, r.distance) == (j, d)
        assert r.cluster_inertia == sum(x[3] for x in want if x[2] == j)
        assert r.inertia == sum(x[3] for x in want)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()
    none = centroids.report(frame(spark, []))
    assert none.count() == 0
    assert none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_the_query_reads_whole_tables(spark):
    import __spark_entry__ as entry

    sf_dir = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    want, _ = plain([(r.vec_id, r.embedding) for r in table])
    got = entry.queries()["op13_ns_bounds"](spark, sf_dir).collect()
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got) == sorted((i, j, d) for i, _, j, d in want)
