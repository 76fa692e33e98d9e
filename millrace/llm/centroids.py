"""Exact k-means over whole numbers with ns-bounds.

Every vector keeps an upper bound on the distance to its centroid and, for each group of
centroids, a lower bound on the distance to all others of the group, with the round in which
each was measured. All centroids of all rounds so far are kept. A bound measured in round T is
loosened in round t by the norm of the total displacement from T to t, ``|c(t) - c(T)|``, which
is never more than the sum of the drifts of the rounds between and much less where a centroid
wanders back and forth. Where the loosened bounds do not prove that the centroid stays the
only nearest one, its distance is measured, and the groups that still may hold a nearer or
equal one are scanned exactly.

Distances are whole numbers, worked out without rounding; bounds carry a margin for the rounding
of their roots, and an equal distance always fails them. So the result is that of the plain
algorithm, ties included. A round reads the vectors with their bounds once and stores them once.
New centroids come from the vectors that moved, added up per batch inside the tasks; what
reaches the driver is a row for every centroid and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import stored

CLUSTERS, ROUNDS, LENGTH, SCALE, SEED = 40, 5, 64, 256, 2
#: Centroids that share a lower bound.
GROUP = 10
#: More than the relative rounding of a root and a sum.
MARGIN = 1e-12

STATE = (
    "vec_id long, v array<long>, was int, cluster int, seen int, upper double, "
    "lower array<double>, at array<int>, measured int"
)


def whole_numbers(vectors: DataFrame, length: int = LENGTH, scale: int = SCALE) -> DataFrame:
    """``(vec_id, v)`` of the rows with exactly ``length`` components, none null or non-finite;
    ``v`` holds floor(``scale`` * x). A component whose number has no 64 bits is an error."""
    x = F.col("embedding").cast("array<double>")
    finite = "forall(x, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('inf'))"
    wide = F.raise_error(F.lit("a scaled component does not fit 64 bits"))

    def scaled(c):
        return F.when(F.abs(scale * c) < float(1 << 62), F.floor(scale * c)).otherwise(wide.cast("long"))

    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
        .where(F.coalesce(F.size("x") == length, F.lit(False)))
        .where(f"coalesce({finite}, false)")
        .select("vec_id", F.transform("x", scaled).alias("v"))
    )


def starting(rows: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors of smallest SHA-256 of ``seed:vec_id``, by that hash; rows that share an id by
    their components, rows without an id last. Fewer rows give fewer."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    ranked = rows.select(order.alias("h"), "vec_id", "v").orderBy(F.asc_nulls_last("h"), "v")
    chosen = stored(ranked.limit(clusters), "starting-centroids").collect()  # ``clusters`` rows
    chosen.sort(key=lambda r: (r.h is None, r.h or "", r.v))
    return np.array([r.v for r in chosen], np.int64)


# --- inside the tasks ----------------------------------------------------------


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``v`` to the rows of ``c``."""
    most = max((int(np.abs(x.astype(np.float64)).max()) for x in (v, c) if x.size), default=0) + 1
    length = v.shape[1]
    if length * (2 * most) ** 2 < 1 << 52:  # every partial sum is a whole number below 2 ** 53
        a, b = v.astype(np.float64), c.astype(np.float64)
        found = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)
        return found.astype(np.int64)
    kind = np.int64 if length * (2 * most) ** 2 < 1 << 62 else object
    a, b = v.astype(kind), c.astype(kind)
    found = np.empty((len(a), len(b)), kind)
    for j in range(len(b)):
        found[:, j] = ((a - b[j]) ** 2).sum(1)
    if kind is object and found.size and found.max() >= 1 << 63:
        raise OverflowError("a squared distance does not fit 64 bits")
    return found.astype(np.int64)


def _own(v: np.ndarray, c: np.ndarray, cluster: np.ndarray) -> np.ndarray:
    """The exact squared distance of every vector to its own centroid."""
    out = np.empty(len(v), np.int64)
    for j in np.unique(cluster):
        mine = cluster == j
        out[mine] = squared(v[mine], c[j : j + 1])[:, 0]
    return out


def _nearest(d: np.ndarray) -> np.ndarray:
    return d.argmin(1)  # the first of equals: the smaller number


class Bounds:
    """The bounds of a batch of vectors, as arrays."""

    def __init__(self, cluster, seen, upper, lower, at):
        self.cluster, self.seen, self.upper, self.lower, self.at = cluster, seen, upper, lower, at


def groups_of(clusters: int, group: int = GROUP) -> list[np.ndarray]:
    return np.array_split(np.arange(clusters), max(1, clusters // group))


def first_round(v: np.ndarray, c: np.ndarray, groups: list[np.ndarray]) -> tuple[Bounds, np.ndarray]:
    """All distances measured; the bounds, and how many each vector took."""
    d, every = squared(v, c), np.arange(len(v))
    cluster = _nearest(d)
    roots = np.sqrt(d.astype(np.float64))
    upper = roots[every, cluster]
    roots[every, cluster] = np.inf
    lower = np.stack([roots[:, g].min(1) for g in groups], 1)
    zero = np.zeros(len(v), np.int64)
    bounds = Bounds(cluster, zero, upper, lower, np.zeros(lower.shape, np.int64))
    return bounds, np.full(len(v), len(c))


def next_round(
    v: np.ndarray, history: np.ndarray, b: Bounds, groups: list[np.ndarray]
) -> tuple[Bounds, np.ndarray]:
    """The assignment to the last centroids of ``history``, by the bounds of earlier rounds."""
    now, c = len(history) - 1, history[-1]
    moved = np.linalg.norm((history - c).astype(np.float64), axis=2) * (1 + MARGIN)
    furthest = np.stack([moved[:, g].max(1) for g in groups], 1)  # round, group
    group_of = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
    columns = np.arange(len(groups))

    upper = (b.upper + moved[b.seen, b.cluster]) * (1 + MARGIN)
    lower = (b.lower - furthest[b.at, columns]) * (1 - MARGIN)
    measured = np.zeros(len(v), np.int64)
    unsure = np.flatnonzero((lower <= upper[:, None]).any(1))
    if not len(unsure):
        return b, measured

    cluster, seen, at = b.cluster.copy(), b.seen.copy(), b.at.copy()
    kept_upper, kept_lower = b.upper.copy(), b.lower.copy()
    mine = v[unsure]
    own = _own(mine, c, cluster[unsure])
    measured[unsure] = 1
    kept_upper[unsure], seen[unsure] = np.sqrt(own.astype(np.float64)), now
    failed = lower[unsure] <= kept_upper[unsure, None] * (1 + MARGIN)
    best, best_d = cluster[unsure].copy(), own.copy()
    scans = []
    for g, members in enumerate(groups):
        asked = np.flatnonzero(failed[:, g])
        if not len(asked):
            continue
        d = squared(mine[asked], c[members])
        scans.append((g, members, asked, d))
        measured[unsure[asked]] += len(members)
        near = _nearest(d)
        found, found_d = members[near], d[np.arange(len(asked)), near]
        better = (found_d < best_d[asked]) | ((found_d == best_d[asked]) & (found < best[asked]))
        best[asked] = np.where(better, found, best[asked])
        best_d[asked] = np.where(better, found_d, best_d[asked])
    # a centroid that was left counts among the others of its group from now on
    left = np.flatnonzero(best != cluster[unsure])
    rows, old = unsure[left], group_of[cluster[unsure[left]]]
    kept_lower[rows, old] = np.minimum(lower[rows, old], np.sqrt(own[left].astype(np.float64)))
    at[rows, old] = now
    for g, members, asked, d in scans:
        roots = np.sqrt(d.astype(np.float64))
        roots[best[asked][:, None] == members] = np.inf
        kept_lower[unsure[asked], g], at[unsure[asked], g] = roots.min(1), now
    cluster[unsure] = best
    kept_upper[unsure] = np.sqrt(best_d.astype(np.float64))
    return Bounds(cluster, seen, kept_upper, kept_lower, at), measured


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def _lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    rows, width = matrix.shape
    ends = pa.array(np.arange(rows + 1) * width, pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(matrix.ravel(), kind))


def _assign(
    batches: Iterator[pa.RecordBatch], history: np.ndarray, group: int
) -> Iterator[pa.RecordBatch]:
    length, groups = history.shape[2], groups_of(history.shape[1], group)
    for batch in batches:
        if not batch.num_rows:
            continue
        v = _matrix(batch.column("v"), length)
        if len(history) == 1:
            was = pa.nulls(len(v), pa.int32())
            b, measured = first_round(v, history[0], groups)
        else:
            was = batch.column("cluster")
            given = (batch.column(n).to_numpy() for n in ("cluster", "seen", "upper"))
            tables = (_matrix(batch.column(n), len(groups)) for n in ("lower", "at"))
            b, measured = next_round(v, history, Bounds(*given, *tables), groups)
        numbers = [pa.array(x, pa.int32()) for x in (b.cluster, b.seen)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("v"), was, *numbers, pa.array(b.upper),
             _lists(b.lower, pa.float64()), _lists(b.at, pa.int32()), pa.array(measured, pa.int32())],
            ["vec_id", "v", "was", "cluster", "seen", "upper", "lower", "at", "measured"],
        )


def _changes(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """What moved vectors add to and take from clusters, a few rows a batch."""
    for batch in batches:
        v = _matrix(batch.column("v"), length).astype(object)  # sums of any size
        out = []
        for name, sign in (("cluster", 1), ("was", -1)):
            numbers = batch.column(name).to_numpy(zero_copy_only=False)
            for j in np.unique(numbers[~np.isnan(numbers.astype(np.float64))]):
                of = v[numbers == j]
                out.append((int(j), sign * len(of), [sign * int(s) for s in of.sum(0)]))
        clusters, counts, sums = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(clusters, pa.int32()), pa.array(counts, pa.int64()),
             pa.array([[str(x) for x in s] for s in sums], pa.list_(pa.string()))],
            ["cluster", "n", "sums"],
        )


def _distances(batches: Iterator[pa.RecordBatch], c: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        v, cluster = _matrix(batch.column("v"), c.shape[1]), batch.column("cluster")
        d = _own(v, c, cluster.to_numpy())
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), cluster, pa.array(d, pa.int64())], ["vec_id", "cluster", "distance"]
        )


# --- rounds --------------------------------------------------------------------


def assigned(rows: DataFrame, history: np.ndarray, group: int = GROUP) -> DataFrame:
    """One stored round: ``rows`` are vectors in the first round, then the round before."""
    return stored(rows.mapInArrow(partial(_assign, history=history, group=group), STATE), "round")


def _updated(state: DataFrame, counts: list[int], sums: np.ndarray, c: np.ndarray) -> np.ndarray:
    """New centroids; ``counts`` and ``sums`` (whole numbers of any size) are brought up to date."""
    moved = state.where("was IS NULL OR was <> cluster").select("cluster", "was", "v")
    changes = moved.mapInArrow(
        partial(_changes, length=c.shape[1]), "cluster int, n long, sums array<string>"
    )
    number = F.col("sum").cast("decimal(38,0)")
    parts = changes.select("cluster", "n", F.posexplode("sums").alias("at", "sum"))
    totals = parts.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(number).alias("sum"))
    for r in totals.collect():  # clusters times components
        sums[r.cluster, r.at] += int(r.sum)
        if r.at == 0:
            counts[r.cluster] += r.n
    out = c.copy()
    for j, n in enumerate(counts):
        if n:
            out[j] = [s // n for s in sums[j]]  # floors below zero as well
    return out


def cluster_vectors(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    length: int = LENGTH,
    scale: int = SCALE,
    seed: int = SEED,
    group: int = GROUP,
) -> tuple[DataFrame, np.ndarray, list[DataFrame]]:
    """``(rows, centroids, states)``: ``vec_id, cluster, distance`` of every kept vector, stored;
    the final centroids; and the stored rounds with their bounds and ``measured`` distances."""
    rows = whole_numbers(vectors, length, scale)
    c = starting(rows, clusters, seed)
    if not len(c):
        none = vectors.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long")
        return none, c.reshape(0, length), []
    history, states = c[None], [assigned(rows, c[None], group)]
    counts, sums = [0] * len(c), np.zeros(c.shape, object)
    for _ in range(rounds):
        c = _updated(states[-1], counts, sums, c)
        history = np.concatenate([history, c[None]])
        states.append(assigned(states[-1], history, group))
    last = states[-1].select("vec_id", "cluster", "v")
    measured = last.mapInArrow(partial(_distances, c=c), "vec_id long, cluster int, distance long")
    return stored(measured, "distances"), c, states


def report(vectors: DataFrame) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector
    with exactly ``LENGTH`` components, none null or non-finite.

    Other vectors are left out. Vectors without an id and repeated rows are clustered like any
    other. With fewer vectors than clusters there are that many clusters; an empty table gives
    no rows. Columns other than vec_id and embedding are not read. A distance or an inertia that
    does not fit 64 bits is an error.
    """
    rows, c, _ = cluster_vectors(vectors)
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    of = {r.cluster: int(r.s) for r in rows.groupBy("cluster").agg(total.alias("s")).collect()}
    inertia = sum(of.values())
    listed = [
        (j, s, inertia, hashlib.sha256(",".join(map(str, c[j].tolist())).encode()).hexdigest())
        for j, s in of.items()
    ]
    kind = StructType.fromDDL("cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    sheet = vectors.sparkSession.createDataFrame(listed, kind)  # a row for each cluster
    return rows.join(F.broadcast(sheet), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
