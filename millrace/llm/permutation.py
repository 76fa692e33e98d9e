"""Approximate nearest neighbours with a permutation index.

Pivots are a bounded random sample of the vectors. A vector is represented by the order of its
nearest pivots, and posted with its place in that order in each pivot's inverted file. A
query's candidates come from the files of its own nearest pivots: in every file, each vector
gains by how little the two places differ, which ranks by the footrule distance of the two
orders (a missing pivot costs the full length). The nearest by that distance are ranked again
by the exact inner product.

The index is kept in blocks of vectors, each with its own inverted files. Queries are taken
against all blocks, in blocks, and the answers of a query are merged by rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

NEAREST = 20
MOST_PIVOTS = 1024
ORDER = 64
BLOCK_ROWS = 8192
QUERY_ROWS = 8192
#: Share of the vectors of a block that is ranked again, and the least number.
RERANKED, LEAST_RERANKED = 0.15, 2000


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, v)`` of the rows whose vector is not null or zero and has finite components
    only. Rows without an id take no part; of rows that share one, the smallest vector does.
    All vectors must have one length."""
    v = F.col("embedding").cast("array<double>")
    finite = "forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf'))"
    return (
        vectors.select(F.col("vec_id").cast("long"), v.alias("v"))
        .where("vec_id IS NOT NULL AND v IS NOT NULL")
        .where(f"coalesce({finite}, false)")
        .where("exists(v, x -> x <> 0)")
        .groupBy("vec_id")
        .agg(F.min("v").alias("v"))
    )


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def orders(v: np.ndarray, pivots: np.ndarray, order: int) -> np.ndarray:
    """For each row, its nearest pivots (largest inner product with the unit row), nearest
    first."""
    near = v @ pivots.T
    some = np.argpartition(-near, order - 1, axis=1)[:, :order]
    by = np.argsort(-np.take_along_axis(near, some, 1), axis=1, kind="stable")
    return np.take_along_axis(some, by, 1).astype(np.int16)


class InvertedFiles:
    """The pivot files of one block: which vectors have the pivot, and at which place."""

    def __init__(self, posted: np.ndarray, pivots: int):
        rows, order = posted.shape
        flat = posted.ravel()
        by = np.argsort(flat, kind="stable")
        self.rows, self.order = rows, order
        self.ids = (by // order).astype(np.int32)
        self.places = (by % order).astype(np.int16)
        self.starts = np.searchsorted(flat[by], np.arange(pivots + 1))

    def nearest(self, query: np.ndarray, most: int) -> np.ndarray:
        """The ``most`` rows of smallest footrule distance to a query's order."""
        gain = np.zeros(self.rows, np.int32)
        for place, pivot in enumerate(query.tolist()):
            cut = slice(self.starts[pivot], self.starts[pivot + 1])
            gain[self.ids[cut]] += self.order - np.abs(self.places[cut] - place)
        return np.argpartition(-gain, most - 1)[:most] if most < self.rows else np.arange(self.rows)


def build(vectors: DataFrame, most_pivots: int = MOST_PIVOTS, order: int = ORDER, seed: int = 0):
    """``(index, pivots)``: all usable vectors with their orders, stored, and the pivots.

    The pivots are the ``most_pivots`` vectors of smallest keyed hash: a bounded sample. Every
    usable vector is indexed.
    """
    rows = stored(usable(vectors), "vectors")
    chosen = (
        rows.orderBy(F.xxhash64(F.lit(seed), "vec_id"), "vec_id").limit(most_pivots).collect()
    )
    if not chosen:
        return rows.withColumn("posted", F.array().cast("array<int>")), np.empty((0, 0))
    pivots = np.array([r.v for r in chosen])
    pivots /= np.linalg.norm(pivots, axis=1, keepdims=True)
    length = min(order, len(pivots))

    def post(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(posted=list(orders(_matrix(batch["v"]), pivots, length)))

    kind = "vec_id long, v array<double>, posted array<int>"
    return stored(rows.mapInPandas(post, kind), "permutation-index"), pivots


def search(
    index: DataFrame,
    pivots: np.ndarray,
    queries: DataFrame,
    nearest: int = NEAREST,
    reranked: float = RERANKED,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each of ``queries``, rows of the index, the
    ``nearest`` found among all others, nearest first, ties to the smaller vec_id."""
    blocks = max(1, -(-index.count() // block_rows))
    parts = max(1, -(-queries.count() // query_rows))
    several = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    hashed = F.xxhash64(F.lit(1), "vec_id")
    left = index.select(F.pmod(hashed, F.lit(blocks)).cast("int").alias("block"), several, "*")
    right = queries.select(every, F.pmod(hashed, F.lit(parts)).cast("int").alias("part"), "*")

    def meet(_, block: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(block) and len(asked):
            block = block.sort_values("vec_id")
            ids, v = block["vec_id"].to_numpy(), _matrix(block["v"])
            files = InvertedFiles(np.stack(block["posted"].to_numpy()), len(pivots))
            most = max(LEAST_RERANKED, int(reranked * len(ids)))
            for query, q, order in zip(asked["vec_id"], asked["v"], asked["posted"]):
                some = np.sort(files.nearest(order, most))
                some = some[ids[some] != query]
                scores = v[some] @ np.asarray(q, np.float64)
                best = np.argsort(-scores, kind="stable")[:nearest]  # ids rise: ties are right
                out.append(
                    pd.DataFrame(
                        {"query_id": query, "vec_id": ids[some[best]], "score": scores[best]}
                    )
                )
        return pd.concat(out) if out else pd.DataFrame(
            {"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"),
             "score": pd.Series(dtype="float64")}
        )

    found = (
        left.groupBy("block", "part")
        .cogroup(right.groupBy("block", "part"))
        .applyInPandas(meet, "query_id long, vec_id long, score double")
    )
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(by))
        .where(F.col("rank") <= nearest)
        .select("query_id", "rank", "vec_id", "score")
    )


def neighbours(vectors: DataFrame, every: int = 20) -> DataFrame:
    """The nearest rows of every row whose vec_id is divisible by ``every``, against all.

    Null, zero and non-finite vectors and rows without an id neither ask nor answer; fewer
    than ``NEAREST`` other rows give all of them; an empty table gives no rows. Columns other
    than vec_id and embedding are not read.
    """
    index, pivots = build(vectors)
    return search(index, pivots, index.where(F.col("vec_id") % every == 0))
