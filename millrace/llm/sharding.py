"""Reproducible shuffle into shards by a Feistel permutation over global row numbers.

The permutation works on any number of rows ``n``: two radices ``a * b >= n`` are chosen with
``a * b - n`` as small as can be found near the square root of ``n``, the rounds mix the two
digits of a number, and a result of ``n`` or more is walked along its cycle until it falls
below ``n``. A cycle holds at most ``a * b - n`` such results, so the walk has an exact bound.
Row ``x`` at place ``p`` of the shuffle is in shard ``p % shards`` at slot ``p // shards``:
both follow from the row number alone, and back.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

ROUNDS = 6
#: Rows are numbered inside buckets; one offset per bucket is all that is gathered.
BUCKETS = 4096
#: Copies of one row are written out by so many at a time.
COPIES_PER_TASK_ROW = 1 << 20


@dataclass(frozen=True)
class Shuffle:
    """A permutation of 0 .. ``n`` - 1, keyed by ``seed``, as column expressions."""

    n: int
    seed: int = 0

    @property
    def radices(self) -> tuple[int, int]:
        root = isqrt(max(self.n - 1, 0)) + 1
        near = range(root, root + 4096)
        a = min(near, key=lambda a: (a * -(-self.n // a) - self.n, a)) if self.n else 1
        return a, max(1, -(-self.n // a))

    def _pass(self, x: str, keys: list[int], back: bool) -> str:
        a, b = self.radices
        left = f"pmod(xxhash64(k, {self.seed}L, {{r}}), {a}L)"
        right = f"pmod(xxhash64(-k, {self.seed}L, {{l}}), {b}L)"
        if back:
            r = f"pmod(s.r - {right.format(l='s.l')}, {b}L)"
            step = (
                f"transform(array({r}), r -> named_struct("
                f"'l', pmod(s.l - {left.format(r='r')}, {a}L), 'r', r))[0]"
            )
        else:
            left_now = f"pmod(s.l + {left.format(r='s.r')}, {a}L)"
            step = (
                f"transform(array({left_now}), l -> named_struct("
                f"'l', l, 'r', pmod(s.r + {right.format(l='l')}, {b}L)))[0]"
            )
        listed = ", ".join(f"{k}L" for k in keys)
        start = f"named_struct('l', ({x}) div {b}L, 'r', ({x}) % {b}L)"
        return f"aggregate(array({listed}), {start}, (s, k) -> {step}, s -> s.l * {b}L + s.r)"

    def _walk(self, x: str, back: bool) -> Column:
        a, b = self.radices
        keys = list(range(1, ROUNDS + 1))
        keys = keys[::-1] if back else keys
        more = self._pass("x", keys, back)
        walk = f"sequence(1L, {max(1, a * b - self.n)}L)"
        return F.expr(
            f"aggregate({walk}, {self._pass(x, keys, back)}, "
            f"(x, i) -> IF(x < {self.n}L, x, {more}))"
        )

    def place(self, row_number: str) -> Column:
        """The place in the shuffle of the row number in the named column."""
        return self._walk(row_number, back=False)

    def row_number(self, place: str) -> Column:
        """The row number at a place: the inverse."""
        return self._walk(place, back=True)


def numbered(rows: DataFrame, buckets: int = BUCKETS) -> tuple[DataFrame, int]:
    """``(row, row_number)`` for every row, numbered 0 .. n - 1, and n.

    The number depends on the rows' values alone, never on files, splits or attempts: equal
    rows are counted first (map-side), distinct ones are ordered inside hash buckets, and the
    buckets follow one another. Equal rows take consecutive numbers and are written out in
    slices by different tasks, so a row that is repeated without end is in no single task.
    """
    copies = stored(
        rows.select(F.struct("*").alias("row"))
        .groupBy("row")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets))),
        "copies",
    )
    totals = copies.groupBy("bucket").agg(F.sum("copies").alias("total"))
    n = totals.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "bucket", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("bucket_start")
    )
    inside = Window.partitionBy("bucket").orderBy("row").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = copies.withColumn(
        "start", F.coalesce(F.sum("copies").over(inside), F.lit(0))
    ).join(F.broadcast(offsets), "bucket")  # one row per bucket, ``buckets`` at most
    once = starts.where("copies = 1").select(
        "row", (F.col("bucket_start") + F.col("start")).alias("row_number")
    )
    slices = starts.where("copies > 1").select(
        "row",
        (F.col("bucket_start") + F.col("start")).alias("first"),
        "copies",
        F.explode(F.expr(f"sequence(0L, copies - 1, {COPIES_PER_TASK_ROW}L)")).alias("skip"),
    )
    many = slices.repartition("row", "skip").select(
        "row",
        F.explode(
            F.expr(
                "transform(sequence(skip, "
                f"least(skip + {COPIES_PER_TASK_ROW}L, copies) - 1), i -> first + i)"
            )
        ).alias("row_number"),
    )
    return once.unionByName(many), n


def shard_rows(
    rows: DataFrame, shards: int, seed: int = 0, buckets: int = BUCKETS
) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``: shards differ by one row at most, slots are
    gapless from 0, and the same rows with the same seed give the same result anywhere.

    Every column counts as part of a row; pass keys and measures, not bulky texts. Columns
    must be orderable (no maps); an input column named ``shard`` or ``slot`` is replaced.
    Nulls are values like others, equal rows take different slots, an empty table gives an
    empty result.
    """
    numbers, n = numbered(rows.drop("shard", "slot"), buckets)
    place = Shuffle(n, seed).place("row_number")
    return numbers.withColumn("place", place).select(
        "row.*",
        (F.col("place") % shards).cast("int").alias("shard"),
        F.expr(f"place div {shards}L").alias("slot"),
    )


def document_shards(documents: DataFrame, shards: int = 40, seed: int = 0) -> DataFrame:
    """The digest of all documents: size, checksum, shard and slot under the law of rows.

    A null text has no bytes, so size 16 and checksum 0.
    """
    text = F.coalesce(documents["text"], F.lit(""))
    rows = documents.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
    )
    return shard_rows(rows, shards, seed).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
