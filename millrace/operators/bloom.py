"""Bloom filters made and tested by built-in functions.

A filter is cut in buckets of 32,768 bits, chosen by one hash of the key; another hash sets four
bits in the bucket. A bucket is a row with a bitmap of 4 KiB, so a filter is a small table that
is built by a grouping and tested after a join on the bucket.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import any_null

BUCKET_BITS = 1 << 15
KEY_BITS = 12  # bits of a filter for each key
SET_BITS = 4  # bits that a key sets
#: Buckets of a filter that is sent to all tasks: 8 MiB. More keys only make it let more pass.
SENT_BUCKETS = 2048


def hashes(key: Sequence[str]) -> tuple[Column, Column]:
    """The hash that chooses a bucket, and the one that chooses bits."""
    return F.xxhash64(*key), F.xxhash64(F.lit(7), *key)


def bit_places(h: str) -> list[Column]:
    return [
        F.shiftrightunsigned(h, 15 * n).bitwiseAND(F.lit(BUCKET_BITS - 1)) for n in range(SET_BITS)
    ]


def is_set(bits: str, place: Column) -> Column:
    byte = F.substring(F.col(bits), (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("bigint")
    return F.getbit(value, place.bitwiseAND(F.lit(7)).cast("int")) == 1


def all_set(bits: str, h: str) -> Column:
    return reduce(and_, [is_set(bits, place) for place in bit_places(h)])


def buckets(hashed: DataFrame, by: Sequence[str]) -> DataFrame:
    """The buckets of filters, one row for each group of ``by``, from rows with the hash ``h``.

    Bitmaps are gathered by sorting. So that every row is sorted once, and not once for each of
    its bits, each of the ``SET_BITS`` places has a bitmap of its own; the few rows of bitmaps are
    put together afterwards."""
    apart = hashed.groupBy(*by).agg(
        F.array(*map(F.bitmap_construct_agg, bit_places("h"))).alias("__apart")
    )
    single = apart.select(*by, F.explode("__apart").alias("__one"))
    return single.groupBy(*by).agg(F.bitmap_or_agg("__one").alias("bits"))


def may_be_among(df: DataFrame, keys: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows of ``df`` whose key is among ``keys``, and by chance some others. No row moves;
    rows with a NULL in the key are left out."""
    spot, h = hashes(key)
    bucket = F.pmod(spot, F.lit(SENT_BUCKETS)).cast("int")
    sent = buckets(keys.select(bucket.alias("__bucket"), h.alias("h")), ["__bucket"])
    asked = df.where(~any_null(key)).withColumns({"__bucket": bucket, "__h": h})
    held = asked.join(F.broadcast(sent), "__bucket").where(all_set("bits", "__h"))
    return held.select(*df.columns)
