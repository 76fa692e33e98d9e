"""SimHash near-duplicates by anchor points of a covering code.

Two 23-bit blocks of the 64-bit fingerprint are read in the binary Golay code, whose words
are the anchors: every block lies within the covering radius 3 of exactly one code word. A
fingerprint's home is the pair of its nearest code words. A neighbour that differs in ``t``
bits spends at most ``t`` of them on the two blocks, so it lies within 3 + t1 and 3 + t2 of
that home with t1 + t2 <= t. Each fingerprint is therefore posted to every such pair of
anchors, and at an anchor the fingerprints at home are compared with all that are posted.
No link can be missed, and no list of candidates is cut.

An anchor that gathers very many fingerprints (a crowd of near copies) is not compared pair
by pair. Its fingerprints are posted to all words that differ in ``t / 2`` bits instead: those
that meet at a word are all within ``t`` of each other, so each is linked to the smallest one
there, and two fingerprints within ``t`` always meet. At most 65 different fingerprints can
meet at a word for t = 2, so no group grows with the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, stored, stored_sized, text_key
from .components import components

GOLAY = 0b110001110101  # generator of the binary Golay code of length 23 (fixed value)
BLOCK = 23
CROWD = 256


# --- fingerprints ------------------------------------------------------------


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash over the XXH64 of word shingles; 0 for no words or a null text.

    Lower-cases A-Z; words are runs without ASCII white space (what ``bytes`` splits at).
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    shingles = (
        map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
        if len(words) >= shingle
        else [b" ".join(words)]
    )
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=seed), shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        bits = np.unpackbits(hashes[part : part + (1 << 16)].astype(">u8").view(np.uint8))
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(text: Column, shingle: int = 3) -> Column:
    """The fingerprint of a text column as a signed 64-bit number."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return of(text.cast("binary"))


# --- anchors -----------------------------------------------------------------


def _syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of the division by the generator, for each 23-bit word."""
    rest = words.copy()
    for bit in range(BLOCK - 1, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GOLAY << (bit - 11)), rest)
    return rest


def _patterns(most: int) -> tuple[np.ndarray, np.ndarray]:
    """All 23-bit words of at most ``most`` bits, fewest bits first, and their bit counts."""
    found = [0]
    for _ in range(most):
        found += [w | 1 << i for w in found for i in range(BLOCK) if not w >> i & 1]
    words = np.array(sorted(set(found), key=lambda w: (w.bit_count(), w)), np.int64)
    return words, np.bitwise_count(words).astype(np.int64)


@cache
def _reach(most: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By the number of bits spent on a block: for each of the 2048 syndromes, the differences
    to the code words that become nearest after flipping so many bits and no fewer, as one
    array with offsets."""
    errors, _ = _patterns(3)  # the code is perfect: one error of 3 bits or fewer per syndrome
    leader = np.zeros(2048, np.int64)
    leader[_syndrome(errors)] = errors
    flips, spent = _patterns(most)
    of_flips = _syndrome(flips)
    lists: dict[int, list[np.ndarray]] = {k: [] for k in range(most + 1)}
    for s in range(2048):
        to, first = np.unique(flips ^ leader[of_flips ^ s], return_index=True)
        for k in lists:
            lists[k].append(to[spent[first] == k])
    return {
        k: (np.concatenate(v), np.cumsum([0, *map(len, v)])) for k, v in lists.items()
    }


def anchors_of(words: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(index into words, anchor, whether it is the word's home)`` for all anchors."""
    reach = _reach(most)
    blocks = [(words >> shift & (1 << BLOCK) - 1).astype(np.int64) for shift in (0, BLOCK)]
    syndromes = [_syndrome(b) for b in blocks]
    out = []
    for i in range(most + 1):
        for j in range(most + 1 - i):
            (to_a, at_a), (to_b, at_b) = reach[i], reach[j]
            n_b = at_b[syndromes[1] + 1] - at_b[syndromes[1]]
            n = (at_a[syndromes[0] + 1] - at_a[syndromes[0]]) * n_b
            row = np.repeat(np.arange(len(words)), n)
            k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            a = blocks[0][row] ^ to_a[at_a[syndromes[0][row]] + k // n_b[row]]
            b = blocks[1][row] ^ to_b[at_b[syndromes[1][row]] + k % n_b[row]]
            out.append((row, a | b << BLOCK, np.full(len(row), i + j == 0)))
    return tuple(np.concatenate(x) for x in zip(*out))


def _posted(most: int):
    def post(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in range(0, len(batch), 4096):
                words = batch["fp"].to_numpy()[part : part + 4096]
                row, anchor, home = anchors_of(words, most)
                yield pd.DataFrame({"anchor": anchor, "fp": words[row], "home": home})

    return post


def links(distinct: DataFrame, max_bits: int = 2, crowd: int = CROWD) -> DataFrame:
    """Edges ``(a, b)`` whose components are those of all fingerprints ``fp`` (distinct) that
    differ in at most ``max_bits`` bits, an even number."""
    if max_bits % 2 or max_bits < 0:
        raise ValueError("max_bits must be even")
    if max_bits == 0:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("false")
    posted = stored(
        distinct.select("fp").mapInPandas(
            _posted(max_bits), "anchor long, fp long, home boolean"
        ),
        "posted",
    )
    # only anchors that are somebody's home, and where somebody else is posted, matter
    met = posted.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"), F.max("home").alias("lived_in")
    ).where("lived_in AND n > 1")
    met = stored(met, "met")
    crowded = broadcast_if_small(
        stored_sized(met.where(F.col("n") > crowd).select("anchor"), "crowded")
    )
    pairs = met.where(F.col("n") <= crowd).select("anchor")
    living = posted.where("home").select("anchor", F.col("fp").alias("a")).join(pairs, "anchor")
    compared = (
        living.join(posted.select("anchor", F.col("fp").alias("b")), "anchor")
        .where((F.col("a") != F.col("b")) & (F.bit_count(F.expr("a ^ b")) <= max_bits))
        .select("a", "b")
    )
    bits = [0, *(1 << i for i in range(63)), -(1 << 63)]
    flips = F.array(*[F.lit(x).cast("long") for x in bits])
    words = posted.join(crowded, "anchor", "left_semi").select("fp").distinct().withColumn(
        "word", F.col("fp")
    )
    for _ in range(max_bits // 2):
        words = words.select("fp", F.explode(flips).alias("flip"), "word").select(
            "fp", F.expr("word ^ flip").alias("word")
        ).distinct()
    meet = words.groupBy("word").agg(F.min("fp").alias("m"), F.count(F.lit(1)).alias("n"))
    met_there = words.join(meet.where("n > 1"), "word").select(
        F.col("fp").alias("a"), F.col("m").alias("b")
    )
    return compared.union(met_there).where("a <> b")


# --- operator ----------------------------------------------------------------


def near_duplicates(
    rows: DataFrame, shingle: int = 3, max_bits: int = 2, crowd: int = CROWD
) -> DataFrame:
    """``rows(doc_id, text)`` as ``(doc_id, fp, component_id)``, one row per input row.

    Fingerprints of at most ``max_bits`` different bits are linked; a component's id is its
    smallest doc_id (null doc_ids count only if there are no others). Null and empty texts
    have fingerprint 0 and are linked like any other. Equal fingerprints are one node, so
    copies are never expanded into pairs. Other columns are not read; an empty table gives
    an empty result.
    """
    prints = stored(
        rows.select("doc_id", fingerprints(rows["text"], shingle).alias("fp")), "fingerprints"
    )
    labels = by_fingerprint(prints, max_bits, crowd).select("fp", "component_id")
    return prints.join(labels, "fp")


def by_fingerprint(prints: DataFrame, max_bits: int = 2, crowd: int = CROWD) -> DataFrame:
    """``(fp, root, component_id)`` of all fingerprints in the stored table ``prints``."""
    nodes = stored(
        prints.groupBy("fp").agg(F.min("doc_id").alias("smallest")), "fingerprint-nodes"
    )
    roots = components(links(nodes, max_bits, crowd)).withColumnRenamed("a", "fp")
    rooted = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    return stored(rooted.join(ids, "root").select("fp", "root", "component_id"), "components")


def document_components(documents: DataFrame) -> DataFrame:
    """The digest: fingerprints as 16 hex digits, and components."""
    return near_duplicates(documents).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one(documents: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The documents without near-duplicates: of each component, the row with the smallest
    doc_id stays (a null one only if there is no other); of rows that share it, the one
    whose text key is smallest; of equal rows, one.

    Rows are told apart by doc_id and a 128-bit key of the text, so texts move only once,
    into the join with the rows that stay.
    """
    key = F.struct(
        documents["doc_id"].isNull().alias("no_id"),
        documents["doc_id"].alias("doc_id"),
        text_key(documents["text"]).alias("text"),
    )
    prints = stored(
        documents.select(
            key.alias("key"), "doc_id", fingerprints(documents["text"], shingle).alias("fp")
        ),
        "fingerprints",
    )
    roots = by_fingerprint(prints, max_bits).select("fp", "root")
    rows = prints.groupBy("key", "fp").agg(F.count(F.lit(1)).alias("n")).join(roots, "fp")
    staying = stored(
        rows.groupBy("root").agg(F.min(F.struct("key", "n")).alias("s")).select("s.*"),
        "staying",
    )
    keyed = documents.select(key.alias("key"), F.struct("*").alias("row"))
    once = keyed.join(staying.where("n = 1"), "key", "left_semi")
    repeated = broadcast_if_small(stored_sized(staying.where("n > 1"), "repeated"))
    first = keyed.join(repeated, "key", "left_semi").groupBy("key").agg(
        F.first("row").alias("row")
    )
    return once.unionByName(first).select("row.*")
