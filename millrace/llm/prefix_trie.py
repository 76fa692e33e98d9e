"""The trie of conversation prefixes, as node tables under minimal perfect hashes.

A prefix of ``d`` turns is named by a digest of 128 bits: the exclusive or, over its turns, of
hashes of place, role and text. So prefixes of one conversation are running values that can be
worked out piece by piece, and a conversation of any length is spread over tasks.

Conversations are dealt to shards in the order of their first turns, so that shared prefixes
mostly meet, and every shard holds a bounded number of rows whatever a first turn has. A shard
lists its distinct digests and builds a minimal perfect hash over them: level by level, a digest
that lands alone takes a place, the others go on, and a place's rank is its slot. Every lookup
is compared with the digest kept in the slot, and all rows of a slot must agree in depth, parent
and turn; if two prefixes ever share a digest, everything is done again with another seed.
Member counts are scattered into flat arrays by slot.

What a node adds to its ancestors (being childless, saved tokens) is known once the counts of
all shards are summed by digest. It is put into the slot of one shard that holds the node, and
each shard adds it up through its array of parent slots, deepest nodes first. A node that
several shards hold gets the sum of theirs, as every addition is in one shard only.

Paths are cut every ``SEGMENT`` turns, where a new table begins: what lies beyond the end of a
conversation's segment is handed in there, as a sum for each segment of the conversation that
owns the nodes (the smallest member of each).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: The rule of rebuilding: blocks of conversations, and the modulus of the shared turns.
BLOCK, SHARED = 20, 4
SEGMENT = 16_384
SHARD_ROWS, LEAST_SHARDS = 65_536, 64
#: Ids in one piece of a list of members.
CHUNK = 512
#: A parent of more children than this, and than a 65,536th of all nodes, is joined by broadcast.
CROWDED = 1024
TRIES = 8

NODE = (
    "shard int, slot int, parent_slot int, depth long, a long, b long, pa long, pb long, "
    "ka long, kb long, words long, n long, least long, clash boolean"
)


# --- rebuilt conversations -------------------------------------------------------


def turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, ka, kb, words)``: 120 bits of the SHA-256 of role and text, and the
    words of the text. Null role or text is empty; rows without a conv_id are left out."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)

    def part(start: int) -> Column:
        return F.conv(F.substring("whole", start, 15), 16, 10).cast("long")

    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")).cast("long")
    return (
        conversations.where("conv_id IS NOT NULL")
        .select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            whole.alias("whole"),
            words.alias("words"),
        )
        .select("conv_id", "turn", part(1).alias("ka"), part(16).alias("kb"), "words")
    )


def numbered(rows: DataFrame) -> DataFrame:
    """Turns with ``idx`` from 1 in each conversation, by turn (null first), then by content.

    All rows are put in order together and numbered inside (conversation, partition), so that a
    conversation of any length is shared by tasks; the partitions before give the offset.
    """
    order = [F.asc_nulls_first("turn"), F.asc("ka"), F.asc("kb")]
    spread = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(
        "conv_id", *order, "row"
    )
    spread = stored(spread.withColumn("part", F.spark_partition_id()), "ordered-turns")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        spread.groupBy("part", "conv_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("part", "conv_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    local = F.row_number().over(Window.partitionBy("part", "conv_id").orderBy(*order))
    return stored(
        spread.withColumn("local", local)
        .join(offsets, ["part", "conv_id"])
        .select("conv_id", (F.col("offset") + F.col("local")).alias("idx"), "ka", "kb", "words"),
        "numbered-turns",
    )


def rebuilt(own: DataFrame, shards: int) -> DataFrame:
    """A row for each conversation: how many of its first turns are not its own (``h``), the
    turns taken in their place (``heads``), its ``length`` and its ``shard``."""
    few = F.when(F.col("idx") < SHARED + 1, F.struct("idx", "ka", "kb", "words"))
    sizes = own.groupBy("conv_id").agg(
        F.max("idx").alias("n"), F.sort_array(F.collect_list(few)).alias("first")
    )
    other = sizes.select(
        F.col("conv_id").alias("base"), F.col("n").alias("base_n"), F.col("first").alias("base_first")
    )
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    lead = F.coalesce(F.get("heads", F.lit(0)), F.get("first", F.col("h").cast("int")))
    found = (
        sizes.withColumn("base", F.col("conv_id") - F.col("conv_id") % BLOCK)
        .join(other, "base", "left")
        .withColumn("h", h)
        .withColumn("taken", taken.cast("int"))
        .withColumn("heads", F.when(F.col("taken") > 0, F.slice("base_first", F.lit(1), F.col("taken"))))
        .withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
        .select(
            "conv_id", "n", "h", "taken", "heads", "length", lead["ka"].alias("fa"), lead["kb"].alias("fb")
        )
    )
    return stored(
        found.repartitionByRange(shards, "fa", "fb", "conv_id")
        .withColumn("shard", F.spark_partition_id())
        .drop("fa", "fb"),
        "rebuilt-conversations",
    )


def prefixes(own: DataFrame, convs: DataFrame, shards: int, segment: int, seed: int) -> DataFrame:
    """A row for each prefix of each conversation, the empty one included: its digest ``a, b``,
    its parent's ``pa, pb``, and ``last`` where it is the whole conversation."""
    by = convs.select(
        "conv_id", "h", "taken", "length", "shard",
        F.explode(F.sequence(F.lit(0), F.expr(f"n div {segment}"))).alias("piece"),
    )
    own_rows = (
        own.withColumn("piece", F.expr(f"idx div {segment}"))
        .join(by, ["conv_id", "piece"])
        .where("idx > h")
        .select("conv_id", "shard", "length", (F.col("idx") - F.col("h") + F.col("taken")).alias("depth"), "ka", "kb", "words")
    )
    head_rows = convs.select(
        "conv_id", "shard", "length", F.posexplode("heads").alias("depth", "turn")
    ).select("conv_id", "shard", "length", (F.col("depth") + 1).cast("long"), "turn.ka", "turn.kb", "turn.words")
    rows = (
        own_rows.union(head_rows)
        .withColumn("segment", F.expr(f"depth div {segment}"))
        .withColumn("xa", F.xxhash64(F.lit(seed), "depth", "ka", "kb"))
        .withColumn("xb", F.xxhash64("kb", "depth", "ka", F.lit(seed)))
    )
    within = Window.partitionBy("conv_id", "segment").orderBy("depth")
    before = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rows.where(F.col("length") >= segment)
        .groupBy("conv_id", "segment")
        .agg(F.bit_xor("xa").alias("xa"), F.bit_xor("xb").alias("xb"))
        .select("conv_id", "segment", *(F.bit_xor(x).over(before).alias(c) for x, c in (("xa", "ca"), ("xb", "cb"))))
        .where("segment > 0")
    )
    digests = [
        F.bit_xor(x).over(within).bitwiseXOR(F.coalesce(F.col(c), F.lit(0))).alias(d)
        for x, c, d in (("xa", "ca", "a"), ("xb", "cb", "b"))
    ]
    elsewhere = F.pmod(F.xxhash64("conv_id", "segment"), F.lit(shards)).cast("int")
    shard = F.when(F.col("segment") == 0, F.col("shard")).otherwise(elsewhere)
    below = (
        rows.join(carried, ["conv_id", "segment"], "left")
        .select("conv_id", shard.alias("shard"), "depth", *digests, "xa", "xb", "ka", "kb", "words",
                (F.col("depth") == F.col("length")).alias("last"))
        .select("conv_id", "shard", "depth", "a", "b", F.col("a").bitwiseXOR(F.col("xa")).alias("pa"),
                F.col("b").bitwiseXOR(F.col("xb")).alias("pb"), "ka", "kb", "words", "last")
    )
    zero = [F.lit(0).cast("long").alias(c) for c in ("depth", "a", "b", "pa", "pb", "ka", "kb", "words")]
    roots = convs.select("conv_id", "shard", *zero, (F.col("length") == 0).alias("last"))
    return stored(below.union(roots), "prefixes")


# --- node tables -----------------------------------------------------------------


def _mixed(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    """64 bits for a digest, other ones for each level."""
    x = a.view(np.uint64) ^ (b.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x = x + np.uint64((level + 1) * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """A minimal perfect hash over distinct digests: slots 0 to ``n`` - 1, one for each.

    In every level the digests left are hashed to places; one that is alone in its place is done,
    and its slot is the rank of the place among those taken. The digests are kept by slot, so that
    a foreign one is told.
    """

    ROOM = 1.5

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.levels: list[tuple[int, np.ndarray, int]] = []
        self.a, self.b = np.empty_like(a), np.empty_like(b)
        left, done = np.arange(len(a)), 0
        while len(left):
            size = max(8, int(self.ROOM * len(left)))
            place = (_mixed(a[left], b[left], len(self.levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size)[place] == 1
            taken = np.zeros(size, bool)
            taken[place[alone]] = True
            ranks = np.where(taken, np.cumsum(taken) - 1, -1).astype(np.int32)
            slots = done + ranks[place[alone]]
            self.a[slots], self.b[slots] = a[left[alone]], b[left[alone]]
            self.levels.append((size, ranks, done))
            done += int(alone.sum())
            left = left[~alone]

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 for one that is not in the table."""
        out, left = np.full(len(a), -1, np.int64), np.arange(len(a))
        for level, (size, ranks, done) in enumerate(self.levels):
            rank = ranks[(_mixed(a[left], b[left], level) % np.uint64(size)).astype(np.int64)]
            hit = rank >= 0
            out[left[hit]] = done + rank[hit]
            left = left[~hit]
        if len(out):
            wrong = (out >= 0) & ((self.a[out] != a) | (self.b[out] != b))
            out[wrong] = -1
        return out


def _numbers(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(n).to_numpy().astype(np.int64, copy=False) for n in names]


def _tabulate(rows: pa.Table, segment: int) -> pa.Table:
    """The node table of one shard."""
    conv, depth, a, b, up_a, up_b, ka, kb, words = _numbers(
        rows, "conv_id", "depth", "a", "b", "pa", "pb", "ka", "kb", "words"
    )
    by = np.lexsort((b, a))
    new = np.ones(len(by), bool)
    new[1:] = (a[by[1:]] != a[by[:-1]]) | (b[by[1:]] != b[by[:-1]])
    names = PerfectHash(a[by[new]], b[by[new]])
    slot, nodes = names.slots(a, b), int(new.sum())
    counts = np.bincount(slot, minlength=nodes)
    least = np.full(nodes, np.iinfo(np.int64).max)
    np.minimum.at(least, slot, conv)
    clash, columns = np.zeros(nodes, bool), {}
    for name, given in (("depth", depth), ("pa", up_a), ("pb", up_b), ("ka", ka), ("kb", kb), ("words", words)):
        flat = np.empty(nodes, np.int64)
        flat[slot] = given
        clash[slot[flat[slot] != given]] = True
        columns[name] = flat
    parent = names.slots(columns["pa"], columns["pb"])
    parent[columns["depth"] % segment == 0] = -1  # above is another table
    shard = np.full(nodes, rows.column("shard")[0].as_py())
    out = {"shard": shard, "slot": np.arange(nodes), "parent_slot": parent} | columns
    out |= {"a": names.a, "b": names.b, "n": counts, "least": least, "clash": clash}
    small = {"shard": pa.int32(), "slot": pa.int32(), "parent_slot": pa.int32(), "clash": pa.bool_()}
    order = [c.split()[0] for c in NODE.split(", ")]
    return pa.table({c: pa.array(out[c], small.get(c, pa.int64())) for c in order})


def _accumulate(rows: pa.Table) -> pa.Table:
    """Additions (rows of no depth) summed over the subtrees of one shard's table."""
    slot, depth, leaves, saved = _numbers(rows, "slot", "depth", "leaves", "saved")
    node = np.flatnonzero(depth >= 0)
    nodes = len(node)
    parent, deep, a, b = (np.empty(nodes, np.int64) for _ in range(4))
    for flat, name in ((parent, "parent_slot"), (deep, "depth"), (a, "a"), (b, "b")):
        flat[slot[node]] = _numbers(rows, name)[0][node]
    added, totals = np.flatnonzero(depth < 0), np.zeros((2, nodes), np.int64)
    for total, given in zip(totals, (leaves, saved)):
        np.add.at(total, slot[added], given[added])
    by = np.argsort(-deep, kind="stable")
    ends = np.append(np.flatnonzero(np.diff(deep[by])) + 1, nodes)
    start = 0
    for end in ends.tolist():  # from the deepest nodes up
        level = by[start:end]
        level = level[parent[level] >= 0]
        for total in totals:
            np.add.at(total, parent[level], total[level])
        start = end
    return pa.table({"a": a, "b": b, "leaves": totals[0], "saved": totals[1]})


def node_tables(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The stored node tables of all shards."""

    def tabulate(table: pa.Table) -> pa.Table:
        return _tabulate(table, segment)

    return stored(rows.drop("last").groupBy("shard").applyInArrow(tabulate, NODE), "node-tables")


def merged(tables: DataFrame) -> DataFrame:
    """A stored row for each distinct prefix, over all shards; ``clash`` where rows of one digest
    differ; ``owner`` is the place of one of its slots."""
    same = ("depth", "pa", "pb", "ka", "kb", "words")
    found = tables.groupBy("a", "b").agg(
        F.sum("n").alias("n_convs"),
        F.min("least").alias("conv_id"),
        F.min(F.expr("shiftleft(cast(shard AS bigint), 32) | slot")).alias("owner"),
        F.max("clash").alias("clash"),
        *(F.min(c).alias(c) for c in same),
        *(F.max(c).alias(f"{c}_most") for c in same),
    )
    differ = F.lit(False)
    for c in same:
        differ |= F.col(c) != F.col(f"{c}_most")
    nodes = found.select(
        "a", "b", "depth", "pa", "pb", "words", "n_convs", "conv_id", "owner",
        (F.col("clash") | differ).alias("clash"),
    )
    children = (
        nodes.where("depth > 0")
        .groupBy(F.col("pa").alias("a"), F.col("pb").alias("b"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    nodes = stored(nodes, "nodes")
    return stored(
        nodes.join(children, ["a", "b"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))),
        "trie-nodes",
    )


def subtree_sums(tables: DataFrame, nodes: DataFrame, rows: DataFrame, segment: int) -> DataFrame:
    """``(a, b, n_leaves, saved_tokens)`` of every node."""
    gains = nodes.select(
        "a", "b", "conv_id", "depth", "owner",
        (F.col("n_children") == 0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    # what lies beyond the end of a segment, summed along the conversation that owns it
    owned = (
        gains.where(F.col("depth") >= segment)
        .groupBy("conv_id", F.expr(f"depth div {segment} - 1").alias("segment"))
        .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    )
    deeper = Window.partitionBy("conv_id").orderBy(F.desc("segment"))
    beyond = (
        rows.where(F.col("depth") % segment == segment - 1)
        .select("a", "b", "conv_id", F.expr(f"depth div {segment}").alias("segment"))
        .join(owned, ["conv_id", "segment"], "left")
        .select("a", "b", *(F.sum(F.coalesce(c, F.lit(0))).over(deeper).alias(c) for c in ("leaves", "saved")))
        .groupBy("a", "b")
        .agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    )
    additions = gains.join(beyond, ["a", "b"], "left").select(
        F.expr("cast(shiftright(owner, 32) AS int)").alias("shard"),
        F.expr("cast(owner & 4294967295 AS int)").alias("slot"),
        F.lit(-1).alias("parent_slot"),
        F.lit(-1).cast("long").alias("depth"),
        "a",
        "b",
        (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
        (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
    )
    none = F.lit(0).cast("long")
    slots = tables.select(
        "shard", "slot", "parent_slot", "depth", "a", "b", none.alias("leaves"), none.alias("saved")
    )
    return (
        slots.union(additions)
        .groupBy("shard")
        .applyInArrow(_accumulate, "a long, b long, leaves long, saved long")
        .groupBy("a", "b")
        .agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    )


# --- members that end at a node ---------------------------------------------------


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Comma-joined ids of rows in order, a few hundred a row."""
    part, number, key, ids = TaskContext.get().partitionId(), 0, None, []

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["a", "b", "part", "number", "ids"]
        )

    for batch in batches:
        out = []
        for a, b, conv_id in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "conv_id"))):
            if ids and (key != (a, b) or len(ids) == size):
                out.append((*key, part, number, ",".join(map(str, ids))))
                number, ids = number + 1, []
            key = a, b
            ids.append(conv_id)
        yield made(out)
    if ids:
        yield made([(*key, part, number, ",".join(map(str, ids)))])


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each run of chunks, fed piece by piece."""
    key, digest = None, None

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[]] * 3
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string()))],
            ["a", "b", "ends_sha256"],
        )

    for batch in batches:
        out = []
        for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids"))):
            if key != (a, b):
                if key:
                    out.append((*key, digest.hexdigest()))
                key, digest = (a, b), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        yield made(out)
    if key:
        yield made([(*key, digest.hexdigest())])


def ends(rows: DataFrame) -> DataFrame:
    """``(a, b, ends_sha256)`` of the nodes at which a conversation ends. The ids are put in order
    and joined in pieces by many tasks, so that a node with very many is a few long rows for the
    one task that must read them one after another."""
    pieces = (
        rows.where("last")
        .select("a", "b", "conv_id")
        .repartitionByRange("a", "b", "conv_id")
        .sortWithinPartitions("a", "b", "conv_id")
        .mapInArrow(partial(_chunks, size=CHUNK), "a long, b long, part int, number long, ids string")
    )
    return (
        stored(pieces, "member-lists")
        .repartition("a", "b")
        .sortWithinPartitions("a", "b", "part", "number")
        .mapInArrow(_hashes, "a long, b long, ends_sha256 string")
    )


def _with_parents(nodes: DataFrame, crowded: int) -> DataFrame:
    """Nodes with their parent's conv_id. Parents of very many children, few by that number, are
    joined by broadcast."""
    most = max(crowded, nodes.count() >> 16)
    parents = nodes.where("n_children > 0").select(
        F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"), "n_children"
    )
    large = F.broadcast(parents.where(F.col("n_children") > most).drop("n_children"))
    small = parents.where(F.col("n_children") <= most).drop("n_children")
    below = nodes.where("depth > 0")
    top = nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return top.unionByName(below.join(large, ["pa", "pb"])).unionByName(
        below.join(large, ["pa", "pb"], "left_anti").join(small, ["pa", "pb"])
    )


def prefix_trie(
    conversations: DataFrame,
    segment: int = SEGMENT,
    shard_rows: int = SHARD_ROWS,
    least_shards: int = LEAST_SHARDS,
    crowded: int = CROWDED,
) -> DataFrame:
    """A row for each node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``.

    Turns are ordered by turn, null first; equal turns by the SHA-256 of role and text; repeated
    rows are turns of their own. Null role or text is empty; rows without a conv_id take no part.
    An empty table has no conversations and so no nodes. Other columns are not read.
    """
    own = numbered(turns(conversations))
    shards = max(least_shards, -(-own.count() // shard_rows))
    convs = rebuilt(own, shards)
    for seed in range(TRIES):
        rows = prefixes(own, convs, shards, segment, seed)
        tables = node_tables(rows, segment)
        nodes = merged(tables)
        if nodes.where("clash").isEmpty():
            break
    else:
        raise RuntimeError("digests of different prefixes are equal under every seed")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        _with_parents(nodes, crowded)
        .join(subtree_sums(tables, nodes, rows, segment), ["a", "b"])
        .join(ends(rows), ["a", "b"], "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256"))
    )
