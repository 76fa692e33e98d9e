"""The trie of conversation prefixes against a trie of Python dictionaries."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from millrace.llm import prefix_trie

KIND = "conv_id long, turn long, role string, text string, a long, depth string, shard int, last string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "d", 2, "l") for r in rows], KIND)


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, tie, (role, text)))
    own = {c: [t[-1] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        out[c] = own.get(base, [])[:h] + ts[h:]
    return out


def plain(rows):
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in sorted(rebuilt(rows).items()):
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
        ends[tuple(ts)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p in members:
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(members[p]) - 1) * words
    return sorted(
        (
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def check(spark, rows, **options):
    got = prefix_trie.prefix_trie(frame(spark, rows), **options)
    assert got.columns == COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: (r[0], r[1])) == plain(rows)


def conversations(seed, n, texts=3, longest=7):
    rng = np.random.default_rng(seed)
    return [
        (int(c), t, "user" if t % 2 == 0 else "assistant", "w " * int(rng.integers(texts)) + "end")
        for c in range(n)
        for t in range(int(rng.integers(1, longest)))
    ]


@pytest.mark.parametrize("segment", [2, 3, 16_384])
def test_nodes_equal_a_plain_trie(spark, segment):
    """Paths cut into many tables, into few, and whole."""
    check(spark, conversations(segment, 150), segment=segment, shard_rows=40, least_shards=3, crowded=2)


def test_awkward_rows(spark):
    rows = [
        (0, 1, "user", "hello there"), (0, None, "system", "be kind"), (0, 2, None, None), (0, 3, "user", ""),
        (1, 0, "user", "own"), (1, 1, "user", "own"), (1, 1, "user", "own"), (1, 1, "user", "other tie"),
        (2, 0, "", "\t\n  \x0b"), (3, 5, "user", "x" * 200_000 + " y"), (4, -1, "user", "é 日本 \x85 b"),
        (25, 0, "user", "no base here"), (26, 0, None, None), (-3, 0, "user", "below zero"), (-40, 0, "user", "base"),
        (-45, 1, "user", "z"), (-45, 0, "ab", "c"), (-46, 0, "a", "bc"), (None, 0, "user", "no id"), (1 << 40, 0, "user", "hello there"),
    ]
    check(spark, rows, segment=3, least_shards=2)
    check(spark, rows)


def test_hot_first_turn_long_conversation_and_copies(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(700) for t in range(3)]  # copies of one
    rows += [(c, 0, "system", "common") for c in range(1000, 1500)]
    rows += [(c, 1, "user", f"own {c}") for c in range(1000, 1500)]
    rows += [(c, t, "user", f"t{t // 2}") for c in (2000, 2020, 2021) for t in range(900)]
    check(spark, rows, segment=64, shard_rows=100, crowded=50)


def test_turnless_conversations_and_an_empty_table(spark):
    few = [(c, 0, "user", f"only {c}") for c in range(21, 40)]  # no base: first turns are dropped
    assert any(not ts for ts in rebuilt(few).values())
    check(spark, few)
    check(spark, [])
    check(spark, [(None, 1, "user", "x")])


def test_perfect_hash():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 100, 20_000):
        a, b = rng.integers(-(1 << 62), 1 << 62, size=(2, n))
        a[: n // 2] = a[0] if n else 0  # half of the digests differ in one number only
        table = prefix_trie.PerfectHash(a, b)
        assert sorted(table.slots(a, b)) == list(range(n))
        assert (table.slots(a + 1, b) == -1).all()


def test_rows_of_one_digest_must_agree():
    import pyarrow as pa

    names = ("shard", "conv_id", "depth", "a", "b", "pa", "pb", "ka", "kb", "words")
    rows = [(0, 1, 1, 5, 6, 0, 0, 1, 1, 2), (0, 2, 1, 5, 6, 0, 0, 1, 9, 2), (0, 3, 1, 7, 7, 0, 0, 3, 3, 2)]
    made = prefix_trie._tabulate(pa.table(dict(zip(names, map(list, zip(*rows))))), 16)
    assert dict(zip(made["a"].to_pylist(), made["clash"].to_pylist())) == {5: True, 7: False}


def test_the_query_reads_whole_tables(spark):
    import __spark_entry__ as entry

    sf_dir = "/root/testdata/sf0.001"
    table = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    got = entry.queries()["op11_prefix_trie"](spark, sf_dir).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: (r[0], r[1])) == plain(table)
