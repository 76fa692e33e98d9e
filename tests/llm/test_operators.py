"""Each operator against a brute-force version, and over awkward rows."""

import hashlib
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import (
    components,
    decontaminate,
    gru,
    html,
    language,
    packing,
    permutation,
    sharding,
    simhash,
    surrogates,
    warc,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, w string, fp long"
LONG = "the and of " * 30_000


def documents(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "s", 1, "clash", 7) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCS)


AWKWARD = [None, "", " ", "!!!", "One", "One", "a b c", "A B C", LONG, "mail x.1@m.example.com now"]


@pytest.fixture()
def awkward(spark):
    return documents(spark, AWKWARD + ["repeated row"] * 5, [*range(len(AWKWARD) - 1), None] + [99] * 5)


@pytest.fixture()
def empty(spark):
    return documents(spark, [])


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_shuffle_is_a_permutation_with_an_inverse(spark, n):
    shuffle = sharding.Shuffle(n, seed=5)
    rows = spark.range(n).withColumn("p", shuffle.place("id")).withColumn("r", shuffle.row_number("p"))
    got = rows.collect()
    assert sorted(r.p for r in got) == list(range(n))
    assert all(r.r == r.id for r in got)


def test_shards_are_even_and_gapless(spark, awkward, empty):
    got = sharding.document_shards(awkward, shards=4).collect()
    assert len(got) == awkward.count()
    by = Counter(r.shard for r in got)
    assert max(by.values()) - min(by.get(k, 0) for k in range(4)) <= 1
    for shard in by:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(by[shard]))
    text = dict(zip(range(len(AWKWARD) - 1), AWKWARD))
    for r in got:
        if r.doc_id in text:
            data = (text[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32) == (len(data) + 16, zlib.crc32(data))
    again = sharding.document_shards(awkward.repartition(3), shards=4).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert sharding.document_shards(empty).count() == 0


def test_components_are_those_of_union_find(spark):
    random = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in random.integers(0, 200, (150, 2))]
    parent = list(range(200))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {x: find(x) for x in range(200) if find(x) != x}


def test_anchors_meet_whenever_two_bits_differ():
    random = np.random.default_rng(2)
    words = random.integers(-(2**63), 2**63, 40)
    for x in words:
        bits = random.choice(64, random.integers(0, 3), replace=False)
        y = int(x) & (2**64 - 1)
        for b in bits:
            y ^= 1 << int(b)
        y = y - 2**64 if y >= 2**63 else y
        pair = np.array([x, y], np.int64)
        row, anchor, home = simhash.anchors_of(pair, 2)
        assert set(anchor[(row == 0) & home]) <= set(anchor[row == 1])


@pytest.mark.parametrize("crowd", [256, 1])
def test_links_find_all_components(spark, crowd):
    random = np.random.default_rng(3)
    base = random.integers(-(2**63), 2**63, 30)
    fps = set(base.tolist())
    for x in base:
        for _ in range(6):
            x = int(x) ^ (1 << int(random.integers(0, 62))) ^ (1 << int(random.integers(0, 62)))
            fps.add(x)
    a = np.array(sorted(fps))
    near = np.bitwise_count((a[:, None] ^ a[None]).view(np.uint64)) <= 2
    label = np.arange(len(a))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            break
        label = new
    nodes = spark.createDataFrame([(int(x),) for x in a], "fp long")
    got = dict(components.components(simhash.links(nodes, 2, crowd)).collect())
    assert [got.get(int(x), int(x)) for x in a] == a[label].tolist()


def fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_digest_and_survivors(spark, awkward, empty):
    got = simhash.document_components(awkward).collect()
    assert len(got) == awkward.count()
    text = dict(zip(range(len(AWKWARD) - 1), AWKWARD))
    for r in got:
        if r.doc_id in text and text[r.doc_id] != LONG:
            assert r.fingerprint == f"{fingerprint(text[r.doc_id]):016x}"
    assert {r.component_id for r in got if r.doc_id in (0, 1, 2)} == {0}
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns
    rows = kept.collect()
    components_ = {(r.component_id) for r in got}
    assert len(rows) == len(components_)
    assert sum(r.doc_id == 99 for r in rows) == 1
    assert simhash.document_components(empty).count() == simhash.keep_one(empty).count() == 0


def test_decontamination_of_short_items_and_awkward_rows(spark, awkward, empty):
    benchmark = spark.createDataFrame(
        [(1, "a b C"), (1, "A B c"), (2, None), (3, "!"), (None, "ONE"), (4, "zz " * 12)],
        "item_id long, text string",
    )
    got = {r.doc_id: r for r in decontaminate.report(awkward, benchmark).collect()}
    assert (got[6].n_words, got[6].n_hit, got[6].n_items) == (3, 3, 1)
    assert got[6].items_sha256 == hashlib.sha256(b"1").hexdigest()
    assert got[4].items_sha256 == hashlib.sha256(b"").hexdigest() and got[4].n_items == 1
    assert not got[0].contaminated and got[0].n_words == 0
    assert decontaminate.report(empty, benchmark).count() == 0
    assert decontaminate.report(awkward, benchmark.limit(0)).where("contaminated").count() == 0
    kept = decontaminate.keep_clean(awkward, benchmark)
    assert kept.columns == awkward.columns
    assert not {4, 5, 6, 7} & {r.doc_id for r in kept.collect()}


def test_only_ascii_letters_lose_their_case(spark):
    docs = documents(spark, ["x É y", "x é y", "X é Y"])
    items = spark.createDataFrame([(1, "x é y")], "item_id long, text string")
    got = {r.doc_id: r.n_hit for r in decontaminate.report(docs, items).collect()}
    assert got == {0: 0, 1: 3, 2: 3}


@pytest.mark.parametrize("bound", [decontaminate.BROADCAST_BYTES, -1])
def test_windows_at_the_ends_of_texts(spark, monkeypatch, bound):
    """Separators at either end, with term lists that are broadcast and that are shuffled."""
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", bound)
    monkeypatch.setattr("millrace.llm.common.BROADCAST_BYTES", bound)
    run = " ".join(f"w{i}" for i in range(12))
    texts = [run, f"  {run}", f"{run}!", f"-- {run} --", f"a {run} b", run[:-4], f"  {run[:-8]}"]
    docs = documents(spark, texts)
    items = spark.createDataFrame([(1, run)], "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit) for r in decontaminate.report(docs, items).collect()}
    assert got == {0: (12, 12), 1: (12, 12), 2: (12, 12), 3: (12, 12), 4: (14, 12), 5: (11, 11), 6: (10, 10)}


def test_proximity(spark):
    index = decontaminate.postings(documents(spark, ["red a b blue", "red a b c d e f blue"]))
    pairs = spark.createDataFrame([(1, "red", "blue")], "pair_id long, term_1 string, term_2 string")
    got = decontaminate.proximity_matches(index, pairs, 3).collect()
    assert [(r.pos_1, r.pos_2) for r in got] == [(0, 3)]


PRIVATE = [
    "write to Ann.Lee7@mail3.example.com or ann.lee7@mail3.example.com today",
    "call +1 (415) 555-1234 4111111111111111. or +1 415 555 1234!",
    "from 10.20.30.40, 4111 1111 1111 1111 and 123-45-6789",
    "Mrs Anna Petrova met Mr John Smith; MRS PETROVA did not. Mr Smith did. Госпожа Анна Иванова",
]


def test_surrogates_are_distinct_coreferent_and_shaped(spark):
    got = [r.text for r in surrogates.report(documents(spark, PRIVATE)).orderBy("doc_id").collect()]
    mails = re.findall(r"\S+@\S+", got[0])
    assert mails[0] == mails[1] and re.fullmatch(r"[a-z]{3}\.[a-z]{3}\d@[a-z]{4}\d\.example\.com", mails[0])
    phone, card = re.search(r"(\+1 \(\d{3}\) \d{3}-\d{4}) (\d{16})\.", got[1]).groups()
    other = re.search(r"or (\+1 \d{3} \d{3} \d{4})!", got[1])[1]
    digits = lambda x: re.sub(r"\D", "", x)
    assert digits(phone) == digits(other) != "14155551234"
    assert digits(re.search(r", (\d{4} \d{4} \d{4} \d{4}) and", got[2])[1]) == card != "4" + "1" * 15
    odd = [int(c) * 2 - 9 * (int(c) > 4) for c in card[-2::-2]]
    assert (sum(odd) + sum(map(int, card[-1::-2]))) % 10 == 0
    first, last = re.match(r"Mrs (\S+) (\S+) met", got[3]).groups()
    assert first.endswith(("na", "ra", "lia", "sa")) and "Anna" not in got[3]
    john, smith = re.search(r"met Mr (\S+) (\S+);", got[3]).groups()
    assert got[3].endswith(got[3].split("Госпожа ")[1]) and f"Mr {smith} did" in got[3]
    assert smith != last and re.search(r"Госпожа [а-яА-Я]+ [а-яА-Я]+$", got[3])


def test_surrogates_leave_the_rest_alone(spark, awkward, empty):
    got = {r.doc_id: r for r in surrogates.report(awkward).collect()}
    assert got[0].text is None and got[8].text == LONG and got[None].n_mentions == 1
    assert "x.1@" not in got[None].text and got[None].text.endswith(" now")
    assert surrogates.rewrite(awkward).columns == awkward.columns
    assert surrogates.rewrite(empty).count() == 0


def test_names_with_apostrophe_or_hyphen(spark):
    texts = ["Mr O'Brien came.", "Mrs D’Angelo and Mr. J-P Smith", "Mr O'BRIEN", "MR x"]
    got = [r.text for r in surrogates.report(documents(spark, texts)).orderBy("doc_id").collect()]
    brien = re.fullmatch(r"Mr ([A-Z][a-z]+) came\.", got[0])[1]
    assert re.fullmatch(r"Mrs [A-Z][a-z]+ and Mr\. [A-Za-z]+ [A-Z][a-z]+", got[1])
    assert got[2] == f"Mr {brien.upper()}" and got[3] == "MR x"


def test_surrogates_of_common_forms(spark):
    forms = ["2001:db8::1", "2001:0DB8:0:0:0:0:0:1", "::1", "+14155550123", "415 555 0123",
             "+49 30 1234567", "3782 822463 10005"]
    texts = [f"call {x} now" for x in forms] + [
        "Dr. Jane Doe and Mr. J. Smith; Prof. Dr. Ada Poe", "Mr John Smith came. Smith said, SMITH'S hat, Smithson",
        "std::vector a::b at 12:30", "Smith alone", "Mr Irwin İrwin, İRWIN Irwin-Poe irwin",
    ]
    got = [r.text for r in surrogates.report(documents(spark, texts)).orderBy("doc_id").collect()]
    for form, text in zip(forms, got):
        assert form not in text and text.startswith("call ") and text.endswith(" now")
    assert got[0].lower() == got[1].lower() and re.fullmatch(r"call \d{4} \d{6} \d{5} now", got[6])
    assert re.fullmatch(r"call \+1\d{10} now", got[3]) and re.fullmatch(r"call \d{3} \d{3} \d{4} now", got[4])
    assert not re.search("Jane|Doe|J\\.|Smith|Ada|Poe", got[7]) and "; Prof. Dr. " in got[7]
    new = re.match(r"Mr \S+ (\S+) came", got[8])[1]
    assert got[8].endswith(f" {new} said, {new.upper()}'S hat, Smithson") and got[9:11] == texts[9:11]


def test_colliding_draws_are_drawn_again(spark, monkeypatch):


    monkeypatch.setattr(
        surrogates.Drawing, "surrogate", lambda self: F.expr("CAST(pmod(xxhash64(entity, draw), 6) AS STRING)")
    )
    real = spark.createDataFrame([("k", x) for x in ("0", "1", "x", "y")], "kind string, entity string")
    drawn = surrogates.draw_all(real, 1).collect()
    found = [r.surrogate for r in drawn]
    assert len(set(found)) == 4 and not {"0", "1"} & set(found)


def test_packing_round_trip(spark, awkward, empty):
    got = packing.pack_documents(awkward, capacity=64, lane_pieces=100, with_ids=True).collect()
    plain = packing.WordTokens(packing.tokenizer_path()).whole
    want = Counter()
    for r in awkward.collect():
        ids = plain.encode(r.text or "", add_special_tokens=False).ids + [1]
        want.update((r.doc_id, s // 64, s, tuple(ids[s : s + 64])) for s in range(0, len(ids), 64))
    assert Counter((r.doc_id, r.piece, r.start, tuple(r.ids)) for r in got) == want
    for sequence in {r.sequence_id for r in got}:
        end = 0
        for r in sorted((r for r in got if r.sequence_id == sequence), key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end <= 64
    assert packing.pack_documents(empty).count() == 0


@pytest.mark.parametrize("text", ["İstanbul ΣΑΣ ﬁn", "don't we'll x'd", "a\x1cb c", "naïve é", "<|endoftext|> x"])
def test_tokens_equal_the_tokenizer(text):
    tokens = packing.WordTokens(packing.tokenizer_path())
    want = tokens.whole.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(tokens.of(text), "<u4").tolist() == want


@pytest.mark.parametrize(
    "text", ["<|endoftext|> x", "a<|endoftext|>b", "<|startoftext|><|endoftext|>é", "<|ENDOFTEXT|> <|endo\nftext|>"]
)
def test_special_tokens_are_those_of_the_file(text):
    from tokenizers import Tokenizer

    fresh = Tokenizer.from_file(packing.tokenizer_path())
    want = np.array(fresh.encode(text, add_special_tokens=False).ids, "<u4")
    tokens = packing.WordTokens(packing.tokenizer_path())
    assert tokens.of(text) == tokens.of(text) == want.tobytes()


def test_the_fullest_bin_closes_first():
    bins = packing.BestFit(10, open_bins=2)
    assert [bins.put(n)[0] for n in (6, 8, 7, 4, 3)] == [0, 1, 2, 0, 2]


@pytest.mark.parametrize("repeated", ["Mr ", "Mr. ", "x.", "x@", "a.b@", "1", "12 ", "1:", "a:b::", "Ab ", "A", "+1 ", "0.", "AB12 "])
def test_texts_of_many_repeats_end_no_executor(spark, repeated):
    hostile = [repeated * 20_000, "x@" + repeated * 20_000 + "com", "Mr " + repeated * 20_000, "mail a.b@example.org"]
    got = {r.doc_id: r.text for r in surrogates.report(documents(spark, hostile)).collect()}
    assert len(got) == 4 and got[3] != hostile[3]


def test_language_on_held_out_texts(spark, awkward, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.98
    odd = {r.doc_id: r for r in language.identify(awkward).collect()}
    assert [odd[k].lang_pred for k in range(4)] == ["und"] * 4 and odd[8].lang_pred == "en"
    assert language.identify(empty).count() == 0
    assert {r.doc_id for r in language.keep_identified(awkward).collect()} >= {4, 5, 8, None, 99}


def test_the_language_stage_fills_and_filters(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    known = [r.lang for r in docs.select("lang").distinct().collect() if r.lang]
    hidden = docs.withColumn("true", F.col("lang")).withColumn(
        "lang", F.when(F.col("doc_id") % 3 != 0, F.col("lang"))
    )
    kept = language.keep_identified(hidden)
    assert kept.columns == hidden.columns
    filled = kept.where("doc_id % 3 = 0 AND true IS NOT NULL").collect()
    assert sum(r.lang == r.true for r in filled) >= 0.95 * len(filled) > 0
    one = language.keep_identified(hidden, wanted=known[:1])
    assert 0 < one.count() < kept.count() and one.where(F.col("true") != known[0]).count() <= 0.05 * one.count()
    assert language.keep_identified(docs.limit(0)).count() == 0


def test_unlabelled_documents_stay(spark, awkward):
    kept = language.keep_identified(awkward.drop("lang").selectExpr("*", "CAST(NULL AS STRING) AS lang"))
    assert {r.doc_id for r in kept.collect()} == {4, 5, 6, 7, 8, None, 99} and kept.count() == 11
    assert all(r.lang is None for r in kept.collect())
    blank = documents(spark, ["one two three", "4", "five"])  # one language: nothing to be told apart
    assert {r.doc_id for r in language.keep_identified(blank).collect()} == {0, 2}


def test_gradients():
    random = np.random.default_rng(0)
    weights = gru.initial(random.integers(1, 9, gru.HEAD).astype(float), np.ones(gru.TAILS))
    weights = {k: v.astype(np.float64) for k, v in weights.items()}
    ids = random.integers(0, gru.HEAD + gru.TAILS, (6, 3))
    mask, h = np.ones((5, 3), np.float32), np.zeros((3, gru.HIDDEN))
    loss = lambda w: gru.gradients(w, ids[:-1], ids[1:], mask, h)
    _, grad, _ = loss(weights)
    for name, at in (("Wh", (3, 5)), ("Wx", (2, 40)), ("Wc", (1, 2)), ("b", (70,)), ("E", (int(ids[1, 0]), 3))):
        moved = {k: v.copy() for k, v in weights.items()}
        moved[name][at] += 1e-3
        up = loss(moved)[0]
        moved[name][at] -= 2e-3
        slope = (up - loss(moved)[0]) / 2e-3
        assert abs(slope - grad[name][at]) < 2e-3 * max(1, abs(slope))


def test_gradients_of_all_weights(monkeypatch):
    random = np.random.default_rng(1)
    weights = gru.initial(random.integers(1, 9, gru.HEAD).astype(float), np.ones(gru.TAILS))
    weights = {k: v.astype(np.float64) for k, v in weights.items()}
    ids = random.integers(0, 70, (5, 3))  # words of three classes
    ids[2:4, 1] = gru.HEAD + 5, gru.HEAD + 63
    mask, h = np.ones((4, 3)), random.uniform(-1, 1, (3, gru.HIDDEN))
    mask[2:, 0] = 0
    results = []
    for bound in (gru.LOGIT_BOUND, 0.0):  # without and with the largest logit taken off
        monkeypatch.setattr(gru, "LOGIT_BOUND", bound)
        results.append(gru.gradients(weights, ids[:-1], ids[1:], mask, h))
    (_, grad, last), (_, shifted, _) = results
    for name, x in weights.items():
        assert np.allclose(grad[name], shifted[name], atol=1e-12)
        across = random.normal(size=x.shape)  # the slope along one direction takes in every cell
        up, down = (
            gru.gradients({**weights, name: x + e * across}, ids[:-1], ids[1:], mask, h)[0]
            for e in (1e-5, -1e-5)
        )
        assert abs((up - down) / 2e-5 - (grad[name] * across).sum()) < 1e-6
    # the loss is that of the scores, the state that of a step at a time
    states, step = [], h
    for t in range(4):
        a = weights["E"][ids[t]] @ weights["Wx"] + weights["b"]
        g, sigmoid = step @ weights["Wh"], lambda x: 1 / (1 + np.exp(-x))
        z, r = (sigmoid(a[:, k : k + gru.HIDDEN] + g[:, k : k + gru.HIDDEN]) for k in (0, gru.HIDDEN))
        n = np.tanh(a[:, 2 * gru.HIDDEN :] + r * g[:, 2 * gru.HIDDEN :])
        step = (1 - z) * n + z * step
        states.append(step)
    assert np.allclose(last, step)
    flat, what, seen = np.concatenate(states), ids[1:].reshape(-1), mask.reshape(-1)
    logs = gru.log_probabilities(weights, flat, what)
    assert abs(results[0][0] + (logs * seen).sum() / seen.sum()) < 1e-9


def test_large_logits_are_shifted():
    x = np.array([[200.0, 0.0, -200.0]], np.float32)
    share = np.array([0.5], np.float32)
    weights = np.full((1, gru.HIDDEN), 10.0, np.float32)
    assert not gru._bounded(weights, np.zeros(1, np.float32))
    assert gru._bounded(weights / 10, np.zeros(1, np.float32))
    assert gru._log_at(x, np.array([1]), False, share) == -200
    assert np.allclose(x, [[0.5, -0.5, 0]])


def test_a_window_takes_each_exponential_once(monkeypatch):
    random, taken, exp = np.random.default_rng(0), [], np.exp
    weights = gru.initial(np.ones(gru.HEAD), np.ones(gru.TAILS))
    ids = random.integers(0, gru.HEAD + gru.TAILS, (17, 64))
    monkeypatch.setattr(np, "exp", lambda x, **k: taken.append(np.size(x)) or exp(x, **k))
    gru.gradients(weights, ids[:-1], ids[1:], np.ones((16, 64), np.float32), np.zeros((64, gru.HIDDEN)))
    heads = int((ids[1:] < gru.HEAD).sum())
    assert sum(taken) == 16 * 64 * (gru.CLASSES + gru.TAILS) + heads * gru.CLASS_WORDS
    assert len(taken) == 2  # however many classes occur


def test_most_frequent_words(spark, monkeypatch):
    monkeypatch.setattr(gru, "HEAD", 2)
    counted = spark.createDataFrame(
        [(bytearray(w), n) for w, n in ((b"a", 9), (b"b", 5), (b"\xff", 5), (b"c", 5), (b"d", 1), (b"", 1))],
        "word binary, n long",
    ).repartition(4)
    words = lambda: [bytes(r.word) for r in gru._most_frequent(counted)]
    for most, want in (
        (9, [b"a", b"b", b"c", b"\xff", b"", b"d"]),
        (5, [b"a", b"b", b"c", b"\xff"]),  # one more would part the words of count 1
        (3, [b"a", b"b"]),  # the head words
    ):
        monkeypatch.setattr(gru, "FREQUENT", most)
        assert words() == want
    assert gru._most_frequent(counted.limit(0)) == []


def test_weights_of_tasks_are_averaged_by_tokens(spark, monkeypatch):
    def lengths(w, runs, rate):  # the mean length of a token's run
        seen = sum(len(r) - 1 for r in runs)
        mean = sum(len(r) * (len(r) - 1) for r in runs) / seen
        return {k: np.full_like(x, mean) for k, x in w.items()}, seen

    monkeypatch.setattr(gru, "train", lengths)
    weights = gru.initial(np.ones(gru.HEAD), np.ones(gru.TAILS))
    sizes = [3, 5, 9, 17]
    rows = [(bytearray(np.arange(n).astype("<u2").tobytes()),) for n in sizes]
    runs = spark.createDataFrame(rows, "run binary").repartition(1)
    out = gru._round(runs, 4, weights, 0.1)
    assert {k: v.shape for k, v in out.items()} == {k: v.shape for k, v in weights.items()}
    want = sum(n * (n - 1) for n in sizes) / sum(n - 1 for n in sizes)
    assert all(v.dtype == np.float32 and np.allclose(v, want) for v in out.values())


def test_training_takes_every_token(spark, awkward, monkeypatch):
    seen = []
    monkeypatch.setattr(gru, "_round", lambda runs, tasks, w, rate: seen.append(runs.collect()) or w)
    counts = gru.count_words(awkward).cache()
    model = gru.fit(awkward, counts)
    assert len(seen) == gru.ROUNDS
    assert sum(len(r.run) // 2 - 1 for r in seen[0]) == sum(r.n for r in seen[0]) == model.total
    model.tables()
    found = Counter(x for r in seen[0] for x in np.frombuffer(r.run, "<u2")[1:].tolist())
    want = Counter()
    for r in awkward.collect():
        want.update(model.look_up(gru.tokens((r.text or "").encode()))[1].tolist())
    assert found == want


def test_texts_are_looked_up_once(spark, awkward, monkeypatch):
    seen, inner = [], type(awkward).mapInPandas

    def watched(df, *args, **kwargs):
        seen.append(df.columns)
        return inner(df, *args, **kwargs)

    monkeypatch.setattr(type(awkward), "mapInPandas", watched)
    assert gru.scores(awkward).count() == awkward.count()
    assert sum("text" in columns for columns in seen) == 2  # to count words, to look them up


def test_runs_overlap_by_one_symbol(spark):
    longest = gru.RUN_WINDOWS * gru.WINDOW
    lists = [np.arange(n + 1) % 1000 for n in (1, longest - 1, longest, longest + 1, 2 * longest + 500)]
    rows = [(len(x) - 1, bytearray(x.astype("<u2").tobytes())) for x in lists]
    runs = gru._runs(spark.createDataFrame(rows, "n_tokens long, symbols binary")).collect()
    want = [x[at : at + longest + 1].tolist() for x in lists for at in range(0, len(x) - 1, longest)]
    got = [np.frombuffer(r.run, "<u2").tolist() for r in runs]
    assert sorted(got) == sorted(want) and [r.n for r in runs] == [len(x) - 1 for x in got]


def test_a_window_takes_little_memory():
    random = np.random.default_rng(0)
    weights = gru.initial(np.ones(gru.HEAD), np.ones(gru.TAILS))
    ids = random.integers(0, gru.HEAD + gru.TAILS, (gru.WINDOW + 1, gru.BATCH))
    mask, h = np.ones((gru.WINDOW, gru.BATCH), np.float32), np.zeros((gru.BATCH, gru.HIDDEN), np.float32)
    tracemalloc.start()
    gru.gradients(weights, ids[:-1], ids[1:], mask, h)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 5e6  # beyond a core's cache a step waits for its arrays


def test_runs_of_any_length_are_trained_whole(monkeypatch):
    monkeypatch.setattr(gru, "BATCH", 2)
    random, inner, seen = np.random.default_rng(0), gru.gradients, []

    def watched(w, before, symbols, mask, h):
        out = inner(w, before, symbols, mask, h)
        seen.append((before, symbols, mask, h.copy(), out[2].copy()))
        return out

    monkeypatch.setattr(gru, "gradients", watched)
    runs = [random.integers(0, gru.HEAD, n) for n in (2, 100, 17, 18, 40)]
    weights = gru.initial(np.ones(gru.HEAD), np.ones(gru.TAILS))
    assert gru.train(weights, runs)[1] == sum(len(r) - 1 for r in runs)
    pairs = lambda x, y: list(zip(x.tolist(), y.tolist()))
    got = Counter(p for b, s, m, _, _ in seen for p in pairs(b[m > 0], s[m > 0]))
    assert got == Counter(p for r in runs for p in pairs(r[:-1], r[1:]))
    assert not seen[0][3].any() and seen[1][3][1].any()  # the long run goes on, the next begins
    assert np.array_equal(seen[1][3][1], seen[0][4][1]) and not seen[1][3][0].any()


def test_scores_against_counts(spark, awkward, empty):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = gru.scores(docs).join(docs.select("doc_id", "text"), "doc_id").collect()
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    count = Counter(w for r in got if not held(r.doc_id) for w in gru.tokens(r.text.encode()))
    total, size = sum(count.values()), len(count)
    for r in got:
        words = gru.tokens(r.text.encode())
        assert (r.n_tokens, r.n_known) == (len(words), sum(w in count for w in words))
        want = sum(np.log10((count[w] + 1) / (total + size + 1)) for w in words)
        assert abs(r.base_score - want) < 1e-6 * abs(want) and r.train_tokens == total
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    odd = {r.doc_id: r for r in gru.scores(awkward).collect()}
    assert odd[0].n_tokens == 1 and odd[0].score <= 0
    assert gru.scores(empty).count() == 0


PAGE = """<html><head><title>T</title><script>var t="<p>no</p>";</script></head><body>
<nav><a href=x>Menu</a></nav><div class="cookie-notice">We use cookies</div><aside>Side</aside>
<article><h1>Head &amp; more</h1><p>First <b>bold<br>text &copy; that goes on for a while and on.<p>Second
 paragraph with <a href=y>a link</a> inside of it, long enough to count.</p><div class="ad">Buy!</div>
<section class="comments"><p>I liked it</p></section></article><form><input><p>Send</p></form>
<footer>The end</footer></body></html>"""


def test_main_text(spark):
    want = (
        "Head & more\n\nFirst bold text © that goes on for a while and on.\n\n"
        "Second paragraph with a link inside of it, long enough to count."
    )
    rows = [(1, "u", PAGE, 1), (None, None, None, 2), (3, "u", "", 3), (4, "u", "<p>x", 4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = {r.page_id: r for r in html.extract(pages).collect()}
    assert got[1].text == want and got[1].n_chars == len(want)
    assert got[None].text == got[3].text == "" and got[4].text == "x"
    assert html.extract(pages.limit(0)).count() == 0


def _p(letter, n=1):
    return "".join(f"<p>{letter * 300}</p>" for _ in range(n))


def test_main_text_of_several_parts():
    page = f"<body><div><section>{_p('a', 3)}</section><section>{_p('b', 2)}</section></div></body>"
    assert html.main_text(page).split("\n\n") == ["a" * 300] * 3 + ["b" * 300] * 2
    page = f"<div><section>{_p('b', 2)}</section><section>{_p('a', 3)}</section></div>"
    assert html.main_text(page).split("\n\n") == ["b" * 300] * 2 + ["a" * 300] * 3
    page = f"<main><article>{_p('a', 3)}</article><article>{_p('b', 2)}</article></main>"
    assert html.main_text(page).split("\n\n") == ["a" * 300] * 3 + ["b" * 300] * 2
    links = "<ul>" + "<li><a href=x>link</a></li>" * 9 + "</ul>"
    page = f"<div><div><section>{_p('a', 3)}</section>{links}</div><section>{_p('b', 2)}</section></div>"
    assert html.main_text(page).split("\n\n") == ["a" * 300] * 3 + ["b" * 300] * 2
    deep = "<div>" * 3000 + _p("a", 2) + "</div>" * 3000
    assert html.main_text(deep).split("\n\n") == ["a" * 300] * 2


def test_archives_round_trip(spark, folder):
    big = "<p>é</p>" * 400
    rows = [(1, "http://a/ü b", big), (5, "u", big), (5, "u", big), (None, None, big), (7, "u", None), (8, "u", "x"), (9, "u", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.page_archive(pages).collect()
    digest = hashlib.sha1(big.encode()).hexdigest()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in got if r.payload_digest == digest) == [
        (0, "revisit", 5), (1, "revisit", 5), (5, "response", None), (5, "response", None),
    ]
    assert all(r.payload_bytes == len(big.encode()) for r in got if r.payload_digest == digest)
    assert sum(r.record_type == "response" for r in got) == 5 and len(got) == 7
    assert warc.page_archive(pages.limit(0)).count() == 0


def test_one_record_is_read_by_seeking(folder):
    bundle = warc.Bundle(folder)
    places = []
    for i in range(5):
        data = warc.record(i, None, b"%d" % i * 400_000, "d", None, False)
        places.append((*bundle.add(data), len(data)))
    bundle.close()
    file, frames = warc.open_bundle(folder, bundle.name)
    assert len(frames) > 1
    number, start, size = places[3]
    assert warc.parse(warc.frame(file, frames, number)[start : start + size])[2] == b"3" * 400_000


def test_nearest_neighbours(spark):
    random = np.random.default_rng(0)
    v = random.normal(size=(3000, 16)).round(3)
    rows = [(i, v[i].tolist()) for i in range(3000)]
    rows += [(3001, None), (3020, [0.0] * 16), (3040, [float("nan")] + [1.0] * 15), (40, v[40].tolist())]
    got = permutation.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    by = {}
    for r in got.collect():
        by.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(by) == set(range(0, 3000, 20))
    hits = 0
    for q, found in by.items():
        s = v @ v[q]
        s[q] = -np.inf
        hits += len(set(np.argsort(-s)[:20]) & {x for x, _ in found.values()})
        assert sorted(found) == list(range(1, 21))
        assert all(abs(score - s[x]) < 1e-9 for x, score in found.values())
    assert hits / (20 * len(by)) >= 0.9
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>")
    assert permutation.neighbours(few).count() == 2
    assert permutation.neighbours(few.limit(0)).count() == 0


def test_pipeline_stages_keep_the_columns(spark):
    import corpus_pipeline

    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_duplicates", "decontamination", "personal_data", "packing"]
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    given = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        given = stage(spark, given, sf_dir)
        assert given.columns == docs.columns
        given = corpus_pipeline.stored(given, "stage")
    assert 0 < given.count() <= docs.count()
