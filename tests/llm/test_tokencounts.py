"""Token counts against the tokenizer itself."""

import random
import sys

import pytest
from tokenizers import Tokenizer

from millrace.llm import tokencounts

KIND = "doc_id long, text string, lang string, row long, key string, n long, keys long, special string"
HOSTILE = [
    None, "", " ", "   ", "\n\n", "a", "One", "One", "a  b", "a \n b", "a\n b", " \n\n  a", "a   b  ",
    "it's we'll I'm they've you'd we're x''s 's 'S", "don't  'll", "a\tb\t c", "x y   z", "é à Ünï",
    "мир и война 1999", "日本語 テキスト", "🙂🙂 a🙂", "१२३ ½ ²³¹ ª º µ × ÷", "é combining", "﻿bom",
    "<|endoftext|>", "a <|endoftext|> b", "a  <|endoftext|>  b<|endoftext|><|endoftext|>c", "<|endoftext", "\x1c!\x1d a\x1e",
    "a\x85b\x0bc\x0c d", "w" * 30_000, "=" * 5_000 + " " + "=" * 5_000, "ab " * 200_000, " " * 10_000 + "x", "1234567890" * 50,
    " line  para​ zero", "Ǆ ʰ ͅ Ⅷ ⓐ",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokencounts.tokenizer_path())


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "l", 1, "k", 2, 3, "s") for i, t in zip(ids, texts)], KIND)


def expected(tokenizer, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    out = []
    for i, t in zip(ids, texts):
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        out.append((i, len((t or "").encode()), n, n > tokencounts.LIMIT))
    return out


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()]


def by_key(found):
    return sorted(found, key=repr)


@pytest.mark.parametrize("frequent", [0, 10, 1 << 18])
def test_counts_are_the_tokenizers(spark, tokenizer, frequent):
    """With no, few and all pre-tokens in the broadcast list."""
    texts = HOSTILE + ["again and again"] * 4
    ids = [*range(len(HOSTILE)), 7, 7, None, None]
    got = rows(tokencounts.count_tokens(frame(spark, texts, ids), frequent=frequent))
    assert by_key(got) == by_key(expected(tokenizer, texts, ids))


def test_random_texts(spark, tokenizer):
    rng = random.Random(3)
    letters = list("aAzé'’ \n\t.,!1²½€я日🙂 ́") + ["  ", "'s", "'ll", "<|endoftext|>", " word"]
    texts = ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(3000)]
    assert by_key(rows(tokencounts.count_tokens(frame(spark, texts)))) == by_key(expected(tokenizer, texts))


def test_cut_stretches_give_the_same_pieces(monkeypatch, tokenizer):
    text = "".join(random.Random(5).choices(["a", " ", "b's", "\n", ". ", "12"], k=5000))
    cut = tokencounts._pre_tokens(tokencounts.tokenizer_path())
    want = [text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]
    for size in (1, 7, 100):
        monkeypatch.setattr(tokencounts, "STRETCH", size)
        assert [p for pieces in cut.of(text) for p in pieces] == want


def test_written_classes_are_the_tokenizers(tokenizer):
    """Every ASCII and Latin-1 character between the same neighbours."""
    cut = tokencounts._pre_tokens(tokencounts.tokenizer_path())
    for code in range(256):
        for text in (f"a{chr(code)}b", f" {chr(code)} 1", f"{chr(code)}'s!{chr(code)}"):
            want = [text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]
            assert [p for pieces in cut.of(text) for p in pieces] == want, code


def test_long_pre_tokens_are_keyed_by_digest(spark):
    words = tokencounts.vocabulary(frame(spark, ["x" * 500, "x" * 500 + " x"])).collect()
    assert {r.key: r.n for r in words if r.key.startswith("#sha256:")}.popitem()[1] == 2
    assert max(len(r.key) for r in words) <= 8 + 64


def test_bytes_that_are_no_utf8_and_an_empty_table(spark, tokenizer):
    broken = spark.sql("SELECT 1L AS doc_id, cast(X'61FF62' AS string) AS text")
    n = len(tokenizer.encode("a�b", add_special_tokens=False).ids)
    assert rows(tokencounts.count_tokens(broken)) == [(1, 3, n, False)]
    none = tokencounts.count_tokens(frame(spark, []))
    assert none.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and none.count() == 0


def test_the_query_reads_whole_tables(spark, tokenizer):
    sys.path.insert(0, ".")
    import __spark_entry__ as entry

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    want = expected(tokenizer, [r.text for r in docs], [r.doc_id for r in docs])
    assert by_key(rows(entry.queries()["op12_pretoken_counts"](spark, sf_dir))) == by_key(want)
