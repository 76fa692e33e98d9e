"""Token counts of whole texts without token ids.

A tokenizer that never joins pieces across pre-tokens gives a text as many ids as its
pre-tokens have pieces. So every distinct pre-token of the corpus is split into pieces once,
and a document's count is the sum over its pre-token frequencies, by a join:

* one pass over the texts gathers the vocabulary of pre-tokens with their occurrences,
  combined in every task before the shuffle;
* each distinct pre-token's pieces are counted once, in a stored table;
* a second pass turns every text into pre-token frequencies and joins them. The most frequent
  pre-tokens, a list bounded in rows and bytes, are broadcast, so that no frequent key is
  shuffled; a pre-token beyond the list has few occurrences by the same bound and is joined by
  a shuffle. Both parts run at every size.

No ids are made, and no text moves. A pre-token of more than ``LONGEST_KEY`` bytes stands in
the joins as its SHA-256, so a key is short whatever the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
#: Pre-tokens of more bytes are keyed by their digest.
LONGEST_KEY = 64
#: Most rows of the broadcast list of frequent pre-tokens.
FREQUENT = 1 << 18
#: Sizes of buffers in a task; they change no result.
CACHED_UNITS, LONGEST_CACHED, STRETCH, PENDING, ROWS = 400_000, 64, 1 << 19, 1 << 19, 10_000


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return dict(zip(plain + rest, [*map(chr, plain), *(chr(256 + i) for i in range(len(rest)))]))


class PreTokens:
    """Pre-tokens of texts, as a byte-level tokenizer cuts them.

    Stretches of ASCII and Latin-1 go through the tokenizer's published pattern with its classes
    written out; any other is cut in units, white space and the word after it, which the
    tokenizer's own pre-tokenizer cuts and which are remembered.
    """

    #: The letters and digits of Latin-1 (fixed values).
    LETTERS, DIGITS = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾"
    #: The tokenizer's own pattern (fixed value) for them.
    PIECES = re.compile(
        rf" ?[{LETTERS}]+| ?[{DIGITS}]+|'(?:[stmd]|re|ve|ll)"
        rf"| ?[^\s{LETTERS}{DIGITS}]+|\s+(?!\S)|\s+"
    )
    PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-\xff]*")
    UNITS = re.compile(r"\s*\S+|\s+")
    #: White space to Python, but not to the tokenizer.
    SEPARATORS = re.compile("[\x1c-\x1f]")
    #: A text may be cut here: what precedes a space between two non-spaces changes nothing.
    SAFE = re.compile(r"(?<=\S) (?=\S)")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        added = whole.get_added_tokens_decoder().values()
        if whole.normalizer or any(t.lstrip or t.rstrip or t.single_word for t in added):
            raise ValueError(f"{path}: not a plain byte-level tokenizer")
        self.special = re.compile("|".join(re.escape(t.content) for t in added) or r"(?!)")
        self.model, self.cut = whole.model, whole.pre_tokenizer.pre_tokenize_str
        self.letters = _byte_letters()
        self.units: dict[str, list[str]] = {}

    def _library(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.cut(text)]

    def _unit(self, unit: str) -> list[str]:
        found = self.units.get(unit)
        if found is None:
            found = self._library(unit)
            if len(unit) <= LONGEST_CACHED:
                if len(self.units) > CACHED_UNITS:
                    self.units.clear()
                self.units[unit] = found
        return found

    def _stretch(self, text: str) -> list[str]:
        if self.PLAIN.fullmatch(text):
            return self.PIECES.findall(text)
        if self.SEPARATORS.search(text):
            return self._library(text)
        return [piece for unit in self.UNITS.findall(text) for piece in self._unit(unit)]

    def _section(self, text: str) -> Iterator[list[str]]:
        start = 0
        while start < len(text):
            cut = self.SAFE.search(text, start + STRETCH) if len(text) - start > STRETCH else None
            end = cut.start() if cut else len(text)
            yield self._stretch(text[start:end])
            start = end

    def specials(self, text: str) -> int:
        return len(self.special.findall(text))

    def of(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of a text outside its special tokens, in lists of bounded length."""
        for section in self.special.split(text):
            yield from self._section(section)

    def pieces(self, piece: str) -> int:
        """Into how many ids the model splits a pre-token."""
        return len(self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters)))


_loaded: dict[str, PreTokens] = {}


def _pre_tokens(path: str) -> PreTokens:
    if path not in _loaded:
        _loaded[path] = PreTokens(path)
    return _loaded[path]


def _keyed(pieces: pa.Array) -> tuple[pa.Array, pa.Array]:
    """What stands for pre-tokens in joins, and the long ones themselves. A digest mixes marks,
    letters and digits, which no pre-token does."""
    long = pc.greater(pc.binary_length(pieces), LONGEST_KEY)
    if not pc.any(long).as_py():
        return pieces, pa.nulls(len(pieces), pa.string())
    digests = pa.array(
        ["#sha256:" + hashlib.sha256(p.encode()).hexdigest() for p in pieces.filter(long).to_pylist()],
        pa.string(),
    )
    keys = pc.replace_with_mask(pieces, long, digests)
    return keys, pc.if_else(long, pieces, pa.scalar(None, pa.string()))


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [(t or b"").decode("utf-8", "replace") for t in batch.column("text").to_pylist()]


def vocabulary(documents: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``(key, n, pieces)``: every distinct pre-token of the corpus, its occurrences, and the
    number of ids it is split into. Stored."""
    path = tokenizer or tokenizer_path()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, pending = _pre_tokens(path), []
        for batch in batches:
            for text in _texts(batch):
                for pieces in tokens.of(text):
                    pending += pieces
                    if len(pending) > PENDING:
                        yield counted(pending)
        yield counted(pending)

    def counted(pending: list[str]) -> pa.RecordBatch:
        found = pa.array(pending, pa.string()).value_counts()
        pending.clear()
        return pa.RecordBatch.from_arrays(
            [*_keyed(found.field("values")), found.field("counts")], ["key", "long", "n"]
        )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _pre_tokens(path)
        for batch in batches:
            keys, whole = batch.column("key"), batch.column("long").to_pylist()
            counts = [tokens.pieces(w or k) for k, w in zip(keys.to_pylist(), whole)]
            yield pa.RecordBatch.from_arrays(
                [keys, batch.column("n"), pa.array(counts, pa.int64())], ["key", "n", "pieces"]
            )

    gathered = documents.select(F.col("text").cast("binary").alias("text")).mapInArrow(
        gather, "key string, long string, n long"
    )
    distinct = gathered.groupBy("key", "long").agg(F.sum("n").alias("n"))
    return stored(distinct.mapInArrow(split, "key string, n long, pieces long"), "pre-tokens")


def _rank(n):
    """Occurrences on a scale of eight steps for each doubling, 512 at most."""
    return F.floor(F.log2(n.cast("double")) * 8).cast("int")


def frequent_from(words: DataFrame, most: int = FREQUENT) -> int:
    """The least rank of occurrences at which no more than ``most`` pre-tokens remain."""
    left, least = most, 1 << 10
    steps = words.groupBy(_rank(F.col("n")).alias("rank")).count().collect()  # 512 rows at most
    for step in sorted(steps, reverse=True):
        left -= step["count"]
        if left < 0:
            break
        least = step["rank"]
    return least


def frequencies(documents: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``(row, doc_id, n_bytes, special, keys, counts)``: pre-token frequencies of every text,
    in lists of bounded length. The first list of a document carries the columns before."""
    path = tokenizer or tokenizer_path()
    kind = pa.schema(
        [("row", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("special", pa.int64()),
         ("keys", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _pre_tokens(path)
        heads, pending, sizes = [], [], []

        def listed() -> pa.RecordBatch:
            """The pending pre-tokens as one list of frequencies a head."""
            coded = pa.array(pending, pa.string()).dictionary_encode()
            keys, _ = _keyed(coded.dictionary)
            owner = np.repeat(np.arange(len(heads)), sizes)
            pairs, counts = np.unique(
                owner * max(len(keys), 1) + coded.indices.to_numpy(), return_counts=True
            )
            ends = np.searchsorted(pairs, np.arange(len(heads) + 1) * max(len(keys), 1))
            ends = pa.array(ends, pa.int32())
            named = keys.take(pa.array(pairs % max(len(keys), 1)))
            made = pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*heads)]
                + [pa.ListArray.from_arrays(ends, x) for x in (named, pa.array(counts, pa.int64()))],
                schema=kind,
            )
            heads.clear(), pending.clear(), sizes.clear()
            return made

        for batch in batches:
            plain = (batch.column(c).to_pylist() for c in ("row", "doc_id", "n_bytes"))
            for row, doc_id, n_bytes, text in zip(*plain, _texts(batch)):
                head = (row, doc_id, n_bytes, tokens.specials(text))
                for pieces in chain(tokens.of(text), [[]]):  # an empty text has a head as well
                    if pieces or head:
                        heads.append(head or (row, None, None, None))
                        pending += pieces
                        sizes.append(len(pieces))
                        head = None
                    if len(pending) > PENDING or len(heads) > ROWS:
                        yield listed()
        if heads:
            yield listed()

    rows = documents.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.col("text").cast("binary").alias("text"),
    )
    return rows.mapInArrow(
        cut, "row long, doc_id long, n_bytes long, special long, keys array<string>, counts array<long>"
    )


def count_tokens(
    documents: DataFrame,
    tokenizer: str | None = None,
    limit: int = LIMIT,
    frequent: int = FREQUENT,
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row of ``documents``.

    A null or empty text has no bytes and no tokens; bytes that are no UTF-8 count as U+FFFD.
    Null doc_ids and repeated rows are counted row by row. An empty table gives no rows; columns
    other than doc_id and text are not read. Special strings inside a text are one token each,
    as the tokenizer takes them by default.
    """
    words = vocabulary(documents, tokenizer)
    least = frequent_from(words, frequent)
    common = words.where(_rank(F.col("n")) >= least).select("key", F.col("pieces").alias("common"))
    rare = words.where(_rank(F.col("n")) < least).select("key", "pieces")

    # one row a document holds its columns and its special tokens, under a key of its own
    own = F.concat(F.lit("\0"), F.col("row").cast("string"))
    listed = F.arrays_zip("keys", F.col("counts").alias("n"))
    head = F.when(F.col("special").isNotNull(), F.array(F.struct(F.lit(None).cast("string").alias("keys"), F.col("special").alias("n"))))
    items = F.concat(F.coalesce(head, F.array().cast("array<struct<keys:string,n:bigint>>")), listed)
    posted = (
        frequencies(documents, tokenizer)
        .select("row", "doc_id", "n_bytes", F.explode(items).alias("item"))
        .select("row", F.col("item.keys").alias("key"), F.col("item.n").alias("n"), *(
            F.when(F.col("item.keys").isNull(), F.col(c)).alias(c) for c in ("doc_id", "n_bytes")
        ))
    )
    is_known = F.col("key").isNull() | F.col("common").isNotNull()
    summed = (
        posted.join(F.broadcast(common), "key", "left")
        .groupBy("row", F.when(is_known, own).otherwise(F.col("key")).alias("key"))
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("n_bytes").alias("n_bytes"),
            F.sum(F.col("n") * F.coalesce("common", F.lit(1))).alias("n"),
        )
    )
    pieces = F.when(F.col("key").startswith("\0"), F.lit(1)).otherwise(
        F.coalesce("pieces", F.raise_error(F.lit("a pre-token is not in the vocabulary")))
    )
    return (
        summed.join(rare, "key", "left")
        .groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("n_bytes").alias("n_bytes"),
            F.sum(F.col("n") * pieces).alias("n_tokens"),
        )
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
