"""Packing of token pieces into sequences by bounded-space online best fit.

Documents become token ids in one pass over the texts; only longer ones are cut. The pieces
(numbers, no texts) are dealt evenly over lanes, and each lane packs its pieces in one
stream: a fixed number of bins is open, a bitset tells which amounts of free space occur
among them, a piece goes to the bin with the least free space that takes it, and where a new
bin is needed and all are open, the fullest one closes. Within a lane the pieces arrive by
falling length, so that the small ones fill what the large ones leave. Memory per task is
the open bins. Every lane leaves one poorly filled sequence at most, of about 4,000.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

TOKENIZER = "word_bpe_49k.json"
SEQUENCE = 4096
END = 1
OPEN_BINS = 8192
LANE_PIECES = 16_384
#: Token ids of so many words are kept per Python worker; the cache changes no result.
CACHED_WORDS = 400_000


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# --- tokens ------------------------------------------------------------------


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return dict(zip(plain + rest, [*map(chr, plain), *(chr(256 + i) for i in range(len(rest)))]))


class WordTokens:
    """Token ids of texts, as the tokenizer gives them, remembered word by word.

    The tokenizer never joins anything across white space, so a text's ids are those of its
    space-separated words. A word of ASCII and Latin-1 letters is split and looked up by the
    tokenizer's own model; any other, and one that holds a special token, goes through the
    whole tokenizer.
    """

    #: The tokenizer's own pattern (fixed value).
    PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    PLAIN = regex.compile(r"[\x21-\x7e\xc0-\xff]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        #: Matches what the tokenizer takes for a special token anywhere in a word.
        self.special = regex.compile("|".join(map(regex.escape, added)) or r"(?!)")
        self.model = self.whole.model
        self.letters = _byte_letters()
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        written = piece.encode().decode("latin-1").translate(self.letters)
        ids = np.array([t.id for t in self.model.tokenize(written)], "<u4").tobytes()
        self.pieces[piece] = ids
        return ids

    def _word(self, word: str) -> bytes:
        plain = self.PLAIN.fullmatch(word) and not self.special.search(word)
        if plain and unicodedata.is_normalized("NFC", word):
            get = self.pieces.get
            found = [get(p) or self._piece(p) for p in self.PIECES.findall(word.lower())]
            ids = b"".join(found)
        else:
            coded = self.whole.encode(word, add_special_tokens=False).ids
            ids = np.array(coded, "<u4").tobytes()
        self.words[word] = ids
        return ids

    def of(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
            self.pieces.clear()
        words = text.replace("\n", " ").split(" ")
        try:
            return b"".join(map(self.words.__getitem__, words))
        except KeyError:
            get = self.words.get
            return b"".join([w if (w := get(x)) is not None else self._word(x) for x in words])


_tokens: dict[str, WordTokens] = {}


def _tokens_of(path: str) -> WordTokens:
    if path not in _tokens:
        _tokens[path] = WordTokens(path)
    return _tokens[path]


def pieces(
    documents: DataFrame,
    tokenizer: str | None = None,
    longest: int = SEQUENCE,
    with_ids: bool = False,
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of every document, and ``ids`` if wanted.

    A null text counts as empty; every document ends with the id 1, so each has a piece.
    """
    path = tokenizer or tokenizer_path()
    end = np.array([END], "<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = _tokens_of(path)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = tokens.of(text or "") + end
                for start in range(0, len(ids), 4 * longest):
                    part = ids[start : start + 4 * longest]
                    n = start // 4
                    row = (doc_id, n // longest, n, len(part) // 4, zlib.crc32(part))
                    out.append((*row, np.frombuffer(part, "<u4")) if with_ids else row)
            names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
            made = pd.DataFrame(out, columns=names)
            yield made.astype({"doc_id": "Int64"})

    kind = "doc_id long, piece int, start long, length long, ids_crc32 long"
    rows = documents.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInPandas(cut, kind + ", ids array<long>" * with_ids)


# --- bins --------------------------------------------------------------------


class BestFit:
    """Bounded-space best fit. ``put`` gives the bin and the offset for a piece."""

    def __init__(self, capacity: int = SEQUENCE, open_bins: int = OPEN_BINS):
        self.capacity, self.most = capacity, open_bins
        self.free: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by free space
        self.bits = 0  # bit f is set while some open bin has f free
        self.open = self.bins = 0

    def _take(self, space: int) -> int:
        bins = self.free[space]
        taken = bins.pop()
        if not bins:
            self.bits ^= 1 << space
        return taken

    def put(self, length: int) -> tuple[int, int]:
        fitting = self.bits >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            into = self._take(space)
        else:
            if self.open == self.most:  # the fullest closes
                self._take((self.bits & -self.bits).bit_length() - 1)
                self.open -= 1
            into, space = self.bins, self.capacity
            self.bins += 1
            self.open += 1
        left = space - length
        if left:
            self.free[left].append(into)
            self.bits |= 1 << left
        else:
            self.open -= 1
        return into, self.capacity - space


def packed(
    stored_pieces: DataFrame,
    capacity: int = SEQUENCE,
    open_bins: int = OPEN_BINS,
    lane_pieces: int = LANE_PIECES,
) -> DataFrame:
    """A stored table of pieces (``length`` of 1 to ``capacity``) with ``sequence_id`` and
    ``offset``. Pieces are dealt to lanes by their place in the stored table, so equal pieces
    are spread like all others."""
    rows = stored(
        stored_pieces.withColumn("place", F.monotonically_increasing_id()), "placed-pieces"
    )
    lanes = max(1, -(-rows.count() // lane_pieces))
    kept = [c for c in rows.columns if c != "place"]

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lane, bins = None, None
        for batch in batches:
            ids, offsets = [], []
            for of, length in zip(batch["lane"], batch["length"]):
                if of != lane:
                    lane, bins = of, BestFit(capacity, open_bins)
                into, offset = bins.put(length)
                ids.append(of << 40 | into)
                offsets.append(offset)
            yield batch[kept].assign(sequence_id=ids, offset=offsets)

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "place")
    return (
        rows.withColumn("lane", F.pmod(F.xxhash64("place"), F.lit(lanes)))
        .repartition(lanes, "lane")
        .sortWithinPartitions("lane", F.desc("length"), "place")
        .mapInPandas(pack, kind + ", sequence_id long, offset long")
    )


def pack_documents(
    documents: DataFrame,
    tokenizer: str | None = None,
    capacity: int = SEQUENCE,
    open_bins: int = OPEN_BINS,
    lane_pieces: int = LANE_PIECES,
    with_ids: bool = False,
) -> DataFrame:
    """All documents as pieces in sequences of at most ``capacity`` tokens.

    Reads ``doc_id`` and ``text`` only; null doc_ids and repeated rows are packed like any
    other, a null or empty text is the single end token, an empty table gives no rows.
    ``with_ids`` adds each piece's token ids: ordered by ``sequence_id, offset`` they are the
    training sequences.
    """
    cut = stored(pieces(documents, tokenizer, capacity, with_ids), "pieces")
    return packed(cut, capacity, open_bins, lane_pieces)
