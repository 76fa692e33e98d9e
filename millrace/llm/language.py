"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram's vector binds its letters, each
rotated by its place, by multiplication; a text's vector bundles its n-grams by addition, and
a language's prototype bundles the texts that are labelled with it. A text gets the language
whose prototype has the largest cosine with it. Texts are counted n-gram by n-gram first, so
that a vector is one small matrix product; prototypes are summed per task and then by Spark.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 512
GRAM = 3
UNDETERMINED = "und"
#: Vectors of so many n-grams are kept per Python worker; the cache changes no result.
CACHED_GRAMS = 60_000
SPACE = 0x20
BITS = 21  # of a code point


def _letters() -> np.ndarray:
    """For every code point its lower-case letter, or a space for what is no letter."""
    global _table
    if _table is None:
        table = np.full(0x110000, SPACE, np.int32)
        for code in range(0x110000):
            letter = chr(code)
            if letter.isalpha():
                low = letter.lower()
                table[code] = ord(low) if len(low) == 1 else code
        _table = table
    return _table


_table: np.ndarray | None = None


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text as packed code points, and their counts. Runs of anything
    but letters count as one space; a text starts and ends with one."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    low = _letters()[codes]
    keep = low != SPACE
    if not keep.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    low = np.concatenate(([SPACE], low, [SPACE]))
    keep = np.concatenate(([True], keep, [False]))
    keep[1:] |= keep[:-1] & (low[:-1] != SPACE)  # the first of a run of spaces
    low = low[keep].astype(np.int64)
    low = low[1:] if len(low) > 1 and low[0] == low[1] == SPACE else low
    packed = low[: len(low) - GRAM + 1].copy()
    for k in range(1, GRAM):
        packed = packed << BITS | low[k : len(low) - GRAM + 1 + k]
    return np.unique(packed, return_counts=True)


class Space:
    """Vectors of letters and n-grams."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = 0):
        self.dimensions, self.seed = dimensions, seed
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.vectors = np.empty((1024, dimensions), np.int8)

    def _letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            random = np.random.Generator(np.random.PCG64([self.seed, code]))
            self.letters[code] = random.integers(0, 2, self.dimensions, np.int8) * 2 - 1
        return self.letters[code]

    def _add(self, gram: int) -> int:
        vector = np.ones(self.dimensions, np.int8)
        for place in range(GRAM):
            code = gram >> BITS * place & (1 << BITS) - 1
            vector = vector * np.roll(self._letter(code), place)
        at = len(self.rows)
        if at == len(self.vectors):
            self.vectors = np.concatenate([self.vectors, np.empty_like(self.vectors)])
        self.vectors[at] = vector
        self.rows[gram] = at
        return at

    def bundle(self, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The vector of a text with these n-grams."""
        if len(self.rows) > CACHED_GRAMS:
            self.rows.clear()
        out = np.zeros(self.dimensions, np.float32)
        for part in range(0, len(found), 16_384):
            get = self.rows.get
            some = found[part : part + 16_384].tolist()
            at = [r if (r := get(g)) is not None else self._add(g) for g in some]
            out += counts[part : part + 16_384].astype(np.float32) @ self.vectors[at].astype(
                np.float32
            )
        return out


_spaces: dict[tuple[int, int], Space] = {}


def _space(dimensions: int, seed: int) -> Space:
    return _spaces.setdefault((dimensions, seed), Space(dimensions, seed))


def prototypes(
    labelled: DataFrame, dimensions: int = DIMENSIONS, seed: int = 0
) -> dict[str, np.ndarray]:
    """One vector per language from ``labelled(text, lang)``; rows without either are left
    out. What reaches the driver is ``dimensions`` numbers per language."""

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        space, sums = _space(dimensions, seed), defaultdict(lambda: np.zeros(dimensions))
        counted: dict[str, Counter] = defaultdict(Counter)

        def bundle() -> None:
            for lang, counts in counted.items():
                found = np.fromiter(counts.keys(), np.int64, len(counts))
                n = np.fromiter(counts.values(), np.int64, len(counts))
                for part in range(0, len(found), 16_384):
                    cut = slice(part, part + 16_384)
                    sums[lang] += space.bundle(found[cut], n[cut]).astype(float)
            counted.clear()

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                found, n = grams(text)
                counts = counted[lang]
                for g, k in zip(found.tolist(), n.tolist()):
                    counts[g] += k
            if sum(map(len, counted.values())) > CACHED_GRAMS:
                bundle()
        bundle()
        _spaces.clear()
        if sums:
            yield pd.DataFrame({"lang": list(sums), "vector": list(sums.values())})

    parts = (
        labelled.select("text", "lang")
        .where("text IS NOT NULL AND lang IS NOT NULL")
        .mapInPandas(learn, "lang string, vector array<double>")
    )
    rows = (
        parts.select("lang", F.posexplode("vector").alias("i", "x"))
        .groupBy("lang", "i")
        .agg(F.sum("x").alias("x"))
        .collect()
    )
    out: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(dimensions))
    for lang, i, x in rows:
        out[lang][i] = x
    return {k: out[k] for k in sorted(out) if np.any(out[k])}


def predicted(
    text: Column, languages: dict[str, np.ndarray], dimensions: int = DIMENSIONS, seed: int = 0
) -> Column:
    """``struct(lang_pred, score)``: the language of largest cosine (of equal ones the first
    by name) and that cosine, 0 at least. ``und`` and 0 for a null text, one without letters,
    or if nothing was learned."""
    names = list(languages)
    unit = np.array([languages[n] / np.linalg.norm(languages[n]) for n in names])

    def named(texts: pd.Series) -> pd.DataFrame:
        space, out = _space(dimensions, seed), []
        for text in texts:
            found, counts = grams(text) if text and names else ((), ())
            vector = space.bundle(found, counts).astype(float) if len(found) else None
            size = np.linalg.norm(vector) if vector is not None else 0
            if not size:
                out.append((UNDETERMINED if not len(found) or not names else names[0], 0.0))
                continue
            cosines = unit @ vector / size
            best = int(np.argmax(cosines))
            out.append((names[best], float(min(1.0, max(0.0, cosines[best])))))
        return pd.DataFrame(out, columns=["lang_pred", "score"])

    @F.pandas_udf("lang_pred string, score double")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        try:
            yield from map(named, parts)
        finally:  # Python workers outlive the task and run other operators
            _spaces.clear()

    return of(text)


def _remainder(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def identify(documents: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of all documents; one fold in four is held out
    from learning. Only texts and the labels of the other folds are used, whole texts
    throughout; rows with equal values are kept, an empty table gives no rows."""
    held_out = _remainder(documents["doc_id"], 4) == 2
    languages = prototypes(documents.where(~held_out))
    return documents.select(
        "doc_id", held_out.alias("held_out"), predicted(documents["text"], languages).alias("p")
    ).select("doc_id", "held_out", "p.lang_pred", "p.score")


def keep_identified(documents: DataFrame, wanted: Sequence[str] | None = None) -> DataFrame:
    """The documents whose language can be told, and where ``lang`` is null, their predicted one.

    Profiles are learned from the labelled documents. Only texts without a letter are rejected
    (null and empty ones are among them), and with ``wanted`` those predicted to be in another
    language: a small cosine alone is no reason, as clean short texts have one. Where nothing was
    learned every text with a letter stays, its ``lang`` as it is, and ``wanted`` rejects none.
    Repeated rows are kept, an empty table gives none, other columns stay as they are.
    """
    languages = prototypes(documents)
    row, p = F.struct("*").alias("row"), predicted(documents["text"], languages).alias("p")
    told = F.col("p.lang_pred") != UNDETERMINED
    if not languages:
        told = F.coalesce(F.col("row.text").rlike(r"\p{L}"), F.lit(False))
    elif wanted is not None:
        told &= F.col("p.lang_pred").isin(list(wanted))
    filled = F.coalesce("row.lang", F.when(F.lit(bool(languages)), F.col("p.lang_pred")))
    columns = [
        filled.alias("lang") if c == "lang" else F.col(f"row.`{c}`").alias(c) for c in documents.columns
    ]
    return documents.select(row, p).where(told).select(*columns)
