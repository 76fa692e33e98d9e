"""Benchmark decontamination with a positional inverted index.

The index stores postings of training tokens: term, text and position, and for terms that
lead a search the words around them. Test items are cut into windows of words. Every window
knows its terms by how rare they are in the training texts; the list of its rarest term is
read first and shifted to where the window would start, and what is left is intersected with
the shifted lists of the next rarest ones. What survives is compared word by word. The same
lists answer proximity questions.

A text is known by a 128-bit key, so exact copies are one text in the index. Terms are in
full lower case there; the last comparison lower-cases A-Z only, as the words are defined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, ascii_lower, broadcast_if_small, stored, stored_sized, text_key

#: What stands between words: ASCII but for digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10
#: So many of a window's rarest terms have their lists intersected.
LISTS = 3


#: ``w`` without the empty ends that a split can have; no other part of it can be empty.
_EMPTY_FIRST, _EMPTY_LAST = "CAST(w[0] = '' AS INT)", "CAST(element_at(w, -1) = '' AS INT)"
_TRIMMED = f"slice(w, 1 + {_EMPTY_FIRST}, greatest(0, size(w) - {_EMPTY_FIRST} - {_EMPTY_LAST}))"


def _split(rows: DataFrame, *others: str | Column) -> DataFrame:
    """``rows`` with ``w``, the words of ``text``, of which the first and last can be empty."""
    return rows.select(*others, F.split(F.coalesce("text", F.lit("")), BETWEEN).alias("w"))


def word_array(rows: DataFrame, *others: str | Column) -> DataFrame:
    """``rows`` with ``w``, the words of ``text``."""
    return _split(rows, *others).withColumn("w", F.expr(_TRIMMED))


def _term(word: Column) -> Column:
    """The term of a word as 64 bits, which join faster than texts. Should two terms share
    them, their lists are read together, and the comparison word by word tells them apart."""
    return F.xxhash64(F.lower(word))


def windows(benchmark: DataFrame, length: int = WINDOW) -> DataFrame:
    """``(window, item_id, phrase, terms)``: every ``length`` consecutive words of an item; an
    item of fewer words, but not none, is one window. ``item_id`` as text, null as empty."""
    lowered = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        ascii_lower(F.col("text")).alias("text"),
    )
    item = word_array(lowered, "item_id", "text").where("size(w) > 0")
    starts = F.expr(f"sequence(1, greatest(size(w) - {length - 1}, 1))")
    cut = item.select("item_id", "w", F.explode(starts).alias("s")).select(
        "item_id", F.slice("w", F.col("s"), F.lit(length)).alias("w")
    )
    phrase = F.concat_ws(" ", "w")
    return cut.select(
        F.xxhash64(phrase).alias("window"),
        "item_id",
        phrase.alias("phrase"),
        F.transform("w", lambda x: F.lower(x)).alias("terms"),
    ).distinct()


def frequencies(texts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(term, n)``: occurrences in all ``texts(text)`` of the terms of ``vocabulary``."""
    # words are exploded as an expression: Spark derives a filter from an exploded column and
    # would split every text again for it, several times
    tokens = _split(texts.select("text")).select(F.explode(F.expr(_TRIMMED)).alias("t"))
    listed = vocabulary.select("term", _term(F.col("term")).alias("id"))
    counted = (
        tokens.select(_term(F.col("t")).alias("id"))
        .join(broadcast_if_small(stored_sized(listed.select("id").distinct(), "term-ids")), "id")
        .groupBy("id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return listed.join(counted, "id").select("term", "n")


def postings(texts: DataFrame, terms: DataFrame | None = None, reach: int = WINDOW) -> DataFrame:
    """The inverted index of ``texts(text)``: ``(term, text_key, pos, before, around)``, one
    posting per term, distinct text and position.

    ``terms(term, lead)`` limits it to lists that will be read; leading terms carry up to
    ``reach`` - 1 words on either side. Without it every token is posted.
    """
    rows = _split(texts.select("text"), text_key(F.col("text")).alias("text_key"), "text")
    at = rows.select(
        "text_key", "w", F.expr(f"posexplode({_TRIMMED})").alias("pos", "t")
    ).withColumn("id", _term(F.col("t")))
    first = F.expr(f"greatest(0, pos - {reach - 1})")
    nearby = F.slice("w", first + F.expr(_EMPTY_FIRST) + 1, F.col("pos") + reach - first)
    around = [(F.col("pos") - first).alias("before"), F.concat_ws(" ", nearby).alias("around")]
    if terms is None:
        at = at.select(F.lower("t").alias("term"), F.lit(False).alias("lead"), "text_key", "pos", *around)
    else:
        listed, size = stored_sized(
            terms.select(_term(F.col("term")).alias("id"), "term", "lead"), "listed-terms"
        )
        if size <= BROADCAST_BYTES:
            at = at.join(F.broadcast(listed), "id").select("term", "lead", "text_key", "pos", *around)
        else:  # no whole text moves with each of its words
            at = at.select("id", "text_key", "pos", *around).join(listed, "id")
    return at.select(
        "term",
        "text_key",
        "pos",
        F.when(F.col("lead"), F.col("before")).alias("before"),
        F.when(F.col("lead"), F.col("around")).alias("around"),
    ).distinct()


def probes(cut: DataFrame, counted: DataFrame, lists: int = LISTS) -> DataFrame:
    """For every different window that can occur at all, its rarest terms and where they
    stand: ``(window, phrase, size, t1, o1, t2, o2, ...)``, rarest first. A window of fewer
    different terms repeats its rarest one."""
    each = (
        cut.select("window", "phrase", "terms")
        .distinct()
        .select("window", "phrase", F.size("terms").alias("size"), F.posexplode("terms").alias("o", "term"))
        .join(counted, "term", "left")
    )
    ranked = (
        each.groupBy("window", "phrase", "size", "term")
        .agg(F.min("o").alias("o"), F.first("n").alias("n"))
        .groupBy("window", "phrase", "size")
        .agg(
            F.count(F.when(F.col("n").isNull(), 1)).alias("absent"),
            F.array_sort(F.collect_list(F.struct("n", "term", "o"))).alias("by"),
        )
        .where("absent = 0")
    )
    chosen = [
        F.coalesce(F.get("by", F.lit(k)), F.get("by", F.lit(0))).getField(f).alias(f"{f[0]}{k + 1}")
        for k in range(lists)
        for f in ("term", "o")
    ]
    return ranked.select("window", "phrase", "size", *chosen)


def phrase_matches(index: DataFrame, wanted: DataFrame, lists: int = LISTS) -> DataFrame:
    """``(text_key, window, start, size)`` of all places where a window of ``wanted`` occurs."""
    led = broadcast_if_small(stored_sized(wanted, "probes"))
    found = (
        index.where("around IS NOT NULL")
        .join(led, F.col("term") == F.col("t1"))
        .withColumn("start", F.col("pos") - F.col("o1"))
        .where("start >= 0")
        .drop("term", "pos")
    )
    for k in range(2, lists + 1):
        listed = index.select(
            F.col("text_key").alias("key_k"), F.col("term").alias("term_k"), F.col("pos").alias("pos_k")
        )
        found = found.join(
            listed,
            (F.col("text_key") == F.col("key_k"))
            & (F.col(f"t{k}") == F.col("term_k"))
            & (F.col("start") + F.col(f"o{k}") == F.col("pos_k")),
            "left_semi",
        )
    there = F.expr("slice(split(around, ' '), before - o1 + 1, size)")
    return (
        found.where((F.col("before") >= F.col("o1")))
        .where(ascii_lower(F.concat_ws(" ", there)) == F.col("phrase"))
        .select("text_key", "window", "start", "size")
        .distinct()
    )


def proximity_matches(index: DataFrame, pairs: DataFrame, within: int) -> DataFrame:
    """``(pair_id, text_key, pos_1, pos_2)`` of all places where the terms of
    ``pairs(pair_id, term_1, term_2)`` stand at most ``within`` words apart.

    Positions are dealt into cells of ``within`` + 1 words, so that only neighbouring cells of
    one text meet."""
    cell = F.expr(f"pos div {within + 1}")
    one = index.join(pairs, F.col("term") == F.col("term_1")).select(
        "pair_id", "text_key", F.col("pos").alias("pos_1"),
        F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"),
    )
    two = index.join(pairs, F.col("term") == F.col("term_2")).select(
        "pair_id", "text_key", F.col("pos").alias("pos_2"), cell.alias("cell")
    )
    return (
        one.join(two, ["pair_id", "text_key", "cell"])
        .where((F.abs(F.col("pos_1") - F.col("pos_2")) <= within) & (F.col("pos_1") != F.col("pos_2")))
        .select("pair_id", "text_key", "pos_1", "pos_2")
        .distinct()
    )


def contaminated_texts(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(text_key, n_hit, n_items, items_sha256)`` of the texts with any window of an item."""
    cut = stored(windows(benchmark), "windows")
    vocabulary = cut.select(F.explode("terms").alias("term")).distinct()
    counted = stored(frequencies(documents, stored(vocabulary, "vocabulary")), "frequencies")
    wanted = stored(probes(cut, counted), "probes")
    terms = wanted.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.col(f"t{k}").alias("term"), F.lit(k == 1).alias("lead"))
                    for k in range(1, LISTS + 1)
                ]
            )
        ).alias("t")
    ).groupBy("t.term").agg(F.max("t.lead").alias("lead"))
    index = stored(postings(documents, terms), "postings")
    hits = stored(phrase_matches(index, wanted), "hits")
    covered = (
        hits.select(
            "text_key", F.explode(F.expr("sequence(start, start + size - 1)")).alias("pos")
        )
        .distinct()
        .groupBy("text_key")
        .agg(F.count(F.lit(1)).alias("n_hit"))
    )
    items = (
        hits.select("text_key", "window")
        .distinct()
        .join(cut.select("window", "item_id"), "window")
        .select("text_key", "item_id")
        .distinct()
        .groupBy("text_key")
        .agg(
            F.count(F.lit(1)).alias("n_items"),
            F.sha2(F.array_join(F.array_sort(F.collect_list("item_id")), ","), 256).alias(
                "items_sha256"
            ),
        )
    )
    return covered.join(items, "text_key")


def report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: words, hit words, items, and whether it is contaminated.

    A null or empty text has no words, repeated rows and null ids are kept as they are, an
    empty benchmark hits nothing. Items that share an id count once. Only doc_id, text,
    item_id and text are read.
    """
    found = stored(contaminated_texts(documents, benchmark), "contaminated")
    rows = word_array(
        documents.select("doc_id", "text"), "doc_id", text_key(F.col("text")).alias("text_key"), "text"
    ).select("doc_id", "text_key", F.size("w").cast("long").alias("n_words"))
    none = F.lit(0).cast("long")
    return rows.join(found, "text_key", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", none).alias("n_hit"),
        F.coalesce("n_items", none).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def keep_clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any window of an item."""
    found = contaminated_texts(documents, benchmark).select("text_key")
    keyed = documents.select(text_key(documents["text"]).alias("text_key"), F.struct("*").alias("row"))
    hit = broadcast_if_small(stored_sized(found, "contaminated"))
    return keyed.join(hit, "text_key", "left_anti").select("row.*")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, array_to_string(w[s:s + 9], ' ') AS phrase, least(len(w), 10) AS size
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
place AS (
  SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, sizes WHERE len(w) >= size),
gram AS (SELECT r, s, size, array_to_string(w[s:s + size - 1], ' ') AS phrase FROM place),
hit AS (SELECT DISTINCT r, s, gram.size, item_id FROM gram JOIN win USING (phrase, size)),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + size)) AS p FROM hit) GROUP BY r),
its AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
  FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r)
"""
