"""Surrogates for personal data: keyed, type-consistent, distinct and coreferent.

Every mention that is detected is replaced, and nothing else. What a mention names (its
entity: an e-mail address whatever its case, a number whatever its separators, each word of a
person's name) is replaced by the same surrogate wherever it occurs, and different entities
by different ones. A surrogate is drawn from a keyed hash of entity and attempt:

* e-mail: letters for letters, digits for digits, below a reserved example domain;
* phone: country code, separators and number of digits stay;
* card number: first digit, separators, length, and whether the check digit is right, stay;
* national number 000-00-0000 and IBAN: same shape; IPv4: a dotted quad; IPv6: eight groups,
  whether or not the address was compressed;
* names after a title: title stays, given names keep gender (none after Dr, Prof and the like)
  and script (Latin, Cyrillic, Greek), family names keep script, upper case stays. Initials
  give way to whole names. The words of such a name are replaced without a title as well in
  the same document.

All entities of the corpus are drawn for together: a draw that equals a real entity, an
earlier surrogate or another entity's draw is a collision, and the entity draws again. The
table of entities is as large as their number and never leaves Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_key

# No group repeats without a bound: the engine goes one call deeper with each repeat, and a text
# of thousands of them would end the executor. Character classes may, as they are loops.

#: Titles that announce a name, by gender.
TITLES_M = "Mr|Mister|Herr|Monsieur|Señor|Господин|Κύριος"
TITLES_F = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Госпожа|Κυρία"
TITLES_N = "Dr|Doctor|Prof|Professor|Mx|Rev"
TITLES = rf"(?:(?:{TITLES_M}|{TITLES_F}|{TITLES_N})\.? ){{1,6}}"

EMAIL = (
    r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[A-Za-z0-9-]++\.){1,126}[A-Za-z]{2,}"
)
OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
IPV4 = rf"(?<![\w.])(?:{OCTET}\.){{3}}{OCTET}(?!\w|\.\d)"
GROUPS = r"[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6}"
IPV6 = (
    r"(?<![\w:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    rf"|(?=[A-Fa-f:]*\d)(?!(?:[0-9A-Fa-f]*:){{9}})(?:{GROUPS}::(?:{GROUPS})?|::{GROUPS}))(?![\w:])"
)
IBAN = r"(?<!\w)[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){3,7}(?: [A-Z0-9]{1,3})?)(?!\w)"
NATIONAL = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
CARD = r"(?<![\w.+-])(?:\d{4}(?:[ -]\d{4}){3}|3[47]\d{2}[ -]\d{6}[ -]\d{5}|\d{13,19})(?![\w-])"
PHONE = (
    r"(?<![\w+])\+\d{1,3} ?\(\d{1,4}\) ?(?:\d{2,4}[ .-]\d{2,8}(?:[.-]\d{2,4})?|\d{6,10})(?!\d)"
    r"|(?<![\w+])\+\d{1,3}(?:[ .-]\d{2,8}){2,5}(?!\d)"
    r"|(?<![\w+])\+(?:\d{1,3} \d{6,12}|\d{8,15})(?!\w)"
    r"|(?<![\w.-])(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])"
)
WORD = r"\p{Lu}(?:[\p{L}'’-]+|(?:\.\p{Lu}){0,2}\.|(?= \p{Lu}\p{L}))"
NAME = rf"(?<!\p{{L}}){TITLES}{WORD}(?: {WORD}){{0,2}}"
MENTION = "|".join([EMAIL, IPV4, IPV6, IBAN, NATIONAL, CARD, PHONE, NAME])
#: What any mention holds; a cheap test that leaves most texts alone.
HINT = rf"[0-9@]|{TITLES}\p{{Lu}}"

# Syllables of made-up names, by script (fixed values).
ONSETS = {
    "latin": "b d f g k l m n p r s t v".split(),
    "cyrillic": "б в г д к л м н п р с т".split(),
    "greek": "β γ δ κ λ μ ν π ρ σ τ φ".split(),
}
NUCLEI = {
    "latin": "a e i o u".split(), "cyrillic": "а е и о у".split(), "greek": "α ε ι ο υ".split()
}
ENDINGS = {
    ("latin", "given_f"): "na ra lia sa".split(),
    ("latin", "given_m"): "no ro lan ton".split(),
    ("latin", "given_n"): "is el en ai".split(),
    ("latin", "family"): "man sen ler dt".split(),
    ("cyrillic", "given_f"): "на ра лия ся".split(),
    ("cyrillic", "given_m"): "ман рий лад тон".split(),
    ("cyrillic", "given_n"): "ин ель ен ай".split(),
    ("cyrillic", "family"): "ко чук дзе як".split(),
    ("greek", "given_f"): "να ρα λια σα".split(),
    ("greek", "given_m"): "νος ρος λης τας".split(),
    ("greek", "given_n"): "ις ελ εν αι".split(),
    ("greek", "family"): "ίδης άκης όγλου έας".split(),
}
#: So many draws fail only if a kind of entity fills its space; names grow with every draw.
DRAWS = 64


def _strings(values: list[str]) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


class Drawing:
    """SQL expressions over columns ``kind``, ``entity`` and ``draw``, keyed by ``key``."""

    def __init__(self, key: int):
        self.key = key

    def _hash(self, place: str, size: int, of: str = "entity") -> str:
        return f"CAST(pmod(xxhash64({self.key}L, kind, {of}, draw, {place}), {size}) AS INT)"

    def _letters(self, text: str, of: str = "entity", keep: int = 0) -> str:
        """Each character after the first ``keep`` by another of its class."""

        def pick(letters: str) -> str:
            return f"substr('{letters}', 1 + {self._hash('i', len(letters), of)}, 1)"

        lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        return (
            f"array_join(transform(filter(split({text}, ''), x -> x <> ''), (x, i) -> CASE "
            f"WHEN i < {keep} THEN x WHEN x RLIKE '^[0-9]$' THEN {pick('0123456789')} "
            f"WHEN x RLIKE '^[A-Z]$' THEN {pick(upper)} "
            rf"WHEN x RLIKE '^\\p{{L}}$' THEN {pick(lower)} ELSE x END), '')"
        )

    def _email(self) -> str:
        domain = "substring_index(entity, '@', -1)"
        tld = f"substring_index({domain}, '.', -1)"
        host = f"regexp_replace({domain}, '(^|[.])(example[.])?[^.]+$', '')"
        below = f"IF({host} = '', '', concat({self._letters(host, of=host)}, '.'))"
        top = f"IF({tld} IN ('com', 'org', 'net'), {tld}, 'org')"
        local = self._letters("substring_index(entity, '@', 1)")
        return f"concat({local}, '@', {below}, 'example.', {top})"

    def _ipv4(self) -> str:
        octets = [f"1 + {self._hash(str(k), 254)}" for k in range(4)]
        return f"concat_ws('.', {', '.join(octets)})"

    def _ipv6(self) -> str:
        groups = [f"lower(hex(1 + {self._hash(str(k), 65535)}))" for k in range(8)]
        return f"concat_ws(':', {', '.join(groups)})"

    def _phone(self) -> str:
        kept = "CASE WHEN entity LIKE '+1%' THEN 2 WHEN entity LIKE '+%' THEN 3 ELSE 0 END"
        return self._letters("entity", keep=0).replace("i < 0", f"i < ({kept})")

    @staticmethod
    def _check_digit(digits: str) -> str:
        """The digit that completes ``digits`` to a number with a right check digit."""
        doubled = (
            f"aggregate(transform(filter(split(reverse({digits}), ''), x -> x <> ''), (x, i) -> "
            "IF(i % 2 = 1, CAST(x AS INT), CAST(x AS INT) * 2 - IF(CAST(x AS INT) > 4, 9, 0))), "
            "0, (s, x) -> s + x)"
        )
        return f"pmod(10 - pmod({doubled}, 10), 10)"

    def _card(self) -> str:
        head = "substr(entity, 1, length(entity) - 1)"
        drawn = self._letters(head, keep=1)
        off = f"CAST(right(entity, 1) AS INT) - {self._check_digit(head)}"
        return f"concat({drawn}, pmod({self._check_digit(drawn)} + {off}, 10))"

    def _name(self, script: str, role: str) -> str:
        onsets, nuclei = ONSETS[script], NUCLEI[script]
        ends = ENDINGS[script, role]

        def syllable(i: str) -> str:
            onset = f"{_strings(onsets)}[{self._hash(f'2 * {i}', len(onsets))}]"
            return f"concat({onset}, {_strings(nuclei)}[{self._hash(f'2 * {i} + 1', len(nuclei))}])"

        stem = f"array_join(transform(sequence(1, 2 + draw), i -> {syllable('i')}), '')"
        return f"initcap(concat({stem}, {_strings(ends)}[{self._hash('0', len(ends))}]))"

    def surrogate(self) -> Column:
        names = " ".join(
            f"WHEN '{role}_{script}' THEN {self._name(script, role)}" for script, role in ENDINGS
        )
        return F.expr(
            f"CASE kind WHEN 'email' THEN {self._email()} WHEN 'ipv4' THEN {self._ipv4()} "
            f"WHEN 'ipv6' THEN {self._ipv6()} WHEN 'iban' THEN {self._letters('entity', keep=2)} "
            f"WHEN 'national' THEN {self._letters('entity')} WHEN 'card' THEN {self._card()} "
            f"WHEN 'phone' THEN {self._phone()} {names} END"
        )


# --- mentions ----------------------------------------------------------------

#: An IPv6 address ``word`` as eight groups without leading zeros.
SIDE = "filter(split(coalesce(get(split(lower(word), '::'), {}), ''), ':'), x -> x <> '')"
ADDRESS = (
    f"concat_ws(':', transform(concat({SIDE.format(0)}, array_repeat('0', greatest(0, 8 - "
    f"size({SIDE.format(0)}) - size({SIDE.format(1)}))), {SIDE.format(1)}), "
    "x -> coalesce(nullif(ltrim('0', x), ''), '0')))"
)


def name_words(name: Column) -> Column:
    """The words of a titled name, the titles left out."""
    return F.split(F.regexp_replace(name, rf"^{TITLES}", ""), " ")


def _is_loud(word: Column) -> Column:
    return (F.upper(word) == word) & word.rlike(r"\p{L}{2}")


def mentions(text: Column) -> Column:
    """All mentions of a text, in order."""
    return F.regexp_extract_all(text, F.lit(MENTION), F.lit(0))


def words_again(names: Column) -> Column:
    """``(forms, name, part)`` of every word of a text's titled names, initials left out."""
    each = F.transform(
        names,
        lambda name: F.transform(
            name_words(name),
            lambda w, i: F.struct(
                F.array_distinct(F.array(w, F.initcap(w), F.upper(w))).alias("forms"),
                name.alias("name"), i.alias("part"),
            ),
        ),
    )
    return F.filter(F.flatten(each), lambda a: a["forms"][0].rlike(r"\p{L}{2}"))


def again_pattern(again: str) -> Column:
    """What follows ``MENTION`` to find these words without a title; null if there are none."""
    # backwards, so that a word comes before its own beginnings
    forms = F.sort_array(
        F.array_distinct(F.flatten(F.transform(F.col(again), lambda a: a["forms"]))), asc=False
    )
    one = F.concat(
        F.lit(r"|(?<![\p{L}\p{N}])(?:"), F.array_join(forms, "|"), F.lit(r")(?![\p{L}\p{N}])")
    )
    return F.when(F.size(forms) > 0, one)


def may_mention(text: Column) -> Column:
    return F.coalesce(text.rlike(HINT), F.lit(False))


def kind_of(mention: Column) -> Column:
    return (
        F.when(mention.contains("@"), "email")
        .when(mention.rlike(rf"^{TITLES}"), "name")
        .when(mention.rlike(rf"^{IPV4}$"), "ipv4")
        .when(mention.rlike(rf"^{IPV6}$"), "ipv6")
        .when(mention.rlike(r"^[A-Z]{2}\d"), "iban")
        .when(mention.rlike(rf"^{NATIONAL}$"), "national")
        .when(mention.rlike(rf"^{CARD}$"), "card")
        .otherwise("phone")
    )


def entities(listed: DataFrame) -> DataFrame:
    """``(mention, part, kind, entity)`` of every mention in ``listed(mention)``: one part, or
    one per word of a name."""
    m = F.col("mention")
    titles = F.regexp_extract("mention", rf"^{TITLES}", 0)
    word = F.col("word")
    script = (
        F.when(word.rlike(r"^\p{IsCyrillic}"), "cyrillic")
        .when(word.rlike(r"^\p{IsGreek}"), "greek")
        .otherwise("latin")
    )
    of = F.col("titles")
    gender = (
        F.when(of.rlike(rf"(?:^| )(?:{TITLES_F})\.? "), "given_f")
        .when(of.rlike(rf"(?:^| )(?:{TITLES_M})\.? "), "given_m")
        .otherwise("given_n")
    )
    names = name_words(m)
    parts = F.when(F.col("what") == "name", names).otherwise(F.array(m))
    digits = F.regexp_replace("word", r"[^0-9]", "")
    split = (
        listed.select("mention", kind_of(m).alias("what"))
        .select(
            "mention", "what", titles.alias("titles"), F.size(parts).alias("n"),
            F.posexplode(parts).alias("part", "word"),
        )
    )
    role = F.when(F.col("part") == F.col("n") - 1, "family").otherwise(gender)
    kind = F.when(F.col("what") == "name", F.concat_ws("_", role, script)).otherwise(F.col("what"))
    entity = (
        F.when(F.col("what") == "email", F.lower("word"))
        .when(F.col("what") == "ipv6", F.expr(ADDRESS))
        .when(F.col("what") == "name", F.initcap("word"))
        .when(F.col("what") == "phone", F.concat(F.when(word.startswith("+"), "+").otherwise(""), digits))
        .when(F.col("what").isin("card", "national"), digits)
        .when(F.col("what") == "iban", F.regexp_replace("word", " ", ""))
        .otherwise(word)
    )
    return split.select("mention", "part", kind.alias("kind"), entity.alias("entity"))


def draw_all(real: DataFrame, key: int) -> DataFrame:
    """``(kind, entity, surrogate)`` for the stored table ``real(kind, entity)``: no surrogate
    is given twice or equals a real entity. Where draws collide, the smallest entity keeps
    its draw and the others draw again."""
    drawing = Drawing(key)
    waiting, given = real, None
    for draw in range(DRAWS):
        drawn = stored(
            waiting.select("kind", "entity", F.lit(draw).alias("draw")).withColumn(
                "surrogate", drawing.surrogate()
            ),
            "drawn",
        )
        taken = real.select("kind", F.col("entity").alias("surrogate"))
        if given is not None:
            taken = taken.unionByName(given.select("kind", "surrogate"))
        first = drawn.groupBy("kind", "surrogate").agg(F.min("entity").alias("entity")).join(
            taken, ["kind", "surrogate"], "left_anti"
        )
        good = stored(first.select("kind", "entity", "surrogate"), "given")
        given = good if given is None else given.unionByName(good)
        waiting = drawn.join(good, ["kind", "entity"], "left_anti").select("kind", "entity")
        if waiting.isEmpty():
            return given
        waiting = stored(waiting, "waiting")
    raise RuntimeError("a kind of entity has more members than surrogates")


def replacements(listed: DataFrame, key: int) -> DataFrame:
    """``(mention, replacement)`` for the stored table ``listed(mention)`` of all mentions."""
    parts = stored(entities(listed), "mention-parts")
    real = stored(parts.select("kind", "entity").distinct(), "entities")
    whole = (
        parts.join(draw_all(real, key), ["kind", "entity"])
        .groupBy("mention")
        .agg(
            F.array_sort(F.collect_list(F.struct("part", "surrogate", "kind"))).alias("parts"),
        )
        .withColumn("s", F.expr("parts[0].surrogate"))
        .withColumn("kind", F.expr("parts[0].kind"))
    )
    # digit by digit (for an IBAN letter by letter) into the mention's own separators
    fills = "CASE kind WHEN 'iban' THEN '^[A-Z0-9]$' ELSE '^[0-9]$' END"
    shaped = F.expr(
        "aggregate(filter(split(mention, ''), x -> x <> ''), "
        "named_struct('t', '', 'k', IF(s LIKE '+%', 1, 0)), "
        f"(a, x) -> IF(x RLIKE {fills}, named_struct('t', concat(a.t, substr(s, a.k + 1, 1)), "
        "'k', a.k + 1), named_struct('t', concat(a.t, x), 'k', a.k)), a -> a.t)"
    )
    loud = (F.upper("mention") == F.col("mention")) & F.col("mention").rlike(r"\p{L}")
    in_case = F.when(loud, F.upper("s")).otherwise(F.col("s"))
    title = F.regexp_extract("mention", rf"^{TITLES}", 0)
    words = F.transform(
        name_words(F.col("mention")),
        lambda w, i: F.when(_is_loud(w), F.upper(F.get("parts", i)["surrogate"])).otherwise(
            F.get("parts", i)["surrogate"]
        ),
    )
    named = F.col("kind").startswith("given") | F.col("kind").startswith("family")
    text = (
        F.when(named, F.concat(title, F.array_join(words, " ")))
        .when(F.col("kind").isin("email", "ipv6"), in_case)
        .when(F.col("kind") == "ipv4", F.col("s"))
        .otherwise(shaped)
    )
    return whole.select("mention", text.alias("replacement"))


# --- operator ----------------------------------------------------------------


def replaced(documents: DataFrame, key: int = 20240101) -> DataFrame:
    """``row`` (all columns of ``documents``, the text rewritten) and ``n_mentions``.

    Texts without a mention, null and empty ones stay as they are and move nowhere. Of the
    others the mentions are gathered and the text rewritten once per distinct text; the rewritten
    texts come from one join on a 128-bit text key. Texts are searched in three passes: to gather
    what to rewrite, to find the rows that change, and those that stay. Repeated rows are rewritten alike. Null keys and
    extra columns of any name are kept; an empty table gives no rows.
    """
    names = [c for c in documents.columns if c != "text"]
    # the other columns as one, never empty
    row = F.struct(F.lit(True).alias("__row"), *(documents[c] for c in names)).alias("row")
    keyed = documents.select(row, documents["text"].alias("text"))
    found = F.when(may_mention(F.col("text")), mentions(F.col("text")))
    some = keyed.withColumn("found", found)
    mentioning = F.coalesce(F.size("found"), F.lit(0)) > 0
    with_text = some.where(mentioning).withColumn("text_key", text_key(F.col("text")))
    # stored, so that what is worked out from the mentions below starts no other pass over texts
    distinct = stored(
        with_text.groupBy("text_key").agg(
            F.any_value("text").alias("text"), F.any_value("found").alias("found")
        ),
        "texts-with-mentions",
    )
    named = F.filter("found", lambda m: kind_of(m) == "name")
    with_key = stored(
        distinct.withColumn("again", words_again(named))
        .withColumn("pattern", F.concat(F.lit(MENTION), F.coalesce(again_pattern("again"), F.lit(""))))
        .withColumn("found", F.regexp_extract_all("text", F.col("pattern"), F.lit(0))),
        "texts-with-words",
    )
    # a word that names again stands for its place in the titled name: (mention, place)
    place = F.get(F.filter("again", lambda a: F.array_contains(a["forms"], F.col("said"))), F.lit(0))
    by_text = stored(
        with_key.select("text_key", "again", F.posexplode("found").alias("i", "said"))
        .withColumn("place", place)
        .select(
            "text_key", "i", "said", F.coalesce("place.name", "said").alias("mention"),
            F.col("place.part").alias("part"),
        ),
        "mentions",
    )
    listed = stored(by_text.select("mention").distinct(), "distinct-mentions")
    word = F.get(name_words(F.col("replacement")), F.col("part"))
    new = (
        F.when(F.col("part").isNull(), F.col("replacement"))
        .when(_is_loud(F.col("said")), F.upper(word))
        .otherwise(F.initcap(word))
    )
    texts = (
        by_text.join(replacements(listed, key), "mention")
        .select("text_key", "i", new.alias("replacement"))
        .groupBy("text_key")
        .agg(F.array_sort(F.collect_list(F.struct("i", "replacement"))).alias("new"))
    )
    rewritten = F.array_join(
        F.transform(
            F.split("text", F.col("pattern"), -1),
            lambda gap, i: F.concat(gap, F.coalesce(F.get(F.col("new"), i)["replacement"], F.lit(""))),
        ),
        "",
    )
    changes = stored(
        with_key.join(texts, "text_key").select(
            "text_key", rewritten.alias("text"), F.size("new").alias("n")
        ),
        "rewritten-texts",
    )

    def rows(of: DataFrame, n: Column) -> DataFrame:
        columns = [
            F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in documents.columns
        ]
        return of.select(F.struct(*columns).alias("row"), n.cast("long").alias("n_mentions"))

    changed = rows(with_text.select("row", "text_key").join(changes, "text_key"), F.col("n"))
    same = rows(some.where(~mentioning), F.lit(0))
    return same.unionByName(changed)


def report(documents: DataFrame) -> DataFrame:
    """``doc_id, text, n_mentions`` of every document after replacement."""
    return replaced(documents.select("doc_id", "text")).select("row.*", "n_mentions")


def rewrite(documents: DataFrame, key: int = 20240101) -> DataFrame:
    """The documents with surrogates for personal data, in the same columns."""
    return replaced(documents, key).select("row.*")
