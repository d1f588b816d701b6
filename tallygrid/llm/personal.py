"""Personal data and the terms that give it away: information-theoretic sanitisation.

Everything is a DataFrame expression. Base spans are e-mail addresses, IP addresses,
card numbers and phone numbers. Words inside base spans are left out. All counts
are numbers of distinct texts of the whole table, so copies of one text prove nothing.
A term t discloses an entity's value v, counted over whole texts (n(t), n(v), n(t, v)
with both, N in all), by

    PMI(t, v) / IC(v) = log(n(t, v) * N / (n(t) * n(v))) / log(N / n(v)),

which is 1 when every text with the term has the value, and 0 when they are
independent; at least ``support`` texts must have both. In addition a term discloses
a kind k of entity by PMI(t, k) / IC(k), where n(k) counts texts with the kind, and
n(t, k) those with t within ``REACH`` code points of one; this takes at least
``support`` different values beside the term.

Terms at or above ``generalise_at`` in one of the two are reported as spans of kind
``term`` wherever they stand, in texts without the entity too; ``sanitise`` replaces
them by their entity's kind, and removes them from ``remove_at`` on.

Only texts with a value of ``support`` texts are paired with its terms, and only terms
whose own count can reach the threshold. Tables of at most ``SMALL`` rows are sent to
the texts; larger ones are joined by exchanges.

Rows: every input row gives one row; a null text counts as empty; repeated rows are
repeated. Only the id and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scale import settle
from . import spans as sp
from .rows import row_key, unused

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
#: The base patterns. Possessive forms and borders match the same strings in linear time.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@"
         r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

REACH = 60
WORD = r"[\p{L}\p{N}_]{3,}"
SUPPORT = 5
GENERALISE_AT = 0.8
REMOVE_AT = 0.95
SMALL = 200_000
PLACES = "array<struct<start:int,end:int,kind:string,match:string,of:string,disclosure:double>>"


def _digits(s: Column) -> Column:
    return F.regexp_replace(s["match"], "[^0-9]", "")


def _keep_ip(s: Column) -> Column:
    def small(part: Column) -> Column:
        value = F.ltrim(part, F.lit("0"))
        return (F.length(value) <= 3) & (F.coalesce(value.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(s["match"], r"\."), small)


def _luhn(digits: Column) -> Column:
    """Every second digit from the right is doubled and its digits are summed; the total ends in 0."""
    values = F.reverse(F.transform(F.filter(F.split(digits, ""), lambda c: c != ""), lambda c: c.cast("int")))
    parts = F.transform(values, lambda v, i: F.when(i % 2 == 0, v).when(v > 4, 2 * v - 9).otherwise(2 * v))
    return F.aggregate(parts, F.lit(0), lambda a, v: a + v) % 10 == 0


def _keep_card(s: Column) -> Column:
    digits = _digits(s)
    return F.length(digits).between(13, 19) & _luhn(digits)


def base_spans(text: Column) -> Column:
    return F.concat(
        sp.find_all(text, EMAIL, "email", F.contains(text, F.lit("@"))),
        F.filter(sp.find_all(text, IP, "ip"), _keep_ip),
        F.filter(F.filter(sp.find_all(text, CARD, "card", text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}")),
                          lambda s: F.length(s["match"]) >= 13), _keep_card),
        F.filter(sp.find_all(text, PHONE, "phone", F.contains(text, F.lit("+"))),
                 lambda s: F.length(_digits(s)).between(9, 15)))


def _context(text: Column, spans: Column) -> Column:
    """Words near each span: array of (kind, value, term, start, end); words inside base spans are left out."""
    def side(span: Column, begin: Column, end: Column) -> Column:
        words = sp.find_all(F.substring(text, begin + 1, end - begin), WORD, TERM)
        moved = F.transform(words, lambda w: F.struct(
            span["kind"].alias("kind"), span["match"].alias("value"), F.lower(w["match"]).alias("term"),
            (w["start"] + begin).alias("start"), (w["end"] + begin).alias("end")))
        # a word cut by the edge of the context is not a whole word
        return F.filter(moved, lambda w: ((w["start"] > begin) | (begin == 0)) & ((w["end"] < end) | (end == F.length(text))
                                                                                | (end == span["start"])))

    both = F.transform(spans, lambda s: F.concat(
        side(s, F.greatest(s["start"] - REACH, F.lit(0)), s["start"]),
        side(s, s["end"], F.least(s["end"] + REACH, F.length(text)))))
    return F.filter(F.flatten(both), lambda w: ~F.exists(spans, lambda s: sp.overlaps(s, w)))


def _masked(text: Column, base: Column) -> Column:
    """Text with base spans blanked; places stay."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        blank = F.repeat(F.lit(" "), F.greatest(s["end"] - F.greatest(s["start"], state["at"]), F.lit(0)))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.concat(state["out"], gap, blank).alias("out"))

    return F.when(F.size(base) == 0, text).otherwise(F.aggregate(
        F.array_sort(base), start, step, lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text)))))


def _words(text: Column) -> Column:
    """Distinct lower-case words."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.lower(w)))


def _places(text: Column, marks: Column) -> Column:
    """Every occurrence of the marked terms (term, of, disclosure)."""
    found = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    gaps = F.slice(F.split(text, WORD, -1), 1, F.greatest(F.size(found), F.lit(1)))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(PLACES).alias("out"))

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.length(pair["gap"])
        end = begin + F.length(pair["hit"])
        mine = F.transform(F.filter(marks, lambda m: m["term"] == F.lower(pair["hit"])), lambda m: F.struct(
            begin.alias("start"), end.alias("end"), F.lit(TERM).alias("kind"), m["term"].alias("match"), m["of"].alias("of"),
            m["disclosure"].alias("disclosure")))
        out = F.when(F.exists(marks, lambda m: m["term"] == F.lower(pair["hit"])), F.concat(state["out"], mine))
        return F.struct(end.alias("at"), out.otherwise(state["out"]).alias("out"))

    pairs = F.zip_with(found, gaps, lambda hit, gap: F.struct(hit.alias("hit"), gap.alias("gap")))
    return F.aggregate(F.filter(pairs, lambda p: p["hit"].isNotNull()), start, step, lambda state: state["out"])


def _sent(table: DataFrame) -> DataFrame:
    """A settled table, marked to be sent to all tasks if it is small."""
    return F.broadcast(table) if table.limit(SMALL + 1).count() <= SMALL else table


def _disclosure(together: str, seen: str, holders: str, total: int) -> Column:
    content = F.log(F.lit(float(total)) / F.col(holders))
    return F.when(content > 0, F.log(F.col(together) * F.lit(float(total)) / (F.col(seen) * F.col(holders))) / content)


def kind_terms(contexts: DataFrame, alone: DataFrame, total: int, *, support: int, generalise_at: float) -> DataFrame:
    """(term, kind, disclosure) of the terms that disclose a kind; ``contexts`` has ``key``, ``kind``, ``value`` and ``term``."""
    beside = contexts.groupBy("term", "kind").agg(
        F.count_distinct("value").alias("values"), F.count_distinct("key").alias("together")) \
        .where(F.col("values") >= support)
    held = contexts.groupBy("kind").agg(F.count_distinct("key").alias("holders"))
    return beside.join(alone, "term").join(held, "kind") \
        .withColumn("disclosure", _disclosure("together", "seen", "holders", total)) \
        .where(F.col("disclosure") >= generalise_at).select("term", "kind", "disclosure")


def value_terms(keyed: DataFrame, entities: DataFrame, alone: DataFrame, total: int, *, support: int,
                generalise_at: float) -> DataFrame:
    """(term, kind, disclosure) of the terms that disclose one value; ``entities`` has distinct ``key``, ``kind`` and ``value``."""
    values = entities.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("holders")).where(F.col("holders") >= support)
    shared = settle(entities.join(values, ["kind", "value"]))
    holders = settle(shared.select("key").distinct())
    words = keyed.join(_sent(holders), "key", "left_semi").select("key", F.explode(_words(_masked(F.col("text"), F.col("base")))).alias("term"))
    # a term of more texts cannot reach the threshold, even where all of the value's texts have it
    most = F.lit(float(total)) ** F.lit(1 - generalise_at) * F.col("holders") ** F.lit(generalise_at) * 1.000001
    pairs = words.distinct().join(alone.where(F.col("seen") >= support), "term").join(_sent(shared), "key").where(F.col("seen") <= most)
    return pairs.groupBy("term", "kind", "value").agg(
        F.count(F.lit(1)).alias("together"), F.first("seen").alias("seen"), F.first("holders").alias("holders")) \
        .where(F.col("together") >= support).withColumn("disclosure", _disclosure("together", "seen", "holders", total)) \
        .where(F.col("disclosure") >= generalise_at).select("term", "kind", "disclosure")


def disclosing_terms(keyed: DataFrame, *, support: int = SUPPORT, generalise_at: float = GENERALISE_AT) -> DataFrame:
    """(term, kind, disclosure) of the terms at or above the threshold for a value or a kind; ``keyed`` has ``key``, ``text`` and ``base``."""
    copies = settle(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("copies")))
    total = copies.count()
    # a text of n rows counts 1 / n in each; sums are whole numbers but for rounding
    repeated = _sent(settle(copies.where("copies > 1")))
    words = keyed.join(repeated, "key", "left").select(
        (1 / F.coalesce("copies", F.lit(1))).alias("part"), F.explode(_words(_masked(F.col("text"), F.col("base")))).alias("term"))
    alone = settle(words.groupBy("term").agg(F.round(F.sum("part")).cast("bigint").alias("seen")))
    rows = settle(keyed.where(F.size("base") > 0).select(
        "key", F.array_distinct(F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["match"].alias("value")))).alias("held"),
        _context(F.col("text"), F.col("base")).alias("near")))
    limits = {"support": support, "generalise_at": generalise_at}
    kinds = kind_terms(rows.select("key", F.inline("near")), alone, total, **limits)
    values = value_terms(keyed, rows.select("key", F.inline("held")).distinct(), alone, total, **limits)
    return kinds.unionByName(values).groupBy("term", "kind").agg(F.max("disclosure").alias("disclosure"))


def find(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", support: int = SUPPORT,
         generalise_at: float = GENERALISE_AT) -> DataFrame:
    """(doc_id, row, base, terms) for every row: base spans, and term spans with their disclosure.

    ``row`` marks rows of equal id and text.
    """
    plain = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keyed = plain.withColumn("key", F.xxhash64("text")).withColumn("base", base_spans(F.col("text")))
    flagged = _sent(settle(disclosing_terms(keyed.drop("doc_id"), support=support, generalise_at=generalise_at)))
    marks = keyed.select("key", F.explode(_words(_masked(F.col("text"), F.col("base")))).alias("term")).join(flagged, "term") \
        .groupBy("key").agg(F.collect_set(F.struct("term", F.col("kind").alias("of"), "disclosure")).alias("marks"))
    terms = F.when(F.col("marks").isNotNull(), _places(_masked(F.col("text"), F.col("base")), F.col("marks")))
    return keyed.join(_sent(settle(marks)), "key", "left").select(
        "doc_id", row_key("doc_id", "text").alias("row"), "base", F.coalesce(terms, F.array().cast(PLACES)).alias("terms"))


def _flat(terms: Column) -> Column:
    """Term spans as plain spans, each place once."""
    return F.array_distinct(F.transform(terms, lambda t: F.struct(
        t["start"].alias("start"), t["end"].alias("end"), t["kind"].alias("kind"), t["match"].alias("match"))))


def report(docs: DataFrame, **options) -> DataFrame:
    """Counts per kind and digests of the spans, one row per document."""
    rows = find(docs, **options)
    order = (*KINDS, TERM)
    base = sp.in_order(F.col("base"), KINDS, True)
    return rows.select("doc_id", *[sp.how_many(F.col("base"), k).alias(f"n_{k}") for k in KINDS],
                       F.sha2(sp.written(base), 256).alias("base_sha256"),
                       sp.written(sp.in_order(F.concat("base", _flat(F.col("terms"))), order, True)).alias("spans"))


def sanitise(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", remove_at: float = REMOVE_AT,
             **options) -> DataFrame:
    """The input with base spans replaced by <kind>, and terms generalised to <kind> or removed."""
    row, base, terms = (unused(docs, name) for name in ("row", "base", "terms"))
    found = find(docs, doc_id=doc_id, text=text, **options).dropDuplicates(["row"]).select(
        F.col("row").alias(row), F.col("base").alias(base), F.col("terms").alias(terms))
    rows = docs.withColumn(row, row_key(doc_id, text)).join(found, row)
    spans = F.concat(
        F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                             F.concat(F.lit("<"), s["kind"], F.lit(">")).alias("by"))),
        F.transform(terms, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.when(
            t["disclosure"] >= remove_at, "").otherwise(F.concat(F.lit("<"), t["of"], F.lit(">"))).alias("by"))))
    return rows.withColumn(text, F.when(F.col(text).isNotNull(), sp.replaced(F.col(text), spans, lambda s: s["by"]))) \
        .select(*docs.columns)
