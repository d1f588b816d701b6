"""Secret scans: known patterns, and sliding-window entropy per character class.

Everything is a DataFrame expression. Besides the base patterns a candidate is a
run of at least ``WINDOW`` characters of tokens (letters, digits, + / _ = -) in what
the base spans leave of the text. A run is made of segments, which = and / part; a
segment that the allow list matches is taken out, and what is left of the run on
either side is judged by itself where it still has ``WINDOW`` characters.

Every candidate has a class, the first of ``CLASSES`` that fits it. A window of
``WINDOW`` characters slides over the candidate; entering and leaving characters
change the counts and the sum of c*log2(c) by one step each, which gives every
window's Shannon entropy. A candidate whose highest window reaches its class's bound
is reported as ``entropy``. Digits alone cannot reach theirs: every long number would.

Rows: every input row gives one row; a null text counts as empty and has no spans;
repeated rows are repeated; an empty table gives an empty one; long texts are read
whole. Base spans of two kinds may overlap, entropy spans overlap none. Only the id
and text columns are read; ``redact`` keeps all columns, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from . import spans as sp
from .rows import unused

KINDS = ("assign", "access", "hex")
ENTROPY = "entropy"
#: The base patterns. The possessive forms match the same strings, without retries.
KEY = "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?"
VALUE = "[A-Za-z0-9+/_.=-]+"
ASSIGN = KEY + VALUE
ACCESS = "AKIA[A-Z0-9]{12,}+"
HEX = "(?<![0-9a-f])[0-9a-f]{32,}+"

WINDOW = 20
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: A run of token characters whose first one does not part segments.
CANDIDATE = f"(?<![A-Za-z0-9+_-])[A-Za-z0-9+_-][A-Za-z0-9+/_=-]{{{WINDOW - 1},}}+"
SEGMENT = "[^=/]++"
#: A letter beside a digit.
_CHANGE = "[0-9][A-Za-z]|[A-Za-z][0-9]"
#: Class, what its strings look like, and the least entropy in bits of a window (20 different characters have 4.32).
CLASSES = (
    ("digits", "^[0-9]+$", 3.33),
    ("hex", "^(?=.*[0-9])(?=.*[a-fA-F])[0-9a-fA-F]+$", 3.0),
    ("lower", "^(?=.*[0-9])(?=.*[a-z])[a-z0-9]+$", 3.5),
    ("upper", "^(?=.*[0-9])(?=.*[A-Z])[A-Z0-9]+$", 3.5),
    ("mixed", "^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z]).+$", 3.8),
    ("signed", f"^(?:(?:(?!{_CHANGE}).)*+(?:{_CHANGE})){{4}}", 3.7),
    ("letters", "^[A-Za-z]+$", 3.9),
    ("other", "^", 4.1),
)
ALLOWED = (
    "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    "(?i)example|placeholder|changeme|dummy|sample",
    "(?i)0123456789|abcdefgh|x{6,}",
    "^sha(?:1|256|384|512)-",
)


def _keep_assign(s: Column) -> Column:
    return F.length(F.regexp_extract(s["match"], f"^{KEY}({VALUE})$", 1)) >= 8


def base_spans(text: Column) -> Column:
    return F.concat(F.filter(sp.find_all(text, ASSIGN, "assign"), _keep_assign),
                    sp.find_all(text, ACCESS, "access", F.contains(text, F.lit("AKIA"))),
                    sp.find_all(text, HEX, "hex"))


def window_entropy(candidate: Column) -> Column:
    """Highest Shannon entropy, in bits, of the candidate's windows, by incremental counts."""
    clog = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 1)])
    codes = F.transform(F.filter(F.split(candidate, ""), lambda c: c != ""),
                        lambda c: F.instr(F.lit(ALPHABET), c))
    pairs = F.zip_with(codes, F.concat(F.array_repeat(F.lit(0), WINDOW), codes),
                       lambda new, old: F.struct(new.alias("new"), old.alias("old")))
    pairs = F.filter(pairs, lambda p: p["new"].isNotNull())
    start = F.struct(F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"), F.lit(0.0).alias("sum"),
                     F.lit(0).alias("n"), F.lit(0.0).alias("best"))

    def step(state: Column, p: Column) -> Column:
        counts, new, old = state["counts"], p["new"], p["old"]
        leaves = old > 0
        without = F.transform(counts, lambda c, i: F.when(leaves & (i == old - 1), c - 1).otherwise(c))
        less = F.when(leaves, clog[F.get(counts, old - 1)] - clog[F.get(counts, old - 1) - 1]).otherwise(0.0)
        before = F.get(counts, new - 1) - F.when(leaves & (old == new), 1).otherwise(0)
        total = state["sum"] - less + clog[before + 1] - clog[before]
        n = F.least(state["n"] + 1, F.lit(WINDOW))
        entropy = F.when(n == WINDOW, F.log2(n.cast("double")) - total / n).otherwise(0.0)
        return F.struct(F.transform(without, lambda c, i: F.when(i == new - 1, c + 1).otherwise(c)).alias("counts"),
                        total.alias("sum"), n.alias("n"), F.greatest(state["best"], entropy).alias("best"))

    return F.aggregate(pairs, start, step, lambda state: state["best"])


def is_random(candidate: Column) -> Column:
    """True if the entropy bound of the candidate's class is reached."""
    bound = F.lit(None).cast("double")
    for _, pattern, least in reversed(CLASSES):
        bound = F.when(candidate.rlike(pattern), least).otherwise(bound)
    return window_entropy(candidate) >= bound


def is_allowed(segment: Column) -> Column:
    benign = F.lit(False)
    for pattern in ALLOWED:
        benign = benign | segment.rlike(pattern)
    return benign


def _parts(run: Column) -> Column:
    """What is left of a run without its allowed segments, as spans of the text."""
    allowed = F.filter(sp.find_all(run["match"], SEGMENT, ENTROPY), lambda s: is_allowed(s["match"]))
    left = F.when(F.size(allowed) == 0, F.array(run)).otherwise(sp.moved(
        sp.find_all(sp.blanked(run["match"], allowed), CANDIDATE, ENTROPY), run["start"]))
    return F.when(is_allowed(run["match"]) | run["match"].rlike("[=/]"), left).otherwise(F.array(run))


def _found(rows: DataFrame, text: Column, base: str, more: str) -> DataFrame:
    """Adds the columns ``base`` and ``more``: base spans and entropy spans."""
    rows = rows.withColumn(base, base_spans(text))
    rows = rows.withColumn(more, sp.blanked(text, F.col(base)))
    rows = rows.withColumn(more, sp.find_all(F.col(more), CANDIDATE, ENTROPY))
    parts = F.flatten(F.transform(F.col(more), _parts))
    return rows.withColumn(more, F.when(F.size(more) == 0, sp.none()).otherwise(F.filter(parts, lambda c: is_random(c["match"]))))


def scan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The input's id and text with ``base`` and ``found`` (base and entropy spans, by start, then kind)."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = _found(rows, F.col("text"), "base", "more")
    order = (*KINDS, ENTROPY)
    return rows.select("doc_id", "text", sp.in_order(F.col("base"), order, False).alias("base"),
                       sp.in_order(F.concat("base", "more"), order, False).alias("found"))


def report(docs: DataFrame, **columns: str) -> DataFrame:
    """Counts per kind and digests of the spans, one row per document."""
    rows = scan(docs, **columns)
    return rows.select("doc_id", *[sp.how_many(F.col("base"), k).alias(f"n_{k}") for k in KINDS],
                       F.sha2(sp.written(F.col("base")), 256).alias("base_sha256"), sp.written(F.col("found")).alias("spans"))


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The input with every found secret replaced by ``mark``; columns and null texts stay."""
    base, more = unused(docs, "base"), unused(docs, "more")
    held = _found(docs, F.coalesce(F.col(text), F.lit("")), base, more)
    return held.withColumn(text, F.when(F.col(text).isNotNull(), sp.replaced(F.col(text), F.concat(base, more), lambda s: F.lit(mark)))) \
        .select(*docs.columns)
