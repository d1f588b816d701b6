"""Pattern matches with their places, in DataFrame expressions only.

A span is a struct (start, end, kind, match): code points, end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SPAN = "array<struct<start:int,end:int,kind:string,match:string>>"


def none() -> Column:
    return F.array().cast(SPAN)


def find_all(text: Column, pattern: str, kind: str, may_hold: Column | None = None) -> Column:
    """Leftmost non-overlapping matches of ``pattern``, which never matches an empty string.

    ``split`` gives the text between the matches, so running lengths give the places.
    ``may_hold`` is a cheap condition without which there can be no match.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), none().alias("out"))

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.length(pair["gap"])
        end = begin + F.length(pair["hit"])
        span = F.struct(begin.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), pair["hit"].alias("match"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    placed = F.aggregate(F.zip_with(found, F.slice(between, 1, F.greatest(F.size(found), F.lit(1))),
                                    lambda hit, gap: F.struct(hit.alias("hit"), gap.alias("gap"))),
                         start, step, lambda state: state["out"])
    some = text.rlike(pattern) if may_hold is None else may_hold & text.rlike(pattern)
    return F.when(some, placed).otherwise(none())


def in_order(spans: Column, kinds: tuple[str, ...], by_kind_first: bool) -> Column:
    """Spans sorted by kind as listed then start, or by start then kind as listed."""
    rank = lambda s: F.array_position(F.array(*map(F.lit, kinds)), s["kind"])
    keyed = F.transform(spans, lambda s: F.struct(
        (rank(s) if by_kind_first else s["start"].cast("bigint")).alias("a"),
        (s["start"].cast("bigint") if by_kind_first else rank(s)).alias("b"), s.alias("s")))
    return F.transform(F.array_sort(keyed), lambda k: k["s"])


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def how_many(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def replaced(text: Column, spans: Column, by) -> Column:
    """Text with every span replaced by ``by(span)``; of overlapping spans the first to start speaks for all."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("a"), (-s["end"]).alias("b"), s.alias("s"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, k: Column) -> Column:
        s = k["s"]
        gap = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        return F.when(s["start"] >= state["at"], F.struct(
            s["end"].alias("at"), F.concat(state["out"], gap, by(s)).alias("out"))).otherwise(
            F.struct(F.greatest(state["at"], s["end"]).alias("at"), state["out"].alias("out")))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        ordered, start, step, lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text)))))


def blanked(text: Column, spans: Column) -> Column:
    """Text with every code point inside a span replaced by a space; places stay."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        begin, end = F.greatest(state["at"], s["start"]), F.greatest(state["at"], s["end"])
        gap = F.substring(text, state["at"] + 1, begin - state["at"])
        return F.struct(end.alias("at"), F.concat(state["out"], gap, F.repeat(F.lit(" "), end - begin)).alias("out"))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        ordered, start, step, lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text)))))


def moved(spans: Column, by: Column) -> Column:
    """Spans ``by`` code points further on."""
    return F.transform(spans, lambda s: F.struct((s["start"] + by).alias("start"), (s["end"] + by).alias("end"),
                                                 s["kind"].alias("kind"), s["match"].alias("match")))
