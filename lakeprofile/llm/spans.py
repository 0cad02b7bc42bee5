"""Positions of pattern matches as Spark expressions.

A span is (kind, start, end, value): code points, end exclusive.  The pieces
between the matches and the matches themselves alternate, so a running length
over both gives every position in one pass over the row's own arrays.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<kind:string,start:int,end:int,value:string>"


def none() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def match_spans(text: Column, pattern: str, kind: str, keep: Callable[[Column], Column] | None = None) -> Column:
    """Leftmost non-overlapping matches; those that fail ``keep`` are dropped without another try."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("hit"))

    def step(state: Column, part: Column) -> Column:
        hit = part["hit"]
        start = state["at"] + F.length(part["gap"])
        end = start + F.coalesce(F.length(hit), F.lit(0))
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), hit.alias("value"))
        wanted = hit.isNotNull() if keep is None else hit.isNotNull() & keep(hit)
        spans = F.when(wanted, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    empty = F.struct(F.lit(0).alias("at"), none().alias("spans"))
    return F.when(text.rlike(pattern), F.aggregate(parts, empty, step, lambda s: s["spans"])).otherwise(none())


def overlaps(span: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (o["start"] < span["end"]) & (span["start"] < o["end"]))


def blanked(text: Column, spans: Column) -> Column:
    """Text with as many blanks in the place of every span, so that all positions stay."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))

    def step(state: Column, s: Column) -> Column:
        begin, end = F.greatest(state["at"], s["start"]), F.greatest(state["at"], s["end"])
        piece = F.concat(F.substring(text, state["at"] + 1, begin - state["at"]), F.repeat(F.lit(" "), end - begin))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(piece)).alias("out"))

    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(ordered, empty, step, lambda s: F.concat(F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.length(text))))


def listed(spans: Column, kinds: Sequence[str], start_first: bool = False) -> Column:
    """``kind:start:end`` of all spans, comma-joined, by kind as listed and start, or by start first."""

    def keyed(s: Column) -> Column:
        rank = F.array_position(F.array(*[F.lit(k) for k in kinds]), s["kind"]).cast("int")
        lead = (s["start"], rank) if start_first else (rank, s["start"])
        return F.struct(lead[0].alias("a"), lead[1].alias("b"), s["end"].alias("e"), F.concat_ws(":", s["kind"], s["start"], s["end"]).alias("t"))

    return F.array_join(F.transform(F.array_sort(F.transform(spans, keyed)), lambda s: s["t"]), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def replaced(text: Column, spans: Column, label: Callable[[Column], Column]) -> Column:
    """Text with every span put in other words; of overlapping spans the first, then longest, counts."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value"))))

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        piece = F.concat(F.substring(text, state["at"] + 1, s["start"] - state["at"]), label(s))
        return F.struct(
            F.when(fresh, s["end"]).otherwise(F.greatest(state["at"], s["end"])).alias("at"),
            F.when(fresh, F.concat(state["out"], F.array(piece))).otherwise(state["out"]).alias("out"),
        )

    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(ordered, empty, step, lambda s: F.concat(F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.length(text))))
