"""Row-scoring vocabulary: weighted presence, completeness, ladders and flags.

Weights are summed as whole hundredths and divided once, so a score that should
be exactly 0.8 compares as 0.8; adding doubles would give 0.7999999999999999.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def present(c: Column | str) -> Column:
    """Not null and not the empty string."""
    c = col_of(c)
    return c.isNotNull() & (c != F.lit(""))


def all_present(*cols: Column | str) -> Column:
    return reduce(and_, [present(c) for c in cols])


def has_items(c: Column | str) -> Column:
    """Array with at least one element; null counts as empty."""
    return F.coalesce(F.size(col_of(c)) > 0, F.lit(False))


def holds(cond: Column) -> Column:
    """Condition with null read as false, as a CASE branch does."""
    return F.coalesce(cond, F.lit(False))


def weighted_score(terms: Iterable[tuple[Column, float]]) -> Column:
    """Sum of the weights whose condition holds, as double in [0, total]."""
    points = [F.when(cond, F.lit(round(w * 100))).otherwise(F.lit(0)) for cond, w in terms]
    return reduce(add, points) / F.lit(100.0)


def completeness(conds: Sequence[Column]) -> Column:
    """Share of conditions that hold."""
    hits = [F.when(c, F.lit(1)).otherwise(F.lit(0)) for c in conds]
    return reduce(add, hits) / F.lit(float(len(conds)))


def ladder(c: Column | str, steps: Sequence[tuple[float, str]], default: str) -> Column:
    """First label whose lower threshold is reached; ``steps`` go downwards."""
    value = col_of(c)
    return first_match([(value >= F.lit(t), F.lit(label)) for t, label in steps], F.lit(default))


def upper_ladder(c: Column | str, steps: Sequence[tuple[float, str]], default: str) -> Column:
    """First label whose upper bound is not exceeded; ``steps`` go upwards."""
    value = col_of(c)
    return first_match([(value <= F.lit(t), F.lit(label)) for t, label in steps], F.lit(default))


def first_match(cases: Sequence[tuple[Column, Column]], default: Column) -> Column:
    """CASE: value of the first condition that holds."""
    (cond, value), *rest = cases
    out = F.when(cond, value)
    for cond, value in rest:
        out = out.when(cond, value)
    return out.otherwise(default)


def no_strings() -> Column:
    return F.array().cast("array<string>")


def first_flag(cases: Sequence[tuple[Column, str]]) -> Column:
    """Array with the first flag that applies, or an empty string array."""
    return first_match([(c, F.array(F.lit(f))) for c, f in cases], no_strings())


def every_flag(cases: Sequence[tuple[Column, str]]) -> Column:
    """Array of all flags that apply, in the given order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(f)) for c, f in cases]))


def verdict(cond: Column, yes: str, no: str) -> Column:
    return F.when(cond, F.lit(yes)).otherwise(F.lit(no))
