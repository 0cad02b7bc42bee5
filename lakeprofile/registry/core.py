"""Registration, inputs, and the text of the SQL checks."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bindings import BINDINGS, TABLES

AS_OF = "2024-01-31"
START = "2024-01-01"

Query = Callable[["Inputs"], DataFrame]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
KNOWN: dict[str, dict[str, str]] = {}  # the named results as they stood when a query was registered


class Inputs:
    """Given tables and the inputs bound to them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._seen: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._seen:
            self._seen[name] = self._load(name)
        return self._seen[name]

    def _load(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        sql = BINDINGS[name]
        needs = {n: self[n] for n in set(re.findall(r"\{(\w+)\}", sql))}
        return self.spark.sql(sql, **needs)

    def raw_json(self, name: str) -> DataFrame:
        """The binding packed as JSON text, as a raw record arrives."""
        return self[name].select(F.to_json(F.struct("*")).alias("raw_json"))


def shared(build: Query) -> Query:
    """Build an intermediate frame once per set of inputs (a plan, not data)."""

    @functools.wraps(build)
    def once(inp: Inputs) -> DataFrame:
        name = f"{build.__module__}.{build.__name__}"
        if name not in inp._seen:
            inp._seen[name] = build(inp)
        return inp._seen[name]

    return once


def with_ctes(sql: str, library: dict[str, str]) -> str:
    """Prefix the CTEs a query text refers to, dependencies first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b[bo]_\w+\b", text):
            if name in library and name not in order:
                visit(library[name])
                order.append(name)

    visit(sql)
    ctes = ",\n".join(f"{n} AS ({library[n]})" for n in order)
    return f"WITH {ctes}\n{sql}" if order else sql


LIBRARY: dict[str, str] = {n: re.sub(r"\{(\w+)\}", r"\1", s) for n, s in BINDINGS.items()}


def cte(name: str, sql: str) -> None:
    """Add a named intermediate result of the SQL checks."""
    LIBRARY[name] = sql


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, its check."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return flat(build(Inputs(spark, folder)))

        run.__name__, run.__doc__ = name, build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
            KNOWN[name] = dict(LIBRARY)
        return build

    return register


def oracles() -> dict[str, str]:
    """Every check with the named results it was written with; a name that is used again later means another one there."""
    return {name: with_ctes(sql, {**LIBRARY, **KNOWN[name]}) for name, sql in ORACLES.items()}


def plain(c: Column, kind: T.DataType) -> Column:
    """Comparable form: rounded doubles, texts for times and arrays."""
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.round(c.cast("double"), 6)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    if isinstance(kind, T.DateType):
        return c.cast("string")
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
        return F.array_join(c, "|", "")
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.to_json(c)
    if isinstance(kind, (T.ShortType, T.ByteType)):
        return c.cast("int")
    return c


def flat(df: DataFrame) -> DataFrame:
    """Nested columns spread out and every value in comparable form."""
    columns = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StructType):
            for inner in field.dataType.fields:
                value = F.col(f"`{field.name}`.`{inner.name}`")
                columns.append(plain(value, inner.dataType).alias(f"{field.name}_{inner.name}"))
        else:
            columns.append(plain(F.col(f"`{field.name}`"), field.dataType).alias(field.name))
    return df.select(*columns)


# The published grades, levels and size brackets.  A label holds from its bound up to the next one;
# the first label also stands for a missing value, unless the caller gives another.
SIZE_BRACKETS = [(None, "startup"), (11, "small"), (51, "medium"), (201, "large"), (1001, "enterprise")]
SIZE_CATEGORIES = [(None, "Unknown"), (1, "Startup"), (11, "Small"), (51, "Medium"), (201, "Large")]
REVENUE_STAGES = [(None, "Early Stage"), (1_000_000, "Growth Stage"), (10_000_001, "Mature")]
STARTUP_STAGES = [(None, "mvp"), (11, "growth"), (51, "scale"), (201, "mature")]
HEALTH_GRADES = [(None, "F"), (0.6, "D"), (0.7, "C"), (0.8, "B"), (0.9, "A")]
SCORE_GRADES = [(None, "F"), (0.2, "D"), (0.4, "C"), (0.6, "B"), (0.8, "A")]
RISK_LEVELS = [(None, "critical"), (0.4, "high"), (0.6, "medium"), (0.8, "low")]
CONFIDENCE_LEVELS = [(None, "low"), (0.6, "medium"), (0.8, "high")]
QUALITY_LEVELS = [(None, "VERY_LOW"), (0.4, "LOW"), (0.6, "MEDIUM"), (0.8, "HIGH")]
HEALTH_LEVELS = [(None, "POOR"), (0.4, "FAIR"), (0.6, "GOOD"), (0.8, "EXCELLENT")]
READINESS_LEVELS = [(None, "NOT_READY"), (0.4, "NEEDS_WORK"), (0.6, "NEARLY_READY"), (0.8, "READY")]
MATCH_LEVELS = [(None, "Poor (<0.4)"), (0.4, "Fair (0.4-0.6)"), (0.6, "Good (0.6-0.8)"), (0.8, "Excellent (0.8+)")]
PARTITION_SIZES = [(None, "EMPTY"), (1, "LOW"), (100, "NORMAL"), (1000, "HIGH"), (10000, "VERY_HIGH")]
READABILITY = [(None, 0.4), (101, 0.6), (501, 0.8), (1001, 1.0), (5000, 0.8), (10000, 0.6)]


def step_of(value: str, steps: Sequence[tuple[float | None, object]], missing: str | None = None) -> str:
    """SQL: range lookup of a value in a table of (lower bound, label) in ascending order."""
    labels = ", ".join(repr(label) for _, label in steps)
    bounds = ", ".join(str(bound) for bound, _ in steps[1:])
    found = f"([{labels}])[1 + len(list_filter([{bounds}]::DOUBLE[], lambda bound: ({value}) >= bound))]"
    return found if missing is None else f"if(({value}) IS NULL, '{missing}', {found})"


def num(*names: str) -> str:
    """SQL: columns as doubles rounded like ``plain``; ``expr AS name`` works too."""
    out = []
    for n in names:
        expr, _, alias = n.rpartition(" AS ") if " AS " in n else (n, "", n)
        out.append(f"round(CAST({expr} AS DOUBLE), 6) AS {alias}")
    return ", ".join(out)


def fixed(*names: str) -> str:
    """SQL: like ``num``, with half-way cases decided on fourteen decimals instead of a double's last bit."""
    out = []
    for n in names:
        expr, _, alias = n.rpartition(" AS ") if " AS " in n else (n, "", n)
        out.append(f"CAST(round(CAST({expr} AS DECIMAL(30,14)), 6) AS DOUBLE) AS {alias}")
    return ", ".join(out)


def joined(*names: str) -> str:
    """SQL: lists joined by ``|``; an empty list is an empty text."""
    out = []
    for n in names:
        expr, _, alias = n.rpartition(" AS ") if " AS " in n else (n, "", n)
        out.append(f"CASE WHEN {expr} IS NULL THEN NULL ELSE coalesce(array_to_string({expr}, '|'), '') END AS {alias}")
    return ", ".join(out)


def stamp(*names: str) -> str:
    """SQL: timestamps as text to the second."""
    out = []
    for n in names:
        expr, _, alias = n.rpartition(" AS ") if " AS " in n else (n, "", n)
        out.append(f"strftime({expr}, '%Y-%m-%d %H:%M:%S') AS {alias}")
    return ", ".join(out)


def points(*terms: tuple[str, float]) -> str:
    """SQL: weighted presence score."""
    return "(" + " + ".join(f"CASE WHEN {c} THEN {w} ELSE 0 END" for c, w in terms) + ")"


def share(*conds: str) -> str:
    return "((" + " + ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END" for c in conds) + f") / {len(conds)}.0)"


def given(*columns: str) -> list[str]:
    return [f"{c} IS NOT NULL" for c in columns]


def filled(c: str) -> str:
    return f"({c} IS NOT NULL AND {c} <> '')"
