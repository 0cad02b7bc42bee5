"""Fields of raw JSON records: one parse per record, typed by ``try_cast``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scoring import col_of


def text_schema(fields: Sequence[str], arrays: Sequence[str] = ()) -> T.StructType:
    """Schema of string fields and string arrays; ``a.b`` nests one level."""
    top: dict[str, list[str] | None] = {}
    for field in fields:
        head, _, tail = field.partition(".")
        if tail:
            inner = top.setdefault(head, [])
            inner.append(tail)
        else:
            top[head] = None
    out = T.StructType()
    for name, inner in top.items():
        kind = T.StringType() if inner is None else text_schema(inner)
        out.add(name, kind)
    for name in arrays:
        out.add(name, T.ArrayType(T.StringType()))
    return out


def scalar(value: Column) -> Column:
    """Scalar text only: an object or array yields null."""
    return F.when(~value.rlike(r"^\s*[\[{]"), value)


def json_scalar(raw: Column | str, path: str) -> Column:
    return scalar(F.get_json_object(col_of(raw), path))


def json_strings(raw: Column | str, path: str) -> Column:
    return F.from_json(F.get_json_object(col_of(raw), path), "array<string>")


def typed(columns: Mapping[str, Column], types: Mapping[str, str]) -> dict[str, Column]:
    """Apply ``try_cast`` where a type is asked for; dirty text becomes null."""
    return {name: c.try_cast(types[name]) if name in types else c for name, c in columns.items()}
