"""Masking and hashing of personal data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scoring import col_of, present
from .text import digits, key_text


def stars(n: Column) -> Column:
    return F.repeat(F.lit("*"), F.greatest(F.lit(1), n))


def mask_tail(c: Column | str) -> Column:
    """First letter, then one star per hidden letter (at least one)."""
    value = col_of(c)
    return F.concat(F.substring(value, 1, 1), stars(F.length(value) - 1))


def mask_name(c: Column | str) -> Column:
    return F.when(present(c), mask_tail(c))


def mask_email(c: Column | str) -> Column:
    """Local part masked, domain kept; null when there is no ``@``."""
    parts = F.split(col_of(c), "@")
    masked = F.concat(mask_tail(F.get(parts, F.lit(0))), F.lit("@"), F.get(parts, F.lit(1)))
    return F.when(present(c), masked)


def mask_phone(c: Column | str) -> Column:
    """First and last three characters kept."""
    value = col_of(c)
    size = F.length(value)
    tail = value.substr(size - 2, F.lit(3))
    return F.when(present(value), F.concat(F.substring(value, 1, 3), stars(size - 6), tail))


def match_hash(c: Column | str) -> Column:
    """MD5 of the normalised text: equal people match without being readable."""
    return F.md5(key_text(c))


def phone_hash(c: Column | str) -> Column:
    return F.md5(digits(c))


def short_sha(c: Column | str) -> Column:
    """First 16 hex digits of SHA-256."""
    return F.substring(F.sha2(col_of(c), 256), 1, 16)


def masking_state(c: Column | str) -> Column:
    value = col_of(c)
    return (
        F.when(value.contains("*"), F.lit("MASKED"))
        .when(value.isNotNull(), F.lit("NOT_MASKED"))
        .otherwise(F.lit("NO_DATA"))
    )
