"""Text keys, format validators, keyword lookups and URL parts."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .scoring import col_of, holds, present

# Industry and country keyword maps; the first entry that hits wins.
INDUSTRY_KEYWORDS: dict[str, tuple[str, ...]] = {
    "technology": ("tech", "software", "ai", "artificial intelligence", "machine learning", "data", "cloud", "saas"),
    "healthcare": ("health", "medical", "pharma", "biotech", "healthcare", "medicine"),
    "finance": ("fintech", "finance", "banking", "payments", "crypto", "blockchain"),
    "ecommerce": ("ecommerce", "retail", "marketplace", "shopping", "online store"),
    "education": ("education", "edtech", "learning", "school", "university"),
    "energy": ("energy", "renewable", "solar", "wind", "clean energy"),
    "transportation": ("transport", "mobility", "logistics", "delivery", "autonomous"),
    "real_estate": ("real estate", "property", "housing", "construction"),
}
COUNTRY_KEYWORDS: dict[str, tuple[str, ...]] = {
    "united states": ("usa", "us", "united states", "america"),
    "canada": ("canada", "canadian"),
    "united kingdom": ("uk", "britain", "england", "united kingdom"),
    "germany": ("germany", "german"),
    "france": ("france", "french"),
    "australia": ("australia", "australian"),
    "singapore": ("singapore", "singaporean"),
    "india": ("india", "indian"),
    "china": ("china", "chinese"),
    "japan": ("japan", "japanese"),
}


def key_text(c: Column | str) -> Column:
    """Join key: trimmed and lower-cased."""
    return F.lower(F.trim(col_of(c)))


def digits(c: Column | str) -> Column:
    return F.regexp_replace(col_of(c), "[^0-9]", "")


def contains_any(c: Column | str, words: Sequence[str]) -> Column:
    value = col_of(c)
    return holds(reduce(or_, [value.contains(w) for w in words]))


def is_email(c: Column | str) -> Column:
    value = col_of(c)
    return holds(
        present(value)
        & value.like("%@%.%")
        & (F.length(value) <= 255)
        & ~value.contains("..")
        & ~value.startswith(".")
        & ~value.endswith(".")
    )


def is_phone(c: Column | str) -> Column:
    return holds(F.length(digits(c)).between(10, 15))


def is_domain(c: Column | str) -> Column:
    value = col_of(c)
    return holds(
        present(value)
        & value.contains(".")
        & ~value.endswith(".")
        & ~value.startswith(".")
        & (F.length(value) <= 253)
    )


def is_url(c: Column | str) -> Column:
    value = col_of(c)
    return holds(
        present(value)
        & (value.startswith("http://") | value.startswith("https://"))
        & (F.length(value) <= 2048)
    )


# The same four checks as SQL functions, for users who work in ``spark.sql``.
SQL_VALIDATORS: dict[str, str] = {
    "validate_email": "coalesce(v <> '' AND v LIKE '%@%.%' AND length(v) <= 255 AND NOT contains(v, '..')"
    " AND NOT startswith(v, '.') AND NOT endswith(v, '.'), false)",
    "validate_phone": "coalesce(length(regexp_replace(v, '[^0-9]', '')) BETWEEN 10 AND 15, false)",
    "validate_domain": "coalesce(v <> '' AND contains(v, '.') AND NOT endswith(v, '.')"
    " AND NOT startswith(v, '.') AND length(v) <= 253, false)",
    "validate_url": "coalesce(v <> '' AND (startswith(v, 'http://') OR startswith(v, 'https://'))"
    " AND length(v) <= 2048, false)",
}


def register_validators(spark: SparkSession) -> None:
    """Create the validators as temporary SQL functions (inlined by Catalyst)."""
    for name, body in SQL_VALIDATORS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(v STRING) RETURNS BOOLEAN RETURN {body}")


def keyword_lookup(
    c: Column | str, keywords: Mapping[str, Sequence[str]], whole_word: bool = False
) -> Column:
    """Label of the first map entry with a keyword in the text, '' if none.

    The default is plain substring search, so ``us`` also hits "industry";
    ``whole_word=True`` asks for word boundaries.
    """
    text = F.lower(col_of(c))
    hits = []
    for label, words in keywords.items():
        if whole_word:
            pattern = r"\b(" + "|".join(re.escape(w) for w in words) + r")\b"
            cond = holds(text.rlike(pattern))
        else:
            cond = contains_any(text, words)
        hits.append(F.when(cond, F.lit(label)))
    return F.coalesce(*hits, F.lit(""))


def name_guess(c: Column | str) -> Column:
    """First three capitalised words of more than two letters, lower-cased."""
    words = F.split(F.trim(col_of(c)), r"\s+")
    capital = F.filter(words, lambda w: w.rlike(r"^\p{Lu}") & (F.length(w) > 2))
    return F.lower(F.array_join(F.slice(capital, 1, 3), " "))


def word_jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of the word sets, 0 when either text is empty."""
    left = F.array_distinct(F.array_remove(F.split(F.trim(a), r"\s+"), ""))
    right = F.array_distinct(F.array_remove(F.split(F.trim(b), r"\s+"), ""))
    union = F.size(F.array_union(left, right))
    both = F.size(F.array_intersect(left, right))
    usable = (F.size(left) > 0) & (F.size(right) > 0)
    return F.coalesce(F.when(usable, both / union), F.lit(0.0))


def host_of(url: Column | str, strip_www: bool = False) -> Column:
    host = F.regexp_extract(col_of(url), r"https?://([^/]+)", 1)
    return F.regexp_replace(host, r"^www\.", "") if strip_www else host


def bare_domain(url: Column | str) -> Column:
    """URL text without scheme and ``www.``; the path, if any, stays."""
    return F.regexp_replace(col_of(url), r"https://|http://|www\.", "")


def word_count(c: Column | str) -> Column:
    """Pieces between white space once non-letters are blanked; 0 for null."""
    gaps = F.regexp_count(col_of(c), F.lit("[^a-zA-Z]+"))
    return F.coalesce(gaps + 1, F.lit(0))


def token_count(c: Column | str) -> Column:
    """Whitespace-separated tokens."""
    return F.regexp_count(col_of(c), F.lit(r"\S+"))
