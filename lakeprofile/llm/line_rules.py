"""Line-first quality rules.

Every line of a text is judged alone; lines that fail are taken out; a document
that loses more than ``max_lost`` of its text goes as a whole.  Document-wide
rules (too few words, repeated word windows) are checked beside that.

A line fails as
* punctuation: exclamation marks on half of its words, or more than a tenth of
  its characters are symbols, or a fragment of under ``fragment_words`` words
  without a closing mark;
* navigation: at least three separators with three words or fewer around each;
* boilerplate: a stock phrase in a line of under ``phrase_words`` words, a line
  of ten or more words of which under three tenths are different, or a line
  that stood in the text before.
Blank lines count for nothing.

Everything is computed from the arrays of the row itself, without a shuffle.
Null text counts as empty (no words, so not kept); a null ``doc_id`` is passed
on; equal rows get equal results; an empty table gives an empty result.  Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, doc_rows, split_words

SYMBOLS = "#*$%&|<>"
#: Stock phrases of pages that are no part of a text.
PHRASES = (
    "all rights reserved", "accept cookies", "cookie policy", "privacy policy", "terms of use", "terms of service", "enable javascript",
    "click here", "subscribe to", "sign in", "log in", "read more", "share this", "lorem ipsum", "powered by", "permission is hereby granted",
)
CLOSED = r"[.!?…:;\"'”’»)\]。！？][\x20\x09-\x0D]*$"
SEPARATORS = "|»›•·>"


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def line_parts(line: Column) -> Column:
    """What several rules ask of a line, worked out once."""
    return F.struct(line.alias("line"), F.size(split_words(line)).alias("n"), F.length(without(line, BLANKS)).alias("chars"), F.lower(line).alias("plain"))


def line_faults(part: Column, fragment_words: int, phrase_words: int) -> Column:
    """Name of the rule the line breaks, or null."""
    line, n, length, plain = part["line"], part["n"], part["chars"], part["plain"]
    shouts = F.length(line) - F.length(without(line, "!"))
    symbols = F.length(line) - F.length(without(line, SYMBOLS))
    bars = F.length(line) - F.length(without(line, SEPARATORS))
    phrase = F.lit(False)
    for p in PHRASES:
        phrase = phrase | plain.contains(p)
    return (
        F.when((shouts >= 3) & (shouts * 2 >= n), "punctuation")
        .when((bars >= 3) & (n - bars <= 3 * (bars + 1)), "navigation")
        .when(symbols * 10 > length, "punctuation")
        .when((n < fragment_words) & ~line.rlike(CLOSED), "punctuation")
        .when((n < phrase_words) & phrase, "boilerplate")
        .when((n >= 10) & (F.size(F.array_distinct(split_words(line))) * 10 < 3 * n), "boilerplate")
    )


def placed_windows(windows: Column) -> Column:
    """Digests of the windows with their places, equal ones side by side; empty where all differ."""
    none = F.array().cast("array<struct<g:bigint,i:int>>")
    placed = F.sort_array(F.transform(windows, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), placed).otherwise(none)


def repeated_words(placed: Column) -> Column:
    """Words in three-word windows that occur twice or more."""
    paired = F.zip_with(placed, F.concat(F.slice(placed, 2, F.size(placed)), F.array(F.lit(None).cast("struct<g:bigint,i:int>"))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    twice = F.filter(paired, lambda p: p["a"]["g"] == p["b"]["g"])
    starts = F.array_distinct(F.flatten(F.transform(twice, lambda p: F.array(p["a"]["i"], p["b"]["i"]))))
    covered = F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2))))
    return F.when(F.size(placed) > 0, F.size(covered)).otherwise(0)


def measure_lines(docs: DataFrame, min_words: int = 50, max_repeat_percent: int = 50, max_lost: float = 0.5, fragment_words: int = 10, phrase_words: int = 30) -> DataFrame:
    """One row per document: word and line measures, the cleaned text, and whether the document stays."""
    text = F.col("text")
    split = doc_rows(docs).select("doc_id", "text", split_words(text).alias("words"), F.filter(F.split(text, "\n", -1), lambda s: F.btrim(s, F.lit(BLANKS)) != "").alias("lines"))
    n = F.size("words")
    digests = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.col("words")[i], F.col("words")[i + 1], F.col("words")[i + 2]))
    empty = F.array().cast("array<bigint>")
    first = F.array_distinct("lines")
    with_windows = split.select("*", F.when(n >= 3, digests).otherwise(empty).alias("windows"), F.size("lines").alias("n_lines"), F.size(first).alias("n_first"), F.transform(F.transform(first, line_parts), lambda j: F.struct(j["line"].alias("line"), j["chars"].alias("chars"), line_faults(j, fragment_words, phrase_words).alias("fault"))).alias("judged"))
    with_places = with_windows.select("*", placed_windows(F.col("windows")).alias("placed"))
    good = F.filter("judged", lambda j: j["fault"].isNull())
    word_chars = F.length(without(text, BLANKS))
    clean_chars = F.aggregate(good, F.lit(0), lambda a, j: a + j["chars"])
    measured = with_places.select(
        "doc_id", n.cast("long").alias("n_words"), word_chars.cast("long").alias("word_chars"),
        (F.length(text) - F.length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        (F.col("n_lines") - F.col("n_first")).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("placed")).cast("long").alias("n_repeat_words"),
        clean_chars.cast("long").alias("clean_chars"),
        (F.col("n_lines") - F.size(good)).cast("long").alias("n_removed_lines"),
        F.array_join(F.transform(good, lambda j: j["line"]), "\n").alias("clean_text"),
    )
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    stays = (F.col("word_chars") - F.col("clean_chars")) <= max_lost * F.col("word_chars")
    return measured.select("*", failed.alias("base_failed"), (~failed & stays).alias("kept"))


COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "clean_chars", "n_removed_lines")


def cleaned(docs: DataFrame, **settings: float) -> DataFrame:
    """``doc_id`` and ``text`` without the failing lines, of the documents that stay."""
    return measure_lines(docs, **settings).where("kept").select("doc_id", F.col("clean_text").alias("text"))


def oracle(min_words: int = 50, max_repeat_percent: int = 50, max_lost: float = 0.5, fragment_words: int = 10, phrase_words: int = 30) -> str:
    """The same measures in DuckDB's SQL."""
    blank = r"[ \t\n\x0b\x0c\r]"
    phrases = " OR ".join(f"contains(lower(line), '{p}')" for p in PHRASES)
    symbols = r"[#*$%&|<>]"
    closed = CLOSED.replace("'", "''").replace(r"[\x20\x09-\x0D]", blank)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '{blank}+'), lambda x: x <> '') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, '{blank}', '', 'g') <> '') AS lines FROM d),
wnd AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
        FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 2)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM wnd) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY doc_id),
ln AS (SELECT DISTINCT doc_id, unnest(lines) AS line FROM w),
m AS (SELECT doc_id, line, length(regexp_replace(line, '{blank}', '', 'g')) AS chars,
             list_filter(regexp_split_to_array(line, '{blank}+'), lambda x: x <> '') AS ws,
             length(regexp_replace(line, '[^!]', '', 'g')) AS shouts, length(line) - length(regexp_replace(line, '{symbols}', '', 'g')) AS symbols,
             len(regexp_split_to_array(line, '[{SEPARATORS}]')) - 1 AS bars FROM ln),
f AS (SELECT doc_id, chars, (shouts >= 3 AND shouts * 2 >= len(ws)) OR (bars >= 3 AND len(ws) - bars <= 3 * (bars + 1)) OR symbols * 10 > chars
             OR (len(ws) < {fragment_words} AND NOT regexp_matches(line, '{closed}')) OR (({phrases}) AND len(ws) < {phrase_words})
             OR (len(ws) >= 10 AND len(list_distinct(ws)) * 10 < 3 * len(ws)) AS bad FROM m),
c AS (SELECT doc_id, count(*) AS n_first, sum(CASE WHEN bad THEN 0 ELSE chars END) AS clean, sum(CASE WHEN bad THEN 0 ELSE 1 END) AS good FROM f GROUP BY doc_id),
r AS (SELECT w.doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '{blank}', '', 'g'))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '{symbols}', '', 'g')))::BIGINT AS n_symbols, (len(lines) - coalesce(n_first, 0))::BIGINT AS n_dup_lines,
             coalesce(cov.n, 0)::BIGINT AS n_repeat_words, coalesce(clean, 0)::BIGINT AS clean_chars, (len(lines) - coalesce(good, 0))::BIGINT AS n_removed_lines
      FROM w LEFT JOIN cov USING (doc_id) LEFT JOIN c USING (doc_id)),
b AS (SELECT *, n_words < {min_words} OR 100 * n_repeat_words > {max_repeat_percent} * n_words AS base_failed FROM r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars - clean_chars <= {max_lost} * word_chars AS kept, clean_chars, n_removed_lines FROM b"""
