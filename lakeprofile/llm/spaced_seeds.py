"""Benchmark decontamination with spaced seeds.

A mask looks at some word positions of a window and ignores the others, so a
replaced word on an ignored position does not hide a copy.  Every window of
every whole document and of every benchmark item is digested under each mask;
equal digests are hits.  Around a hit the two texts are laid over each other and
the stretches (matching word +1, other word -3, from a match on while the sum is
above 0) are measured; a document is contaminated by an item when at least
``min_overlap`` words of any stretch match, or all words of a shorter item.  No hit
is kept without that check.  Reported is the part with the highest sum or, if too
few of its words match, the one with the most matching words.

Words are runs of letters and digits in lower case; in scripts written without
blanks every letter is a word.  Items with fewer words than the shortest mask are
looked up whole: all their words must follow each other, so an item of one word
matches every document with that word.  Items without words, null and empty texts
never match.
Null ids are ids like any other; equal rows get equal results; empty tables give
an empty result.  Only ids and texts are read.

The digests of the benchmark are counted first: up to ``broadcast_seeds`` of
them (24 bytes each: digest, item, its length, place) travel to the documents, which are
then not shuffled; beyond that both sides are joined by shuffle.  No window carries
words: hits are reduced to one row per document, item and alignment (counted, and
broadcast up to the same number of rows), and only then are the words of both looked
up.  Both ways give the same rows.  Work grows with the length of a text and of an
item, times the alignments on which they share a window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import doc_rows, text_key, whole

#: 1: the word counts, 0: it is ignored.
MASKS = ("11011011", "111001011", "10110010101")
NO_TERM = r"[^\p{L}\p{N}]+"
NO_BLANKS = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsBopomofo}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"


def word_digests(text: Column) -> Column:
    apart = F.when(text.rlike(NO_BLANKS), F.regexp_replace(text, f"({NO_BLANKS})", " $1 ")).otherwise(text)
    words = F.filter(F.split(F.lower(apart), NO_TERM), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def window_digests(words: Column, at: Column, masks: Sequence[str]) -> Column:
    """One digest per mask of the window that begins at ``at``; null where it does not fit."""
    out = []
    for number, mask in enumerate(masks):
        seen = [words[at + i] for i, c in enumerate(mask) if c == "1"]
        out.append(F.when(at + len(mask) <= F.size(words), F.xxhash64(F.lit(number), *seen)))
    return F.array(*out)


def windows(rows: DataFrame, masks: Sequence[str]) -> DataFrame:
    """Columns of the row but ``words``, ``at`` and ``seed`` of every window of its array ``words``.

    ``outer``, since Spark would otherwise split every text once more to look for empty ones beforehand.
    """
    kept = [c for c in rows.columns if c != "words"]
    placed = rows.select("*", F.posexplode_outer("words").alias("at", "_word")).drop("_word")
    return placed.select(*kept, "at", F.explode(window_digests(F.col("words"), F.col("at"), masks)).alias("seed")).where(F.col("seed").isNotNull())


def whole_items(texts: DataFrame, items: DataFrame, broadcast_seeds: int) -> DataFrame:
    """Documents that hold all words of an item one after another, as ``contaminated`` gives them; for short items."""
    lengths = sorted(r.n for r in items.select(F.size("words").alias("n")).distinct().collect())  # fewer than the shortest mask has places
    run = lambda at, n: F.when(at + n <= F.size("words"), F.xxhash64(F.lit(n), *[F.col("words")[at + i] for i in range(n)]))
    sized = F.coalesce(*[F.when(F.size("words") == n, run(F.lit(0), n)) for n in lengths], F.lit(None).cast("long"))
    seeds = items.select(sized.alias("seed"), "item_id", F.col("words").alias("item_words"))
    placed = texts.select("*", F.posexplode_outer("words").alias("at", "_word")).drop("_word")
    piece = lambda n: F.struct(run(F.col("at"), n).alias("seed"), F.slice("words", F.col("at") + 1, n).alias("words"))
    there = placed.select("doc_id", "_key", "at", F.explode(F.array(*[piece(n) for n in lengths])).alias("w"))
    there = there.select("doc_id", "_key", "at", "w.*").where(F.col("seed").isNotNull())
    hits = there.join(F.broadcast(seeds) if items.count() <= broadcast_seeds else seeds, "seed")
    size = F.size("item_words")
    same = hits.where(F.col("words") == F.col("item_words"))
    found = same.groupBy("doc_id", "_key", "item_id", size.cast("long").alias("n")).agg(F.min("at").cast("long").alias("at"))
    longest = found.groupBy("doc_id", "_key", "item_id").agg(F.max(F.struct("n", (-F.col("at")).alias("f"))).alias("b"))
    return longest.select("doc_id", "_key", "item_id", F.col("b.n").alias("matched_words"), F.col("b.n").alias("overlap_words"), (-F.col("b.f")).alias("first_word"))


def best_stretch(same: Column, least: Column) -> Column:
    """Of an array of matches, the stretch with the highest score if ``least`` of its words match, else the one with the
    most matching words: its words, matching words and start."""

    def step(s: Column, hit: Column) -> Column:
        score = F.when(hit, s["score"] + 1).otherwise(s["score"] - 3)
        lives = score > 0
        start = F.when(s["score"] > 0, s["start"]).otherwise(s["at"])
        hits = F.when(s["score"] > 0, s["hits"]).otherwise(0) + F.when(hit, 1).otherwise(0)
        better = lives & (score > s["top"])
        fuller = lives & (hits > s["most"])
        return F.struct(
            (s["at"] + 1).alias("at"), F.when(lives, score).otherwise(0).alias("score"), start.alias("start"), F.when(lives, hits).otherwise(0).alias("hits"),
            F.when(better, score).otherwise(s["top"]).alias("top"), F.when(better, s["at"] + 1 - start).otherwise(s["words"]).alias("words"),
            F.when(better, hits).otherwise(s["matched"]).alias("matched"), F.when(better, start).otherwise(s["first"]).alias("first"),
            F.when(fuller, hits).otherwise(s["most"]).alias("most"), F.when(fuller, s["at"] + 1 - start).otherwise(s["most_words"]).alias("most_words"),
            F.when(fuller, start).otherwise(s["most_first"]).alias("most_first"),
        )

    def chosen(s: Column) -> Column:
        top = F.struct(s["words"].alias("words"), s["matched"].alias("matched"), s["first"].alias("first"))
        fullest = F.struct(s["most_words"].alias("words"), s["most"].alias("matched"), s["most_first"].alias("first"))
        return F.when(s["matched"] >= least, top).otherwise(fullest)

    names = ("at", "score", "start", "hits", "top", "words", "matched", "first", "most", "most_words", "most_first")
    return F.aggregate(same, F.struct(*[F.lit(0).alias(n) for n in names]), step, chosen)


def contaminated(docs: DataFrame, benchmark: DataFrame, masks: Sequence[str] = MASKS, min_overlap: int = 10, broadcast_seeds: int = 1_000_000) -> DataFrame:
    """(doc_id, _key, item_id, matched_words, overlap_words, first_word) of the verified overlaps."""
    shortest = min(map(len, masks))
    given = benchmark.select("item_id", word_digests(whole("text")).alias("words")).where(F.size("words") > 0).dropDuplicates()
    items, short = given.where(F.size("words") >= shortest), given.where(F.size("words") < shortest)
    # two items under one number would both be laid over the text
    numbered = items.select("item_id", "words", F.xxhash64("item_id", "words").alias("_item"), F.size("words").alias("_n"))
    count = items.agg(F.coalesce(F.sum(F.size("words")), F.lit(0)).alias("n")).first()["n"] * len(masks)
    light = lambda rows, n: F.broadcast(rows) if n <= broadcast_seeds else rows
    seeds = windows(numbered.select("_item", "_n", "words"), masks).withColumnRenamed("at", "item_at")
    read = doc_rows(docs).withColumn("_key", text_key(F.col("text")))
    texts = read.select("doc_id", "_key", word_digests(F.col("text")).alias("words"))
    hits = windows(texts, masks).join(light(seeds, count), "seed")
    aligned = cut_lineage(hits.select("doc_id", "_key", "_item", "_n", (F.col("at") - F.col("item_at")).alias("_shift")).distinct())
    spots = light(aligned.withColumnsRenamed({"doc_id": "_doc", "_key": "_text_key"}), aligned.count())
    met = read.join(spots, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_text_key")))
    before, other = F.greatest("_shift", F.lit(0)), F.greatest(-F.col("_shift"), F.lit(0))
    mine = F.slice(word_digests(F.col("text")), before + 1, F.col("_n") - other)
    cut = met.select("doc_id", "_key", "_item", "_n", before.alias("_before"), other.alias("_other"), mine.alias("mine"))
    laid_over = cut.join(light(numbered, count), ["_item", "_n"])
    theirs = F.slice("words", F.col("_other") + 1, F.size("mine"))
    each = laid_over.select("doc_id", "_key", "item_id", "_before", "_n", "mine", theirs.alias("theirs"))
    same = F.zip_with("mine", "theirs", lambda a, b: a == b)
    least = F.least(F.lit(min_overlap), F.col("_n"))
    laid = each.select("doc_id", "_key", "item_id", "_before", least.alias("_least"), best_stretch(same, least).alias("s"))
    good = laid.where(F.col("s.matched") >= F.col("_least"))
    best = lambda m, w, f: F.max(F.struct(m.alias("m"), w.alias("w"), (-f).alias("f"))).alias("b")
    top = good.groupBy("doc_id", "_key", "item_id").agg(best(F.col("s.matched"), F.col("s.words"), F.col("_before") + F.col("s.first")))
    found = top.select("doc_id", "_key", "item_id", F.col("b.m").cast("long").alias("matched_words"), F.col("b.w").cast("long").alias("overlap_words"), (-F.col("b.f")).cast("long").alias("first_word"))
    if short.isEmpty():
        return found
    # an id with a long and a short text counts once, as it does with two long ones
    both = found.unionByName(whole_items(texts, short, broadcast_seeds)).groupBy("doc_id", "_key", "item_id")
    top = both.agg(best(F.col("matched_words"), F.col("overlap_words"), F.col("first_word")))
    return top.select("doc_id", "_key", "item_id", F.col("b.m").alias("matched_words"), F.col("b.w").alias("overlap_words"), (-F.col("b.f")).alias("first_word"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **settings: int) -> DataFrame:
    """Documents without a verified overlap; all columns."""
    found = contaminated(docs, benchmark, **settings).select(F.col("doc_id").alias("_doc"), F.col("_key").alias("_text_key")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    on = F.col("_row.doc_id").eqNullSafe(F.col("_doc")) & (text_key(whole(F.col("_row.text"))) == F.col("_text_key"))
    return rows.join(found, on, "left_anti").select("_row.*")
