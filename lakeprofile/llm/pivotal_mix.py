"""Mixing sources to target weights by pivotal dependent rounding.

A source's target is its share of all words by weight, at most ``most`` times its
own words; what a full source leaves is shared again by weight until none is
above (targets are ``min(most * size, level * weight)`` with one common level).
A document is taken ``target / source size`` times: the whole part for certain,
the fraction by chance, so that the fractions of a source add up.

Chance: the fractional copies of documents next to each other in size, the long ones first, meet in
pairs.  Of a pair one takes mass from the other, at random but with the expected
value kept, until one of them is 0 or 1; the other goes on to meet the next.  A
source is dealt into chunks of about ``chunk_rows`` documents by a digest; each
chunk leaves at most one fractional document, and these meet again, ``fan_in`` at
a time, level by level, until one per source is left, which is then drawn.  The
taken words of a source miss its target by about one document, not by a random
walk over all of them.

All draws come from a digest of seed, source and chunk over documents in a fixed
order, so reruns agree.  Null text has size 0; the null source is a source, last
in order; a null ``doc_id`` is an id like any other; equal rows are drawn each on
its own; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from ..session import cut_lineage, ship_package
from .common import split_words, text_key, whole

WEIGHTS = (5.0, 2.0, 1.0)  # in order of the sources, repeating
ROW = "doc_id long, key long, source string, size long, source_size long, target double, whole long, chance double, chunk long, open boolean"


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``key`` (digest of the text), ``source``, ``size`` in words."""
    text = whole("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(text).alias("key"), F.col("source"), F.size(split_words(text)).cast("long").alias("size"))


def targets(rows: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = 3.0) -> DataFrame:
    """One row per source: documents, words and target words.

    Rows are sources here, not documents, so the windows over all of them are small.
    """
    sources = rows.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(place, F.lit(len(weights))) + 1)
    ranked = sources.withColumn("weight", weight).withColumn("full", F.lit(most) * F.col("source_size"))
    everything = Window.partitionBy(F.lit(0))
    by_need = Window.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    upto, onward = by_need.rowsBetween(Window.unboundedPreceding, -1), by_need.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = F.coalesce(F.sum("full").over(upto), F.lit(0.0))
    used = F.coalesce(F.sum("weight").over(onward), F.lit(0.0)) - F.col("weight")
    total, all_weights = F.sum("source_size").over(everything), F.sum("weight").over(everything)
    # the level if exactly the sources before this one were full; it rises until the first source
    # that stays below its limit and falls from there on
    level = (total - filled) / (all_weights - used)
    common = ranked.withColumn("_each", level).withColumn("_level", F.max("_each").over(everything))
    return common.select("source", "docs", "source_size", F.least("full", F.col("_level") * F.col("weight")).alias("target"))


def draws(seed: int, source: object, place: str, n: int) -> np.ndarray:
    text = f"{seed}|{'' if source is None else 's' + str(source)}|{place}"
    return np.random.default_rng(int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little")).random(n)


def pivot(chance: np.ndarray, luck: np.ndarray) -> np.ndarray:
    """Chances after all pairs have met in order; all but one are 0 or 1."""
    out, held = chance.tolist(), -1
    for i, b in enumerate(out):
        if b <= 0.0 or b >= 1.0:
            continue
        if held < 0:
            held = i
            continue
        a, u = out[held], luck[i]
        if a + b < 1.0:  # one gives all it has
            if u * (a + b) < a:
                out[held], out[i] = a + b, 0.0
            else:
                out[held], out[i], held = 0.0, a + b, i
        else:  # one is filled up
            rest = a + b - 1.0
            if u * (2.0 - a - b) < 1.0 - b:
                out[held], out[i], held = 1.0, rest, i
            else:
                out[held], out[i] = rest, 1.0
        last = out[held]
        if last < 1e-12 or last > 1 - 1e-12:
            out[held], held = float(round(last)), -1
    return np.array(out)


def drawn(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = 3.0, chunk_rows: int = 2_000, fan_in: int = 16, seed: int = 17) -> DataFrame:
    """Every row of ``sized`` with ``source_size``, ``target`` and whole ``copies``."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = cut_lineage(sized(docs))
    # a marker instead of the null source lets sources meet by plain equality
    named = rows.withColumn("source", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")))
    goal = targets(rows, weights, most)
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(F.lit(0.0))
    goal = goal.select(
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("source"), "source_size", "target", F.floor(rate + 1e-12).cast("long").alias("whole"),
        F.greatest(rate - F.floor(rate + 1e-12), F.lit(0.0)).alias("chance"), F.ceil(F.col("docs") / chunk_rows).cast("long").alias("chunks"),
    )
    # equal rows count as one until they are dealt to the chunks, and are dealt in blocks
    equal = named.groupBy("doc_id", "key", "source", "size").agg(F.count(F.lit(1)).alias("rows"))
    rated = lookup_join(equal, cut_lineage(goal), "source", spread=["doc_id", "key"])
    blocks = rated.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / chunk_rows)))).repartition("doc_id", "key", "block")
    begin = F.col("block") * chunk_rows
    dealt = blocks.withColumn("copy", F.explode(F.sequence(begin, F.least(begin + chunk_rows, F.col("rows")) - 1)))
    chunk = F.pmod(F.xxhash64("doc_id", "key", "copy"), F.col("chunks"))
    start = dealt.select("doc_id", "key", "source", "size", "source_size", "target", "whole", "chance", chunk.alias("chunk"), F.lit(True).alias("open"))

    def meet(level: int, only: bool):
        def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values(["size", "doc_id", "key", "chunk"], ascending=[False, True, True, True], kind="stable", na_position="first").reset_index(drop=True)
            chance = pivot(frame["chance"].to_numpy(), draws(seed, key[0], f"{level}/{key[1]}", len(frame)))
            fraction = (chance > 0.0) & (chance < 1.0)
            if only and fraction.any():  # the last one of its source
                at = np.flatnonzero(fraction)
                chance[at] = (draws(seed, key[0], "last", len(at)) < chance[at]).astype(float)
                fraction[:] = False
            return frame.assign(chance=chance, chunk=key[1], open=fraction)

        return run

    largest = goal.agg(F.coalesce(F.max("chunks"), F.lit(1)).alias("n")).first()["n"]
    levels = max(1, math.ceil(math.log(max(largest, 1), fan_in) - 1e-9) + 1)
    done, open_rows = [], start
    for level in range(levels):
        if level:
            open_rows = open_rows.withColumn("chunk", F.floor(F.col("chunk") / fan_in))
        met = cut_lineage(open_rows.groupBy("source", "chunk").applyInPandas(meet(level, level == levels - 1), ROW))
        done.append(met.where(~F.col("open")))
        open_rows = met.where("open")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    source = F.when(F.col("source") == "", F.lit(None).cast("string")).otherwise(F.expr("substring(source, 2)"))
    return out.select("doc_id", "key", source.alias("source"), "size", "source_size", "target", (F.col("whole") + F.col("chance").cast("long")).alias("copies"))


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, **settings: float) -> DataFrame:
    """Every document as often as it was drawn; all columns."""
    per_text = drawn(docs, **settings).groupBy("doc_id", "key", "source").agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
    picked = per_text.where("_copies > 0").select(F.col("doc_id").alias("_doc"), F.col("key").alias("_key"), F.col("source").alias("_source"), "_copies", "_rows")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(row, F.col("doc_id").cast("long").alias("_id"), text_key(whole("text")).alias("_text_key"), F.col("source").alias("_from"))
    on = F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_text_key") == F.col("_key")) & F.col("_from").eqNullSafe(F.col("_source"))
    joined = rows.join(picked, on)
    # equal rows share their copies out
    place = F.row_number().over(Window.partitionBy("_doc", "_key", "_source").orderBy("_rows"))
    numbered = joined.withColumn("_place", F.when(F.col("_rows") > 1, place).otherwise(1))
    own = F.floor(F.col("_copies") / F.col("_rows")) + F.when(F.col("_place") <= F.col("_copies") % F.col("_rows"), 1).otherwise(0)
    counted = numbered.withColumn("_times", own.cast("int")).where("_times > 0")
    return counted.select("_row", F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("_copy")).select("_row.*")
