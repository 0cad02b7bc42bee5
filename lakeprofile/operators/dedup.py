"""Duplicate handling: survivors, marks, and near-equal names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import key_text
from ..session import cut_lineage
from .joins import probe_join
from .ordering import keep_first


def union_sources(*sources: DataFrame) -> DataFrame:
    """UNION ALL by name; a column missing in one source is a typed null."""
    out, *rest = sources
    for df in rest:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def mark_duplicates(
    df: DataFrame,
    key: str,
    group_value: str,
    order_by: Sequence[Column],
    row_id: Sequence[str],
    reason: str,
) -> DataFrame:
    """Keep all rows and tell the survivor of each ``key`` from its duplicates.

    The survivor is found on narrow rows first (at most one per key and map
    task is shuffled) and joined back; the rows of a hot key are dealt to
    several tasks there instead of meeting in one window.
    """
    winners = keep_first(df, [key], order_by).select(
        key,
        F.col(group_value).alias("duplicate_group_id"),
        F.struct(*row_id).alias("_winner"),
    )
    marked = probe_join(df.where(F.col(key).isNotNull()), winners, key, "inner")
    first = F.struct(*row_id) == F.col("_winner")
    return (
        marked.withColumn("is_primary_record", first)
        .withColumn("duplicate_reason", F.when(~first, F.lit(reason)))
        .drop("_winner")
    )


def survivors_by_link(df: DataFrame, key: str, link: str) -> DataFrame:
    """One row per non-blank ``link`` (smallest key); rows without it all stay."""
    value = F.lower(F.trim(F.col(link)))
    linked = value.isNotNull() & (value != "")
    chosen = keep_first(
        df.where(linked).withColumn("_link", value), ["_link"], [F.col(key).asc()]
    ).drop("_link")
    return chosen.unionByName(df.where(~F.coalesce(linked, F.lit(False))))


def name_labels(df: DataFrame, key: str, name: str) -> DataFrame:
    """Names with their smallest key, and the labels by which names one edit apart meet.

    A name is the exclusive or of two 64-bit hashes of each (place, letter), so a
    name without or with another letter at a place follows from running sums and
    costs the same for every place: rows and time are linear in the letters, and
    a row carries hashes only.  ``swap`` labels leave one place open and keep its
    number; names of equal length that differ there share one.  A ``drop`` label
    is the name without one letter and meets the ``whole`` label of a shorter name.
    """
    text = key_text(name)
    names = (
        df.where(F.col(name).isNotNull())
        .groupBy(F.md5(text).alias("_name"))
        .agg(F.min(key).alias("_min"), F.first(text).alias("_text"))
    )
    letters = names.select("_name", "_min", F.length("_text").alias("_size"), F.posexplode_outer(F.when(F.col("_text") != "", F.split("_text", ""))).alias("_at", "_letter"))
    hashed = ("_a", "_b")
    at = lambda shift, salt: F.coalesce(F.xxhash64(F.col("_at") - shift, F.col("_letter"), F.lit(salt)), F.lit(0).cast("long"))
    here = {f"{h}0": F.when(F.col("_letter").isNotNull(), at(0, h)).otherwise(F.lit(0).cast("long")) for h in hashed}
    before = {f"{h}1": F.when(F.col("_letter").isNotNull(), at(1, h)).otherwise(F.lit(0).cast("long")) for h in hashed}
    spots = letters.withColumns({**here, **before})
    each = Window.partitionBy("_name")  # the names are dealt by it already
    upto = each.orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = spots.withColumns(
        {
            **{f"{h}_all": F.bit_xor(f"{h}0").over(each) for h in hashed},
            **{f"{h}_to": F.bit_xor(f"{h}0").over(upto) for h in hashed},
            # letters behind the place, one place further on
            **{f"{h}_on": F.bit_xor(f"{h}1").over(each).bitwiseXOR(F.bit_xor(f"{h}1").over(upto)) for h in hashed},
        }
    )

    def label(kind: str, family: str, size: Column, place: Column, parts: list[Column]) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.lit(family).alias("family"), size.alias("size"), place.alias("place"), parts[0].alias("a"), parts[1].alias("b"))

    size, none = F.col("_size"), F.lit(-1)
    swap = label("swap", "swap", size, F.col("_at"), [F.col(f"{h}_all").bitwiseXOR(F.col(f"{h}0")) for h in hashed])
    drop = label("drop", "gap", size - 1, none, [F.col(f"{h}_to").bitwiseXOR(F.col(f"{h}0")).bitwiseXOR(F.col(f"{h}_on")) for h in hashed])
    whole = label("whole", "gap", size, none, [F.col(f"{h}_all") for h in hashed])
    own = F.when(F.col("_letter").isNull(), F.array(whole)).when(F.col("_at") == 0, F.array(swap, drop, whole)).otherwise(F.array(swap, drop))
    return sums.select("_name", "_min", F.explode(own).alias("_l")).select("_name", "_min", "_l.*").distinct()


LABEL = ("family", "size", "place", "a", "b")


def near_name_survivors(df: DataFrame, key: str, name: str) -> DataFrame:
    """Keys that stay when names at most one edit apart are merged.

    The names are taken in the order of their smallest keys; one goes if a name
    before it *that stays* is at most one edit away.  So of a chain in which each
    is near the next only, the first stays, the second goes and the third stays:
    nothing goes for the sake of a name that is gone itself.

    No pair is built.  Round by round, a name that no undecided name near it
    precedes stays, and the names near it go; both follow from the smallest key
    under each label.  Only labels with several holders matter, so the table that
    is worked on is small; there are as many rounds as names in the longest chain
    of ever larger keys, halved.
    """
    labels = cut_lineage(name_labels(df, key, name))
    shared = labels.groupBy(*LABEL).agg(F.count(F.lit(1)).alias("_holders")).where("_holders > 1").drop("_holders")
    open_rows = cut_lineage(labels.join(shared, list(LABEL), "left_semi"))
    alone = labels.select("_name", "_min").distinct().join(open_rows.select("_name").distinct(), "_name", "left_anti")
    stay = [alone.select("_min")]
    whole, drop = F.col("kind") != "drop", F.col("kind") == "drop"
    while not open_rows.isEmpty():
        # whole asks for drops, drop for wholes, swap for swaps
        least = open_rows.groupBy(*LABEL).agg(F.min(F.when(whole, F.col("_min"))).alias("_w"), F.min(F.when(drop, F.col("_min"))).alias("_d"))
        other = F.when(F.col("kind") == "whole", F.col("_d")).otherwise(F.col("_w"))
        nearest = open_rows.join(least, list(LABEL)).groupBy("_name", "_min").agg(F.min(other).alias("_near"))
        first = cut_lineage(nearest.where(F.coalesce(F.col("_min") <= F.col("_near"), F.lit(True))).select("_name", "_min"))
        stay.append(first.select("_min"))
        # labels of those that stay, as seen from the other side
        held = open_rows.join(first.select("_name"), "_name", "left_semi").select(*LABEL, "kind").distinct()
        asks = F.when(F.col("kind") == "whole", F.lit("drop")).when(F.col("kind") == "drop", F.lit("whole")).otherwise(F.lit("swap"))
        near = open_rows.join(held.select(*LABEL, asks.alias("kind")), [*LABEL, "kind"], "left_semi").select("_name")
        done = near.union(first.select("_name")).distinct()
        open_rows = cut_lineage(open_rows.join(done, "_name", "left_anti"))
    out, *rest = stay
    for part in rest:
        out = out.union(part)
    return out.select(F.col("_min").alias(key))


def survivors_by_near_name(df: DataFrame, key: str, name: str) -> DataFrame:
    """Rows whose name stays (``near_name_survivors``), and those without a name; keys are unique."""
    kept = df.join(near_name_survivors(df, key, name), key, "left_semi")
    return kept.unionByName(df.where(F.col(name).isNull()))
