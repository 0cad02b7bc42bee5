"""Incremental processing: watermarks, deltas, upserts, budgets and quotas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import all_present
from ..session import cut_lineage
from .joins import probe_join
from .ordering import keep_first, running_totals


def default_watermark(as_of: str, days: int = 7) -> Column:
    """Where a first run starts: ``days`` before ``as_of``."""
    return F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAYS")


def delta_read(
    df: DataFrame,
    watermark: Column,
    updated_at: str = "updated_at",
    required: Sequence[str] = (),
    page_size: int | None = None,
    tie_breaker: Sequence[str] = (),
) -> DataFrame:
    """Rows changed after the watermark with the required texts present.

    ``page_size`` takes the oldest rows first, as a bounded work page.
    """
    changed = df.where(F.col(updated_at) > watermark)
    if required:
        changed = changed.where(all_present(*required))
    if page_size is not None:
        changed = changed.orderBy(F.col(updated_at).asc(), *tie_breaker).limit(page_size)
    return changed


def watermark_advance(processed: DataFrame, watermark: Column, updated_at: str = "updated_at") -> DataFrame:
    """One row: newest processed timestamp, never behind the old watermark."""
    return processed.agg(F.greatest(watermark, F.max(updated_at)).alias("watermark"))


def newest_stored(stored: DataFrame, key: str, values: Sequence[str], at: str) -> DataFrame:
    """One row per key: the ``values`` stored last (a row without a time counts as oldest; of equal times the largest values)."""
    newest = F.max(F.struct(F.col(at).isNotNull(), F.col(at), F.struct(*values).alias("v")))["v"]
    return stored.groupBy(key).agg(newest.alias("_v")).select(key, *[F.col(f"_v.{v}").alias(v) for v in values])


def changed_rows(current: DataFrame, previous: DataFrame, key: str, new_hash: str, old_hash: str, at: str) -> DataFrame:
    """Rows that are new or whose content hash differs from the one stored last.

    ``previous`` may hold every hash a key ever had; content that went from A to B and back is changed.
    """
    known = newest_stored(previous, key, [old_hash], at).select(F.col(key).alias("_key"), F.col(old_hash).alias("_old"))
    return current.join(known, (F.col(key) == F.col("_key")) & F.col(new_hash).eqNullSafe(F.col("_old")), "left_anti")


def lookback(df: DataFrame, ts: str, as_of: str, interval: str, inclusive: bool = True) -> DataFrame:
    """Rows of the last ``interval`` (for example ``'7' DAY``) before ``as_of``."""
    start = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {interval}")
    return df.where(F.col(ts) >= start if inclusive else F.col(ts) > start)


def upsert_latest(
    current: DataFrame, updates: DataFrame, key: str, updated_at: str, tie_breaker: Sequence[str] = ()
) -> DataFrame:
    """Latest row per key of both sides; replaying the same updates is harmless."""
    order = [F.col(updated_at).desc(), *[F.col(t).desc() for t in tie_breaker]]
    return keep_first(current.unionByName(updates, allowMissingColumns=True), [key], order)


def ttl_alive(df: DataFrame, expires_at: str, now: Column) -> DataFrame:
    return df.where(F.col(expires_at) >= now)


def cache_misses(work: DataFrame, cache: DataFrame, keys: Sequence[str], expires_at: str, now: Column) -> DataFrame:
    """Work items without an unexpired cache entry."""
    valid = cache.where(F.col(expires_at) > now).select(*keys)
    return probe_join(work, valid.distinct(), keys, "left_anti")


def evict_oldest(
    df: DataFrame, created_at: str, tie_breaker: Sequence[str], threshold: int, share: float = 0.2
) -> DataFrame:
    """Drop the oldest ``share`` of the rows once there are ``threshold`` or more."""
    narrow = df.select(created_at, *tie_breaker)
    order = [F.col(created_at).asc(), *[F.col(t).asc() for t in tie_breaker]]
    placed = running_totals(narrow, order, "_age").drop(created_at)
    total = df.agg(F.count(F.lit(1)).alias("_total")).scalar()
    limit = F.when(total >= threshold, F.floor(total * F.lit(share))).otherwise(F.lit(0))
    evicted = placed.where(F.col("_age") <= limit).select(*tie_breaker)
    return df.join(evicted, list(tie_breaker), "left_anti")


def budget_gate(
    df: DataFrame, key: Sequence[str], order_by: Sequence[Column], cost: Column, budget: float, max_items: int | None = None
) -> DataFrame:
    """Rows admitted in order while the spend before them is under budget.

    A row passes when its own cost still fits and, if the caller gives an item
    cap, that is not reached.
    Costs are summed as decimals, so the cut does not depend on sum order.
    """
    exact = cost.cast("decimal(28,10)")
    running = running_totals(df, order_by, "item_no", {"running_cost": exact})
    admitted = F.col("running_cost") <= F.lit(str(budget)).cast("decimal(28,10)")
    if max_items is not None:
        admitted = admitted & (F.col("item_no") <= max_items)
    return running.withColumn("admitted", admitted)


def batch_assign(df: DataFrame, order_by: Sequence[Column], size: int) -> DataFrame:
    """Number rows in order and put every ``size`` of them into one batch."""
    numbered = running_totals(df, order_by, "row_no")
    return numbered.withColumn("batch_no", F.floor((F.col("row_no") - 1) / F.lit(size)).cast("long"))


# Calls allowed per window.
API_QUOTAS: dict[str, int] = {"1 minute": 50, "1 hour": 200, "1 day": 600}


def quota_windows(calls: DataFrame, ts: str, quotas: Mapping[str, int] = API_QUOTAS) -> DataFrame:
    """Calls per aligned window and whether they exceed the quota.

    The log is shuffled once at minute grain; the wider windows add up minutes.
    """
    minutes = calls.groupBy(F.window(ts, "1 minute").start.alias("minute")).agg(
        F.count(F.lit(1)).alias("calls")
    )
    return widths_of(minutes, quotas)


def widths_of(minutes: DataFrame, quotas: Mapping[str, int] = API_QUOTAS) -> DataFrame:
    """Windows of each width from ``calls`` per ``minute``."""
    parts = []
    for width, limit in quotas.items():
        per = minutes.groupBy(F.window("minute", width).start.alias("window_start")).agg(
            F.sum("calls").alias("calls")
        )
        parts.append(
            per.select(
                F.lit(width).alias("width"),
                "window_start",
                "calls",
                F.lit(limit).alias("quota"),
                (F.col("calls") > limit).alias("over_limit"),
            )
        )
    out, *rest = parts
    for p in rest:
        out = out.unionByName(p)
    return out
