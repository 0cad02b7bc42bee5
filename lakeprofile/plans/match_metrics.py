"""Match events and the daily match-quality metric (mean of top-10 scores)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scoring import ladder, present
from ..operators.aggregates import global_or_zero
from ..operators.ordering import top_n

# Top scores averaged, and the reported categories.
TOP = 10
CATEGORIES = [(0.8, "Excellent (0.8+)"), (0.6, "Good (0.6-0.8)"), (0.4, "Fair (0.4-0.6)")]
WORST = "Poor (<0.4)"
SCORES = ("final_score", "embedding_similarity", "ml_score")


def exact_mean(column: str) -> Column:
    """Mean of decimals, which does not depend on the order of the rows."""
    return F.avg(F.col(column).cast("decimal(20,10)")).cast("double")


def usable_shortlists(shortlists: DataFrame) -> DataFrame:
    """Rows with challenge and company; a missing score counts as 0."""
    kept = shortlists.where(present("challenge_id") & present("company_key"))
    return kept.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in SCORES})


def challenge_metrics(shortlists: DataFrame, row_id: str = "event_id") -> DataFrame:
    """Per day and challenge: counts, top-10 mean, means, extremes, deviation.

    The top-10 rows come from a separate narrow branch, because there Spark
    trims each task to ten rows per challenge before the shuffle; all other
    figures are plain aggregates with map-side combine.
    """
    keys = ["dt", "challenge_id"]
    rows = usable_shortlists(shortlists)
    best = top_n(
        rows.select(*keys, "final_score", row_id), keys, [F.col("final_score").desc(), F.col(row_id).asc()], TOP
    )
    ams = best.groupBy(*keys).agg(exact_mean("final_score").alias("ams_challenge"))
    stats = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_shortlists"),
        exact_mean("embedding_similarity").alias("avg_embedding_similarity"),
        exact_mean("ml_score").alias("avg_ml_score"),
        F.max("final_score").alias("top_score"),
        F.min("final_score").alias("min_score"),
        F.stddev_pop("final_score").alias("score_std"),
    )
    return stats.join(ams, keys)


def overall_metrics(challenges: DataFrame) -> DataFrame:
    """Per day: counts and the mean of the per-challenge means."""
    return challenges.groupBy("dt").agg(
        F.count(F.lit(1)).alias("total_challenges"),
        F.sum("total_shortlists").alias("total_shortlists"),
        exact_mean("ams_challenge").alias("avg_ams_challenge"),
        exact_mean("avg_embedding_similarity").alias("avg_embedding_similarity"),
        exact_mean("avg_ml_score").alias("avg_ml_score"),
    )


def since(df: DataFrame, start: str, end: str | None = None) -> DataFrame:
    out = df.where(F.col("dt") >= start)
    return out if end is None else out.where(F.col("dt") <= end)


def daily_trend(overall: DataFrame, start: str) -> DataFrame:
    return since(overall, start).groupBy("dt").agg(exact_mean("avg_ams_challenge").alias("overall_avg_ams")).orderBy("dt")


def daily_change(overall: DataFrame) -> DataFrame:
    """Change to the day before; one row per day, so one window is enough."""
    by_day = Window.orderBy("dt")
    previous = F.lag("avg_ams_challenge").over(by_day)
    return overall.withColumn("prev_avg_ams", previous).withColumn(
        "ams_change", F.col("avg_ams_challenge") - F.col("prev_avg_ams")
    )


def top_challenges(challenges: DataFrame, start: str, min_days: int = 7, n: int = 10) -> DataFrame:
    """Best challenges by mean daily metric with enough days measured."""
    means = since(challenges, start).groupBy("challenge_id").agg(
        F.round(exact_mean("ams_challenge"), 9).alias("avg_ams"), F.count(F.lit(1)).alias("days_measured")
    )
    enough = means.where(F.col("days_measured") >= min_days)
    return enough.orderBy(F.col("avg_ams").desc(), F.col("challenge_id").asc()).limit(n)


def distribution(challenges: DataFrame, start: str) -> DataFrame:
    category = ladder("ams_challenge", CATEGORIES, WORST)
    return (
        since(challenges, start)
        .groupBy(category.alias("performance_category"))
        .agg(F.count(F.lit(1)).alias("challenge_count"))
    )


def events_by_type(events: DataFrame, start: str) -> DataFrame:
    return since(events, start).groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"))


def average_scores(events: DataFrame, start: str) -> DataFrame:
    """Mean scores per challenge; here missing scores are left out."""
    return since(events, start).groupBy("challenge_id").agg(*[F.avg(c).alias(f"avg_{c}") for c in SCORES])


def high_scores(events: DataFrame, start: str, above: float = 0.8) -> DataFrame:
    return (
        since(events, start)
        .where(F.col("final_score") > above)
        .select("challenge_id", "company_key", "final_score", "created_at")
        .orderBy(F.col("final_score").desc())
    )


def challenge_events(events: DataFrame, challenge: str, start: str) -> DataFrame:
    return since(events, start).where(F.col("challenge_id") == challenge).orderBy(F.col("created_at").desc())


def run_averages(health: DataFrame, matches: DataFrame) -> DataFrame:
    """Mean health and similarity of a run, 0 when nothing ran."""
    similarity = matches.agg(global_or_zero(F.col("embedding_similarity"), "avg_similarity")).scalar()
    number = matches.agg(F.count(F.lit(1)).alias("matches")).scalar()
    domains = health.agg(global_or_zero(F.col("health_score"), "avg_health_score"), F.count(F.lit(1)).alias("domains"))
    return domains.select("*", similarity.alias("avg_similarity"), number.alias("matches"))
