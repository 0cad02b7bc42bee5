"""The evaluation record of scored models: one row per model, and its curves as tables of points.

Scored rows carry the model's name, so any number of models is evaluated in one
pass.  A curve has one point per distinct score; points are numbered from the
highest score down by a range-partitioned running count, so a model with most
rows is spread over many tasks.  Points inside a straight stretch say nothing and
are dropped (``drop_straight``): the area is the same, and a curve of a thousand
million scores is as long as its bends.  Curves stay tables, stored beside the
record; no row and no driver holds a whole one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import probe_join
from ..operators.ordering import running_totals, top_n
from ..session import cut_lineage
from .learning import TOP_FEATURES, classification_summary

MODEL = "model_name"
DAY = ("year", "month", "day", "run")
RECORD = (
    "evaluation_date string, model_name string, accuracy double, precision double, recall double, f1_score double, auc_score double, pr_auc_score double, "
    "cross_val_mean double, cross_val_std double, samples long, confusion_matrix string, top_features string, roc_points long, pr_points long"
)
ROC = "evaluation_date string, model_name string, step long, threshold double, fp long, tp long, fpr double, tpr double"
PR = "evaluation_date string, model_name string, step long, threshold double, tp long, said long, precision double, recall double"
PARTS = "year int, month int, day int, run string"
BLOCK = 4096


def exact(c: str | Column) -> Column:
    """A count as a decimal: products of two are exact."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,0)")


def threshold_points(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Per model and distinct score, highest first: true and false positives so far, and those of all rows."""
    counts = scored.groupBy(MODEL, F.col(score).alias("threshold")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.sum(1 - F.col(label).cast("long")).alias("neg")
    )
    points = running_totals(counts, [F.col("threshold").desc()], "step", {"tp": F.col("pos"), "fp": F.col("neg")}, partition_by=[MODEL])
    totals = counts.groupBy(MODEL).agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    found = probe_join(points, totals, MODEL, "inner")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("double")
    origin = totals.select(MODEL, none.alias("threshold"), *[zero.alias(c) for c in ("pos", "neg", "step", "tp", "fp")], "all_pos", "all_neg")
    return found.unionByName(origin)


def with_neighbours(points: DataFrame, carried: Sequence[str]) -> DataFrame:
    """``before`` and ``after``: the ``carried`` columns of the points next to each (null at the ends).

    Points are numbered without gaps in ``step``.  Blocks of steps make the
    windows, and the point at either edge of a block is lent to the next one.
    """
    own = F.floor(F.col("step") / BLOCK)
    edge = F.col("step") % BLOCK
    places = F.array_compact(F.array(own, F.when(edge == 0, own - 1), F.when(edge == BLOCK - 1, own + 1)))
    lent = points.withColumn("_block", F.explode(places)).withColumn("_own", F.col("_block") == own)
    window = Window.partitionBy(MODEL, "_block").orderBy("step")
    value = F.struct(*carried)
    return lent.withColumns({"before": F.lag(value).over(window), "after": F.lead(value).over(window)}).where("_own").drop("_block", "_own")


def drop_straight(points: DataFrame, carried: Sequence[str], straight: Callable[[str, str, str], Column]) -> DataFrame:
    """Points where the line bends, and both ends; renumbered."""
    near = with_neighbours(points.withColumn("_self", F.struct(*carried)), carried)
    middle = F.col("before").isNotNull() & F.col("after").isNotNull() & straight("before", "_self", "after")
    kept = near.where(~F.coalesce(middle, F.lit(False))).drop("before", "after", "_self").withColumnRenamed("step", "_old")
    numbered = running_totals(kept, [F.col("_old")], "step", partition_by=[MODEL])
    return numbered.withColumn("step", F.col("step") - 1).drop("_old")


def on_a_line(a: str, b: str, c: str) -> Column:
    """Three points (fp, tp) on one line, decided in whole numbers."""
    rise = lambda p, q, x: exact(F.col(f"{q}.{x}") - F.col(f"{p}.{x}"))
    return rise(a, b, "fp") * rise(b, c, "tp") == rise(b, c, "fp") * rise(a, b, "tp")


def level_or_upright(a: str, b: str, c: str) -> Column:
    """Three points (tp, hits / said) of equal recall, or of equal precision."""
    upright = (F.col(f"{a}.tp") == F.col(f"{b}.tp")) & (F.col(f"{b}.tp") == F.col(f"{c}.tp"))
    same = lambda p, q: exact(F.col(f"{p}.hits")) * exact(F.col(f"{q}.said")) == exact(F.col(f"{q}.hits")) * exact(F.col(f"{p}.said"))
    return upright | (same(a, b) & same(b, c))


def share(part: Column, of: Column) -> Column:
    return F.when(of > 0, part / of).otherwise(F.lit(0.0))


def roc_points(points: DataFrame, reduced: bool = True) -> DataFrame:
    """``fpr`` and ``tpr`` from the origin on."""
    rows = drop_straight(points, ["fp", "tp"], on_a_line) if reduced else points
    return rows.select(MODEL, "step", "threshold", "fp", "tp", share(F.col("fp"), F.col("all_neg")).alias("fpr"), share(F.col("tp"), F.col("all_pos")).alias("tpr"))


def pr_points(points: DataFrame, reduced: bool = True) -> DataFrame:
    """``precision`` and ``recall`` from (1, 0) on; ``said`` rows were called positive."""
    start = F.col("step") == 0
    rows = points.withColumns({"hits": F.when(start, 1).otherwise(F.col("tp")), "said": F.when(start, 1).otherwise(F.col("tp") + F.col("fp"))})
    if reduced:
        rows = drop_straight(rows, ["tp", "hits", "said"], level_or_upright)
    said = F.col("said").cast("long").alias("said")
    return rows.select(MODEL, "step", "threshold", "tp", said, (F.col("hits") / F.col("said")).alias("precision"), share(F.col("tp"), F.col("all_pos")).alias("recall"))


def roc_area(points: DataFrame) -> DataFrame:
    """Trapezoid area per model, summed in whole numbers: the same for a curve and its reduced form."""
    near = with_neighbours(points, ["fp", "tp"])
    strip = exact(F.col("fp") - F.col("before.fp")) * exact(F.col("tp") + F.col("before.tp"))
    sums = near.groupBy(MODEL).agg(F.sum(strip).alias("s"), F.max("fp").alias("n"), F.max("tp").alias("p"))
    area = F.col("s").cast("double") / (2.0 * F.col("n") * F.col("p"))
    return sums.select(MODEL, F.when((F.col("n") > 0) & (F.col("p") > 0), area).alias("auc_score"))


def pr_area(points: DataFrame) -> DataFrame:
    """Trapezoid area per model over recall; strips are summed as decimals, in any order the same."""
    near = with_neighbours(points, ["tp", "precision"])
    strip = (F.col("tp") - F.col("before.tp")) * (F.col("precision") + F.col("before.precision"))
    sums = near.groupBy(MODEL).agg(F.sum(strip.cast("decimal(38,14)")).alias("s"), F.max("tp").alias("p"))
    return sums.select(MODEL, F.when(F.col("p") > 0, F.col("s").cast("double") / (2.0 * F.col("p"))).alias("pr_auc_score"))


def fold_scores(scored: DataFrame, label: str, prediction: str, fold: str) -> DataFrame:
    """Mean and population deviation of the accuracy of the folds."""
    right = F.count_if(F.col(prediction) == F.col(label)) / F.count(F.lit(1))
    folds = scored.groupBy(MODEL, fold).agg(right.alias("a"))
    return folds.groupBy(MODEL).agg(F.avg("a").alias("cross_val_mean"), F.stddev_pop("a").alias("cross_val_std"))


def feature_text(weights: DataFrame, n: int = TOP_FEATURES) -> DataFrame:
    """The ``n`` largest weights of each model (``model_name``, ``feature``, ``weight``) as JSON text, largest first."""
    best = top_n(weights, [MODEL], [F.abs("weight").desc(), F.col("feature").asc()], n, rank="rank")
    entries = F.array_sort(F.collect_list(F.struct("rank", "feature", "weight")))  # n at most
    pairs = F.transform(entries, lambda e: F.struct(e["feature"].alias("key"), e["weight"].alias("value")))
    return best.groupBy(MODEL).agg(F.to_json(F.map_from_entries(pairs)).alias("top_features"))


def evaluate(scored: DataFrame, weights: DataFrame, at: str, label: str = "label", score: str = "score", prediction: str = "prediction", fold: str = "fold") -> dict[str, DataFrame]:
    """``record`` (a row per model), ``roc_curve`` and ``pr_curve`` of ``scored`` as of the time ``at``.

    ``label`` and ``prediction`` are 0 or 1; ``fold`` numbers the parts of a cross-validation.  A model without rows of
    both labels has no area under the ROC curve; one without positive rows none under the other.
    """
    counts = scored.groupBy(MODEL, F.col(label).cast("int").alias("actual"), F.col(prediction).cast("int").alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    cell = lambda a, p: F.coalesce(F.sum(F.when((F.col("actual") == a) & (F.col("predicted") == p), F.col("n"))), F.lit(0))
    matrix = counts.groupBy(MODEL).agg(F.to_json(F.array(*[F.array(cell(a, 0), cell(a, 1)) for a in (0, 1)])).alias("confusion_matrix"))
    points = cut_lineage(threshold_points(scored, label, score))
    roc, pr = cut_lineage(roc_points(points)), cut_lineage(pr_points(points))
    sizes = [c.groupBy(MODEL).agg(F.count(F.lit(1)).alias(name)) for c, name in ((roc, "roc_points"), (pr, "pr_points"))]
    rows = classification_summary(counts, [MODEL])
    for part in (roc_area(roc), pr_area(pr), fold_scores(scored, label, prediction, fold), matrix, feature_text(weights), *sizes):
        rows = rows.join(part, MODEL, "left")  # one row per model on both sides
    date = F.lit(at).alias("evaluation_date")
    columns = [f.split()[0] for f in RECORD.split(", ")][1:]
    return {"record": rows.select(date, *columns), "roc_curve": roc.select(date, "*"), "pr_curve": pr.select(date, "*")}


def write_evaluation(parts: dict[str, DataFrame], path: str) -> None:
    """JSON rows below ``record``, ``roc_curve`` and ``pr_curve``, in a folder per day and run.

    A run that is repeated replaces its own folders and no others.
    """
    when = F.to_timestamp("evaluation_date")
    folders = {"year": F.year(when), "month": F.month(when), "day": F.dayofmonth(when), "run": F.date_format(when, "'t'HHmmss")}
    for name, rows in parts.items():
        writer = rows.withColumns(folders).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*DAY).json(f"{path}/{name}")


def read_evaluation(spark: SparkSession, path: str, part: str = "record") -> DataFrame:
    """A stored part with its folder columns; a bound on year, month or day reads those folders alone."""
    schema = {"record": RECORD, "roc_curve": ROC, "pr_curve": PR}[part]
    return spark.read.schema(f"{schema}, {PARTS}").json(f"{path}/{part}")
