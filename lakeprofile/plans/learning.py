"""Training sets, features, the match model and its evaluation."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import probe_join
from ..operators.ordering import running_totals, top_n
from ..session import cut_lineage

# Thresholds of the weekly run.
MIN_GAIN = 0.01
MIN_SAMPLES = 100
TIERS = ((0.8, "high"), (0.6, "medium"))
TOP_FEATURES = 20
FOLDS = 5


def training_set(shortlists: DataFrame, profiles: DataFrame, start: str, end: str) -> DataFrame:
    """Scored shortlists (with ``rule_features``, a map, and ``reason``) with company facts and the contacted-within-14-days label.

    Profiles are unique per company; the shortlists are read once, and those of a
    company that holds very many are split by their size.
    """
    period = F.col("created_at").between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))
    rows = shortlists.where(period).dropna(subset=["final_score", "embedding_similarity", "ml_score"])
    facts = profiles.select(
        "company_key", "industry", "country", "employee_count", "annual_revenue", "total_funding", "domain_health_score",
        "content_richness_score", F.col("updated_at").alias("_updated"),
    )
    recent = F.col("created_at") >= F.col("_updated") - F.expr("INTERVAL 14 DAYS")
    label = F.when(recent & (F.col("final_score") > 0.7), F.lit(1)).otherwise(F.lit(0))
    joined = probe_join(rows, facts, "company_key", "inner")
    return joined.withColumn("contacted_within_14_days", label).drop("_updated")


def training_stats(training: DataFrame) -> DataFrame:
    return training.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.avg(c).alias(f"avg_{c}") for c in ("final_score", "embedding_similarity", "ml_score")],
        F.coalesce(F.sum("contacted_within_14_days"), F.lit(0)).alias("positive_cases"),
    )


def category_values(df: DataFrame, column: str) -> list[str]:
    """Sorted category names, all of them.

    They become feature names, and a linear model keeps one coefficient per
    feature in its document, so the list is as long as the model is.
    """
    values = df.select(F.coalesce(column, F.lit("unknown")).alias("v")).distinct()
    return sorted(r["v"] for r in values.collect())


def feature_matrix(
    df: DataFrame,
    numeric: Sequence[str],
    categories: Mapping[str, Sequence[str]],
    mapped: Mapping[str, Sequence[str]] | None = None,
    keep: Sequence[str] = (),
) -> tuple[DataFrame, list[str]]:
    """Numeric features (null → 0), map entries (absent → 0) and one-hot columns."""
    features: dict[str, Column] = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numeric}
    for column, names in (mapped or {}).items():
        for n in names:
            features[n] = F.coalesce(F.try_element_at(F.col(column), F.lit(n)), F.lit(0.0))
    for column, values in categories.items():
        value = F.coalesce(F.col(column), F.lit("unknown"))
        for v in values:
            features[f"{column}_{v}"] = F.when(value == v, F.lit(1.0)).otherwise(F.lit(0.0))
    return df.select(*keep, *[c.alias(n) for n, c in features.items()]), list(features)


def with_split(df: DataFrame, key: str, label: str, seed: str = "42") -> DataFrame:
    """Exact 80/20 split inside each label, and a cross-validation fold.

    The rows of a label are numbered in the order of a digest; the last fifth
    (rounded) is the test part.  Range partitioning on (label, digest) splits a
    label that holds most rows over many tasks.
    """
    drawn = df.withColumn("_draw", F.xxhash64(F.lit(seed), F.col(label), F.col(key)))
    placed = running_totals(drawn, [F.col("_draw"), F.col(key)], "_place", partition_by=[label])
    sizes = placed.groupBy(F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n"))
    joined = probe_join(placed.withColumn("_label", F.col(label)), sizes, "_label")
    train = F.col("_place") <= F.col("_n") - F.round(F.col("_n") / FOLDS)
    return joined.withColumns({"is_train": train, "fold": (F.col("_place") % FOLDS).cast("int")}).select(*df.columns, "is_train", "fold")


def class_sizes(df: DataFrame, label: str) -> tuple[int, int]:
    """Rows labelled 0 and rows labelled 1; other labels are an error."""
    value = F.col(label)
    ones, zeros, rows = df.agg(F.count_if(value == 1), F.count_if(value == 0), F.count(F.lit(1))).first()
    if ones + zeros != rows:
        raise ValueError(f"{label} has values other than 0 and 1")
    return zeros, ones


def with_balance(df: DataFrame, label: str) -> DataFrame:
    """Weight n / (classes · n_class) per row; give it the training part alone."""
    sizes = class_sizes(df, label)
    share = [sum(sizes) / (sum(n > 0 for n in sizes) * n) if n else 1.0 for n in sizes]
    return df.withColumn("weight", F.when(F.col(label) == 1, share[1]).otherwise(share[0]))


def fit_logistic(
    train: DataFrame, names: Sequence[str] | None, label: str, cost: float = 1.0, iterations: int = 1_000
) -> tuple[LogisticRegressionModel, PipelineModel]:
    """Class-balanced logistic regression with an L2 penalty.

    Minimises ``|w|² / 2 + cost · Σ weight · loss`` over features as they are.
    Spark divides the loss by the sum of the weights (the number of rows), and
    so the penalty.  Features are the columns ``names``, or the vectors in
    ``features`` where no names are given.
    """
    balanced = with_balance(train, label)
    rows = max(1, train.count())
    stages = [] if names is None else [VectorAssembler(inputCols=list(names), outputCol="features")]
    lr = LogisticRegression(
        featuresCol="features", labelCol=label, weightCol="weight", maxIter=iterations, regParam=1.0 / (cost * rows), standardization=False
    )
    pipeline = Pipeline(stages=[*stages, lr]).fit(balanced)
    return pipeline.stages[-1], pipeline


def model_document(model: LogisticRegressionModel, names: Sequence[str]) -> dict:
    """JSON-ready model: coefficients in feature order and the intercept."""
    return {
        "model_type": "logistic_regression",
        "coefficients": [float(c) for c in model.coefficients],
        "intercept": float(model.intercept),
        "feature_order": list(names),
    }


def model_frame(spark: SparkSession, document: Mapping, name: str = "model_json") -> DataFrame:
    """One-row frame holding a document as JSON."""
    return spark.range(1).select(F.lit(json.dumps(document)).alias(name))


def areas(scored: DataFrame, label: str, raw: str = "rawPrediction") -> dict[str, float]:
    out = {}
    for name, metric in (("auc_score", "areaUnderROC"), ("pr_auc_score", "areaUnderPR")):
        out[name] = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw, metricName=metric).evaluate(scored)
    return out


#: Fields of the document that tells how good a stored model is; the model document holds them too.
EVALUATION_FIELDS = ("auc_score", "pr_auc_score", "training_samples", "test_samples", "model_version", "trained_at")


def evaluation_document(document: Mapping) -> dict:
    """The part of a model document that is stored apart, so that it can be read without the coefficients."""
    return {k: document[k] for k in EVALUATION_FIELDS}


def train_and_evaluate(df: DataFrame, names: Sequence[str] | None, label: str, key: str, trained_at: str = "") -> tuple[DataFrame, dict]:
    """Fit on the train part, score the rest, cross-validate by fold.

    ``names`` is as in ``fit_logistic``; features given as vectors have their names in a vocabulary, not in the document.
    Returns one row of metrics and the model document, marked with ``trained_at`` and a version made of it.
    """
    prepared = cut_lineage(with_split(df, key, label))
    train, test = prepared.where("is_train"), prepared.where("NOT is_train")
    model, pipeline = fit_logistic(train, names, label)
    scored = pipeline.transform(test)
    metrics: dict[str, float] = areas(scored, label)
    quality = classification_summary(confusion_counts(scored, label, "prediction")).first().asDict()
    folds = []
    for fold in range(FOLDS):
        held = prepared.where(F.col("fold") == fold)
        _, fitted = fit_logistic(prepared.where(F.col("fold") != fold), names, label)
        right = fitted.transform(held).agg(F.avg((F.col("prediction") == F.col(label)).cast("double")).alias("a"))
        folds.append(right.first()["a"] or 0.0)
    mean = sum(folds) / FOLDS
    counts = prepared.groupBy("is_train").count().collect()  # two rows
    sizes = {r["is_train"]: r["count"] for r in counts}
    metrics.update(
        {k: quality[k] for k in ("accuracy", "precision", "recall", "f1_score")},
        cross_val_mean=mean,
        cross_val_std=(sum((f - mean) ** 2 for f in folds) / FOLDS) ** 0.5,
    )
    values = [F.lit(float(v)).alias(k) for k, v in metrics.items()]
    row = df.sparkSession.range(1).select(
        F.lit("logistic_regression").alias("model_type"),
        *values,
        F.lit(sizes.get(True, 0)).alias("training_samples"),
        F.lit(sizes.get(False, 0)).alias("test_samples"),
        F.lit(model.numFeatures).alias("feature_count"),
        F.lit(model.summary.totalIterations < model.getMaxIter()).alias("converged"),
    )
    document = model_document(model, [] if names is None else names)
    document.update(training_samples=sizes.get(True, 0), test_samples=sizes.get(False, 0), **{k: metrics[k] for k in ("auc_score", "pr_auc_score")})
    document.update(trained_at=trained_at, model_version="v" + "".join(c for c in trained_at if c.isdigit()))
    return row, document


def forest_importances(df: DataFrame, names: Sequence[str], label: str, trees: int = 20) -> DataFrame:
    """Importances of a random forest on the same features."""
    assembler = VectorAssembler(inputCols=list(names), outputCol="features")
    forest = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=5, seed=42)
    fitted = Pipeline(stages=[assembler, forest]).fit(df).stages[-1]
    return weights_frame(df.sparkSession, "random_forest", names, [float(v) for v in fitted.featureImportances.toArray()])


def weights_frame(spark: SparkSession, model: str, names: Sequence[str], values: Sequence[float]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(n).alias("feature"), F.lit(float(v)).alias("weight")) for n, v in zip(names, values, strict=True)])
    return spark.range(1).select(F.lit(model).alias("model_type"), F.explode(rows).alias("_w")).select("model_type", "_w.*")


def top_features(weights: DataFrame, n: int = TOP_FEATURES) -> DataFrame:
    """Largest weights by absolute value, per model."""
    return top_n(weights, ["model_type"], [F.abs("weight").desc(), F.col("feature").asc()], n, rank="rank")


# --- evaluation from scored rows --------------------------------------------


def confusion_counts(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    return scored.groupBy(F.col(label).cast("int").alias("actual"), F.col(prediction).cast("int").alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def classification_summary(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1 of two classes, per ``by``."""

    def cell(actual: int, predicted: int) -> Column:
        hit = (F.col("actual") == actual) & (F.col("predicted") == predicted)
        return F.sum(F.when(hit, F.col("n")).otherwise(F.lit(0))).cast("double")

    cells = counts.groupBy(*by).agg(
        *[cell(a, p).alias(f"c{a}{p}") for a in (0, 1) for p in (0, 1)], F.sum("n").cast("double").alias("total")
    )

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))

    per = {}
    for k in (0, 1):
        hit, real = F.col(f"c{k}{k}"), F.col(f"c{k}0") + F.col(f"c{k}1")
        said = F.col(f"c0{k}") + F.col(f"c1{k}")
        p, r = share(hit, said), share(hit, real)
        per[k] = (real, p, r, share(2 * p * r, p + r))

    def weighted(i: int) -> Column:
        return share(per[0][0] * per[0][i] + per[1][0] * per[1][i], F.col("total"))

    return cells.select(
        *by,
        share(F.col("c00") + F.col("c11"), F.col("total")).alias("accuracy"),
        weighted(1).alias("precision"),
        weighted(2).alias("recall"),
        weighted(3).alias("f1_score"),
        F.col("total").cast("long").alias("samples"),
    )


def threshold_counts(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score, highest first: true and false positives so far."""
    counts = scored.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.sum(1 - F.col(label).cast("long")).alias("neg")
    )
    cumulative = running_totals(
        counts, [F.col("threshold").desc()], "step", {"tp": F.col("pos"), "fp": F.col("neg")}
    )
    return cumulative.withColumns(
        {
            "all_pos": counts.agg(F.sum("pos").alias("n")).scalar(),
            "all_neg": counts.agg(F.sum("neg").alias("n")).scalar(),
        }
    )


def roc_curve(scored: DataFrame, label: str, score: str) -> DataFrame:
    """One point per distinct threshold, and the origin."""
    points = threshold_counts(scored, label, score).select(
        "threshold",
        (F.col("fp") / F.col("all_neg")).alias("fpr"),
        (F.col("tp") / F.col("all_pos")).alias("tpr"),
    )
    zero = F.lit(0.0)
    origin = scored.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"), zero.alias("fpr"), zero.alias("tpr"))
    return points.unionByName(origin)


def pr_curve(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Precision and recall per threshold, and the end point (1, 0)."""
    points = threshold_counts(scored, label, score).select(
        "threshold",
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        (F.col("tp") / F.col("all_pos")).alias("recall"),
    )
    end = scored.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end)


def area_under_roc(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Trapezoid area from the running counts; no neighbour lookup is needed."""
    counts = threshold_counts(scored, label, score)
    strip = F.col("neg") * (F.col("tp") - F.col("pos") / 2)
    area = F.sum(strip) / (F.max("all_pos") * F.max("all_neg"))
    return counts.agg(area.alias("auc_score"))


# --- registry ----------------------------------------------------------------


def model_latest(versions: DataFrame, start: str) -> DataFrame:
    kept = versions.where(F.col("training_date") >= start)
    return kept.orderBy(F.col("training_date").desc(), F.col("auc_score").desc())


def model_comparison(versions: DataFrame, start: str) -> DataFrame:
    return (
        versions.where(F.col("training_date") >= start)
        .groupBy("model_type")
        .agg(
            F.avg("auc_score").alias("avg_auc"),
            F.avg("pr_auc_score").alias("avg_pr_auc"),
            F.count(F.lit(1)).alias("model_count"),
        )
    )


def model_promotion(versions: DataFrame) -> DataFrame:
    """Compare each model with the one trained before it in the same type.

    The predecessor is found by an equi-join on the training rank, which is a
    per-type order over registry rows.
    """
    order = [F.col("training_date").asc(), F.col("model_id").asc()]
    placed = running_totals(
        versions.select("model_type", "model_id", "training_date", "auc_score", "accuracy", "training_samples"),
        order,
        "version_no",
        partition_by=["model_type"],
    )
    older = placed.select(
        F.col("model_type"),
        (F.col("version_no") + 1).alias("version_no"),
        F.col("auc_score").alias("old_auc"),
        F.col("accuracy").alias("old_accuracy"),
    )
    joined = placed.join(older, ["model_type", "version_no"], "left")
    auc_gain = F.round(F.coalesce(F.col("auc_score") - F.col("old_auc"), F.lit(0.0)), 9)
    accuracy_gain = F.round(F.coalesce(F.col("accuracy") - F.col("old_accuracy"), F.lit(0.0)), 9)
    better = F.col("old_auc").isNull() | (F.col("auc_gain") > MIN_GAIN) | (F.col("accuracy_gain") > MIN_GAIN)
    tier = F.when(F.col("auc_score") > TIERS[0][0], TIERS[0][1]).when(F.col("auc_score") > TIERS[1][0], TIERS[1][1]).otherwise("low")
    return joined.withColumns({"auc_gain": auc_gain, "accuracy_gain": accuracy_gain}).withColumns(
        {
            "enough_samples": F.col("training_samples") >= MIN_SAMPLES,
            "improvement": better,
            "performance_level": tier,
        }
    )


# --- text vectors -------------------------------------------------------------


#: Slots of a text sketch; only those a text uses are stored.
TEXT_SLOTS = 1 << 18


#: Words whose numbers of texts travel to every task.
BROADCAST_WORDS = 500_000
#: Rows from which on a key's texts may be dealt to several tasks.
HOT_ROWS = 10_000


def text_words(df: DataFrame, text: str, key: str) -> DataFrame:
    """(key, word) of every word of every text; words are runs of letters, digits and ``_`` in lower case."""
    return df.select(key, F.explode(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}_]+")).alias("word")).where("word <> ''")


def word_counts(df: DataFrame, text: str, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(key, word, times), all rows of a key in one task.

    Texts move to their key whole, which is far less than their words would be one by one.  Only keys that hold more
    than ``hot_rows`` rows and more than an even task's share are counted where their texts lie.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    share = rows.agg(F.sum("_n").alias("_n")).scalar() / F.lit(float(tasks))
    hot = cut_lineage(rows.where((F.col("_n") > hot_rows) & (F.col("_n") > share)).select(F.col(key).alias("_hot")))

    def counted(words: DataFrame) -> DataFrame:
        return words.groupBy(key, "word").agg(F.count(F.lit(1)).alias("times"))

    if hot.isEmpty():
        return counted(text_words(df.select(key, text).repartition(F.col(key)), text, key))
    same, few = F.col(key).eqNullSafe(F.col("_hot")), F.broadcast(hot)
    moved = df.select(key, text).join(few, same, "left_anti").repartition(F.col(key))
    spread = counted(text_words(df.select(key, text).join(few, same, "left_semi"), text, key))
    return counted(text_words(moved, text, key)).unionByName(spread.repartition(F.col(key)))


def word_slot(word: Column, slots: int) -> Column:
    return F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("long") % slots


def most_frequent(known: DataFrame, most: int) -> tuple[DataFrame, int]:
    """Words of ``known`` (word, texts) found in at least so many texts, and that number: the least power of 2, from 2 on, that leaves ``most`` words or fewer."""
    sizes = known.groupBy(F.floor(F.log2("texts")).cast("int").alias("power")).agg(F.count(F.lit(1)).alias("n")).collect()  # one row a power
    bound, left = 2, sum(r["n"] for r in sizes)
    for r in sorted(sizes):
        if left > most:
            bound, left = 2 ** (r["power"] + 1), left - r["n"]
    return known.where(F.col("texts") >= bound), bound


def text_entries(df: DataFrame, text: str, key: str, slots: int = TEXT_SLOTS, broadcast_words: int = BROADCAST_WORDS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(key, slot, value): the entries of a signed count sketch of whole texts.

    The first eight digits of a word's digest give its slot, the ninth its sign, so
    words that share a slot cancel on average.  An entry sums sign * times *
    ln((n + 1) / (d + 1)) over its words, ``d`` of the ``n`` keys having the word; the
    entries of a key have length 1 together, or are all 0 where every word is in every
    text.  Null texts and texts without words have no entry; rows with equal keys are
    one text.  There is a row for every slot a text uses and no list of words anywhere.

    The ``broadcast_words`` most frequent words travel to the texts, which stay in their
    tasks.  The others meet word by word, each in fewer texts than any of those, and
    only their entries move back to the texts.
    """
    counted = word_counts(df, text, key, hot_rows)
    known = cut_lineage(counted.groupBy("word").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1"))
    frequent, bound = most_frequent(known, broadcast_words)
    keys = df.groupBy(key).agg(F.lit(1).alias("one")).agg(F.count("one").alias("n")).scalar()
    sign = F.when(F.substring(F.md5("word"), 9, 1) < "8", 1.0).otherwise(-1.0)
    rare = F.log((keys + 1) / (F.col("texts") + 1))

    def weighed(words: DataFrame) -> DataFrame:
        return words.select(key, word_slot(F.col("word"), slots).alias("slot"), (sign * F.col("times") * rare).alias("value"))

    if bound == 2:  # a word that is not among them is in one text
        values = weighed(counted.join(F.broadcast(frequent), "word", "left").withColumn("texts", F.coalesce("texts", F.lit(1))))
    else:
        others = counted.join(F.broadcast(frequent.select("word")), "word", "left_anti")
        others = others.withColumn("texts", F.count(F.lit(1)).over(Window.partitionBy("word")))
        values = weighed(counted.join(F.broadcast(frequent), "word")).unionByName(weighed(others).repartition(F.col(key)))
    entries = values.groupBy(key, "slot").agg(F.sum("value").alias("value"))
    length = F.sqrt(F.sum(F.col("value") * F.col("value")).over(Window.partitionBy(key)))
    return entries.withColumn("value", F.when(length > 0, F.col("value") / length).otherwise(F.lit(0.0)))


def slot_collisions(df: DataFrame, text: str, key: str, slots: int = TEXT_SLOTS) -> DataFrame:
    """(slot, words, times, heaviest): slots that several words share, and the times the most frequent of them is used."""
    words = text_words(df, text, key).groupBy("word").agg(F.count(F.lit(1)).alias("times"))
    slot = words.groupBy(word_slot(F.col("word"), slots).alias("slot"))
    return slot.agg(F.count(F.lit(1)).alias("words"), F.sum("times").alias("times"), F.max("times").alias("heaviest")).where("words > 1")


def text_vectors(df: DataFrame, text: str, key: str, features: int = 512) -> DataFrame:
    """Hashed TF-IDF vectors of length 1 over whole texts, as arrays."""
    stages = [
        RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"\W+"),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features),
        IDF(inputCol="_tf", outputCol="_tfidf"),
        Normalizer(inputCol="_tfidf", outputCol="_unit"),
    ]
    rows = df.select(key, text)
    fitted = Pipeline(stages=stages).fit(rows)
    return fitted.transform(rows).select(key, vector_to_array("_unit", "float32").alias("embedding_vector"))
