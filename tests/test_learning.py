"""Model training and evaluation."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from conftest import one, plan_of
from pyspark.sql import functions as F

from lakeprofile.plans import learning


@pytest.fixture(scope="module")
def labelled(spark):
    rows = spark.range(600).select(
        "id",
        (F.col("id") % 3 == 0).cast("int").alias("label"),
        F.when(F.col("id") % 3 == 0, 1.0).otherwise(0.0).alias("signal"),
        ((F.col("id") * 37) % 101 / 101.0).alias("noise"),
    )
    return rows


def test_split_is_stable_and_stratified(labelled):
    split = learning.with_split(labelled, "id", "label")
    shares = {r["label"]: r["s"] for r in split.groupBy("label").agg(F.avg(F.col("is_train").cast("int")).alias("s")).collect()}
    assert shares == {0: 0.8, 1: 0.8}  # exactly, in each label
    assert {r["n"] for r in split.groupBy("label", "fold").agg(F.count("*").alias("n")).collect()} == {40, 80}
    assert split.exceptAll(learning.with_split(labelled, "id", "label")).count() == 0


def test_balance_weights(labelled):
    weights = {r["label"]: r["weight"] for r in learning.with_balance(labelled, "label").select("label", "weight").distinct().collect()}
    assert weights == pytest.approx({1: 600 / (2 * 200), 0: 600 / (2 * 400)})


def test_training_finds_the_signal(labelled):
    metrics, document = learning.train_and_evaluate(labelled, ["signal", "noise"], "label", "id")
    row = one(metrics)
    assert row["auc_score"] > 0.99 and row["accuracy"] > 0.99 and row["cross_val_mean"] > 0.99
    assert row["training_samples"] + row["test_samples"] == 600
    assert document["feature_order"] == ["signal", "noise"]
    assert abs(document["coefficients"][0]) > abs(document["coefficients"][1])


def test_forest_and_top_features(spark, labelled):
    weights = learning.forest_importances(labelled, ["signal", "noise"], "label", trees=5)
    best = learning.top_features(weights, n=1).first()
    assert best["feature"] == "signal"
    signed = learning.weights_frame(spark, "m", ["a", "b", "c"], [0.1, -5.0, 2.0])
    assert [r["feature"] for r in learning.top_features(signed, n=2).orderBy("rank").collect()] == ["b", "c"]


def test_curves_and_summary(spark):
    scored = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1), (0, 0.7)], "label int, score double")
    roc = {(round(r["fpr"], 4), round(r["tpr"], 4)) for r in learning.roc_curve(scored, "label", "score").collect()}
    assert roc == {(0.0, 0.0), (0.0, 0.5), (0.3333, 0.5), (0.6667, 1.0), (1.0, 1.0)}
    assert one(learning.area_under_roc(scored, "label", "score"))["auc_score"] == pytest.approx(0.75)
    pr = {(round(r["precision"], 4), r["recall"]) for r in learning.pr_curve(scored, "label", "score").collect()}
    assert pr == {(1.0, 0.0), (1.0, 0.5), (0.5, 0.5), (0.5, 1.0), (0.4, 1.0)}
    counts = learning.confusion_counts(scored.withColumn("p", (F.col("score") >= 0.75).cast("int")), "label", "p")
    summary = one(learning.classification_summary(counts))
    assert summary["accuracy"] == pytest.approx(0.6) and summary["recall"] == pytest.approx(0.6)


def test_promotion_needs_a_real_gain(spark):
    rows = spark.createDataFrame(
        [("a", "lr", "2024-01-01", 0.70, 0.7, 200), ("b", "lr", "2024-01-02", 0.71, 0.7, 200), ("c", "lr", "2024-01-03", 0.73, 0.7, 50)],
        "model_id string, model_type string, training_date string, auc_score double, accuracy double, training_samples int",
    )
    got = {r["model_id"]: (r["improvement"], r["enough_samples"], r["performance_level"]) for r in learning.model_promotion(rows).collect()}
    assert got == {"a": (True, True, "medium"), "b": (False, True, "medium"), "c": (True, False, "medium")}


def test_all_categories_count(spark):
    names = learning.category_values(spark.range(10_500).select(F.col("id").cast("string").alias("c")), "c")
    assert len(names) == 10_500 and names == sorted(names)


def test_labels_are_binary(spark):
    with pytest.raises(ValueError, match="other than 0 and 1"):
        learning.with_balance(spark.range(3).withColumn("label", F.col("id")), "label")


def test_fit_is_at_the_minimum_of_the_penalised_loss(labelled):
    model, _ = learning.fit_logistic(labelled, ["signal", "noise"], "label")
    rows = labelled.toPandas()
    x, y = rows[["signal", "noise"]].to_numpy(), rows["label"].to_numpy()
    w = np.array(model.coefficients)
    weight = np.where(y == 1, 600 / (2 * 200), 600 / (2 * 400))
    error = weight * (1 / (1 + np.exp(-(x @ w + model.intercept))) - y)
    assert np.abs(w + x.T @ error).max() < 0.05 and abs(error.sum()) < 0.05


def test_text_vectors_have_unit_length(spark):
    rows = spark.createDataFrame([(1, "alpha beta beta"), (2, "gamma delta")], "id int, text string")
    for r in learning.text_vectors(rows, "text", "id", features=64).collect():
        assert sum(x * x for x in r["embedding_vector"]) == pytest.approx(1.0, abs=1e-5)


def test_text_entries_against_a_plain_sketch(spark):
    """Signs, shared slots, null and empty texts, a key in two rows, words in other scripts; 8 slots, so that many collide."""
    texts = [(1, "alpha beta Beta"), (2, "gamma delta \u00e9t\u00e9"), (3, None), (4, " .,"), (5, "alpha gamma"), (5, "alpha"), (None, "beta \u4e2d\u6587")]
    rows = spark.createDataFrame(texts, "id int, text string")
    words = {}
    for key, text in texts:
        for w in re.findall(r"\w+", (text or "").lower()):
            words.setdefault(key, Counter())[w] += 1
    digest = {w: hashlib.md5(w.encode()).hexdigest() for c in words.values() for w in c}
    want = {}
    for key, counts in words.items():
        for w, times in counts.items():
            rare = math.log(7 / (1 + sum(w in c for c in words.values())))
            slot = int(digest[w][:8], 16) % 8
            want[key, slot] = want.get((key, slot), 0.0) + (1 if digest[w][8] < "8" else -1) * times * rare
    size = {key: math.sqrt(sum(v * v for (k, _), v in want.items() if k == key)) for key in words}
    got = {(r.id, r.slot): r.value for r in learning.text_entries(rows, "text", "id", slots=8).collect()}
    assert got == pytest.approx({(k, s): v / size[k] if size[k] else 0.0 for (k, s), v in want.items()})
    shared = Counter(int(d[:8], 16) % 8 for d in digest.values())
    found = {r.slot: r.words for r in learning.slot_collisions(rows, "text", "id", slots=8).collect()}
    assert found == {s: n for s, n in shared.items() if n > 1}
    assert learning.text_entries(rows.limit(0), "text", "id").count() == 0


def test_text_entries_move_texts_instead_of_their_words(spark, tmp_path):
    """Frequent words travel, others meet word by word, hot keys are spread: the same entries, and one move of entries at most."""
    texts = [(i % 40, " ".join(f"w{j}" for j in range(1, 30) if (i * 7 + j) % j < 3) + f" own{i}") for i in range(80)] + [(None, "w1 w2 gap")] * 3
    spark.createDataFrame(texts, "id int, text string").write.parquet(str(tmp_path / "texts"))
    rows = spark.read.parquet(str(tmp_path / "texts"))
    found = []
    for settings in ({}, {"broadcast_words": 5}, {"broadcast_words": 0}, {"hot_rows": 1}):
        out = learning.text_entries(rows, "text", "id", slots=64, **settings)
        exchanges = [line for line in plan_of(out).split("\n") if "Exchange hashpartitioning(" in line]
        assert not any("slot" in line for line in exchanges)
        found.append({(r.id, r.slot): r.value for r in out.collect()})
    assert found[0] and all(other == pytest.approx(found[0]) for other in found[1:])
    sizes = spark.createDataFrame([("a", 2), ("b", 3), ("c", 4), ("d", 9)], "word string, texts long")
    assert [(learning.most_frequent(sizes, n)[0].count(), learning.most_frequent(sizes, n)[1]) for n in (4, 3, 2, 1, 0)] == [(4, 2), (2, 4), (2, 4), (1, 8), (0, 16)]
