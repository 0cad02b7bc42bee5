"""Sparse features over a stored vocabulary, and models fitted on them."""

import math

import pytest
from lakeprofile.plans import features, learning
from lakeprofile.session import work_path
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import plan_of

ROWS = "id int, label int, n double, m int, r map<string,double>, c string"


def prepared(spark, rows, **columns):
    long = features.entries(rows, "id", columns.get("numeric", []), columns.get("mapped", []), columns.get("categories", []))
    words = features.vocabulary(long, columns.get("mapped", []))
    sparse = features.sparse_rows(long, words, "id", rows.select("id", "label"))
    return words, features.write_features(sparse, words.count(), work_path(spark, "features"))


def test_entries_become_vectors(spark):
    rows = spark.createDataFrame(
        [(1, 0, 0.5, None, {"x": 1.0, "y": 0.0}, "b"), (2, 1, None, 3, None, None), (3, 0, 0.0, 0, {}, "a"), (4, 1, -1.0, 2, {"z": None, "x": 2.0}, "")], ROWS
    )
    words, stored = prepared(spark, rows, numeric=["n", "m"], mapped=["r"], categories=["c"])
    names = {r["index"]: r["feature"] for r in words.collect()}
    assert sorted(names) == list(range(len(names))) and set(names.values()) == {"n", "m", "x", "y", "z", "c_a", "c_b", "c_unknown", "c"}
    got = {r["id"]: {names[i]: v for i, v in zip(r["features"].indices.tolist(), r["features"].values.tolist(), strict=True)} for r in stored.collect()}
    assert got == {1: {"n": 0.5, "x": 1.0, "c_b": 1.0}, 2: {"m": 3.0, "c_unknown": 1.0}, 3: {"c_a": 1.0}, 4: {"n": -1.0, "m": 2.0, "x": 2.0, "c": 1.0}}
    assert {r["features"].size for r in stored.collect()} == {len(names)}
    assert stored.select(F.size(vector_to_array("features"))).first()[0] == len(names)


def test_names_beyond_the_vocabulary_are_left_out(spark):
    old = spark.createDataFrame([(1, 0, 1.0, 1, {"x": 1.0}, "a")], ROWS)
    words, _ = prepared(spark, old, numeric=["n"], mapped=["r"], categories=["c"])
    new = spark.createDataFrame([(5, 0, 2.0, 1, {"y": 1.0}, "b"), (6, 0, None, 1, None, "b")], ROWS)
    long = features.entries(new, "id", ["n"], ["r"], ["c"])
    rows = features.sparse_rows(long, words, "id", new.select("id")).collect()
    assert {r["id"]: (len(r["indices"]), r["values"]) for r in rows} == {5: (1, [2.0]), 6: (0, [])}


def test_empty_table(spark):
    words, stored = prepared(spark, spark.createDataFrame([], ROWS), numeric=["n"], categories=["c"])
    assert words.count() == stored.count() == 0


def test_coefficients_have_the_closed_form(spark):
    """One category, next to no penalty: the score of a category is the log odds of its rows, balanced."""
    counts = {"a": (30, 10), "b": (20, 20), "c": (10, 30), "d": (25, 5)}
    rows, i = [], 0
    for c, ns in counts.items():
        for label, n in enumerate(ns):
            for _ in range(n):
                rows.append((i, label, None, None, None, c))
                i += 1
    words, stored = prepared(spark, spark.createDataFrame(rows, ROWS), categories=["c"])
    model, _ = learning.fit_logistic(stored, None, "label", cost=1e6)
    weights = {r["feature"]: r["weight"] for r in features.weights_table(spark, model, words).collect()}
    zeros, ones = (sum(n[k] for n in counts.values()) for k in (0, 1))
    for c, (no, yes) in counts.items():
        assert weights[f"c_{c}"] + model.intercept == pytest.approx(math.log(yes / no * zeros / ones), abs=1e-3)


def test_two_hundred_thousand_categories(spark):
    rows = spark.range(200_000).select(
        F.col("id").cast("int").alias("id"), (F.col("id") % 2).cast("int").alias("label"), F.lit(None).cast("double").alias("n"),
        F.lit(None).cast("int").alias("m"), F.lit(None).cast("map<string,double>").alias("r"), F.concat(F.lit("v"), "id").alias("c"),
    )
    words, stored = prepared(spark, rows, categories=["c"])
    assert words.count() == 200_000 == words.agg(F.max("index")).first()[0] + 1
    assert len(stored.columns) == 3 and len(plan_of(stored)) < 20_000  # neither a column nor a name in the plan for each
    model, _ = learning.fit_logistic(stored, None, "label", iterations=3)
    assert model.numFeatures == 200_000
    assert features.weights_table(spark, model, words).where("(weight > 0) = (cast(substr(feature, 4) AS BIGINT) % 2 = 1)").count() == 200_000


def test_training_on_vectors(spark):
    rows = spark.range(300).select(
        F.col("id").cast("int").alias("id"), (F.col("id") % 3 == 0).cast("int").alias("label"), F.lit(1.0).alias("n"), F.lit(1).alias("m"),
        F.create_map(F.lit("hint"), (F.col("id") % 3 == 0).cast("double")).alias("r"), F.concat(F.lit("k"), F.col("id") % 7).alias("c"),
    )
    _, stored = prepared(spark, rows, numeric=["n"], mapped=["r"], categories=["c"])
    metrics, document = learning.train_and_evaluate(stored, None, "label", "id", "2024-01-31T00:00:00")
    row = metrics.first()
    assert row["auc_score"] > 0.99 and row["accuracy"] > 0.99 and row["feature_count"] == 9 and document["feature_order"] == []
