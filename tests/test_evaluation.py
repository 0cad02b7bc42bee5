"""The evaluation record: curves, areas, files."""

import json
import random

import numpy as np
import pytest
from lakeprofile.plans import evaluation, learning
from lakeprofile.registry import QUERIES

from conftest import SMALL

SCORED = "model_name string, label int, score double, prediction int, fold int"
WEIGHTS = "model_name string, feature string, weight double"


def rows_of(model, n, seed, steps):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        label = rng.random() < 0.4
        score = round(min(1.0, max(0.0, rng.gauss(0.6 if label else 0.4, 0.2))) * steps) / steps
        out.append((model, int(label), score, int(score >= 0.5), i % 5))
    return out


def plain_curves(rows):
    """All points (fp, tp) and (recall, precision), one per score, by sorting."""
    by = {}
    for _, label, score, _, _ in rows:
        by.setdefault(score, [0, 0])[1 - label] += 1
    roc, pr, tp, fp = [(0, 0)], [(0.0, 1.0)], 0, 0
    positive = sum(r[1] for r in rows)
    for score in sorted(by, reverse=True):
        tp, fp = tp + by[score][0], fp + by[score][1]
        roc.append((fp, tp))
        pr.append((tp / positive if positive else 0.0, tp / (tp + fp)))
    return roc, pr


def area(line):
    return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(line, line[1:], strict=False))


@pytest.fixture(params=[4096, 4])
def block(request, monkeypatch):
    monkeypatch.setattr(evaluation, "BLOCK", request.param)


def test_reduced_curves_keep_their_areas(spark, block):
    sets = {"many": rows_of("many", 3000, 1, 10_000), "few": rows_of("few", 500, 2, 20), "right": [("right", i % 2, float(i % 2), i % 2, i % 5) for i in range(90)]}
    scored = spark.createDataFrame([r for rows in sets.values() for r in rows], SCORED)
    points = evaluation.threshold_points(scored, "label", "score")
    full, short = evaluation.roc_points(points, reduced=False), evaluation.roc_points(points)
    whole = {r["model_name"]: r["auc_score"] for r in evaluation.roc_area(full).collect()}
    assert whole == {r["model_name"]: r["auc_score"] for r in evaluation.roc_area(short).collect()}  # to the last bit
    pr_full, pr_short = evaluation.pr_points(points, reduced=False), evaluation.pr_points(points)
    pr_whole = {r["model_name"]: r["pr_auc_score"] for r in evaluation.pr_area(pr_full).collect()}
    assert pr_whole == pytest.approx({r["model_name"]: r["pr_auc_score"] for r in evaluation.pr_area(pr_short).collect()}, abs=1e-12)
    kept = {}
    for r in short.orderBy("model_name", "step").collect():
        kept.setdefault(r["model_name"], []).append((r["fp"], r["tp"]))
    kept_pr = {}
    for r in pr_short.orderBy("model_name", "step").collect():
        kept_pr.setdefault(r["model_name"], []).append((r["recall"], r["precision"]))
    for name, rows in sets.items():
        roc, pr = plain_curves(rows)
        positive = sum(r[1] for r in rows)
        assert whole[name] == pytest.approx(area(roc) / (positive * (len(rows) - positive)), abs=1e-12)
        assert pr_whole[name] == pytest.approx(area(pr), abs=1e-12)
        cross = lambda a, b, c: (b[0] - a[0]) * (c[1] - b[1]) - (c[0] - b[0]) * (b[1] - a[1])
        bends = [roc[0], *[b for a, b, c in zip(roc, roc[1:], roc[2:], strict=False) if cross(a, b, c)], roc[-1]]
        assert kept[name] == bends and (name != "few" or len(bends) < len(roc))
        assert set(kept_pr[name]) <= set(pr) and kept_pr[name][0] == pr[0] and kept_pr[name][-1] == pr[-1]
        assert area(kept_pr[name]) == pytest.approx(area(pr), abs=1e-12)


def test_record_round_trip_and_rerun(spark, tmp_path):
    sets = {"a": rows_of("a", 400, 3, 50), "b": rows_of("b", 300, 4, 50), "one": [("one", 1, 0.9, 1, 0)] * 10}
    scored = spark.createDataFrame([r for rows in sets.values() for r in rows], SCORED)
    weights = spark.createDataFrame([("a", f"f{i}", (-1.0) ** i * i) for i in range(30)], WEIGHTS)
    path = str(tmp_path / "e")
    for at in ("2024-01-30T06:00:00", "2024-01-31T06:00:00", "2024-01-31T18:30:00", "2024-01-31T18:30:00"):
        evaluation.write_evaluation(evaluation.evaluate(scored, weights, at), path)
    stored = evaluation.read_evaluation(spark, path)
    assert stored.count() == 9  # the repeated run replaced itself
    last = {r["model_name"]: r for r in stored.where("year = 2024 AND month = 1 AND day = 31 AND run = 't183000'").collect()}
    assert set(last) == {"a", "b", "one"}
    for name in ("a", "b"):
        rows, r = sets[name], last[name]
        y, p = np.array([x[1] for x in rows]), np.array([x[3] for x in rows])
        assert json.loads(r["confusion_matrix"]) == [[int(((y == i) & (p == j)).sum()) for j in (0, 1)] for i in (0, 1)]
        assert r["accuracy"] == pytest.approx((y == p).mean()) and r["samples"] == len(rows)
        folds = [(y[i::5] == p[i::5]).mean() for i in range(5)]
        assert r["cross_val_mean"] == pytest.approx(np.mean(folds)) and r["cross_val_std"] == pytest.approx(np.std(folds))
        roc, pr = plain_curves(rows)
        positive = int(y.sum())
        assert r["auc_score"] == pytest.approx(area(roc) / (positive * (len(rows) - positive))) and r["pr_auc_score"] == pytest.approx(area(pr))
    best = json.loads(last["a"]["top_features"])
    assert list(best) == [f"f{i}" for i in range(29, 9, -1)] and best["f29"] == -29.0
    assert last["one"]["auc_score"] is None and last["one"]["pr_auc_score"] == 1.0 and last["b"]["top_features"] is None
    curve = evaluation.read_evaluation(spark, path, "roc_curve").where("day = 31 AND run = 't183000'")
    again = {r["model_name"]: r["auc_score"] for r in evaluation.roc_area(curve).collect()}
    assert again == {name: r["auc_score"] for name, r in last.items()}
    sizes = {r["model_name"]: r["count"] for r in curve.groupBy("model_name").count().collect()}
    assert sizes == {name: r["roc_points"] for name, r in last.items()}


def test_no_scored_rows(spark, tmp_path):
    parts = evaluation.evaluate(spark.createDataFrame([], SCORED), spark.createDataFrame([], WEIGHTS), "2024-01-31T06:00:00")
    evaluation.write_evaluation(parts, str(tmp_path / "e"))
    assert all(p.count() == 0 for p in parts.values())


def test_model_documents(spark):
    rows = spark.range(200).selectExpr("id", "cast(id % 3 = 0 AS INT) AS label", "cast(id % 3 = 0 AS DOUBLE) AS signal")
    metrics, document = learning.train_and_evaluate(rows, ["signal"], "label", "id", "2024-01-31T06:00:00")
    short = learning.evaluation_document(document)
    assert set(short) == {"auc_score", "pr_auc_score", "training_samples", "test_samples", "model_version", "trained_at"}
    assert short["training_samples"] == 160 and short["test_samples"] == 40 and short["model_version"] == "v20240131060000"
    assert json.loads(json.dumps(document))["coefficients"] == document["coefficients"]
    row = metrics.first()
    assert (row["auc_score"], row["pr_auc_score"]) == (short["auc_score"], short["pr_auc_score"])


def test_stored_documents_of_the_query(spark):
    row = QUERIES["lr_train_eval"](spark, SMALL).first()
    model, apart = json.loads(row["model_json"]), json.loads(row["evaluation_json"])
    assert len(model["coefficients"]) == len(model["feature_order"]) == row["feature_count"]
    assert {k: model[k] for k in apart} == apart and apart["test_samples"] == row["test_samples"]
