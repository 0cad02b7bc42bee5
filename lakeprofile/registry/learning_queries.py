"""Training data, features, models and their evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.matching import logistic_score, match_reason
from ..operators.ordering import category_codes as add_codes
from ..plans import evaluation, features, learning
from .core import START, cte, num, query, shared, stamp
from .gold_queries import profiles_of

PERIOD = ("2024-01-01", "2024-01-28")
cte(
    "o_training",
    """SELECT s.event_id, s.challenge_id, s.company_key, s.final_score, s.embedding_similarity, s.ml_score, s.created_at, g.industry, g.country, g.employee_count, g.employee_count * 150000 AS annual_revenue, g.total_funding,
       s.industry_match, s.geo_match, s.name_similarity, coalesce(nullif(concat_ws('; ', CASE WHEN embedding_similarity > 0.8 THEN 'Very high content similarity' WHEN embedding_similarity > 0.6 THEN 'High content similarity' WHEN embedding_similarity > 0.4 THEN 'Moderate content similarity' END,
       CASE WHEN industry_match > 0 THEN 'Industry match' END, CASE WHEN geo_match > 0 THEN 'Geographic match' END, CASE WHEN name_similarity > 0.5 THEN 'Company name similarity' END,
       CASE WHEN ml_score > 0.7 THEN 'Strong ML prediction' WHEN ml_score > 0.5 THEN 'Moderate ML prediction' END), ''), 'General similarity') AS reason,
       CASE WHEN s.created_at >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 14 DAY AND s.final_score > 0.7 THEN 1 ELSE 0 END AS contacted_within_14_days
       FROM b_shortlists s JOIN o_companies g ON g.company_key = s.company_key WHERE s.created_at BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-01-28 00:00:00' AND s.final_score IS NOT NULL AND s.ml_score IS NOT NULL""",
)


@shared
def training_of(inp):
    rules = ("industry_match", "geo_match", "name_similarity")
    scores = [F.col(c) for c in ("embedding_similarity", *rules, "ml_score")]
    rows = inp["b_shortlists"].withColumn("reason", match_reason(*scores)).withColumn("rule_features", F.create_map(*[x for c in rules for x in (F.lit(c), F.col(c))]))
    profiles = profiles_of(inp).withColumn("annual_revenue", F.col("employee_count") * 150_000)
    return learning.training_set(rows, profiles, *PERIOD)


@query(
    "training_set",
    f"""SELECT event_id, challenge_id, company_key, {num('final_score', 'embedding_similarity', 'ml_score')}, {stamp('created_at')}, industry, country, employee_count, annual_revenue, {num('total_funding')}, industry_match, geo_match, name_similarity, reason, contacted_within_14_days FROM o_training""",
)
def training_set(inp):
    from ..session import work_path
    from ..sources.readers import read_parquet

    shown = [
        "event_id", "challenge_id", "company_key", "final_score", "embedding_similarity", "ml_score", "created_at", "industry", "country", "employee_count", "annual_revenue",
        "total_funding", "rule_features", "reason", "contacted_within_14_days",
    ]
    path = work_path(inp.spark, "training")
    training_of(inp).select(*shown).write.mode("overwrite").option("compression", "snappy").parquet(path)
    rules = [F.col("rule_features")[c].alias(c) for c in ("industry_match", "geo_match", "name_similarity")]
    return read_parquet(inp.spark, path).select("*", *rules).drop("rule_features")


@query(
    "training_stats",
    f"SELECT count(*) AS total_records, {num('avg(final_score) AS avg_final_score', 'avg(embedding_similarity) AS avg_embedding_similarity', 'avg(ml_score) AS avg_ml_score')}, CAST(sum(contacted_within_14_days) AS BIGINT) AS positive_cases FROM o_training",
)
def training_stats(inp):
    return learning.training_stats(training_of(inp))


NUMBERS = ("embedding_similarity", "ml_score", "employee_count", "annual_revenue", "total_funding")
RULES = ("industry_match", "geo_match", "name_similarity")


@shared
def long_features(inp):
    from ..session import cut_lineage

    rows = cut_lineage(training_of(inp).select("event_id", *NUMBERS, "rule_features", "industry", "country", F.col("contacted_within_14_days").alias("label")))
    return rows, features.entries(rows, "event_id", NUMBERS, ["rule_features"], ["industry", "country"])


cte(
    "o_entries",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        [f"SELECT event_id, contacted_within_14_days AS label, '{c}' AS feature, '{kind}' AS col, '{name}' AS name, coalesce({c}, 0)::DOUBLE AS number FROM o_training" for c, kind, name in [*[(c, c, "") for c in NUMBERS], *[(c, "rule_features", c) for c in RULES]]]
        + [f"SELECT event_id, contacted_within_14_days, '{c}_' || coalesce({c}, 'unknown'), '{c}', coalesce({c}, 'unknown'), 1.0::DOUBLE FROM o_training" for c in ("industry", "country")]
    )
    + ")",
)
cte("o_words", "SELECT *, CAST(row_number() OVER (ORDER BY col, name) - 1 AS INTEGER) AS idx FROM (SELECT DISTINCT col, name, feature FROM o_entries)")


@query("feature_vocabulary", "SELECT col AS column_name, name, feature, idx FROM o_words")
def feature_vocabulary(inp):
    """All features of the training set with their places in the vector."""
    words = features.vocabulary(long_features(inp)[1], ["rule_features"])
    return words.select(F.col("column").alias("column_name"), "name", "feature", F.col("index").alias("idx"))


@query("training_features", f"SELECT event_id, label, feature, {num('number AS value')} FROM o_entries JOIN o_words USING (col, name, feature) WHERE number <> 0")
def training_features(inp):
    """Features of the training set that are not 0, read back from the stored vectors."""
    from pyspark.ml.functions import vector_to_array

    from ..session import work_path

    rows, long = long_features(inp)
    words = features.vocabulary(long, ["rule_features"])
    sparse = features.sparse_rows(long, words, "event_id", rows.select("event_id", "label"))
    stored = features.write_features(sparse, words.count(), work_path(inp.spark, "features"))
    dense = stored.select("event_id", "label", F.posexplode(vector_to_array("features")).alias("index", "value")).where("value <> 0")
    return dense.join(words.select("index", "feature"), "index").select("event_id", "label", "feature", "value")


LANGS = ("de", "en", "es", "fr")
SOURCES = tuple(sorted(f"src{i}" for i in range(20)))


@query(
    "feature_matrix",
    "SELECT doc_id, label, "
    + num("n_chars", "embedding_similarity", "coalesce(employee_count, 0) AS employee_count", "industry_match", "geo_match", "0.0 AS name_similarity")
    + ", "
    + num(*[f"(industry = '{v}')::INT AS industry_{v}" for v in LANGS], *[f"(country = '{v}')::INT AS country_{v}" for v in SOURCES])
    + " FROM b_training_docs",
)
def feature_matrix(inp):
    return features_of(inp)[0]


@shared
def features_of(inp):
    docs = inp["b_training_docs"].withColumn(
        "rule_features", F.create_map(F.lit("industry_match"), F.col("industry_match"), F.lit("geo_match"), F.col("geo_match"))
    )
    categories = {c: learning.category_values(docs, c) for c in ("industry", "country")}
    return learning.feature_matrix(
        docs,
        ["n_chars", "embedding_similarity", "employee_count"],
        categories,
        mapped={"rule_features": ["industry_match", "geo_match", "name_similarity"]},
        keep=["doc_id", "label"],
    )


@query(
    "categorical_codes",
    """SELECT doc_id, dense_rank() OVER (ORDER BY industry) - 1 AS industry_code, dense_rank() OVER (ORDER BY country) - 1 AS country_code FROM b_training_docs""",
)
def categorical_codes(inp):
    coded = add_codes(add_codes(inp["b_training_docs"], "industry", "industry_code"), "country", "country_code")
    return coded.select("doc_id", "industry_code", "country_code")


@query("lr_train_eval")
def lr_train_eval(inp):
    """Metrics of a trained model; the model and its evaluation read back from their JSON files."""
    from ..session import work_path
    from ..sources.writers import write_document

    rows, names = features_of(inp)
    metrics, document = learning.train_and_evaluate(rows, names, "label", "doc_id", "2024-01-31T00:00:00")
    texts = {"model_json": document, "evaluation_json": learning.evaluation_document(document)}
    for name, content in texts.items():
        path = work_path(inp.spark, name)
        write_document(learning.model_frame(inp.spark, content, name), path)
        metrics = metrics.withColumn(name, inp.spark.read.json(path).select(name).scalar())
    return metrics


@query("feature_importance")
def feature_importance(inp):
    rows, names = features_of(inp)
    model, _ = learning.fit_logistic(rows, names, "label")
    linear = learning.weights_frame(inp.spark, "logistic_regression", names, [float(c) for c in model.coefficients])
    forest = learning.forest_importances(rows, names, "label")
    return learning.top_features(linear.unionByName(forest))


SCORE_MODEL = {"coefficients": [2.0, 0.0004, -0.6], "intercept": -1.0, "feature_order": ["embedding_similarity", "n_chars", "industry_en"]}
cte(
    "o_doc_scores",
    """SELECT doc_id, label, round(1 / (1 + exp(-(2.0 * embedding_similarity + 0.0004 * n_chars - 0.6 * CASE WHEN industry = 'en' THEN 1 ELSE 0 END - 1.0))), 3) AS score FROM b_training_docs""",
)


@shared
def doc_scores(inp):
    docs = inp["b_training_docs"]
    score = logistic_score(SCORE_MODEL, {c: F.col(c) for c in ("embedding_similarity", "n_chars")}, {"industry": F.col("industry")})
    scored = docs.select("doc_id", "label", F.round(score, 3).alias("score"))
    return scored.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


@query("confusion_matrix", "SELECT label AS actual, (score >= 0.5)::INTEGER AS predicted, count(*) AS n FROM o_doc_scores GROUP BY 1, 2")
def confusion_matrix(inp):
    return learning.confusion_counts(doc_scores(inp), "label", "prediction")


cte(
    "o_confusion",
    """SELECT count(*) FILTER (WHERE label = 0 AND score < 0.5)::DOUBLE AS tn, count(*) FILTER (WHERE label = 0 AND score >= 0.5)::DOUBLE AS fp,
       count(*) FILTER (WHERE label = 1 AND score < 0.5)::DOUBLE AS fn, count(*) FILTER (WHERE label = 1 AND score >= 0.5)::DOUBLE AS tp, count(*) AS n FROM o_doc_scores""",
)


@query(
    "classification_summary",
    f"""SELECT {num('(tp + tn) / n AS accuracy', '((tn + fp) * p0 + (tp + fn) * p1) / n AS precision', '((tn + fp) * r0 + (tp + fn) * r1) / n AS recall',
       '((tn + fp) * coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) + (tp + fn) * coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0)) / n AS f1_score')}, n AS samples
       FROM (SELECT *, coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tn / nullif(tn + fp, 0), 0) AS r0, coalesce(tp / nullif(tp + fn, 0), 0) AS r1 FROM o_confusion)""",
)
def classification_summary(inp):
    return learning.classification_summary(learning.confusion_counts(doc_scores(inp), "label", "prediction"))


cte(
    "o_points",
    """SELECT score AS threshold, sum(sum(label)) OVER w AS tp, sum(sum(1 - label)) OVER w AS fp, sum(label) AS pos, sum(1 - label) AS neg, (SELECT sum(label) FROM o_doc_scores) AS p, (SELECT sum(1 - label) FROM o_doc_scores) AS n
       FROM o_doc_scores GROUP BY score WINDOW w AS (ORDER BY score DESC)""",
)


@query("roc_curve", f"SELECT {num('threshold', 'fp / n AS fpr', 'tp / p AS tpr')} FROM o_points UNION ALL SELECT NULL, 0.0, 0.0")
def roc_curve(inp):
    return learning.roc_curve(doc_scores(inp), "label", "score")


@query("pr_curve", f"SELECT {num('threshold', 'tp / (tp + fp) AS precision', 'tp / p AS recall')} FROM o_points UNION ALL SELECT NULL, 1.0, 0.0")
def pr_curve(inp):
    return learning.pr_curve(doc_scores(inp), "label", "score")


@query("roc_auc", f"SELECT {num('sum(neg * (tp - pos / 2)) / (max(p) * max(n)) AS auc_score')} FROM o_points")
def roc_auc(inp):
    return learning.area_under_roc(doc_scores(inp), "label", "score")


#: Scored models of the evaluation record: name, weight of the similarity, of the text length, of English, and the intercept.
RIVALS = {"coarse": (1.5, 0.0, 0.0, -0.7), "linear": (2.0, 0.0004, -0.6, -1.0), "reversed": (-2.0, 0.0, 0.4, 0.8)}
WEIGHTED = ("embedding_similarity", "n_chars", "industry_en")
cte(
    "o_rival_scores",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS model_name, doc_id, label, doc_id % 5 AS fold,
        round(1 / (1 + exp(-({a} * embedding_similarity + {b} * n_chars + {c} * CASE WHEN industry = 'en' THEN 1 ELSE 0 END + {d}))), 2) AS score FROM b_training_docs"""
        for name, (a, b, c, d) in RIVALS.items()
    ),
)
cte(
    "o_rival_steps",
    """SELECT model_name, score, sum(label) AS pos, sum(1 - label) AS neg, sum(sum(label)) OVER w AS tp, sum(sum(1 - label)) OVER w AS fp, sum(sum(label)) OVER (PARTITION BY model_name) AS p, sum(sum(1 - label)) OVER (PARTITION BY model_name) AS n
       FROM o_rival_scores GROUP BY model_name, score WINDOW w AS (PARTITION BY model_name ORDER BY score DESC)""",
)
cte(
    "o_rival_line",
    """SELECT model_name, tp, fp, p, n, tp AS hits, tp + fp AS said FROM o_rival_steps UNION ALL SELECT DISTINCT model_name, 0, 0, p, n, 1, 1 FROM o_rival_steps""",
)
cte(
    "o_rival_bends",
    """SELECT model_name, count(*) FILTER (WHERE before IS NULL OR after IS NULL OR (fp - bf) * (af_tp - tp) <> (af_fp - fp) * (tp - bt)) AS roc_points,
       count(*) FILTER (WHERE before IS NULL OR after IS NULL OR NOT ((bt = tp AND tp = af_tp) OR (bh * said = hits * bs AND hits * asaid = ah * said))) AS pr_points,
       sum((fp - bf) * (tp + bt)) / (2.0 * max(p) * max(n)) AS auc, sum((tp - bt) * (hits / said + bh / bs)) / (2.0 * max(p)) AS pr_auc
       FROM (SELECT *, lag(said) OVER w AS before, lead(said) OVER w AS after, lag(fp) OVER w AS bf, lag(tp) OVER w AS bt, lead(fp) OVER w AS af_fp, lead(tp) OVER w AS af_tp, lag(hits) OVER w AS bh, lag(said) OVER w AS bs,
             lead(hits) OVER w AS ah, lead(said) OVER w AS asaid FROM o_rival_line WINDOW w AS (PARTITION BY model_name ORDER BY tp + fp)) GROUP BY model_name""",
)
cte(
    "o_rival_cells",
    """SELECT model_name, count(*) FILTER (WHERE label = 0 AND score < 0.5)::DOUBLE AS tn, count(*) FILTER (WHERE label = 0 AND score >= 0.5)::DOUBLE AS fp,
       count(*) FILTER (WHERE label = 1 AND score < 0.5)::DOUBLE AS fn, count(*) FILTER (WHERE label = 1 AND score >= 0.5)::DOUBLE AS tp, count(*) AS n FROM o_rival_scores GROUP BY model_name""",
)
cte(
    "o_rival_rates",
    """SELECT *, coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tn / nullif(tn + fp, 0), 0) AS r0, coalesce(tp / nullif(tp + fn, 0), 0) AS r1 FROM o_rival_cells""",
)
cte(
    "o_rival_folds",
    """SELECT model_name, avg(a) AS m, stddev_pop(a) AS s FROM (SELECT model_name, fold, avg(((score >= 0.5)::INT = label)::INT) AS a FROM o_rival_scores GROUP BY model_name, fold) GROUP BY model_name""",
)


@shared
def rival_scores(inp):
    docs, parts = inp["b_training_docs"], []
    for name, (*weights, intercept) in RIVALS.items():
        model = {"coefficients": weights, "intercept": intercept, "feature_order": list(WEIGHTED)}
        score = logistic_score(model, {c: F.col(c) for c in WEIGHTED[:2]}, {"industry": F.col("industry")})
        parts.append(docs.select(F.lit(name).alias("model_name"), "label", (F.col("doc_id") % 5).alias("fold"), F.round(score, 2).alias("score")))
    out, *rest = parts
    for part in rest:
        out = out.unionByName(part)
    return out.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


def rival_weights(inp):
    entries = [F.struct(F.lit(m).alias("model_name"), F.lit(f).alias("feature"), F.lit(float(w)).alias("weight")) for m, ws in RIVALS.items() for f, w in zip(WEIGHTED, ws, strict=False)]
    return inp.spark.range(1).select(F.explode(F.array(*entries)).alias("w")).select("w.*")


def feature_json(name: str) -> str:
    best = sorted(zip(WEIGHTED, RIVALS[name], strict=False), key=lambda f: (-abs(f[1]), f[0]))
    return "{" + ",".join(f'"{f}":{"4.0E-4" if w == 0.0004 else w}' for f, w in best) + "}"


@query(
    "evaluation_record",
    f"""SELECT '2024-01-31T00:00:00' AS evaluation_date, model_name, {num('(tp + tn) / n AS accuracy', '((tn + fp) * p0 + (tp + fn) * p1) / n AS precision', '((tn + fp) * r0 + (tp + fn) * r1) / n AS recall',
       '((tn + fp) * coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) + (tp + fn) * coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0)) / n AS f1_score',
       'auc AS auc_score', 'pr_auc AS pr_auc_score', 'm AS cross_val_mean', 's AS cross_val_std', 'auc AS stored_auc_score', 'pr_auc AS stored_pr_auc_score')}, n AS samples,
       '[[' || tn::BIGINT || ',' || fp::BIGINT || '],[' || fn::BIGINT || ',' || tp::BIGINT || ']]' AS confusion_matrix,
       CASE model_name {' '.join(f"WHEN '{m}' THEN '{feature_json(m)}'" for m in RIVALS)} END AS top_features, roc_points, pr_points, 2024 AS year, 1 AS month, 31 AS day, 't000000' AS run
       FROM o_rival_rates JOIN o_rival_bends USING (model_name) JOIN o_rival_folds USING (model_name)""",
)
def evaluation_record(inp):
    """The record read back from its files, beside the areas of the stored curves."""
    from ..session import work_path

    path = work_path(inp.spark, "evaluation")
    evaluation.write_evaluation(evaluation.evaluate(rival_scores(inp), rival_weights(inp), "2024-01-31T00:00:00"), path)
    roc, pr = (evaluation.read_evaluation(inp.spark, path, part).where("year = 2024 AND month = 1 AND day = 31") for part in ("roc_curve", "pr_curve"))
    areas = evaluation.roc_area(roc).join(evaluation.pr_area(pr), "model_name")
    areas = areas.select("model_name", F.col("auc_score").alias("stored_auc_score"), F.col("pr_auc_score").alias("stored_pr_auc_score"))
    return evaluation.read_evaluation(inp.spark, path).join(areas, "model_name")


@query(
    "evaluation_curves",
    f"""SELECT 'roc' AS curve, model_name, {num('fp / n AS x', 'tp / p AS y')} FROM (SELECT *, lag(fp) OVER w AS bf, lag(tp) OVER w AS bt, lead(fp) OVER w AS af, lead(tp) OVER w AS a_t FROM o_rival_line WINDOW w AS (PARTITION BY model_name ORDER BY tp + fp))
       WHERE bf IS NULL OR af IS NULL OR (fp - bf) * (a_t - tp) <> (af - fp) * (tp - bt)
       UNION ALL SELECT 'pr', model_name, {num('tp / p AS x', 'hits / said AS y')} FROM (SELECT *, lag(tp) OVER w AS bt, lag(hits) OVER w AS bh, lag(said) OVER w AS bs, lead(tp) OVER w AS a_t, lead(hits) OVER w AS ah, lead(said) OVER w AS asaid
       FROM o_rival_line WINDOW w AS (PARTITION BY model_name ORDER BY tp + fp)) WHERE bt IS NULL OR a_t IS NULL OR NOT ((bt = tp AND tp = a_t) OR (bh * said = hits * bs AND hits * asaid = ah * said))""",
)
def evaluation_curves(inp):
    """Both curves of every model, straight stretches reduced to their ends."""
    points = evaluation.threshold_points(rival_scores(inp), "label", "score")
    roc = evaluation.roc_points(points).select(F.lit("roc").alias("curve"), "model_name", F.col("fpr").alias("x"), F.col("tpr").alias("y"))
    pr = evaluation.pr_points(points).select(F.lit("pr").alias("curve"), "model_name", F.col("recall").alias("x"), F.col("precision").alias("y"))
    return roc.unionByName(pr)


@query("model_latest", f"SELECT model_type, model_version, {num('auc_score', 'pr_auc_score')}, training_date FROM b_model_versions WHERE training_date >= '2024-01-01'")
def model_latest(inp):
    return learning.model_latest(inp["b_model_versions"], START).select("model_type", "model_version", "auc_score", "pr_auc_score", "training_date")


@query("model_comparison", f"SELECT model_type, {num('avg(auc_score) AS avg_auc', 'avg(pr_auc_score) AS avg_pr_auc')}, count(*) AS model_count FROM b_model_versions WHERE training_date >= '2024-01-01' GROUP BY model_type")
def model_comparison(inp):
    return learning.model_comparison(inp["b_model_versions"], START)


@query(
    "model_promotion",
    f"""SELECT model_id, model_type, {num('round(auc_gain, 9) AS auc_gain', 'round(accuracy_gain, 9) AS accuracy_gain')}, training_samples >= 100 AS enough_samples, (first_model OR round(auc_gain, 9) > 0.01 OR round(accuracy_gain, 9) > 0.01) AS improvement,
       CASE WHEN auc_score > 0.8 THEN 'high' WHEN auc_score > 0.6 THEN 'medium' ELSE 'low' END AS performance_level
       FROM (SELECT *, lag(auc_score) OVER w IS NULL AS first_model, coalesce(auc_score - lag(auc_score) OVER w, 0) AS auc_gain, coalesce(accuracy - lag(accuracy) OVER w, 0) AS accuracy_gain
             FROM b_model_versions WINDOW w AS (PARTITION BY model_type ORDER BY training_date, model_id))""",
)
def model_promotion(inp):
    shown = ["model_id", "model_type", "auc_gain", "accuracy_gain", "enough_samples", "improvement", "performance_level"]
    return learning.model_promotion(inp["b_model_versions"]).select(*shown)


@query("text_vectors")
def text_vectors(inp):
    """Vector length and norm per document (the hash function is Spark's own)."""
    rows = learning.text_vectors(inp["documents"], "text", "doc_id")
    norm = F.sqrt(F.aggregate("embedding_vector", F.lit(0.0), lambda a, x: a + x * x))
    return rows.select("doc_id", F.size("embedding_vector").alias("dimensions"), F.round(norm, 4).alias("norm"))


cte(
    "o_words",
    r"""SELECT doc_id, word, count(*) AS times, ('0x' || substr(md5(word), 1, 8))::BIGINT % 262144 AS slot, if(substr(md5(word), 9, 1) < '8', 1.0, -1.0)::DOUBLE AS sign
       FROM (SELECT doc_id, unnest(string_split_regex(lower(text), '[^\p{L}\p{N}_]+')) AS word FROM documents) WHERE word <> '' GROUP BY ALL""",
)
cte(
    "o_entries",
    """SELECT doc_id, slot, sum(sign * times * ln(((SELECT count(DISTINCT doc_id) FROM documents) + 1) / (texts + 1))) AS value
       FROM o_words JOIN (SELECT word, count(*) AS texts FROM o_words GROUP BY word) USING (word) GROUP BY doc_id, slot""",
)


@query(
    "text_entries",
    f"""SELECT doc_id, slot, {num('if(size > 0, value / size, 0) AS value')}
       FROM (SELECT *, sqrt(sum(value * value) OVER (PARTITION BY doc_id)) AS size FROM o_entries)""",
)
def text_entries(inp):
    return learning.text_entries(inp["documents"], "text", "doc_id")


@query(
    "slot_collisions",
    """SELECT slot, count(*) AS words, CAST(sum(times) AS BIGINT) AS times, CAST(max(times) AS BIGINT) AS heaviest
       FROM (SELECT word, slot, sum(times) AS times FROM o_words GROUP BY ALL) GROUP BY slot HAVING count(*) > 1""",
)
def slot_collisions(inp):
    """Words of all whole documents that share a slot of the sketch."""
    return learning.slot_collisions(inp["documents"], "text", "doc_id")
