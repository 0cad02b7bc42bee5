"""Operators against brute force, with hot keys and ties."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from conftest import plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeprofile.functions import vectors
from lakeprofile.operators import aggregates, calendar, dedup, incremental, joins, matching, ordering
from lakeprofile.plans import crawl


def hot_rows(spark, n=3000):
    """A third of all rows share one group and one value."""
    return spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("grp"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 11).cast("int").alias("val"),
    )


def test_running_totals_match_a_plain_window(spark):
    rows = hot_rows(spark).withColumn("grp", F.when(F.col("grp") != "g1", F.col("grp")))
    got = ordering.running_totals(
        rows, [F.col("val").desc(), F.col("id").asc()], "pos", {"total": F.col("val")}, partition_by=["grp"], chunks=7
    )
    expected, state = {}, {}
    for r in sorted(rows.collect(), key=lambda r: (r["grp"] or "", -r["val"], r["id"])):
        pos, total = state.get(r["grp"], (0, 0))
        state[r["grp"]] = (pos + 1, total + r["val"])
        expected[r["id"]] = state[r["grp"]]
    assert {r["id"]: (r["pos"], r["total"]) for r in got.collect()} == expected


def test_hot_group_is_spread_over_chunks(spark):
    """No chunk of a full ranking holds more than a small multiple of the mean."""
    rows = hot_rows(spark, 12000)
    ranged = rows.repartitionByRange(8, F.col("grp"), F.col("val").desc(), F.col("id"))
    sizes = [r["count"] for r in ranged.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2.5 * 12000 / 8


def test_top_n_is_trimmed_before_the_shuffle(spark):
    plan = plan_of(ordering.top_n(hot_rows(spark), ["grp"], [F.col("val").desc(), F.col("id").asc()], 3))
    lines = plan.splitlines()
    partial = next(i for i, x in enumerate(lines) if "Partial" in x)
    exchange = next(i for i, x in enumerate(lines) if "Exchange" in x)
    assert exchange < partial  # the partial limit runs below the exchange


def test_percent_rank_matches_spark(spark):
    from pyspark.sql import Window

    rows = hot_rows(spark, 500).withColumn("score", F.when(F.col("id") % 17 != 0, F.col("val") / 10.0))
    got = ordering.percent_rank(rows, "score", "p")
    plain = rows.withColumn("p", F.percent_rank().over(Window.orderBy(F.col("score").asc_nulls_first())))
    assert {r["id"]: round(r["p"], 9) for r in got.collect()} == {r["id"]: round(r["p"], 9) for r in plain.collect()}
    single = ordering.percent_rank(rows.where("id = 1"), "score", "p").first()
    assert single["p"] == 0.0


def test_chunk_count_follows_size(spark):
    assert ordering.chunk_count(spark.range(10)) == 1
    assert ordering.chunk_count(spark.range(100_000)) == 4
    assert ordering.chunk_count(spark.range(10_000_001)) == 6


def test_mark_duplicates_keeps_every_row(spark):
    rows = hot_rows(spark, 300)
    got = dedup.mark_duplicates(rows, "grp", "grp", [F.col("val").asc(), F.col("id").asc()], ["val", "id"], "dup").collect()
    assert len(got) == 300
    winners = [r for r in got if r["is_primary_record"]]
    assert len(winners) == len({r["grp"] for r in got})
    assert all((r["duplicate_reason"] is None) == r["is_primary_record"] for r in got)
    for w in winners:
        assert (w["val"], w["id"]) == min((r["val"], r["id"]) for r in got if r["grp"] == w["grp"])


@pytest.fixture()
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


@pytest.mark.parametrize("join", [joins.lookup_join, joins.probe_join])
@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_lookup_join_equals_a_plain_join(spark, no_broadcast, how, join):
    rows = hot_rows(spark, 2000).withColumn("grp", F.when(F.col("grp") != "g3", F.col("grp")))
    lookup = rows.where("grp <> 'g4' OR grp IS NULL").groupBy("grp").agg(F.max("val").alias("top"))
    got = join(rows, lookup, "grp", how)
    want = rows.join(lookup, "grp", how)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_probe_join_reads_its_rows_once_and_splits_a_hot_key(spark, no_broadcast, tmp_path):
    """The lookup is an aggregate on the same key; AQE alone leaves such a join in one task."""
    hot_rows(spark, 60_000).withColumn("body", F.sha2(F.col("id").cast("string"), 512)).repartition(8).write.parquet(str(tmp_path / "wide"))
    rows = spark.read.parquet(str(tmp_path / "wide"))
    hot_rows(spark, 900).write.parquet(str(tmp_path / "narrow"))
    lookup = spark.read.parquet(str(tmp_path / "narrow")).groupBy("grp").agg(F.max("val").alias("top"))
    assert plan_of(joins.probe_join(rows, lookup, "grp", "inner")).count("/wide") == 1
    assert plan_of(joins.lookup_join(rows, lookup, "grp", "inner")).count("/wide") > 1
    small = {
        "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:

        def largest(df):
            out = str(tmp_path / f"out{len(list(tmp_path.iterdir()))}")
            df.withColumn("task", F.spark_partition_id()).write.parquet(out)
            per_task = spark.read.parquet(out).where("grp = 'hot'").groupBy("task").count()
            return max(r["count"] for r in per_task.collect())

        hot = rows.where("grp = 'hot'").count()
        assert largest(rows.join(lookup, "grp")) == hot
        assert largest(joins.probe_join(rows, lookup, "grp", "inner")) < 0.7 * hot
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_hot_rows_of_a_join_meet_in_several_tasks(spark, no_broadcast):
    """Joining to an aggregate on the same key, where AQE does not split."""
    rows = hot_rows(spark, 8000)
    lookup = rows.groupBy("grp").agg(F.max("val").alias("top"))

    def largest(df):
        per_task = df.where("grp = 'hot'").groupBy(F.spark_partition_id()).count()
        return max(r["count"] for r in per_task.collect())

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        hot = rows.where("grp = 'hot'").count()
        assert largest(rows.join(lookup, "grp")) == hot
        assert largest(joins.lookup_join(rows, lookup, "grp", "inner")) < 0.7 * hot
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def one_edit(a: str, b: str) -> bool:
    if a == b:
        return True
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="abc", min_size=0, max_size=6), min_size=1, max_size=40))
def test_near_names_match_brute_force(spark, names):
    keyed = [(f"k{i:03d}", n) for i, n in enumerate(names)]
    rows = spark.createDataFrame(keyed, "key string, name string")
    kept = {r["key"] for r in dedup.survivors_by_near_name(rows, "key", "name").collect()}
    want = set()
    for k, n in keyed:  # in the order of their keys
        if not any(one_edit(n, dict(keyed)[k2]) for k2 in want):
            want.add(k)
    assert kept == want


def near(spark, *names):
    rows = spark.createDataFrame([(f"k{i:03d}", n) for i, n in enumerate(names)], "key string, name string")
    return [names[int(r["key"][1:])] for r in dedup.survivors_by_near_name(rows, "key", "name").orderBy("key").collect()]


def test_a_name_goes_for_one_that_stays_only(spark):
    assert near(spark, "xxab", "xxabc", "xxabcd") == ["xxab", "xxabcd"]
    assert near(spark, *["a" * n for n in range(1, 8)]) == ["a", "aaa", "aaaaa", "aaaaaaa"]
    assert near(spark, "ab", "ba", "a b", "AB ") == ["ab", "ba"]
    assert near(spark, "", "x", "xy", "😀y", "😀") == ["", "xy"]
    assert near(spark, "ab😀", "ab", "abé😀", "b😀a") == ["ab😀", "b😀a"]  # a letter beyond the first plane is one letter


def test_near_names_are_linear_in_a_long_name(spark):
    body = "".join(chr(97 + i * 7 % 26) for i in range(10_000))
    names = [body, body[:5000] + "#" + body[5001:], body[:9999], body[:20] + "##" + body[22:], body[:20] + "##" + body[22:] + "!"]
    assert near(spark, *names) == [names[0], names[3]]
    rows = spark.createDataFrame([(f"k{i}", n) for i, n in enumerate(names)], "key string, name string")
    labels = dedup.name_labels(rows, "key", "name")
    assert labels.count() <= sum(2 * len(n) + 1 for n in names)
    assert max(len(str(r)) for r in labels.limit(50).collect()) < 300  # no label holds a name


def test_null_names_and_links_stay(spark):
    rows = spark.createDataFrame([("a", None, None), ("b", None, " "), ("c", "x", "L"), ("d", "y", "l ")], "key string, name string, link string")
    assert dedup.survivors_by_near_name(rows.drop("link"), "key", "name").count() == 3  # x and y are one edit apart
    assert sorted(r["key"] for r in dedup.survivors_by_link(rows, "key", "link").collect()) == ["a", "b", "c"]


def test_array_unions(spark):
    rows = spark.createDataFrame(
        [("k", ["b", "a"], None), ("k", ["a", None], ["z"]), ("m", [], None)], "key string, x array<string>, y array<string>"
    )
    got = {r["key"]: (r["x"], r["y"]) for r in aggregates.array_unions(rows, "key", ["x", "y"]).collect()}
    assert got == {"k": (["a", "b"], ["z"])}


def test_a_key_with_a_million_elements_is_no_row(spark):
    """The table of elements spreads over all tasks; its largest row holds one element."""
    rows = spark.range(2_000).select(
        F.lit("hot").alias("key"), F.transform(F.sequence(F.lit(0), F.lit(499)), lambda i: F.concat(F.lit("e"), (F.col("id") * 500 + i).cast("string"))).alias("x"),
        F.array(F.lit("a"), F.lit(None).cast("string"), F.lit("a")).alias("y"),
    )
    counted = aggregates.element_counts(rows, "key", ["x", "y"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        per_task = [r["count"] for r in counted.where("column = 'x'").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(per_task) == 1_000_000 and max(per_task) < 400_000
    assert [tuple(r) for r in counted.where("column = 'y'").collect()] == [("hot", "y", "a", 4_000)]


def test_missing_days(spark):
    rows = spark.createDataFrame([("t", "2024-01-30"), ("t", "2024-01-31"), ("u", "2024-01-31")], "table_name string, dt string")
    got = calendar.missing_partitions(rows, ["t", "u", "v"], "2024-01-31", days=1)
    assert {tuple(r) for r in got.collect()} == {("2024-01-30", "u"), ("2024-01-30", "v"), ("2024-01-31", "v")}


# --- matching ------------------------------------------------------------------


def match_frames(spark, n_challenges=12, n_candidates=90, dims=5):
    rng = random.Random(3)
    texts = ["software from Canada", "solar plants in Germany", "words only", "Acme Robotics Group builds"]
    challenges = spark.createDataFrame(
        [(f"c{i}", texts[i % 4], [rng.uniform(-1, 1) for _ in range(dims)]) for i in range(n_challenges)],
        "challenge_id string, text string, vector array<double>",
    )
    candidates = spark.createDataFrame(
        [
            (f"k{i:03d}", "acme robotics" if i % 9 == 0 else f"firm {i}", ["technology", "energy", "other"][i % 3], ["canada", "germany"][i % 2],
             [0.0] * dims if i % 30 == 0 else [rng.uniform(-1, 1) for _ in range(dims)], None)
            for i in range(n_candidates)
        ],
        "company_key string, company_name string, industry string, country string, embedding_vector array<double>, updated_at timestamp",
    )
    return challenges, candidates


def brute_force(challenges, candidates, k):
    out = {}
    for q in challenges.collect():
        industry = next((w for w in ("technology", "energy") if {"technology": "software", "energy": "solar"}[w] in q["text"]), "")
        country = next((c for c in ("canada", "germany") if c in q["text"].lower()), "")
        rows = []
        for c in candidates.collect():
            a, b = np.array(q["vector"]), np.array(c["embedding_vector"])
            norm = np.linalg.norm(a) * np.linalg.norm(b)
            sim = float(a @ b / norm) if norm else 0.0
            z = 0.5 * sim + 0.3 * (industry != "" and industry in c["industry"]) + 0.2 * (country != "" and country in c["country"])
            rows.append((-(0.7 * sim + 0.3 / (1 + math.exp(-z))), c["company_key"]))
        out[q["challenge_id"]] = [key for _, key in sorted(rows)[:k]]
    return out


def ranked_keys(found):
    ranked = {}
    for r in sorted(found.collect(), key=lambda r: (r["challenge_id"], r["rank"])):
        ranked.setdefault(r["challenge_id"], []).append(r["company_key"])
    return ranked


@pytest.mark.parametrize("cells", [(20_000, 256), (13, 4), (3, 30)])
def test_matching_is_exact_for_any_number_of_cells(spark, cells):
    challenges, candidates = match_frames(spark)
    got = matching.match_topk(challenges, candidates, k=7, part_candidates=cells[0], centres=cells[1])
    assert ranked_keys(got) == brute_force(challenges, candidates, 7)


@pytest.mark.parametrize("asked", [1, 5_000])
def test_matching_with_ties_and_many_challenges(spark, asked):
    """Candidates in tight groups, every vector three times: ties go by key, whatever cells are left out."""
    rng = np.random.default_rng(5)
    around = rng.normal(size=(20, 16))
    base = np.repeat(around, 10, axis=0) + 0.05 * rng.normal(size=(200, 16))
    vectors = np.repeat(base, 3, axis=0)
    questions = around[rng.integers(0, 20, asked)] + 0.05 * rng.normal(size=(asked, 16))
    keys = [f"k{i:04d}" for i in rng.permutation(len(vectors))]
    candidates = spark.createDataFrame([(k, "", "", "", v.tolist()) for k, v in zip(keys, vectors, strict=True)], "company_key string, company_name string, industry string, country string, embedding_vector array<double>")
    challenges = spark.createDataFrame([(f"c{i:05d}", "", v.tolist()) for i, v in enumerate(questions)], "challenge_id string, text string, vector array<double>")
    got = ranked_keys(matching.match_topk(challenges, candidates, k=8, part_candidates=25, centres=24))
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    sims = np.round(unit(questions) @ unit(vectors).T, 12)
    for i in range(0, asked, max(1, asked // 400)):
        want = sorted(range(len(keys)), key=lambda j: (-sims[i, j], keys[j]))[:8]
        assert got[f"c{i:05d}"] == [keys[j] for j in want]
    assert len(got) == asked


def test_far_cells_are_left_out(spark):
    """Bounds hold for every pair and leave out most cells of grouped vectors."""
    rng = np.random.default_rng(6)
    around = rng.normal(size=(12, 16))
    cells = [matching.Cell(16, c / np.linalg.norm(c), 0.0, 0.1, 50, 1) for c in around]
    weights = matching.Weights(0.5, 0.3, 0.2, 0.0)
    asked = pd.DataFrame({"q_row": [0], "q_vector": [around[4]]})
    (routes,) = list(matching._route(cells, weights, 20)(iter([asked])))
    assert routes[routes["first"]]["cell"].tolist() == [4]
    inside = [np.cos(np.arccos(cells[4].centre @ c.centre) - 0.1) for c in cells]
    for cell, bound, sim in zip(routes["cell"], routes["bound"], inside, strict=True):
        assert bound >= weights.final(np.array(1.0 if cell == 4 else sim), 0.5)[1]
    assert (routes["bound"] >= weights.final(np.array(np.cos(0.1)), 0.0)[1]).sum() < 4


def test_matching_of_empty_tables_and_repeated_rows(spark):
    challenges, candidates = match_frames(spark, n_candidates=4)
    assert matching.match_topk(challenges.limit(0), candidates).count() == 0
    assert matching.match_topk(challenges, candidates.limit(0)).count() == 0
    twice = ranked_keys(matching.match_topk(challenges, candidates.unionAll(candidates), k=3, part_candidates=2))
    assert all(len(v) == 3 and v[0] == v[1] for v in twice.values())


def test_match_reasons(spark):
    challenges, candidates = match_frames(spark)
    rows = matching.match_topk(challenges, candidates, k=90).collect()
    named = [r for r in rows if r["challenge_id"] == "c3" and r["company_name"] == "acme robotics"]
    assert named and all("Company name similarity" in r["reason"] for r in named)
    assert any("Industry match" in r["reason"] for r in rows if r["challenge_id"] == "c0")


def test_similarity_of_jvm_and_numpy_agree(spark):
    challenges, candidates = match_frames(spark)
    got = matching.match_topk(challenges, candidates, k=90)
    pairs = got.join(challenges, "challenge_id").join(candidates.select("company_key", "embedding_vector"), "company_key")
    gap = pairs.select(F.max(F.abs(F.col("embedding_similarity") - vectors.cosine("vector", "embedding_vector")))).first()[0]
    assert gap < 1e-9


@pytest.mark.parametrize("cells", [(20_000, 256), (2, 4)])
def test_vectors_of_other_widths_score_alone(spark, cells):
    """A vector of another width, an empty or a missing number in one changes no other score."""
    schema = "challenge_id string, text string, vector array<double>"
    asked = spark.createDataFrame([("a", "", [1.0, 0.0]), ("b", "", [0.0, 0.0, 2.0])], schema)
    offered = spark.createDataFrame(
        [("x", [3.0, 0.0]), ("y", [3.0, 4.0]), ("z", [1.0, 1.0, 1.0]), ("n", [None, 1.0]), ("e", [])], "company_key string, embedding_vector array<double>"
    ).selectExpr("*", "'' AS company_name", "'' AS industry", "'' AS country")
    got = matching.match_topk(asked, offered, part_candidates=cells[0], centres=cells[1]).collect()
    scores = {(r.challenge_id, r.company_key): round(r.embedding_similarity, 9) for r in got}
    third = round(1 / math.sqrt(3), 9)
    assert scores == {("a", "x"): 1.0, ("a", "y"): 0.6, ("a", "z"): 0.0, ("a", "n"): 0.0, ("b", "x"): 0.0, ("b", "y"): 0.0, ("b", "z"): third, ("b", "n"): 0.0}


# --- increments ------------------------------------------------------------------


def test_watermark_never_moves_back(spark):
    rows = spark.createDataFrame([(1, "2024-01-05 00:00:00")], "id int, t string").select("id", F.col("t").cast("timestamp_ntz").alias("updated_at"))
    late = F.lit("2024-02-01").cast("timestamp_ntz")
    early = F.lit("2024-01-01").cast("timestamp_ntz")
    assert str(incremental.watermark_advance(rows, late).first()[0]) == "2024-02-01 00:00:00"
    assert str(incremental.watermark_advance(rows, early).first()[0]) == "2024-01-05 00:00:00"
    assert str(incremental.watermark_advance(rows.limit(0), early).first()[0]) == "2024-01-01 00:00:00"


def test_upsert_is_idempotent(spark):
    schema = "k string, v int, t int"
    current = spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], schema)
    updates = spark.createDataFrame([("a", 2, 2), ("c", 1, 1), ("b", 0, 0)], schema)
    once = incremental.upsert_latest(current, updates, "k", "t")
    twice = incremental.upsert_latest(once, updates, "k", "t")
    want = {("a", 2, 2), ("b", 1, 1), ("c", 1, 1)}
    assert {tuple(r) for r in once.collect()} == want == {tuple(r) for r in twice.collect()}


def test_content_that_came_back_is_changed(spark):
    """The newest stored hash counts, not any hash the key ever had."""
    current = spark.createDataFrame([("back", "A"), ("same", "A"), ("new", "A"), ("unhashed", None), ("bare", None), ("tied", "B")], "k string, now string")
    stored = spark.createDataFrame(
        [("back", "A", 1), ("back", "B", 2), ("same", "B", 1), ("same", "A", 2), ("same", "C", None), ("unhashed", "A", 1), ("bare", None, 1), ("tied", "A", 1), ("tied", "B", 1)], "k string, old string, at int"
    )
    got = incremental.changed_rows(current, stored, "k", "now", "old", "at")
    assert sorted(r["k"] for r in got.collect()) == ["back", "new", "unhashed"]


def test_crawl_candidates_use_the_last_check(spark):
    health = spark.createDataFrame([("drift", 0.9), ("kept", 0.9), ("ill", 0.1), ("never", 0.7)], "k string, health_score double")
    checks = spark.createDataFrame([("drift", "A", "A", 1), ("drift", "A", "B", 2), ("kept", "A", "B", 1), ("kept", "B", "B", 2), ("ill", "A", "B", 1)], "k string, prev_hash string, content_hash string, at int")
    rows = crawl.crawl_candidates(health, checks, "k", "at").collect()
    assert sorted(r["k"] for r in rows) == ["drift", "never"]


def test_budget_gate_stops_on_money_and_count(spark):
    rows = spark.createDataFrame([(i, 0.1) for i in range(10)], "id int, cost double")
    gate = lambda budget, items: [
        r["id"] for r in incremental.budget_gate(rows, ["id"], [F.col("id").asc()], F.col("cost"), budget, items).collect() if r["admitted"]
    ]
    assert sorted(gate(0.3, 100)) == [0, 1, 2]  # exactly on the budget passes
    assert sorted(gate(5.0, 4)) == [0, 1, 2, 3]


def test_evict_below_threshold_keeps_all(spark):
    rows = spark.range(50).select("id", F.col("id").alias("created"))
    assert incremental.evict_oldest(rows, "created", ["id"], threshold=51).count() == 50
    left = incremental.evict_oldest(rows, "created", ["id"], threshold=50)
    assert sorted(r["id"] for r in left.collect()) == list(range(10, 50))


def test_expired_cache_is_a_miss(spark):
    work = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    cache = spark.createDataFrame([("a", 10), ("b", 5)], "k string, expires_at int")
    misses = incremental.cache_misses(work, cache, ["k"], "expires_at", F.lit(5))
    assert sorted(r["k"] for r in misses.collect()) == ["b", "c"]


def test_quota_flags(spark):
    calls = spark.range(60).select(F.lit("2024-01-01 00:00:30").cast("timestamp_ntz").alias("ts"))
    got = {r["width"]: (r["calls"], r["over_limit"]) for r in incremental.quota_windows(calls, "ts").collect()}
    assert got == {"1 minute": (60, True), "1 hour": (60, False), "1 day": (60, False)}


def test_model_scoring_by_prefix(spark):
    model = {"coefficients": [1.0, 2.0, 5.0], "intercept": -1.0, "feature_order": ["x", "industry_a", "nobody"]}
    score = matching.logistic_score(model, {"x": F.col("x")}, {"industry": F.col("industry")})
    rows = spark.createDataFrame([(0.0, "b"), (0.0, "a"), (None, None)], "x double, industry string")
    got = [r[0] for r in rows.select(score).collect()]
    assert got == pytest.approx([1 / (1 + math.e), 1 / (1 + math.exp(-1)), 1 / (1 + math.e)])
