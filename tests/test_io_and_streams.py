"""Files, tables, plans and streams."""

import pytest
from conftest import SMALL, plan_of
from pyspark.sql import functions as F

from lakeprofile.operators import keyed_table
from lakeprofile.operators.incremental import default_watermark, delta_read, quota_windows, upsert_latest
from lakeprofile.plans import ledger, quality
from lakeprofile.registry import ORACLES, QUERIES, stream_queries
from lakeprofile.registry.core import Inputs
from lakeprofile.session import shared_root, work_path
from lakeprofile.sources import maintenance, readers, writers
from lakeprofile.streaming import streams


def test_partition_predicate_prunes_folders(spark, tmp_path):
    rows = spark.range(40).select("id", F.concat(F.lit("2024-01-"), F.lpad((F.col("id") % 20 + 1).cast("string"), 2, "0")).alias("dt"))
    writers.write_by_day(rows, str(tmp_path / "t"))
    kept = readers.between_dates(readers.read_parquet(spark, str(tmp_path / "t"), rows.schema), "2024-01-10", "2024-01-12")
    assert "PartitionFilters: [isnotnull(dt" in plan_of(kept, "simple")
    assert kept.count() == 6 and kept.select(F.input_file_name()).distinct().count() <= 6


def test_hot_day_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("body"), F.lit("2024-01-01").alias("dt"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        writers.write_by_day(rows, str(tmp_path / "t"), rebalance=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = list((tmp_path / "t" / "dt=2024-01-01").glob("*.parquet"))
    assert len(files) > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 60_000


def test_promotion_refuses_an_empty_stage(spark, tmp_path):
    rows = spark.range(3).select("id", F.lit("2024-01-01").alias("dt"))
    target = str(tmp_path / "target")
    writers.write_by_day(rows, target)
    with pytest.raises(ValueError, match="staged 0 rows"):
        writers.stage_and_promote(rows.limit(0), str(tmp_path / "s"), target, ["dt"])
    assert spark.read.parquet(target).count() == 3


def test_json_reader_skips_bad_lines(spark, tmp_path):
    folder = tmp_path / "j" / "date=2024-01-01"
    folder.mkdir(parents=True)
    (folder / "a.jsonl").write_text('{"a": 1}\n\n{"a": \nnot json\n{"a": 2}\n')
    got = readers.read_json_skip_bad(spark, str(tmp_path / "j"), "a int")
    assert sorted(r["a"] for r in got.collect()) == [1, 2]


def test_csv_quotes_and_escapes(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n"p, ""q",1\n"x \\" y",2\n')
    rows = spark.createDataFrame([('say "hi", ok', 1), (" keep ", 2), (None, 3)], "a string, b int")
    writers.write_csv(rows, str(tmp_path / "c"))
    back = readers.read_csv(spark, str(tmp_path / "c"), "a string, b int")
    assert {tuple(r) for r in back.collect()} == {('say "hi", ok', 1), (" keep ", 2), (None, 3)}


def test_newest_file_wins(spark, tmp_path):
    import os

    for age, name in ((100, "new.json"), (900, "old.json")):
        f = tmp_path / name
        f.write_text(f'[\n {{"v": "{name}"}}\n]')
        os.utime(f, (2_000_000_000 - age, 2_000_000_000 - age))
    assert [r["v"] for r in readers.newest_file(spark, str(tmp_path), "v string").collect()] == ["new.json"]


def test_newest_of_files_of_one_time(spark, tmp_path):
    """The highest number in the name, not the last name."""
    import os

    for name in ("export-9.json", "export-10.json", "export-1.json", "zz.json"):
        f = tmp_path / name
        f.write_text(f'[\n {{"v": "{name}"}}\n]')
        os.utime(f, (2_000_000_000, 2_000_000_000))
    assert [r["v"] for r in readers.newest_file(spark, str(tmp_path), "v string").collect()] == ["export-10.json"]


def test_stage_is_dropped_after_promotion(spark, tmp_path):
    rows = spark.range(3).select("id", F.lit("2024-01-01").alias("dt"))
    stage, target = tmp_path / "stage", tmp_path / "target"
    assert writers.stage_and_promote(rows, str(stage), str(target), ["dt"]) == 3
    assert not stage.exists() and spark.read.parquet(str(target)).count() == 3
    with pytest.raises(ValueError, match="staged 0 rows"):
        writers.stage_and_promote(rows.limit(0), str(stage), str(target), ["dt"])
    assert stage.exists()


def test_catalog_record_reads_back_what_was_set(spark, tmp_path):
    name = "noted_table"
    maintenance.create_dated_table(spark, name, "a int, dt string", str(tmp_path / "t"), "first's")
    try:
        maintenance.set_comments(spark, name, "it's a \\ \"table\"", {"a": "a's column"})
        maintenance.set_properties(spark, name, {"owner's": "x = 'y'"})
        maintenance.add_partition(spark, name, "2024-01-01")
        got = {tuple(r) for r in maintenance.catalog_record(spark, name).collect()}
        assert got == {
            ("table", "", "it's a \\ \"table\"", ""), ("column", "a", "int", "a's column"), ("column", "dt", "string", ""), ("property", "owner's", "x = 'y'", ""), ("partition", "2024-01-01", "", ""),
        }
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_layers_and_retention(spark, tmp_path):
    maintenance.create_layers(spark, str(tmp_path), {"bronze_t": 90, "gold_t": 730})
    described = {r[0]: r[1] for r in spark.sql("DESCRIBE DATABASE EXTENDED bronze_t").collect()}
    assert "retention_days" in described["Properties"]
    spark.sql("DROP DATABASE bronze_t")
    spark.sql("DROP DATABASE gold_t")


def test_missing_checkpoint_folder_is_an_error_on_a_cluster(spark):
    assert shared_root(spark)
    assert work_path(spark, "a") != work_path(spark, "a")


# --- streams equal batch ----------------------------------------------------------


@pytest.fixture()
def events(spark, tmp_path):
    """Updates in four files, so that four micro-batches run."""
    rows = Inputs(spark, SMALL)["b_updates"]
    path = str(tmp_path / "in")
    rows.repartition(4, "event_id").write.parquet(path)
    return rows, path


def test_stream_upsert_equals_batch_and_resumes(spark, tmp_path, events):
    rows, path = events
    table, progress = str(tmp_path / "keyed"), str(tmp_path / "progress")
    keyed_table.create(rows.limit(0), table, "company_key", 3)

    def run():
        stream = streams.file_stream(spark, path, rows.schema, files_per_batch=1)
        streams.stream_upsert(stream, table, progress, "company_key", "updated_at", 3, ["event_id"])
        return {(r["company_key"], r["event_id"]) for r in keyed_table.read(spark, table, rows.schema).collect()}

    batch = upsert_latest(rows, rows.limit(0), "company_key", "updated_at", ["event_id"])
    assert run() == {(r["company_key"], r["event_id"]) for r in batch.collect()}
    newer = rows.where("company_key = '1'").withColumns({"event_id": F.col("event_id") + 10**6, "updated_at": F.col("updated_at") + F.expr("INTERVAL 1 YEAR")})
    newer.coalesce(1).write.mode("append").parquet(path)
    again = run()  # only the new file is read
    assert max(int(e) for k, e in again if k == "1") >= 10**6


def status(df):
    return {(r["width"], str(r["window_start"]), r["calls"], r["over_limit"]) for r in df.collect()}


@pytest.mark.parametrize("lateness", ["60 DAYS", "1 HOUR"])
def test_stream_quota_on_time_and_late_calls_are_all_calls(spark, tmp_path, lateness):
    calls = Inputs(spark, SMALL)["b_api_calls"]
    calls = calls.unionByName(calls.limit(1).withColumn("call_id", F.lit(-1).cast("long")).withColumn("called_at", F.lit(None).cast(calls.schema["called_at"].dataType)))
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    calls.repartition(3, "call_id").write.parquet(path)
    streams.stream_quota(streams.file_stream(spark, path, calls.schema, files_per_batch=1), "called_at", out, str(tmp_path / "progress"), lateness)
    late = streams.late_calls(spark, out, calls.schema)
    assert late.where("call_id = -1").count() == 1 and (late.count() > 1) == (lateness == "1 HOUR")
    on_time = calls.join(late.select("call_id"), "call_id", "left_anti")
    assert status(streams.quota_status(spark, out)) == status(quota_windows(on_time, "called_at"))
    if lateness == "60 DAYS":
        assert status(streams.quota_status(spark, out)) == status(quota_windows(calls, "called_at"))


class Killed(Exception):
    pass


def killer(step, batch):
    """Fails once behind a step of a batch, as a lost driver would."""
    left = [1]

    def after(now, number):
        if left and now == step and number == batch:
            left.clear()
            raise Killed

    return after


@pytest.mark.parametrize("step, batch", [("rows", 1), ("late", 1), ("marks", 1), ("rows", 0), ("marks", 2)])
def test_killed_delta_neither_skips_nor_repeats(spark, tmp_path, events, step, batch):
    rows, path = events
    start = F.lit("2024-01-05 00:00:00")

    def run(out, progress, after=None):
        stream = streams.file_stream(spark, path, rows.schema, files_per_batch=1)
        streams.stream_delta(stream, ["profile_text"], "updated_at", out, progress, start, after)

    def state(out):
        parts = [sorted((r["event_id"], r["batch"]) for r in streams.read_delta(spark, out, rows.schema, part).collect()) for part in ("rows", "late")]
        return [*parts, streams.read_watermark(spark, out).first()[0]]

    run(str(tmp_path / "whole"), str(tmp_path / "p1"))
    out, progress, after = str(tmp_path / "killed"), str(tmp_path / "p2"), killer(step, batch)
    with pytest.raises(Exception, match="Killed"):
        run(out, progress, after)
    run(out, progress, after)
    got = state(out)
    assert got == state(str(tmp_path / "whole"))
    taken = [e for e, _ in got[0] + got[1]]
    assert sorted(taken) == sorted(r["event_id"] for r in rows.where("profile_text <> ''").select("event_id").collect())
    newest = rows.where("profile_text <> ''").agg(F.max("updated_at")).first()[0]
    assert got[2] == newest.replace(tzinfo=None)


def test_delta_readers_do_not_see_an_unfinished_batch(spark, tmp_path, events):
    rows, path = events
    out = str(tmp_path / "out")
    stream = streams.file_stream(spark, path, rows.schema, files_per_batch=1)
    with pytest.raises(Exception, match="Killed"):
        streams.stream_delta(stream, ["profile_text"], "updated_at", out, str(tmp_path / "p"), F.lit("2024-01-01"), killer("late", 1))
    assert {r["batch"] for r in streams.read_delta(spark, out, rows.schema).select("batch").distinct().collect()} == {0}
    later = rows.limit(5).withColumn("updated_at", F.col("updated_at") + F.expr("INTERVAL 1 YEAR"))
    streams.stream_delta(stream, ["profile_text"], "updated_at", out, str(tmp_path / "p"), F.lit("2030-01-01"))  # the start of a first run does not count here
    before = streams.read_watermark(spark, out).first()[0]
    later.coalesce(1).write.mode("append").parquet(path)
    streams.stream_delta(stream, ["profile_text"], "updated_at", out, str(tmp_path / "p"), F.lit("2030-01-01"))
    assert streams.read_watermark(spark, out).first()[0] > before


@pytest.mark.parametrize("step", ["minutes", "late", "marks"])
def test_killed_quota_counts_no_call_twice(spark, tmp_path, step):
    calls = Inputs(spark, SMALL)["b_api_calls"]
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    calls.repartition(3, "call_id").write.parquet(path)
    after = killer(step, 1)
    for _ in range(2):
        try:
            streams.stream_quota(streams.file_stream(spark, path, calls.schema, files_per_batch=1), "called_at", out, str(tmp_path / "progress"), "60 DAYS", after)
        except Exception as error:  # noqa: BLE001
            assert "Killed" in str(error)
    assert status(streams.quota_status(spark, out)) == status(quota_windows(calls, "called_at"))


# --- plans ----------------------------------------------------------------------------

# Queries that run actions while they are built; their plans show only the tail.
ROW_LOGIC = [
    "silver_companies", "silver_vendor_companies", "silver_contacts", "silver_domain_health", "silver_web_extracts", "gold_profiles",
    "startup_profiles_b", "dq_issues", "keyword_extract", "probe_flags", "crawl_normalize", "ams_challenge", "prompt_build",
]


@pytest.mark.parametrize("name", ROW_LOGIC)
def test_row_logic_stays_in_the_jvm(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert "Python" not in plan and "InPandas" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_no_query_uses_a_cross_join(spark):
    for name in ("company_analytics", "roc_curve", "run_averages", "missing_partitions", "summary_queue", "cache_evict"):
        plan = plan_of(QUERIES[name](spark, SMALL))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_scan_reads_only_needed_columns(spark):
    plan = plan_of(QUERIES["events_by_type"](spark, SMALL), "formatted")
    schema = next(x for x in plan.splitlines() if x.startswith("ReadSchema"))
    assert "value" not in schema and "props" not in schema


def test_watermark_reaches_the_scan(spark, tmp_path):
    rows = spark.range(100).select("id", (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.col("id").cast("int"))).alias("updated_at"))
    rows.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    plan = plan_of(delta_read(stored, default_watermark("2024-02-01")), "formatted")
    assert "GreaterThan(updated_at,2024-01-25" in plan


def test_every_check_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) >= 140


def test_struct_round_trip(spark):
    rows = spark.createDataFrame([(1, ["a"], 0.5)], "id int, g_x array<string>, g_y double")
    nested = ledger.nest_columns(rows, {"g": ["x", "y"]}, "s")
    assert [tuple(r) for r in ledger.flatten_struct(nested, "s").collect()] == [(1, ["a"], 0.5)]


def test_masked_phone_is_never_a_valid_phone(spark):
    rows = spark.createDataFrame([("1", "k", "c", "555****567")], "apollo_id string, contact_key string, company_key string, phone_masked string")
    for c in ("first_name_masked", "last_name_masked", "email_masked", "linkedin_url", "title", "department"):
        rows = rows.withColumn(c, F.lit(None).cast("string"))
    checked = quality.check_contacts(rows.withColumn("data_quality_score", F.lit(0.5))).first()
    assert checked["phone_format_check"] == "INVALID" and checked["overall_validation_status"] == "PASS"


def test_arrivals_have_as_many_files_as_the_table_has_tasks(spark, tmp_path, monkeypatch):
    """Two micro-batches at any size, each read by many tasks; null and repeated keys arrive too."""
    rows = spark.range(600, numPartitions=6).select(F.when(F.col("id") % 10 > 0, F.col("id") % 100).alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("text"), F.lit("en").alias("lang"), F.lit("web").alias("source"))
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(stream_queries, "work_path", lambda spark, name: str(tmp_path / name))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8KB")
    try:
        stream = stream_queries.arriving(Inputs(spark, str(tmp_path)), "b_profiles")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(list((tmp_path / "in_b_profiles").glob("*.parquet"))) >= 12
    batches = []
    streams.run_batches(stream, str(tmp_path / "progress"), lambda batch, number: batches.append([r.profile_text for r in batch.collect()]))
    assert len(batches) == 2 and all(batches)
    assert sorted(batches[0] + batches[1]) == sorted(r.text for r in rows.collect())
