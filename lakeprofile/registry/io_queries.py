"""Scans, sinks and table maintenance, proved by writing and reading back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..plans import match_metrics, second_gen
from ..session import work_path
from ..sources import maintenance, readers, writers
from .aggregate_queries import challenge_metrics_of, overall_of
from .core import AS_OF, fixed, num, query, stamp
from .silver_queries import gen_companies_of

SRC_A = "domain string, company_name string, country string, industry string, total_funding decimal(15,2), crunchbase_url string, source_id long"
SRC_A_SQL = f"domain, company_name, country, industry, {num('total_funding')}, crunchbase_url, source_id"


@query("scan_csv", f"SELECT {SRC_A_SQL}, upper(domain) || ', \"' || country || '\" \\' AS quoted FROM b_src_a")
def scan_csv(inp):
    quoted = F.concat(F.upper("domain"), F.lit(', "'), "country", F.lit('" \\'))
    rows = inp["b_src_a"].select("domain", "company_name", "country", "industry", "total_funding", "crunchbase_url", "source_id", quoted.alias("quoted"))
    path = work_path(inp.spark, "csv")
    writers.write_csv(rows, path)
    return readers.read_csv(inp.spark, path, SRC_A + ", quoted string")


@query("scan_csv_inferred", f"SELECT source_id, {num('total_funding')}, country FROM b_src_a")
def scan_csv_inferred(inp):
    path = work_path(inp.spark, "csv")
    writers.write_csv(inp["b_src_a"].select("source_id", "total_funding", "country"), path)
    rows = readers.read_csv_inferred(inp.spark, path)
    return rows.select(F.col("source_id").cast("long").alias("source_id"), "total_funding", "country")


@query("sink_csv_roundtrip", f"SELECT event_id, challenge_id, {num('final_score')}, dt FROM b_shortlists")
def sink_csv_roundtrip(inp):
    path = work_path(inp.spark, "csv")
    writers.write_csv(inp["b_shortlists"].select("event_id", "challenge_id", "final_score", "dt"), path)
    return readers.read_csv(inp.spark, path, "event_id long, challenge_id string, final_score double, dt string")


@query("scan_raw_jsonl", "SELECT id, title, length(email)::INTEGER AS email_length FROM b_contacts")
def scan_raw_jsonl(inp):
    path = work_path(inp.spark, "lines")
    inp.raw_json("b_contacts").write.text(path)
    raw = readers.read_raw_lines(inp.spark, path)

    def at(p):
        return F.get_json_object("raw_json", p)

    return raw.select(at("$.id").alias("id"), at("$.title").alias("title"), F.length(at("$.email")).alias("email_length"))


@query(
    "scan_typed_json",
    "SELECT page_id, url, meta_description, CASE WHEN tech_hints IS NULL THEN NULL ELSE array_to_string(tech_hints, '|') END AS tech_hints, array_to_string(navigation_items, '|') AS navigation_items FROM b_page_record",
)
def scan_typed_json(inp):
    path = work_path(inp.spark, "json")
    writers.write_json(inp["b_page_record"], path)
    schema = "page_id long, url string, meta_description string, tech_hints array<string>, navigation_items array<string>"
    return readers.read_json(inp.spark, path, schema)


@query("scan_jsonl_skip_bad", f"SELECT event_id, challenge_id, {num('ml_score')}, dt AS date FROM b_shortlists")
def scan_jsonl_skip_bad(inp):
    rows = inp["b_shortlists"].select(F.col("dt").alias("date"), F.to_json(F.struct("event_id", "challenge_id", "ml_score")).alias("line"))
    lines = F.array(F.col("line"), F.lit(""), F.substring("line", 1, 12))  # good, empty, cut off
    path = work_path(inp.spark, "daily")
    rows.select("date", F.explode(lines).alias("value")).write.partitionBy("date").text(path)
    good = readers.read_json_skip_bad(inp.spark, path, "event_id long, challenge_id string, ml_score double")
    return good.select("event_id", "challenge_id", "ml_score", F.col("date").cast("string").alias("date"))


@query("scan_partition_pruned", f"SELECT event_id, dt, {num('ml_score')} FROM b_shortlists WHERE dt BETWEEN '2024-01-10' AND '2024-01-20'")
def scan_partition_pruned(inp):
    path = work_path(inp.spark, "events")
    writers.write_by_day(inp["b_shortlists"].select("event_id", "ml_score", "dt"), path)
    stored = readers.read_parquet(inp.spark, path, "event_id long, ml_score double, dt string")
    return readers.between_dates(stored, "2024-01-10", "2024-01-20")


@query("scan_parquet_dir", f"SELECT doc_id, label, {num('n_chars')}, industry FROM b_training_docs")
def scan_parquet_dir(inp):
    path = work_path(inp.spark, "parts")
    rows = inp["b_training_docs"].select("doc_id", "label", "n_chars", "industry")
    rows.repartition(7, "doc_id").write.parquet(path)
    return readers.read_parquet(inp.spark, path)


@query("scan_latest_file", f"SELECT dt, total_challenges, {fixed('avg_ams_challenge')} FROM o_ams_day")
def scan_latest_file(inp):
    """Two JSON-array files (one row per day each); the newer one is read."""
    day = F.struct("dt", "total_challenges", "avg_ams_challenge")
    array = overall_of(inp).agg(F.to_json(F.collect_list(day)).alias("value"))
    path = work_path(inp.spark, "latest")
    array.select(F.replace("value", F.lit("2024"), F.lit("2023")).alias("value")).write.mode("append").text(path)
    array.write.mode("append").text(path)
    return readers.newest_file(inp.spark, path, "dt string, total_challenges long, avg_ams_challenge double")


@query("scan_manifest", "SELECT trim(domain) AS domain FROM b_src_b WHERE trim(domain) <> ''")
def scan_manifest(inp):
    path = work_path(inp.spark, "manifest")
    inp["b_src_b"].select(F.concat(F.lit("  "), "domain", F.lit(" ")).alias("value")).write.text(path)
    return readers.read_manifest(inp.spark, path)


@query("sink_dt_roundtrip", f"SELECT event_id, challenge_id, {num('final_score', 'ml_score')}, {stamp('created_at')}, dt FROM b_shortlists")
def sink_dt_roundtrip(inp):
    rows = inp["b_shortlists"].select("event_id", "challenge_id", "final_score", "ml_score", "created_at", "dt")
    path = work_path(inp.spark, "by_day")
    writers.write_by_day(rows, path, rebalance=True)
    return readers.read_parquet(inp.spark, path, rows.schema)


@query(
    "sink_ymd_roundtrip",
    f"SELECT id, employee_count, annual_revenue, {stamp('created_at')}, year(created_at)::INTEGER AS year, month(created_at)::INTEGER AS month, day(created_at)::INTEGER AS day FROM o_gen_companies WHERE created_at BETWEEN TIMESTAMP '2024-01-15 00:00:00' AND TIMESTAMP '2024-01-15 23:59:59'",
)
def sink_ymd_roundtrip(inp):
    rows = gen_companies_of(inp).select("id", "employee_count", "annual_revenue", "created_at", "year", "month", "day")
    path = work_path(inp.spark, "by_date")
    writers.write_partitioned(rows, path, ["year", "month", "day"])
    return second_gen.day_partition(readers.read_parquet(inp.spark, path), "2024-01-15")


@query("stage_promote", f"SELECT event_id, {num('ml_score + CASE WHEN dt >= $$2024-01-20$$ THEN 1 ELSE 0 END AS ml_score')}, dt FROM b_shortlists")
def stage_promote(inp):
    """Days of the new batch are replaced, all other days stay."""
    rows = inp["b_shortlists"].select("event_id", "ml_score", "dt")
    target, staging = work_path(inp.spark, "target"), work_path(inp.spark, "staging")
    writers.write_by_day(rows, target)
    batch = rows.where(F.col("dt") >= "2024-01-20").withColumn("ml_score", F.col("ml_score") + 1)
    writers.stage_and_promote(batch, staging, target, ["dt"])
    return readers.read_parquet(inp.spark, target, rows.schema)


@query(
    "sink_json_roundtrip",
    f"SELECT dt AS date, total_challenges, total_shortlists, {fixed('avg_ams_challenge')}, '{{\"total\":' || total_challenges || '}}' AS counts_json FROM o_ams_day",
)
def sink_json_roundtrip(inp):
    rows = overall_of(inp).select(
        F.col("dt").alias("date"), "total_challenges", "total_shortlists", "avg_ams_challenge",
        F.to_json(F.struct(F.col("total_challenges").alias("total"))).alias("counts_json"),
    )
    path = work_path(inp.spark, "metrics")
    writers.write_json(rows, path, by=["date"])
    back = readers.read_json(inp.spark, path, "total_challenges long, total_shortlists long, avg_ams_challenge double, counts_json string")
    return back.withColumn("date", F.col("date").cast("string"))


@query(
    "ams_overall",
    f"""SELECT 'overall' AS grain, dt, '' AS challenge_id, total_challenges AS n, {fixed('avg_ams_challenge AS ams')} FROM o_ams_day
       UNION ALL SELECT 'challenge', dt, challenge_id, total_shortlists, {fixed('ams_challenge')} FROM o_ams""",
)
def ams_overall(inp):
    """Both metric tables written by day, then read back."""
    from ..session import cut_lineage

    per_challenge = cut_lineage(challenge_metrics_of(inp))
    per_day = match_metrics.overall_metrics(per_challenge)
    days, challenges = work_path(inp.spark, "ams_overall"), work_path(inp.spark, "ams_challenge")
    writers.write_by_day(per_day, days)
    writers.write_by_day(per_challenge, challenges)
    top = readers.read_parquet(inp.spark, days, per_day.schema).select(
        F.lit("overall").alias("grain"), "dt", F.lit("").alias("challenge_id"), F.col("total_challenges").alias("n"), F.col("avg_ams_challenge").alias("ams")
    )
    each = readers.read_parquet(inp.spark, challenges, per_challenge.schema).select(
        F.lit("challenge").alias("grain"), "dt", "challenge_id", F.col("total_shortlists").alias("n"), F.col("ams_challenge").alias("ams")
    )
    return top.unionByName(each)


def dated_table(inp, register: bool = True) -> str:
    """Events stored by day with an external table over them."""
    name = f"events_{uuid.uuid4().hex}"
    path = work_path(inp.spark, name)
    writers.write_by_day(inp["b_shortlists"].select("event_id", "challenge_id", "final_score", "dt"), path)
    schema = "event_id BIGINT, challenge_id STRING, final_score DOUBLE, dt STRING"
    maintenance.create_dated_table(inp.spark, name, schema, path)
    if register:
        maintenance.recover_partitions(inp.spark, name)
    return name


@query(
    "partition_add",
    "SELECT dt, count(*) AS rows_in_partition FROM b_shortlists WHERE dt IN ('2024-01-05', '2024-01-06') GROUP BY dt",
)
def partition_add(inp):
    """Two days registered by hand, one of them twice."""
    name = dated_table(inp, register=False)
    for day in ("2024-01-05", "2024-01-06", "2024-01-06"):
        maintenance.add_partition(inp.spark, name, day)
    return readers.read_table(inp.spark, name).groupBy("dt").agg(F.count(F.lit(1)).alias("rows_in_partition"))


@query(
    "partition_retention",
    "SELECT dt, count(*) AS rows_in_partition FROM b_shortlists WHERE dt >= '2024-01-24' GROUP BY dt",
)
def partition_retention(inp):
    name = dated_table(inp)
    kept = maintenance.drop_old_partitions(inp.spark, name, AS_OF, 7)
    counts = readers.read_table(inp.spark, name).groupBy("dt").agg(F.count(F.lit(1)).alias("rows_in_partition"))
    return kept.join(counts, "dt", "left")


COMMENTS = {"event_id": "Unique event number", "challenge_id": "Challenge the event belongs to", "final_score": "Final score of the match"}


@query(
    "table_metadata",
    f"""SELECT col_name, data_type, comment, non_null FROM (VALUES ('event_id', 'bigint', '{COMMENTS['event_id']}'), ('challenge_id', 'string', '{COMMENTS['challenge_id']}'),
       ('final_score', 'double', '{COMMENTS['final_score']}'), ('dt', 'string', '')) AS c(col_name, data_type, comment)
       JOIN (SELECT * FROM (SELECT count(event_id) AS event_id, count(challenge_id) AS challenge_id, count(final_score) AS final_score, count(dt) AS dt FROM b_shortlists)
             UNPIVOT (non_null FOR col_name IN (event_id, challenge_id, final_score, dt))) USING (col_name)""",
)
def table_metadata(inp):
    """Column comments after they were set, with the number of filled values."""
    name = dated_table(inp)
    maintenance.set_comments(inp.spark, name, "Match events", COMMENTS)
    maintenance.set_properties(inp.spark, name, {"layer": "gold", "retention_days": "30"})
    table = readers.read_table(inp.spark, name)
    filled = table.agg(*[F.count(c).alias(c) for c in table.columns]).unpivot([], table.columns, "col_name", "non_null")
    return maintenance.column_comments(inp.spark, name).join(filled, "col_name")


PROPERTIES = {"layer": "gold", "retention_days": "30", "steward": "match team's"}


@query(
    "catalog_record",
    f"""SELECT * FROM (VALUES ('table', '', 'Events of the matcher''s run', ''), ('column', 'event_id', 'bigint', '{COMMENTS['event_id']}'), ('column', 'challenge_id', 'string', '{COMMENTS['challenge_id']}'),
       ('column', 'final_score', 'double', '{COMMENTS['final_score']}'), ('column', 'dt', 'string', ''), ('property', 'layer', 'gold', ''), ('property', 'retention_days', '30', ''), ('property', 'steward', 'match team''s', '')) AS c(kind, item, value, detail)
       UNION ALL SELECT DISTINCT 'partition', dt, '', '' FROM b_shortlists""",
)
def catalog_record(inp):
    """Comments, properties and partitions of a table, as they are read back."""
    name = dated_table(inp)
    maintenance.set_comments(inp.spark, name, "Events of the matcher's run", COMMENTS)
    maintenance.set_properties(inp.spark, name, PROPERTIES)
    return maintenance.catalog_record(inp.spark, name)


@query(
    "catalog_mapped",
    """SELECT event_id AS id, 'challenge ' || challenge_id AS challenge, round(final_score * 100, 6) AS percent, dt AS day FROM b_shortlists WHERE dt >= '2024-01-20'""",
)
def catalog_mapped(inp):
    """A catalog table read into another shape; old days are not read."""
    shape = {"id": F.col("event_id"), "challenge": F.concat(F.lit("challenge "), "challenge_id"), "percent": F.col("final_score") * 100, "day": F.col("dt")}
    return readers.read_mapped(inp.spark, dated_table(inp), shape).where(F.col("day") >= "2024-01-20")
