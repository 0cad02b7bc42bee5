"""Streaming forms: the given tables arrive as files, the results match batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import keyed_table
from ..operators.incremental import upsert_latest
from ..session import work_path
from ..streaming import streams
from .core import cte, num, query, stamp
from .increment_queries import QUOTA_SQL


def arriving(inp, name: str, arrivals: int = 2):
    """The binding stored in ``arrivals`` parts by its first column, read back as a file stream of about that many batches.

    A part has as many files as the binding has tasks, so no task reads or writes more when the table is larger.
    """
    rows = inp[name]
    path = work_path(inp.spark, f"in_{name}")
    part = F.pmod(F.xxhash64(rows.columns[0]), F.lit(arrivals))
    for n in range(arrivals):
        rows.where(part == n).write.mode("append").parquet(path)
    stored = inp.spark.read.parquet(path)
    return streams.file_stream(inp.spark, path, stored.schema, files_per_batch=-(-len(stored.inputFiles()) // arrivals))


def arriving_in_turn(inp, name: str, turn):
    """The binding stored as one file after the other, in the order of ``turn`` (1 to 3), which the stream takes one by one."""
    rows = inp[name].withColumn("_turn", turn)
    path = work_path(inp.spark, f"in_{name}")
    for n in (1, 2, 3):
        rows.where(F.col("_turn") == n).drop("_turn").coalesce(1).write.mode("append").parquet(path)
    return streams.file_stream(inp.spark, path, inp[name].schema, files_per_batch=1)


# most updates come in the order of their days, one in fifty at the end
TURN = "CASE WHEN event_id % 50 = 0 THEN 3 WHEN day({ts}) <= 10 THEN 1 WHEN day({ts}) <= 20 THEN 2 ELSE 3 END"
cte(
    "o_arrivals",
    f"""SELECT *, {TURN.format(ts='updated_at')} AS turn FROM b_updates WHERE profile_text <> '' AND profile_text_hash IS NOT NULL AND profile_text_hash <> ''""",
)
cte(
    "o_marks",
    """SELECT 1 AS turn, TIMESTAMP '2024-01-03 00:00:00' AS mark UNION ALL SELECT 2, greatest(TIMESTAMP '2024-01-03 00:00:00', (SELECT max(updated_at) FROM o_arrivals WHERE turn = 1))
       UNION ALL SELECT 3, greatest(TIMESTAMP '2024-01-03 00:00:00', (SELECT max(updated_at) FROM o_arrivals WHERE turn < 3))""",
)


@query(
    "stream_delta",
    "SELECT event_id, company_key, profile_text_hash, updated_at <= mark AS late, turn - 1 AS batch FROM o_arrivals JOIN o_marks USING (turn)",
)
def stream_delta(inp):
    """Updates newer than the stored watermark as each file found it, and those that came too late."""
    out, checkpoint = work_path(inp.spark, "out"), work_path(inp.spark, "progress")
    stream = arriving_in_turn(inp, "b_updates", F.expr(TURN.format(ts="updated_at")))
    streams.stream_delta(stream, ["profile_text", "profile_text_hash"], "updated_at", out, checkpoint, F.lit("2024-01-03 00:00:00"))
    parts = [streams.read_delta(inp.spark, out, stream.schema, part).withColumn("late", F.lit(part == "late")) for part in ("rows", "late")]
    return parts[0].unionByName(parts[1]).select("event_id", "company_key", "profile_text_hash", "late", F.col("batch").cast("int").alias("batch"))


@query("stream_watermark", f"SELECT {stamp('max(updated_at) AS watermark')} FROM b_updates")
def stream_watermark(inp):
    out, checkpoint = work_path(inp.spark, "marks"), work_path(inp.spark, "progress")
    streams.stream_watermark(arriving(inp, "b_updates"), "updated_at", out, checkpoint)
    return inp.spark.read.parquet(out).agg(F.max("watermark").alias("watermark"))


@query("stream_changed", "SELECT p.company_key, p.profile_text_hash FROM b_profiles p LEFT JOIN (SELECT company_key, arg_max(coalesce(embedded_hash, '-'), stored_at) AS embedded_hash FROM b_embedded GROUP BY company_key) e ON e.company_key = p.company_key WHERE p.profile_text_hash IS DISTINCT FROM e.embedded_hash")
def stream_changed(inp):
    out, checkpoint = work_path(inp.spark, "changed"), work_path(inp.spark, "progress")
    stream = arriving(inp, "b_profiles")
    streams.stream_changed(stream, inp["b_embedded"], "company_key", "profile_text_hash", "embedded_hash", "stored_at", out, checkpoint)
    return inp.spark.read.parquet(out).select("company_key", "profile_text_hash")


@query(
    "stream_upsert",
    f"""SELECT company_key, status, {num('score')}, {stamp('updated_at')} FROM (SELECT *, row_number() OVER (PARTITION BY company_key ORDER BY updated_at DESC, event_id DESC) AS rn FROM b_updates) WHERE rn = 1""",
)
def stream_upsert(inp):
    table, checkpoint = work_path(inp.spark, "keyed"), work_path(inp.spark, "progress")
    rows = inp["b_updates"]
    keyed_table.create(rows.limit(0), table, "company_key", 4)
    streams.stream_upsert(arriving(inp, "b_updates"), table, checkpoint, "company_key", "updated_at", 4, ["event_id"])
    return keyed_table.read(inp.spark, table, rows.schema).select("company_key", "status", "score", "updated_at")


@query(
    "keyed_versions",
    f"""SELECT * FROM (VALUES (0), (1), (2)) AS v(version), LATERAL (SELECT company_key, status, {num('score')}, {stamp('updated_at')} FROM (SELECT *, row_number() OVER (PARTITION BY company_key ORDER BY updated_at DESC, event_id DESC) AS rn
       FROM b_updates WHERE day(updated_at) <= 10 * (v.version + 1) OR v.version = 2) WHERE rn = 1)""",
)
def keyed_versions(inp):
    """A published read model merged twice; every version reads as it was."""
    table, rows = work_path(inp.spark, "published"), inp["b_updates"].drop("profile_text", "profile_text_hash")
    day = F.day("updated_at")
    first = upsert_latest(rows.where(day <= 10), rows.limit(0), "company_key", "updated_at", ["event_id"])
    keyed_table.create(first, table, "company_key", 4)
    for part in (rows.where(day.between(11, 20)), rows.where(day > 20)):
        keyed_table.merge(part, table, "company_key", "updated_at", 4, ["event_id"])
    parts = [keyed_table.read(inp.spark, table, rows.schema, v).withColumn("version", F.lit(v)) for v in range(3)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("version", "company_key", "status", "score", "updated_at")


cte("o_call_turns", f"SELECT *, {TURN.format(ts='called_at').replace('event_id', 'call_id')} AS turn FROM b_api_calls")
cte(
    "o_call_marks",
    """SELECT 1 AS turn, TIMESTAMP '1970-01-01 00:00:00' AS mark UNION ALL SELECT t.turn, (SELECT max(called_at) FROM o_call_turns c WHERE c.turn < t.turn AND (c.turn = 1 OR NOT time_bucket(INTERVAL '1 minute', c.called_at, TIMESTAMP '1970-01-01')
       + INTERVAL '1 minute' <= (SELECT max(called_at) FROM o_call_turns WHERE turn = 1) - INTERVAL '2 day')) FROM (VALUES (2), (3)) AS t(turn)""",
)
cte(
    "o_calls_on_time",
    """SELECT c.* FROM o_call_turns c JOIN o_call_marks m USING (turn) WHERE NOT (time_bucket(INTERVAL '1 minute', called_at, TIMESTAMP '1970-01-01') + INTERVAL '1 minute' <= mark - INTERVAL '2 day')""",
)


@query("stream_quota_windows", QUOTA_SQL.replace("b_api_calls", "o_calls_on_time"))
def stream_quota_windows(inp):
    """Windows of all three widths from the calls that were on time."""
    return quota_stream(inp)[1]


@query(
    "stream_late_calls",
    """SELECT call_id, endpoint, turn - 1 AS batch FROM o_call_turns WHERE call_id NOT IN (SELECT call_id FROM o_calls_on_time)""",
)
def stream_late_calls(inp):
    """Calls more than two days behind the newest one when they came."""
    out, _ = quota_stream(inp)
    return streams.late_calls(inp.spark, out, inp["b_api_calls"].schema).select("call_id", "endpoint", F.col("batch").cast("int").alias("batch"))


def quota_stream(inp):
    out, checkpoint = work_path(inp.spark, "quota"), work_path(inp.spark, "progress")
    stream = arriving_in_turn(inp, "b_api_calls", F.expr(TURN.format(ts="called_at").replace("event_id", "call_id")))
    streams.stream_quota(stream, "called_at", out, checkpoint, lateness="2 DAYS")
    return out, streams.quota_status(inp.spark, out)
