"""Watermarks, deltas, upserts, budgets, caches and quotas."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import incremental
from ..operators.ordering import top_n
from ..plans import crawl, ledger
from .aggregate_queries import cache_of
from .core import AS_OF, num, query, stamp

def watermark():
    return F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")


@query(
    "delta_read",
    f"""SELECT event_id, company_key, profile_text, profile_text_hash, {stamp('updated_at')} FROM b_updates
       WHERE updated_at > TIMESTAMP '2024-01-24 00:00:00' AND profile_text <> '' AND profile_text_hash IS NOT NULL""",
)
def delta_read(inp):
    rows = incremental.delta_read(inp["b_updates"], incremental.default_watermark(AS_OF), required=["profile_text", "profile_text_hash"])
    return rows.select("event_id", "company_key", "profile_text", "profile_text_hash", "updated_at")


@query(
    "delta_page",
    f"""SELECT event_id, company_key, {stamp('updated_at')} FROM (SELECT * FROM b_updates WHERE updated_at > TIMESTAMP '2024-01-20 00:00:00' AND profile_text <> ''
       ORDER BY b_updates.updated_at, event_id LIMIT 1000) AS page""",
)
def delta_page(inp):
    page = incremental.delta_read(inp["b_updates"], watermark(), required=["profile_text"], page_size=1000, tie_breaker=["event_id"])
    return page.select("event_id", "company_key", "updated_at")


@query(
    "watermark_advance",
    """SELECT 'advanced' AS kind, strftime(greatest(TIMESTAMP '2024-01-20 00:00:00', max(updated_at)), '%Y-%m-%d %H:%M:%S') AS watermark FROM b_updates WHERE updated_at > TIMESTAMP '2024-01-20 00:00:00'
       UNION ALL SELECT 'kept', strftime(greatest(TIMESTAMP '2025-01-01 00:00:00', max(updated_at)), '%Y-%m-%d %H:%M:%S') FROM b_updates""",
)
def watermark_advance(inp):
    rows = inp["b_updates"]
    moved = incremental.watermark_advance(incremental.delta_read(rows, watermark()), watermark())
    kept = incremental.watermark_advance(rows, F.lit("2025-01-01 00:00:00").cast("timestamp_ntz"))
    return moved.withColumn("kind", F.lit("advanced")).unionByName(kept.withColumn("kind", F.lit("kept")))


@query(
    "changed_profiles",
    """SELECT p.company_key, p.profile_text_hash, p.industry FROM b_profiles p LEFT JOIN (SELECT company_key, arg_max(coalesce(embedded_hash, '-'), stored_at) AS embedded_hash FROM b_embedded GROUP BY company_key) e ON e.company_key = p.company_key WHERE p.profile_text_hash IS DISTINCT FROM e.embedded_hash""",
)
def changed_profiles(inp):
    rows = incremental.changed_rows(inp["b_profiles"], inp["b_embedded"], "company_key", "profile_text_hash", "embedded_hash", "stored_at")
    return rows.select("company_key", "profile_text_hash", "industry")


@query(
    "lookback_filter",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT {h} AS hours, count(*) AS rows_in_window FROM b_updates WHERE updated_at >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL {h} HOUR"
        for h in (24, 168, 336, 720)
    )
    + ")",
)
def lookback_filter(inp):
    parts = [
        incremental.lookback(inp["b_updates"], "updated_at", AS_OF, f"'{h}' HOUR").agg(F.count(F.lit(1)).alias("rows_in_window")).withColumn("hours", F.lit(h))
        for h in (24, 168, 336, 720)
    ]
    out, *rest = parts
    for p in rest:
        out = out.unionByName(p)
    return out


@query(
    "batch_assign",
    """SELECT event_id, row_number() OVER (ORDER BY updated_at, event_id) AS row_no, CAST(floor((row_number() OVER (ORDER BY updated_at, event_id) - 1) / 25) AS BIGINT) AS batch_no FROM b_updates""",
)
def batch_assign(inp):
    rows = inp["b_updates"].select("event_id", "updated_at")
    order = [F.col("updated_at").asc(), F.col("event_id").asc()]
    return incremental.batch_assign(rows, order, 25).select("event_id", "row_no", "batch_no")


@query(
    "upsert_latest",
    f"""SELECT company_key, status, {num('score')}, {stamp('updated_at')} FROM (SELECT *, row_number() OVER (PARTITION BY company_key ORDER BY updated_at DESC, event_id DESC) AS rn FROM b_updates) WHERE rn = 1""",
)
def upsert_latest(inp):
    rows = inp["b_updates"].drop("profile_text", "profile_text_hash")
    current = incremental.upsert_latest(rows.where(F.col("updated_at") <= watermark()), rows.limit(0), "company_key", "updated_at", ["event_id"])
    merged = incremental.upsert_latest(current, rows.where(F.col("updated_at") > watermark()), "company_key", "updated_at", ["event_id"])
    return merged.select("company_key", "status", "score", "updated_at")


@query("ttl_expire", f"SELECT company_key, task_type, content_hash, seq, {stamp('expires_at')} FROM o_cache WHERE expires_at >= TIMESTAMP '2024-01-22 06:00:00'")
def ttl_expire(inp):
    alive = incremental.ttl_alive(cache_of(inp), "expires_at", F.lit("2024-01-22 06:00:00").cast("timestamp"))
    return alive.select("company_key", "task_type", "content_hash", "seq", "expires_at")


@query(
    "cache_misses",
    """SELECT company_key, task_type, content_hash, seq FROM b_llm_calls w WHERE NOT EXISTS (SELECT 1 FROM o_cache c WHERE c.company_key = w.company_key AND c.task_type = w.task_type
       AND c.content_hash = w.content_hash AND c.expires_at > TIMESTAMP '2024-01-22 03:00:00')""",
)
def cache_misses(inp):
    work = inp["b_llm_calls"].select("company_key", "task_type", "content_hash", "seq")
    now = F.lit("2024-01-22 03:00:00").cast("timestamp")
    return incremental.cache_misses(work, cache_of(inp), ["company_key", "task_type", "content_hash"], "expires_at", now)


@query(
    "cache_evict",
    f"""SELECT event_id, {stamp('updated_at')} FROM (SELECT *, row_number() OVER (ORDER BY updated_at, event_id) AS age, count(*) OVER () AS n FROM b_updates) WHERE n < 1000 OR age > floor(n * 0.2)""",
)
def cache_evict(inp):
    rows = inp["b_updates"].select("event_id", "updated_at")
    return incremental.evict_oldest(rows, "updated_at", ["event_id"], threshold=1000)


@query(
    "budget_gate",
    """SELECT seq, item_no, round(CAST(running AS DOUBLE), 6) AS running_cost, running <= 3.5 AND item_no <= 400 AS admitted FROM (SELECT seq, row_number() OVER (ORDER BY created_at, seq) AS item_no,
       sum(CAST(input_tokens / 1000.0 AS DECIMAL(28,10))) OVER (ORDER BY created_at, seq ROWS UNBOUNDED PRECEDING) AS running FROM b_llm_calls)""",
)
def budget_gate(inp):
    rows = inp["b_llm_calls"].select("seq", "created_at", (F.col("input_tokens") / 1000.0).alias("cost"))
    order = [F.col("created_at").asc(), F.col("seq").asc()]
    gated = incremental.budget_gate(rows, ["seq"], order, F.col("cost"), 3.5, 400)
    return gated.select("seq", "item_no", "running_cost", "admitted")


QUOTA_SQL = " UNION ALL ".join(
    f"""SELECT '{width}' AS width, strftime(time_bucket(INTERVAL '{width}', called_at, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS calls, {limit} AS quota, count(*) > {limit} AS over_limit
       FROM b_api_calls GROUP BY 2"""
    for width, limit in incremental.API_QUOTAS.items()
)


@query("quota_windows", QUOTA_SQL)
def quota_windows(inp):
    return incremental.quota_windows(inp["b_api_calls"], "called_at")


@query(
    "latest_per_type",
    f"""SELECT model_type, model_id, training_date, {num('auc_score')} FROM (SELECT *, row_number() OVER (PARTITION BY model_type ORDER BY training_date DESC, model_id) AS rn FROM b_model_versions) WHERE rn = 1""",
)
def latest_per_type(inp):
    newest = top_n(inp["b_model_versions"], ["model_type"], [F.col("training_date").desc(), F.col("model_id").asc()], 1)
    return newest.select("model_type", "model_id", "training_date", "auc_score")


@query(
    "crawl_candidates",
    """SELECT p.page_id, p.domain, h.prev_hash FROM b_probes p LEFT JOIN (SELECT * FROM b_prev_hash QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY checked_at DESC) = 1) h ON h.page_id = p.page_id WHERE p.health_score * 100 >= 70 AND (h.prev_hash IS NULL OR h.prev_hash <> h.content_hash)""",
)
def crawl_candidates(inp):
    return crawl.crawl_candidates(inp["b_probes"], inp["b_prev_hash"], "page_id", "checked_at").select("page_id", "domain", "prev_hash")


QUEUE_PROMPT = """'Task: ' || replace(task_type, '_', ' ') || '. Answer as one JSON object.' || chr(10) || 'Name: ' || company_name || chr(10) || 'Industry: ' || industry || chr(10)
       || 'Description: ' || profile_text || chr(10) || 'Website: ' || profile_text || chr(10)"""


@query(
    "summary_queue",
    f"""SELECT company_key, task_type, model, item_no FROM (SELECT *, row_number() OVER w AS item_no, sum(cost) OVER (w ROWS UNBOUNDED PRECEDING) AS running FROM (
         SELECT company_key, task_type, model, updated_at, CAST(round(len(string_split(trim(regexp_replace(prompt, '\\s+', ' ', 'g')), ' ')) * 1.3 * CASE WHEN model = 'haiku' THEN 0.25 + 0.3 * 1.25 ELSE 3.0 + 0.3 * 15.0 END / 1e6, 10) AS DECIMAL(28,10)) AS cost
         FROM (SELECT p.company_key, p.updated_at, p.profile_text_hash, t.task_type, t.model, {QUEUE_PROMPT} AS prompt FROM (SELECT CAST(company_key AS VARCHAR) AS company_key, 'Company ' || company_key AS company_name, industry, profile_text, profile_text_hash, updated_at FROM b_profiles
           WHERE updated_at > TIMESTAMP '2024-01-17 00:00:00' - INTERVAL 7 DAY AND profile_text <> '') p,
           (VALUES ('executive_summary', 'haiku'), ('key_insights', 'haiku'), ('tech_analysis', 'haiku'), ('competitive_analysis', 'sonnet'), ('risk_assessment', 'sonnet'), ('business_intelligence', 'sonnet')) AS t(task_type, model)) q
         WHERE NOT EXISTS (SELECT 1 FROM o_cache c WHERE c.company_key = q.company_key AND c.task_type = q.task_type)) WINDOW w AS (ORDER BY updated_at DESC, company_key, task_type)) WHERE running <= 1.5""",
)
def summary_queue(inp):
    profiles = inp["b_profiles"].select(
        F.col("company_key").cast("string").alias("company_key"),
        F.concat(F.lit("Company "), "company_key").alias("company_name"),
        "industry", "profile_text", F.col("updated_at").cast("timestamp_ntz").alias("updated_at"),
        F.col("profile_text").alias("description"), F.col("profile_text").alias("web_content"),
        F.lit("-").alias("content_hash"),
    )
    cache = cache_of(inp).withColumn("content_hash", F.lit("-"))
    queue = ledger.summary_queue(profiles, cache, "2024-01-17", budget=1.5)
    return queue.select("company_key", "task_type", "model", "item_no")


