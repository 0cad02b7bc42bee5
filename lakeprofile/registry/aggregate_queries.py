"""Quality, partition monitors, match metrics, ledger and report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.calendar import missing_partitions as find_missing
from ..plans import ledger, match_metrics, monitors, quality
from .core import (
    AS_OF, HEALTH_LEVELS, MATCH_LEVELS, PARTITION_SIZES, QUALITY_LEVELS, READINESS_LEVELS, START, cte, fixed, num, query, shared, stamp, step_of,
)
from .gold_queries import profiles_of
from .silver_queries import companies_of, contacts_of, health_of, web_of

LEVEL_SQL = step_of("{0}", QUALITY_LEVELS)
DOMAIN_SQL = "coalesce({0} <> '' AND contains({0}, '.') AND NOT ends_with({0}, '.') AND NOT starts_with({0}, '.') AND length({0}) <= 253, false)"
URL_SQL = "coalesce((starts_with({0}, 'http://') OR starts_with({0}, 'https://')) AND length({0}) <= 2048, false)"
EMAIL_SQL = "coalesce({0} LIKE '%@%.%' AND length({0}) <= 255 AND NOT contains({0}, '..') AND NOT starts_with({0}, '.') AND NOT ends_with({0}, '.'), false)"


def check_sql(*columns: str) -> str:
    return ", ".join(f"CASE WHEN coalesce({c}, '') = '' THEN 'FAIL' ELSE 'PASS' END AS {c}_check" for c in columns)


def either(cond: str, yes: str, no: str, name: str) -> str:
    return f"CASE WHEN {cond} THEN '{yes}' ELSE '{no}' END AS {name}"


def present_sql(*columns: str) -> str:
    return " AND ".join(f"coalesce({c}, '') <> ''" for c in columns)


cte(
    "o_dq_companies",
    f"""SELECT company_key, domain, company_name, {check_sql('company_key', 'domain', 'company_name')}, {either(DOMAIN_SQL.format('domain'), 'PASS', 'FAIL', 'domain_format_check')},
       CASE WHEN country IS NOT NULL AND industry IS NOT NULL AND description IS NOT NULL THEN 'COMPLETE' WHEN country IS NULL AND industry IS NULL AND description IS NULL THEN 'INCOMPLETE' ELSE 'PARTIAL' END AS data_completeness,
       {LEVEL_SQL.format('data_quality_score')} AS quality_level, 'PRIMARY' AS record_type, {either(URL_SQL.format('linkedin_url'), 'VALID', 'INVALID', 'linkedin_url_check')},
       {either(URL_SQL.format('website_url'), 'VALID', 'INVALID', 'website_url_check')}, {either('founded_year > 2024 OR founded_year < 1800', 'INVALID', 'VALID', 'founded_year_check')},
       {either('employee_count < 0 OR employee_count > 1000000', 'INVALID', 'VALID', 'employee_count_check')}, {either('total_funding < 0 OR total_funding > 1000000000000', 'INVALID', 'VALID', 'total_funding_check')},
       {either(present_sql('company_key', 'domain', 'company_name') + ' AND ' + DOMAIN_SQL.format('domain'), 'PASS', 'FAIL', 'overall_validation_status')} FROM o_companies""",
)
cte(
    "o_dq_contacts",
    "SELECT c.apollo_id, contact_key, company_key, first_name_masked, last_name_masked, "
    + check_sql("c.apollo_id", "contact_key", "company_key").replace("c.apollo_id_check", "apollo_id_check")
    + ", "
    + ", ".join(
        f"CASE WHEN {c}_masked LIKE '%*%' THEN 'MASKED' WHEN {c}_masked IS NULL THEN 'NO_DATA' ELSE 'NOT_MASKED' END AS {c}_masking_check"
        for c in ("first_name", "last_name", "email")
    )
    + f""", {either(EMAIL_SQL.format('email_masked'), 'VALID', 'INVALID', 'email_format_check')}, 'INVALID' AS phone_format_check, {either(URL_SQL.format('linkedin_url'), 'VALID', 'INVALID', 'linkedin_url_check')},
       CASE WHEN title <> '' THEN 'COMPLETE' WHEN department <> '' THEN 'PARTIAL' ELSE 'INCOMPLETE' END AS professional_info_check, {LEVEL_SQL.format('data_quality_score')} AS quality_level,
       {either(present_sql('c.apollo_id', 'contact_key', 'company_key'), 'PASS', 'FAIL', 'overall_validation_status')} FROM o_contacts c JOIN o_masked m ON m.apollo_id = c.apollo_id""",
)
cte(
    "o_dq_health",
    f"""SELECT domain, company_key, health_score, {check_sql('domain', 'company_key')}, {either(DOMAIN_SQL.format('domain'), 'PASS', 'FAIL', 'domain_format_check')},
       if(health_score < 0 OR health_score > 1, 'INVALID', {step_of('health_score', HEALTH_LEVELS, 'NO_DATA')}) AS health_score_validation,
       'VALID' AS grade_validation, 'VALID' AS risk_level_validation, {either("critical_issues = ''", 'CLEAN', 'MINOR_ISSUES', 'critical_issues_validation')},
       {either(present_sql('domain', 'company_key') + ' AND ' + DOMAIN_SQL.format('domain') + ' AND coalesce(health_score BETWEEN 0 AND 1, false)', 'PASS', 'FAIL', 'overall_validation_status')} FROM o_health""",
)
cte(
    "o_dq_web",
    f"""SELECT company_key, domain, url AS page_url, {check_sql('company_key', 'domain')}, {either("url <> ''", 'PASS', 'FAIL', 'page_url_check')}, {either(URL_SQL.format('url'), 'PASS', 'FAIL', 'page_url_format_check')},
       {either(DOMAIN_SQL.format('domain'), 'PASS', 'FAIL', 'domain_format_check')}, CASE WHEN title <> '' THEN 'COMPLETE' WHEN meta_description <> '' THEN 'PARTIAL' ELSE 'INCOMPLETE' END AS content_completeness,
       {LEVEL_SQL.format('content_richness_score')} AS content_quality_level, {either('content_hash IS NULL', 'NO_HASH', 'VALID', 'content_hash_validation')},
       {either(present_sql('company_key', 'domain', 'url') + ' AND ' + URL_SQL.format('url') + ' AND ' + DOMAIN_SQL.format('domain'), 'PASS', 'FAIL', 'overall_validation_status')} FROM o_web""",
)
cte(
    "o_dq_profiles",
    f"""SELECT company_key, domain, company_name, false AS no_profile_text, profile_text_hash IS NULL AS no_profile_text_hash, {check_sql('company_key', 'domain', 'company_name')}, {either(DOMAIN_SQL.format('domain'), 'PASS', 'FAIL', 'domain_format_check')},
       'COMPLETE' AS profile_text_completeness, {either('profile_text_hash IS NULL', 'NO_HASH', 'VALID', 'profile_text_hash_validation')}, {LEVEL_SQL.format('overall_data_quality_score')} AS quality_level, 'VALID' AS confidence_level_validation,
       {step_of('investment_readiness_score', READINESS_LEVELS)} AS investment_readiness_validation,
       {either(present_sql('company_key', 'domain', 'company_name') + ' AND ' + DOMAIN_SQL.format('domain') + ' AND profile_text_hash IS NOT NULL', 'PASS', 'FAIL', 'overall_validation_status')} FROM o_gold""",
)


@shared
def checks_of(inp):
    return {
        "silver_companies": quality.check_companies(companies_of(inp), AS_OF),
        "silver_apollo_contacts": quality.check_contacts(contacts_of(inp)),
        "silver_domain_health": quality.check_health(health_of(inp)),
        "silver_web_extracts": quality.check_web(web_of(inp)),
        "gold_startup_profiles": quality.check_profiles(profiles_of(inp)),
    }


@query("dq_companies", "SELECT * FROM o_dq_companies")
def dq_companies(inp):
    return quality.check_companies(companies_of(inp), AS_OF)


@query("dq_contacts", "SELECT * FROM o_dq_contacts")
def dq_contacts(inp):
    return quality.check_contacts(contacts_of(inp))


@query("dq_health", f"SELECT * REPLACE ({num('health_score')}) FROM o_dq_health")
def dq_health(inp):
    return quality.check_health(health_of(inp))


@query("dq_web", "SELECT * FROM o_dq_web")
def dq_web(inp):
    return quality.check_web(web_of(inp))


@query("dq_profiles", "SELECT * FROM o_dq_profiles")
def dq_profiles(inp):
    return quality.check_profiles(profiles_of(inp))


DQ_TABLES = {
    "silver_companies": "o_dq_companies", "silver_apollo_contacts": "o_dq_contacts", "silver_domain_health": "o_dq_health",
    "silver_web_extracts": "o_dq_web", "gold_startup_profiles": "o_dq_profiles",
}


@query(
    "dq_summary",
    "SELECT table_name, count(*) AS total_records, count(*) FILTER (WHERE s = 'PASS') AS valid_records, count(*) FILTER (WHERE s = 'FAIL') AS invalid_records, "
    "round(CAST(round(count(*) FILTER (WHERE s = 'PASS') * 100.0 / count(*), 2) AS DOUBLE), 6) AS validation_percentage FROM ("
    + " UNION ALL ".join(f"SELECT '{t}' AS table_name, overall_validation_status AS s FROM {o}" for t, o in DQ_TABLES.items())
    + ") GROUP BY table_name",
)
def dq_summary(inp):
    return quality.quality_summary(checks_of(inp))


def issue_sql(table: str, source: str, key: str, domain: str, name: str, *rules: tuple[str, str]) -> str:
    cases = " ".join(f"WHEN {cond} THEN '{text}'" for text, cond in rules)
    return (
        f"SELECT '{table}' AS table_name, {key} AS company_key, {domain} AS domain, {name} AS company_name, overall_validation_status, "
        f"CASE {cases} ELSE 'Other validation issue' END AS issue_description FROM {source} WHERE overall_validation_status = 'FAIL'"
    )


def blank(c: str) -> tuple[str, str]:
    return (f"Missing {c}", f"coalesce({c}, '') = ''")


BAD_DOMAIN = ("Invalid domain format", f"NOT {DOMAIN_SQL.format('domain')}")


@query(
    "dq_issues",
    " UNION ALL ".join(
        [
            issue_sql("silver_companies", "o_dq_companies", "company_key", "domain", "company_name", blank("company_key"), blank("domain"), blank("company_name"), BAD_DOMAIN),
            issue_sql("silver_apollo_contacts", "o_dq_contacts", "contact_key", "company_key", "first_name_masked || ' ' || last_name_masked", blank("apollo_id"), blank("contact_key"), blank("company_key")),
            issue_sql("silver_domain_health", "o_dq_health", "domain", "company_key", "domain", blank("domain"), blank("company_key"), BAD_DOMAIN, ("Missing health_score", "health_score IS NULL")),
            issue_sql("silver_web_extracts", "o_dq_web", "company_key", "domain", "page_url", blank("company_key"), blank("domain"), blank("page_url"), ("Invalid page_url format", f"NOT {URL_SQL.format('page_url')}"), BAD_DOMAIN),
            issue_sql("gold_startup_profiles", "o_dq_profiles", "company_key", "domain", "company_name", blank("company_key"), blank("domain"), blank("company_name"), BAD_DOMAIN, ("Missing profile_text", "no_profile_text"), ("Missing profile_text_hash", "no_profile_text_hash")),
        ]
    ),
)
def dq_issues(inp):
    return quality.quality_issues(checks_of(inp))


@query(
    "table_counts",
    """SELECT 'silver_companies' AS table_name, count(*) AS record_count FROM o_companies UNION ALL SELECT 'silver_apollo_companies', count(*) FROM o_vendor
       UNION ALL SELECT 'silver_apollo_contacts', count(*) FROM o_contacts UNION ALL SELECT 'silver_domain_health', count(*) FROM o_health UNION ALL SELECT 'silver_web_extracts', count(*) FROM o_web""",
)
def table_counts(inp):
    from ..plans.silver import silver_vendor_companies

    return monitors.table_counts(
        {
            "silver_companies": companies_of(inp),
            "silver_apollo_companies": silver_vendor_companies(inp.raw_json("b_vendor"), AS_OF),
            "silver_apollo_contacts": contacts_of(inp),
            "silver_domain_health": health_of(inp),
            "silver_web_extracts": web_of(inp),
        }
    )


# --- partition monitors -----------------------------------------------------------

cte("o_status", "SELECT table_name, dt, count(*) AS record_count, min(created_at) AS earliest_record, max(created_at) AS latest_record FROM b_partitions GROUP BY ALL")


@query("partition_status", f"SELECT table_name, dt, record_count, {stamp('earliest_record', 'latest_record')} FROM o_status")
def partition_status(inp):
    return monitors.partition_status(inp["b_partitions"])


@query(
    "partition_size",
    f"""SELECT table_name, dt, count(*) AS record_count, count(DISTINCT company_key) AS unique_companies, count(DISTINCT domain) AS unique_domains,
       {num('round(count(*)::DOUBLE / count(DISTINCT company_key), 2) AS avg_records_per_company')} FROM b_partitions GROUP BY table_name, dt""",
)
def partition_size(inp):
    return monitors.partition_size(inp["b_partitions"])


@query(
    "storage_usage",
    "SELECT table_name, dt, record_count, round(record_count * CASE table_name "
    + " ".join(f"WHEN '{t}' THEN {mb}" for t, mb in monitors.MB_PER_RECORD.items())
    + " END, 2)::DOUBLE AS estimated_size_mb FROM o_status",
)
def storage_usage(inp):
    return monitors.storage_usage(inp["b_partitions"])


@query(
    "partition_health",
    f"""SELECT table_name, dt, record_count, {step_of('record_count', PARTITION_SIZES)} AS partition_size_category,
       CASE WHEN dt = '2024-01-31' THEN 'CURRENT' WHEN dt = '2024-01-30' THEN 'YESTERDAY' WHEN dt >= '2024-01-24' THEN 'RECENT' WHEN dt >= '2024-01-01' THEN 'OLD' ELSE 'VERY_OLD' END AS partition_age_category FROM o_status""",
)
def partition_health(inp):
    return monitors.partition_health(monitors.partition_status(inp["b_partitions"]), AS_OF)


@query(
    "missing_partitions",
    """SELECT d.dt, t.missing_table FROM (SELECT CAST(CAST(range AS DATE) AS VARCHAR) AS dt FROM range(DATE '2024-01-01', DATE '2024-02-01', INTERVAL 1 DAY)) d
       CROSS JOIN (SELECT unnest(['silver_companies', 'silver_apollo_companies', 'silver_apollo_contacts', 'silver_domain_health', 'silver_web_extracts', 'gold_startup_profiles']) AS missing_table) t
       WHERE NOT EXISTS (SELECT 1 FROM b_partitions p WHERE p.dt = d.dt AND p.table_name = t.missing_table)""",
)
def missing_partitions(inp):
    return find_missing(inp["b_partitions"], list(monitors.MB_PER_RECORD), AS_OF)


# --- match metrics -------------------------------------------------------------------

cte(
    "o_usable",
    "SELECT event_id, dt, challenge_id, coalesce(final_score, 0) AS final_score, embedding_similarity, ml_score FROM b_shortlists WHERE challenge_id <> '' AND company_key <> ''",
)
cte(
    "o_ams",
    """SELECT dt, challenge_id, count(*) AS total_shortlists, avg(CAST(final_score AS DECIMAL(20,10))) FILTER (WHERE rn <= 10) AS ams_challenge, avg(CAST(embedding_similarity AS DECIMAL(20,10))) AS avg_embedding_similarity, avg(CAST(ml_score AS DECIMAL(20,10))) AS avg_ml_score,
       max(final_score) AS top_score, min(final_score) AS min_score, stddev_pop(final_score) AS score_std
       FROM (SELECT *, row_number() OVER (PARTITION BY dt, challenge_id ORDER BY final_score DESC, event_id) AS rn FROM o_usable) GROUP BY dt, challenge_id""",
)
cte(
    "o_ams_day",
    """SELECT dt, count(*) AS total_challenges, CAST(sum(total_shortlists) AS BIGINT) AS total_shortlists, avg(CAST(ams_challenge AS DECIMAL(20,10))) AS avg_ams_challenge, avg(CAST(avg_embedding_similarity AS DECIMAL(20,10))) AS avg_embedding_similarity,
       avg(CAST(avg_ml_score AS DECIMAL(20,10))) AS avg_ml_score FROM o_ams GROUP BY dt""",
)
DAY_MEANS = ("avg_ams_challenge", "avg_embedding_similarity", "avg_ml_score")


@shared
def challenge_metrics_of(inp):
    return match_metrics.challenge_metrics(inp["b_shortlists"])


@shared
def overall_of(inp):
    return match_metrics.overall_metrics(challenge_metrics_of(inp))


@query(
    "ams_challenge",
    f"SELECT dt, challenge_id, total_shortlists, {fixed('ams_challenge', 'avg_embedding_similarity', 'avg_ml_score')}, {num('top_score', 'min_score', 'score_std')} FROM o_ams",
)
def ams_challenge(inp):
    return challenge_metrics_of(inp)


@query("ams_trend", f"SELECT dt, {fixed('avg_ams_challenge AS overall_avg_ams')} FROM o_ams_day WHERE dt >= '2024-01-01'")
def ams_trend(inp):
    return match_metrics.daily_trend(overall_of(inp), START)


@query(
    "ams_daily_change",
    f"""SELECT dt, total_challenges, total_shortlists, {fixed(*DAY_MEANS, 'lag(avg_ams_challenge) OVER (ORDER BY dt) AS prev_avg_ams', 'avg_ams_challenge - lag(avg_ams_challenge) OVER (ORDER BY dt) AS ams_change')} FROM o_ams_day""",
)
def ams_daily_change(inp):
    return match_metrics.daily_change(overall_of(inp))


@query(
    "ams_top_challenges",
    f"""SELECT challenge_id, {fixed('a AS avg_ams')}, days_measured FROM (SELECT challenge_id, round(avg(CAST(ams_challenge AS DECIMAL(20,10))), 9) AS a, count(*) AS days_measured FROM o_ams WHERE dt >= '2024-01-01' GROUP BY challenge_id HAVING count(*) >= 7)
       ORDER BY a DESC, challenge_id LIMIT 10""",
)
def ams_top_challenges(inp):
    return match_metrics.top_challenges(challenge_metrics_of(inp), START)


@query(
    "ams_distribution",
    f"""SELECT {step_of('ams_challenge', MATCH_LEVELS)} AS performance_category,
       count(*) AS challenge_count FROM o_ams WHERE dt >= '2024-01-01' GROUP BY 1""",
)
def ams_distribution(inp):
    return match_metrics.distribution(challenge_metrics_of(inp), START)


@query("events_by_type", "SELECT event_type, count(*) AS event_count FROM b_shortlists WHERE dt >= '2024-01-01' GROUP BY event_type")
def events_by_type(inp):
    return match_metrics.events_by_type(inp["b_shortlists"], START)


@query(
    "events_avg_by_challenge",
    f"SELECT challenge_id, {num('avg(final_score) AS avg_final_score', 'avg(embedding_similarity) AS avg_embedding_similarity', 'avg(ml_score) AS avg_ml_score')} FROM b_shortlists WHERE dt >= '2024-01-01' GROUP BY challenge_id",
)
def events_avg_by_challenge(inp):
    return match_metrics.average_scores(inp["b_shortlists"], START)


@query(
    "events_high_score",
    f"""SELECT 'high' AS kind, challenge_id, company_key, {num('final_score')}, {stamp('created_at')} FROM b_shortlists WHERE final_score > 0.8 AND dt >= '2024-01-01'
       UNION ALL SELECT 'challenge', challenge_id, company_key, {num('final_score')}, {stamp('created_at')} FROM b_shortlists WHERE challenge_id = '7' AND dt >= '2024-01-01'""",
)
def events_high_score(inp):
    events = inp["b_shortlists"]
    high = match_metrics.high_scores(events, START).withColumn("kind", F.lit("high"))
    one = match_metrics.challenge_events(events, "7", START).withColumn("kind", F.lit("challenge"))
    shown = ["kind", "challenge_id", "company_key", "final_score", "created_at"]
    return high.select(*shown).unionByName(one.select(*shown))


@query(
    "run_averages",
    f"""SELECT {num('coalesce(avg(health_score), 0) AS avg_health_score')}, count(*) AS domains, any_value(s.avg_similarity) AS avg_similarity, any_value(s.matches) AS matches FROM b_probes,
       (SELECT {num('coalesce(avg(embedding_similarity), 0) AS avg_similarity')}, count(*) AS matches FROM b_shortlists) s""",
)
def run_averages(inp):
    return match_metrics.run_averages(inp["b_probes"], inp["b_shortlists"])


# --- ledger -----------------------------------------------------------------------------

cte(
    "o_calls",
    """SELECT *, CASE WHEN was_cached THEN 0 ELSE input_tokens / 3.0 END AS output_tokens, CASE WHEN was_cached THEN 0 WHEN model = 'haiku' THEN input_tokens * 0.25 + input_tokens / 3.0 * 1.25 ELSE input_tokens * 3.0 + input_tokens / 3.0 * 15.0 END / 1e3 AS cost_usd,
       strftime(created_at, '%Y-%m-%d') AS dt FROM b_llm_calls""",
)


@shared
def calls_of(inp):
    """Model calls with tokens, cost in thousandths of the price, and day."""
    calls = inp["b_llm_calls"]
    words = F.col("input_tokens").cast("double")
    cost = ledger.call_cost(F.col("model"), words, words / 3.0) * 1000
    return calls.withColumns(
        {
            "total_tokens": F.col("input_tokens").cast("long"),
            "processing_time_ms": F.col("input_tokens") * 10 + F.col("turn"),
            "cost_usd": F.when(F.col("was_cached"), F.lit(0.0)).otherwise(cost),
            "dt": F.date_format("created_at", "yyyy-MM-dd"),
        }
    )


LEDGER_TASKS = ", ".join(f"count(*) FILTER (WHERE task_type = '{t}') AS {t}_requests" for t in ledger.TASK_MODELS)
cte(
    "o_ledger",
    f"""SELECT dt, count(*) AS total_requests, CAST(sum(input_tokens) AS BIGINT) AS total_tokens, sum(cost_usd) AS total_cost_usd, avg(cost_usd) AS avg_cost_per_request,
       count(*) FILTER (WHERE model = 'haiku') AS claude_haiku_requests, count(*) FILTER (WHERE model = 'sonnet') AS claude_sonnet_requests,
       sum(CASE WHEN model = 'haiku' THEN cost_usd ELSE 0 END) AS claude_haiku_cost, sum(CASE WHEN model = 'sonnet' THEN cost_usd ELSE 0 END) AS claude_sonnet_cost, {LEDGER_TASKS},
       avg(CASE WHEN was_cached THEN 1.0 ELSE 0 END) AS cache_hit_rate, avg(CASE WHEN success THEN 0.0 ELSE 1 END) AS error_rate, avg(input_tokens * 10 + turn) AS avg_processing_time_ms FROM o_calls GROUP BY dt""",
)


@query(
    "llm_cost_daily",
    f"""SELECT dt, total_requests, total_tokens, claude_haiku_requests, claude_sonnet_requests, {', '.join(f'{t}_requests' for t in ledger.TASK_MODELS)},
       {num('total_cost_usd', 'avg_cost_per_request', 'claude_haiku_cost', 'claude_sonnet_cost', 'cache_hit_rate', 'error_rate', 'avg_processing_time_ms', 'total_cost_usd / total_tokens AS avg_cost_per_token', '50 AS daily_budget_usd', 'total_cost_usd / 50 AS budget_utilization', '50 - total_cost_usd AS remaining_budget_usd')} FROM o_ledger""",
)
def llm_cost_daily(inp):
    return ledger.cost_per_day(calls_of(inp))


@query(
    "llm_cost_summary",
    f"""SELECT 7 AS period_days, {num('coalesce(sum(total_cost_usd), 0) AS total_cost', 'coalesce(sum(total_cost_usd), 0) / 7 AS average_daily_cost')}, count(*) AS days_with_cost, {num('coalesce(sum(total_cost_usd), 0) / 70 * 100 AS budget_utilization')},
       CASE WHEN sum(total_cost_usd) / 70 >= 1 THEN '1.0' WHEN sum(total_cost_usd) / 70 >= 0.9 THEN '0.9' WHEN sum(total_cost_usd) / 70 >= 0.8 THEN '0.8' END AS alert_level
       FROM o_ledger WHERE dt BETWEEN '2024-01-12' AND '2024-01-18'""",
)
def llm_cost_summary(inp):
    return ledger.cost_summary(ledger.cost_per_day(calls_of(inp)), "2024-01-18", budget=10.0)


@query(
    "llm_cost_by_day",
    f"""SELECT CAST(CAST(range AS DATE) AS VARCHAR) AS dt, {num('coalesce(total_cost_usd, 0) AS cost')} FROM range(DATE '2024-01-12', DATE '2024-01-19', INTERVAL 1 DAY)
       LEFT JOIN o_ledger ON o_ledger.dt = CAST(CAST(range AS DATE) AS VARCHAR)""",
)
def llm_cost_by_day(inp):
    return ledger.cost_by_day(ledger.cost_per_day(calls_of(inp)), "2024-01-18")


@query(
    "summary_pivot",
    "SELECT company_key, "
    + ", ".join(f"max_by(result, seq) FILTER (WHERE task_type = '{t}') AS {t}" for t in ledger.TASK_MODELS)
    + f", {num('sum(cost_usd) AS processing_cost_usd')} FROM o_calls GROUP BY company_key",
)
def summary_pivot(inp):
    return ledger.summary_pivot(calls_of(inp))


cte("o_cache", "SELECT company_key, task_type, content_hash, created_at, created_at + INTERVAL 7 DAY AS expires_at, seq FROM b_llm_calls WHERE was_cached")


@shared
def cache_of(inp):
    calls = inp["b_llm_calls"].where("was_cached")
    return calls.select(
        "company_key", "task_type", "content_hash", "created_at", "seq", (F.col("created_at") + F.expr("INTERVAL 7 DAYS")).alias("expires_at")
    )


@query(
    "cache_stats",
    """SELECT count(*) AS total_items, count(*) FILTER (WHERE created_at > TIMESTAMP '2024-01-14 06:00:00') AS recent_items,
       count(*) FILTER (WHERE expires_at < TIMESTAMP '2024-01-15 06:00:00' + INTERVAL 7 DAY) AS expired_items FROM o_cache""",
)
def cache_stats(inp):
    now = F.lit("2024-01-15 06:00:00").cast("timestamp")
    shifted = cache_of(inp).withColumn("expires_at", F.col("expires_at") - F.expr("INTERVAL 7 DAYS"))
    return ledger.cache_stats(shifted, now)


