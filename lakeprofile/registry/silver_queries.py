"""SILVER products, their duplicate handling and quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedup
from ..plans import quality, second_gen, silver
from .core import AS_OF, READABILITY, SIZE_BRACKETS, cte, filled, given, joined, num, points, query, share, shared, stamp, step_of
from .row_queries import (
    DECIDER_SQL,
    HEALTH_FLAG_SQL,
    HEALTH_GRADE_SQL,
    METRIC_SQL,
    PAGE_TYPE_SQL,
    SENIOR_SQL,
    TITLE_SQL,
    gen_raw,
)

SOURCE_COLUMNS = (
    "company_key", "domain", "company_name", "country", "industry", "total_funding", "crunchbase_url", "description",
    "founded_year", "employee_count", "linkedin_url", "website_url", "source_system", "source_priority", "source_id", "created_at",
)


def source_rows(inp):
    """Both company sources; the second one arrives as raw JSON."""
    from_json = F.from_json("raw_json", inp["b_src_b"].schema).alias("_j")
    json_side = inp.raw_json("b_src_b").select(from_json).select("_j.*")
    return [inp["b_src_a"], json_side]


cte(
    "o_sources",
    """SELECT lower(trim(domain)) AS domain, trim(company_name) AS company_name, trim(country) AS country, trim(industry) AS industry, total_funding,
       crunchbase_url, NULL AS description, NULL AS founded_year, NULL AS employee_count, NULL AS linkedin_url, NULL AS website_url, source_system, source_priority, source_id, created_at
FROM b_src_a WHERE domain <> '' AND company_name <> ''
UNION ALL BY NAME
SELECT lower(trim(domain)) AS domain, trim(company_name) AS company_name, trim(country) AS country, trim(industry) AS industry, total_funding,
       NULL AS crunchbase_url, trim(description) AS description, founded_year, employee_count, linkedin_url, website_url, source_system, source_priority, source_id, created_at
FROM b_src_b WHERE domain <> '' AND company_name <> ''""",
)
cte("o_ranked", "SELECT *, row_number() OVER (PARTITION BY domain ORDER BY source_priority, created_at, source_id) AS rn FROM o_sources")
SIZE_SQL = step_of("employee_count", SIZE_BRACKETS, "unknown")
CONFIDENCE_SQL = points(
    ("domain IS NOT NULL", 0.3), ("company_name IS NOT NULL", 0.3), ("country IS NOT NULL", 0.1),
    ("industry IS NOT NULL", 0.1), ("description IS NOT NULL", 0.1), ("founded_year IS NOT NULL", 0.1),
)
cte(
    "o_companies",
    f"""SELECT domain AS company_key, * EXCLUDE (rn), 1.0 AS data_quality_score, {CONFIDENCE_SQL} AS confidence_score, {SIZE_SQL} AS size_bracket
       FROM o_ranked WHERE rn = 1""",
)
UNION_SHOWN = f"domain, company_name, country, industry, {num('total_funding')}, crunchbase_url, description, founded_year, employee_count, source_system, source_id, {stamp('created_at')}"


@query("union_sources", f"SELECT {UNION_SHOWN} FROM o_sources")
def union_sources(inp):
    merged = dedup.union_sources(*[silver.normalize_companies(s) for s in source_rows(inp)])
    return merged.select(
        "domain", "company_name", "country", "industry", "total_funding", "crunchbase_url", "description", "founded_year",
        "employee_count", "source_system", "source_id", "created_at",
    )


@shared
def merged_sources(inp):
    return dedup.union_sources(*[silver.normalize_companies(s) for s in source_rows(inp)])


@query("dedup_survivorship", f"SELECT domain, company_name, source_system, source_id, {stamp('created_at')} FROM o_ranked WHERE rn = 1")
def dedup_survivorship(inp):
    return silver.dedup_companies(merged_sources(inp)).select("domain", "company_name", "source_system", "source_id", "created_at")


@query(
    "dedup_annotated",
    """SELECT domain, source_system, source_id, domain AS duplicate_group_id, rn = 1 AS is_primary_record, CASE WHEN rn > 1 THEN 'domain_duplicate' END AS duplicate_reason FROM o_ranked""",
)
def dedup_annotated(inp):
    marked = silver.annotate_duplicates(merged_sources(inp))
    return marked.select("domain", "source_system", "source_id", "duplicate_group_id", "is_primary_record", "duplicate_reason")


cte(
    "o_linked",
    """SELECT * EXCLUDE (link_rn) FROM (SELECT *, row_number() OVER (PARTITION BY lower(trim(linkedin_url)) ORDER BY company_key) AS link_rn FROM o_companies)
       WHERE link_rn = 1 OR linkedin_url IS NULL OR trim(linkedin_url) = ''""",
)


# the same choice in the order of keys: the stay of each name is settled before the next one is looked at
cte(
    "o_near",
    """SELECT a.company_key AS later, list(b.company_key) AS earlier FROM o_linked a JOIN o_linked b ON b.company_key < a.company_key AND levenshtein(lower(trim(b.company_name)), lower(trim(a.company_name))) <= 1 GROUP BY 1""",
)
cte("o_settled", "SELECT list_reduce([NULL::VARCHAR[]] || list([later] || earlier ORDER BY later), lambda gone, n: CASE WHEN len(list_filter(n[2:], lambda k: NOT list_contains(coalesce(gone, []), k))) > 0 THEN list_append(coalesce(gone, []), n[1]) ELSE gone END) AS gone FROM o_near")


@query(
    "dedup_linkedin_fuzzy",
    """SELECT company_key, company_name, linkedin_url FROM o_linked WHERE NOT coalesce(list_contains((SELECT gone FROM o_settled), company_key), false)""",
)
def dedup_linkedin_fuzzy(inp):
    companies = silver.silver_companies(source_rows(inp), AS_OF)
    by_link = dedup.survivors_by_link(companies, "company_key", "linkedin_url")
    kept = dedup.survivors_by_near_name(by_link, "company_key", "company_name")
    return kept.select("company_key", "company_name", "linkedin_url")


@query(
    "silver_companies",
    f"""SELECT company_key, domain, linkedin_url, company_name, country, industry, description, founded_year, employee_count, size_bracket, {num('total_funding', 'data_quality_score', 'confidence_score')},
       website_url, source_priority, source_system AS source_systems, company_key AS duplicate_group_id, true AS is_primary_record, 'domain_exact_match' AS survivorship_rules_applied,
       NULL::VARCHAR AS legal_name, NULL::VARCHAR AS timezone, {stamp('created_at')}, '2024-01-31 00:00:00' AS updated_at, '2024-01-31' AS dt FROM o_companies""",
)
def silver_companies(inp):
    shown = (
        "company_key", "domain", "linkedin_url", "company_name", "country", "industry", "description", "founded_year", "employee_count",
        "size_bracket", "total_funding", "data_quality_score", "confidence_score", "website_url", "source_priority", "source_systems",
        "duplicate_group_id", "is_primary_record", "survivorship_rules_applied", "legal_name", "timezone", "created_at", "updated_at", "dt",
    )
    return companies_of(inp).select(*shown)


@shared
def companies_of(inp):
    return silver.silver_companies(source_rows(inp), AS_OF)


@query(
    "silver_vendor_companies",
    f"""SELECT s.*, v.domain AS company_key, v.name, v.state AS state_province, v.website AS website_url, v.employee_count, v.founded_year, v.industry,
       {num('TRY_CAST(v.latitude AS DECIMAL(10,8)) AS latitude', 'TRY_CAST(v.longitude AS DECIMAL(11,8)) AS longitude', 'TRY_CAST(v.total_funding AS DECIMAL(15,2)) AS total_funding')},
       CAST(TRY_CAST(v.founded_date AS DATE) AS VARCHAR) AS founded_date, {joined('v.technology_stack AS technology_stack', 'v.industry_tags AS industry_tags')},
       'apollo' AS source_system, '2024-01-31' AS dt FROM o_vendor_scored s JOIN o_vendor v ON v.id = s.apollo_id""",
)
def silver_vendor_companies(inp):
    from .row_queries import VENDOR_FLAGS

    shown = (
        "apollo_id", "domain", *VENDOR_FLAGS, "data_quality_score", "completeness_score", "accuracy_score", "company_key", "name",
        "state_province", "website_url", "employee_count", "founded_year", "industry", "latitude", "longitude", "total_funding",
        "founded_date", "technology_stack", "industry_tags", "source_system", "dt",
    )
    return silver.silver_vendor_companies(inp.raw_json("b_vendor"), AS_OF).select(*shown)


CONTACT_FLAG_SQL = {
    "is_valid_email": "email LIKE '%@%.%'",
    "is_valid_phone": "length(regexp_replace(phone, '[^0-9]', '', 'g')) >= 10",
    "is_valid_linkedin": "linkedin_url LIKE '%linkedin.com%'",
    "has_complete_name": "first_name <> '' AND last_name <> ''",
    "has_professional_info": "title <> '' AND department <> ''",
    "has_company_association": "organization_name <> '' AND organization_domain <> ''",
}
CONTACT_QUALITY = points(
    *[
        (filled(c), w)
        for c, w in (
            ("first_name", 0.15), ("last_name", 0.15), ("email", 0.2), ("title", 0.15), ("organization_name", 0.15), ("linkedin_url", 0.1), ("phone", 0.1),
        )
    ]
)
CONTACT_COMPLETE = share(
    *given("first_name", "last_name", "email", "title", "organization_name", "linkedin_url", "phone", "department", "seniority_level", "TRY_CAST(years_experience AS INTEGER)")
)
cte(
    "o_contacts",
    f"""SELECT id AS apollo_id, 'contact_' || id AS contact_key, lower(trim(organization_domain)) AS company_key, trim(title) AS title, department, seniority_level, linkedin_url,
       is_verified, TRY_CAST(years_experience AS INTEGER) AS years_experience, {TITLE_SQL} AS job_title_normalized, {SENIOR_SQL} AS is_senior_level, {DECIDER_SQL} AS is_decision_maker,
       {', '.join(f'coalesce({c}, false) AS {f}' for f, c in CONTACT_FLAG_SQL.items())}, {CONTACT_QUALITY} AS data_quality_score, {CONTACT_COMPLETE} AS completeness_score,
       {share(*CONTACT_FLAG_SQL.values())} AS accuracy_score,
       {points(('is_verified', 0.3), (SENIOR_SQL, 0.3), (DECIDER_SQL, 0.2), (CONTACT_FLAG_SQL['is_valid_email'], 0.1), (CONTACT_FLAG_SQL['is_valid_linkedin'], 0.1))} AS contact_quality_score
       FROM b_contacts WHERE coalesce(first_name, last_name, full_name) IS NOT NULL""",
)
SCORES = ("data_quality_score", "completeness_score", "accuracy_score", "contact_quality_score")


@query(
    "silver_contacts",
    f"""SELECT c.* EXCLUDE ({', '.join(SCORES)}), {num(*[f'c.{s} AS {s}' for s in SCORES])}, m.* EXCLUDE (apollo_id), 'sql|python' AS skills, 'apollo' AS source_system, '2024-01-31' AS dt
       FROM o_contacts c JOIN o_masked m USING (apollo_id)""",
)
def silver_contacts(inp):
    people = [f"{c}_{k}" for c in ("first_name", "last_name", "full_name", "email", "phone") for k in ("masked", "hash")]
    shown = (
        "apollo_id", "contact_key", "company_key", "title", "department", "seniority_level", "linkedin_url", "is_verified", "years_experience",
        "job_title_normalized", "is_senior_level", "is_decision_maker", *CONTACT_FLAG_SQL, *SCORES, *people, "pii_masking_applied",
        "skills", "source_system", "dt",
    )
    return contacts_of(inp).select(*shown)


@shared
def contacts_of(inp):
    return silver.silver_contacts(inp.raw_json("b_contacts"), AS_OF)


HEALTH_QUALITY = points(
    ("domain IS NOT NULL", 0.2), ("health_score IS NOT NULL", 0.2),
    *[(f"{c} IS NOT NULL", 0.1) for c in ("is_https_enabled", "ssl_grade", "page_load_time_ms", "seo_score", "security_score", "accessibility_score")],
)
HEALTH_COMPLETE = share(
    *given(
        "health_score", "is_https_enabled", "ssl_grade", "page_load_time_ms", "seo_score", "security_score", "accessibility_score",
        "domain_age_days", "domain_authority_score", "backlink_count",
    )
)
cte(
    "o_health",
    f"""SELECT page_id, domain, company_key, health_score, {HEALTH_GRADE_SQL}, {HEALTH_FLAG_SQL}, {HEALTH_QUALITY} AS data_quality_score, {HEALTH_COMPLETE} AS completeness_score
       FROM b_probes""",
)


@query(
    "silver_domain_health",
    f"""SELECT * EXCLUDE (health_score, data_quality_score, completeness_score), {num('health_score', 'data_quality_score', 'completeness_score')}, domain LIKE '%.%' AS is_valid_domain,
       domain <> '' AS is_domain_resolvable, NULL::DOUBLE AS accuracy_score, '{{"domain":"' || domain || '","analysis_timestamp":"2024-01-31"}}' AS raw_analysis_data, 'gate_job' AS source_system, '2024-01-31' AS dt FROM o_health""",
)
def silver_domain_health(inp):
    shown = (
        "page_id", "domain", "company_key", "health_score", "overall_grade", "risk_level", "is_ssl_valid", "is_website_accessible", "health_flags",
        "critical_issues", "warnings", "recommendations", "data_quality_score", "completeness_score", "is_valid_domain", "is_domain_resolvable",
        "accuracy_score", "raw_analysis_data", "source_system", "dt",
    )
    return health_of(inp).select(*shown)


@shared
def health_of(inp):
    return silver.silver_domain_health(inp["b_probes"], AS_OF)


@query("distinct_domains", "SELECT DISTINCT domain, domain AS company_key, company_name, industry, country FROM o_sources WHERE domain <> ''")
def distinct_domains(inp):
    return silver.company_domains(merged_sources(inp))


@shared
def page_raw(inp):
    """Page records packed as the crawler delivers them, nested parts included."""
    nested = inp["b_page_record"].select(
        "page_id", "url", "title", "content", "crawl_timestamp", "firecrawl_job_id", "extraction_method",
        F.struct(F.col("meta_description").alias("description"), F.col("meta_keywords").alias("keywords")).alias("meta"),
        F.struct("linkedin", "github").alias("social_links"),
        F.struct("email", "contact_form").alias("contact_info"),
        "tech_hints", "programming_languages", "clients_mentions", "testimonials", "navigation_items", "topics", "content_categories", "funding_hints",
    )
    return nested.select(F.to_json(F.struct("*")).alias("raw_json"))


cte(
    "o_pages",
    "SELECT * EXCLUDE (title, content), trim(title) AS title, content AS full_content, regexp_extract(url, 'https?://([^/]+)', 1) AS domain, "
    "lower(regexp_extract(url, 'https?://([^/]+)', 1)) AS company_key, TRY_CAST(crawl_timestamp AS TIMESTAMP) AS crawl_ts, "
    "len(tech_hints) > 0 AS has_tech, len(clients_mentions) > 0 AS has_clients FROM b_page_record WHERE url <> '' AND content IS NOT NULL",
)
RICHNESS_SQL = points(
    (filled("title"), 0.1), (filled("meta_description"), 0.1), ("length(full_content) > 500", 0.2), ("linkedin IS NOT NULL", 0.1),
    ("email IS NOT NULL", 0.1), ("has_tech", 0.1), ("has_clients", 0.1), ("len(navigation_items) > 0", 0.1),
)
cte(
    "o_web",
    f"""SELECT *, {RICHNESS_SQL} AS content_richness_score, {step_of('word_count', READABILITY)} AS readability_score,
       {points(('has_tech', 0.3), ('len(programming_languages) > 0', 0.2))} AS technical_depth_score, {points(('len(funding_hints) > 0', 0.2))} AS business_info_score,
       {points(('url IS NOT NULL', 0.2), ('title IS NOT NULL', 0.2), ('full_content IS NOT NULL', 0.2), ('crawl_ts IS NOT NULL', 0.1), ('firecrawl_job_id IS NOT NULL', 0.1), ('extraction_method IS NOT NULL', 0.1), ('domain IS NOT NULL', 0.1))} AS data_quality_score,
       ({share('url IS NOT NULL', 'title IS NOT NULL', 'full_content IS NOT NULL', 'crawl_ts IS NOT NULL', 'meta_description IS NOT NULL', 'has_tech', 'has_clients', 'linkedin IS NOT NULL', 'email IS NOT NULL', 'len(navigation_items) > 0')}) AS completeness_score,
       md5(url || title || full_content) AS content_hash, contains(url, domain) AS is_company_website
       FROM (SELECT *, {METRIC_SQL}, {PAGE_TYPE_SQL} FROM o_pages)""",
)
WEB_SCORES = ("content_richness_score", "readability_score", "technical_depth_score", "business_info_score", "data_quality_score", "completeness_score")


@query(
    "silver_web_extracts",
    f"""SELECT url AS page_url, company_key, domain, title, meta_description, page_type, about_snippet, content_length, word_count, {num(*WEB_SCORES)}, {stamp('crawl_ts')},
       trim(linkedin) AS social_links_linkedin, trim(github) AS social_links_github, email AS contact_info_email, CAST(contact_form AS BOOLEAN) AS contact_info_contact_form,
       CASE WHEN meta_keywords IS NULL THEN '' ELSE 'alpha|beta|gamma|delta' END AS meta_keywords, {joined('tech_hints', 'topics', 'navigation_items')},
       meta_description IS NOT NULL AS has_meta_description, meta_keywords IS NOT NULL AS has_meta_keywords, coalesce(has_tech, false) AS has_structured_data, has_external_links, has_images, has_videos,
       is_accessible, has_content, url LIKE 'http%' AS is_valid_url, is_company_website, content_hash, firecrawl_job_id FROM o_web""",
)
def silver_web_extracts(inp):
    shown = (
        "page_url", "company_key", "domain", "title", "meta_description", "page_type", "about_snippet", "content_length", "word_count", *WEB_SCORES,
        "crawl_ts", F.col("social_links.linkedin").alias("social_links_linkedin"), F.col("social_links.github").alias("social_links_github"),
        F.col("contact_info.email").alias("contact_info_email"), F.col("contact_info.contact_form").alias("contact_info_contact_form"),
        "meta_keywords", "tech_hints", "topics", "navigation_items", "has_meta_description", "has_meta_keywords", "has_structured_data",
        "has_external_links", "has_images", "has_videos", "is_accessible", "has_content", "is_valid_url", "is_company_website", "content_hash",
        "firecrawl_job_id",
    )
    return web_of(inp).select(*shown)


@shared
def web_of(inp):
    return silver.silver_web_extracts(page_raw(inp), AS_OF)


@query("content_scores", f"SELECT url AS page_url, firecrawl_job_id, {num(*WEB_SCORES[:4])} FROM o_web")
def content_scores(inp):
    return web_of(inp).select("page_url", "firecrawl_job_id", *WEB_SCORES[:4])


# --- second generation ---------------------------------------------------------


@query(
    "silver_b",
    f"""SELECT 'companies' AS kind, id, name, employee_count, annual_revenue, founded_year, {stamp('created_at')}, year(created_at)::INTEGER AS year, month(created_at)::INTEGER AS month, day(created_at)::INTEGER AS day FROM o_gen_companies
       UNION ALL SELECT 'vendor', id, name, employee_count, annual_revenue, founded_year, {stamp('created_at')}, year(created_at)::INTEGER, month(created_at)::INTEGER, day(created_at)::INTEGER FROM o_gen_companies
       UNION ALL SELECT 'contacts', id, first_name, NULL, TRY_CAST(organization_annual_revenue AS BIGINT), NULL, {stamp('ts AS created_at')}, year(ts)::INTEGER, month(ts)::INTEGER, day(ts)::INTEGER FROM (SELECT *, CAST(created_at AS TIMESTAMP) AS ts FROM b_gen_contacts)""",
)
def silver_b(inp):
    shown = ["kind", "id", "name", "employee_count", "annual_revenue", "founded_year", "created_at", "year", "month", "day"]
    firms = second_gen.payload_table(gen_raw(inp, "b_gen_companies"), second_gen.COMPANY_PAYLOAD)
    vendor = second_gen.payload_table(gen_raw(inp, "b_gen_companies"), second_gen.VENDOR_PAYLOAD)
    people = second_gen.payload_table(gen_raw(inp, "b_gen_contacts"), second_gen.CONTACT_PAYLOAD).withColumnsRenamed(
        {"first_name": "name", "organization_employee_count": "employee_count", "organization_annual_revenue": "annual_revenue", "organization_founded_year": "founded_year"}
    )
    parts = [df.withColumn("kind", F.lit(k)).select(*shown) for k, df in (("companies", firms), ("vendor", vendor), ("contacts", people))]
    return quality.union_all(parts)


@shared
def gen_crawl_raw(inp):
    """Crawl payloads with metadata and extracted parts."""
    rows = inp["b_gen_crawls"].select(
        F.struct("company_id", "domain", "pages_crawled", "crawled_at", "content_hash").alias("metadata"),
        F.struct(
            F.array(F.struct("page_id")).alias("pages"), F.struct("main_language").alias("extracted_content"), F.struct("page_id").alias("crawl_metadata")
        ).alias("extracted_data"),
    )
    return rows.select(F.to_json(F.struct("*")).alias("data"))


cte(
    "o_gen_web",
    """SELECT w.company_id, c.name AS company_name, c.industry, c.employee_count, TRY_CAST(w.pages_crawled AS INTEGER) AS pages_crawled, CAST(w.crawled_at AS TIMESTAMP) AS crawled_at, w.content_hash,
       '[{"page_id":' || w.page_id || '}]' AS pages_data, '{"main_language":"' || w.main_language || '"}' AS extracted_content
       FROM b_gen_crawls w JOIN o_gen_companies c ON c.id = w.company_id WHERE w.domain IS NOT NULL""",
)


@query("web_extracts_b", f"SELECT * EXCLUDE (crawled_at), {stamp('crawled_at')}, day(crawled_at)::INTEGER AS day FROM o_gen_web")
def web_extracts_b(inp):
    shown = ["company_id", "company_name", "industry", "employee_count", "pages_crawled", "crawled_at", "content_hash", "pages_data", "extracted_content", "day"]
    return gen_web_of(inp).select(*shown)


@shared
def gen_companies_of(inp):
    return second_gen.payload_table(gen_raw(inp, "b_gen_companies"), second_gen.COMPANY_PAYLOAD)


@shared
def gen_web_of(inp):
    return second_gen.web_extracts(gen_crawl_raw(inp), gen_companies_of(inp))
