"""Cleaned, deduplicated and masked SILVER tables.

``as_of`` (a date text) stands for the run date in every function.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import privacy, scoring
from ..functions.json_fields import scalar, text_schema
from ..functions.scoring import (
    all_present,
    completeness,
    every_flag,
    first_flag,
    first_match,
    has_items,
    holds,
    ladder,
    present,
    upper_ladder,
    weighted_score,
)
from ..functions.text import contains_any, digits, host_of, key_text, word_count
from ..operators.dedup import mark_duplicates, union_sources
from ..operators.ordering import keep_first

# Columns of the canonical company table, in order, with types.
COMPANY_COLUMNS: dict[str, str] = {
    "company_key": "string", "domain": "string", "linkedin_url": "string", "company_name": "string",
    "legal_name": "string", "dba_name": "string", "country": "string", "state_province": "string",
    "city": "string", "postal_code": "string", "timezone": "string", "industry": "string",
    "sub_industry": "string", "industry_category": "string", "naics_code": "string", "sic_code": "string",
    "description": "string", "short_description": "string", "founded_year": "int", "founded_month": "int",
    "founded_date": "date", "employee_count": "int", "employee_range": "string", "revenue_range": "string",
    "size_bracket": "string", "total_funding": "decimal(15,2)", "last_funding_date": "string",
    "last_funding_type": "string", "last_funding_amount": "decimal(15,2)", "funding_stage": "string",
    "valuation": "decimal(15,2)", "website_url": "string", "facebook_url": "string", "twitter_url": "string",
    "instagram_url": "string", "youtube_url": "string", "github_url": "string", "data_quality_score": "double",
    "source_priority": "int", "source_systems": "array<string>", "confidence_score": "double",
    "duplicate_group_id": "string", "is_primary_record": "boolean", "duplicate_reason": "string",
    "survivorship_rules_applied": "array<string>", "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz",
    "last_verified_at": "timestamp_ntz", "dt": "string",
}

# Headcount brackets (upper bounds).
SIZE_BRACKETS = [(10, "startup"), (50, "small"), (200, "medium"), (1000, "large")]

TRIMMED = (
    "company_name", "legal_name", "dba_name", "country", "state_province", "city", "postal_code",
    "industry", "sub_industry", "description",
)


def trim_all(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.trim(c) for c in columns if c in df.columns})


def run_time(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")


def normalize_companies(source: DataFrame) -> DataFrame:
    """Domain key, trimmed texts, and only rows that have a domain and a name."""
    kept = source.where(all_present("domain", "company_name"))
    keyed = kept.withColumns({"company_key": key_text("domain"), "domain": key_text("domain")})
    return trim_all(keyed, TRIMMED)


def size_bracket(c: Column | str) -> Column:
    value = scoring.col_of(c)
    return F.when(value.isNull(), F.lit("unknown")).otherwise(upper_ladder(value, SIZE_BRACKETS, "enterprise"))


def company_scores(df: DataFrame) -> DataFrame:
    """Quality ladder by key fields and presence-weighted confidence."""
    has = {
        c: F.col(c).isNotNull()
        for c in ("domain", "company_name", "country", "industry", "description", "founded_year")
    }
    quality = first_match(
        [
            (has["domain"] & has["company_name"], F.lit(1.0)),
            (has["domain"], F.lit(0.8)),
            (has["company_name"], F.lit(0.6)),
        ],
        F.lit(0.4),
    )
    confidence = weighted_score(
        [(cond, 0.3 if c in ("domain", "company_name") else 0.1) for c, cond in has.items()]
    )
    return df.withColumns({"data_quality_score": quality, "confidence_score": confidence})


SURVIVOR_ORDER = ("source_priority", "created_at", "source_id")


def survivor_order() -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in SURVIVOR_ORDER]


def dedup_companies(companies: DataFrame) -> DataFrame:
    """One row per domain: best source, then oldest, then smallest id."""
    return keep_first(companies, ["domain"], survivor_order())


def annotate_duplicates(companies: DataFrame) -> DataFrame:
    """All rows, each with its group, survivor flag and duplicate reason."""
    return mark_duplicates(
        companies, "domain", "company_key", survivor_order(), SURVIVOR_ORDER, "domain_duplicate"
    )


def silver_companies(sources: Sequence[DataFrame], as_of: str) -> DataFrame:
    """Canonical companies from all sources, one row per domain."""
    merged = union_sources(*[normalize_companies(s) for s in sources])
    absent = {c: F.lit(None).cast(t) for c, t in COMPANY_COLUMNS.items() if c not in merged.columns}
    kept = company_scores(dedup_companies(merged.withColumns(absent)))
    return kept.withColumns(
        {
            "duplicate_group_id": F.col("company_key"),
            "is_primary_record": F.lit(True),
            "duplicate_reason": F.lit(None).cast("string"),
            "survivorship_rules_applied": F.array(F.lit("domain_exact_match")),
            "source_systems": F.array("source_system"),
            "size_bracket": size_bracket("employee_count"),
            "updated_at": run_time(as_of),
            "last_verified_at": run_time(as_of),
            "dt": F.lit(as_of),
        }
    ).select(*[F.col(c).cast(t).alias(c) for c, t in COMPANY_COLUMNS.items()])


# JSON fields of a vendor company record (target column, source field, type).
VENDOR_FIELDS: list[tuple[str, str, str]] = [
    ("apollo_id", "id", "raw"), ("apollo_url", "url", "raw"),
    ("apollo_organization_id", "organization_id", "raw"),
    ("name", "name", "text"), ("legal_name", "legal_name", "text"), ("dba_name", "dba_name", "text"),
    ("domain", "domain", "key"), ("website_url", "website", "text"),
    ("country", "country", "text"), ("state_province", "state", "text"), ("city", "city", "text"),
    ("postal_code", "postal_code", "text"), ("address_line1", "address_line1", "text"),
    ("address_line2", "address_line2", "text"), ("timezone", "timezone", "text"),
    ("latitude", "latitude", "decimal(10,8)"), ("longitude", "longitude", "decimal(11,8)"),
    ("industry", "industry", "text"), ("sub_industry", "sub_industry", "text"),
    ("industry_category", "industry_category", "text"), ("naics_code", "naics_code", "text"),
    ("sic_code", "sic_code", "text"), ("description", "description", "text"),
    ("short_description", "short_description", "text"), ("tagline", "tagline", "text"),
    ("founded_year", "founded_year", "int"), ("founded_month", "founded_month", "int"),
    ("founded_date", "founded_date", "date"), ("employee_count", "employee_count", "int"),
    ("employee_range", "employee_range", "text"), ("revenue_range", "revenue_range", "text"),
    ("annual_revenue", "annual_revenue", "decimal(15,2)"), ("total_funding", "total_funding", "decimal(15,2)"),
    ("last_funding_date", "last_funding_date", "date"), ("last_funding_type", "last_funding_type", "text"),
    ("last_funding_amount", "last_funding_amount", "decimal(15,2)"), ("funding_stage", "funding_stage", "text"),
    ("valuation", "valuation", "decimal(15,2)"),
    ("linkedin_url", "linkedin_url", "text"), ("facebook_url", "facebook_url", "text"),
    ("twitter_url", "twitter_url", "text"), ("instagram_url", "instagram_url", "text"),
    ("youtube_url", "youtube_url", "text"), ("github_url", "github_url", "text"),
    ("crunchbase_url", "crunchbase_url", "text"),
    ("apollo_organization_type", "organization_type", "text"),
    ("apollo_organization_status", "organization_status", "text"),
    ("apollo_organization_size", "organization_size", "text"),
    ("apollo_organization_industry", "organization_industry", "text"),
    ("apollo_organization_website", "organization_website", "text"),
    ("apollo_organization_phone", "organization_phone", "text"),
    ("apollo_organization_email", "organization_email", "text"),
]
VENDOR_ARRAYS = (
    "technology_stack", "programming_languages", "frameworks", "databases", "cloud_providers", "industry_tags",
)


def shape(value: Column, kind: str) -> Column:
    """Raw text, trimmed text, join key, or a typed value with null for dirt."""
    if kind == "raw":
        return value
    if kind == "text":
        return F.trim(value)
    if kind == "key":
        return key_text(value)
    return value.try_cast(kind)


def extract(raw: DataFrame, fields: Sequence[tuple[str, str, str]], arrays: Sequence[str] = ()) -> DataFrame:
    """Typed columns of the JSON text in ``raw_json``.

    ``inline`` keeps the parse out of the filters that follow: Spark would push
    them below a plain ``from_json`` and parse every row a second time.
    """
    schema = text_schema([source for _, source, _ in fields], arrays)
    parsed = raw.select("raw_json", F.inline(F.array(F.from_json("raw_json", schema))))
    return parsed.select(
        "raw_json",
        *[shape(scalar(F.col(source)), kind).alias(target) for target, source, kind in fields],
        *arrays,
    )


def lineage(id_column: str, source: str, as_of: str) -> dict[str, Column]:
    return {
        "source_system": F.lit(source),
        "source_record_id": F.col(id_column),
        "raw_data_hash": F.md5("raw_json"),
        "created_at": run_time(as_of),
        "updated_at": run_time(as_of),
        "last_verified_at": run_time(as_of),
        "dt": F.lit(as_of),
    }


def vendor_flags(df: DataFrame) -> DataFrame:
    """Validity flags of a company record and the share that holds."""
    site = F.col("website_url")
    place = [F.col(c).isNotNull() for c in ("address_line1", "city", "state_province", "country")]
    flags = {
        "is_valid_domain": present("domain") & F.col("domain").contains("."),
        "is_valid_email": F.col("apollo_organization_email").like("%@%.%"),
        "is_valid_phone": F.length(digits("apollo_organization_phone")) >= 10,
        "is_valid_website": site.startswith("http") | site.startswith("www."),
        "has_complete_address": place[0] & place[1] & place[2] & place[3],
        "has_industry_classification": present("industry"),
    }
    flagged = df.withColumns({name: holds(cond) for name, cond in flags.items()})
    return flagged.withColumn("accuracy_score", completeness([F.col(f) for f in flags]))


def vendor_scores(df: DataFrame) -> DataFrame:
    text_weights = {"domain": 0.2, "name": 0.2, "country": 0.1, "industry": 0.1, "description": 0.1, "linkedin_url": 0.1}
    terms = [(present(c), w) for c, w in text_weights.items()]
    terms += [(F.col(c).isNotNull(), 0.1) for c in ("founded_year", "employee_count")]
    counted = [*text_weights, "founded_year", "employee_count", "website_url", "city"]
    return df.withColumns(
        {
            "data_quality_score": weighted_score(terms),
            "completeness_score": completeness([F.col(c).isNotNull() for c in counted]),
            "freshness_score": F.lit(1.0),
        }
    )


def silver_vendor_companies(raw: DataFrame, as_of: str) -> DataFrame:
    """Vendor company records: typed, trimmed, validated and scored."""
    parsed = extract(raw, VENDOR_FIELDS, VENDOR_ARRAYS)
    kept = parsed.where(F.col("apollo_id").isNotNull() & all_present("domain", "name"))
    scored = vendor_scores(vendor_flags(kept)).withColumn("company_key", F.col("domain"))
    return scored.withColumns(lineage("apollo_id", "apollo", as_of)).drop("raw_json")


# JSON fields of a contact record.
CONTACT_FIELDS: list[tuple[str, str, str]] = [
    ("apollo_id", "id", "raw"), ("apollo_url", "url", "raw"),
    ("apollo_organization_id", "organization_id", "raw"),
    ("first_name", "first_name", "raw"), ("last_name", "last_name", "raw"), ("full_name", "full_name", "raw"),
    ("title", "title", "raw"), ("department", "department", "text"),
    ("seniority_level", "seniority_level", "text"), ("job_function", "job_function", "text"),
    ("email", "email", "raw"), ("phone", "phone", "raw"),
    ("linkedin_url", "linkedin_url", "text"), ("twitter_url", "twitter_url", "text"),
    ("company_name", "organization_name", "text"), ("company_domain", "organization_domain", "key"),
    ("company_industry", "organization_industry", "text"), ("company_size_range", "organization_size", "text"),
    ("company_location", "organization_location", "text"), ("years_experience", "years_experience", "int"),
    ("education_level", "education_level", "text"), ("education_institution", "education_institution", "text"),
    ("contact_status", "contact_status", "text"), ("contact_source", "contact_source", "text"),
    ("is_verified", "is_verified", "boolean"),
]
CONTACT_ARRAYS = ("skills", "certifications", "languages")

# Job title keywords in the order they are tried.
TITLE_RULES: list[tuple[str, tuple[str, ...]]] = [
    ("CEO", ("ceo", "chief executive")),
    ("CTO", ("cto", "chief technology")),
    ("CFO", ("cfo", "chief financial")),
    ("CMO", ("cmo", "chief marketing")),
    ("COO", ("coo", "chief operating")),
    ("VP", ("vp", "vice president")),
    ("Director", ("director",)),
    ("Manager", ("manager",)),
    ("Senior", ("senior",)),
    ("Junior", ("junior", "jr")),
]
SENIOR_LEVELS = ("executive", "c-level", "senior executive")
SENIOR_TITLE_WORDS = ("ceo", "cto", "cfo", "chief", "president")
DECIDER_TITLE_WORDS = (*SENIOR_TITLE_WORDS, "director", "vp")
MASKED_FIELDS = ("first_name", "last_name", "full_name", "email", "phone")


def normalized_title(c: Column | str) -> Column:
    title = scoring.col_of(c)
    lowered = F.lower(title)
    return first_match([(contains_any(lowered, words), F.lit(label)) for label, words in TITLE_RULES], F.trim(title))


def contact_roles(df: DataFrame) -> DataFrame:
    """Normalised title, seniority and decision-maker flags."""
    lowered = F.lower("title")
    senior_level = holds(F.lower("seniority_level").isin(*SENIOR_LEVELS))
    return df.withColumns(
        {
            "job_title_normalized": normalized_title("title"),
            "is_senior_level": senior_level | contains_any(lowered, SENIOR_TITLE_WORDS),
            "is_decision_maker": contains_any(lowered, DECIDER_TITLE_WORDS),
        }
    )


def contact_flags(df: DataFrame) -> DataFrame:
    flags = {
        "is_valid_email": F.col("email").like("%@%.%"),
        "is_valid_phone": F.length(digits("phone")) >= 10,
        "is_valid_linkedin": F.col("linkedin_url").contains("linkedin.com"),
        "has_complete_name": all_present("first_name", "last_name"),
        "has_professional_info": all_present("title", "department"),
        "has_company_association": all_present("company_name", "company_domain"),
    }
    flagged = df.withColumns({name: holds(cond) for name, cond in flags.items()})
    return flagged.withColumn("accuracy_score", completeness([F.col(f) for f in flags]))


def contact_scores(df: DataFrame) -> DataFrame:
    weights = {
        "first_name": 0.15, "last_name": 0.15, "email": 0.2, "title": 0.15,
        "company_name": 0.15, "linkedin_url": 0.1, "phone": 0.1,
    }
    counted = [*weights, "department", "seniority_level", "years_experience"]
    quality = [
        (holds(F.col("is_verified")), 0.3),
        (F.col("is_senior_level"), 0.3),
        (F.col("is_decision_maker"), 0.2),
        (F.col("is_valid_email"), 0.1),
        (F.col("is_valid_linkedin"), 0.1),
    ]
    return df.withColumns(
        {
            "data_quality_score": weighted_score([(present(c), w) for c, w in weights.items()]),
            "completeness_score": completeness([F.col(c).isNotNull() for c in counted]),
            "freshness_score": F.lit(1.0),
            "contact_quality_score": weighted_score(quality),
        }
    )


def mask_contacts(df: DataFrame) -> DataFrame:
    """Add masked and hashed copies of the personal fields; keep named people."""
    named = df.where(F.coalesce("first_name", "last_name", "full_name").isNotNull())
    people = ("first_name", "last_name", "full_name")
    masked = {f"{c}_masked": privacy.mask_name(c) for c in people}
    hashed = {f"{c}_hash": privacy.match_hash(c) for c in people}
    return named.withColumns(
        {
            **masked,
            **hashed,
            "email_masked": privacy.mask_email("email"),
            "email_hash": privacy.match_hash("email"),
            "phone_masked": privacy.mask_phone("phone"),
            "phone_hash": privacy.phone_hash("phone"),
            "pii_masking_applied": F.array(*[F.lit(f) for f in MASKED_FIELDS]),
        }
    )


def silver_contacts(raw: DataFrame, as_of: str) -> DataFrame:
    """Masked contacts; clear personal fields never leave this function."""
    parsed = extract(raw, CONTACT_FIELDS, CONTACT_ARRAYS).where(F.col("apollo_id").isNotNull())
    masked = mask_contacts(contact_scores(contact_flags(contact_roles(parsed))))
    return (
        masked.withColumns(
            {
                "contact_key": F.concat(F.lit("contact_"), "apollo_id"),
                "company_key": F.col("company_domain"),
                "title": F.trim("title"),
                **lineage("apollo_id", "apollo", as_of),
            }
        )
        .drop("raw_json", *MASKED_FIELDS)
    )


# Health thresholds and probe weights.
GRADES = [(0.9, "A"), (0.8, "B"), (0.7, "C"), (0.6, "D")]
RISKS = [(0.8, "low"), (0.6, "medium"), (0.4, "high")]
GOOD_SSL = ("A+", "A", "B")
WEAK_SSL = ("C", "D", "F")
PROBE_WEIGHTS = [
    ("dns_status", "resolved", 0.2),
    ("http_status", "success", 0.2),
    ("https_status", "success", 0.3),
    ("tls_status", "valid", 0.2),
    ("content_status", "success", 0.1),
]
REGULATED = ("finance", "healthcare", "ecommerce")


def probe_health_score() -> Column:
    """Share of the probe weight that succeeded."""
    return weighted_score([(F.col(c) == good, w) for c, good, w in PROBE_WEIGHTS])


def probe_flags(score: str = "domain_health_score") -> Column:
    """Every failed probe, then low score and empty content."""
    failed = [(F.col(c) == "failed", c.replace("status", "failed")) for c, _, _ in PROBE_WEIGHTS]
    low = F.coalesce(F.col(score), F.lit(0.0)) < 0.5
    empty = F.coalesce(F.col("content_size_bytes"), F.lit(0)) == 0
    return every_flag([*failed, (low, "low_health_score"), (empty, "no_content")])


def health_grades(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "overall_grade": ladder("health_score", GRADES, "F"),
            "risk_level": ladder("health_score", RISKS, "critical"),
            "is_ssl_valid": holds(F.col("ssl_grade").isin(*GOOD_SSL)),
            "is_website_accessible": holds(F.col("health_score") > 0.3),
            "is_domain_resolvable": holds(present("domain")),
            "is_valid_domain": holds(present("domain") & F.col("domain").contains(".")),
        }
    )


def health_flag_arrays(df: DataFrame) -> DataFrame:
    """At most one flag per array: the first problem found."""
    no_https = ~F.col("is_https_enabled")
    slow, load = F.col("page_load_time_ms") > 3000, F.col("page_load_time_ms") > 2000
    malware, phishing = F.col("is_malware_detected"), F.col("is_phishing_detected")

    def weak(column: str, below: float) -> Column:
        return F.col(column) < below

    weak_ssl = F.col("ssl_grade").isin(*WEAK_SSL)
    return df.withColumns(
        {
            "health_flags": first_flag(
                [
                    (no_https, "no_https"),
                    (F.col("ssl_grade").isin("D", "F"), "poor_ssl"),
                    (slow, "slow_loading"),
                    (weak("seo_score", 0.5), "poor_seo"),
                    (weak("security_score", 0.5), "security_issues"),
                    (weak("accessibility_score", 0.5), "accessibility_issues"),
                    (malware, "malware_detected"),
                    (phishing, "phishing_detected"),
                ]
            ),
            "critical_issues": first_flag(
                [
                    (malware, "malware_detected"),
                    (phishing, "phishing_detected"),
                    (no_https & F.col("industry").isin(*REGULATED), "no_https_critical"),
                ]
            ),
            "warnings": first_flag(
                [
                    (weak_ssl, "ssl_warning"),
                    (load, "performance_warning"),
                    (weak("seo_score", 0.6), "seo_warning"),
                    (weak("security_score", 0.6), "security_warning"),
                    (weak("accessibility_score", 0.6), "accessibility_warning"),
                ]
            ),
            "recommendations": first_flag(
                [
                    (no_https, "enable_https"),
                    (weak_ssl, "improve_ssl"),
                    (load, "optimize_performance"),
                    (weak("seo_score", 0.6), "improve_seo"),
                    (weak("security_score", 0.6), "improve_security"),
                    (weak("accessibility_score", 0.6), "improve_accessibility"),
                    (~F.col("has_meta_description"), "add_meta_description"),
                    (~F.col("has_contact_page"), "add_contact_page"),
                ]
            ),
        }
    )


def health_scores(df: DataFrame) -> DataFrame:
    measured = ["health_score", "is_https_enabled", "ssl_grade", "page_load_time_ms", "seo_score", "security_score", "accessibility_score"]
    extra = ["domain_age_days", "domain_authority_score", "backlink_count"]
    weights = {"domain": 0.2, "health_score": 0.2, **dict.fromkeys(measured[1:], 0.1)}
    return df.withColumns(
        {
            "data_quality_score": weighted_score([(F.col(c).isNotNull(), w) for c, w in weights.items()]),
            "completeness_score": completeness([F.col(c).isNotNull() for c in (*measured, *extra)]),
            "accuracy_score": F.lit(None).cast("double"),
            "freshness_score": F.lit(1.0),
        }
    )


def company_domains(companies: DataFrame) -> DataFrame:
    """Distinct domains with the company facts the health job needs."""
    known = companies.where(present("domain"))
    return known.select("domain", "company_key", "company_name", "industry", "country").distinct()


def silver_domain_health(probes: DataFrame, as_of: str) -> DataFrame:
    """Grades, flags and scores of probed domains."""
    graded = health_scores(health_flag_arrays(health_grades(probes)))
    analysis = F.struct(F.col("domain"), F.lit(as_of).alias("analysis_timestamp"))
    return graded.withColumns(
        {
            "is_analysis_complete": F.lit(True),
            "source_system": F.lit("gate_job"),
            "raw_analysis_data": F.to_json(analysis),
            "analysis_timestamp": run_time(as_of),
            "created_at": run_time(as_of),
            "updated_at": run_time(as_of),
            "last_verified_at": run_time(as_of),
            "dt": F.lit(as_of),
        }
    )


# JSON fields of a crawled page record.
SOCIAL = ("linkedin", "facebook", "twitter", "instagram", "youtube", "github", "tiktok", "discord", "slack")
PAGE_FIELDS: list[tuple[str, str, str]] = [
    ("page_url", "url", "raw"), ("title", "title", "text"),
    ("meta_description", "meta.description", "text"), ("meta_keywords_text", "meta.keywords", "raw"),
    ("full_content", "content", "raw"), ("crawl_ts", "crawl_timestamp", "timestamp_ntz"),
    *[(f"{s}_link", f"social_links.{s}", "text") for s in SOCIAL],
    ("contact_email", "contact_info.email", "text"), ("contact_phone", "contact_info.phone", "text"),
    ("contact_address", "contact_info.address", "text"), ("contact_form", "contact_info.contact_form", "boolean"),
    ("live_chat", "contact_info.live_chat", "boolean"),
    ("firecrawl_job_id", "firecrawl_job_id", "text"), ("extraction_method", "extraction_method", "text"),
]
PAGE_ARRAYS = (
    "clients_mentions", "testimonials", "case_studies", "tech_hints", "programming_languages", "frameworks",
    "databases", "cloud_providers", "cms_platforms", "analytics_tools", "navigation_items", "footer_links",
    "cta_buttons", "forms_detected", "content_categories", "topics", "keywords", "company_size_hints",
    "industry_hints", "location_hints", "funding_hints", "team_hints",
)
PAGE_TYPES = ("about", "contact", "blog", "product", "pricing", "team", "careers")


def page_type(url: Column | str, title: Column | str, host: Column | str) -> Column:
    """First keyword found in the path or title, then homepage, then other."""
    url, title, host = scoring.col_of(url), F.lower(scoring.col_of(title)), scoring.col_of(host)
    named = [(holds(url.contains(f"/{p}") | title.contains(p)), F.lit(p)) for p in PAGE_TYPES]
    home = holds((url == host) | url.endswith("/"))
    return first_match([*named, (home, F.lit("homepage"))], F.lit("other"))


def content_metrics(df: DataFrame, snippet_chars: int | None = None) -> DataFrame:
    """Snippet (the whole content unless a length is given), lengths and markers of the page content."""
    content = F.col("full_content")
    return df.withColumns(
        {
            "about_snippet": content if snippet_chars is None else F.substring(content, 1, snippet_chars),
            "content_length": F.length(content),
            "word_count": word_count(content),
            "has_external_links": contains_any(content, ["http"]),
            "has_images": contains_any(content, ["<img", "<picture"]),
            "has_videos": contains_any(content, ["<video", "youtube"]),
            "is_accessible": holds(F.length(content) > 100),
            "has_content": holds(F.length(content) > 50),
        }
    )


def readability(words: Column | str) -> Column:
    n = scoring.col_of(words)
    return first_match(
        [
            ((n > 1000) & (n < 5000), F.lit(1.0)),
            ((n > 500) & (n < 10000), F.lit(0.8)),
            (n > 100, F.lit(0.6)),
        ],
        F.lit(0.4),
    )


def any_present(*columns: str) -> Column:
    return F.coalesce(*columns).isNotNull()


def content_scores(df: DataFrame) -> DataFrame:
    """Richness (ten signals), readability, technical depth, business info."""
    signals = ("tech_hints", "clients_mentions", "navigation_items", "cta_buttons", "forms_detected")
    richness = [
        (present("title"), 0.1),
        (present("meta_description"), 0.1),
        (F.length("full_content") > 500, 0.2),
        (any_present("linkedin_link", "facebook_link", "twitter_link"), 0.1),
        (any_present("contact_email", "contact_phone"), 0.1),
        *[(has_items(s), 0.1) for s in signals],
    ]
    depth = {
        "tech_hints": 0.3, "programming_languages": 0.2, "frameworks": 0.2,
        "databases": 0.1, "cloud_providers": 0.1, "analytics_tools": 0.1,
    }
    hints = ("company_size_hints", "industry_hints", "location_hints", "funding_hints", "team_hints")
    return df.withColumns(
        {
            "content_richness_score": weighted_score(richness),
            "readability_score": readability("word_count"),
            "technical_depth_score": weighted_score([(has_items(c), w) for c, w in depth.items()]),
            "business_info_score": weighted_score([(has_items(c), 0.2) for c in hints]),
        }
    )


def content_hash(*parts: str) -> Column:
    """MD5 of the joined parts; null as soon as one part is null."""
    return F.md5(F.concat(*parts))


def silver_web_extracts(raw: DataFrame, as_of: str, strip_www: bool = False) -> DataFrame:
    """Crawled pages: keys, page type, content metrics, scores and structs."""
    parsed = extract(raw, PAGE_FIELDS, PAGE_ARRAYS)
    kept = parsed.where(present("page_url") & F.col("full_content").isNotNull())
    host = host_of("page_url", strip_www)
    keyed = kept.withColumns({"domain": host, "company_key": F.lower(host)})
    keywords = F.split(F.regexp_replace("meta_keywords_text", r"[,\s]+", ","), ",")
    measured = content_scores(content_metrics(keyed))
    enriched = measured.withColumns(
        {
            "meta_keywords": F.when(present("meta_keywords_text"), keywords).otherwise(scoring.no_strings()),
            "page_type": page_type("page_url", "title", "domain"),
            "social_links": F.struct(*[F.col(f"{s}_link").alias(s) for s in SOCIAL]),
            "contact_info": F.struct(
                F.col("contact_email").alias("email"),
                F.col("contact_phone").alias("phone"),
                F.col("contact_address").alias("address"),
                "contact_form",
                "live_chat",
            ),
        }
    )
    seen = {"page_url": 0.2, "title": 0.2, "full_content": 0.2, **dict.fromkeys(("crawl_ts", "firecrawl_job_id", "extraction_method", "domain"), 0.1)}
    counted = [
        *[F.col(c).isNotNull() for c in ("page_url", "title", "full_content", "crawl_ts", "meta_description", "linkedin_link", "contact_email")],
        *[has_items(c) for c in ("tech_hints", "clients_mentions", "navigation_items")],
    ]
    return enriched.withColumns(
        {
            "has_meta_description": holds(present("meta_description")),
            "has_meta_keywords": has_items("meta_keywords"),
            "has_structured_data": has_items("tech_hints"),
            "has_heading_structure": has_items("navigation_items"),
            "has_internal_links": has_items("footer_links"),
            "is_valid_url": holds(F.col("page_url").startswith("http")),
            "is_company_website": holds(F.col("page_url").contains(F.col("domain"))),
            "data_quality_score": weighted_score([(F.col(c).isNotNull(), w) for c, w in seen.items()]),
            "completeness_score": completeness(counted),
            "accuracy_score": F.lit(None).cast("double"),
            "freshness_score": F.lit(1.0),
            "content_hash": content_hash("page_url", "title", "full_content"),
            "source_system": F.lit("firecrawl"),
            "raw_data_hash": F.md5("raw_json"),
            "created_at": run_time(as_of),
            "updated_at": run_time(as_of),
            "last_verified_at": run_time(as_of),
            "dt": F.lit(as_of),
        }
    ).drop("raw_json", "meta_keywords_text", "contact_email", "contact_phone", "contact_address", "contact_form", "live_chat", *[f"{s}_link" for s in SOCIAL])

