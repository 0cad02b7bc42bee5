"""GOLD products: wide company profiles, analytics, and published read models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.privacy import short_sha
from ..functions.scoring import (
    completeness,
    first_match,
    has_items,
    ladder,
    no_strings,
    upper_ladder,
    weighted_score,
)
from ..functions.text import bare_domain
from ..operators.aggregates import array_unions, count_where, element_counts
from ..operators.joins import probe_join
from ..operators.ordering import full_rank, keep_first, percent_rank
from ..session import cut_lineage
from .silver import SOCIAL, run_time

# Seniority buckets of the contact mix.
SENIORITY_MIX: dict[str, tuple[str, ...]] = {
    "c_level": ("c-level", "executive"),
    "vp_director": ("vp", "director"),
    "manager": ("manager",),
    "senior": ("senior",),
    "mid_level": ("mid", "mid-level"),
    "junior": ("junior",),
}
WEB_ARRAYS = (
    "content_categories", "topics", "keywords", "tech_hints", "programming_languages", "frameworks",
    "databases", "cloud_providers", "cms_platforms", "analytics_tools", "clients_mentions", "testimonials",
    "case_studies",
)
WEB_SCORES = ("content_richness_score", "readability_score", "technical_depth_score", "business_info_score")


def latest_per_key(df: DataFrame, key: str, tie_breaker: Sequence[str] = ()) -> DataFrame:
    """Newest ``dt`` per key, so a profile never multiplies over days."""
    order = [F.col("dt").desc(), *[F.col(t).asc() for t in tie_breaker]]
    return keep_first(df, [key], order)


def contact_aggregates(contacts: DataFrame) -> DataFrame:
    """Contact count, verification, mean quality and seniority mix per company."""
    level = F.col("seniority_level")
    return contacts.groupBy("company_key").agg(
        F.count(F.lit(1)).alias("apollo_contact_count"),
        F.coalesce(F.bool_or("is_verified"), F.lit(False)).alias("apollo_has_verified_contact"),
        F.avg("contact_quality_score").alias("apollo_contact_quality_score"),
        *[count_where(level.isin(*names)).alias(f"{b}_count") for b, names in SENIORITY_MIX.items()],
    )


def web_aggregates(pages: DataFrame, tie_breaker: str = "page_url") -> DataFrame:
    """Best page, mean scores and the union of all array columns per company.

    Best page and means share one aggregation with map-side combine; the arrays
    de-duplicate before they are collected.
    """
    own = pages.where(F.col("is_company_website"))
    best = F.struct(
        F.col("title").alias("web_title"),
        F.col("meta_description").alias("web_meta_description"),
        F.col("about_snippet").alias("web_about_snippet"),
        "social_links",
    )
    order = F.struct("content_richness_score", "crawl_ts", tie_breaker)
    facts = own.groupBy("company_key").agg(
        F.max_by(best, order).alias("_best"), *[F.avg(c).alias(f"avg_{c}") for c in WEB_SCORES]
    )
    arrays = array_unions(own, "company_key", WEB_ARRAYS)
    arrays = arrays.select("company_key", *[F.col(a).alias(f"all_{a}") for a in WEB_ARRAYS])
    joined = facts.select("company_key", "_best.*", *[f"avg_{c}" for c in WEB_SCORES]).join(arrays, "company_key", "left")
    return joined.withColumns({f"all_{a}": F.coalesce(f"all_{a}", no_strings()) for a in WEB_ARRAYS})


def web_elements(pages: DataFrame) -> DataFrame:
    """What a company's own pages list, one row per company, kind and element, with the number of times it occurs."""
    return element_counts(pages.where(F.col("is_company_website")), "company_key", WEB_ARRAYS)


def combine_sources(companies: DataFrame, health: DataFrame, contacts: DataFrame, web: DataFrame) -> DataFrame:
    """Companies with health, contact and web facts; every side has unique keys."""
    base = companies.where(F.col("is_primary_record")).drop("created_at", "updated_at", "last_verified_at", "dt", "source_systems")
    health_side = latest_per_key(health, "domain").select(
        F.col("domain").alias("_domain"),
        F.col("health_score").alias("domain_health_score"),
        F.col("overall_grade").alias("domain_grade"),
        "risk_level",
        "health_flags",
        "critical_issues",
    )
    mix = F.struct(*[F.coalesce(f"{b}_count", F.lit(0)).alias(b) for b in SENIORITY_MIX])
    joined = (
        base.join(health_side, F.col("domain") == F.col("_domain"), "left")
        .drop("_domain")
        .join(contacts, "company_key", "left")
        .join(web, "company_key", "left")
    )
    return joined.withColumns(
        {
            "domain_health_score": F.coalesce("domain_health_score", F.lit(0.5)),
            "domain_grade": F.coalesce("domain_grade", F.lit("C")),
            "risk_level": F.coalesce("risk_level", F.lit("medium")),
            "health_flags": F.coalesce("health_flags", no_strings()),
            "critical_issues": F.coalesce("critical_issues", no_strings()),
            "apollo_contact_count": F.coalesce("apollo_contact_count", F.lit(0)),
            "apollo_has_verified_contact": F.coalesce("apollo_has_verified_contact", F.lit(False)),
            "apollo_contact_quality_score": F.coalesce("apollo_contact_quality_score", F.lit(0.0)),
            "apollo_seniority_mix": mix,
        }
    ).drop(*[f"{b}_count" for b in SENIORITY_MIX])


# Stage by headcount, letter grades and confidence thresholds.
STAGE_BY_HEADCOUNT = [(10, "mvp"), (50, "growth"), (200, "scale")]
LETTERS = [(0.8, "A"), (0.6, "B"), (0.4, "C"), (0.2, "D")]
CONFIDENCE = [(0.8, "high"), (0.6, "medium")]


def startup_stage(founded_year: Column, employee_count: Column, as_of: str) -> Column:
    newest = F.year(F.lit(as_of).cast("date")) - 1
    unborn = founded_year.isNull() | (founded_year > newest)
    staffed = F.coalesce(employee_count, F.lit(0))
    return F.when(unborn, F.lit("idea")).otherwise(upper_ladder(staffed, STAGE_BY_HEADCOUNT, "mature"))


def profile_tags() -> Column:
    fields = ("industry", "sub_industry", "size_bracket", "startup_stage", "funding_stage", "country")
    return F.array_compact(F.array(*fields))


def gold_scores(df: DataFrame, as_of: str) -> DataFrame:
    """Derived scores in two stages: those on inputs, then those on scores."""
    social_weights = dict(zip(SOCIAL, (0.2, 0.15, 0.15, 0.1, 0.1, 0.2, 0.05, 0.05, 0.05), strict=True))
    tech_weights = {
        "all_tech_hints": 0.3, "all_programming_languages": 0.2, "all_frameworks": 0.2,
        "all_databases": 0.1, "all_cloud_providers": 0.1, "all_analytics_tools": 0.1,
    }
    funded = F.col("total_funding") > 0
    known = [
        "company_name", "domain", "country", "industry", "description", "founded_year", "employee_count",
        "linkedin_url", "website_url", "web_title",
    ]
    first = df.withColumns(
        {
            "social_media_score": weighted_score(
                [(F.col(f"social_links.{s}").isNotNull(), w) for s, w in social_weights.items()]
            ),
            "technology_score": weighted_score([(has_items(c), w) for c, w in tech_weights.items()]),
            "content_quality_grade": ladder("avg_content_richness_score", LETTERS, "F"),
            "business_credibility_score": weighted_score(
                [
                    (F.col("website_url").isNotNull(), 0.2),
                    (F.col("linkedin_url").isNotNull(), 0.2),
                    (F.length("description") > 100, 0.2),
                    (F.col("founded_year").isNotNull(), 0.1),
                    (F.col("employee_count").isNotNull(), 0.1),
                    (funded, 0.1),
                    (has_items("all_testimonials"), 0.1),
                ]
            ),
            "client_credibility_score": weighted_score(
                [
                    (has_items("all_clients_mentions"), 0.4),
                    (has_items("all_testimonials"), 0.3),
                    (has_items("all_case_studies"), 0.3),
                ]
            ),
            "overall_data_quality_score": F.round(
                F.col("data_quality_score") * 0.4
                + F.coalesce("domain_health_score", F.lit(0.5)) * 0.2
                + F.coalesce("apollo_contact_quality_score", F.lit(0.5)) * 0.2
                + F.coalesce("avg_content_richness_score", F.lit(0.5)) * 0.2,
                9,
            ),
            "data_completeness_score": completeness([F.col(c).isNotNull() for c in known]),
            "startup_stage": startup_stage(F.col("founded_year"), F.col("employee_count"), as_of),
        }
    )
    return first.withColumns(
        {
            "confidence_level": ladder("overall_data_quality_score", CONFIDENCE, "low"),
            "investment_readiness_score": weighted_score(
                [
                    (funded, 0.2),
                    (F.col("apollo_contact_count") > 0, 0.2),
                    (F.col("domain_health_score") >= 0.7, 0.2),
                    (F.col("business_credibility_score") >= 0.7, 0.2),
                    (F.col("client_credibility_score") >= 0.5, 0.2),
                ]
            ),
            "market_opportunity_score": weighted_score(
                [
                    (F.col("industry").isNotNull(), 0.3),
                    (has_items("all_content_categories"), 0.2),
                    (has_items("all_topics"), 0.2),
                    (F.col("social_media_score") >= 0.5, 0.1),
                    (F.col("technology_score") >= 0.5, 0.1),
                    (F.col("apollo_contact_count") > 5, 0.1),
                ]
            ),
            "profile_tags": profile_tags(),
        }
    )


def or_text(c: Column | str, default: str) -> Column:
    value = F.col(c) if isinstance(c, str) else c
    return F.coalesce(value.cast("string"), F.lit(default))


# The sections of the profile text (title, then label and column
# with its default); the text must read the same for equal embeddings.
PROFILE_SECTIONS: list[tuple[str, list[tuple[str, list[object]]]]] = [
    (
        "COMPANY PROFILE",
        [
            ("Company: ", [("company_name", "Unknown")]),
            ("Domain: ", [("domain", "Unknown")]),
            ("Industry: ", [("industry", "Unknown")]),
            ("Location: ", [("city", ""), ", ", ("country", "Unknown")]),
            ("Founded: ", [("founded_year", "Unknown")]),
            ("Size: ", [("employee_range", "Unknown"), " (", ("employee_count", "Unknown"), " employees)"]),
            ("Stage: ", [("startup_stage", "Unknown")]),
        ],
    ),
    ("DESCRIPTION", [("", [("description", "No description available")])]),
    (
        "WEBSITE CONTENT",
        [
            ("Title: ", [("web_title", "No title available")]),
            ("Meta Description: ", [("web_meta_description", "No meta description available")]),
            ("About: ", [("web_about_snippet", "No about information available")]),
        ],
    ),
    (
        "TECHNOLOGY STACK",
        [
            ("Technologies: ", [("all_tech_hints[]", "Unknown")]),
            ("Programming Languages: ", [("all_programming_languages[]", "Unknown")]),
            ("Frameworks: ", [("all_frameworks[]", "Unknown")]),
            ("Cloud Providers: ", [("all_cloud_providers[]", "Unknown")]),
        ],
    ),
    (
        "SOCIAL MEDIA",
        [
            ("LinkedIn: ", [("social_links.linkedin", "Not available")]),
            ("Twitter: ", [("social_links.twitter", "Not available")]),
            ("GitHub: ", [("social_links.github", "Not available")]),
        ],
    ),
    (
        "FUNDING INFORMATION",
        [
            ("Total Funding: $", [("total_funding", "Unknown")]),
            ("Last Funding: ", [("last_funding_date", "Unknown")]),
            ("Funding Stage: ", [("funding_stage", "Unknown")]),
        ],
    ),
    (
        "DOMAIN HEALTH",
        [
            ("Health Score: ", [("domain_health_score", "Unknown")]),
            ("Grade: ", [("domain_grade", "Unknown")]),
            ("Risk Level: ", [("risk_level", "Unknown")]),
        ],
    ),
    (
        "CONTACT INFORMATION",
        [
            ("Apollo Contacts: ", [("apollo_contact_count", "0")]),
            ("Verified Contacts: ", [("apollo_has_verified_contact", "false")]),
            ("Contact Quality: ", [("apollo_contact_quality_score", "Unknown")]),
        ],
    ),
    (
        "QUALITY METRICS",
        [
            ("Data Quality: ", [("overall_data_quality_score", "Unknown")]),
            ("Content Richness: ", [("avg_content_richness_score", "Unknown")]),
            ("Business Credibility: ", [("business_credibility_score", "Unknown")]),
            ("Confidence Level: ", [("confidence_level", "Unknown")]),
        ],
    ),
]
SCORE_FIELDS = (
    "domain_health_score", "apollo_contact_quality_score", "overall_data_quality_score",
    "avg_content_richness_score", "business_credibility_score",
)


def four_decimals(score: Column) -> Column:
    """Half rounds up, whatever the last bit of a mean is."""
    return (F.floor(score.cast("double") * 10000 + 0.500001) / 10000).cast("decimal(9,4)")


def profile_text() -> Column:
    """Multi-section profile for embeddings.

    Scores are printed with four decimals, so the text does not change with the
    order in which a mean was summed.
    """

    def render(part: object) -> Column:
        if isinstance(part, str):
            return F.lit(part)
        name, default = part
        if name.endswith("[]"):
            return or_text(F.array_join(F.col(name[:-2]), ", "), default)
        value = F.col(name)
        return or_text(four_decimals(value) if name in SCORE_FIELDS else value, default)

    pieces: list[Column] = []
    for number, (title, lines) in enumerate(PROFILE_SECTIONS):
        pieces.append(F.lit(("\n" if number else "") + f"{title}\n{'=' * len(title)}\n" + ("" if number else "\n")))
        for label, parts in lines:
            pieces += [F.lit(label), *[render(p) for p in parts], F.lit("\n")]
    return F.concat(*pieces)


def profile_summary() -> Column:
    """One sentence about the company; null without a name."""

    def part(cond: Column, *pieces: Column) -> Column:
        return F.coalesce(F.when(cond, F.concat(*pieces)), F.lit(""))

    year, country = F.col("founded_year"), F.col("country")
    staff, raised = F.col("employee_count"), F.col("total_funding")
    return F.concat(
        F.col("company_name"),
        F.lit(" is a "),
        or_text("industry", "technology"),
        F.lit(" company "),
        part(year.isNotNull(), F.lit("founded in "), year.cast("string")),
        part(country.isNotNull(), F.lit(" based in "), country),
        part(staff.isNotNull(), F.lit(" with "), staff.cast("string"), F.lit(" employees")),
        part(raised > 0, F.lit(" and has raised $"), raised.cast("string"), F.lit(" in funding")),
        F.lit("."),
    )


GOLD_RENAMES = {
    "all_content_categories": "web_content_categories",
    "all_topics": "web_topics",
    "all_keywords": "web_keywords",
    "all_tech_hints": "technology_stack",
    "social_links": "social_media_presence",
    "avg_content_richness_score": "content_richness_score",
    "avg_readability_score": "readability_score",
    "avg_technical_depth_score": "technical_depth_score",
    "avg_business_info_score": "business_info_score",
    **{f"all_{a}": a for a in WEB_ARRAYS if a not in ("content_categories", "topics", "keywords", "tech_hints")},
}
PLACEHOLDER_FLAGS = (
    "has_contact_info", "has_physical_address", "has_team_page", "has_careers_page", "has_pricing_page",
    "has_privacy_policy", "has_terms_of_service",
)
PLACEHOLDER_ARRAYS = (
    "growth_indicators", "innovation_indicators", "funding_readiness_indicators", "due_diligence_red_flags",
    "target_market", "competitive_landscape",
)
PLACEHOLDER_SCORES = {
    "data_accuracy_score": 0.8,
    "data_freshness_score": 1.0,
    "market_presence_score": 0.5,
    "competitive_advantage_score": 0.5,
}
GOLD_SOURCES = ("silver_companies", "silver_domain_health", "silver_apollo_contacts", "silver_web_extracts")


def gold_profiles(companies: DataFrame, health: DataFrame, contacts: DataFrame, pages: DataFrame, as_of: str) -> DataFrame:
    """One wide, scored profile per company."""
    combined = combine_sources(companies, health, contact_aggregates(contacts), web_aggregates(pages))
    scored = gold_scores(combined, as_of)
    texts = scored.withColumns(
        {
            "profile_text": profile_text(),
            "profile_summary": profile_summary(),
            "profile_text_hash": F.md5(
                F.concat("company_key", "domain", "company_name", "description", "web_title")
            ),
            "investment_readiness_grade": ladder("investment_readiness_score", LETTERS, "F"),
            "tagline": F.lit(None).cast("string"),
            "market_size_estimate": F.lit("medium"),
            **{c: F.lit(False) for c in PLACEHOLDER_FLAGS},
            **{c: no_strings() for c in PLACEHOLDER_ARRAYS},
            **{c: F.lit(v) for c, v in PLACEHOLDER_SCORES.items()},
            "source_systems": F.array(*[F.lit(s) for s in GOLD_SOURCES]),
            "last_updated_source": F.lit("gold_aggregation"),
            "profile_generation_method": F.lit("comprehensive_aggregation"),
            "created_at": run_time(as_of),
            "updated_at": run_time(as_of),
            "last_verified_at": run_time(as_of),
            "dt": F.lit(as_of),
        }
    )
    return texts.withColumnsRenamed(GOLD_RENAMES)


# --- second generation: keyed by id, fed by vendor payloads -----------------


def company_categories(df: DataFrame, as_of: str) -> DataFrame:
    """Size category, revenue stage and age in years."""
    staff, revenue, born = F.col("employee_count"), F.col("annual_revenue"), F.col("founded_year")
    return df.withColumns(
        {
            "company_size_category": F.when(staff.between(1, 10), "Startup")
            .when(staff.between(11, 50), "Small")
            .when(staff.between(51, 200), "Medium")
            .when(staff > 200, "Large")
            .otherwise("Unknown"),
            "revenue_stage": F.when(revenue < 1_000_000, "Early Stage")
            .when(revenue <= 10_000_000, "Growth Stage")
            .when(revenue > 10_000_000, "Mature")
            .otherwise("Unknown"),
            "company_age_years": F.year(F.lit(as_of).cast("date")) - born,
        }
    )


SENIOR_RANKS = ("C-Level", "VP", "Director")


def contact_rollup(contacts: DataFrame) -> DataFrame:
    """Contact totals and the distinct titles and departments per organization."""
    known = contacts.where(F.col("organization_id").isNotNull())
    # equal people first: one scan, and a hot organization shrinks before it meets
    kinds = known.groupBy("organization_id", "title", "department", "seniority").agg(F.count(F.lit(1)).alias("_n"))
    senior = F.when(F.col("seniority").isin(*SENIOR_RANKS), F.col("_n")).otherwise(F.lit(0))
    return kinds.groupBy("organization_id").agg(
        F.sum("_n").alias("total_contacts"),
        F.sum(senior).alias("senior_contacts"),
        F.sort_array(F.collect_set("title")).alias("contact_titles"),
        F.sort_array(F.collect_set("department")).alias("contact_departments"),
    )


def profile_text_compact() -> Column:
    parts = ("description", "keywords", "technologies", "extracted_content")
    return F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in parts])


def startup_profiles(
    companies: DataFrame, extracts: DataFrame, vendor: DataFrame, contacts: DataFrame, health: DataFrame, as_of: str
) -> DataFrame:
    """One profile per company id.

    Every lookup is reduced to one row per key before its join: the newest
    crawl, vendor record and health check, and the contact totals.
    """

    def newest(df: DataFrame, key: str, at: str, *more: str) -> DataFrame:
        order = [F.col(at).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in more]]
        return keep_first(df.where(F.col(key).isNotNull()), [key], order)

    known = companies.where(F.col("id").isNotNull() & F.col("name").isNotNull())
    recency = [c for c in ("updated_at", "created_at") if c in known.columns]
    base = keep_first(known, ["id"], [*[F.col(c).desc_nulls_last() for c in recency], F.col("name").asc(), F.col("website_url").asc_nulls_last()])
    extracts = newest(extracts, "company_id", "crawled_at", "content_hash")
    vendor = newest(vendor, "id", "apollo_updated_at", "apollo_id")
    health = newest(health, "domain", "last_health_check", "domain_health_score")
    web = extracts.select(
        F.col("company_id").alias("id"),
        "pages_crawled",
        F.col("crawled_at").alias("last_web_crawl"),
        F.col("content_hash").alias("web_content_hash"),
        "extracted_content",
    )
    ids = vendor.select("id", "apollo_id", "apollo_url", "apollo_created_at", "apollo_updated_at")
    sites = health.select(
        F.col("domain").alias("website_url"), "domain_health_score", "ssl_valid", "dns_resolution", "last_health_check"
    )
    rollup = contact_rollup(contacts).withColumnRenamed("organization_id", "id")
    placed = probe_join(base, sites, "website_url")  # many companies may lack a site
    joined = placed.join(web, "id", "left").join(ids, "id", "left").join(rollup, "id", "left")
    stamp = F.lit(as_of).cast("date")
    return (
        company_categories(joined, as_of)
        .withColumns(
            {
                "profile_text": profile_text_compact(),
                "profile_created_at": run_time(as_of),
                "profile_updated_at": run_time(as_of),
                "year": F.year(stamp),
                "month": F.month(stamp),
                "day": F.day(stamp),
            }
        )
        .withColumnsRenamed({"id": "company_id", "name": "company_name", "description": "company_description"})
    )


def safe_ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.coalesce(part, F.lit(0)).cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


ANALYTICS_INPUTS = (
    "company_id", "company_name", "industry", "company_size_category", "revenue_stage", "company_age_years", "domain_health_score",
    "total_contacts", "senior_contacts", "pages_crawled", "employee_count", "annual_revenue", "web_content_hash", "technologies",
)


def company_analytics(profiles: DataFrame) -> DataFrame:
    """Industry ranks, health percentile, contact ratios and keyword flags.

    The used columns are stored once; both rankings and the percentile work
    on narrow selections of them and join back by company.
    """
    base = cut_lineage(profiles.where(F.col("company_id").isNotNull()).select(*ANALYTICS_INPUTS))

    def ranked(by: str, out: str) -> DataFrame:
        order = [F.col(by).desc_nulls_last(), F.col("company_id").asc()]
        return full_rank(base, "company_id", order, out, partition_by=["industry"], using=[by], stored=True)

    tech = F.coalesce("technologies", F.lit(""))

    def mentions(*words: str) -> Column:
        hit = tech.contains(words[0])
        for w in words[1:]:
            hit = hit | tech.contains(w)
        return hit.cast("int")

    with_ranks = (
        base.join(
            percent_rank(base.select("company_id", "domain_health_score"), "domain_health_score", "health_score_percentile").drop("domain_health_score"),
            "company_id",
        )
        .join(ranked("annual_revenue", "industry_revenue_rank"), "company_id")
        .join(ranked("employee_count", "industry_employee_rank"), "company_id")
    )
    return with_ranks.withColumns(
        {
            "contact_density": safe_ratio(F.col("total_contacts"), F.col("employee_count")),
            "senior_contact_ratio": safe_ratio(F.col("senior_contacts"), F.col("total_contacts")),
            "has_web_presence": F.coalesce(F.col("pages_crawled") > 0, F.lit(False)).cast("int"),
            "has_extracted_content": F.col("web_content_hash").isNotNull().cast("int"),
            "is_ai_company": mentions("AI", "Machine Learning"),
            "is_cloud_company": mentions("Cloud", "AWS", "Azure"),
        }
    )


# --- CSV start-ups, enrichment, browse queries ------------------------------

# Headcount ranges with a known midpoint.
HEADCOUNT_MIDPOINTS = {"101-250": 175, "501-1000": 750, "5001-10000": 7500}


def clean_startups(raw: DataFrame, as_of: str) -> DataFrame:
    """Vendor CSV rows: blanks for missing text, parsed numbers, categories."""

    def text(column: str) -> Column:
        return F.coalesce(F.trim(F.col(column).cast("string")), F.lit(""))

    midpoint = F.create_map(*[x for k, v in HEADCOUNT_MIDPOINTS.items() for x in (F.lit(k), F.lit(v))])
    cleaned = raw.select(
        "company_id",
        text("company_name").alias("company_name"),
        text("website_url").alias("website_url"),
        text("linkedin_url").alias("linkedin_url"),
        text("industries").alias("industry"),
        text("description").alias("description"),
        text("headquarters_location").alias("headquarters_location"),
        F.substring(text("founded_date"), 1, 4).try_cast("int").alias("founded_year"),
        F.try_element_at(midpoint, text("employee_count")).alias("employee_count"),
        text("total_funding_usd").try_cast("double").alias("total_funding_usd"),
        text("funding_status").alias("funding_status"),
    )
    staff, funds = F.col("employee_count"), F.col("total_funding_usd")
    return cleaned.withColumns(
        {
            "company_size_category": F.when(staff > 200, "Large").when(staff > 50, "Medium").when(staff > 10, "Small").otherwise("Startup"),
            "revenue_stage": F.when(funds > 10_000_000, "Mature").when(funds > 1_000_000, "Growth Stage").otherwise("Early Stage"),
            "company_age_years": F.year(F.lit(as_of).cast("date")) - F.col("founded_year"),
        }
    )


# Vendor CSV headers and the columns they become.
CSV_HEADERS = {
    "Organization Name": "company_name",
    "Website": "website_url",
    "LinkedIn": "linkedin_url",
    "Headquarters Location": "headquarters_location",
    "Industries": "industries",
    "Description": "description",
    "Founded Date": "founded_date",
    "Number of Employees": "employee_count",
    "Total Funding Amount (in USD)": "total_funding_usd",
    "Last Funding Date": "last_funding_date",
    "Funding Status": "funding_status",
    "country": "country",
}


def rename_vendor_columns(df: DataFrame) -> DataFrame:
    """Vendor headers to column names; a missing value becomes ''."""
    return df.select(
        *[F.coalesce(F.col(f"`{h}`").cast("string"), F.lit("")).alias(c) for h, c in CSV_HEADERS.items()]
    )


def enrich_by_domain(companies: DataFrame, vendor: DataFrame, crawl: DataFrame) -> DataFrame:
    """Left enrichment by bare domain; absent facts become empty values.

    Both lookups hold one row per domain, so the join never multiplies rows.
    """
    keyed = companies.withColumn("domain", bare_domain("website_url"))
    facts = vendor.join(crawl, "domain", "full")
    return (
        probe_join(keyed, facts, "domain")
        .withColumns(
            {
                "apollo_company_id": F.coalesce("apollo_company_id", F.lit("")),
                "technologies": F.coalesce("technologies", no_strings()),
                "enrichment_sources": F.array_compact(
                    F.array(
                        F.when(F.coalesce("apollo_company_id", F.lit("")) != "", F.lit("apollo")),
                        F.when(F.coalesce("web_content", F.lit("")) != "", F.lit("firecrawl")),
                    )
                ),
                "web_content": F.coalesce("web_content", F.lit("")),
            }
        )
    )


def publish_defaults(df: DataFrame) -> DataFrame:
    """Nulls become 0 or '' and money an exact decimal, as the store needs."""
    return df.na.fill({"founded_year": 0, "employee_count": 0, "company_age_years": 0}).withColumn(
        "total_funding_usd", F.coalesce(F.col("total_funding_usd").cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))
    )


def search_companies(df: DataFrame, text: str, columns: Sequence[str] = ("company_name", "industry")) -> DataFrame:
    """Case-insensitive substring search over the given columns."""
    needle = text.lower()
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.lower(c).contains(needle), F.lit(False))
    return df.where(hit)


def lookup_company(df: DataFrame, key: str, column: str = "company_key") -> DataFrame:
    return df.where(F.col(column) == F.lit(key))


def top_funding(df: DataFrame, n: int = 3) -> DataFrame:
    return df.orderBy(F.col("total_funding_usd").desc_nulls_last(), F.col("company_name").asc()).limit(n)


def browse(df: DataFrame, size: str | None = None, industry_like: str | None = None) -> DataFrame:
    """Profiles by funding, optionally of one size category or industry text."""
    out = df
    if size is not None:
        out = out.where(F.col("company_size_category") == size)
    if industry_like is not None:
        out = out.where(F.col("industry").contains(industry_like))
    return out.orderBy(F.col("total_funding_usd").desc_nulls_last(), F.col("company_name").asc())


def summary_report(df: DataFrame) -> DataFrame:
    """Dataset figures and value counts by size and stage, as labelled rows."""
    totals = df.agg(
        F.count(F.lit(1)).cast("double").alias("companies"),
        F.countDistinct("industry").cast("double").alias("industries"),
        F.avg("company_age_years").alias("mean_age"),
        F.avg("employee_count").alias("mean_employees"),
        F.sum(F.coalesce("total_funding_usd", F.lit(0.0))).alias("total_funding"),
    )
    stats = totals.unpivot([], list(totals.columns), "item", "value").select(
        F.lit("total").alias("section"), "item", "value"
    )
    by = [
        df.groupBy(F.col(c).alias("item"))
        .agg(F.count(F.lit(1)).cast("double").alias("value"))
        .select(F.lit(c).alias("section"), "item", "value")
        for c in ("company_size_category", "revenue_stage")
    ]
    return stats.unionByName(by[0]).unionByName(by[1])


def enrichment_stats(df: DataFrame) -> DataFrame:
    """Totals by enrichment source and the latest update."""
    return df.agg(
        F.count(F.lit(1)).alias("total_companies"),
        F.count_if(F.array_contains("enrichment_sources", "apollo")).alias("apollo_enriched"),
        F.count_if(F.array_contains("enrichment_sources", "firecrawl")).alias("firecrawl_enriched"),
        F.max("updated_at").alias("last_updated"),
    )


# What a full run reads and the stages it has.
RUN_SOURCES = ("CSV", "Apollo API", "Firecrawl API")
RUN_STAGES = ("Bronze", "Silver", "Gold", "API Enrichment", "Embeddings", "DynamoDB")
RUN_SERVICES = ("apollo", "firecrawl", "bedrock")


def run_summary(
    df: DataFrame, embeddings: DataFrame, at: str, enabled: Sequence[str] = RUN_SERVICES, sources: Sequence[str] = RUN_SOURCES, stages: Sequence[str] = RUN_STAGES, order_key: str = "company_id"
) -> DataFrame:
    """One JSON record of the run (totals, time, sources, stages, which services were on) and one per processed company.

    ``embeddings`` are the vectors the run made.  The head is one row; the company
    list stays a distributed column of JSON texts instead of one array, so it can
    be written without a driver.
    """
    fields = ("company_name", "industry", "company_size_category", "revenue_stage", "enrichment_sources")
    companies = df.select(
        F.lit("company").alias("kind"), F.col(order_key).alias("item"), F.to_json(F.struct(order_key, *fields)).alias("body")
    )
    status = F.struct(*[F.lit(s in enabled).alias(f"{s}_enabled") for s in RUN_SERVICES])
    names = lambda given: F.array(*[F.lit(g) for g in given])
    head = df.agg(F.count(F.lit(1)).alias("total_startups_processed")).select(
        "total_startups_processed", embeddings.agg(F.count(F.lit(1)).alias("n")).scalar().alias("embeddings_generated"), F.lit(at).alias("execution_time"),
        names(sources).alias("data_sources"), names(stages).alias("processing_stages"), status.alias("api_status"),
    )
    return head.select(F.lit("run").alias("kind"), F.lit("").alias("item"), F.to_json(F.struct("*")).alias("body")).unionByName(companies)


# --- read models ------------------------------------------------------------

READ_MODEL = {
    "company_key": "company_key",
    "company_name": "name",
    "domain": "domain",
    "country": "country",
    "industry": "industry",
    "size_bracket": "size_bracket",
    "profile_tags": "tags",
    "domain_health_score": "domain_health_score",
    "apollo_contact_count": "contact_count",
    "apollo_has_verified_contact": "has_verified_contact",
    "apollo_seniority_mix": "seniority_mix",
    "web_title": "title",
    "web_meta_description": "meta_description",
    "web_about_snippet": "about_snippet",
    "updated_at": "updated_at",
}


def read_model_public(profiles: DataFrame, as_of: str) -> DataFrame:
    """Public fields with a one-year expiry (epoch seconds)."""
    expiry = F.unix_seconds((F.lit(as_of).cast("date") + F.expr("INTERVAL 365 DAYS")).cast("timestamp"))
    return profiles.select(
        *[F.col(c).alias(n) for c, n in READ_MODEL.items()],
        F.lit("1.0").alias("schema_version"),
        expiry.alias("ttl"),
    )


def read_model_private(profiles: DataFrame, as_of: str) -> DataFrame:
    """Public fields with long texts and the seniority mix hashed."""
    public = read_model_public(profiles, as_of)
    mix = F.struct(
        *[short_sha(F.col(f"seniority_mix.{b}").cast("string")).alias(b) for b in SENIORITY_MIX]
    )

    def hashed(c: str) -> Column:
        return F.when(F.col(c) != "", short_sha(c)).otherwise(F.col(c))

    return public.withColumns(
        {
            "seniority_mix": F.when(F.col("seniority_mix").isNotNull(), mix),
            "meta_description": hashed("meta_description"),
            "about_snippet": hashed("about_snippet"),
        }
    )


def as_documents(df: DataFrame, key: str) -> DataFrame:
    """Key and JSON body; null fields are left out of the body."""
    return df.select(key, F.to_json(F.struct("*")).alias("item"))


def success_label(revenue_over: int = 1_000_000, staff_over: int = 10, health_over: float = 80.0) -> Column:
    """1 when any of three alternatives holds; health is on a 0–100 scale."""
    rules = first_match(
        [
            ((F.col("annual_revenue") > revenue_over) & (F.col("employee_count") > staff_over), F.lit(1)),
            ((F.col("domain_health_score") * 100 > health_over) & (F.col("pages_crawled") > 0), F.lit(1)),
            ((F.col("total_contacts") > 5) & (F.col("senior_contacts") > 2), F.lit(1)),
        ],
        F.lit(0),
    )
    return rules
