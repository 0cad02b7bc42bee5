"""Second-generation SILVER tables: JSON payloads keyed by id, dated folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json_fields import text_schema
from ..operators.joins import probe_join
from ..operators.ordering import keep_first

# Payload fields and their types; fields not listed are text.
COMPANY_PAYLOAD = (
    "id", "name", "website_url", "linkedin_url", "industry", "employee_count", "annual_revenue", "founded_year",
    "headquarters_address", "headquarters_city", "headquarters_state", "headquarters_country",
    "headquarters_postal_code", "phone", "description", "keywords", "technologies", "social_media_links",
    "created_at", "updated_at",
)
VENDOR_PAYLOAD = (*COMPANY_PAYLOAD, "apollo_id", "apollo_url", "apollo_created_at", "apollo_updated_at")
CONTACT_PAYLOAD = (
    "id", "first_name", "last_name", "full_name", "email", "phone", "title", "department", "seniority",
    "linkedin_url", "twitter_url", "facebook_url", "github_url", "apollo_id", "apollo_url", "apollo_created_at",
    "apollo_updated_at", "organization_id", "organization_name", "organization_website_url",
    "organization_linkedin_url", "organization_industry", "organization_employee_count",
    "organization_annual_revenue", "organization_founded_year", "organization_headquarters_address",
    "organization_headquarters_city", "organization_headquarters_state", "organization_headquarters_country",
    "organization_headquarters_postal_code", "created_at", "updated_at",
)
PAYLOAD_TYPES = {
    "employee_count": "int", "organization_employee_count": "int",
    "annual_revenue": "bigint", "organization_annual_revenue": "bigint",
    "founded_year": "int", "organization_founded_year": "int",
    "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz",
    "apollo_created_at": "timestamp_ntz", "apollo_updated_at": "timestamp_ntz",
}


def date_parts(ts: Column | str) -> dict[str, Column]:
    return {"year": F.year(ts), "month": F.month(ts), "day": F.day(ts)}


def day_partition(df: DataFrame, as_of: str) -> DataFrame:
    """Rows of one dated folder; the literals prune partitions."""
    year, month, day = (int(p) for p in as_of.split("-"))
    return df.where((F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day))


def payload_table(raw: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Typed columns of the ``data`` payload plus year, month, day of creation."""
    parsed = raw.select(F.inline(F.array(F.from_json("data", text_schema(fields)))))  # one parse, see silver.extract
    typed = parsed.select(
        *[F.col(f).try_cast(PAYLOAD_TYPES[f]).alias(f) if f in PAYLOAD_TYPES else F.col(f) for f in fields]
    )
    return typed.where(F.col("id").isNotNull()).withColumns(date_parts("created_at"))


CRAWL_COLUMNS = (
    "name", "website_url", "industry", "employee_count", "annual_revenue", "founded_year", "headquarters_city",
    "headquarters_state", "headquarters_country", "description", "technologies", "keywords",
)


def web_extracts(raw: DataFrame, companies: DataFrame) -> DataFrame:
    """Crawl payloads joined to their company; nested parts stay JSON text."""

    def at(path: str) -> Column:
        return F.get_json_object("data", path)

    crawls = raw.select(
        at("$.metadata.company_id").alias("company_id"),
        at("$.metadata.domain").alias("domain"),
        at("$.metadata.pages_crawled").try_cast("int").alias("pages_crawled"),
        at("$.metadata.crawled_at").try_cast("timestamp_ntz").alias("crawled_at"),
        at("$.metadata.content_hash").alias("content_hash"),
        at("$.extracted_data.pages").alias("pages_data"),
        at("$.extracted_data.extracted_content").alias("extracted_content"),
        at("$.extracted_data.crawl_metadata").alias("crawl_metadata"),
    ).where(F.col("company_id").isNotNull() & F.col("domain").isNotNull())
    recency = [F.col(c).desc_nulls_last() for c in ("updated_at", "created_at") if c in companies.columns]
    newest = keep_first(companies.where(F.col("id").isNotNull()), ["id"], [*recency, F.col("name").asc_nulls_last()])  # one row per company
    firm = newest.select(F.col("id").alias("company_id"), *CRAWL_COLUMNS)
    return (
        probe_join(crawls, firm, "company_id", "inner")
        .withColumnsRenamed({"name": "company_name", "description": "company_description"})
        .withColumns({"last_crawled": F.col("crawled_at"), **date_parts("crawled_at")})
        .drop("domain")
    )
