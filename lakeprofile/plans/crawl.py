"""Records of the vendor API and the crawler, normalised row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json_fields import text_schema
from ..operators.incremental import newest_stored

CRAWL_SCHEMA = (
    "domain string, timestamp string, success boolean, content_hash string, pages_crawled int, total_links int, "
    "response_time_ms int, error string, error_type string, "
    "data struct<data: struct<markdown: string, html: string, links: array<string>, images: array<string>, "
    "metadata: struct<title: string, description: string, language: string, canonicalUrl: string>, "
    "pages: array<struct<markdown: string, html: string, links: array<string>>>>>"
)
META_FIELDS = ("title", "description", "language", "canonicalUrl")


def crawl_richness(data: str = "data.data") -> Column:
    """Length, links, images and metadata share of one crawl in [0, 1]."""

    def size_of(field: str) -> Column:
        return F.coalesce(F.size(f"{data}.{field}"), F.lit(0))

    length = F.coalesce(F.length(f"{data}.markdown"), F.lit(0))
    filled = sum(
        (F.when(F.col(f"{data}.metadata.{m}") != "", 1).otherwise(0) for m in META_FIELDS), start=F.lit(0)
    )
    score = (
        F.least(length / F.lit(5000.0), F.lit(1.0)) * 0.4
        + F.least(size_of("links") / F.lit(50.0), F.lit(1.0)) * 0.2
        + F.least(size_of("images") / F.lit(10.0), F.lit(1.0)) * 0.1
        + filled / F.lit(4.0) * 0.3
    )
    return F.when(F.col("success") & F.col(data).isNotNull(), score).otherwise(F.lit(0.0))


def page_links(pages: Column) -> Column:
    """Links over all pages of a crawl."""
    return F.coalesce(
        F.aggregate(pages, F.lit(0), lambda n, p: n + F.coalesce(F.size(p["links"]), F.lit(0))), F.lit(0)
    )


def crawl_digest(pages: Column) -> Column:
    """SHA-256 of all pages' markdown and html, joined in page order; whole, as changes are decided by it."""
    texts = F.transform(
        F.coalesce(pages, F.array()),
        lambda p: F.concat(F.coalesce(p["markdown"], F.lit("")), F.coalesce(p["html"], F.lit(""))),
    )
    return F.sha2(F.array_join(texts, ""), 256)


def crawl_content_hash(pages: Column) -> Column:
    """The published short form: the first 16 digits of the digest."""
    return F.substring(crawl_digest(pages), 1, 16)


def normalize_crawls(raw: DataFrame) -> DataFrame:
    """Crawl JSON to flat columns with defaults; content only when it succeeded."""
    rows = raw.select("raw_json", F.from_json("raw_json", CRAWL_SCHEMA).alias("_j")).select("raw_json", "_j.*")
    ok = F.col("success") & F.col("data.data").isNotNull()

    def text(field: str) -> Column:
        return F.when(ok, F.coalesce(F.col(f"data.data.{field}"), F.lit("")))

    empty = F.array().cast("array<string>")
    return rows.select(
        "domain",
        "timestamp",
        F.coalesce("success", F.lit(False)).alias("success"),
        F.coalesce("content_hash", crawl_content_hash(F.col("data.data.pages"))).alias("content_hash"),
        crawl_digest(F.col("data.data.pages")).alias("content_digest"),
        F.coalesce("pages_crawled", F.lit(0)).alias("pages_crawled"),
        F.coalesce("total_links", page_links(F.col("data.data.pages"))).alias("total_links"),
        F.coalesce("response_time_ms", F.lit(0)).alias("response_time_ms"),
        F.coalesce("error", F.lit("")).alias("error"),
        F.coalesce("error_type", F.lit("")).alias("error_type"),
        crawl_richness().alias("content_richness_score"),
        text("metadata.title").alias("title"),
        text("metadata.description").alias("description"),
        text("metadata.language").alias("language"),
        text("metadata.canonicalUrl").alias("canonical_url"),
        text("markdown").alias("main_content"),
        text("html").alias("html_content"),
        F.when(ok, F.coalesce("data.data.links", empty)).alias("links"),
        F.when(ok, F.coalesce("data.data.images", empty)).alias("images"),
        F.col("raw_json").alias("raw_data"),
    )


def crawl_candidates(health: DataFrame, hashes: DataFrame, key: str, at: str, minimum: float = 70.0) -> DataFrame:
    """Healthy domains never crawled before or whose content has drifted.

    ``hashes`` holds the stored and the present whole digest of each check; the last one of a key counts.
    """
    healthy = health.where(F.col("health_score") * 100 >= minimum)
    joined = healthy.join(newest_stored(hashes, key, ["prev_hash", "content_hash"], at), key, "left")
    drifted = ~F.col("content_hash").eqNullSafe(F.col("prev_hash"))
    return joined.where(F.col("prev_hash").isNull() | drifted)


CONTACT_SCHEMA = (
    "id string, first_name string, last_name string, email string, title string, "
    "organization struct<id: string, name: string>, linkedin_url string, twitter_url string, "
    "phone_numbers array<string>, city string, state string, country string, updated_at string"
)


def normalize_api_contacts(raw: DataFrame) -> DataFrame:
    """Contact API records: organization flattened, raw JSON kept."""
    rows = raw.select("raw_json", F.from_json("raw_json", CONTACT_SCHEMA).alias("_j")).select("raw_json", "_j.*")
    return rows.select(
        "id", "first_name", "last_name", "email", "title",
        F.col("organization.id").alias("company_id"),
        F.col("organization.name").alias("company_name"),
        "linkedin_url", "twitter_url",
        F.coalesce("phone_numbers", F.array().cast("array<string>")).alias("phone_numbers"),
        "city", "state", "country", "updated_at",
        F.col("raw_json").alias("raw_data"),
    )


# Fields of a company record of the API.
COMPANY_TEXTS = (
    "id", "name", "website_url", "industry", "founded_year", "employee_count", "annual_revenue", "total_funding",
    "last_funding_round", "last_funding_date", "linkedin_url", "twitter_url", "facebook_url", "description", "phone",
    "address", "city", "state", "country", "postal_code", "updated_at",
)
COMPANY_NUMBERS = {"founded_year": "int", "employee_count": "int", "annual_revenue": "bigint", "total_funding": "double"}


def normalize_api_companies(raw: DataFrame) -> DataFrame:
    """Company API records with the raw JSON kept; dirty numbers become null."""
    parsed = F.from_json("raw_json", text_schema(COMPANY_TEXTS, ["keywords"])).alias("_j")
    rows = raw.select("raw_json", parsed)
    numbers = {c: F.col(f"_j.{c}").try_cast(t) for c, t in COMPANY_NUMBERS.items()}
    return rows.select(
        *[numbers.get(c, F.col(f"_j.{c}")).alias(c) for c in COMPANY_TEXTS],
        F.coalesce("_j.keywords", F.array().cast("array<string>")).alias("keywords"),
        F.col("raw_json").alias("raw_data"),
    )
