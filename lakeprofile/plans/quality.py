"""Row-level quality checks, their summary and the list of issues.

Each ``check_*`` keeps the columns its issue description needs, so the summary
and the issue list are built from the check frames alone.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.privacy import masking_state
from ..functions.scoring import first_match, holds, ladder, present, verdict
from ..functions.text import is_domain, is_email, is_phone, is_url

# Quality levels.
LEVELS = [(0.8, "HIGH"), (0.6, "MEDIUM"), (0.4, "LOW")]


def filled(c: str) -> Column:
    return holds(present(c))


def presence_checks(*columns: str) -> dict[str, Column]:
    return {f"{c}_check": verdict(filled(c), "PASS", "FAIL") for c in columns}


def quality_level(c: str) -> Column:
    return ladder(c, LEVELS, "VERY_LOW")


def domain_check() -> Column:
    return verdict(is_domain("domain"), "PASS", "FAIL")


def within(c: str, low: float, high: float) -> Column:
    """VALID unless the value is present and outside the range."""
    value = F.col(c)
    return verdict(holds((value < low) | (value > high)), "INVALID", "VALID")


def url_check(c: str) -> Column:
    return verdict(is_url(c), "VALID", "INVALID")


def md5_state(c: str) -> Column:
    return (
        F.when(F.length(c) == 32, F.lit("VALID"))
        .when(F.col(c).isNotNull(), F.lit("INVALID_LENGTH"))
        .otherwise(F.lit("NO_HASH"))
    )


def text_state(main: str, second: str) -> Column:
    return F.when(filled(main), "COMPLETE").when(filled(second), "PARTIAL").otherwise("INCOMPLETE")


def known_label(c: str, labels: tuple[str, ...]) -> Column:
    value = F.col(c)
    return F.when(value.isNull(), "NO_DATA").when(value.isin(*labels), "VALID").otherwise("INVALID")


def score_state(c: str, steps: list[tuple[float, str]], default: str) -> Column:
    value = F.col(c)
    graded = ladder(c, steps, default)
    return F.when(value.isNull(), "NO_DATA").when((value < 0) | (value > 1), "INVALID").otherwise(graded)


def overall(*must: Column) -> Column:
    ok = must[0]
    for cond in must[1:]:
        ok = ok & cond
    return verdict(ok, "PASS", "FAIL")


def check_companies(df: DataFrame, as_of: str) -> DataFrame:
    this_year = int(as_of[:4])
    given = [F.col(c).isNotNull() for c in ("country", "industry", "description")]
    return df.select(
        "company_key",
        "domain",
        "company_name",
        *[c.alias(n) for n, c in presence_checks("company_key", "domain", "company_name").items()],
        domain_check().alias("domain_format_check"),
        F.when(given[0] & given[1] & given[2], "COMPLETE")
        .when(given[0] | given[1] | given[2], "PARTIAL")
        .otherwise("INCOMPLETE")
        .alias("data_completeness"),
        quality_level("data_quality_score").alias("quality_level"),
        verdict(holds(F.col("is_primary_record")), "PRIMARY", "DUPLICATE").alias("record_type"),
        url_check("linkedin_url").alias("linkedin_url_check"),
        url_check("website_url").alias("website_url_check"),
        within("founded_year", 1800, this_year).alias("founded_year_check"),
        within("employee_count", 0, 1_000_000).alias("employee_count_check"),
        within("total_funding", 0, 1_000_000_000_000).alias("total_funding_check"),
        overall(filled("company_key"), filled("domain"), filled("company_name"), is_domain("domain")).alias(
            "overall_validation_status"
        ),
    )


def check_contacts(df: DataFrame) -> DataFrame:
    """A masked phone has at most six digits, so its format is always INVALID."""
    return df.select(
        "apollo_id",
        "contact_key",
        "company_key",
        "first_name_masked",
        "last_name_masked",
        *[c.alias(n) for n, c in presence_checks("apollo_id", "contact_key", "company_key").items()],
        *[
            masking_state(f"{c}_masked").alias(f"{c}_masking_check")
            for c in ("first_name", "last_name", "email")
        ],
        verdict(is_email("email_masked"), "VALID", "INVALID").alias("email_format_check"),
        verdict(is_phone("phone_masked"), "VALID", "INVALID").alias("phone_format_check"),
        url_check("linkedin_url").alias("linkedin_url_check"),
        text_state("title", "department").alias("professional_info_check"),
        quality_level("data_quality_score").alias("quality_level"),
        overall(filled("apollo_id"), filled("contact_key"), filled("company_key")).alias("overall_validation_status"),
    )


def check_health(df: DataFrame) -> DataFrame:
    issues = F.size("critical_issues")
    score = F.col("health_score")
    return df.select(
        "domain",
        "company_key",
        "health_score",
        *[c.alias(n) for n, c in presence_checks("domain", "company_key").items()],
        domain_check().alias("domain_format_check"),
        score_state("health_score", [(0.8, "EXCELLENT"), (0.6, "GOOD"), (0.4, "FAIR")], "POOR").alias(
            "health_score_validation"
        ),
        known_label("overall_grade", ("A+", "A", "B", "C", "D", "F")).alias("grade_validation"),
        known_label("risk_level", ("low", "medium", "high", "critical")).alias("risk_level_validation"),
        F.when(issues == 0, "CLEAN").when(issues <= 2, "MINOR_ISSUES").otherwise("MAJOR_ISSUES").alias(
            "critical_issues_validation"
        ),
        overall(filled("domain"), filled("company_key"), is_domain("domain"), holds(score.between(0, 1))).alias(
            "overall_validation_status"
        ),
    )


def check_web(df: DataFrame) -> DataFrame:
    return df.select(
        "company_key",
        "domain",
        "page_url",
        *[c.alias(n) for n, c in presence_checks("company_key", "domain", "page_url").items()],
        verdict(is_url("page_url"), "PASS", "FAIL").alias("page_url_format_check"),
        domain_check().alias("domain_format_check"),
        text_state("title", "meta_description").alias("content_completeness"),
        quality_level("content_richness_score").alias("content_quality_level"),
        md5_state("content_hash").alias("content_hash_validation"),
        overall(
            filled("company_key"), filled("domain"), filled("page_url"), is_url("page_url"), is_domain("domain")
        ).alias("overall_validation_status"),
    )


def check_profiles(df: DataFrame) -> DataFrame:
    size = F.length("profile_text")
    return df.select(
        "company_key",
        "domain",
        "company_name",
        F.col("profile_text").isNull().alias("no_profile_text"),
        F.col("profile_text_hash").isNull().alias("no_profile_text_hash"),
        *[c.alias(n) for n, c in presence_checks("company_key", "domain", "company_name").items()],
        domain_check().alias("domain_format_check"),
        F.when(size > 500, "COMPLETE")
        .when(size > 100, "PARTIAL")
        .when(size.isNotNull(), "INCOMPLETE")
        .otherwise("NO_DATA")
        .alias("profile_text_completeness"),
        md5_state("profile_text_hash").alias("profile_text_hash_validation"),
        quality_level("overall_data_quality_score").alias("quality_level"),
        verdict(holds(F.col("confidence_level").isin("high", "medium", "low")), "VALID", "INVALID").alias(
            "confidence_level_validation"
        ),
        score_state(
            "investment_readiness_score", [(0.8, "READY"), (0.6, "NEARLY_READY"), (0.4, "NEEDS_WORK")], "NOT_READY"
        ).alias("investment_readiness_validation"),
        overall(
            filled("company_key"),
            filled("domain"),
            filled("company_name"),
            is_domain("domain"),
            F.col("profile_text").isNotNull(),
            F.col("profile_text_hash").isNotNull(),
        ).alias("overall_validation_status"),
    )


def union_all(parts: list[DataFrame]) -> DataFrame:
    out, *rest = parts
    for p in rest:
        out = out.unionByName(p)
    return out


def quality_summary(checks: Mapping[str, DataFrame]) -> DataFrame:
    """Pass and fail totals and the pass percentage per table."""
    status = union_all(
        [df.select(F.lit(t).alias("table_name"), F.col("overall_validation_status").alias("s")) for t, df in checks.items()]
    )
    passed = F.count_if(F.col("s") == "PASS")
    return status.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("total_records"),
        passed.alias("valid_records"),
        F.count_if(F.col("s") == "FAIL").alias("invalid_records"),
        F.round(passed * 100.0 / F.count(F.lit(1)), 2).alias("validation_percentage"),
    )


# Per table: the three shown columns and, in order, what may be wrong.
Rule = tuple[str, Column]


def missing(c: str) -> Rule:
    return (f"Missing {c}", ~filled(c))


def bad_domain() -> Rule:
    return ("Invalid domain format", ~is_domain("domain"))


def issue_rules() -> dict[str, tuple[list[Column], list[Rule]]]:
    score = F.col("health_score")
    return {
        "silver_companies": (
            [F.col("company_key"), F.col("domain"), F.col("company_name")],
            [missing("company_key"), missing("domain"), missing("company_name"), bad_domain()],
        ),
        "silver_apollo_contacts": (
            [F.col("contact_key"), F.col("company_key"), F.concat("first_name_masked", F.lit(" "), "last_name_masked")],
            [missing("apollo_id"), missing("contact_key"), missing("company_key")],
        ),
        "silver_domain_health": (
            [F.col("domain"), F.col("company_key"), F.col("domain")],
            [
                missing("domain"),
                missing("company_key"),
                bad_domain(),
                ("Missing health_score", score.isNull()),
                ("Invalid health_score", ~score.between(0, 1)),
            ],
        ),
        "silver_web_extracts": (
            [F.col("company_key"), F.col("domain"), F.col("page_url")],
            [
                missing("company_key"),
                missing("domain"),
                missing("page_url"),
                ("Invalid page_url format", ~is_url("page_url")),
                bad_domain(),
            ],
        ),
        "gold_startup_profiles": (
            [F.col("company_key"), F.col("domain"), F.col("company_name")],
            [
                missing("company_key"),
                missing("domain"),
                missing("company_name"),
                bad_domain(),
                ("Missing profile_text", F.col("no_profile_text")),
                ("Missing profile_text_hash", F.col("no_profile_text_hash")),
            ],
        ),
    }


def quality_issues(checks: Mapping[str, DataFrame]) -> DataFrame:
    """Failed rows of all tables with the first problem that applies."""
    rules = issue_rules()
    parts = []
    for table, df in checks.items():
        (key, domain, label), problems = rules[table]
        reason = first_match([(cond, F.lit(text)) for text, cond in problems], F.lit("Other validation issue"))
        failed = df.where(F.col("overall_validation_status") == "FAIL")
        parts.append(
            failed.select(
                F.lit(table).alias("table_name"),
                key.alias("company_key"),
                domain.alias("domain"),
                label.alias("company_name"),
                "overall_validation_status",
                reason.alias("issue_description"),
            )
        )
    return union_all(parts)
