"""Edge rules of the column functions on tiny frames."""

import pytest
from conftest import one
from pyspark.sql import functions as F

from lakeprofile.functions import privacy, scoring, text, vectors
from lakeprofile.functions.json_fields import json_scalar, json_strings
from lakeprofile.plans import crawl, gold, ledger, silver


def value(spark, c, **columns):
    rows = spark.range(1).select(*[F.lit(v).alias(k) if not isinstance(v, F.Column) else v.alias(k) for k, v in columns.items()])
    return rows.select(c.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("name", "masked"), [("Anna", "A***"), ("J", "J*"), ("", None), (None, None), ("Al", "A*")]
)
def test_mask_name(spark, name, masked):
    assert value(spark, privacy.mask_name("n"), n=F.lit(name).cast("string")) == masked


@pytest.mark.parametrize(
    ("mail", "masked"),
    [("ann@x.com", "a**@x.com"), ("a@x.com", "a*@x.com"), ("no-at", None), ("", None), (None, None), ("@x.com", "*@x.com")],
)
def test_mask_email(spark, mail, masked):
    assert value(spark, privacy.mask_email("m"), m=F.lit(mail).cast("string")) == masked


@pytest.mark.parametrize(("phone", "masked"), [("12345678", "123**678"), ("12345", "123*345"), ("", None)])
def test_mask_phone(spark, phone, masked):
    assert value(spark, privacy.mask_phone("p"), p=phone) == masked


def test_score_on_threshold_is_exact(spark):
    """Ten weights of 0.1 and 0.2 that add up to 0.8 reach the 0.8 step."""
    true = F.lit(True)
    score = scoring.weighted_score([(true, 0.2), (true, 0.2), (true, 0.1), (true, 0.1), (true, 0.1), (true, 0.1), (~true, 0.2)])
    assert value(spark, score) == 0.8
    assert value(spark, scoring.ladder(score, [(0.8, "high")], "low")) == "high"


def test_null_conditions_do_not_count(spark):
    null = F.lit(None).cast("boolean")
    assert value(spark, scoring.weighted_score([(null, 0.5), (F.lit(True), 0.25)])) == 0.25
    assert value(spark, scoring.completeness([null, F.lit(True)])) == 0.5


def test_flags(spark):
    cases = [(F.lit(False), "a"), (F.lit(True), "b"), (F.lit(True), "c")]
    assert value(spark, scoring.first_flag(cases)) == ["b"]
    assert value(spark, scoring.every_flag(cases)) == ["b", "c"]
    assert value(spark, scoring.first_flag(cases[:1])) == []


@pytest.mark.parametrize(
    ("mail", "ok"),
    [("a@b.c", True), ("a..b@c.d", False), (".a@b.c", False), ("a@b.c.", False), ("", False), (None, False), ("x" * 250 + "@b.com", False)],
)
def test_validate_email(spark, mail, ok):
    text.register_validators(spark)
    rows = spark.range(1).select(F.lit(mail).cast("string").alias("m"))
    assert rows.select(text.is_email("m")).first()[0] is ok
    assert rows.selectExpr("validate_email(m)").first()[0] is ok


@pytest.mark.parametrize(("phone", "ok"), [("+1 (555) 123-4567", True), ("123456789", False), ("1" * 16, False), (None, False)])
def test_validate_phone(spark, phone, ok):
    assert value(spark, text.is_phone("p"), p=F.lit(phone).cast("string")) is ok


@pytest.mark.parametrize(("url", "ok"), [("http://a", True), ("ftp://a", False), ("https://" + "a" * 2048, False)])
def test_validate_url(spark, url, ok):
    assert value(spark, text.is_url("u"), u=url) is ok


def test_keywords_are_substrings_unless_asked(spark):
    phrase = "We serve retail industry"
    assert value(spark, text.keyword_lookup("t", text.INDUSTRY_KEYWORDS), t=phrase) == "technology"  # ret-ai-l
    assert value(spark, text.keyword_lookup("t", text.INDUSTRY_KEYWORDS, whole_word=True), t=phrase) == "ecommerce"
    assert value(spark, text.keyword_lookup("t", text.COUNTRY_KEYWORDS), t=phrase) == "united states"  # ind-us-try
    assert value(spark, text.keyword_lookup("t", text.COUNTRY_KEYWORDS, whole_word=True), t=phrase) == ""


def test_name_guess(spark):
    assert value(spark, text.name_guess("t"), t="the Big Al Corp Of Northern Lights") == "big corp northern"
    assert value(spark, text.name_guess("t"), t="nothing here") == ""


def test_word_counts(spark):
    assert value(spark, text.word_count("t"), t="one, two  3 three") == 3
    assert value(spark, text.word_count("t"), t="") == 1
    assert value(spark, text.word_count("t"), t=F.lit(None).cast("string")) == 0
    assert value(spark, text.token_count("t"), t="  a b\n c ") == 3


def test_hosts(spark):
    assert value(spark, text.host_of("u"), u="https://www.x.com/a") == "www.x.com"
    assert value(spark, text.host_of("u", strip_www=True), u="https://www.x.com/a") == "x.com"
    assert value(spark, text.bare_domain("u"), u="https://www.x.com") == "x.com"


def test_cosine_edge_cases(spark):
    a = F.array(F.lit(1.0), F.lit(0.0))
    zero = F.array(F.lit(0.0), F.lit(0.0))
    none = F.lit(None).cast("array<double>")
    assert value(spark, vectors.cosine(a, a)) == 1.0
    assert value(spark, vectors.cosine(a, zero)) == 0.0
    assert value(spark, vectors.cosine(a, none)) == 0.0
    assert value(spark, vectors.clamp01(F.lit(1.7))) == 1.0


def test_json_scalar_rejects_objects(spark):
    raw = '{"a": {"b": 1}, "c": [1, 2], "d": "x", "e": ["p", "q"]}'
    assert value(spark, json_scalar("r", "$.a"), r=raw) is None
    assert value(spark, json_scalar("r", "$.c"), r=raw) is None
    assert value(spark, json_scalar("r", "$.d"), r=raw) == "x"
    assert value(spark, json_strings("r", "$.e"), r=raw) == ["p", "q"]


def test_malformed_vendor_json_gives_no_row(spark):
    raw = spark.createDataFrame([("{broken",), ('{"id":"1","name":"N","domain":" A.com "}',), ('{"id":"2"}',)], "raw_json string")
    rows = silver.silver_vendor_companies(raw, "2024-01-31").select("apollo_id", "company_key", "is_valid_domain").collect()
    assert [tuple(r) for r in rows] == [("1", "a.com", True)]


def test_clear_personal_data_is_dropped(spark):
    raw = spark.createDataFrame([('{"id":"1","first_name":"Ann","email":"ann@x.com","phone":"5551234567"}',)], "raw_json string")
    contacts = silver.silver_contacts(raw, "2024-01-31")
    assert not {"first_name", "last_name", "full_name", "email", "phone", "raw_json"} & set(contacts.columns)
    assert one(contacts.select("email_masked", "phone_masked")) == {"email_masked": "a**@x.com", "phone_masked": "555****567"}


def test_page_types(spark):
    def kind(url, title):
        return value(spark, silver.page_type("u", "t", "h"), u=url, t=F.lit(title).cast("string"), h="x.com")

    assert kind("https://x.com/about-us", None) == "about"
    assert kind("https://x.com/p", "Our TEAM") == "team"
    assert kind("https://x.com/", None) == "homepage"
    assert kind("https://x.com/p", None) == "other"


@pytest.mark.parametrize(("words", "score"), [(50, 0.4), (101, 0.6), (501, 0.8), (1001, 1.0), (5000, 0.8), (10000, 0.6)])
def test_readability_steps(spark, words, score):
    assert value(spark, silver.readability("w"), w=words) == score


def test_startup_stage_and_sizes(spark):
    def stage(year, staff):
        return value(spark, gold.startup_stage(F.col("y"), F.col("s"), "2024-01-31"), y=F.lit(year).cast("int"), s=F.lit(staff).cast("int"))

    assert [stage(None, 5), stage(2024, 5), stage(2023, None), stage(2000, 50), stage(2000, 200), stage(2000, 201)] == [
        "idea", "idea", "mvp", "growth", "scale", "mature",
    ]
    assert value(spark, silver.size_bracket("n"), n=F.lit(None).cast("int")) == "unknown"
    assert value(spark, silver.size_bracket("n"), n=1001) == "enterprise"


def test_safe_ratio(spark):
    assert value(spark, gold.safe_ratio(F.lit(3), F.lit(0))) == 0.0
    assert value(spark, gold.safe_ratio(F.lit(1), F.lit(2))) == 0.5


def test_token_prices(spark):
    """1000 tokens in and 200 out on the small and the large model."""
    small = value(spark, ledger.call_cost(F.lit("haiku"), F.lit(1000.0), F.lit(200.0)))
    large = value(spark, ledger.call_cost(F.lit("claude-3-sonnet"), F.lit(1000.0), F.lit(200.0)))
    assert small == pytest.approx(0.0005)
    assert large == pytest.approx(0.006)


def test_alert_reports_highest_level(spark):
    levels = [value(spark, ledger.alert_level(F.lit(u))) for u in (0.5, 0.8, 0.95, 1.2)]
    assert levels == [None, "0.8", "0.9", "1.0"]


def test_answers(spark):
    assert value(spark, ledger.parse_answer(F.lit('{"a":1}'))) == '{"a":1}'
    assert value(spark, ledger.parse_answer(F.lit("plain"))) == '{"raw_response":"plain"}'
    assert value(spark, ledger.parse_insights(F.lit('["x","y"]'))) == ["x", "y"]
    assert value(spark, ledger.parse_insights(F.lit("plain"))) == ["plain"]


def test_crawl_without_content_scores_zero(spark):
    raw = spark.createDataFrame([('{"domain":"x.com","success":false}',), ('{"domain":"y.com","success":true}',)], "raw_json string")
    rows = crawl.normalize_crawls(raw).select("domain", "content_richness_score", "title", "error").collect()
    assert [tuple(r) for r in rows] == [("x.com", 0.0, None, ""), ("y.com", 0.0, None, "")]


def test_api_companies_keep_raw(spark):
    raw = spark.createDataFrame([('{"id":"1","name":"N","employee_count":5}',)], "raw_json string")
    row = one(crawl.normalize_api_companies(raw).select("id", "name", "employee_count", "keywords", "raw_data"))
    assert row["keywords"] == [] and row["employee_count"] == 5 and row["raw_data"].startswith('{"id"')


def test_private_read_model_hashes_long_texts(spark):
    import hashlib

    profile = spark.createDataFrame(
        [("k", "N", "d", "c", "i", "small", ["t"], 0.5, 3, True, (1, 0, 0, 0, 0, 0), "T", "M", None, None)],
        "company_key string, company_name string, domain string, country string, industry string, size_bracket string, profile_tags array<string>, "
        "domain_health_score double, apollo_contact_count long, apollo_has_verified_contact boolean, "
        "apollo_seniority_mix struct<c_level:int,vp_director:int,manager:int,senior:int,mid_level:int,junior:int>, "
        "web_title string, web_meta_description string, web_about_snippet string, updated_at timestamp",
    )
    row = one(gold.read_model_private(profile, "2024-01-31"))
    assert row["meta_description"] == hashlib.sha256(b"M").hexdigest()[:16]
    assert row["seniority_mix"]["c_level"] == hashlib.sha256(b"1").hexdigest()[:16]
    assert row["about_snippet"] is None
    body = one(gold.as_documents(gold.read_model_public(profile, "2024-01-31"), "company_key"))["item"]
    assert '"about_snippet"' not in body and '"title":"T"' in body
