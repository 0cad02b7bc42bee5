"""Candidate selection and challenge matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import COUNTRY_KEYWORDS, INDUSTRY_KEYWORDS
from ..operators.matching import candidate_prefilter, match_topk
from .core import cte, num, query, stamp
from .row_queries import keyword_sql, name_sql


@query(
    "candidate_prefilter",
    f"""SELECT 'filtered' AS kind, company_key, industry, country, {stamp('updated_at')} FROM b_candidates WHERE industry = 'finance' AND country = 'canada'
       UNION ALL SELECT 'newest', company_key, industry, country, {stamp('updated_at')} FROM (SELECT * FROM b_candidates ORDER BY b_candidates.updated_at DESC, company_key LIMIT 50) AS newest""",
)
def prefilter(inp):
    rows = inp["b_candidates"]
    filtered = candidate_prefilter(rows, {"industry": "finance", "country": "canada"})
    newest = candidate_prefilter(rows, {"industry": None, "country": None}, limit=50)
    shown = ["kind", "company_key", "industry", "country", "updated_at"]
    return filtered.withColumn("kind", F.lit("filtered")).select(*shown).unionByName(newest.withColumn("kind", F.lit("newest")).select(*shown))


cte(
    "o_asked",
    f"SELECT challenge_id, vector, {keyword_sql('text', INDUSTRY_KEYWORDS)} AS q_industry, {keyword_sql('text', COUNTRY_KEYWORDS)} AS q_country, {name_sql('text')} AS q_name FROM b_challenges",
)
cte(
    "o_pairs",
    """SELECT challenge_id, company_key, company_name, industry, country, q_name, list_cosine_similarity(vector::DOUBLE[], embedding_vector::DOUBLE[]) AS sim,
       CASE WHEN q_industry <> '' AND contains(industry, q_industry) THEN 1.0::DOUBLE ELSE 0 END AS ind, CASE WHEN q_country <> '' AND contains(country, q_country) THEN 1.0::DOUBLE ELSE 0 END AS geo FROM o_asked, b_candidates""",
)
cte("o_final", "SELECT *, 0.7 * sim + 0.3 * ml AS final_score FROM (SELECT *, 1 / (1 + exp(-(0.5 * sim + 0.3 * ind + 0.2 * geo))) AS ml FROM o_pairs)")
cte(
    "o_named",
    """SELECT *, CASE WHEN q_name = '' THEN 0 ELSE len(list_intersect(string_split(q_name, ' '), string_split(lower(company_name), ' ')))::DOUBLE / len(list_distinct(list_concat(string_split(q_name, ' '), string_split(lower(company_name), ' ')))) END AS name_similarity
       FROM (SELECT *, row_number() OVER (PARTITION BY challenge_id ORDER BY final_score DESC, company_key) AS rank FROM o_final) WHERE rank <= 20""",
)
REASON_SQL = """coalesce(nullif(concat_ws('; ', CASE WHEN sim > 0.8 THEN 'Very high content similarity' WHEN sim > 0.6 THEN 'High content similarity' WHEN sim > 0.4 THEN 'Moderate content similarity' END,
       CASE WHEN ind > 0 THEN 'Industry match' END, CASE WHEN geo > 0 THEN 'Geographic match' END, CASE WHEN name_similarity > 0.5 THEN 'Company name similarity' END,
       CASE WHEN ml > 0.7 THEN 'Strong ML prediction' WHEN ml > 0.5 THEN 'Moderate ML prediction' END), ''), 'General similarity')"""


@query(
    "match_topk",
    f"""SELECT challenge_id, company_key, company_name, industry, country, CAST(rank AS INTEGER) AS rank, {num('sim AS embedding_similarity', 'ind AS industry_match', 'geo AS geo_match', 'ml AS ml_score', 'final_score', 'name_similarity')}, {REASON_SQL} AS reason FROM o_named""",
)
def match(inp):
    return match_topk(inp["b_challenges"], inp["b_candidates"])
