"""Company, contact, page and event inputs as SQL over the given tables.

The texts are common to Spark SQL and DuckDB; ``{name}`` stands for a table or
another binding.  The given tables hold no nulls, so the bindings inject nulls,
blanks, mixed case, dirty numbers and duplicates.  Every binding keeps all rows
of its table.
"""

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)

BINDINGS: dict[str, str] = {
    # company source, priority 1
    "b_src_a": """
SELECT concat('  D', cast(s_suppkey % 60 AS STRING), '.Example.com ') AS domain,
       concat(' ', s_name, ' ') AS company_name, concat('NATION_', cast(s_nationkey AS STRING)) AS country,
       CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 'technology' END AS industry,
       CASE WHEN s_acctbal < 0 THEN NULL ELSE cast(s_acctbal AS DECIMAL(15,2)) END AS total_funding,
       concat('https://cb.example.com/', cast(s_suppkey AS STRING)) AS crunchbase_url,
       'crunchbase' AS source_system, 1 AS source_priority, s_suppkey AS source_id,
       cast('2024-01-01 00:00:00' AS TIMESTAMP) + s_suppkey * INTERVAL '1' HOUR AS created_at
FROM {supplier}""",
    # company source, priority 2
    "b_src_b": """
SELECT CASE WHEN c_custkey % 29 = 0 THEN '' ELSE concat('d', cast(c_custkey % 90 AS STRING), '.example.com') END AS domain,
       CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE c_name END AS company_name,
       concat('NATION_', cast(c_nationkey AS STRING)) AS country, lower(c_mktsegment) AS industry,
       CASE WHEN c_custkey % 5 = 0 THEN NULL
            WHEN c_custkey % 3 = 0 THEN concat('About ', c_name, ', a company with a description that is long enough to count towards the credibility of its profile, thanks to this clause')
            ELSE concat('About ', c_name) END AS description,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE cast(1990 + c_custkey % 40 AS INT) END AS founded_year,
       CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE cast(c_custkey % 1500 AS INT) END AS employee_count,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE concat('https://linkedin.com/company/', cast(c_custkey % 45 AS STRING)) END AS linkedin_url,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE concat('https://d', cast(c_custkey % 90 AS STRING), '.example.com') END AS website_url,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE cast(c_acctbal * 1000 AS DECIMAL(15,2)) END AS total_funding,
       'apollo' AS source_system, 2 AS source_priority, c_custkey AS source_id,
       cast('2024-01-02 00:00:00' AS TIMESTAMP) + c_custkey * INTERVAL '1' MINUTE AS created_at
FROM {customer}""",
    # vendor company records, all fields as the text a JSON record carries
    "b_vendor": """
SELECT CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE concat('org-', cast(c_custkey AS STRING)) END AS id,
       concat('https://vendor.example.com/', cast(c_custkey AS STRING)) AS url,
       cast(c_custkey % 500 AS STRING) AS organization_id,
       CASE WHEN c_custkey % 31 = 0 THEN NULL WHEN c_custkey % 37 = 0 THEN '' ELSE concat(' ', c_name, ' ') END AS name,
       CASE WHEN c_custkey % 29 = 0 THEN '' ELSE concat(' D', cast(c_custkey % 90 AS STRING), '.Example.com') END AS domain,
       CASE c_custkey % 3 WHEN 0 THEN concat('https://d', cast(c_custkey % 90 AS STRING), '.example.com') WHEN 1 THEN 'www.example.com' ELSE 'ftp://example.com' END AS website,
       concat('NATION_', cast(c_nationkey AS STRING)) AS country,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE concat(' State ', cast(c_nationkey AS STRING)) END AS state,
       CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE concat('City ', cast(c_custkey % 50 AS STRING)) END AS city,
       CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE concat(cast(c_custkey AS STRING), ' Main St') END AS address_line1,
       CASE WHEN c_custkey % 10 = 0 THEN 'n/a' ELSE concat(cast(c_custkey % 90 AS STRING), '.25') END AS latitude,
       concat('-', cast(c_custkey % 180 AS STRING), '.5') AS longitude,
       CASE WHEN c_custkey % 13 = 0 THEN '' ELSE lower(c_mktsegment) END AS industry,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE concat('About ', c_name) END AS description,
       CASE WHEN c_custkey % 7 = 0 THEN 'unknown' ELSE cast(1990 + c_custkey % 40 AS STRING) END AS founded_year,
       CASE WHEN c_custkey % 11 = 0 THEN '2015-13-45' ELSE concat('2015-0', cast(1 + c_custkey % 9 AS STRING), '-15') END AS founded_date,
       CASE WHEN c_custkey % 17 = 0 THEN '12x' ELSE cast(c_custkey % 1500 AS STRING) END AS employee_count,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE cast(cast(c_acctbal * 1000 AS DECIMAL(15,2)) AS STRING) END AS total_funding,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE concat('https://linkedin.com/company/', cast(c_custkey % 45 AS STRING)) END AS linkedin_url,
       CASE WHEN c_custkey % 6 = 0 THEN '12345' ELSE concat('+55 11 ', lpad(cast(c_custkey AS STRING), 9, '0')) END AS organization_phone,
       CASE WHEN c_custkey % 9 = 0 THEN 'no-at-sign' ELSE concat('info', cast(c_custkey AS STRING), '@example.com') END AS organization_email,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE split('python,spark', ',') END AS technology_stack,
       split(concat('tag', cast(c_custkey % 4 AS STRING), ',', lower(c_mktsegment)), ',') AS industry_tags
FROM {customer}""",
    # people with personal data
    "b_contacts": """
SELECT cast(c_custkey AS STRING) AS id,
       CASE WHEN c_custkey % 38 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 13 = 0 THEN 'J' ELSE concat('First', cast(c_custkey AS STRING)) END AS first_name,
       CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE concat('Last', cast(c_custkey AS STRING)) END AS last_name,
       CASE WHEN c_custkey % 4 = 1 THEN concat('First', cast(c_custkey AS STRING), ' Last', cast(c_custkey AS STRING)) ELSE NULL END AS full_name,
       CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 23 = 0 THEN 'no-at-sign'
            ELSE concat('user', cast(c_custkey AS STRING), '@d', cast(c_custkey % 90 AS STRING), '.example.com') END AS email,
       CASE WHEN c_custkey % 6 = 0 THEN '12345' ELSE concat('+55 11 ', lpad(cast(c_custkey AS STRING), 9, '0')) END AS phone,
       CASE c_custkey % 11 WHEN 0 THEN 'CEO' WHEN 1 THEN 'Chief Technology Officer' WHEN 2 THEN 'CFO' WHEN 3 THEN 'CMO'
            WHEN 4 THEN 'COO' WHEN 5 THEN 'Vice President Sales' WHEN 6 THEN 'Director' WHEN 7 THEN 'Product Manager'
            WHEN 8 THEN 'Senior Engineer' WHEN 9 THEN 'Jr Analyst' ELSE ' Advisor ' END AS title,
       CASE c_custkey % 8 WHEN 0 THEN 'c-level' WHEN 1 THEN 'executive' WHEN 2 THEN 'vp' WHEN 3 THEN 'director'
            WHEN 4 THEN 'manager' WHEN 5 THEN 'senior' WHEN 6 THEN 'mid' ELSE 'junior' END AS seniority_level,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE lower(c_mktsegment) END AS department,
       concat('D', cast(c_custkey % 90 AS STRING), '.example.com') AS organization_domain,
       CASE WHEN c_custkey % 12 = 0 THEN NULL ELSE concat('Company ', cast(c_custkey % 90 AS STRING)) END AS organization_name,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE concat('https://linkedin.com/in/', cast(c_custkey AS STRING)) END AS linkedin_url,
       CASE WHEN c_custkey % 14 = 0 THEN 'many' ELSE cast(c_custkey % 30 AS STRING) END AS years_experience,
       split('sql,python', ',') AS skills,
       c_custkey % 10 = 0 AS is_verified
FROM {customer}""",
    # crawled pages, flat
    "b_web": """
SELECT page_id, url AS page_url, lower(regexp_extract(url, 'https?://([^/?#]+)', 1)) AS domain,
       concat('d', cast(page_id % 60 AS STRING), '.example.com') AS company_key,
       regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, html AS full_content,
       length(html) AS content_length,
       cast('2024-01-01 00:00:00' AS TIMESTAMP) + page_id * INTERVAL '1' HOUR AS crawl_ts
FROM {pages}""",
    # the fields of a crawl record that the pages do not carry are derived
    "b_page_record": """
SELECT page_id,
       CASE WHEN page_id % 40 = 0 THEN '' ELSE concat('https://d', cast(page_id % 60 AS STRING), '.example.com', regexp_extract(url, 'https?://[^/]+(.*)', 1)) END AS url,
       CASE WHEN page_id % 10 = 0 THEN NULL ELSE concat(' ', regexp_extract(html, '<title>([^<]*)</title>', 1), ' ') END AS title,
       CASE WHEN page_id % 4 = 0 THEN NULL ELSE concat('Description ', cast(page_id AS STRING)) END AS meta_description,
       CASE WHEN page_id % 6 = 0 THEN NULL ELSE 'alpha, beta  gamma,delta' END AS meta_keywords,
       CASE WHEN page_id % 45 = 0 THEN NULL ELSE html END AS content,
       CASE WHEN page_id % 30 = 0 THEN 'not a time' ELSE concat('2024-01-', lpad(cast(1 + page_id % 28 AS STRING), 2, '0'), ' 08:30:00') END AS crawl_timestamp,
       CASE WHEN page_id % 3 = 0 THEN NULL ELSE concat(' https://linkedin.com/company/', cast(page_id AS STRING)) END AS linkedin,
       CASE WHEN page_id % 5 = 0 THEN concat('https://github.com/', cast(page_id AS STRING)) ELSE NULL END AS github,
       CASE WHEN page_id % 7 = 0 THEN NULL ELSE concat('info@', lower(regexp_extract(url, 'https?://([^/?#]+)', 1))) END AS email,
       CASE WHEN page_id % 2 = 0 THEN 'true' ELSE 'false' END AS contact_form,
       CASE WHEN page_id % 3 = 1 THEN split(concat('spark,tool', cast(page_id % 7 AS STRING)), ',') ELSE NULL END AS tech_hints,
       CASE WHEN page_id % 4 = 1 THEN split('python,scala', ',') ELSE NULL END AS programming_languages,
       CASE WHEN page_id % 5 = 1 THEN split(concat('client', cast(page_id % 9 AS STRING)), ',') ELSE NULL END AS clients_mentions,
       CASE WHEN page_id % 6 = 1 THEN split('great', ',') ELSE NULL END AS testimonials,
       split('home,about', ',') AS navigation_items,
       CASE WHEN page_id % 2 = 1 THEN split(concat('topic', cast(page_id % 11 AS STRING), ',news'), ',') ELSE NULL END AS topics,
       CASE WHEN page_id % 8 = 1 THEN split('b2b', ',') ELSE NULL END AS content_categories,
       CASE WHEN page_id % 9 = 1 THEN split('seed', ',') ELSE NULL END AS funding_hints,
       CASE WHEN page_id % 20 = 0 THEN NULL ELSE concat('job-', cast(page_id AS STRING)) END AS firecrawl_job_id,
       'markdown' AS extraction_method
FROM {pages}""",
    # domain probe results and scores
    "b_probes": """
SELECT page_id, lower(regexp_extract(url, 'https?://([^/?#]+)', 1)) AS domain,
       CASE WHEN page_id % 33 = 0 THEN '' ELSE concat('d', cast(page_id % 60 AS STRING), '.example.com') END AS company_key,
       CASE page_id % 4 WHEN 0 THEN 'finance' WHEN 1 THEN 'technology' WHEN 2 THEN 'healthcare' ELSE NULL END AS industry,
       CASE WHEN page_id % 7 = 0 THEN 'failed' ELSE 'resolved' END AS dns_status,
       CASE WHEN page_id % 5 = 0 THEN 'failed' ELSE 'success' END AS http_status,
       CASE WHEN url LIKE 'https%' THEN 'success' ELSE 'failed' END AS https_status,
       url LIKE 'https%' AS is_https_enabled,
       CASE WHEN url LIKE 'https%' AND page_id % 11 <> 0 THEN 'valid' ELSE 'failed' END AS tls_status,
       CASE WHEN length(html) > 2000 THEN 'success' ELSE 'failed' END AS content_status,
       CASE WHEN page_id % 13 = 0 THEN 0 ELSE length(html) END AS content_size_bytes,
       CASE WHEN page_id % 47 = 0 THEN NULL ELSE cast((page_id * 37) % 101 AS DOUBLE) / 100 END AS health_score,
       cast((page_id * 53) % 101 AS DOUBLE) / 100 AS seo_score,
       cast((page_id * 71) % 101 AS DOUBLE) / 100 AS security_score, cast((page_id * 89) % 101 AS DOUBLE) / 100 AS accessibility_score,
       cast(500 + (page_id * 97) % 3000 AS INT) AS page_load_time_ms,
       CASE page_id % 6 WHEN 0 THEN 'A+' WHEN 1 THEN 'A' WHEN 2 THEN 'B' WHEN 3 THEN 'C' WHEN 4 THEN 'D' ELSE 'F' END AS ssl_grade,
       page_id % 50 = 0 AS is_malware_detected, page_id % 60 = 0 AS is_phishing_detected,
       page_id % 4 <> 0 AS has_meta_description, page_id % 3 <> 0 AS has_contact_page,
       CASE WHEN page_id % 9 = 0 THEN NULL ELSE cast(page_id % 4000 AS INT) END AS domain_age_days,
       cast(page_id % 100 AS INT) AS domain_authority_score, cast(NULL AS INT) AS backlink_count
FROM {pages}""",
    # challenge -> company scores over 30 days
    "b_shortlists": """
SELECT event_id, cast(user_id AS STRING) AS challenge_id,
       CASE WHEN event_id % 101 = 0 THEN '' ELSE concat('d', cast(event_id % 60 AS STRING), '.example.com') END AS company_key,
       CASE WHEN event_id % 97 = 0 THEN NULL ELSE least(value / 200, 1.0) END AS final_score,
       cast(event_id % 100 AS DOUBLE) / 100 AS embedding_similarity, cast(event_id % 37 AS DOUBLE) / 37 AS ml_score,
       cast(event_id % 2 AS DOUBLE) AS industry_match, cast(event_id % 3 AS DOUBLE) / 2 AS geo_match,
       cast(event_id % 5 AS DOUBLE) / 4 AS name_similarity,
       event_type, ts AS created_at, substr(cast(ts AS STRING), 1, 10) AS dt
FROM {events}""",
    # vectors with industry and country
    "b_candidates": """
SELECT cast(vec_id AS STRING) AS company_key, concat('Company ', cast(vec_id AS STRING)) AS company_name,
       CASE label WHEN 0 THEN 'technology' WHEN 1 THEN 'healthcare' WHEN 2 THEN 'finance' WHEN 3 THEN 'ecommerce' WHEN 4 THEN 'education'
            WHEN 5 THEN 'energy' WHEN 6 THEN 'transportation' WHEN 7 THEN 'real_estate' ELSE 'other' END AS industry,
       CASE vec_id % 5 WHEN 0 THEN 'united states' WHEN 1 THEN 'canada' WHEN 2 THEN 'germany' WHEN 3 THEN 'india' ELSE 'japan' END AS country,
       embedding AS embedding_vector,
       cast('2024-01-01 00:00:00' AS TIMESTAMP) + vec_id * INTERVAL '1' HOUR AS updated_at
FROM {embeddings}""",
    # challenge texts with the vector of the same number
    "b_challenges": """
SELECT cast(b.item_id AS STRING) AS challenge_id, b.text AS text, e.embedding AS vector
FROM {benchmark} b JOIN {embeddings} e ON b.item_id = e.vec_id""",
    # model calls for the ledger, cache and budget
    "b_llm_calls": """
SELECT conv_id, turn, cast(conv_id AS STRING) AS company_key, conv_id * 1000 + turn AS seq,
       CASE turn % 6 WHEN 0 THEN 'executive_summary' WHEN 1 THEN 'key_insights' WHEN 2 THEN 'tech_analysis'
            WHEN 3 THEN 'competitive_analysis' WHEN 4 THEN 'risk_assessment' ELSE 'business_intelligence' END AS task_type,
       CASE WHEN turn % 6 < 3 THEN 'haiku' ELSE 'sonnet' END AS model,
       length(text) - length(replace(text, ' ', '')) + 1 AS input_tokens, md5(text) AS content_hash, text AS result,
       conv_id % 4 = 0 AS was_cached, (conv_id + turn) % 15 <> 0 AS success,
       cast('2024-01-15 00:00:00' AS TIMESTAMP) + (conv_id * 8 + turn) * INTERVAL '20' MINUTE AS created_at
FROM {conversations}""",
    # five tables with daily partitions; the rows of two days moved to the day before
    "b_partitions": """
SELECT CASE event_type WHEN 'signup' THEN 'silver_companies' WHEN 'purchase' THEN 'silver_apollo_contacts' WHEN 'view' THEN 'silver_domain_health'
            WHEN 'click' THEN 'silver_web_extracts' ELSE 'gold_startup_profiles' END AS table_name,
       CASE WHEN day(ts) = 7 THEN '2024-01-06' WHEN day(ts) = 19 THEN '2024-01-18' ELSE substr(cast(ts AS STRING), 1, 10) END AS dt,
       cast(user_id AS STRING) AS company_key,
       concat('d', cast(event_id % 60 AS STRING), '.example.com') AS domain, ts AS created_at
FROM {events}""",
    # vendor call log
    "b_api_calls": """
SELECT event_id AS call_id, ts AS called_at, CASE WHEN event_id % 2 = 0 THEN 'companies' ELSE 'contacts' END AS endpoint FROM {events}""",
    # flat crawl results
    "b_crawls": """
SELECT page_id, lower(regexp_extract(url, 'https?://([^/?#]+)', 1)) AS domain, page_id % 8 <> 0 AS success,
       CASE WHEN page_id % 9 = 0 THEN NULL ELSE html END AS markdown,
       cast((length(html) - length(replace(html, '<a ', ''))) / 3 AS INT) AS n_links, cast(page_id % 12 AS INT) AS n_images,
       regexp_extract(html, '<title>([^<]*)</title>', 1) AS meta_title, CASE WHEN page_id % 4 = 0 THEN NULL ELSE 'text' END AS meta_description,
       regexp_extract(html, 'lang="([a-z]+)"', 1) AS meta_language, CASE WHEN page_id % 3 = 0 THEN url ELSE NULL END AS canonical_url
FROM {pages}""",
    # stored and present content hashes by check: some unknown, some drifted, some only at an earlier check
    "b_prev_hash": """
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN NULL WHEN page_id % 5 = 0 THEN md5(concat(html, 'old')) ELSE md5(html) END AS prev_hash,
       md5(html) AS content_hash, cast('2024-01-20 00:00:00' AS TIMESTAMP) AS checked_at
FROM {pages}
UNION ALL
SELECT page_id, CASE WHEN page_id % 5 = 0 THEN md5(html) ELSE md5(concat(html, 'old')) END, md5(html), cast('2024-01-10 00:00:00' AS TIMESTAMP)
FROM {pages} WHERE page_id % 4 = 0""",
    # labelled features for training and evaluation
    "b_training_docs": """
SELECT d.doc_id, l.quality AS label, cast(d.n_chars AS DOUBLE) AS n_chars, d.lang AS industry, d.source AS country,
       cast(d.doc_id % 100 AS DOUBLE) / 100 AS embedding_similarity,
       cast(d.doc_id % 3 AS DOUBLE) / 2 AS industry_match, cast(d.doc_id % 2 AS DOUBLE) AS geo_match,
       CASE WHEN d.doc_id % 10 = 0 THEN NULL ELSE cast(d.doc_id % 500 AS DOUBLE) END AS employee_count
FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id""",
    # model registry rows
    "b_model_versions": """
SELECT concat('m', cast(s_suppkey AS STRING)) AS model_id, CASE WHEN s_suppkey % 2 = 0 THEN 'logistic_regression' ELSE 'random_forest' END AS model_type,
       concat('v', cast(s_suppkey AS STRING)) AS model_version,
       0.5 + cast((s_suppkey * 7) % 50 AS DOUBLE) / 100 AS auc_score, 0.4 + cast((s_suppkey * 11) % 50 AS DOUBLE) / 100 AS pr_auc_score,
       0.6 + cast((s_suppkey * 13) % 30 AS DOUBLE) / 100 AS accuracy, cast(50 + s_suppkey % 200 AS INT) AS training_samples,
       concat('2024-01-', lpad(cast(s_nationkey + 1 AS STRING), 2, '0')) AS training_date
FROM {supplier}""",
    # vendor CSV rows
    "b_startups": """
SELECT concat('company_', lpad(cast(c_custkey AS STRING), 6, '0')) AS company_id, concat(' ', c_name, ' ') AS company_name,
       CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE concat('https://www.d', cast(c_custkey % 90 AS STRING), '.example.com') END AS website_url,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE concat('https://linkedin.com/company/', cast(c_custkey AS STRING)) END AS linkedin_url,
       concat('NATION_', cast(c_nationkey AS STRING)) AS headquarters_location,
       CASE WHEN c_custkey % 9 = 0 THEN 'EdTech, Software' ELSE lower(c_mktsegment) END AS industries,
       CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE concat('About ', c_name) END AS description,
       CASE WHEN c_custkey % 7 = 0 THEN 'n.d.' ELSE concat(cast(1990 + c_custkey % 30 AS STRING), '-05-01') END AS founded_date,
       CASE c_custkey % 4 WHEN 0 THEN '101-250' WHEN 1 THEN '501-1000' WHEN 2 THEN '5001-10000' ELSE '11-50' END AS employee_count,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE cast(cast(c_acctbal * 2000 AS DECIMAL(15,2)) AS STRING) END AS total_funding_usd,
       concat('2023-1', cast(c_custkey % 3 AS STRING), '-01') AS last_funding_date,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'Seed' END AS funding_status,
       concat('NATION_', cast(c_nationkey AS STRING)) AS country
FROM {customer}""",
    # enrichment lookups, one row per domain
    "b_vendor_lookup": """
SELECT concat('d', cast(s_suppkey % 60 AS STRING), '.example.com') AS domain, min(concat('apollo-', cast(s_suppkey AS STRING))) AS apollo_company_id
FROM {supplier} GROUP BY concat('d', cast(s_suppkey % 60 AS STRING), '.example.com')""",
    "b_crawl_lookup": """
SELECT concat('d', cast(page_id % 75 AS STRING), '.example.com') AS domain, max(url) AS web_content, split('spark,sql', ',') AS technologies
FROM {pages} GROUP BY concat('d', cast(page_id % 75 AS STRING), '.example.com')""",
    # second generation: companies, vendor rows, contacts and crawls by id
    "b_gen_companies": """
SELECT CASE WHEN c_custkey % 53 = 0 THEN NULL ELSE concat('c', cast(c_custkey AS STRING)) END AS id,
       CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE c_name END AS name,
       concat('d', cast(c_custkey AS STRING), '.example.com') AS website_url,
       lower(c_mktsegment) AS industry,
       CASE WHEN c_custkey % 17 = 0 THEN 'many' ELSE cast(c_custkey % 400 AS STRING) END AS employee_count,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE cast(cast(floor(c_acctbal * 2000) AS BIGINT) AS STRING) END AS annual_revenue,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE cast(1990 + c_custkey % 30 AS STRING) END AS founded_year,
       concat('City ', cast(c_custkey % 50 AS STRING)) AS headquarters_city,
       concat('NATION_', cast(c_nationkey AS STRING)) AS headquarters_country,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE concat('About ', c_name) END AS description,
       CASE c_custkey % 3 WHEN 0 THEN 'AI, Cloud' WHEN 1 THEN 'AWS' ELSE 'Machine Learning' END AS technologies,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'b2b' END AS keywords,
       concat('2024-01-', lpad(cast(1 + c_custkey % 28 AS STRING), 2, '0'), ' 10:00:00') AS created_at,
       concat('apollo-', cast(c_custkey AS STRING)) AS apollo_id
FROM {customer}""",
    "b_gen_contacts": """
SELECT concat('p', cast(o_orderkey AS STRING)) AS id, concat('First', cast(o_orderkey % 100 AS STRING)) AS first_name,
       CASE o_orderkey % 5 WHEN 0 THEN 'C-Level' WHEN 1 THEN 'VP' WHEN 2 THEN 'Director' ELSE 'Staff' END AS seniority,
       CASE o_orderkey % 4 WHEN 0 THEN 'CEO' WHEN 1 THEN 'Engineer' WHEN 2 THEN 'Sales' ELSE NULL END AS title,
       o_orderpriority AS department,
       CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE concat('c', cast(o_custkey AS STRING)) END AS organization_id,
       cast(cast(floor(o_totalprice) AS BIGINT) AS STRING) AS organization_annual_revenue,
       cast(o_orderdate AS STRING) AS created_at
FROM {orders}""",
    "b_gen_crawls": """
SELECT page_id, concat('c', cast(page_id AS STRING)) AS company_id,
       CASE WHEN page_id % 25 = 0 THEN NULL ELSE lower(regexp_extract(url, 'https?://([^/?#]+)', 1)) END AS domain,
       cast(page_id % 6 AS STRING) AS pages_crawled,
       concat('2024-01-', lpad(cast(1 + page_id % 28 AS STRING), 2, '0'), ' 12:00:00') AS crawled_at,
       md5(html) AS content_hash, regexp_extract(html, 'lang="([a-z]+)"', 1) AS main_language
FROM {pages}
UNION ALL
SELECT page_id, concat('c', cast(page_id AS STRING)), lower(regexp_extract(url, 'https?://([^/?#]+)', 1)), '9', '2023-12-15 12:00:00',
       md5(concat('old', cast(page_id AS STRING))), 'xx'
FROM {pages} WHERE page_id % 3 = 0""",
    "b_gen_health": """
SELECT concat('d', cast(page_id * 2 AS STRING), '.example.com') AS domain,
       CASE WHEN page_id % 10 = 0 THEN NULL ELSE cast((page_id * 37) % 101 AS DOUBLE) / 100 END AS domain_health_score,
       url LIKE 'https%' AS ssl_valid, page_id % 7 <> 0 AS dns_resolution,
       cast('2024-01-30 00:00:00' AS TIMESTAMP) AS last_health_check
FROM {pages}
UNION ALL
SELECT concat('d', cast(page_id * 2 AS STRING), '.example.com'), cast(0.5 AS DOUBLE), true, true, cast('2024-01-20 00:00:00' AS TIMESTAMP)
FROM {pages} WHERE page_id % 4 = 0""",
    # keyed rows that change over time, for upserts and deltas
    "b_updates": """
SELECT cast(user_id AS STRING) AS company_key, event_id, event_type AS status, value AS score, ts AS updated_at,
       CASE WHEN event_id % 10 = 0 THEN '' ELSE concat('Profile ', cast(event_id AS STRING)) END AS profile_text,
       CASE WHEN event_id % 12 = 0 THEN NULL ELSE md5(cast(event_id AS STRING)) END AS profile_text_hash
FROM {events}""",
    # profiles whose stored embedding hash may be missing or old, or was right once and is not any more
    "b_profiles": """
SELECT doc_id AS company_key, text AS profile_text, md5(text) AS profile_text_hash, lang AS industry, source AS country,
       cast('2024-01-10 00:00:00' AS TIMESTAMP) + doc_id * INTERVAL '1' MINUTE AS updated_at
FROM {documents}""",
    "b_embedded": """
SELECT doc_id AS company_key, CASE WHEN doc_id % 4 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN md5(concat(text, 'old')) ELSE md5(text) END AS embedded_hash,
       cast('2024-01-05 00:00:00' AS TIMESTAMP) AS stored_at
FROM {documents}
UNION ALL
SELECT doc_id, md5(concat(text, 'other')), cast('2024-01-08 00:00:00' AS TIMESTAMP) FROM {documents} WHERE doc_id % 9 = 0
UNION ALL
SELECT doc_id, md5(concat(text, 'first')), cast('2024-01-02 00:00:00' AS TIMESTAMP) FROM {documents} WHERE doc_id % 5 = 0""",
}
