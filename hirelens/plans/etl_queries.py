"""Ingest / merge / cleaning / per-extractor queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelens import refdata as R
from hirelens.functions import location as G
from hirelens.functions import roles as X
from hirelens.functions import salary as L
from hirelens.functions.header import BADGE_SITE, fallback_header, page_header, page_title
from hirelens.functions.skills import extract_skills_from_found, keywords_found
from hirelens.functions.text import is_obfuscated, join_list, parse_list
from hirelens.operators import clean, merge
from hirelens.operators.enrich import annualize
from hirelens.plans.common import m2, money, read, silver
from hirelens.plans.expected_sql import cte
from hirelens.plans.registry import register
from hirelens.sources import driver_tables as T

E = cte()


@register("silver_build")
def silver_build(spark, d):
    """Bronze → silver enrichment, written to the shared folder (its row count is the check).

    Goes through the per-session silver table, so gold / report queries run
    after it read what it wrote instead of enriching again."""
    return silver(spark, d)


# ------------------------------------------------------------------ merges
def _batches(spark, d):
    o = read(spark, d, "orders")
    rows = o.select(
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("https://jobs.example.com/c/"), F.col("o_custkey").cast("string"))).alias("link"),
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"),
        F.to_date("o_orderdate").alias("date_posted"), F.col("o_orderkey").alias(merge.SEQ))
    # raw range predicates on the source column so the batch split reaches the Parquet scan
    old = rows.where(o.o_orderdate < F.lit("1998-01-01").cast("timestamp_ntz")).withColumn(merge.BATCH, F.lit(0))
    new = rows.where(o.o_orderdate >= F.lit("1997-01-01").cast("timestamp_ntz")).withColumn(merge.BATCH, F.lit(1))
    return old, new


_BATCH_SQL = """
WITH r AS (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'https://jobs.example.com/c/' || o_custkey END AS link,
                  o_orderkey AS id, o_totalprice AS price, CAST(o_orderdate AS DATE) AS date_posted FROM orders),
b AS (SELECT *, 0 AS _batch FROM r WHERE year(date_posted) <= 1997
      UNION ALL SELECT *, 1 AS _batch FROM r WHERE year(date_posted) >= 1997)
"""


def _merge_sql(direction: str, agg: str) -> str:
    return _BATCH_SQL + f"""
, keyed AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY link ORDER BY _batch {direction}, id {direction}) AS rn
                           FROM b WHERE link IS NOT NULL) WHERE rn = 1),
nulls AS (SELECT link, id, price, date_posted, {agg}(_batch) AS _batch FROM b WHERE link IS NULL GROUP BY ALL)
SELECT link, id, {m2('price')} AS price, date_posted, _batch FROM keyed
UNION ALL SELECT link, id, {m2('price')} AS price, date_posted, _batch FROM nulls"""


def _out(df):
    return df.select("link", "id", money("price"), "date_posted", merge.BATCH)


@register("merge_keep_last", _merge_sql("DESC", "max"))
def merge_keep_last(spark, d):
    old, new = _batches(spark, d)
    master = merge.dedupe(old, ["link"], "last")
    return _out(merge.merge_keep_last(master, new, merge.pick_key(old, new)))


@register("merge_keep_first", _merge_sql("ASC", "min"))
def merge_keep_first(spark, d):
    old, new = _batches(spark, d)
    master = merge.dedupe(old, ["link"], "first")
    return _out(merge.merge_keep_first(master, new, merge.pick_key(old, new)))


@register("merge_idempotent", _merge_sql("ASC", "min"))
def merge_idempotent(spark, d):
    """Merging the same batch twice changes nothing (keep-first)."""
    old, new = _batches(spark, d)
    master = merge.dedupe(old, ["link"], "first")
    once = merge.merge_keep_first(master, new, ["link"])
    return _out(merge.merge_keep_first(once, new, ["link"]))


@register("new_links_antijoin", _BATCH_SQL + f"""
SELECT link, id, {m2('price')} AS price FROM b WHERE _batch = 1
  AND (link IS NULL OR link NOT IN (SELECT link FROM b WHERE _batch = 0 AND link IS NOT NULL))""")
def new_links_antijoin(spark, d):
    old, new = _batches(spark, d)
    return merge.new_rows(new, old, "link").select("link", "id", money("price"))


@register("union_common_columns", _BATCH_SQL + f"""
, u AS (SELECT link, id, price, CASE WHEN _batch = 1 THEN 'header ' || id END AS header_text,
               row_number() OVER (PARTITION BY link ORDER BY _batch, id, price) AS rn FROM b)
SELECT link, id, {m2('price')} AS price, header_text FROM u WHERE link IS NULL OR rn = 1""")
def union_common_columns(spark, d):
    old, new = _batches(spark, d)
    existing = old.select("link", "id", "price")
    fresh = new.select("link", "id", "price", "date_posted",
                       F.concat(F.lit("header "), F.col("id").cast("string")).alias("header_text"))
    u = merge.union_common(existing, fresh, extra=["header_text"])
    return u.select("link", "id", money("price"), "header_text")


# ------------------------------------------------------------------ cleaning
def _masked_customers(spark, d):
    c = read(spark, d, "customer")
    n = F.broadcast(read(spark, d, "nation"))
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_acctbal") < 0, F.lit("****")).otherwise(F.col("c_name")).alias("company"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("  ")).otherwise(F.col("n_name")).alias("location"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None).cast("string"))
        .otherwise(F.col("c_mktsegment")).alias("segment"))


_MASK_SQL = """
WITH m AS (SELECT c_custkey AS id, c_acctbal < 0 AS company_obf, c_mktsegment = 'AUTOMOBILE' AS location_obf,
                  c_mktsegment = 'BUILDING' AS segment_obf FROM customer)
"""


@register("drop_obfuscated_all", _MASK_SQL + "SELECT id FROM m WHERE NOT (company_obf AND location_obf)")
def drop_obfuscated_all(spark, d):
    return clean.drop_obfuscated_rows(_masked_customers(spark, d), ["location", "company"]).select("id")


@register("drop_obfuscated_any", _MASK_SQL + """
SELECT id FROM m WHERE NOT (company_obf OR location_obf OR segment_obf)""")
def drop_obfuscated_any(spark, d):
    return clean.drop_rows_with_any_obfuscated(_masked_customers(spark, d), ["company", "location", "segment"]) \
        .select("id")


@register("obfuscation_counts", _MASK_SQL + """
SELECT count(*) FILTER (WHERE company_obf) AS company, count(*) FILTER (WHERE location_obf) AS location,
       count(*) FILTER (WHERE segment_obf) AS segment FROM m""")
def obfuscation_counts(spark, d):
    m = _masked_customers(spark, d)
    return m.agg(*[F.count_if(is_obfuscated(c)).alias(c) for c in ["company", "location", "segment"]])


@register("null_profile", """
WITH e AS (SELECT * FROM events)
SELECT 'event_id' AS column_name, count(*) - count(event_id) AS nulls, count(*) AS total FROM e
UNION ALL SELECT 'ts', count(*) - count(ts), count(*) FROM e
UNION ALL SELECT 'user_id', count(*) - count(user_id), count(*) FROM e
UNION ALL SELECT 'event_type', count(*) - count(event_type), count(*) FROM e
UNION ALL SELECT 'value', count(*) - count(value), count(*) FROM e
UNION ALL SELECT 'props', count(*) - count(props), count(*) FROM e""")
def null_profile(spark, d):
    return clean.null_profile(read(spark, d, "events")).select("column_name", "nulls", "total")


@register("apply_overrides", """
SELECT o.o_orderkey AS id, CASE WHEN o.o_orderpriority = '1-URGENT' THEN upper(c.c_name) ELSE c.c_name END AS company,
       CASE WHEN o.o_orderpriority = '1-URGENT' THEN 'Patched' ELSE o.o_orderstatus END AS status
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey""")
def apply_overrides(spark, d):
    o, c = read(spark, d, "orders"), read(spark, d, "customer")
    base = o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("id"), F.col("c_name").alias("company"), F.col("o_orderstatus").alias("status"))
    overrides = (o.where(F.col("o_orderpriority") == "1-URGENT").join(c, o.o_custkey == c.c_custkey)
                 .select(F.col("o_orderkey").alias("id"), F.upper("c_name").alias("company"),
                         F.lit("Patched").alias("status")))
    return clean.apply_overrides(base, overrides, "id")


@register("safe_casts", """
SELECT event_id,
       TRY_CAST(CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS value_num,
       TRY_CAST(CASE WHEN event_type = 'click' THEN 'not a date' ELSE substr(CAST(ts AS VARCHAR), 1, 10) END AS DATE)
         AS event_date,
       coalesce(strftime(TRY_CAST(CASE WHEN event_type = 'click' THEN 'not a date'
                ELSE substr(CAST(ts AS VARCHAR), 1, 10) END AS DATE), '%Y-%m-%d'), 'Unknown') AS event_date_filled,
       event_type <> 'error' AND value IS NOT NULL AS value_disclosed,
       CASE WHEN event_type = 'error' OR value IS NULL THEN 'Not disclosed' ELSE 'Disclosed' END AS value_group
FROM events""")
def safe_casts(spark, d):
    e = read(spark, d, "events")
    raw = e.select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("v"),
        F.when(F.col("event_type") == "click", F.lit("not a date"))
        .otherwise(F.substring(F.col("ts").cast("string"), 1, 10)).alias("t"))
    return clean.safe_casts(raw, "v", "t") \
        .select("event_id", "value_num", "event_date", "event_date_filled", "value_disclosed", "value_group")


# ------------------------------------------------------------------ extractors (by construction)
def _bronze(spark, d):
    return T.bronze_postings(spark, d)


def _lowered(spark, d):
    """Bronze with the lower-cased, normalised texts materialised once per row."""
    from hirelens.functions.text import normalize_text
    b = _bronze(spark, d).withColumns({
        "_t": F.lower(normalize_text("title")), "_d": F.lower(normalize_text("description")),
        "_h": F.lower(normalize_text("header_text"))})
    return b.withColumn("_td", F.concat_ws(" ", "_t", "_d"))


@register("extract_experience", E + "SELECT id, experience_level FROM exp_postings")
def extract_experience(spark, d):
    b = _lowered(spark, d)
    return b.select("id", X.experience_level("_t", "_d", normalized=True).alias("experience_level"))


@register("extract_work_type", E + "SELECT id, work_type FROM exp_postings")
def extract_work_type(spark, d):
    b = _lowered(spark, d)
    return b.select("id", X.header_first_of(X.work_type_of, "_h", "_td").alias("work_type"))


@register("extract_employment_type", E + "SELECT id, employment_type FROM exp_postings")
def extract_employment_type(spark, d):
    b = _lowered(spark, d)
    return b.select("id", X.header_first_of(X.employment_type_of, "_h", "_td").alias("employment_type"))


@register("extract_country", E + "SELECT id, location, country FROM exp_postings")
def extract_country(spark, d):
    b = _bronze(spark, d)
    return b.select("id", "location", G.extract_country("location").alias("country"))


_SKILLS_SQL = ", ".join(
    f"coalesce((SELECT string_agg(skill, ';' ORDER BY skill) FROM exp_job_skills s "
    f"WHERE s.job_id = p.id AND s.skill_category = '{c}'), '') AS {c}" for c in R.SKILL_COLUMNS)


@register("extract_skills", E + f"SELECT p.id, {_SKILLS_SQL} FROM exp_postings p")
def extract_skills_q(spark, d):
    b = _bronze(spark, d).select("id", keywords_found(F.col("description")).alias("_kw"))  # one scan for the four columns
    return b.select("id", *[F.concat_ws(";", v).alias(k) for k, v in extract_skills_from_found(F.col("_kw")).items()])


@register("skill_list_roundtrip", E + """
SELECT o.o_orderkey AS id, coalesce((SELECT string_agg(text_skill, ';' ORDER BY text_skill)
       FROM exp_order_skills s WHERE s.job_id = o.o_orderkey), '') AS skills FROM orders o""")
def skill_list_roundtrip(spark, d):
    o = read(spark, d, "orders").select("o_orderkey")
    lists = T.order_skill_lists(spark, d)
    messy = F.concat(F.lit(" "), F.concat_ws(" ; ", "skills"), F.lit(" ;; "))
    j = o.join(lists, o.o_orderkey == lists.l_orderkey, "left")
    return j.select(F.col("o_orderkey").alias("id"), join_list(parse_list(messy)).alias("skills"))


@register("extract_salary", E + f"""
SELECT id, has_salary, currency_raw, min_salary_raw, max_salary_raw, single_salary_raw, salary_period,
       {m2('min_salary_annual_usd')} AS min_salary_annual_usd, {m2('max_salary_annual_usd')} AS max_salary_annual_usd,
       {m2('avg_salary_annual_usd')} AS avg_salary_annual_usd, salary_confidence FROM exp_postings""")
def extract_salary(spark, d):
    b = _bronze(spark, d)
    df = L.with_salary_header_first(b, F.col("header_text"), F.col("title"), F.col("description"), "_best")
    df = df.select("id", *[v.alias(k) for k, v in L.salary_fields(F.col("_best")).items()])
    df = annualize(df)
    return df.select("id", "has_salary", "currency_raw", "min_salary_raw", "max_salary_raw", "single_salary_raw",
                     "salary_period", money("min_salary_annual_usd"), money("max_salary_annual_usd"),
                     money("avg_salary_annual_usd"), "salary_confidence")


@register("salary_currency_fallback", E + """
SELECT id, country, CASE country WHEN 'India' THEN 'INR' WHEN 'United States' THEN 'USD' WHEN 'France' THEN 'EUR'
  WHEN 'Malaysia' THEN 'MYR' WHEN 'Singapore' THEN 'SGD' WHEN 'Germany' THEN 'EUR' WHEN 'Canada' THEN 'CAD'
  WHEN 'Indonesia' THEN 'IDR' WHEN 'Thailand' THEN 'THB' WHEN 'United Arab Emirates' THEN 'AED'
  WHEN 'Saudi Arabia' THEN 'SAR' WHEN 'Mexico' THEN 'MXN' WHEN 'United Kingdom' THEN 'GBP' WHEN 'Japan' THEN 'JPY'
  WHEN 'Pakistan' THEN 'PKR' WHEN 'Portugal' THEN 'EUR' WHEN 'Spain' THEN 'EUR' WHEN 'Australia' THEN 'AUD'
  WHEN 'Brazil' THEN 'BRL' ELSE 'USD' END AS currency
FROM exp_postings""")
def salary_currency_fallback(spark, d):
    """A salary without a currency takes the location's country currency, else USD."""
    b = _bronze(spark, d).select("id", "location", F.lit("Salary: 90,000 yearly.").alias("t"))
    b = b.withColumn("country", G.extract_country("location"))
    df = L.with_best_salary(b, F.col("t"), "_best")
    f = L.salary_fields(F.col("_best"), fallback_currency=G.country_currency(F.col("country")))
    return df.select("id", "country", f["currency_raw"].alias("currency"))


# ------------------------------------------------------------------ pages
@register("header_from_pages", r"""
SELECT page_id, nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title,
       CAST(NULL AS VARCHAR) AS header_text,
       CASE WHEN NOT starts_with(url, 'http') THEN NULL
            WHEN contains(url, '""" + BADGE_SITE + r"""') THEN NULL
            ELSE concat_ws(' | ', nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), ''),
                           nullif(regexp_extract(html, '<p>([^<]*)</p>', 1), '')) END AS fallback_header
FROM pages""")
def header_from_pages(spark, d):
    p = read(spark, d, "pages")
    title = page_title(F.col("html"))
    first_p = F.nullif(F.regexp_extract("html", r"<p>([^<]*)</p>", 1), F.lit(""))
    return p.select("page_id", title.alias("title"), page_header(F.col("html")).alias("header_text"),
                    fallback_header(F.col("url"), title, first_p).alias("fallback_header"))


# ------------------------------------------------------------------ sources / re-extraction / join forms
@register("bronze_csv_roundtrip", E + """
SELECT id, title, company, location, date_posted FROM exp_postings""")
def bronze_csv_roundtrip(spark, d):
    """S1 + S2: bronze written as CSV (quoted, multi-line-safe) and read back with the fixed schema."""
    from hirelens.session import scratch_path
    from hirelens.sources.files import read_bronze_csv, write_csv
    path = scratch_path(spark, "bronze-csv")
    write_csv(_bronze(spark, d), path)
    return read_bronze_csv(spark, path).select("id", "title", "company", "location", "date_posted")


@register("salary_with_rates_table", E + f"""
SELECT id, currency_raw, {m2('avg_salary_annual_usd')} AS avg_salary_annual_usd FROM exp_postings""")
def salary_with_rates_table(spark, d):
    """S5 + J2: rates as a table, turned into one constant map."""
    from hirelens.sources.files import read_rates
    b = _bronze(spark, d)
    df = L.with_salary_header_first(b, F.col("header_text"), F.col("title"), F.col("description"), "_best")
    df = df.select("id", *[v.alias(k) for k, v in L.salary_fields(F.col("_best")).items()])
    df = annualize(df, read_rates(spark))
    return df.select("id", "currency_raw", money("avg_salary_annual_usd"))


@register("salary_reextract", E + f"""
SELECT id, has_salary, currency_raw, {m2('avg_salary_annual_usd')} AS avg_salary_annual_usd, salary_confidence
FROM exp_postings""")
def salary_reextract(spark, d):
    """Salary columns recomputed over silver (header used only with a salary keyword)."""
    from hirelens.operators.enrich import reextract_salary
    from hirelens.plans.common import silver
    s = reextract_salary(silver(spark, d))
    return s.select("id", "has_salary", "currency_raw", money("avg_salary_annual_usd"), "salary_confidence")


@register("skills_reextract", E + f"SELECT p.id, {_SKILLS_SQL} FROM exp_postings p")
def skills_reextract(spark, d):
    """K5: only the four skill arrays recomputed over silver."""
    from hirelens.operators.enrich import reextract_skills
    from hirelens.plans.common import silver
    s = reextract_skills(silver(spark, d))
    return s.select("id", *[F.concat_ws(";", c).alias(c) for c in R.SKILL_COLUMNS])


@register("extract_country_gazetteer_join", E + "SELECT id, country FROM exp_postings")
def extract_country_gazetteer_join(spark, d):
    """G1/G2/J8 join form: distinct cleaned locations, their word runs joined with a gazetteer table, joined back."""
    from hirelens.operators.enrich import default_gazetteer, resolve_countries
    return resolve_countries(_bronze(spark, d), "location", default_gazetteer(spark)).select("id", "country")


@register("skill_list_literal", E + """
SELECT o.o_orderkey AS id, coalesce((SELECT string_agg(text_skill, ';' ORDER BY text_skill)
       FROM exp_order_skills s WHERE s.job_id = o.o_orderkey), '') AS skills FROM orders o""")
def skill_list_literal(spark, d):
    """K7: skills stored as a list literal string ("['a', 'b']") parsed back to an array."""
    from hirelens.functions.text import parse_list_literal
    o = read(spark, d, "orders").select("o_orderkey")
    lists = T.order_skill_lists(spark, d)
    literal = F.concat(F.lit("["), F.concat_ws(", ", F.transform(
        F.coalesce("skills", F.array().cast("array<string>")), lambda s: F.concat(F.lit("'"), s, F.lit("'")))),
        F.lit("]"))
    j = o.join(lists, o.o_orderkey == lists.l_orderkey, "left")
    return j.select(F.col("o_orderkey").alias("id"), join_list(parse_list_literal(literal)).alias("skills"))


@register("missing_salary_rows", E + """
SELECT id, title FROM exp_postings WHERE avg_salary_annual_usd IS NULL""")
def missing_salary_rows(spark, d):
    """Postings whose salary is missing."""
    from hirelens.plans.common import silver
    return silver(spark, d).where(F.col("avg_salary_annual_usd").isNull()).select("id", "title")
