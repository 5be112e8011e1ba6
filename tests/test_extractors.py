"""Unit goldens for the Column extractors (FIXTURES.md §2, §4)."""

import pytest
from pyspark.sql import functions as F

from hirelens.functions import location as G
from hirelens.functions import roles as X
from hirelens.functions import salary as S
from hirelens.functions.skills import extract_skills
from hirelens.functions.text import is_obfuscated, join_list, parse_list
from hirelens.operators.enrich import annualize

# (text, currency, min, max, single, period, annual usd min, max, avg)
SALARY_CASES = [
    ("The salary range for this role is MX$235,200- MX$252,806.", "MXN", 235200, 252806, None, None, 11760, 12640.3, 12200.15),
    ("Software Engineer - Salary: MYR 8,000 - 12,000 per month", "MYR", 8000, 12000, None, "month", 24000, 36000, 30000),
    ("We offer $80,000 - $120,000 annually", "USD", 80000, 120000, None, "year", 80000, 120000, 100000),
    ("Compensation: SGD 5,500 monthly", "SGD", None, None, 5500, "month", 52800, 52800, 52800),
    ("Pay range: RM 4,500 to RM 7,200 per month", "MYR", 4500, 7200, None, "month", 13500, 21600, 17550),
    ("Annual salary of USD 95,000", "USD", None, None, 95000, None, 95000, 95000, 95000),
    ("€45,000 - €65,000 per year", "EUR", 45000, 65000, None, "year", 56250, 81250, 68750),
    ("Hourly rate: $25 - $35 per hour", "USD", 25, 35, None, "hour", 52000, 72800, 62400),
    ("Salary up to ¥8,000,000 annually", "JPY", None, None, 8000000, "year", 50000, 50000, 50000),
    ("Competitive salary: INR 12,00,000 - 18,00,000 per annum", "INR", 1200000, 1800000, None, "year", 15000, 22500, 18750),
    ("Package: 50K - 80K SGD yearly", "SGD", 50000, 80000, None, "year", 40000, 64000, 52000),
    ("Starting at THB 45,000 per month", "THB", None, None, 45000, "month", 16875, 16875, 16875),
    ("Offering AED 15,000 - AED 25,000 monthly", "AED", 15000, 25000, None, "month", 45000, 75000, 60000),
    ("Executive package: $1.5M - $2.2M per year", "USD", 1500000, 2200000, None, "year", None, None, None),
    ("Senior role: USD 500K - 1M annually", "USD", 500000, 1000000, None, "year", 500000, 1000000, 750000),
    ("PKR 2,50,000 per annum", "PKR", None, None, 250000, "year", 1000, 1000, 1000),
    ("SAR 15,000 per month", "SAR", None, None, 15000, "month", 45000, 45000, 45000),
    ("Rupiah 3,000,000 per month", "IDR", None, None, 3000000, "month", 2250, 2250, 2250),
    ("Rp 4.500.000 – Rp 7.000.000 monthly", "IDR", 4500000, 7000000, None, "month", 3375, 5250, 4312.5),
    ("Base salary: €50.000,50 annually", "EUR", None, None, 50000.5, "year", 62500.625, 62500.625, 62500.625),
    ("Compensation 1.2M THB yearly", "THB", None, None, 1200000, "year", 37500, 37500, 37500),
    ("Starting: IDR 8.5M monthly", "IDR", None, None, 8500000, "month", 6375, 6375, 6375),
    ("$110K/yr - $130K/yr", "USD", 110000, 130000, None, "year", 110000, 130000, 120000),
]


@pytest.fixture(scope="module")
def salary_rows(spark):
    texts = [c[0] for c in SALARY_CASES] + [
        "5+ years with 3 teams", "We raised $20,000,000 in funding. Salary $90,000 annually.", "Attractive package."]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    df = S.with_best_salary(df, F.col("t"), "_best")
    df = df.select("i", *[v.alias(k) for k, v in S.salary_fields(F.col("_best")).items()])
    return {r.i: r for r in annualize(df).collect()}


def _close(a, b):
    return (a is None and b is None) or (a is not None and b is not None and abs(a - b) < 1e-6)


@pytest.mark.parametrize("idx", range(len(SALARY_CASES)))
def test_salary_goldens(salary_rows, idx):
    text, cur, mn, mx, single, period, amin, amax, aavg = SALARY_CASES[idx]
    r = salary_rows[idx]
    assert r.has_salary, text
    assert r.currency_raw == cur, text
    assert _close(r.min_salary_raw, mn) and _close(r.max_salary_raw, mx) and _close(r.single_salary_raw, single), text
    assert r.salary_period == period, text
    assert _close(r.min_salary_annual_usd, amin) and _close(r.max_salary_annual_usd, amax), text
    assert _close(r.avg_salary_annual_usd, aavg), text


def test_salary_negatives_and_confidence(salary_rows):
    n = len(SALARY_CASES)
    assert not salary_rows[n].has_salary and salary_rows[n].salary_confidence is None
    funding = salary_rows[n + 1]
    assert funding.has_salary and funding.single_salary_raw == 90000 and funding.currency_raw == "USD"
    assert not salary_rows[n + 2].has_salary
    assert salary_rows[2].salary_confidence == 1.0      # range + currency + period
    assert salary_rows[5].salary_confidence == 0.6      # single + currency
    assert salary_rows[0].salary_confidence == 0.9      # range + currency


def test_experience(spark):
    cases = [("Senior Data Engineer", "", "Senior"), ("Associate Analyst", "", "Entry-Level"),
             ("Senior Associate", "", "Senior"), ("BI Specialist", "", "Mid-Level"),
             ("Data Analyst", "0-2 years", "Entry-Level"), ("Data Analyst", "3–5 years", "Mid-Level"),
             ("Data Analyst", "5-8 years", "Senior"), ("Data Analyst", "2 years", "Entry-Level"),
             ("Data Analyst", "4 years", "Mid-Level"), ("Data Analyst", "5+ yrs", "Senior"),
             ("Data Analyst", "fresh graduate welcome", "Entry-Level"), ("Data Analyst", "great team", "Not Specified"),
             (None, None, "Not Specified")]
    df = spark.createDataFrame(cases, "t string, d string, e string")
    out = df.select("e", X.experience_level("t", "d").alias("got")).collect()
    assert [r.got for r in out] == [r.e for r in out]


def test_work_and_employment_types(spark):
    work = [("hybrid or remote", "Remote"), ("wfh", "Remote"), ("onsite", "On-site"),
            ("flexible location", "Hybrid"), ("team", "Not Specified")]
    emp = [("permanent", "Full-time"), ("part time", "Part-time"), ("contractor", "Contract"),
           ("temp role", "Temporary"), ("internship", "Internship"), ("freelancer", "Freelance"),
           ("fulltime", "Full-time")]
    w = spark.createDataFrame(work, "d string, e string").select("e", X.work_type(F.lit(""), "d").alias("g"))
    assert all(r.e == r.g for r in w.collect())
    e = spark.createDataFrame(emp, "d string, e string").select("e", X.employment_type(F.lit(""), "d").alias("g"))
    assert all(r.e == r.g for r in e.collect())
    h = spark.createDataFrame([("Hybrid", "remote", "Hybrid"), ("$50/hr", "remote", "Remote")], "h string, d string, e string")
    out = h.select("e", X.work_type_with_header("h", F.lit(""), "d").alias("g")).collect()
    assert all(r.e == r.g for r in out)


def test_skills(spark):
    df = spark.createDataFrame([("Python, C++ and SQL; Azure; SAS",), (None,), ("Power BI, c/c++, unix/linux",)], "t string")
    rows = df.select(*[v.alias(k) for k, v in extract_skills(F.col("t")).items()]).collect()
    assert rows[0].programming_languages == ["c++", "python", "sas", "sql"]
    assert rows[0].analyst_tools == ["azure", "sas"] and rows[0].cloud_platforms == ["azure"]
    assert rows[0].libraries == []
    assert rows[1].programming_languages == [] and rows[1].analyst_tools == []
    assert rows[2].analyst_tools == ["Power BI", "linux", "unix", "unix/linux"]
    assert rows[2].programming_languages == ["c", "c++", "c/c++"]


def test_country(spark):
    cases = [("Greater Bengaluru Area", "India"), ("San Jose, CA", "United States"), ("", "Unknown"),
             (None, "Unknown"), ("Paris", "France"), ("Toronto, ON", "Canada"), ("Dubai, United Arab Emirates",
                                                                                 "United Arab Emirates")]
    df = spark.createDataFrame(cases, "l string, c string")
    out = df.select("c", G.extract_country("l").alias("g")).collect()
    assert [r.g for r in out] == [r.c for r in out]


def test_obfuscation_and_lists(spark):
    df = spark.createDataFrame([(None,), ("****",), (" ",), ("A*",), ("日本",)], "v string")
    assert [r.o for r in df.select(is_obfuscated("v").alias("o")).collect()] == [True, True, True, False, False]
    l = spark.createDataFrame([(" a ; b;;c ",), (None,)], "s string")
    assert [r.j for r in l.select(join_list(parse_list("s")).alias("j")).collect()] == ["a;b;c", ""]


def test_page_header_positive(spark):
    from hirelens.functions.header import fallback_header, page_header
    html = ('<div><span class="tvm__text tvm__text--low-emphasis"><strong>$110K/yr - $130K/yr</strong></span>'
            '<span class="tvm__text--low-emphasis"><strong> Hybrid </strong></span>'
            '<span class="visually-hidden">Matches your job preferences, job type is Full-time.</span></div>')
    df = spark.createDataFrame([(html, "https://www.linkedin.com/jobs/1"), ("<p>x</p>", "https://example.org/j"),
                                ("<p>x</p>", "ftp://x")], "html string, url string")
    rows = df.select(page_header(F.col("html")).alias("h"),
                     fallback_header(F.col("url"), F.lit("T"), F.lit("D")).alias("f")).collect()
    assert rows[0].h == "$110K/yr - $130K/yr; Hybrid\nHybrid\nFull-time"
    assert rows[1].h is None and rows[0].f is None and rows[1].f == "T | D" and rows[2].f is None


def test_gazetteer_join_priority(spark):
    from hirelens.operators.enrich import resolve_countries
    gaz = spark.createDataFrame([("paris", "France", 1), ("paris texas", "United States", 0)],
                                "key string, country string, priority int")
    df = spark.createDataFrame([(1, "Paris, Texas"), (2, "Greater Paris Area"), (3, "Nowhere")], "id int, location string")
    out = {r.id: r.country for r in resolve_countries(df, "location", gaz).collect()}
    assert out == {1: "United States", 2: "France", 3: "Unknown"}


def test_salary_steps_run_once(spark):
    """A text is split once, not once a sentence, and one pattern finds the places with their groups."""
    df = spark.createDataFrame([("Pay: 90,000 USD per year. Remote.",)], "t string")
    plan = S.with_best_salary(df, F.col("t"), "best")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(S.SENTENCE_SPLIT) == 1
    assert plan.count("(?iu)") == 1


def test_salary_places_with_control_characters(spark):
    """Characters that mark places and groups may stand in a text; offsets stay those of the text."""
    df = spark.createDataFrame([("Pay: 90,000 USD \u0001 \u0002 and more",)], "t string")
    best = df.select(S.extract_salary("t").alias("b")).first()["b"]
    assert (best["single_salary"], best["currency_token"], best["at"], best["end"]) == (90000.0, "USD", 0, 15)


def test_lookup_is_a_map(spark):
    from hirelens.functions.literals import lookup
    d = {f"käy {i}": f"v{i}" for i in range(100)}
    rows = [(k,) for k in d] + [("käy",), ("",), (None,)]
    got = spark.createDataFrame(rows, "k string").select("k", lookup(d, F.col("k")).alias("v")).collect()
    assert all(r["v"] == d.get(r["k"]) for r in got)


def test_salary_is_one_projection(spark):
    """r04 F1 to F6, F8, F9, F11, F12: rows aren't copied from step to step, and a place after a lead word isn't looked at twice."""
    df = spark.createDataFrame([("Pay: 90,000 USD per year. Remote.",)], "t string")
    plan = S.with_best_salary(df, F.col("t"), "best")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project [") == 1
    places = df.select(F.regexp_extract_all(F.split("t", S.SENTENCE_SPLIT)[0], F.lit(S.PLACES), 1).alias("p")).first()["p"]
    assert places == ["Pay: 90,000 USD per year"]


def test_salary_pool(spark):
    """Salary sentences come first, digit or not; funding ones don't count; without any all sentences are read."""
    rows = [("Great package. We want 90,000 USD.", None), ("We want 90,000 USD.", 90000.0), ("Pay: 80,000 USD. We want 90,000 USD.", 80000.0),
            ("$ Pay: 70,000 USD.", 70000.0), ("Salary: 60,000 USD - 80,000 USD. Pay: 5,000 USD.", None), ("Pay: $5K.", 5000.0), (None, None)]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "id int, t string")
    got = {r.id: r.b for r in df.select("id", S.extract_salary("t").alias("b")).collect()}
    assert [got[i] and got[i]["single_salary"] for i in range(len(rows))] == [w for _, w in rows]
    assert (got[4]["min_salary"], got[4]["max_salary"]) == (60000.0, 80000.0)


def test_trie_deals_many_branches_into_groups():
    import re

    from hirelens.functions.trie import trie_regex
    words = [a + b for a in "abcdefghijklmnopqrstuvwxyz$é₹^-]" for b in ("", "x", "xy")]
    pattern = trie_regex(words)
    assert "(?=[" in pattern
    assert all(re.fullmatch(pattern, w) for w in words)
    assert not any(re.fullmatch(pattern, w) for w in ("", "1", "ay", "xyz", "₸"))
