"""Keyword tables by join against single regexes, and caller-supplied tables in the enrichment."""

from __future__ import annotations

import random

import pytest
import regex
from pyspark.sql import functions as F

from hirelens import refdata as R
from hirelens.functions.skills import extract_skills, keyword_regex
from hirelens.operators.keywords import default_keywords, match_keywords, with_keywords

TEXTS = ["Python, C++ and SQL; Azure; SAS", None, "", "Power BI, c/c++, unix/linux", "asp.net or .NET; vue.js", ".net", "c# is not c", "r", "R&D in r.",
         "no-sql t-sql pl/sql", "power  bi", "scikit-learn/scikit", "node.js.", "(sql)", "sql_x", "+sql", "Ünïcode sql", "java javascript", "git,git,git"]


def found_by_regex(text, keywords):
    return sorted({(c, k) for c, k in keywords if text is not None and regex.search(keyword_regex(k), text.lower())})


def table(spark, keywords):
    return spark.createDataFrame(keywords, "category string, keyword string")


def test_builtin_keywords_as_a_table_equal_the_regex_form(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id long, t string")
    want = {r.id: r for r in df.select("id", *[v.alias(k) for k, v in extract_skills(F.col("t")).items()]).collect()}
    got = with_keywords(df, "id", F.col("t"), default_keywords(spark), R.SKILL_COLUMNS).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        assert [r[c] for c in R.SKILL_COLUMNS] == [want[r.id][c] for c in R.SKILL_COLUMNS], r


def test_fifty_thousand_keywords(spark):
    rng = random.Random(3)
    syllables = ["ba", "co", "du", "fe", "gi", "ho", "ju", "ka", "lo", "mi", "nu", "pe", "ra", "so", "tu"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(2, 4)))
    sign = lambda: rng.choice([" ", " ", "-", "/", ".", " & "])
    keywords = {(rng.choice("ab"), word() + "".join(sign() + word() for _ in range(rng.choice([0, 0, 1, 2])))) for _ in range(75_000)}
    keywords |= {("a", ".net"), ("b", "c++"), ("b", "(x)"), ("a", "#1"), ("b", "batu co."), ("a", "-kalo-")}
    keywords = sorted(keywords)
    assert len(keywords) >= 50_000
    texts = ["".join(word() + sign() for _ in range(12)) + " " + rng.choice(keywords)[1] + rng.choice([" ", ".", "x", "_", " end"]) for _ in range(40)]
    texts += [".net", "asp.net", "x .net", "c++", "c+++", "(x)", "a(x)", "(x)b", " (x) ", "#1", "batu co.", "batu co.x", "batu co..", "z -kalo- z", "z-kalo-z", "--kalo--"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    got = {}
    for r in match_keywords(df, ["id"], F.col("t"), table(spark, keywords)).collect():
        got.setdefault(r.id, set()).add((r.category, r.canonical))
    for i, t in enumerate(texts):
        near = [(c, k) for c, k in keywords if k in t.lower()]
        assert sorted(got.get(i, set())) == found_by_regex(t, near), t
    assert sum(map(len, got.values())) > 50


def test_keywords_that_cannot_be_found_are_refused(spark):
    df = spark.createDataFrame([(1, "a b c d e")], "id long, t string")
    for bad in ("...", "a b c d e", "a" + "." * 9):
        with pytest.raises(Exception, match="keyword without a letter"):
            match_keywords(df, ["id"], F.col("t"), table(spark, [("x", bad), ("x", "a")])).collect()
    assert match_keywords(df, ["id"], F.col("t"), table(spark, [("x", "")])).count() == 0
    assert match_keywords(df.limit(0), ["id"], F.col("t"), table(spark, [("x", "a")])).count() == 0


def test_hot_keyword_is_spread(spark):
    df = spark.range(300).select("id", F.lit("python and sql").alias("t"))
    hits = match_keywords(df, ["id"], F.col("t"), table(spark, [("x", "python"), ("y", "python")]), salts=8)
    assert hits.count() == 600
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan


def test_enrich_takes_the_callers_tables(spark):
    """2.14: keywords as lists or as a table, a gazetteer and rates; what is not given stays as it is."""
    from hirelens.operators.enrich import enrich
    rows = [(1, "Analyst", "We use Quxlang and python. Salary: £50,000 per year.", "Springfield"), (2, "Analyst", "Great team", "Paris"), (3, "Analyst", "quxlang/sql", None)]
    bronze = spark.createDataFrame(rows, "id long, title string, description string, location string").withColumn("company", F.lit("c"))
    lists = {c: (["quxlang", "python"] if c == R.SKILL_COLUMNS[0] else kws) for c, kws in R.SKILL_CATEGORIES.items()}
    keywords = spark.createDataFrame([(R.SKILL_COLUMNS[0], "quxlang", "Qux"), (R.SKILL_COLUMNS[0], "python", "python")], "category string, keyword string, canonical string")
    gazetteer = spark.createDataFrame([("springfield", "Kenya", 1)], "key string, country string, priority int")
    plain = {r.id: r for r in enrich(bronze).collect()}
    assert plain[1][R.SKILL_COLUMNS[0]] == ["python"] and plain[1].country == "Unknown" and plain[2].country == "France"
    by_list = {r.id: r for r in enrich(bronze, keywords=lists).collect()}
    assert by_list[1][R.SKILL_COLUMNS[0]] == ["python", "quxlang"] and by_list[3][R.SKILL_COLUMNS[0]] == ["quxlang"]
    by_table = {r.id: r for r in enrich(bronze, keywords=keywords, gazetteer=gazetteer, rates={"GBP": 0.5}).collect()}
    assert by_table[1][R.SKILL_COLUMNS[0]] == ["Qux", "python"] and by_table[3][R.SKILL_COLUMNS[0]] == ["Qux"] and by_table[2][R.SKILL_COLUMNS[0]] == []
    assert by_table[1].country == "Kenya" and by_table[2].country == "Unknown" and by_table[3].country == "Unknown"
    assert by_table[1].avg_salary_annual_usd == 100_000 and plain[1].avg_salary_annual_usd == 50_000 / R.synthetic_rates()["GBP"]
    assert set(by_table[1].asDict()) == set(plain[1].asDict())


def test_bitmap_grows_with_the_keywords(spark):
    """a full bitmap lets every candidate through; the hits don't depend on its size."""
    from hirelens.operators.keywords import bitmap_bits
    assert bitmap_bits(1) == 1 << 18 and bitmap_bits(900_000) >= 16 * 900_000
    df = spark.createDataFrame([(1, "python and Customer#7."), (2, "c++, sql")], "id long, t string")
    words = table(spark, [("x", "python"), ("x", "c++"), ("y", "customer#7")])
    hits = [sorted(map(tuple, match_keywords(df, ["id"], F.col("t"), words, bits=b).collect())) for b in (64, None)]
    assert hits[0] == hits[1] and len(hits[0]) == 3


def test_candidates_are_cut_once(spark):
    """r04 F7, F10: texts are cut into words in one place of the plan, and candidates are not compared with each other."""
    from pyspark.sql import functions as F

    from hirelens.operators.keywords import WORD, match_keywords
    df = spark.createDataFrame([(1, "python, c++ (c++) and power bi"), (2, "  "), (3, None), (4, "c++ c++ c++")], "id int, t string").repartition(3, "id")
    keys = spark.createDataFrame([("a", "c++"), ("a", "power bi"), ("b", "python"), ("b", "(c++)")], "category string, keyword string")
    hits = match_keywords(df, ["id"], F.concat("t", F.lit("")), keys)
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(_x") == 1 and not any("size(regexp_extract_all(lower(concat" in l for l in plan.splitlines())
    assert "array_distinct(concat" not in plan
    assert {tuple(r) for r in hits.collect()} == {(1, "b", "python"), (1, "a", "c++"), (1, "a", "power bi"), (1, "b", "(c++)"), (4, "a", "c++")}
