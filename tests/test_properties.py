"""Invariants from the test strategy: keys, totals, ordering of quantiles, partitions of the input."""

import pytest
from pyspark.sql import functions as F

from hirelens.operators import clean, gold
from hirelens.plans.common import silver

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    s = silver(spark, SF)
    return s, gold.build_gold(s)


KEYS = {"skills": ["skill"], "job_skills": ["job_id", "skill", "skill_category"], "companies": ["company"],
        "country_skill_counts": ["country", "skill"], "experience_skill_counts": ["experience_level", "skill"],
        "salary_skill_stats": ["skill"], "job_postings": ["id"]}


@pytest.mark.parametrize("name", sorted(KEYS))
def test_gold_keys_unique(tables, name):
    _, g = tables
    df = g[name]
    assert df.count() == df.select(*KEYS[name]).distinct().count()


def test_frequency_total_equals_job_skills(tables):
    _, g = tables
    assert g["skills"].agg(F.sum("frequency")).first()[0] == g["job_skills"].count()


def test_quantiles_ordered(tables):
    _, g = tables
    bad = g["salary_skill_stats"].where((F.col("p25") > F.col("median")) | (F.col("median") > F.col("p75")))
    assert bad.count() == 0


def test_survivors_plus_dropped_is_input(spark):
    df = spark.createDataFrame([("a", "x"), ("**", None), (None, "  "), ("b", "**")], "location string, company string")
    kept = clean.drop_obfuscated_rows(df, ["location", "company"])
    dropped = df.subtract(kept)
    assert kept.count() + dropped.count() == df.count() and kept.count() == 2


def test_no_cartesian_products(spark):
    import __spark_entry__ as E
    for name in ["skill_cooccurrence", "salary_histogram", "country_skill_matrix", "salary_outliers",
                 "experience_by_top_country", "company_summary"]:
        plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan, name
