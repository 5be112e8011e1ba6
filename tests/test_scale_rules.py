"""Rules that keep the library right at any size: no overridden settings, no caps, no silent fallbacks."""

import pytest
from pyspark.sql import functions as F

from hirelens import refdata as R
from hirelens.functions.header import fallback_header
from hirelens.functions.location import extract_country
from hirelens.functions.salary import extract_salary
from hirelens.operators import merge, ml, reports
from hirelens.operators.enrich import require_columns, resolve_countries


def test_session_leaves_submitted_partitions_alone(spark):
    from hirelens.session import build_session
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "4000")
        assert build_session().conf.get("spark.sql.shuffle.partitions") == "4000"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_cooccurrence_beyond_64_skills(spark):
    """70 jobs with one skill each have no pairs of different skills."""
    from hirelens import refdata as R
    empty = F.array().cast("array<string>")
    jobs = spark.range(70).select("id", *[F.array(F.concat(F.lit("s"), F.col("id").cast("string"))).alias(c) if i == 0 else empty.alias(c)
                                          for i, c in enumerate(R.SKILL_COLUMNS)])
    got = reports.skill_cooccurrence(jobs, 70).collect()
    assert len(got) == 70 and all(r.skill_a == r.skill_b and r.n == 1 for r in got)


def test_union_common_one_row_per_link(spark):
    old = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "link string, v int")
    new = spark.createDataFrame([("a", 9, "h"), ("b", 5, "h"), (None, 3, "h")], "link string, v int, header string")
    got = sorted(((r.link or "", r.v, r.header) for r in merge.union_common(old, new, ["header"]).collect()), key=repr)
    assert got == sorted([("", 3, None), ("", 3, "h"), ("a", 1, None), ("b", 5, "h")], key=repr)


@pytest.mark.parametrize(("place", "country"), [
    ("London, Ontario, Canada", "Canada"), ("Rome, New York", "United States"), ("Latin America", "Unknown"),
    ("Albuquerque, New Mexico, United States", "United States"), ("Manchester, New Hampshire, United States", "United States"),
    ("Albuquerque, New Mexico", "United States"), ("Berlin, Germany", "Germany"),
])
def test_last_part_of_a_location_decides(spark, place, country):
    assert spark.createDataFrame([(place,)], "l string").select(extract_country("l")).first()[0] == country


def test_gazetteer_join_has_no_nested_loop(spark):
    rows = spark.createDataFrame([(1, "Springfield (suburb)"), (2, "nowhere"), (3, None), (4, "Springfield, Old Town"), (5, "Old Town, Springfield")], "id int, location string")
    keys = spark.createDataFrame([("springfield", "Canada", 2), ("springfield", "United States", 1), ("old town", "Canada", 9)], "key string, country string, priority int")
    got = resolve_countries(rows, "location", keys)
    # Of a name's countries the lowest priority counts, unless a neighbour names one of the others.
    assert {r.id: r.country for r in got.collect()} == {1: "United States", 2: "Unknown", 3: "Unknown", 4: "Canada", 5: "Canada"}
    with pytest.raises(Exception, match="more than 1 words: old town"):
        resolve_countries(rows, "location", keys, max_words=1).collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize(("text", "period"), [("Pay: 9000 EUR/month", "month"), ("Salary 45 EUR/hour", "hour"), ("salary $90,000 a year", "year")])
def test_period_after_the_currency(spark, text, period):
    best = spark.createDataFrame([(text,)], "t string").select(extract_salary("t").alias("b")).first().b
    assert best is not None and best.period == period


def test_no_header_without_parts(spark):
    rows = spark.createDataFrame([("http://x.y", None, None), ("http://x.y", "t", None)], "link string, title string, d string")
    assert [r[0] for r in rows.select(fallback_header(F.col("link"), F.col("title"), F.col("d"))).collect()] == [None, "t"]


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="description, title"):
        require_columns(spark.range(1), ["title", "description"])


def test_skill_vocabulary_breaks_ties_by_name(spark):
    first, *others = R.SKILL_COLUMNS
    rows = spark.createDataFrame([(1, ["d", "b", "z"]), (2, ["a", "c", "z"]), (3, [])], "id long, s array<string>")
    silver = rows.select("id", F.col("s").alias(first), *[F.array().cast("array<string>").alias(c) for c in others])
    feats, vocab = ml.skill_features(silver, top_n=3)
    assert vocab == ["z", "a", "b"]
    got = {r["id"]: list(r["features"].toArray()) for r in feats.collect()}
    assert got == {1: [1, 0, 1], 2: [1, 1, 0], 3: [0, 0, 0]}


def _tables(spark, root, orders: int = 400):
    """The tables that postings are built from, with rows of their own."""
    def put(name, df):
        df.write.parquet(f"{root}/{name}.parquet")
    n = spark.range(orders)
    put("region", spark.createDataFrame([(0, "ASIA")], "r_regionkey long, r_name string"))
    put("nation", spark.createDataFrame([(0, 0), (1, 0)], "n_nationkey int, n_regionkey long"))
    put("customer", spark.createDataFrame([(i, f"Customer#{i}", i % 2, "AUTOMOBILE") for i in range(4)],
                                          "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"))
    put("part", spark.createDataFrame([(0, "Brand#1"), (1, "Brand#2")], "p_partkey long, p_brand string"))
    put("lineitem", n.select(F.col("id").alias("l_orderkey"), (F.col("id") % 2).alias("l_partkey")))
    put("orders", n.select(F.col("id").alias("o_orderkey"), (F.col("id") % 4).alias("o_custkey"), F.element_at(F.array(F.lit("F"), F.lit("O"), F.lit("P")), (F.col("id") % 3 + 1).cast("int")).alias("o_orderstatus"),
                           (F.col("id") * 100.0 + 50000).alias("o_totalprice"), F.lit("1-URGENT").alias("o_orderpriority"),
                           F.date_add(F.lit("1992-01-01").cast("date"), (F.col("id") * 5).cast("int")).cast("timestamp_ntz").alias("o_orderdate")))


def test_default_country_filters_a_written_table(spark, tmp_path):
    """a filter on the extraction's outcome would take in a copy of it for every use."""
    from hirelens.plans.dashboard_queries import default_country
    _tables(spark, tmp_path)
    got = default_country(spark, str(tmp_path))
    assert "regexp" not in got._jdf.queryExecution().optimizedPlan().toString()
    rows = got.collect()
    assert {r.id for r in rows} == {i for i in range(400) if i % 3 != 2} and {r.country for r in rows} == {"Unknown"}


def test_postings_are_dealt_by_rows(spark, tmp_path, monkeypatch):
    """tasks grow with the number of postings, not with the bytes shuffled before."""
    from hirelens.sources import driver_tables
    monkeypatch.setattr(driver_tables, "ROWS_A_TASK", 20, raising=False)
    _tables(spark, tmp_path)
    got = driver_tables.bronze_postings(spark, str(tmp_path))
    assert got.rdd.getNumPartitions() == 20 and got.select("id").distinct().count() == 400 == got.count()


def test_stream_runs_one_micro_batch_a_dump(spark, tmp_path, monkeypatch):
    """the number of micro-batches doesn't grow with the files that a dump has."""
    from hirelens.plans import merge_queries
    _tables(spark, tmp_path)
    ran, inner = [], merge_queries.first_of_stream
    monkeypatch.setattr(merge_queries, "first_of_stream", lambda *a, **k: ran.append(inner(*a, **k)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = merge_queries.stream_first_with_state(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(ran) == 4
    links = [r.link for r in got if r.link is not None]
    assert sorted(links) == sorted(set(links)) and len(links) == 4
