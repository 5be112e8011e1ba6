"""Operator properties: percentiles, merges, gold invariants, plan shape."""

from pyspark.sql import functions as F

from hirelens.operators import merge
from hirelens.operators.quantiles import exact_percentiles


def test_exact_percentiles_match_builtin(spark):
    # one hot key holding most rows, plus small keys and duplicate values
    df = spark.range(0, 6000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 11).cast("string")).alias("k"),
        F.floor(F.rand(7) * 500).cast("double").alias("v"))
    got = {r.k: r for r in exact_percentiles(df, ["k"], "v", [0.0, 0.25, 0.5, 0.9, 1.0],
                                             ["p0", "p25", "p50", "p90", "p100"]).collect()}
    ref = df.groupBy("k").agg(F.percentile("v", [0.0, 0.25, 0.5, 0.9, 1.0]).alias("p"), F.count("*").alias("n"))
    for r in ref.collect():
        g = got[r.k]
        assert [round(x, 9) for x in (g.p0, g.p25, g.p50, g.p90, g.p100)] == [round(x, 9) for x in r.p]
        assert g["count"] == r.n


def _batch(spark, rows, b):
    return spark.createDataFrame(rows, "link string, v int, _seq long").withColumn(merge.BATCH, F.lit(b))


def test_merge_keep_first_last_idempotent(spark):
    old = _batch(spark, [("a", 1, 1), ("b", 2, 2), (None, 9, 3), (None, 9, 4)], 0)
    new = _batch(spark, [("a", 10, 1), ("c", 30, 2), ("c", 31, 3), (None, 9, 5), (None, 8, 6)], 1)
    master = merge.dedupe(old, ["link"], "first")
    first = merge.merge_keep_first(master, new, ["link"])
    rows = sorted((r.link or "", r.v) for r in first.collect())
    assert rows == [("", 8), ("", 9), ("a", 1), ("b", 2), ("c", 30)]
    again = merge.merge_keep_first(first, new, ["link"])
    assert sorted((r.link or "", r.v) for r in again.collect()) == rows
    last = merge.merge_keep_last(merge.dedupe(old, ["link"], "last"), new, ["link"])
    assert sorted((r.link or "", r.v) for r in last.collect()) == [("", 8), ("", 9), ("a", 10), ("b", 2), ("c", 31)]
    empty = merge.merge_keep_first(master, new.limit(0), ["link"])
    assert empty.count() == master.count()


def test_pick_key(spark):
    a = spark.createDataFrame([(1, "x")], "id int, `Job URL` string")
    b = spark.createDataFrame([(1, "x")], "id int, `Job URL` string")
    assert merge.pick_key(a, b) == ["Job URL"]
    assert merge.pick_key(a.select("id"), b) is None


def test_anti_join_new_rows(spark):
    old = spark.createDataFrame([("a",), (None,)], "link string")
    new = spark.createDataFrame([("a",), ("b",), (None,)], "link string")
    assert sorted(r.link or "" for r in merge.new_rows(new, old).collect()) == ["", "b"]


def test_load_tables_idempotent(spark):
    from hirelens.sources.catalog import load_tables
    skills = spark.createDataFrame([("sql", 3), ("python", 2)], "skill string, frequency long")
    spark.sql("DROP TABLE IF EXISTS default.skills_t")
    load_tables(spark, {"skills_t": skills}, {"skills_t": ["skill"]})
    load_tables(spark, {"skills_t": skills}, {"skills_t": ["skill"]})
    held = lambda: sorted(tuple(r) for r in spark.table("default.skills_t").select("skill", "frequency").collect())
    assert held() == [("python", 2), ("sql", 3)]
    newer = spark.createDataFrame([("sql", 5)], "skill string, frequency long")
    load_tables(spark, {"skills_t": newer}, {"skills_t": ["skill"]})
    assert held() == [("python", 2), ("sql", 5)]


def test_load_writes_only_touched_partitions(spark, tmp_path):
    """Months without a new or replaced row keep their files; a month that loses its last row goes; a failed load changes nothing."""
    import pytest
    from hirelens.sources.catalog import load_table, month_part
    spark.sql("DROP TABLE IF EXISTS load_t")
    rows = [(i, f"2024-{1 + i % 4:02d}-0{1 + i % 9}", f"v{i}") for i in range(40)] + [(100, "2024-07-01", "alone"), (101, None, "undated")]
    df = spark.createDataFrame(rows, "id long, d string, v string").select("id", F.col("d").cast("date").alias("date_posted"), "v")
    load_table(df, "load_t", ["id"], month_part(), str(tmp_path / "t"))
    files = lambda: {f: f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}
    held = lambda: {r.id: (str(r.date_posted), r.v) for r in spark.table("load_t").collect()}
    before, want = files(), held()
    assert len(want) == 42
    change = spark.createDataFrame([(1, "2024-02-20", "new"), (100, "2024-03-01", "moved"), (500, "2024-03-02", "added")], "id long, d string, v string")
    change = change.select("id", F.col("d").cast("date").alias("date_posted"), "v")
    for _ in range(2):
        assert load_table(change, "load_t", ["id"], month_part()) in (["2024-02", "2024-03", "2024-07"], ["2024-02", "2024-03"])
        want |= {1: ("2024-02-20", "new"), 100: ("2024-03-01", "moved"), 500: ("2024-03-02", "added")}
        assert held() == want
    after = files()
    untouched = {f: t for f, t in before.items() if "2024-02" not in str(f) and "2024-03" not in str(f) and "2024-07" not in str(f)}
    assert untouched and untouched.items() <= after.items()
    assert not any("2024-07" in str(f) for f in after)
    bad = change.withColumn("v", F.when(F.col("id") == 500, F.raise_error(F.lit("broken row"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="broken row"):
        load_table(bad, "load_t", ["id"], month_part())
    assert files() == after and held() == want


def test_rates_source(spark):
    from hirelens.sources.files import read_rates
    rates = {r.code: r.rate for r in read_rates(spark).collect()}
    assert rates["USD"] == 1.0 and rates["EUR"] == 0.8 and len([k for k in rates if k == "USD"]) == 1
    missing = {r.code: r.rate for r in read_rates(spark, "/nonexistent/rates.json").collect()}
    assert missing == {"USD": 1.0}


def test_fill_missing_salary_only_where_missing(spark):
    from hirelens.operators.enrich import SALARY_COLUMNS, fill_missing_salary
    base = {c: None for c in SALARY_COLUMNS}
    rows = [dict(base, id=1, has_salary=True, currency_raw="USD"), dict(base, id=2, has_salary=False)]
    schema = "id int, has_salary boolean, currency_raw string, min_salary_raw double, max_salary_raw double, " \
             "single_salary_raw double, salary_period string, min_salary_annual_usd double, " \
             "max_salary_annual_usd double, avg_salary_annual_usd double, salary_confidence double"
    df = spark.createDataFrame([[r[c.split()[0]] for c in schema.split(", ")] for r in rows], schema)
    with_fb = df.withColumns({"fb_has_salary": F.lit(True), "fb_currency_raw": F.lit("EUR")})
    filled = fill_missing_salary(with_fb)
    assert "fb_currency_raw" not in filled.columns
    out = {r.id: r for r in filled.collect()}
    assert out[1].currency_raw == "USD" and out[2].currency_raw == "EUR" and out[2].has_salary


def test_drop_obfuscated_counts(spark):
    from hirelens.operators.clean import drop_obfuscated_counted
    df = spark.createDataFrame([("***", ""), ("Paris", "***"), ("--", None)], "location string, company string")
    kept, counts = drop_obfuscated_counted(df, ["location", "company"])
    assert kept.count() == 1
    assert counts.get == {"rows": 3, "dropped": 2}


def test_dedupe_hot_key(spark):
    # one link holds a third of all rows; keep-last must pick its highest (batch, seq) row
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string")))
        .alias("link"), F.col("id").alias("v"), F.col("id").alias(merge.SEQ), (F.col("id") % 2).cast("int").alias(merge.BATCH))
    out = {r.link: r.v for r in merge.dedupe(df, ["link"], "last").collect()}
    assert out["hot"] == 29997 and len(out) == 998  # last multiple of 3 with batch 1 (odd id)
    plan = merge.dedupe(df, ["link"], "last")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan  # partial aggregation, not a row_number over the hot key


def test_approx_percentiles_close_to_exact(spark):
    from hirelens.operators.quantiles import percentiles
    df = spark.range(0, 20000).select((F.col("id") % 3).cast("string").alias("k"), (F.rand(3) * 1000).alias("v"))
    ex = {r.k: r for r in percentiles(df, ["k"], "v", [0.5], ["p50"]).collect()}
    ap = {r.k: r for r in percentiles(df, ["k"], "v", [0.5], ["p50"], approx=True).collect()}
    for k in ex:
        assert abs(ex[k].p50 - ap[k].p50) < 5.0 and ex[k]["count"] == ap[k]["count"]


def test_percentiles_of_awkward_values(spark):
    """Negative values, zeros, ties, infinities, a null key, a single value: as the builtin has them."""
    import math
    import random
    r = random.Random(3)
    rows = [("mixed", r.choice([0.0, -0.0, 5.0, -3.5, 1e-300, -1e300, r.gauss(0, 1000)])) for _ in range(501)]
    rows += [("one", 7.25), ("ties", 4.0), ("ties", 4.0), ("ties", None), (None, 1.0), (None, 2.0), ("none", None),
             ("inf", float("inf")), ("inf", 1.0), ("inf", -float("inf"))]
    df = spark.createDataFrame(rows, "k string, v double")
    probs, names = [0.0, 0.1, 0.5, 0.77, 1.0], ["a", "b", "c", "d", "e"]
    got = {x.k: x for x in exact_percentiles(df, ["k"], "v", probs, names).collect()}
    want = df.where("v is not null").groupBy("k").agg(F.percentile("v", probs).alias("p"), F.count("v").alias("n")).collect()
    assert set(got) == {x.k for x in want}
    for x in want:
        assert got[x.k]["count"] == x.n
        for name, v in zip(names, x.p):
            if x.k == "inf" and name in "bd":
                continue  # between infinities: no number is right
            assert got[x.k][name] == v or math.isclose(got[x.k][name], v, rel_tol=1e-12) or (math.isnan(v) and math.isnan(got[x.k][name])), (x.k, name)


def test_grid_cells_never_fall(spark):
    from hirelens.operators.quantiles import grid_cell
    values = sorted({s * m * 10.0**e for s in (-1, 1) for m in (1, 1.00001, 2, 9.99) for e in range(-300, 300, 7)} | {0.0, 1.0, 5e-324, float("inf"), -float("inf")})
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    cells = [r.c for r in df.select("i", grid_cell(F.col("v")).alias("c")).orderBy("i").collect()]
    assert cells == sorted(cells)


def test_hot_key_is_ranked_inside_its_brackets_only(spark):
    """A hot key's values are ranked only where its brackets lie: the last windows see a small part of the rows."""
    from hirelens.operators.quantiles import grid_cell
    v = (F.col("id") * 7 % 100003).cast("double") + 20_000
    cells = spark.range(0, 100_000).select(grid_cell(v).alias("c")).groupBy("c").count()
    assert cells.agg(F.max("count")).first()[0] < 1000


def test_t_quantiles_equal_the_published_table(spark):
    from hirelens.operators.reports import t_quantile_975
    # Published two-sided 5 % points of Student's t.
    table = {1: 12.706, 2: 4.303, 3: 3.182, 4: 2.776, 5: 2.571, 6: 2.447, 7: 2.365, 8: 2.306, 9: 2.262, 10: 2.228, 11: 2.201, 12: 2.179,
             13: 2.160, 14: 2.145, 15: 2.131, 16: 2.120, 17: 2.110, 18: 2.101, 19: 2.093, 20: 2.086, 21: 2.080, 22: 2.074, 23: 2.069,
             24: 2.064, 25: 2.060, 26: 2.056, 27: 2.052, 28: 2.048, 29: 2.045, 30: 2.042, 40: 2.021, 50: 2.009, 60: 2.000, 70: 1.994,
             80: 1.990, 90: 1.987, 100: 1.984, 120: 1.980, 150: 1.976, 200: 1.972, 500: 1.965, 1000: 1.962, 10**9: 1.960}
    df = spark.createDataFrame([(v,) for v in [*table, 0]], "v long")
    got = {r.v: r.t for r in df.select("v", t_quantile_975(F.col("v")).alias("t")).collect()}
    assert {v: round(got[v], 3) for v in table} == table and got[0] is None
    edge = spark.createDataFrame([(v,) for v in range(395, 407)], "v long").select("v", t_quantile_975(F.col("v")).alias("t")).orderBy("v").collect()
    steps = [a.t - b.t for a, b in zip(edge, edge[1:])]
    assert all(abs(x - y) < 2e-7 for x, y in zip(steps, steps[1:]))  # both roads meet


def test_kmeans_steps_equal_a_plain_version(spark):
    """Lloyd's steps over distinct skill sets against numpy over single rows."""
    import numpy as np
    from hirelens import refdata as R
    from hirelens.operators import ml
    rng = np.random.default_rng(4)
    skills = ["sql", "python", "r", "excel", "tableau", "aws", "azure", "spark", "word", "looker"]
    rows = [(i, [s for s in skills if rng.random() < 0.3]) for i in range(300)]
    df = spark.createDataFrame([(i, s, [], [], []) for i, s in rows], "id long, " + ", ".join(f"{c} array<string>" for c in R.SKILL_COLUMNS))
    table = ml.fit_centres(df, max_iter=6)
    vocab = ml.skill_vocabulary(df)
    x = np.array([[s in own for s in vocab] for _, own in rows], float)
    c = np.array([[s in R.CLUSTER_SIGNATURES[n] for s in vocab] for n in R.CLUSTER_NAMES], float)
    near = lambda: np.argmin(np.round(((c**2).sum(1)[None, :] - 2 * x @ c.T), 9), axis=1)
    for _ in range(6):
        a = near()
        c = np.array([x[a == j].mean(axis=0) if (a == j).any() else c[j] for j in range(len(c))])
    got = {r.id: r.cluster for r in ml.with_clusters(df, table).collect()}
    assert [got[i] for i, _ in rows] == near().tolist()
    learned, names = ml.read_centres(ml.fit_centres(df, max_iter=2, learned_start=True))
    assert len(learned) == R.N_CLUSTERS and names == R.CLUSTER_NAMES


def test_pca_is_the_covariances_first_two_directions(spark):
    import numpy as np
    from hirelens import refdata as R
    from hirelens.operators import ml
    rng = np.random.default_rng(5)
    skills = ["sql", "python", "r", "excel", "tableau", "aws"]
    rows = [(i, [s for j, s in enumerate(skills) if rng.random() < 0.1 + 0.13 * j]) for i in range(200)]
    df = spark.createDataFrame([(i, s, [], [], []) for i, s in rows], "id long, " + ", ".join(f"{c} array<string>" for c in R.SKILL_COLUMNS))
    vocab = ml.skill_vocabulary(df)
    x = np.array([[s in own for s in vocab] for _, own in rows], float)
    _, vectors = np.linalg.eigh(np.cov(x.T))
    want = x @ vectors[:, ::-1][:, :2]
    got = np.array([[r.x, r.y] for r in ml.skill_projection(df).orderBy("id").collect()])
    for j in range(2):
        assert min(np.abs(got[:, j] - want[:, j]).max(), np.abs(got[:, j] + want[:, j]).max()) < 1e-9


def test_merge_without_key_is_full_row_dedup(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "v int, w string")
    b = spark.createDataFrame([(2, "y"), (3, "z"), (3, "z")], "v int, w string")
    key = merge.pick_key(a, b)
    assert key is None
    out = sorted(tuple(r) for r in merge.merge_keep_first(a, b, key).collect())
    assert out == [(1, "x"), (2, "y"), (3, "z")]
    again = sorted(tuple(r) for r in merge.merge_keep_first(merge.merge_keep_first(a, b, key), b, key).collect())
    assert again == out
