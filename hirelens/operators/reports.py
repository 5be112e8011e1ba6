"""Report queries (dashboard, status page, EDA notebook) as DataFrame operators.

A7-A22, W1-W4, T1-T7, P8-P11.  Conventions:

* Top-k always has an explicit tie-break (name ascending, SURVEY Q12), so it
  plans as ``TakeOrderedAndProject`` and is deterministic.
* Per-group top-k ranks *aggregated* rows (one per group × item), never raw
  rows, so a hot group costs one row per item, not a third of the table.
* Windows without a partition key only run over tiny, bounded inputs
  (one row per month / level / bucket); each says why.
* Global statistics (quantile fences, histogram range) are one-row
  aggregates cross-joined back: a 1-row broadcast, bounded by construction.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens.functions.literals import lit_array
from hirelens.functions.skills import all_skills
from hirelens.operators.gold import job_skills
from hirelens.operators.quantiles import exact_percentiles


# ---------------------------------------------------------------- A7 / A8 / A9
def counts_by(df: DataFrame, col: str, name: str = "job_count", drop_null: bool = True) -> DataFrame:
    """Row count per value (pandas-style: null keys dropped unless asked)."""
    src = df.where(F.col(col).isNotNull()) if drop_null else df
    return src.groupBy(col).agg(F.count(F.lit(1)).alias(name))


def status_scalars(df: DataFrame) -> DataFrame:
    """Total rows, distinct companies, distinct countries, latest date — one job."""
    return df.agg(
        F.count(F.lit(1)).alias("total_jobs"),
        F.countDistinct("company").alias("companies"),
        F.countDistinct("country").alias("countries"),
        F.max("date_posted").alias("last_date"),
    )


def recent_companies(df: DataFrame, k: int = 5) -> DataFrame:
    """A9 + T1: companies by their latest posting date, newest first."""
    return (df.where(F.col("company").isNotNull()).groupBy("company")
            .agg(F.max("date_posted").alias("last_posting"))
            .orderBy(F.col("last_posting").desc(), F.col("company")).limit(k))


def top_values(df: DataFrame, col: str, k: int, name: str = "postings") -> DataFrame:
    """Most frequent values (ties by value)."""
    return counts_by(df, col, name, drop_null=False).orderBy(F.col(name).desc(), F.col(col)).limit(k)


def latest_dates(df: DataFrame, k: int = 30) -> DataFrame:
    """A7 + T2: postings per date, last ``k`` dates."""
    return counts_by(df, "date_posted").orderBy(F.col("date_posted").desc()).limit(k)


# ---------------------------------------------------------------- A10 / A11
def cents_avg(c: str | Column) -> Column:
    """Mean of a money column summed as exact integer cents.

    Floating sums depend on summation order (partition layout); integer cents
    do not, so the mean is the same on any cluster layout and in any engine.
    """
    col = F.col(c) if isinstance(c, str) else c
    cents = F.floor(col * 100 + 0.5).cast("long")
    return F.sum(cents) / F.count(cents) / 100


def mean_salary_by(df: DataFrame, col: str, salary: str = "avg_salary_annual_usd") -> DataFrame:
    """A10: mean salary per group rounded to whole dollars."""
    return (df.groupBy(col).agg(cents_avg(salary).alias("_m"))
            .select(col, F.floor(F.col("_m") + 0.5).cast("double").alias("avg_salary")))


def salary_by_date(df: DataFrame, salary: str = "avg_salary_annual_usd") -> DataFrame:
    """Mean salary per posting date over positive salaries."""
    return df.where(F.col(salary) > 0).groupBy("date_posted").agg(cents_avg(salary).alias("avg_salary"))


# ---------------------------------------------------------------- A12 / A13 / W1
def monthly_counts(df: DataFrame, date_col: str = "date_posted") -> DataFrame:
    """A12 + W1: postings per month and the centred 3-month rolling mean.

    The window has no partition key on purpose: its input is one row per
    month (a few hundred rows at most), so one task is the right plan.
    """
    months = (df.where(F.col(date_col).isNotNull())
              .groupBy(F.trunc(F.col(date_col), "month").alias("month"))
              .agg(F.count(F.lit(1)).alias("jobs")))
    w = Window.orderBy("month").rowsBetween(-1, 1)
    return months.withColumn("smoothed_jobs", F.avg("jobs").over(w))


def monthly_focus_skill_counts(silver: DataFrame, focus: list[str], date_col: str = "date_posted") -> DataFrame:
    """Per month and focus skill, postings with a skill containing the focus word."""
    skills = all_skills()
    hit = F.filter(lit_array(focus), lambda f: F.exists(skills, lambda s: F.lower(s).contains(f)))
    return (silver.where(F.col(date_col).isNotNull())
            .select(F.trunc(F.col(date_col), "month").alias("month"), F.explode(hit).alias("focus_skill"))
            .groupBy("month", "focus_skill").agg(F.count(F.lit(1)).alias("jobs")))


# ---------------------------------------------------------------- A14 / A15 / W4
def proportions(df: DataFrame, col: str) -> DataFrame:
    """A14 + W4: value counts (nulls included) and share of the total.

    ``sum over ()`` runs on the aggregated rows (one per value), so it is tiny.
    """
    c = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


_Z975 = 1.959963984540054
#: Degrees of freedom up to which the finite series is summed; beyond, five terms in 1/ν are exact to 1e-11.
_SERIES_DF = 400


def t_two_sided(t: Column, v: Column) -> Column:
    """P(|T| <= t) for a Student t with a whole number ``v`` of degrees of freedom.

    The incomplete beta function at half-integers is a finite sum in the cosine
    of θ = atan(t / sqrt(v)): its terms run over 1, 3, 5, … for odd v and over
    0, 2, 4, … for even v.
    """
    theta = F.atan(t / F.sqrt(v))
    odd = v % 2 == 1
    c2 = F.cos(theta) * F.cos(theta)
    n = F.floor((v - F.when(odd, 1.0).otherwise(0.0)) / 2)  # terms
    # Odd: cos, then × 2/3 cos², 4/5 cos², …  Even: 1, then × 1/2 cos², 3/4 cos², …
    first = F.when(odd, F.cos(theta)).otherwise(F.lit(1.0))
    steps = F.when(n > 1, F.sequence(F.lit(1).cast("long"), n - 1)).otherwise(F.array().cast("array<bigint>"))
    start = F.struct(first.alias("term"), first.alias("sum"))

    def add(acc: Column, k: Column) -> Column:
        ratio = F.when(odd, 2.0 * k / (2.0 * k + 1.0)).otherwise((2.0 * k - 1.0) / (2.0 * k))
        term = acc["term"] * ratio * c2
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    total = F.when(n > 0, F.aggregate(steps, start, add, lambda acc: acc["sum"])).otherwise(F.lit(0.0))
    return F.when(odd, (theta + F.sin(theta) * total) * (2.0 / 3.141592653589793)).otherwise(F.sin(theta) * total)


def t_quantile_975(df_col: Column) -> Column:
    """Student-t 0.975 quantile for a whole number of degrees of freedom from 1 on.

    Up to 400 degrees the distribution function is inverted by halving an
    interval (the quantile lies between the normal's and 12.71, that of one
    degree); beyond, the Cornish-Fisher expansion in 1/ν is exact to 1e-11.
    """
    v = df_col.cast("double")
    z = _Z975
    g = [z, (z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96, (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
         (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160]
    far = reduce(lambda acc, c: acc / v + F.lit(c), reversed(g[:-1]), F.lit(g[-1]))
    start = F.struct(F.lit(1.9).alias("lo"), F.lit(12.71).alias("hi"))

    def halve(acc: Column, _k: Column) -> Column:
        mid = (acc["lo"] + acc["hi"]) / 2
        low = t_two_sided(mid, v) < 0.95
        return F.struct(F.when(low, mid).otherwise(acc["lo"]).alias("lo"), F.when(low, acc["hi"]).otherwise(mid).alias("hi"))

    near = F.aggregate(F.sequence(F.lit(1), F.lit(45)), start, halve, lambda acc: (acc["lo"] + acc["hi"]) / 2)
    return F.when(v > _SERIES_DF, far).when(v >= 1, near)


def mean_ci95(df: DataFrame, group: str, levels: list[str] | None = None, value: str = "avg_salary_annual_usd",
              min_n: int = 10) -> DataFrame:
    """Mean, n, sample std and 95 % t half-width per level (listed levels or all, n ≥ min_n ≥ 2)."""
    listed = df.where(F.col(group).isin(levels)) if levels is not None else df.where(F.col(group).isNotNull())
    stats = (listed.where(F.col(value).isNotNull())
             .groupBy(group).agg(cents_avg(value).alias("mean"), F.count(F.lit(1)).alias("n"),
                                 F.stddev_samp(value).alias("std")))
    t = t_quantile_975(F.col("n") - 1)
    return (stats.where(F.col("n") >= max(2, min_n))
            .withColumn("t", t)
            .withColumn("half_width", F.col("t") * F.col("std") / F.sqrt(F.col("n").cast("double"))))


def suppressed_levels(df: DataFrame, group: str, levels: list[str], value: str = "avg_salary_annual_usd",
                      min_n: int = 10) -> DataFrame:
    """A15 (second output): listed levels with fewer than ``min_n`` salaries."""
    lv = df.sparkSession.createDataFrame([(x,) for x in levels], f"{group} string")
    n = df.where(F.col(value).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    return lv.join(n, group, "left").where(F.coalesce(F.col("n"), F.lit(0)) < min_n)


# ---------------------------------------------------------------- A16 / A17 / A18
def _global(df: DataFrame) -> DataFrame:
    return df.withColumn("_all", F.lit(1))


def iqr_outliers(df: DataFrame, value: str = "avg_salary_annual_usd", k: float = 2.0) -> DataFrame:
    """Q1, Q3, threshold Q3 + k·IQR and the number of values above it."""
    q = exact_percentiles(_global(df), ["_all"], value, [0.25, 0.75], ["q1", "q3"], count_name=None)
    q = q.withColumn("threshold", F.col("q3") + F.lit(k) * (F.col("q3") - F.col("q1")))
    above = (_global(df).join(F.broadcast(q.select("_all", "threshold")), "_all")
             .agg(F.count_if(F.col(value) > F.col("threshold")).alias("n_outliers")))
    return q.drop("_all").crossJoin(above)


def box_stats(df: DataFrame, group: str, value: str = "avg_salary_annual_usd") -> DataFrame:
    """Five numbers per group plus 1.5·IQR whisker limits (clipped to the data)."""
    q = exact_percentiles(df.where(F.col(group).isNotNull()), [group], value, [0.0, 0.25, 0.5, 0.75, 1.0],
                          ["min", "q1", "median", "q3", "max"], count_name="n")
    iqr = F.col("q3") - F.col("q1")
    return (q.withColumn("lower_whisker", F.greatest(F.col("min"), F.col("q1") - 1.5 * iqr))
            .withColumn("upper_whisker", F.least(F.col("max"), F.col("q3") + 1.5 * iqr)))


def histogram(df: DataFrame, value: str = "avg_salary_annual_usd", bins: int = 30) -> DataFrame:
    """Equal-width bins between the global min and max (max falls in the last bin)."""
    v = df.where(F.col(value).isNotNull()).select(F.col(value).alias("_v"))
    rng = v.agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))  # one row
    b = F.least(F.lit(bins), F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins) + 1)
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(1)).otherwise(b)
    return (v.crossJoin(F.broadcast(rng)).select(b.cast("int").alias("bin"), "_lo", "_hi")
            .groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"))
            .select("bin", (F.col("_lo") + (F.col("bin") - 1) * (F.col("_hi") - F.col("_lo")) / bins).alias("bin_start"),
                    "n"))


# ---------------------------------------------------------------- A19 / J5 / P10
def top_keys(df: DataFrame, col: str, k: int, weight: str | None = None) -> DataFrame:
    """Top-k values of ``col`` by row count (or summed ``weight``), ties by value."""
    agg = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(agg.alias("_w"))
            .orderBy(F.col("_w").desc(), F.col(col)).limit(k).select(col))


def crosstab_top(df: DataFrame, row: str, col: str, k: int) -> DataFrame:
    """Counts by (row, col) for the top-k ``row`` values (semi join to the top-k)."""
    keep = df.join(F.broadcast(top_keys(df, row, k)), row, "left_semi")  # k rows: bounded
    return keep.groupBy(row, col).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- A20-A22 / J9
def skill_cooccurrence(silver: DataFrame, k: int = 20) -> DataFrame:
    """Co-occurrence counts among the top-k skills; the diagonal is own support.

    One silver row is one job, so a job's top skills are an array of its own row:
    no shuffle by job.  Equal arrays are counted first, and only distinct ones
    are expanded to their pairs.  Any ``k`` will do.
    """
    own = silver.select(F.array_distinct(all_skills()).alias("_s"))
    top = (own.select(F.explode("_s").alias("skill")).where(F.col("skill") != "").groupBy("skill").agg(F.count(F.lit(1)).alias("_n"))
           .orderBy(F.col("_n").desc(), F.col("skill")).limit(k).agg(F.collect_list("skill").alias("_top")))  # one row of k names
    sets = (own.crossJoin(F.broadcast(top)).select(F.array_sort(F.array_intersect("_s", "_top")).alias("_m"))
            .where(F.size("_m") > 0).groupBy("_m").agg(F.count(F.lit(1)).alias("_c")))
    pairs = sets.select("_c", "_m", F.explode("_m").alias("skill_a")).select("_c", "skill_a", F.explode("_m").alias("skill_b"))
    return pairs.groupBy("skill_a", "skill_b").agg(F.sum("_c").alias("n"))


def country_skill_top(counts: DataFrame, n_countries: int = 10, n_skills: int = 15) -> tuple[list, list]:
    """Axes of the heat-map: top countries and skills by summed count (≤ 25 values to the driver)."""
    countries = [r[0] for r in top_keys(counts, "country", n_countries, weight="count").collect()]
    skills = [r[0] for r in top_keys(counts, "skill", n_skills, weight="count").collect()]
    return sorted(countries), sorted(skills)


def country_skill_pivot(counts: DataFrame, n_countries: int = 10, n_skills: int = 15) -> DataFrame:
    """Country × skill matrix of ``count`` (0 when absent), sorted axes."""
    countries, skills = country_skill_top(counts, n_countries, n_skills)
    sub = counts.where(F.col("country").isin(countries) & F.col("skill").isin(skills) & (F.col("count") > 0))
    return (sub.groupBy("country").pivot("skill", skills).agg(F.first("count"))
            .fillna(0, subset=skills))


def dense_matrix(pairs: DataFrame, row: str, col: str, value: str, rows: DataFrame, cols: DataFrame) -> DataFrame:
    """Every (row, col) of two small axis tables, with 0 for missing pairs."""
    grid = F.broadcast(rows.select(row)).crossJoin(F.broadcast(cols.select(col)))  # |rows|·|cols|, bounded by k
    return grid.join(pairs, [row, col], "left").select(row, col, F.coalesce(F.col(value), F.lit(0)).alias(value))


# ---------------------------------------------------------------- W2
def top_k_per_group(pairs: DataFrame, group: list[str], item: str, weight: str, k: int) -> DataFrame:
    """The ``k`` heaviest items per group (ties by item), ranked over aggregated rows."""
    w = Window.partitionBy(*group).orderBy(F.col(weight).desc(), F.col(item))
    return pairs.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


def skill_counts_by(silver: DataFrame, group: list[str]) -> DataFrame:
    """Job-skill rows per (group…, skill) — the input of W2 / A4 / A5."""
    return job_skills(silver, extra=group).groupBy(*group, "skill").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- P8 / P9 / P11
def filter_postings(silver: DataFrame, skill: str = "All", company: str = "All", work_type: str = "All",
                    employment_type: str = "All") -> DataFrame:
    """Dashboard filters; 'All' disables one.  Skill filter is a semi join (Q13)."""
    out = silver
    if company != "All":
        out = out.where(F.col("company") == F.lit(company))
    if work_type != "All":
        out = out.where(F.col("work_type") == F.lit(work_type))
    if employment_type != "All":
        out = out.where(F.col("employment_type") == F.lit(employment_type))
    if skill != "All":
        out = out.where(F.array_contains(all_skills(), F.lit(skill)))  # row-local: no join needed on silver
    return out


def exclude_not_specified(df: DataFrame, col: str) -> DataFrame:
    """Drop values mentioning 'not specified' (case-insensitive); nulls kept."""
    return df.where(~F.coalesce(F.lower(F.col(col)).contains("not specified"), F.lit(False)))




# ---------------------------------------------------------------- P12 / P13
def columns_like(df: DataFrame, fragment: str) -> list[str]:
    """Column names containing ``fragment`` (schema only, no job)."""
    return [c for c in df.columns if fragment in c]


def for_display(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename columns for presentation."""
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})
