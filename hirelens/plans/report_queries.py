"""Dashboard / status page / EDA reports over silver."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelens.functions.skills import all_skills
from hirelens.operators import gold
from hirelens.operators import reports as Q
from hirelens.plans.common import m2, money, silver
from hirelens.plans.expected_sql import cte
from hirelens.plans.registry import register

E = cte()
LEVELS = ["Entry-Level", "Mid-Level", "Senior"]
LEVELS_AND_NONE = [*LEVELS, "Executive"]  # no posting has the last one
FOCUS_SKILLS = ["python", "sql", "aws", "excel", "power"]
US = "United States"


# ------------------------------------------------------------------ status page
@register("status_scalars", E + """
SELECT count(*) AS total_jobs, count(DISTINCT company) AS companies, count(DISTINCT country) AS countries,
       max(date_posted) AS last_date FROM exp_postings""")
def status_scalars(spark, d):
    return Q.status_scalars(silver(spark, d))


@register("recent_companies", E + """
SELECT company, max(date_posted) AS last_posting FROM exp_postings WHERE company IS NOT NULL
GROUP BY company ORDER BY last_posting DESC, company LIMIT 5""")
def recent_companies(spark, d):
    return Q.recent_companies(silver(spark, d), 5)


@register("common_titles", E + """
SELECT title, count(*) AS postings FROM exp_postings GROUP BY title ORDER BY postings DESC, title LIMIT 5""")
def common_titles(spark, d):
    return Q.top_values(silver(spark, d), "title", 5)


@register("monthly_counts_smoothed", E + """
, m AS (SELECT date_trunc('month', date_posted) AS month, count(*) AS jobs FROM exp_postings
        WHERE date_posted IS NOT NULL GROUP BY 1)
SELECT CAST(month AS DATE) AS month, jobs,
       avg(jobs) OVER (ORDER BY month ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS smoothed_jobs FROM m""")
def monthly_counts_smoothed(spark, d):
    return Q.monthly_counts(silver(spark, d))


# ------------------------------------------------------------------ dashboard
@register("date_counts_last30", E + """
SELECT date_posted, count(*) AS job_count FROM exp_postings WHERE date_posted IS NOT NULL
GROUP BY date_posted ORDER BY date_posted DESC LIMIT 30""")
def date_counts_last30(spark, d):
    return Q.latest_dates(silver(spark, d), 30)


@register("counts_by_work_type", E + """
SELECT work_type, count(*) AS job_count FROM exp_postings WHERE work_type IS NOT NULL GROUP BY work_type""")
def counts_by_work_type(spark, d):
    return Q.counts_by(silver(spark, d), "work_type")


@register("country_counts", E + """
SELECT country, count(*) AS job_count FROM exp_postings GROUP BY country ORDER BY job_count DESC, country LIMIT 1000""")
def country_counts(spark, d):
    s = silver(spark, d)
    return (s.groupBy("country").agg(F.count(F.lit(1)).alias("job_count"))
            .orderBy(F.col("job_count").desc(), F.col("country")).limit(1000))


@register("top_skills", E + """
SELECT skill, count(*) AS frequency FROM exp_job_skills GROUP BY skill ORDER BY frequency DESC, skill LIMIT 20""")
def top_skills(spark, d):
    return gold.skills(silver(spark, d)).orderBy(F.col("frequency").desc(), F.col("skill")).limit(20)


@register("us_top_skills", E + f"""
SELECT s.skill, count(*) AS count FROM exp_job_skills s JOIN exp_postings p ON p.id = s.job_id
WHERE p.country = '{US}' GROUP BY s.skill ORDER BY count DESC, skill LIMIT 10""")
def us_top_skills(spark, d):
    c = gold.country_skill_counts(silver(spark, d))
    return (c.where(F.col("country") == US).select("skill", "count")
            .orderBy(F.col("count").desc(), F.col("skill")).limit(10))


_STATS = """(SELECT s.skill, quantile_cont(p.avg_salary_annual_usd, 0.25) AS p25,
       quantile_cont(p.avg_salary_annual_usd, 0.5) AS median,
       quantile_cont(p.avg_salary_annual_usd, 0.75) AS p75, count(*) AS count
FROM (SELECT DISTINCT job_id, skill FROM exp_job_skills) s JOIN exp_postings p ON p.id = s.job_id
WHERE p.avg_salary_annual_usd IS NOT NULL GROUP BY s.skill)"""


@register("top_paid_skills", E + f"""
SELECT skill, {m2('median')} AS median, {m2('p75')} AS p75, {m2('p25')} AS p25, count FROM {_STATS}
ORDER BY median DESC, skill LIMIT 20""")
def top_paid_skills(spark, d):
    t = gold.salary_skill_stats(silver(spark, d))
    return (t.orderBy(F.col("median").desc(), F.col("skill")).limit(20)
            .select("skill", money("median"), money("p75"), money("p25"), "count"))


@register("salary_by_experience", E + """
SELECT experience_level, floor(sum(floor(avg_salary_annual_usd * 100 + 0.5)) / count(avg_salary_annual_usd) / 100 + 0.5)
       AS avg_salary FROM exp_postings GROUP BY experience_level""")
def salary_by_experience(spark, d):
    return Q.mean_salary_by(silver(spark, d), "experience_level")


@register("salary_by_date", E + f"""
SELECT date_posted, {m2('sum(CAST(floor(avg_salary_annual_usd * 100 + 0.5) AS BIGINT)) / count(*) / 100')} AS avg_salary FROM exp_postings
WHERE avg_salary_annual_usd > 0 GROUP BY date_posted""")
def salary_by_date(spark, d):
    return Q.salary_by_date(silver(spark, d)).select("date_posted", money("avg_salary"))


@register("company_options", E + """
SELECT DISTINCT company FROM exp_postings WHERE company IS NOT NULL ORDER BY company""")
def company_options(spark, d):
    return silver(spark, d).where(F.col("company").isNotNull()).select("company").distinct().orderBy("company")


@register("filter_postings", E + """
SELECT p.id, p.company, p.avg_salary_annual_usd IS NOT NULL AS has_salary_usd FROM exp_postings p
WHERE p.work_type = 'Remote' AND p.employment_type = 'Full-time'
  AND EXISTS (SELECT 1 FROM exp_job_skills s WHERE s.job_id = p.id AND s.skill = 'python')""")
def filter_postings(spark, d):
    f = Q.filter_postings(silver(spark, d), skill="python", work_type="Remote", employment_type="Full-time")
    return f.select("id", "company", F.col("avg_salary_annual_usd").isNotNull().alias("has_salary_usd"))


@register("adhoc_sql", E + """
SELECT country, count(*) AS n FROM exp_postings WHERE experience_level = 'Senior' AND work_type <> 'Remote'
GROUP BY country HAVING count(*) >= 2""")
def adhoc_sql(spark, d):
    from hirelens.sources.catalog import run_query
    return run_query(spark, {"job_postings": silver(spark, d)},
                     "SELECT country, count(*) AS n FROM job_postings WHERE experience_level = :lvl "
                     "AND work_type <> :wt GROUP BY country HAVING count(*) >= :min_n",
                     {"lvl": "Senior", "wt": "Remote", "min_n": 2})


@register("table_preview", E + """
SELECT id, title, company, country FROM exp_postings ORDER BY id LIMIT 10""")
def table_preview(spark, d):
    from hirelens.sources.catalog import preview
    return preview(silver(spark, d).select("id", "title", "company", "country"), 10, order_by=["id"])


# ------------------------------------------------------------------ EDA notebook
@register("monthly_focus_skill_counts", E + f"""
, f(focus_skill) AS (VALUES {", ".join(f"('{x}')" for x in FOCUS_SKILLS)}),
hits AS (SELECT DISTINCT p.id, date_trunc('month', p.date_posted) AS month, f.focus_skill
         FROM exp_postings p JOIN exp_job_skills s ON s.job_id = p.id
         JOIN f ON contains(lower(s.skill), f.focus_skill) WHERE p.date_posted IS NOT NULL)
SELECT CAST(month AS DATE) AS month, focus_skill, count(*) AS jobs FROM hits GROUP BY ALL""")
def monthly_focus_skill_counts(spark, d):
    return Q.monthly_focus_skill_counts(silver(spark, d), FOCUS_SKILLS)


@register("experience_proportions", E + f"""
SELECT experience_level, count(*) AS n, {m2('count(*) * 100.0 / sum(count(*)) OVER ()')} AS share_pct
FROM exp_postings GROUP BY experience_level""")
def experience_proportions(spark, d):
    p = Q.proportions(silver(spark, d), "experience_level")
    return p.select("experience_level", "n", money(F.col("share") * 100.0, "share_pct"))


def _with_t(rows: str, steps: int = 12) -> str:
    """CTE ``t``: ``rows`` (with a count n) plus the t quantile, by integrating the density (Simpson) and Newton steps."""
    density = "exp(lc - n / 2.0 * ln(1 + pow({x}, 2) / (n - 1)))"
    inner = density.format(x="(i * t / 1000.0)")
    share = f"2 * t / 3000.0 * list_sum(list_transform(range(0, 1001), lambda i: (CASE WHEN i IN (0, 1000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * {inner}))"
    out = f", t0 AS (SELECT *, 1.959963984540054::DOUBLE AS t, lgamma(n / 2.0) - lgamma((n - 1) / 2.0) - 0.5 * ln((n - 1) * pi()) AS lc FROM {rows})"
    for i in range(steps):
        out += f", t{i + 1} AS MATERIALIZED (SELECT * REPLACE (t - ({share} - 0.95) / (2 * {density.format(x='t')}) AS t) FROM t{i})"
    return out + f", t AS (SELECT * FROM t{steps})"


_CI = f"""
, st AS (SELECT {{g}}, sum(CAST(floor(avg_salary_annual_usd * 100 + 0.5) AS BIGINT)) / count(*) / 100 AS mean, count(*) AS n, stddev_samp(avg_salary_annual_usd) AS std
         FROM exp_postings WHERE {{where}} AND avg_salary_annual_usd IS NOT NULL GROUP BY {{g}} HAVING count(*) >= {{least}})
{_with_t('st').replace('{', '{{').replace('}', '}}')}
SELECT {{g}}, {m2('mean')} AS mean, n, {m2('std')} AS std, {m2('t * 1000000')} AS t_millionths,
       {m2('t * std / sqrt(CAST(n AS DOUBLE))')} AS half_width FROM t"""


def _ci(r, group: str):
    return r.select(group, money("mean"), "n", money("std"), money(F.col("t") * 1000000, "t_millionths"), money("half_width"))


@register("experience_ci95", E + _CI.format(g="experience_level", where="experience_level IN ('Entry-Level', 'Mid-Level', 'Senior')", least=10))
def experience_ci95(spark, d):
    """A15 over large groups."""
    return _ci(Q.mean_ci95(silver(spark, d), "experience_level", LEVELS), "experience_level")


@register("company_ci95", E + _CI.format(g="company", where="company IS NOT NULL", least=2))
def company_ci95(spark, d):
    """A15 over small groups: t for a handful of degrees of freedom."""
    return _ci(Q.mean_ci95(silver(spark, d), "company", min_n=2), "company")


@register("salary_outliers", E + f"""
, q AS (SELECT quantile_cont(avg_salary_annual_usd, 0.25) AS q1, quantile_cont(avg_salary_annual_usd, 0.75) AS q3
        FROM exp_postings)
SELECT {m2('q1')} AS q1, {m2('q3')} AS q3, {m2('q3 + 2.0 * (q3 - q1)')} AS threshold,
       (SELECT count(*) FROM exp_postings WHERE avg_salary_annual_usd > q3 + 2.0 * (q3 - q1)) AS n_outliers FROM q""")
def salary_outliers(spark, d):
    r = Q.iqr_outliers(silver(spark, d))
    return r.select(money("q1"), money("q3"), money("threshold"), "n_outliers")


@register("salary_box_by_experience", E + f"""
, q AS (SELECT experience_level, min(avg_salary_annual_usd) AS mn, quantile_cont(avg_salary_annual_usd, 0.25) AS q1,
               median(avg_salary_annual_usd) AS med, quantile_cont(avg_salary_annual_usd, 0.75) AS q3,
               max(avg_salary_annual_usd) AS mx, count(avg_salary_annual_usd) AS n
        FROM exp_postings WHERE experience_level IS NOT NULL AND avg_salary_annual_usd IS NOT NULL
        GROUP BY experience_level)
SELECT experience_level, {m2('mn')} AS min, {m2('q1')} AS q1, {m2('med')} AS median, {m2('q3')} AS q3,
       {m2('mx')} AS max, n, {m2('greatest(mn, q1 - 1.5 * (q3 - q1))')} AS lower_whisker,
       {m2('least(mx, q3 + 1.5 * (q3 - q1))')} AS upper_whisker FROM q""")
def salary_box_by_experience(spark, d):
    b = Q.box_stats(silver(spark, d), "experience_level")
    return b.select("experience_level", *[money(c) for c in ["min", "q1", "median", "q3", "max"]], "n",
                    money("lower_whisker"), money("upper_whisker"))


@register("salary_histogram", E + f"""
, v AS (SELECT avg_salary_annual_usd AS x FROM exp_postings WHERE avg_salary_annual_usd IS NOT NULL),
r AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
b AS (SELECT CAST(CASE WHEN hi = lo THEN 1 ELSE least(30, floor((x - lo) / (hi - lo) * 30) + 1) END AS INTEGER) AS bin,
             lo, hi FROM v, r)
SELECT bin, {m2('any_value(lo) + (bin - 1) * (any_value(hi) - any_value(lo)) / 30')} AS bin_start, count(*) AS n
FROM b GROUP BY bin""")
def salary_histogram(spark, d):
    return Q.histogram(silver(spark, d), bins=30).select("bin", money("bin_start"), "n")


@register("experience_by_top_country", E + """
, top AS (SELECT country FROM exp_postings WHERE country IS NOT NULL GROUP BY country
          ORDER BY count(*) DESC, country LIMIT 10)
SELECT country, experience_level, count(*) AS n FROM exp_postings WHERE country IN (SELECT country FROM top)
GROUP BY ALL""")
def experience_by_top_country(spark, d):
    return Q.crosstab_top(silver(spark, d), "country", "experience_level", 10)


@register("worktype_by_experience", E + """
SELECT work_type, experience_level, count(*) AS n FROM exp_postings GROUP BY ALL""")
def worktype_by_experience(spark, d):
    return silver(spark, d).groupBy("work_type", "experience_level").agg(F.count(F.lit(1)).alias("n"))


@register("skill_cooccurrence", E + """
, js AS (SELECT DISTINCT job_id, skill FROM exp_job_skills),
top AS (SELECT skill FROM js GROUP BY skill ORDER BY count(*) DESC, skill LIMIT 20),
t AS (SELECT * FROM js WHERE skill IN (SELECT skill FROM top))
SELECT a.skill AS skill_a, b.skill AS skill_b, count(*) AS n FROM t a JOIN t b ON a.job_id = b.job_id GROUP BY ALL""")
def skill_cooccurrence(spark, d):
    return Q.skill_cooccurrence(silver(spark, d), 20)


_CSC = """, csc AS (SELECT p.country, s.skill, count(*) AS count FROM exp_job_skills s JOIN exp_postings p
                ON p.id = s.job_id GROUP BY ALL),
tc AS (SELECT country FROM csc GROUP BY country ORDER BY sum(count) DESC, country LIMIT 10),
ts AS (SELECT skill FROM csc GROUP BY skill ORDER BY sum(count) DESC, skill LIMIT 15),
dense AS (SELECT tc.country, ts.skill, coalesce(csc.count, 0) AS count FROM tc CROSS JOIN ts
          LEFT JOIN csc ON csc.country = tc.country AND csc.skill = ts.skill)"""


@register("country_skill_matrix", E + """
, j AS (SELECT DISTINCT p.country, s.skill, s.job_id FROM exp_job_skills s JOIN exp_postings p ON p.id = s.job_id),
n AS (SELECT country, skill, count(*) AS count FROM j GROUP BY ALL),
tc AS (SELECT country FROM n GROUP BY country ORDER BY sum(count) DESC, country LIMIT 10),
ts AS (SELECT skill FROM n GROUP BY skill ORDER BY sum(count) DESC, skill LIMIT 10)
SELECT tc.country, ts.skill, coalesce(n.count, 0) AS count FROM tc CROSS JOIN ts
LEFT JOIN n ON n.country = tc.country AND n.skill = ts.skill""")
def country_skill_matrix(spark, d):
    s = silver(spark, d)
    jobs = s.select("country", F.explode(F.array_distinct(all_skills())).alias("skill"))  # a row is a job
    counts = jobs.groupBy("country", "skill").agg(F.count(F.lit(1)).alias("count"))
    rows = Q.top_keys(counts, "country", 10, weight="count")
    cols = Q.top_keys(counts, "skill", 10, weight="count")
    return Q.dense_matrix(counts, "country", "skill", "count", rows, cols)


@register("country_skill_pivot", E + _CSC + """
SELECT country, string_agg(skill || '=' || count, ', ' ORDER BY skill) AS cells FROM dense GROUP BY country""")
def country_skill_pivot(spark, d):
    """The wide matrix, each row written out with its column names (they depend on the data)."""
    wide = Q.country_skill_pivot(gold.country_skill_counts(silver(spark, d)), 10, 15)
    cells = [F.concat(F.lit(f"{c}="), F.col(f"`{c}`").cast("string")) for c in wide.columns if c != "country"]
    return wide.select("country", F.concat_ws(", ", *cells).alias("cells"))


def _topk_sql(group: list[str], k: int) -> str:
    g = ", ".join(f"p.{c}" for c in group)
    gp = ", ".join(group)
    return E + f"""
, c AS (SELECT {g}, s.skill, count(*) AS n FROM exp_job_skills s JOIN exp_postings p ON p.id = s.job_id GROUP BY ALL)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {gp} ORDER BY n DESC, skill) AS rank FROM c)
WHERE rank <= {k}"""


@register("top_skills_per_country", _topk_sql(["country"], 5))
def top_skills_per_country(spark, d):
    return Q.top_k_per_group(Q.skill_counts_by(silver(spark, d), ["country"]), ["country"], "skill", "n", 5)


@register("top_skills_per_work_type", _topk_sql(["work_type"], 5))
def top_skills_per_work_type(spark, d):
    return Q.top_k_per_group(Q.skill_counts_by(silver(spark, d), ["work_type"]), ["work_type"], "skill", "n", 5)


@register("top_skills_per_experience_country", _topk_sql(["experience_level", "country"], 3))
def top_skills_per_experience_country(spark, d):
    g = ["experience_level", "country"]
    return Q.top_k_per_group(Q.skill_counts_by(silver(spark, d), g), g, "skill", "n", 3)


@register("employment_excluding_not_specified", E + """
SELECT employment_type, count(*) AS n FROM exp_postings
WHERE NOT coalesce(contains(lower(employment_type), 'not specified'), false) GROUP BY employment_type""")
def employment_excluding_not_specified(spark, d):
    s = Q.exclude_not_specified(silver(spark, d), "employment_type")
    return s.groupBy("employment_type").agg(F.count(F.lit(1)).alias("n"))


@register("distinct_levels_max_salary", E + f"""
SELECT experience_level, {m2('max(avg_salary_annual_usd)')} AS max_salary FROM exp_postings GROUP BY experience_level""")
def distinct_levels_max_salary(spark, d):
    return (silver(spark, d).groupBy("experience_level")
            .agg(money(F.max("avg_salary_annual_usd"), "max_salary")))



@register("suppressed_levels", E + """
, l(experience_level) AS (VALUES ('Entry-Level'), ('Mid-Level'), ('Senior'), ('Executive')),
n AS (SELECT experience_level, count(*) AS n FROM exp_postings WHERE avg_salary_annual_usd IS NOT NULL GROUP BY 1)
SELECT l.experience_level, n.n FROM l LEFT JOIN n USING (experience_level) WHERE coalesce(n.n, 0) < 10""")
def suppressed_levels(spark, d):
    """A15 (second output): listed levels with fewer than 10 salaries."""
    return Q.suppressed_levels(silver(spark, d), "experience_level", LEVELS_AND_NONE)


@register("salary_box_by_country", E + f"""
, q AS (SELECT country, min(avg_salary_annual_usd) AS mn, quantile_cont(avg_salary_annual_usd, 0.25) AS q1,
               median(avg_salary_annual_usd) AS med, quantile_cont(avg_salary_annual_usd, 0.75) AS q3,
               max(avg_salary_annual_usd) AS mx, count(avg_salary_annual_usd) AS n
        FROM exp_postings WHERE country IS NOT NULL AND avg_salary_annual_usd IS NOT NULL GROUP BY country)
SELECT country, {m2('mn')} AS min, {m2('q1')} AS q1, {m2('med')} AS median, {m2('q3')} AS q3, {m2('mx')} AS max, n,
       {m2('greatest(mn, q1 - 1.5 * (q3 - q1))')} AS lower_whisker,
       {m2('least(mx, q3 + 1.5 * (q3 - q1))')} AS upper_whisker FROM q""")
def salary_box_by_country(spark, d):
    b = Q.box_stats(silver(spark, d), "country")
    return b.select("country", *[money(c) for c in ["min", "q1", "median", "q3", "max"]], "n",
                    money("lower_whisker"), money("upper_whisker"))


DISPLAY_NAMES = {
    "min_salary_annual_usd": "Min Salary (USD)", "max_salary_annual_usd": "Max Salary (USD)",
    "avg_salary_annual_usd": "Average Salary (USD)", "salary_confidence": "Salary Confidence",
    "salary_period": "Salary Period",
}


@register("salary_columns_display", E + f"""
SELECT id, has_salary, min_salary_raw, max_salary_raw, single_salary_raw, salary_period AS "Salary Period",
       {m2('min_salary_annual_usd')} AS "Min Salary (USD)", {m2('max_salary_annual_usd')} AS "Max Salary (USD)",
       {m2('avg_salary_annual_usd')} AS "Average Salary (USD)", salary_confidence AS "Salary Confidence"
FROM exp_postings""")
def salary_columns_display(spark, d):
    """P13 + P12: every column whose name mentions 'salary', renamed for display."""
    s = silver(spark, d)
    cols = Q.columns_like(s, "salary")
    out = s.select("id", *[money(c) if c.endswith("_usd") else F.col(c) for c in cols])
    return Q.for_display(out, DISPLAY_NAMES)
