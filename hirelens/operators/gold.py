"""Silver → gold (A1-A6): the seven analytics tables.

Every table is computed from silver alone.  Silver rows already carry the
skill arrays next to country / experience / salary, so the per-skill tables
are an ``explode`` followed by one aggregation: no join back to postings.
Aggregations are partial (map-side) so a hot key only ships one partial row
per task; percentiles go through :func:`exact_percentiles`, which splits hot
keys across tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens import refdata as R
from hirelens.functions.skills import all_skills
from hirelens.operators.quantiles import percentiles


def job_skills(silver: DataFrame, extra: list[str] | None = None, cols: list[str] | None = None) -> DataFrame:
    """A2: (job_id, skill, skill_category [, extra…]) — one row per array element, '' dropped."""
    cols = cols or R.SKILL_COLUMNS
    def tag(c: str):
        return F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")),
                           lambda s: F.struct(s.alias("skill"), F.lit(c).alias("skill_category")))

    tagged = F.flatten(F.array(*[tag(c) for c in cols]))
    extra = extra or []
    return (silver.select(F.col("id").alias("job_id"), *extra, F.explode(tagged).alias("_s"))
            .select("job_id", F.col("_s.skill").alias("skill"), F.col("_s.skill_category").alias("skill_category"),
                    *extra)
            .where(F.col("skill").isNotNull() & (F.col("skill") != "")))


def skills(silver: DataFrame) -> DataFrame:
    """A1: skill frequency; a skill listed in two categories counts twice per job."""
    return job_skills(silver).groupBy("skill").agg(F.count(F.lit(1)).alias("frequency"))


def companies(silver: DataFrame, approx: bool = False) -> DataFrame:
    """A3: per non-null company: job count (non-null ids), median avg salary, modal country.

    Modal country ties go to the smallest value; a company with no salaries
    gets a null median.
    """
    base = silver.where(F.col("company").isNotNull())
    counts = base.groupBy("company").agg(
        F.count("id").alias("job_count"),
        F.mode("country", deterministic=True).alias("country"),
    )
    med = percentiles(base, ["company"], "avg_salary_annual_usd", [0.5], ["median_salary"], count_name=None,
                      approx=approx)
    return counts.join(med, "company", "left").select("company", "job_count", "median_salary", "country")


def country_skill_counts(silver: DataFrame) -> DataFrame:
    """A4: (country, skill) → count of job-skill rows."""
    return job_skills(silver, extra=["country"]).groupBy("country", "skill").agg(F.count(F.lit(1)).alias("count"))


def experience_skill_counts(silver: DataFrame) -> DataFrame:
    """A5: (experience_level, skill) → count of job-skill rows."""
    return (job_skills(silver, extra=["experience_level"])
            .groupBy("experience_level", "skill").agg(F.count(F.lit(1)).alias("count")))


def salary_skill_stats(silver: DataFrame, approx: bool = False) -> DataFrame:
    """p25 / median / p75 / count of avg annual USD per skill.

    Each job counts once per skill (membership), null salaries are ignored and
    skills without any salary are omitted; percentiles interpolate linearly.
    ``approx=True`` switches to ``percentile_approx`` (no interpolation).
    """
    per_job = (silver.where(F.col("avg_salary_annual_usd").isNotNull())
               .select("avg_salary_annual_usd", F.explode(F.array_distinct(all_skills())).alias("skill"))
               .where(F.col("skill") != ""))
    return percentiles(per_job, ["skill"], "avg_salary_annual_usd", [0.25, 0.5, 0.75],
                       ["p25", "median", "p75"], count_name="count", approx=approx)


def job_postings(silver: DataFrame, centres: DataFrame | None = None) -> DataFrame:
    """Gold ``job_postings``: silver plus ``cluster`` / ``cluster_name`` by the nearest of ``centres`` (``ml.fit_centres``)."""
    if centres is None:
        return silver
    from hirelens.operators.ml import with_clusters
    return with_clusters(silver, centres)


def build_gold(silver: DataFrame, centres: DataFrame | None = None) -> dict[str, DataFrame]:
    """All seven gold tables as lazy DataFrames (callers persist silver once)."""
    return {
        "job_postings": job_postings(silver, centres),
        "skills": skills(silver),
        "job_skills": job_skills(silver),
        "companies": companies(silver),
        "country_skill_counts": country_skill_counts(silver),
        "experience_skill_counts": experience_skill_counts(silver),
        "salary_skill_stats": salary_skill_stats(silver),
    }
