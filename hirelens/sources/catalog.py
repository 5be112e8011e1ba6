"""Table loading, ad-hoc SQL, previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hirelens import refdata as R

# Fixed value: the explicit projection used when loading job_postings (dates cast to DATE).
JOB_POSTINGS_LOAD_COLUMNS = [
    "id", "title", "company", "location", "link", "source", "date_posted", "work_type", "employment_type",
    "description", "header_text", "has_salary", "currency_raw", "min_salary_raw", "max_salary_raw",
    "single_salary_raw", "salary_period", "min_salary_annual_usd", "max_salary_annual_usd",
    "avg_salary_annual_usd", "salary_confidence", "experience_level", "country",
    *R.SKILL_COLUMNS, "cluster", "cluster_name",
]


def run_query(spark: SparkSession, tables: dict[str, DataFrame], sql: str, args: dict | None = None) -> DataFrame:
    """Register the given frames as temp views and run parameterised SQL (no string interpolation)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql, args=args or {})


def preview(df: DataFrame, n: int = 10, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows; ordered by a key when given so the sample is deterministic."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


#: Partition column of loaded tables: a month, or a share of the keys.
PART = "load_part"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def month_part(date: str = "date_posted") -> Column:
    """Partition by month; rows without a date share one partition."""
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit("undated"))


def key_part(keys: list[str], parts: int) -> Column:
    """Partition by a hash of the keys, for tables without a date."""
    return F.format_string("%05d", F.pmod(F.xxhash64(*keys), F.lit(parts)))


def load_table(df: DataFrame, table: str, keys: list[str], part: Column, location: str | None = None) -> list[str]:
    """Merge ``df`` by key into a partitioned table; returns the partitions written.

    Only partitions that hold a row of ``df``, or a row that ``df`` replaces, are
    read and written (dynamic partition overwrite).  Their new files are staged
    and moved when the job commits, so a load that fails leaves the table as it
    was, and the files of all other partitions are never touched.  Loading the
    same rows again changes nothing (Q14).  The list of partitions (months, or
    ``key_part``'s number) is the only thing the driver gathers.
    """
    from hirelens.operators.merge import dedupe, merge_keep_last
    from hirelens.sources.tables import stage
    spark = df.sparkSession
    cols = df.columns
    new = stage(dedupe(df, keys, "last").select(*cols, part.alias(PART)), "load")
    if not spark.catalog.tableExists(table):
        writer = new.write.format("parquet").partitionBy(PART)
        (writer.option("path", location) if location else writer).saveAsTable(table)
        return sorted(r[0] for r in new.select(PART).distinct().collect())
    spark.catalog.refreshTable(table)
    held = spark.table(table)
    replaced = held.select(*keys, PART).join(new.select(*keys), keys, "left_semi").select(PART)
    touched = sorted(r[0] for r in replaced.unionByName(new.select(PART)).distinct().collect())
    old = held.where(F.col(PART).isin(touched)).select(*cols)
    merged = merge_keep_last(old, new.select(*cols), keys).select(*cols, part.alias(PART))
    # One partition's rows go to as few tasks as its size asks for, so it doesn't end up in many small files.
    merged = merged.hint("rebalance", F.col(PART))
    written = Observation()
    rows = merged.observe(written, F.collect_set(PART).alias("parts"))
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        rows.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)
    for gone in sorted(set(touched) - set(written.get["parts"])):  # all its rows moved elsewhere
        _drop_partition(spark, table, gone)
    return touched


def _drop_partition(spark: SparkSession, table: str, part: str) -> None:
    """Drop a partition with its files (Spark keeps the files of external tables)."""
    spec = f"PARTITION ({PART} = '{part}')"
    about = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {spec}").where("col_name = 'Location'").collect()
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {spec}")
    for place in about:
        if f"{PART}={part}" in place["data_type"]:  # the partition's own folder, not the table's
            path = spark._jvm.org.apache.hadoop.fs.Path(place["data_type"])
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def load_tables(spark: SparkSession, gold: dict[str, DataFrame], keys: dict[str, list[str]],
                database: str = "default", parts: int = 16) -> dict[str, list[str]]:
    """S6 for the gold tables: each merged by key into ``database.<name>``; returns the partitions written of each.

    ``job_postings`` is cut to the fixed projection (dates cast to DATE) and
    partitioned by month, the others by a hash of their keys.
    """
    written = {}
    for name, df in gold.items():
        part = key_part(keys[name], parts)
        if name == "job_postings":
            df = df.select(*[c for c in JOB_POSTINGS_LOAD_COLUMNS if c in df.columns])
            df = df.withColumn("date_posted", F.col("date_posted").cast("date"))
            part = month_part()
        written[name] = load_table(df, f"{database}.{name}", keys[name], part)
    return written
