"""Merges of landed files, into a bucketed master, and as streams (W3, U2, U3, J1, 2.13, P6)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.operators import clean, merge
from hirelens.operators.master import BucketedMaster
from hirelens.plans.common import m2, money, read
from hirelens.plans.etl_queries import _batches, _masked_customers, _merge_sql, _out
from hirelens.plans.registry import register
from hirelens.session import scratch_path
from hirelens.sources.dumps import read_dumps
from hirelens.sources.files import write_csv
from hirelens.streaming.ingest import first_of_stream, merge_stream

# Postings dated in overlapping ranges of years: (first, last) of each dump, in the order they land.
YEARS = [(1990, 1993), (1993, 1995), (1995, 1996), (1996, 1999)]

_ROWS_SQL = """
WITH r AS (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'https://jobs.example.com/c/' || o_custkey END AS link,
                  o_orderkey AS id, o_totalprice AS price, CAST(o_orderdate AS DATE) AS date_posted FROM orders)
"""


def _dumps_sql(years) -> str:
    return _ROWS_SQL + ", b AS (" + " UNION ALL ".join(
        f"SELECT *, {i} AS _batch FROM r WHERE year(date_posted) BETWEEN {a} AND {z}" for i, (a, z) in enumerate(years)) + ")"


def _kept_sql(years, direction: str, batch: str | None) -> str:
    """One row per link in file order, and the different rows without a link."""
    order = f", {batch}(_batch) AS _batch" if batch else ""
    col = ", _batch" if batch else ""
    return _dumps_sql(years) + f"""
, keyed AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY link ORDER BY _batch {direction}, id {direction}) AS rn
                           FROM b WHERE link IS NOT NULL) WHERE rn = 1),
nulls AS (SELECT link, id, price, date_posted{order} FROM b WHERE link IS NULL GROUP BY link, id, price, date_posted)
SELECT link, id, {m2('price')} AS price, date_posted{col} FROM keyed
UNION ALL SELECT link, id, {m2('price')} AS price, date_posted{col} FROM nulls"""


def _dump(spark, d, i: int):
    o = read(spark, d, "orders")
    first, last = YEARS[i]
    rows = o.where((o.o_orderdate >= F.lit(f"{first}-01-01").cast("timestamp_ntz")) & (o.o_orderdate < F.lit(f"{last + 1}-01-01").cast("timestamp_ntz")))
    return rows.select(
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("https://jobs.example.com/c/"), F.col("o_custkey").cast("string"))).alias("link"),
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"), F.to_date("o_orderdate").alias("date_posted"))


# ------------------------------------------------------------------ order of files
DUMP_SCHEMA = T.StructType([T.StructField("link", T.StringType()), T.StructField("id", T.LongType()),
                            T.StructField("price", T.DoubleType()), T.StructField("date_posted", T.DateType())])


def _landed_dumps(spark, d):
    """Three CSV dumps, written one after another with their rows in the order of ids, read back newest first."""
    root = scratch_path(spark, "dumps")
    paths = []
    for i in range(3):
        paths.append(f"{root}/dump={2 - i}")  # names against the order of landing: times decide
        write_csv(_dump(spark, d, i).orderBy("id"), paths[-1])
    return read_dumps(spark, paths[::-1], DUMP_SCHEMA, dump="folder")


def _plain(df):
    return df.select("link", "id", money("price"), "date_posted")


@register("dumps_keep_first", _kept_sql(YEARS[:3], "ASC", None))
def dumps_keep_first(spark, d):
    """W3 / U3 over files: the first row of a link in the order of dumps, files and rows."""
    return _plain(merge.dedupe(_landed_dumps(spark, d), ["link"], "first"))


@register("dumps_keep_last", _kept_sql(YEARS[:3], "DESC", None))
def dumps_keep_last(spark, d):
    """W3 / U2 over files: the last row of a link."""
    return _plain(merge.dedupe(_landed_dumps(spark, d), ["link"], "last"))


# ------------------------------------------------------------------ bucketed master
def _master(spark, name: str) -> BucketedMaster:
    return BucketedMaster(spark, f"{name}_{uuid.uuid4().hex[:12]}", "link", 16, scratch_path(spark, name))


@register("merge_bucketed_keep_last", _merge_sql("DESC", "max"))
def merge_bucketed_keep_last(spark, d):
    """The batch is shuffled into the master's buckets; the master is read as it lies."""
    old, new = _batches(spark, d)
    master = _master(spark, "master_last")
    master.create(old, "last")
    return _out(master.merged(new, "last"))


@register("merge_bucketed_keep_first", _merge_sql("ASC", "min"))
def merge_bucketed_keep_first(spark, d):
    """Unseen keys are appended to the master's buckets, twice with the same batch."""
    old, new = _batches(spark, d)
    master = _master(spark, "master_first")
    master.create(old, "first")
    master.append_new(new)
    master.append_new(new)
    return _out(master.current("first"))


@register("run_counts", """
WITH m AS (SELECT c_acctbal < 0 AND c_mktsegment = 'AUTOMOBILE' AS dropped FROM customer),
r AS (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS link, o_orderkey AS id, year(o_orderdate) AS y FROM orders)
SELECT (SELECT count(*) FROM m) AS rows_read, (SELECT count(*) FROM m WHERE dropped) AS rows_dropped,
       (SELECT count(DISTINCT link) FROM r WHERE y >= 1997 AND link NOT IN (SELECT link FROM r WHERE y <= 1997 AND link IS NOT NULL))
       + (SELECT count(*) FROM r WHERE y > 1997 AND link IS NULL) AS rows_new""")
def run_counts(spark, d):
    """P6 + U3: what a run reports, observed while it writes (no job of its own): rows dropped as obfuscated, rows new to the master."""
    kept, counts = clean.drop_obfuscated_counted(_masked_customers(spark, d), ["location", "company"])
    kept.write.parquet(scratch_path(spark, "kept-customers"))
    old, new = _batches(spark, d)
    master = _master(spark, "master_counts")
    master.create(old, "first")
    added = master.append_new(new)
    seen = counts.get
    return spark.createDataFrame([(seen["rows"], seen["dropped"], added)], "rows_read long, rows_dropped long, rows_new long")


# ------------------------------------------------------------------ streams
def _land(spark, d, root: str, i: int):
    """One landing dump, de-duplicated on its own, rows in the order of ids."""
    rows = _dump(spark, d, i).withColumns({merge.SEQ: F.col("id"), merge.BATCH: F.lit(i)})
    merge.dedupe(rows, ["link"], "first").write.parquet(f"{root}/incoming/dump-{i}")
    return rows.schema


@register("stream_first_with_state", _kept_sql(YEARS, "ASC", "min"))
def stream_first_with_state(spark, d):
    """U3 as a stateful stream: four dumps land and the stream is restarted after each; one dump a micro-batch, however many files it has."""
    root = scratch_path(spark, "stream-state")
    for i in range(4):
        schema = _land(spark, d, root, i)
        first_of_stream(spark, f"{root}/incoming/*", schema, "link", f"{root}/out", f"{root}/checkpoint", max_files=None, order=[merge.BATCH, merge.SEQ])
    return _out(spark.read.schema(schema).parquet(f"{root}/out"))


def _stream_merge(spark, d, keep: str):
    old, new = _batches(spark, d)
    root = scratch_path(spark, f"stream-merge-{keep}")
    master = _master(spark, f"stream_{keep}")
    master.create(old.limit(0), keep)
    for i, batch in enumerate((old, new)):
        batch.write.parquet(f"{root}/incoming/dump-{i}")
    merge_stream(spark, f"{root}/incoming/*", new.schema, master, f"{root}/checkpoint", keep)
    return _out(master.current(keep))


@register("stream_merge_keep_first", _merge_sql("ASC", "min"))
def stream_merge_keep_first(spark, d):
    """U3 through Structured Streaming: both batches land as files; each micro-batch appends its unseen keys to the master."""
    return _stream_merge(spark, d, "first")


@register("stream_merge_keep_last", _merge_sql("DESC", "max"))
def stream_merge_keep_last(spark, d):
    """U2 through Structured Streaming: the newer batch replaces rows with the same key."""
    return _stream_merge(spark, d, "last")
