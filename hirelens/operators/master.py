"""A master table that merges without being moved.

The master is bucketed and sorted by the key.  A batch is shuffled into the same
buckets and meets them where they lie, so a merge moves the batch only, however
large the master is.  Writes are appends: keep-first adds the unseen keys,
keep-last adds the batch's winners, and ``current`` picks one row per key inside
each bucket, again without a shuffle.  An append is one job whose files appear
when it commits; the same batch appended twice changes nothing (keep-first finds
its keys, keep-last picks equal rows), so a failed run is simply run again.

Rows without a key never collapse into one (Q24); they live in a second table,
bucketed by a fingerprint of the row, and are only de-duplicated as whole rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hirelens.operators.merge import BATCH, SEQ, dedupe

ROW = "_row"


class BucketedMaster:
    def __init__(self, spark: SparkSession, name: str, key: str, buckets: int, location: str | None = None):
        """``name`` in the catalog; ``buckets`` is fixed with the first write (thousands for tables of many TB)."""
        self.spark, self.name, self.key, self.buckets, self.location = spark, name, key, buckets, location

    def _write(self, rows: DataFrame, name: str, by: str) -> None:
        w = rows.write.mode("append").format("parquet").bucketBy(self.buckets, by).sortBy(by)
        if self.location and not self.spark.catalog.tableExists(name):
            w = w.option("path", f"{self.location}/{name.rsplit('.', 1)[-1]}")
        w.saveAsTable(name)

    def _fingerprint(self, rows: DataFrame) -> DataFrame:
        data = [c for c in rows.columns if c not in (BATCH, SEQ, ROW)]
        return rows.withColumn(ROW, F.md5(F.to_json(F.struct(*data), {"ignoreNullFields": "false"})))

    def _table(self, name: str) -> DataFrame:
        self.spark.catalog.refreshTable(name)  # another session (a stream's) may have appended
        return self.spark.table(name)

    def keyed(self) -> DataFrame:
        return self._table(self.name)

    def keyless(self) -> DataFrame:
        return self._table(f"{self.name}_nokey")

    def _split(self, batch: DataFrame, keep: str) -> tuple[DataFrame, DataFrame]:
        """The batch de-duplicated on its own: one row per key, and its different rows without a key."""
        null = F.col(self.key).isNull()
        return dedupe(batch.where(~null), [self.key], keep), dedupe(self._fingerprint(batch.where(null)), [ROW], keep)

    def create(self, rows: DataFrame, keep: str = "last") -> None:
        """The first version, from ``rows`` (de-duplicated here)."""
        keyed, keyless = self._split(rows, keep)
        self._write(keyed.repartition(self.buckets, self.key), self.name, self.key)
        self._write(keyless.repartition(self.buckets, ROW), f"{self.name}_nokey", ROW)

    def unseen(self, batch: DataFrame) -> DataFrame:
        """Rows of ``batch`` (with a key) whose key the master doesn't hold; only the batch is shuffled."""
        return batch.join(self.keyed().select(self.key), self.key, "left_anti")

    def _unseen_keyless(self, batch: DataFrame) -> DataFrame:
        return batch.join(self.keyless().select(ROW), ROW, "left_anti")

    def merged(self, batch: DataFrame, keep: str = "last") -> DataFrame:
        """What the master would hold after the batch, without writing it."""
        keyed, keyless = self._split(batch, keep)
        cols = self.keyed().columns
        if keep == "last":
            out = self.keyed().join(keyed.select(self.key), self.key, "left_anti").unionByName(keyed.select(*cols))
        else:
            out = self.keyed().unionByName(self.unseen(keyed).select(*cols))
        rest = self.keyless()
        if keep == "last":  # a repeated row counts as the batch's
            rest = rest.join(keyless.select(ROW), ROW, "left_anti").unionByName(keyless.select(*rest.columns))
        else:
            rest = rest.unionByName(self._unseen_keyless(keyless).select(*rest.columns))
        return out.unionByName(rest.select(*cols))

    def append_new(self, batch: DataFrame) -> int:
        """Append what is new (master rows win); returns how many rows that were."""
        keyed, keyless = self._split(batch, "first")
        counts = []
        for rows, name, by in ((self.unseen(keyed), self.name, self.key), (self._unseen_keyless(keyless), f"{self.name}_nokey", ROW)):
            seen = Observation()
            self._write(rows.select(*self.spark.table(name).columns).observe(seen, F.count(F.lit(1)).alias("n")), name, by)
            counts.append(seen.get["n"])
        return sum(counts)

    def upsert(self, batch: DataFrame) -> None:
        """Append the batch's rows; ``current`` lets the last row of a key win."""
        keyed, keyless = self._split(batch, "last")
        self._write(keyed.select(*self.keyed().columns).repartition(self.buckets, self.key), self.name, self.key)
        self._write(keyless.select(*self.keyless().columns).repartition(self.buckets, ROW), f"{self.name}_nokey", ROW)

    def current(self, keep: str = "last") -> DataFrame:
        """One row per key, and the different rows without one; buckets are read as they lie."""
        cols = self.keyed().columns
        return dedupe(self.keyed(), [self.key], keep).select(*cols).unionByName(dedupe(self.keyless(), [ROW], keep).select(*cols))
