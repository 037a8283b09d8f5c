"""A keyed table on plain Parquet, written as a log of batches.

A batch lands in its own directory, so repeating it after a failure overwrites
exactly what the failed attempt left. Reading the table resolves the newest row per
key. ``compact`` folds old batches into a snapshot that counts only once it is listed
in the commit table, which is written last: a run that dies between leaves the
previous snapshot and its batches in force. Batches and snapshots are partitioned by a
hash of the key and sorted by it in each file, so that a lookup of one key opens one part
of each and reads few of its pages.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgauge.operators.history import latest_by_key
from tripgauge.sources.files import delete_directory

BUCKET = "key_bucket"
BUCKETS = 16

_COMMIT = T.StructType([T.StructField("upto", T.LongType())])


class KeyedLog:
    """``buckets`` belongs to what is stored and can't change later."""

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, key: str = "trip_id", buckets: int = BUCKETS
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = key
        self.buckets = buckets
        self.schema = schema
        in_bucket = T.StructField(BUCKET, T.IntegerType())
        batch = T.StructField("batch_id", T.LongType())
        self.stored_schema = T.StructType([*schema.fields, batch, in_bucket])
        self._snapshot = T.StructType([*schema.fields, batch, T.StructField("created_seq", T.LongType()), in_bucket])

    @property
    def batches_path(self) -> str:
        return f"{self.path}/batches"

    def write(self, df: DataFrame, batch_id: int) -> None:
        """Store one batch; a key appears in it at most once."""
        self._write(df.select(*self.schema.fieldNames()), f"{self.batches_path}/batch_id={batch_id}")

    def history(self) -> DataFrame:
        """Every row of every batch still kept as a batch, with ``batch_id``."""
        return self._batches().drop(BUCKET)

    def latest(self, before: int | None = None, key: str | None = None) -> DataFrame:
        """The newest row per key, ``batch_id`` it came with and ``created_seq`` of the
        key's first. ``before`` ignores that batch and later ones; ``key`` looks up one
        key."""
        upto = self._last_commit(before)
        rows = self._batches()
        if before is not None:
            rows = rows.filter(F.col("batch_id") < before)
        if upto is not None:
            folded = self.spark.read.schema(self._snapshot).parquet(f"{self.path}/snapshots/{upto}")
            rows = folded.unionByName(rows.filter(F.col("batch_id") > upto), allowMissingColumns=True)
        if key is not None:
            rows = rows.filter((F.col(BUCKET) == self._bucket(F.lit(key))) & (F.col(self.key) == key))
        return latest_by_key(rows.drop(BUCKET), self.key, "batch_id", "created_seq")

    def compact(self, upto: int) -> None:
        """Fold batches up to and including ``upto`` into a snapshot."""
        self._write(self.latest(before=upto + 1), f"{self.path}/snapshots/{upto}")
        commit = self.spark.createDataFrame([(upto,)], _COMMIT).coalesce(1)
        commit.write.mode("append").parquet(f"{self.path}/commits")

    def vacuum(self) -> None:
        """Delete batches and snapshots the newest snapshot stands for. Queries planned
        before, and feeds that have not read those batches yet, lose them."""
        upto = self._last_commit(None)
        if upto is None:
            return
        folded = self.history().filter(F.col("batch_id") <= upto).select("batch_id").distinct().collect()
        older = self._read(f"{self.path}/commits", _COMMIT).filter(F.col("upto") < upto).distinct().collect()
        for row in folded:
            delete_directory(self.spark, f"{self.batches_path}/batch_id={row['batch_id']}")
        for row in older:
            delete_directory(self.spark, f"{self.path}/snapshots/{row['upto']}")

    def maintain(self, batch_id: int, every: int | None) -> None:
        """After each ``every`` batches fold and delete those more than ``every`` old."""
        if every and batch_id and batch_id % every == 0:
            self.compact(batch_id - every)
            self.vacuum()

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.hash(key), F.lit(self.buckets))

    def _write(self, df: DataFrame, path: str) -> None:
        # Rebalanced, so that a bucket is one file of useful size, or several if large.
        # Sorted by key in each file, so that row groups and pages without a key are skipped.
        parts = df.withColumn(BUCKET, self._bucket(F.col(self.key))).hint("rebalance", F.col(BUCKET))
        parts.sortWithinPartitions(BUCKET, self.key).write.mode("overwrite").partitionBy(BUCKET).parquet(path)

    def _batches(self) -> DataFrame:
        return self._read(self.batches_path, self.stored_schema, self.batches_path)

    def _last_commit(self, before: int | None) -> int | None:
        commits = self._read(f"{self.path}/commits", _COMMIT)
        if before is not None:
            commits = commits.filter(F.col("upto") < before)
        return commits.agg(F.max("upto")).head()[0]

    def _read(self, path: str, schema: T.StructType, base: str | None = None) -> DataFrame:
        reader = self.spark.read.schema(schema)
        if base:
            reader = reader.option("basePath", base)
        try:
            return reader.parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)
