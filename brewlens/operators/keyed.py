"""Keyed tables on plain Parquet: writes read and replace only the buckets they touch.

A keyed table is a folder partitioned by ``key_bucket = pmod(xxhash64(keys), buckets)``;
its layout (keys, number of buckets, schema) lies beside the data, so every later
writer uses the same one.  A write folds its batch to one row per key, finds
the buckets of those keys, reads these alone (partition pruning) and writes
them alone: files of other buckets keep their names and times.

* ``upsert_into``: partial upsert.  The touched buckets are merged, written to
  the shared scratch folder first, and then replaced by dynamic partition
  overwrite.  The same batch again changes nothing, so a job that was lost
  half-way is run again.
* ``insert_ignore_into``: appends the rows whose key is new; no file is replaced.
* ``update_into``: update-from; keys the table lacks are left out.

Each write ends with a check of the buckets it wrote: as many rows as distinct
keys.  One writer at a time.  Null keys are refused: they would match nothing
and pile up in one bucket.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from brewlens.operators import upsert as U
from brewlens.session import merging, scratch_path

BUCKET = "key_bucket"
_LAYOUT = "keys array<string>, buckets int, schema string"


class KeyedTable:
    """A keyed table under ``path``; ``create`` makes one, the constructor opens it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        layout = spark.read.schema(_LAYOUT).json(f"{path}/_layout").first()
        self.keys, self.buckets = list(layout["keys"]), layout["buckets"]
        self.schema = StructType.fromJson(json.loads(layout["schema"]))      # of the rows, without the bucket

    @classmethod
    def create(cls, rows: DataFrame, path: str, keys: Sequence[str], buckets: int = 64) -> KeyedTable:
        """Write ``rows`` (one per key) as a new keyed table.  Choose about 1 GB a bucket."""
        spark = rows.sparkSession
        spark.createDataFrame([(list(keys), buckets, rows.schema.json())], _LAYOUT).coalesce(1).write.json(f"{path}/_layout")
        told = rows.withColumn(BUCKET, _bucket(keys, buckets))
        told.repartition(buckets, BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/data")
        table = cls(spark, path)
        table._check(None)
        return table

    def read(self) -> DataFrame:
        return self._stored().drop(BUCKET)

    def read_for(self, rows: DataFrame) -> DataFrame:
        """The stored rows of the buckets that the keys of ``rows`` fall into; other buckets are not read."""
        touched = rows.select(_bucket(self.keys, self.buckets).alias(BUCKET)).distinct().collect()   # at most `buckets` rows
        return self._stored(sorted(r[BUCKET] for r in touched)).drop(BUCKET)

    def _stored(self, buckets: list[int] | None = None) -> DataFrame:
        with_bucket = StructType([*self.schema.fields, StructField(BUCKET, IntegerType())])
        stored = self.spark.read.schema(with_bucket).parquet(f"{self.path}/data")
        return stored if buckets is None else stored.where(F.col(BUCKET).isin(buckets))

    def _folded(self, batch: DataFrame, order_cols, keep: str) -> tuple[DataFrame, list[int]]:
        """The batch with one row per key, written once, and the buckets it touches (at most ``buckets`` numbers)."""
        order = order_cols or [c for c in batch.columns if c not in self.keys] or self.keys
        once = U.dedupe(batch, self.keys, order, keep).withColumn(BUCKET, _bucket(self.keys, self.buckets))
        held = self.spark.read.schema(once.schema).parquet(_scratch(once, "keyed-batch"))
        told = held.agg(F.collect_set(BUCKET).alias("touched"),
                        F.count_if(_any_null(self.keys)).alias("nulls")).first()
        if told["nulls"]:
            raise ValueError(f"{told['nulls']} rows without a key ({', '.join(self.keys)})")
        return held.drop(BUCKET), sorted(told["touched"])

    def _replace(self, merged: DataFrame, touched: list[int]) -> None:
        """Replace the touched buckets; what they will hold is on disk before anything is taken away."""
        names = self.schema.names
        told = merged.select(*names).withColumn(BUCKET, _bucket(self.keys, self.buckets))
        ready = self.spark.read.schema(told.schema).parquet(_scratch(told, "keyed-merged"))
        (ready.repartition(len(touched), BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BUCKET).parquet(f"{self.path}/data"))
        self._check(touched)

    def _check(self, touched: list[int] | None) -> None:
        per_key = self._stored(touched).groupBy(BUCKET, *self.keys).agg(F.count(F.lit(1)).alias("rows"))
        bad = per_key.where((F.col("rows") > 1) | _any_null(self.keys)).limit(3).collect()
        if bad:
            raise ValueError(f"keys that are not unique or null in {self.path}: {[tuple(r[k] for k in self.keys) for r in bad]}")

    def upsert_into(self, updates: DataFrame, set_cols: Sequence[str], order_cols: Sequence[str] | None = None) -> list[int]:
        """``INSERT ... ON CONFLICT (keys) DO UPDATE SET set_cols``; returns the buckets that were replaced."""
        batch, touched = self._folded(updates, order_cols, "last")
        if touched:
            self._replace(U.upsert(self._stored(touched).drop(BUCKET), batch, self.keys, set_cols), touched)
        return touched

    def update_into(self, updates: DataFrame, cols: Sequence[str]) -> list[int]:
        """``UPDATE ... SET cols FROM updates``; buckets without one of the keys stay as they are."""
        batch, touched = self._folded(updates, None, "last")
        if touched:
            known = self._stored(touched).select(BUCKET, *self.keys).join(batch.select(*self.keys), self.keys, "left_semi")
            touched = sorted(known.agg(F.collect_set(BUCKET)).first()[0])
        if touched:
            self._replace(U.update_from(self._stored(touched).drop(BUCKET), batch, self.keys, cols), touched)
        return touched

    def insert_ignore_into(self, batch: DataFrame, order_cols: Sequence[str] | None = None) -> int:
        """``INSERT ... ON CONFLICT (keys) DO NOTHING``; returns how many rows were new."""
        batch, touched = self._folded(batch, order_cols, "first")
        if not touched:
            return 0
        fresh = batch.join(merging(self._stored(touched).select(*self.keys)), self.keys, "left_anti")
        names = self.schema.names
        fresh = fresh.select(*names).withColumn(BUCKET, _bucket(self.keys, self.buckets))
        ready = self.spark.read.schema(fresh.schema).parquet(_scratch(fresh, "keyed-fresh"))
        added = ready.count()
        if added:
            ready.repartition(len(touched), BUCKET).write.mode("append").partitionBy(BUCKET).parquet(f"{self.path}/data")
            self._check(touched)
        return added


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _any_null(keys: Sequence[str]) -> Column:
    out = F.lit(False)
    for k in keys:
        out = out | F.col(k).isNull()
    return out


def _scratch(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return path
