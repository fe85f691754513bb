"""The factor lake: parquet partitioned by factor and year, upserted so that new rows win.

Layout: {root}/factors/factor_id=.../year=.../ with datetime, asset and value (float), and
{root}/catalog/factor_id=.../ with one row per factor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factorloom.functions.common import cut_lineage, trimmed
from factorloom.plans.dsl import Node

SCHEMA = "datetime timestamp, asset string, value float"
CATALOG = "ast_hash string, expression string, start_date string, end_date string, row_count long, last_updated timestamp"


FILE_ROWS = 20_000_000  # rows of one file of the lake, some 200 MB


class HashMismatch(ValueError):
    """A factor id that stands for another expression already."""


def tree_hash(node: Node) -> str:
    return hashlib.sha256(str(node).encode()).hexdigest()


def lake_rows(df: DataFrame, timestamp: str = "timestamp", instrument: str = "instrument", value: str = "value") -> DataFrame:
    """datetime, asset, value (float) of the rows that can be stored: keys known, value finite."""
    v = F.col(value).cast("float")
    out = df.select(F.col(timestamp).cast("timestamp").alias("datetime"), trimmed(F.col(instrument).cast("string")).alias("asset"), v.alias("value"))
    return out.filter(F.col("datetime").isNotNull() & F.col("asset").isNotNull() & (F.abs(F.col("value")) < float("inf")))


def merge_new(old: DataFrame, new: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Rows of both by key, those of new in front of those of old; of repeated keys the greatest row.

    One shuffle with a map-side merge; the result has old's columns.
    """
    keys = list(keys)
    values = [c for c in old.columns if c not in keys]
    both = old.select(*keys, F.struct(F.lit(0).alias("_new"), *values).alias("_r")).unionByName(new.select(*keys, F.struct(F.lit(1).alias("_new"), *values).alias("_r")))
    return both.groupBy(*keys).agg(F.max("_r").alias("_r")).select(*[F.col(k) if k in keys else F.col("_r")[k].alias(k) for k in old.columns])


class Lake:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return bool(p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p))

    def _factor(self, factor_id: str) -> str:
        return f"{self.root}/factors/factor_id={factor_id}"

    def read(self, factor_id: str, start: str | None = None, end: str | None = None, assets: Iterable[str] | None = None) -> DataFrame:
        """timestamp, instrument, value; years outside start and end (inclusive) aren't listed, assets reach the scan."""
        path = self._factor(factor_id)
        if not self._exists(path):
            return self.spark.createDataFrame([], SCHEMA).select(F.col("datetime").alias("timestamp"), F.col("asset").alias("instrument"), "value")
        df = self.spark.read.schema(f"{SCHEMA}, year int").parquet(path)
        if start is not None:
            df = df.filter((F.col("year") >= int(start[:4])) & (F.col("datetime") >= F.lit(start).cast("timestamp")))
        if end is not None:
            df = df.filter((F.col("year") <= int(end[:4])) & (F.col("datetime") <= F.lit(end).cast("timestamp")))
        if assets is not None:
            df = df.filter(F.col("asset").isin([str(a).strip() for a in assets]))
        return df.select(F.col("datetime").alias("timestamp"), F.col("asset").alias("instrument"), "value")

    def catalog(self, factor_id: str | None = None) -> DataFrame:
        path = f"{self.root}/catalog"
        if not self._exists(path):
            return self.spark.createDataFrame([], f"{CATALOG}, factor_id string")
        df = self.spark.read.schema(f"{CATALOG}, factor_id string").parquet(path)
        return df if factor_id is None else df.filter(F.col("factor_id") == factor_id)

    def write(self, factor_id: str, df: DataFrame, node: Node | None = None, **columns: str) -> int:
        """Upserts df's rows of a factor and its catalog entry; returns the factor's rows in all.

        Only the years that df has rows of are read and written, each as a whole; writing the same rows
        again changes nothing. A factor id stored with another expression raises HashMismatch.
        """
        digest = tree_hash(node) if node is not None else None
        known = self.catalog(factor_id).select("ast_hash").first()
        if known is not None and digest and known.ast_hash and known.ast_hash != digest:
            raise HashMismatch(f"{factor_id} is registered with another expression")
        new = lake_rows(df, **columns)
        years = [r.y for r in new.select(F.year("datetime").alias("y")).distinct().collect()]  # one row a year
        path = self._factor(factor_id)
        if years:
            old = self.spark.createDataFrame([], SCHEMA)
            if self._exists(path):
                old = self.spark.read.schema(f"{SCHEMA}, year int").parquet(path).filter(F.col("year").isin(years)).drop("year")
            merged = cut_lineage(merge_new(old, new, ["datetime", "asset"]))  # before the old files go
            out = merged.withColumn("year", F.year("datetime"))
            files = max(1, -(-merged.count() // FILE_ROWS))  # a large year is several tasks and files
            out = out.repartition(len(years) * files, "year", F.pmod(F.xxhash64("asset"), F.lit(files))).sortWithinPartitions("asset", "datetime")
            out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)
        whole = self.read(factor_id).agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b"), F.count("*").alias("n")).first()
        day = lambda t: str(t)[:10] if t else None
        entry = self.spark.createDataFrame([(digest, str(node) if node is not None else None, day(whole.a), day(whole.b), whole.n)], CATALOG.rsplit(", ", 1)[0])
        entry.withColumn("last_updated", F.current_timestamp()).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/catalog/factor_id={factor_id}")
        return whole.n

    def delete(self, factor_id: str) -> None:
        for path in (self._factor(factor_id), f"{self.root}/catalog/factor_id={factor_id}"):
            p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
