"""Raw tables to clean ones: lists exploded, keys and times normalised, a stable hash key, duplicates gone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorloom.functions.common import key_upper


def explode_lists(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A row per element of each list column in turn; a null or empty list keeps one row with null."""
    for c in columns:
        df = df.withColumn(c, F.explode_outer(c))
    return df


def hash_key(*columns: str) -> Column:
    """A stable hash of the key columns' texts, nulls included."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]), 256)


def clean_table(df: DataFrame, *, key: Sequence[str], lists: Sequence[str] = (), tickers: Sequence[str] = (), align_by: str | None = None, key_name: str = "row_key") -> DataFrame:
    """df exploded, tickers trimmed and upper case, with key_name, and one row per key.

    Of rows of one key the last by align_by counts (nulls first), ties and no align_by being settled
    by the greatest row of the other columns, so the result doesn't depend on the order of rows.
    """
    df = explode_lists(df, lists)
    df = df.withColumns({c: key_upper(c) for c in tickers})
    rest = [c for c in df.columns if c not in key]
    pick = F.max(F.struct(*([F.col(align_by).alias("_by")] if align_by else []), *rest)).alias("_r")
    out = df.groupBy(*key).agg(pick).select(*key, *[F.col("_r")[c].alias(c) for c in rest])
    return out.withColumn(key_name, hash_key(*key))
