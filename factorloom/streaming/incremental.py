"""Keeping tables up to date from streams: micro-batches upserted, and watermarked event windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from factorloom.sources.lake import Lake


def stream_to_lake(stream: DataFrame, lake: Lake, factor_id: str, checkpoint: str, **columns: str) -> StreamingQuery:
    """Upserts each micro-batch of factor values; a batch that is replayed changes nothing.

    columns as in lake.lake_rows. Runs over what is there and stops (availableNow).
    """

    def write(batch: DataFrame, _: int) -> None:
        lake.write(factor_id, batch, **columns)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_bars(stream: DataFrame, *, time: str, key: str, price: str, volume: str, width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Bars of a stream of ticks: open, high, low, close, volume and ticks per key and window, late ticks within the watermark."""
    order = F.struct(time, price)
    return (
        stream.withWatermark(time, late)
        .groupBy(F.window(time, width), key)
        .agg(
            F.min_by(price, order).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, order).alias("close"), F.sum(volume).alias("volume"), F.count("*").alias("ticks")
        )
        .select(F.col("window.start").alias("timestamp"), F.col(key).alias("instrument"), "open", "high", "low", "close", "volume", "ticks")
    )
