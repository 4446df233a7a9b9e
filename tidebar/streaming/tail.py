"""Bars that arrive as a stream: touched series are computed again from their look-back on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def event_bars(events: DataFrame, minutes: int, late: str = "1 hour") -> DataFrame:
    """Closed bars from a stream of events (event_type, ts, value); events later than the watermark are dropped."""
    w = F.window("ts", f"{minutes} minutes")
    return (
        events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy("event_type", w.alias("w"))
        .agg(F.min_by("value", "ts").alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", "ts").alias("close"), F.sum("value").alias("volume"))
        .select("event_type", F.col("w.start").alias("time"), "open", "high", "low", "close", "volume")
    )


def recompute_tail(stored_bars: Callable[[], DataFrame], compute: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame], None], lookback: int) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: rows of the new bars and later ones, computed over their series' last ``lookback`` bars before them.

    Window indicators equal a full run's where lookback is as long as their frame. Averages with an unlimited memory differ by what they have
    forgotten after lookback bars, and OBV by a constant, as it counts from the first bar it sees.
    """

    def run(batch: DataFrame, _: int) -> None:
        first = batch.groupBy("asset_id", "interval_min").agg(F.min("time").alias("first"))
        rows = stored_bars().join(first, ["asset_id", "interval_min"])
        age = Window.partitionBy("asset_id", "interval_min", F.col("time") < F.col("first")).orderBy(F.desc("time"))
        rows = rows.withColumn("age", F.row_number().over(age)).where((F.col("time") >= F.col("first")) | (F.col("age") <= lookback))
        found = compute(rows.drop("age", "first"))
        write(found.join(first, ["asset_id", "interval_min"]).where("time >= first").drop("first"))

    return run
