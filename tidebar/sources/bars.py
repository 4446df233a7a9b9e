"""Bars: from the event and line-item tables, and scans over a bar table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import INTERVALS, LOOKBACK

TYPES = ("click", "error", "purchase", "signup", "view")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bars_from_events(spark: SparkSession, sf_dir: str, interval: str = "60") -> DataFrame:
    """Open, high, low, close and volume of ``value`` by event type and interval.

    Known types are numbered, others get an id from their name, so each type is a series of its own. A
    type's times are distinct, as a bar's open and close need; of equal times any counts.
    """
    minutes = INTERVALS[interval]
    e = read(spark, sf_dir, "events").select("event_type", "ts", "value", F.window("ts", f"{minutes} minutes").alias("w"))
    rank = F.coalesce(*[F.when(F.col("event_type") == t, F.lit(i + 1)) for i, t in enumerate(TYPES)], F.pmod(F.xxhash64("event_type"), F.lit(1 << 40)) + 1000).cast("long")
    out = e.groupBy(rank.alias("asset_id"), F.col("w.start").alias("time")).agg(
        F.min_by("value", "ts").alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", "ts").alias("close"), F.sum("value").alias("volume")
    )
    return out.select("asset_id", F.lit(interval).alias("interval_min"), F.col("time").cast("timestamp_ntz").alias("time"), "open", "high", "low", "close", "volume")


def bars_sql(interval: str = "60") -> str:
    rank = " ".join(f"WHEN '{t}' THEN {i + 1}" for i, t in enumerate(TYPES))
    return (
        f"SELECT CAST(CASE event_type {rank} END AS BIGINT) AS asset_id, '{interval}' AS interval_min, time_bucket(INTERVAL '{INTERVALS[interval]} minutes', ts) AS time, "
        "arg_min(value, ts) AS open, max(value) AS high, min(value) AS low, arg_max(value, ts) AS close, sum(value) AS volume FROM events GROUP BY 1, 2, 3"
    )


def with_close_time(bars: DataFrame) -> DataFrame:
    """time_close: time plus the interval; unknown codes count as one minute."""
    minutes = F.coalesce(F.create_map(*[F.lit(x) for kv in INTERVALS.items() for x in kv])[F.col("interval_min")], F.lit(1))
    return bars.withColumn("time_close", F.col("time") + F.make_dt_interval(mins=minutes))


def scan(bars: DataFrame, assets=None, interval: str | None = None, start=None, end=None, lookback: int = LOOKBACK) -> DataFrame:
    """Bars of a range (both ends belong to it) after ``lookback`` warm-up intervals; is_target marks the range itself."""
    if assets is not None:
        bars = bars.where(F.col("asset_id").isin(list(assets)))
    if interval is not None:
        bars = bars.where(F.col("interval_min") == interval)
    if end is not None:
        bars = bars.where(F.col("time") <= F.lit(end).cast("timestamp_ntz"))
    if start is None:
        return bars.withColumn("is_target", F.lit(True))
    first = F.lit(start).cast("timestamp_ntz")
    bars = bars.where(F.col("time") >= first - F.make_dt_interval(mins=F.lit(lookback * INTERVALS.get(interval or "1", 1))))
    return bars.withColumn("is_target", F.col("time") >= first)


def scan_from_gaps(bars: DataFrame, gaps: DataFrame, end=None, lookback: int = LOOKBACK) -> DataFrame:
    """Bars of the series in gaps (asset_id, interval_min, first_gap) from ``lookback`` intervals before their first gap on;
    is_target marks those at or after it."""
    if end is not None:
        bars = bars.where(F.col("time") <= F.lit(end).cast("timestamp_ntz"))
    minutes = F.coalesce(F.create_map(*[F.lit(x) for kv in INTERVALS.items() for x in kv])[F.col("interval_min")], F.lit(1))
    rows = bars.join(gaps, ["asset_id", "interval_min"]).where(F.col("time") >= F.col("first_gap") - F.make_dt_interval(mins=minutes * lookback))
    return rows.withColumn("is_target", F.col("time") >= F.col("first_gap")).drop("first_gap")


def count_bars(bars: DataFrame, asset_id: int | None = None, interval: str | None = None, start=None, end=None) -> DataFrame:
    """How many bars meet the conditions that are given; both ends belong to the range."""
    return scan(bars, None if asset_id is None else [asset_id], interval, start, end, lookback=0).agg(F.count(F.lit(1)).alias("n"))


def time_range(bars: DataFrame) -> DataFrame:
    return bars.groupBy("asset_id", "interval_min").agg(F.min("time").alias("min_time"), F.max("time").alias("max_time"), F.count(F.lit(1)).alias("n"))


def selected_assets(assets: DataFrame) -> DataFrame:
    """Assets of the current run with the name to show."""
    return assets.where("selected_in_current_run = 1").select("id", F.coalesce("pair", "kraken_symbol", "bybit_symbol").alias("name"))
