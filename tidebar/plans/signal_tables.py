"""From bars to the indicator table and the three signal tables, and their multi-timeframe join."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params
from ..functions import signals, windowed
from ..operators import profile, recursive
from ..sources.bars import with_close_time

KEY = ["asset_id", "interval_min", "time"]
#: Computed name to stored name, where they differ (fixed values).
STORED = {"plus_di_14": "dm_plus_14", "minus_di_14": "dm_minus_14", "ao": "ao_5_34", "supertrend_dir_10_3": "supertrend_direction"}
SOURCE = "spark_backfill"


def indicators(bars: DataFrame) -> DataFrame:
    """Bars with all indicator columns under their computed names. One shuffle by series serves the whole plan."""
    return recursive.with_recursive(windowed.apply(bars), profile.profile, profile.COLUMNS)


def indicator_table(frame: DataFrame) -> DataFrame:
    """The stored columns of an indicator frame."""
    names = [f"sma_{n}" for n in params.SMA if n not in (7, 25, 99)] + ["bb_middle", "bb_upper", "bb_lower", "stoch_k", "stoch_d", *windowed.ICHI_COLUMNS, "obv", "cmf", "ao", *[c for c in recursive.COLUMNS if not c.startswith(("supertrend_10_1", "supertrend_10_2", "supertrend_dir_10_1", "supertrend_dir_10_2"))], *profile.COLUMNS]
    return frame.select(*KEY, "open", "high", "low", "close", "volume", *[F.col(n).alias(STORED.get(n, n)) for n in names], F.lit(SOURCE).alias("source_script"))


def signal_table(frame: DataFrame, kind: str, thresholds: dict = params.THRESHOLDS) -> DataFrame:
    """One class's signals with their concordance, for each bar of an indicator frame."""
    layers = [signals.derived(), signals.columns(kind, thresholds), signals.concordance(kind)]
    for layer in layers:
        frame = frame.select("*", *[F.expr(signals.dialect(sql, True)).alias(name) for name, sql in layer.items()])
    return with_close_time(frame).select("asset_id", "interval_min", "time", "time_close", *layers[1], *layers[2], F.lit(SOURCE).alias("source_script"))


def multi_timeframe(base: DataFrame, higher: dict[str, DataFrame], columns: list[str], start=None, end=None, once: bool = False) -> DataFrame:
    """Base rows (one-minute bars) with the last closed bar of every higher timeframe, without looking ahead.

    Timeframe rows are found by equality on the close time rounded down to the bucket; a base row without
    one in each is left out. The sides join by asset and bucket: Spark broadcasts a side or merges by the
    sizes that it sees. start and end: base rows that close in [start, end). With once, base rows that repeat an asset and a
    time count once.
    """
    if once:
        base = base.dropDuplicates(["asset_id", "time"])
    base = base.select("asset_id", F.col("time").alias("time_1"), F.col("time_close").alias("time_close_1"), *[F.col(c).alias(f"{c}_1") for c in columns])
    if start is not None:
        base = base.where(F.col("time_close_1") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        base = base.where(F.col("time_close_1") < F.lit(end).cast("timestamp_ntz"))
    for code in higher:
        base = base.withColumn(f"bucket_{code}", F.window("time_close_1", f"{params.INTERVALS[code]} minutes").start.cast("timestamp_ntz"))
    for code, table in higher.items():
        suffix = code.lower()
        side = table.select("asset_id", F.col("time").alias(f"time_{suffix}"), F.col("time_close").alias(f"time_close_{suffix}"), F.col("time_close").alias(f"bucket_{code}"), *[F.col(c).alias(f"{c}_{suffix}") for c in columns])
        base = base.join(side, ["asset_id", f"bucket_{code}"]).drop(f"bucket_{code}")
    return base


def lookahead_violations(mtf: DataFrame, suffixes=("60", "240", "d")) -> DataFrame:
    late = [F.coalesce(F.col(f"time_close_{s}") > F.col("time_close_1"), F.lit(False)) for s in suffixes]
    return mtf.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(x).alias(f"violations_{s}") for x, s in zip(late, suffixes, strict=True)])


def _late(suffix: str):
    return F.col(f"time_close_{suffix}") > F.col("time_close_1")


def lookahead_sample(mtf: DataFrame, n: int = 10, suffixes=("d", "240", "60")) -> DataFrame:
    """The first n rows, by asset and time, that hold a bar which wasn't closed, and the timeframe of the largest such bar."""
    kind = F.coalesce(*[F.when(_late(s), F.lit(f"{s.upper()} lookahead")) for s in suffixes])
    times = [c for s in suffixes for c in (f"time_{s}", f"time_close_{s}")]
    return mtf.select("asset_id", "time_1", "time_close_1", *times, kind.alias("violation_type")).where("violation_type IS NOT NULL").orderBy("asset_id", "time_1").limit(n)


def verify(mtf: DataFrame, kind: str, asset_id: int, suffixes=("d", "240", "60")) -> DataFrame:
    """One row: the asset's rows, how many of them look ahead, and whether none does."""
    late = F.coalesce(F.greatest(*[F.coalesce(_late(s), F.lit(False)) for s in suffixes]), F.lit(False))
    out = mtf.where(F.col("asset_id") == asset_id).agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(late).alias("violations"))
    bad = F.concat(F.col("violations").cast("string"), F.lit(" rows with lookahead bias!"))
    passed = F.col("violations") == 0
    return out.select(F.lit(kind).alias("classification"), F.lit(asset_id).alias("asset_id"), "total_rows", "violations", passed.alias("passed"), F.when(passed, F.lit("No lookahead bias detected")).otherwise(bad).alias("message"))


def latest_rows(mtf: DataFrame, asset_id: int, n: int = 5, suffixes=("d", "240", "60")) -> DataFrame:
    """An asset's newest n rows, the bars of each timeframe as 'time - close'."""
    span = lambda s: F.concat_ws(" - ", F.col(f"time_{s}").cast("string"), F.col(f"time_close_{s}").cast("string")).alias(f"bar_{s}")
    return mtf.where(F.col("asset_id") == asset_id).orderBy(F.desc("time_1")).limit(n).select("asset_id", "time_1", "time_close_1", *[span(s) for s in suffixes])


def signal_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, new_columns): how many columns of graded signals and concordances each table has."""
    spark = next(iter(tables.values())).sparkSession
    of = lambda t: sum(bool(re.search(r".signal.", c)) or bool(re.match(r"concordance.", c)) for c in t.columns)
    return spark.createDataFrame([(name, of(t)) for name, t in tables.items()], "table_name string, new_columns long")


def latest(table: DataFrame) -> DataFrame:
    """The newest row's concordance of each series."""
    row = F.max_by(F.struct("time", "concordance_sum", "concordance_count", "concordance_score"), "time")
    return table.groupBy("asset_id", "interval_min").agg(row.alias("r")).select("asset_id", "interval_min", "r.*")
