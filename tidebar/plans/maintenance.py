"""Gaps, upserts and enrichment of stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def missing(bars: DataFrame, table: DataFrame, key: list[str]) -> DataFrame:
    """Bars without a row in table."""
    return bars.join(table.select(*key), key, "left_anti")


def first_gap(bars: DataFrame, table: DataFrame, warmup_days: int = 32) -> DataFrame:
    """The first missing time of each series after its warm-up."""
    after = bars.groupBy("asset_id", "interval_min").agg((F.min("time") + F.make_dt_interval(days=F.lit(warmup_days))).alias("after"))
    gaps = missing(bars, table, ["asset_id", "interval_min", "time"]).join(after, ["asset_id", "interval_min"])
    return gaps.where("time >= after").groupBy("asset_id", "interval_min").agg(F.min("time").alias("first_gap"))


def gap_summary(bars: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """How many bars each table lacks, by series; series without gaps are left out."""
    out = None
    for name, table in tables.items():
        part = missing(bars, table, ["asset_id", "interval_min", "time"]).groupBy("asset_id", "interval_min").agg(F.count(F.lit(1)).alias("missing")).withColumn("table_name", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def upsert(old: DataFrame, new: DataFrame, key: list[str], newest: str | None = None) -> DataFrame:
    """One row for each key: that of new where new has the key, else that of old. Write the result to another path than old's.

    Of rows in new that repeat a key, the one with the largest ``newest`` (else the largest values) counts. Nulls in a
    key equal each other. One shuffle by the key, with map-side combination; a table of key columns only is
    a distinct union, so rows that are there stay.
    """
    rest = [c for c in new.columns if c not in key]
    both = old.select(*new.columns, F.lit(0).alias("__new")).unionByName(new.withColumn("__new", F.lit(1)))
    row = F.max(F.struct("__new", *([F.col(newest).alias("__newest")] if newest else []), *rest)).alias("__row")
    return both.groupBy(*key).agg(row).select(*[F.col(c) if c in key else F.col("__row")[c].alias(c) for c in new.columns])


def latest_version(spark: SparkSession, path: str) -> int:
    """The number of the newest complete version of a stored table; 0 if there is none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(where):
        return 0
    found = [x.getPath() for x in files.listStatus(where) if x.getPath().getName().startswith("v")]
    return max((int(x.getName()[1:]) for x in found if files.exists(spark._jvm.org.apache.hadoop.fs.Path(x, "_SUCCESS"))), default=0)


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    n = latest_version(spark, path)
    return spark.read.parquet(f"{path}/v{n}") if n else None


def write_upsert(new: DataFrame, path: str, key: list[str], newest: str | None = None) -> DataFrame:
    """Upserts into the table at path: a complete new version beside the others, which readers see only when it is whole.

    Rows are laid out by series and, within it, by falling time, for lookups of a series' latest rows.
    A run that fails leaves no visible trace, and one that is repeated gives the same table.
    """
    spark, n = new.sparkSession, latest_version(new.sparkSession, path)
    old = spark.read.parquet(f"{path}/v{n}") if n else new.limit(0)
    series = [c for c in ("asset_id", "interval_min") if c in new.columns]
    times = [c for c in ("time_close", "time", "time_1") if c in new.columns][:1]
    rows = upsert(old, new, key, newest)
    if series and times:
        rows = rows.repartitionByRange(*series, *times).sortWithinPartitions(*series, *[F.desc(c) for c in times])
    rows.write.mode("overwrite").parquet(f"{path}/v{n + 1}")
    return spark.read.parquet(f"{path}/v{n + 1}")


def write_all(tables: dict[str, DataFrame], root: str, key: list[str]) -> dict[str, DataFrame]:
    """Upserts several tables, each at its name below root."""
    return {name: write_upsert(table, f"{root}/{name}", key) for name, table in tables.items()}


def enrich_atr(mtf: DataFrame, indicators: DataFrame, overwrite: bool = False) -> DataFrame:
    """atr_at_signal from the one-minute indicator rows (of repeated ones the largest); values that are there stay unless overwrite."""
    atr = indicators.where("interval_min = '1' AND atr_14 > 0").groupBy("asset_id", F.col("time").alias("time_1")).agg(F.max("atr_14").alias("atr_14"))
    both = ("atr_14", "atr_at_signal") if overwrite else ("atr_at_signal", "atr_14")
    return mtf.join(atr, ["asset_id", "time_1"], "left").withColumn("atr_at_signal", F.coalesce(*both)).drop("atr_14")


def _after_warmup(rows: DataFrame, time: str, warmup_days: int) -> DataFrame:
    """Each asset's first time plus its warm-up, as ``after``."""
    return rows.groupBy("asset_id").agg((F.min(time) + F.make_dt_interval(days=F.lit(warmup_days))).alias("after"))


def mtf_first_gap(signals: DataFrame, mtf: DataFrame, assets=None, end=None, warmup_days: int = 32) -> DataFrame:
    """The first one-minute signal time without a multi-timeframe row, over all assets, after each one's warm-up (one row)."""
    ones = signals.where("interval_min = '1'").select("asset_id", "time")
    if assets is not None:
        ones = ones.where(F.col("asset_id").isin(list(assets)))
    rows = ones.join(_after_warmup(ones, "time", warmup_days), "asset_id").where("time >= after")
    if end is not None:
        rows = rows.where(F.col("time") <= F.lit(end).cast("timestamp_ntz"))
    return rows.join(mtf.select("asset_id", F.col("time_1").alias("time")), ["asset_id", "time"], "left_anti").agg(F.min("time").alias("first_gap"))


def _unfilled(mtf: DataFrame, warmup_days: int) -> DataFrame:
    return mtf.join(_after_warmup(mtf, "time_1", warmup_days), "asset_id").where("atr_at_signal IS NULL AND time_1 >= after")


def atr_first_gap(mtf: DataFrame, end=None, warmup_days: int = 32) -> DataFrame:
    """The first time without an ATR over all assets, after each one's warm-up (one row)."""
    rows = _unfilled(mtf, warmup_days)
    if end is not None:
        rows = rows.where(F.col("time_1") <= F.lit(end).cast("timestamp_ntz"))
    return rows.agg(F.min("time_1").alias("first_gap"))


def rows_to_fill(mtf: DataFrame, start, end, gap_fill: bool = False, warmup_days: int = 32) -> DataFrame:
    """Keys of the rows whose ATR is to be filled: those without one or, with gap_fill, all rows of an asset from its
    first gap on. An asset without a gap has none."""
    inside = F.col("time_1").between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))
    if not gap_fill:
        return mtf.where(F.col("atr_at_signal").isNull() & inside).select("asset_id", "time_1")
    first = _unfilled(mtf, warmup_days).groupBy("asset_id").agg(F.min("time_1").alias("first_gap"))
    return mtf.where(inside).join(first, "asset_id").where("time_1 >= first_gap").select("asset_id", "time_1")


def time_slices(mtf: DataFrame, n: int, start=None) -> DataFrame:
    """(part, start, end): n equal slices from the first to the last row without an ATR; with start, from there to the last row.

    The last slice ends at the last time. No row without an ATR, no slices.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    low, high = (F.min(micros("time_1")), F.max(micros("time_1")))
    ends = (mtf.where("atr_at_signal IS NULL") if start is None else mtf).agg(low.alias("low"), high.alias("high")).where("low IS NOT NULL")
    if start is not None:
        ends = ends.withColumn("low", F.unix_micros(F.lit(start).cast("timestamp")))
    step = F.floor((F.col("high") - F.col("low")) / n)
    ntz = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    rows = ends.select("low", "high", step.alias("step"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("part"))
    end = F.when(F.col("part") == n - 1, F.col("high")).otherwise(F.col("low") + F.col("step") * (F.col("part") + 1))
    return rows.select("part", ntz(F.col("low") + F.col("step") * F.col("part")).alias("start"), ntz(end).alias("end"))


def date_chunks(earliest: DataFrame, end, start=None, months: int = 2, days: int = 0) -> DataFrame:
    """(chunk_start, chunk_end, asset_id): chunks of days or months up to end, and the assets with data before a chunk's end.

    earliest: (asset_id, first), each asset's first time. Without start the chunks begin at the earliest of all.
    """
    step = F.make_dt_interval(days=F.lit(days)) if days > 0 else F.make_ym_interval(months=F.lit(months))
    begin = earliest.agg(F.min("first")).first()[0] if start is None else start
    if begin is None:
        return earliest.select(F.col("first").alias("chunk_start"), F.col("first").alias("chunk_end"), "asset_id").limit(0)
    begin, stop = (F.lit(x).cast("timestamp_ntz") for x in (begin, end))
    starts = F.filter(F.when(begin < stop, F.sequence(begin, stop, step)), lambda x: x < stop)
    ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))), F.array(stop))
    rows = earliest.select("asset_id", "first", F.explode(F.arrays_zip(starts.alias("a"), ends.alias("b"))).alias("x"))
    return rows.where(F.col("first") < F.col("x.b")).select(F.col("x.a").alias("chunk_start"), F.col("x.b").alias("chunk_end"), "asset_id")


def earliest_times(signals: DataFrame, assets=None) -> DataFrame:
    """(asset_id, first): the first one-minute time of each asset."""
    ones = signals.where("interval_min = '1'")
    if assets is not None:
        ones = ones.where(F.col("asset_id").isin(list(assets)))
    return ones.groupBy("asset_id").agg(F.min("time").alias("first"))


def fill_status(mtf: DataFrame) -> DataFrame:
    return mtf.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("atr_at_signal").isNull()).alias("missing"), F.count("atr_at_signal").alias("filled"))
