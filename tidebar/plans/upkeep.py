"""Registered queries of scans, sinks, gap filling and verification, and the SQL that checks them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params
from ..sources import bars as B
from . import entries, maintenance, oracle, signal_oracle, signal_tables

SCALES = ("1", "60", "240", "D")


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.bars_from_events(spark, sf_dir)


def distinct_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for code in SCALES:
        part = B.bars_from_events(spark, sf_dir, code).select("interval_min")
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def filtered_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, out = _hourly(spark, sf_dir), None
    for name, given in (("all", {}), ("asset", {"asset_id": 2}), ("range", {"interval": "60", "start": "2024-01-05", "end": "2024-01-09"}), ("none", {"interval": "5"})):
        part = B.count_bars(b, **given).withColumn("what", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def gap_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, stored = entries._half(spark, sf_dir)
    gaps = maintenance.first_gap(b, stored, warmup_days=3)
    return B.scan_from_gaps(b, gaps, end="2024-01-20", lookback=24).select("asset_id", "time", "close", "is_target")


def own_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leading signals under thresholds from a table."""
    table = spark.sql("SELECT * FROM VALUES ('RSI', 'oversold', 45.0D), ('RSI', 'overbought', 55.0D), ('STOCHASTIC', 'oversold', 25.0D), ('RSI', 'unused', NULL) AS t(indicator_base, threshold_name, threshold_value)")
    frame = signal_tables.indicators(_hourly(spark, sf_dir))
    found = signal_tables.signal_table(frame, "lead", params.thresholds(table))
    return found.select("asset_id", "time", "rsi_oversold", "rsi_overbought", "rsi_signal", "stoch_oversold", "stoch_overbought")


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {c: entries.band_signal(B.bars_from_events(spark, sf_dir, c)) for c in SCALES}


def signal_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The multi-timeframe join of base rows that close in a range."""
    t = _tables(spark, sf_dir)
    return signal_tables.multi_timeframe(t.pop("1"), t, entries.MTF_COLUMNS, start="2024-01-10", end="2024-01-20")


def mtf_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The multi-timeframe join of a base that repeats its rows."""
    t = _tables(spark, sf_dir)
    base = t.pop("1")
    return signal_tables.multi_timeframe(base.unionByName(base), t, entries.MTF_COLUMNS, once=True)


def earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintenance.earliest_times(B.bars_from_events(spark, sf_dir, "1"), [1, 2, 5])


def mtf_first_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = entries._mtf(spark, sf_dir).where("(minute(time_1) + asset_id) % 7 <> 0")
    return maintenance.mtf_first_gap(B.bars_from_events(spark, sf_dir, "1"), stored, assets=[1, 2, 3], end="2024-01-28", warmup_days=5)


def _some_atr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-minute rows, some without an ATR; asset 5 has all of them."""
    ones = B.bars_from_events(spark, sf_dir, "1")
    return ones.select("asset_id", F.col("time").alias("time_1"), F.when((F.col("asset_id") == 5) | ((F.hour("time") + F.col("asset_id")) % 6 != 0), F.lit(1.0)).alias("atr_at_signal"))


def atr_first_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintenance.atr_first_gap(_some_atr(spark, sf_dir), end="2024-01-28", warmup_days=4)


def atr_rows_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintenance.rows_to_fill(_some_atr(spark, sf_dir), "2024-01-03", "2024-01-20")


def atr_rows_from_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintenance.rows_to_fill(_some_atr(spark, sf_dir), "2024-01-03", "2024-01-20", gap_fill=True, warmup_days=4)


def time_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintenance.time_slices(_some_atr(spark, sf_dir), 7)


def date_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of nine days; the third of the assets begins later."""
    ones = B.bars_from_events(spark, sf_dir, "1").where("asset_id <> 3 OR time >= '2024-01-15'")
    return maintenance.date_chunks(maintenance.earliest_times(ones), "2024-01-31", start="2024-01-01", days=9)


def _early(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A multi-timeframe table with rows that look ahead."""
    early = lambda s, m: F.when(F.minute("time_1") == m, F.expr("time_close_1 + INTERVAL 1 HOUR")).otherwise(F.col(f"time_close_{s}"))
    return entries._mtf(spark, sf_dir).withColumn("time_close_60", early("60", 7)).withColumn("time_close_d", early("d", 11))


def lookahead_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signal_tables.lookahead_sample(_early(spark, sf_dir))


def lookahead_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = entries._mtf(spark, sf_dir), _early(spark, sf_dir)
    return signal_tables.verify(good, "coin", 2).unionByName(signal_tables.verify(bad, "lead", 3))


def latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signal_tables.latest_rows(entries._mtf(spark, sf_dir), 1)


def signal_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the three multi-timeframe tables."""
    tables = {c: B.bars_from_events(spark, sf_dir, c) for c in SCALES}
    frames = {c: signal_tables.indicators(t) for c, t in tables.items()}
    out = {}
    for kind in ("lead", "coin", "conf"):
        sides = {c: signal_tables.signal_table(f, kind) for c, f in frames.items()}
        names = [c for c in sides["1"].columns if c not in ("asset_id", "interval_min", "time", "time_close", "source_script")]
        out[f"mtf_signals_{kind}"] = signal_tables.multi_timeframe(sides.pop("1"), sides, names)
    return signal_tables.signal_columns(out)


def upsert_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals upserted twice into a stored table: a part, then later rows, some of which repeat a key."""
    rows = entries.band_signal(_hourly(spark, sf_dir)).select(*signal_tables.KEY, "time_close", "bb_signal", F.lit(1).alias("source"))
    later = rows.where("hour(time) < 12")
    repeated = later.withColumn("source", F.lit(2)).unionByName(later.withColumn("source", F.lit(3)).withColumn("bb_signal", F.lit(9)))
    return _stored(spark, [rows.where("(asset_id + hour(time)) % 5 <> 0"), repeated], signal_tables.KEY, "source").drop("interval_min")


def upsert_mtf(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = entries._mtf(spark, sf_dir).select("asset_id", "time_1", "close_1", "close_60")
    new = rows.where("minute(time_1) < 30").withColumn("close_60", F.lit(0.0))
    return _stored(spark, [rows.where("minute(time_1) >= 20"), new], ["asset_id", "time_1"])


def upsert_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of key columns only: rows that are there stay."""
    keys = _hourly(spark, sf_dir).select("asset_id", "time")
    return _stored(spark, [keys.where("asset_id < 4"), keys.where("asset_id > 2")], ["asset_id", "time"])


def _stored(spark: SparkSession, batches: list[DataFrame], key: list[str], newest: str | None = None) -> DataFrame:
    """The batches upserted one after the other into a new table in the shared folder."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='tidebar-')}"
        sc.setCheckpointDir(root)
    path = f"{root}/upsert-{uuid.uuid4().hex}"
    for batch in batches:
        maintenance.write_upsert(batch, path, key, newest)
    return maintenance.stored(spark, path)


QUERIES: dict[str, Callable] = {f.__name__: f for f in (distinct_intervals, filtered_count, gap_scan, own_thresholds, signal_scan, mtf_once, earliest, mtf_first_gap, atr_first_gap, atr_rows_missing, atr_rows_from_gap, time_slices, date_chunks, lookahead_sample, lookahead_verdict, latest_rows, signal_columns, upsert_signals, upsert_mtf, upsert_keys)}

_H, _ONE, _MTF = f"({B.bars_sql()})", f"({B.bars_sql('1')})", f"({entries._mtf_sql()})"
_ATR = f"(SELECT asset_id, time AS time_1, CASE WHEN asset_id = 5 OR (hour(time) + asset_id) % 6 <> 0 THEN 1.0 END AS atr_at_signal FROM {_ONE})"
_GAPS = f"(SELECT *, time_1 >= min(time_1) OVER (PARTITION BY asset_id) + INTERVAL 4 DAY AND atr_at_signal IS NULL AS gap FROM {_ATR})"
_EARLY = f"(SELECT * REPLACE (CASE WHEN minute(time_1) = 7 THEN time_close_1 + INTERVAL 1 HOUR ELSE time_close_60 END AS time_close_60, CASE WHEN minute(time_1) = 11 THEN time_close_1 + INTERVAL 1 HOUR ELSE time_close_d END AS time_close_d) FROM {_MTF})"
_LATE = "(time_close_d > time_close_1 OR time_close_240 > time_close_1 OR time_close_60 > time_close_1)"

SQL: dict[str, str] = {
    "distinct_intervals": " UNION ".join(f"SELECT interval_min FROM ({B.bars_sql(c)})" for c in SCALES),
    "filtered_count": f"SELECT count(*) AS n, 'all' AS what FROM {_H} UNION ALL SELECT count(*), 'asset' FROM {_H} WHERE asset_id = 2 UNION ALL SELECT count(*), 'range' FROM {_H} WHERE time BETWEEN '2024-01-05' AND '2024-01-09' UNION ALL SELECT 0, 'none'",
    "gap_scan": f"WITH g AS (SELECT asset_id, min(time) AS gap FROM (SELECT *, min(time) OVER (PARTITION BY asset_id) AS since FROM {_H}) WHERE (asset_id + hour(time)) % 5 = 0 AND time >= since + INTERVAL 3 DAY GROUP BY 1) SELECT asset_id, time, close, time >= gap AS is_target FROM {_H} JOIN g USING (asset_id) WHERE time >= gap - INTERVAL 24 HOUR AND time <= '2024-01-20'",
    "own_thresholds": f"{oracle.with_base('60', True)} SELECT asset_id, time, CAST(coalesce(rsi_14 < 45, false) AS INT) AS rsi_oversold, CAST(coalesce(rsi_14 > 55, false) AS INT) AS rsi_overbought, CASE WHEN rsi_14 < 20 THEN 2 WHEN rsi_14 < 45 THEN 1 WHEN rsi_14 > 80 THEN -2 WHEN rsi_14 > 55 THEN -1 ELSE 0 END AS rsi_signal, CAST(coalesce(stoch_k < 25, false) AS INT) AS stoch_oversold, CAST(coalesce(stoch_k > 80, false) AS INT) AS stoch_overbought FROM full_rows",
    "signal_scan": f"SELECT * FROM {_MTF} WHERE time_close_1 >= '2024-01-10' AND time_close_1 < '2024-01-20'",
    "mtf_once": f"SELECT * FROM {_MTF}",
    "earliest": f"SELECT asset_id, min(time) AS first FROM {_ONE} WHERE asset_id IN (1, 2, 5) GROUP BY 1",
    "mtf_first_gap": f"WITH s AS (SELECT asset_id, time, min(time) OVER (PARTITION BY asset_id) + INTERVAL 5 DAY AS after FROM {_ONE}) SELECT min(s.time) AS first_gap FROM s LEFT JOIN {_MTF} m ON s.asset_id = m.asset_id AND s.time = m.time_1 AND (minute(m.time_1) + m.asset_id) % 7 <> 0 WHERE s.asset_id <= 3 AND s.time >= s.after AND s.time <= '2024-01-28' AND m.time_1 IS NULL",
    "atr_first_gap": f"SELECT min(time_1) AS first_gap FROM {_GAPS} WHERE gap AND time_1 <= '2024-01-28'",
    "atr_rows_missing": f"SELECT asset_id, time_1 FROM {_ATR} WHERE atr_at_signal IS NULL AND time_1 BETWEEN '2024-01-03' AND '2024-01-20'",
    "atr_rows_from_gap": f"SELECT asset_id, time_1 FROM (SELECT *, min(CASE WHEN gap THEN time_1 END) OVER (PARTITION BY asset_id) AS first_gap FROM {_GAPS}) WHERE time_1 >= first_gap AND time_1 BETWEEN '2024-01-03' AND '2024-01-20'",
    "time_slices": f"WITH e AS (SELECT epoch_us(min(time_1)) AS low, epoch_us(max(time_1)) AS high FROM {_ATR} WHERE atr_at_signal IS NULL) SELECT CAST(k AS INT) AS part, make_timestamp(low + (high - low) // 7 * k) AS \"start\", CASE WHEN k = 6 THEN make_timestamp(high) ELSE make_timestamp(low + (high - low) // 7 * (k + 1)) END AS \"end\" FROM e, range(7) t(k)",
    "date_chunks": f"WITH f AS (SELECT asset_id, min(time) AS first FROM {_ONE} WHERE asset_id <> 3 OR time >= '2024-01-15' GROUP BY 1), c AS (SELECT * FROM (VALUES (TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-10'), (TIMESTAMP '2024-01-10', TIMESTAMP '2024-01-19'), (TIMESTAMP '2024-01-19', TIMESTAMP '2024-01-28'), (TIMESTAMP '2024-01-28', TIMESTAMP '2024-01-31')) v(chunk_start, chunk_end)) SELECT chunk_start, chunk_end, asset_id FROM c JOIN f ON first < chunk_end",
    "lookahead_sample": f"SELECT asset_id, time_1, time_close_1, time_d, time_close_d, time_240, time_close_240, time_60, time_close_60, CASE WHEN time_close_d > time_close_1 THEN 'D lookahead' WHEN time_close_240 > time_close_1 THEN '240 lookahead' ELSE '60 lookahead' END AS violation_type FROM {_EARLY} WHERE {_LATE} ORDER BY asset_id, time_1 LIMIT 10",
    "lookahead_verdict": f"SELECT 'coin' AS classification, 2 AS asset_id, count(*) AS total_rows, count(*) FILTER {_LATE} AS violations, true AS passed, 'No lookahead bias detected' AS message FROM {_MTF} WHERE asset_id = 2 UNION ALL SELECT 'lead', 3, count(*), count(*) FILTER {_LATE}, false, (count(*) FILTER {_LATE}) || ' rows with lookahead bias!' FROM {_EARLY} WHERE asset_id = 3".replace("FILTER (", "FILTER (WHERE "),
    "latest_rows": f"SELECT asset_id, time_1, time_close_1, time_d || ' - ' || time_close_d AS bar_d, time_240 || ' - ' || time_close_240 AS bar_240, time_60 || ' - ' || time_close_60 AS bar_60 FROM {_MTF} WHERE asset_id = 1 ORDER BY time_1 DESC LIMIT 5",
    # 2, 5 and 1 graded signals and 3 columns of concordance, for four timeframes
    "signal_columns": "SELECT * FROM (VALUES ('mtf_signals_lead', 20::BIGINT), ('mtf_signals_coin', 32::BIGINT), ('mtf_signals_conf', 16::BIGINT)) t(table_name, new_columns)",
    "upsert_signals": f"SELECT asset_id, time, time + INTERVAL 1 HOUR AS time_close, CASE WHEN hour(time) < 12 THEN 9 ELSE CAST({signal_oracle.band_sql()} AS INT) END AS bb_signal, CASE WHEN hour(time) < 12 THEN 3 ELSE 1 END AS source FROM ({oracle.with_base()} SELECT * FROM base) WHERE hour(time) < 12 OR (asset_id + hour(time)) % 5 <> 0",
    "upsert_mtf": f"SELECT asset_id, time_1, close_1, CASE WHEN minute(time_1) < 30 THEN 0.0 ELSE close_60 END AS close_60 FROM {_MTF}",
    "upsert_keys": f"SELECT asset_id, time FROM {_H}",
}
