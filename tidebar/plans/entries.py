"""Registered queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params
from ..functions import signals, windowed
from ..operators import profile, recursive
from ..sources import bars as B
from . import maintenance, oracle, signal_oracle, signal_tables

KEY = ["asset_id", "time"]
MTF_COLUMNS = ["bb_signal", "close"]

FAMILIES = {
    "sma_family": [f"sma_{n}" for n in params.SMA],
    "bollinger": ["bb_middle", "bb_upper", "bb_lower", "bb_bandwidth"],
    "stochastic": ["stoch_k", "stoch_d"],
    **{f"ichimoku_{'_'.join(map(str, v[:3]))}": [f"{c}_{'_'.join(map(str, v[:3]))}" for c in ("tenkan", "kijun", "senkou_a", "senkou_b", "chikou")] for v in params.ICHIMOKU},
    "obv": ["obv"],
    "cmf": ["cmf"],
    "awesome_oscillator": ["ao"],
    "true_range": ["tr"],
    "directional_movement": ["plus_dm", "minus_dm"],
}
RECURSIVE = {
    "ema_family": [f"ema_{n}" for n in params.EMA],
    "dema_family": [f"dema_{n}" for n in params.DEMA],
    "rsi_family": [f"rsi_{n}" for n in params.RSI],
    "macd_family": [c for c in recursive.COLUMNS if c.startswith("macd")],
    "atr": ["atr_14", "atr_10"],
    "adx": ["plus_di_14", "minus_di_14", "adx_14"],
    "supertrend": [c for c in recursive.COLUMNS if c.startswith("supertrend")],
    "keltner": ["keltner_middle", "keltner_upper", "keltner_lower"],
}


def _rounded(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*KEY, *[F.round(c, 6).alias(c) for c in names])


def _rounded_sql(names: list[str]) -> str:
    return ", ".join([*KEY, *[f"round({c}, 6) AS {c}" for c in names]])


def bars(interval: str) -> Callable:
    return lambda spark, sf_dir: _rounded(B.bars_from_events(spark, sf_dir, interval), ["open", "high", "low", "close", "volume"])


def window_family(names: list[str]) -> Callable:
    return lambda spark, sf_dir: _rounded(windowed.apply(B.bars_from_events(spark, sf_dir)), names)


def recursive_family(names: list[str]) -> Callable:
    return lambda spark, sf_dir: _rounded(recursive.with_recursive(windowed.apply(B.bars_from_events(spark, sf_dir))), names)


def volume_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(signal_tables.indicators(B.bars_from_events(spark, sf_dir)), profile.COLUMNS)


def signals_of(kind: str) -> Callable:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        table = signal_tables.signal_table(signal_tables.indicators(B.bars_from_events(spark, sf_dir)), kind)
        return table.drop("source_script", "interval_min")

    return run


def signals_sql(kind: str) -> str:
    return f"{oracle.with_base('60', True, True)} SELECT *, time + INTERVAL 1 HOUR AS time_close FROM {signal_oracle.signals_sql('every_column', kind)}"


def band_signal(bars_: DataFrame) -> DataFrame:
    frame = windowed.apply(bars_)
    return B.with_close_time(frame.withColumn("bb_signal", F.expr(f"CAST({signals.graded()['coin']['bb_signal']} AS INT)")))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = band_signal(B.bars_from_events(spark, sf_dir))
    return frame.select(*KEY, "close", *[F.round(c, 6).alias(c) for c in ("sma_7", "bb_middle", "bb_upper", "bb_lower")], "bb_signal")


FLAGSHIP_SQL = f"{oracle.with_base()} SELECT asset_id, time, close, {', '.join(f'round({c}, 6) AS {c}' for c in ('sma_7', 'bb_middle', 'bb_upper', 'bb_lower'))}, CAST({signal_oracle.band_sql()} AS INT) AS bb_signal FROM base"


def _mtf(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {c: band_signal(B.bars_from_events(spark, sf_dir, c)) for c in ("1", "60", "240", "D")}
    return signal_tables.multi_timeframe(tables.pop("1"), tables, MTF_COLUMNS)


def mtf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mtf(spark, sf_dir)


def _mtf_sql() -> str:
    side = lambda c, s: f"(SELECT asset_id, time AS time_{s}, time + INTERVAL {params.INTERVALS[c]} MINUTE AS time_close_{s}, CAST({signal_oracle.band_sql()} AS INT) AS bb_signal_{s}, close AS close_{s} FROM {signal_oracle.windows_sql(f'({B.bars_sql(c)})')})"
    sql = f"SELECT * FROM {side('1', '1')} x"
    for c, s in (("60", "60"), ("240", "240"), ("D", "d")):
        sql += f" JOIN {side(c, s)} y{s} ON x.asset_id = y{s}.asset_id AND time_close_{s} = time_bucket(INTERVAL '{params.INTERVALS[c]} minutes', time_close_1)"
    columns = [f"{c}_{s}" for s in ("1", "60", "240", "d") for c in ("time", "time_close", *MTF_COLUMNS)]
    return f"SELECT x.asset_id, {', '.join(columns)} FROM ({sql.replace('SELECT * FROM', 'SELECT x.asset_id, * EXCLUDE (asset_id) FROM', 1)}) x"


def lookahead(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signal_tables.lookahead_violations(_mtf(spark, sf_dir))


def _half(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Hourly bars, and a stored table that lacks some of them."""
    b = B.bars_from_events(spark, sf_dir)
    return b, b.where("(asset_id + hour(time)) % 5 <> 0")


def first_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintenance.first_gap(*_half(spark, sf_dir), warmup_days=2).drop("interval_min")


def gap_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, stored = _half(spark, sf_dir)
    return maintenance.gap_summary(b, {"indicators": stored, "signals_lead": b}).drop("interval_min")


def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, stored = _half(spark, sf_dir)
    new = b.where("hour(time) < 12").withColumn("volume", F.lit(0.0))
    return maintenance.upsert(stored, new, signal_tables.KEY).select(*KEY, "close", F.round("volume", 6).alias("volume"))


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    ones = B.bars_from_events(spark, sf_dir, "1")
    rows = recursive.with_recursive(windowed.apply(ones))
    mtf_rows = ones.select("asset_id", F.col("time").alias("time_1"), F.when(F.minute("time") == 0, F.lit(1.0)).alias("atr_at_signal"))
    return maintenance.enrich_atr(mtf_rows, rows)


def atr_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir).select("asset_id", "time_1", F.round("atr_at_signal", 6).alias("atr_at_signal"))


def fill_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintenance.fill_status(_enriched(spark, sf_dir))


def latest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signal_tables.latest(signals_of("lead")(spark, sf_dir).withColumn("interval_min", F.lit("60"))).drop("interval_min")


def indicator_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = signal_tables.indicator_table(signal_tables.indicators(B.bars_from_events(spark, sf_dir)))
    return table.select(*KEY, *[F.round(c, 6).alias(c) for c, t in table.dtypes if t == "double"], "source_script")


def _indicator_sql() -> str:
    pairs = [f"sma_{n}" for n in (20, 50, 100, 200)] + ["open", "high", "low", "close", "volume", "bb_middle", "bb_upper", "bb_lower", "stoch_k", "stoch_d", *windowed.ICHI_COLUMNS, "obv", "cmf", "ao"]
    pairs += [c for c in recursive.COLUMNS if not c.startswith(("supertrend_10_1", "supertrend_10_2", "supertrend_dir_10_1", "supertrend_dir_10_2"))] + profile.COLUMNS
    return f"{oracle.with_base('60', True, True)} SELECT asset_id, time, {', '.join(f'round({c}, 6) AS {signal_tables.STORED.get(c, c)}' for c in pairs)}, '{signal_tables.SOURCE}' AS source_script FROM every_column"


def time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.time_range(B.bars_from_events(spark, sf_dir)).drop("interval_min")


def distinct_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.bars_from_events(spark, sf_dir).select("asset_id").distinct()


def range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = B.scan(B.bars_from_events(spark, sf_dir), assets=[1, 3], interval="60", start="2024-01-10", end="2024-01-20", lookback=48)
    return found.select(*KEY, "close", "is_target")


def selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The asset master's selection, over suppliers as a stand-in."""
    s = B.read(spark, sf_dir, "supplier")
    master = s.select(F.col("s_suppkey").alias("id"), F.when(F.col("s_suppkey") % 3 == 0, F.col("s_name")).alias("pair"), F.when(F.col("s_suppkey") % 2 == 0, F.lit("K")).alias("kraken_symbol"), F.lit("B").alias("bybit_symbol"), (F.col("s_suppkey") % 2).alias("selected_in_current_run"))
    return B.selected_assets(master)


_BARS = f"({B.bars_sql()})"
_STORED = f"(SELECT * FROM {_BARS} WHERE (asset_id + hour(time)) % 5 <> 0)"

QUERIES: dict[str, Callable] = {
    **{f"bars_{n}": bars(c) for n, c in (("1m", "1"), ("1h", "60"), ("4h", "240"), ("1d", "D"))},
    **{k: window_family(v) for k, v in FAMILIES.items()},
    **{k: recursive_family(v) for k, v in RECURSIVE.items()},
    "vpvr_levels": volume_profile,
    "indicator_table": indicator_table,
    **{f"signals_{k}": signals_of(k) for k in ("lead", "coin", "conf")},
    "latest_summary": latest_summary,
    "band_signal": flagship,
    "mtf_coin": mtf,
    "lookahead_check": lookahead,
    "first_gap": first_gap,
    "gap_summary": gap_summary,
    "upsert_indicators": upsert,
    "atr_enrichment": atr_enrichment,
    "fill_status": fill_status,
    "time_range": time_range,
    "distinct_assets": distinct_assets,
    "range_scan": range_scan,
    "selected_assets": selected,
}

_ATR_SQL = f"{oracle.with_base('1', True)}, enriched AS (SELECT asset_id, time AS time_1, CASE WHEN minute(time) = 0 THEN 1.0 WHEN atr_14 > 0 THEN atr_14 END AS atr_at_signal FROM full_rows)"

SQL: dict[str, str] = {
    **{f"bars_{n}": f"SELECT {_rounded_sql(['open', 'high', 'low', 'close', 'volume'])} FROM ({B.bars_sql(c)})" for n, c in (("1m", "1"), ("1h", "60"), ("4h", "240"), ("1d", "D"))},
    **{k: f"{oracle.with_base()} SELECT {_rounded_sql(v)} FROM base" for k, v in FAMILIES.items()},
    **{k: f"{oracle.with_base('60', True)} SELECT {_rounded_sql(v)} FROM full_rows" for k, v in RECURSIVE.items()},
    "vpvr_levels": f"{oracle.with_base('60', False, True)} SELECT {_rounded_sql(profile.COLUMNS)} FROM base LEFT JOIN profile USING (asset_id, rn)",
    "indicator_table": _indicator_sql(),
    **{f"signals_{k}": signals_sql(k) for k in ("lead", "coin", "conf")},
    "latest_summary": f"SELECT asset_id, max(time) AS time, arg_max(concordance_sum, time) AS concordance_sum, arg_max(concordance_count, time) AS concordance_count, arg_max(concordance_score, time) AS concordance_score FROM ({signals_sql('lead')}) GROUP BY 1",
    "band_signal": FLAGSHIP_SQL,
    "mtf_coin": _mtf_sql(),
    "lookahead_check": f"SELECT count(*) AS total, count(*) FILTER (time_close_60 > time_close_1) AS violations_60, count(*) FILTER (time_close_240 > time_close_1) AS violations_240, count(*) FILTER (time_close_d > time_close_1) AS violations_d FROM ({_mtf_sql()})",
    "first_gap": f"SELECT asset_id, min(time) AS first_gap FROM (SELECT *, min(time) OVER (PARTITION BY asset_id) AS since FROM {_BARS}) WHERE (asset_id + hour(time)) % 5 = 0 AND time >= since + INTERVAL 2 DAY GROUP BY 1",
    "gap_summary": f"SELECT asset_id, count(*) AS missing, 'indicators' AS table_name FROM {_BARS} WHERE (asset_id + hour(time)) % 5 = 0 GROUP BY 1",
    "upsert_indicators": f"SELECT asset_id, time, close, CASE WHEN hour(time) < 12 THEN 0.0 ELSE round(volume, 6) END AS volume FROM {_BARS} WHERE hour(time) < 12 OR (asset_id + hour(time)) % 5 <> 0",
    "atr_enrichment": f"{_ATR_SQL} SELECT asset_id, time_1, round(atr_at_signal, 6) AS atr_at_signal FROM enriched",
    "fill_status": f"{_ATR_SQL} SELECT count(*) AS total, count(*) - count(atr_at_signal) AS missing, count(atr_at_signal) AS filled FROM enriched",
    "time_range": f"SELECT asset_id, min(time) AS min_time, max(time) AS max_time, count(*) AS n FROM {_BARS} GROUP BY 1",
    "distinct_assets": f"SELECT DISTINCT asset_id FROM {_BARS}",
    "range_scan": f"SELECT asset_id, time, close, time >= TIMESTAMP '2024-01-10' AS is_target FROM {_BARS} WHERE asset_id IN (1, 3) AND time <= TIMESTAMP '2024-01-20' AND time >= TIMESTAMP '2024-01-08'",
    "selected_assets": "SELECT s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN s_name WHEN s_suppkey % 2 = 0 THEN 'K' ELSE 'B' END AS name FROM supplier WHERE s_suppkey % 2 = 1",
}
