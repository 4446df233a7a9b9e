"""Indicators that are plain window aggregates, as SQL expressions in layers.

Each layer may use the columns of those before. All windows share one partitioning and order, so a
layer is one Window node, and one shuffle and sort serve them all. Expressions are SQL that Spark and
DuckDB read alike; {w} is the series so far, {p} the series' partition, {fN} the N rows up to this one.
"""

from __future__ import annotations

import re

from ..params import ICHIMOKU, SMA

KEY = "PARTITION BY asset_id, interval_min"
ORDER = f"{KEY} ORDER BY time"


def expand(sql: str) -> str:
    sql = re.sub(r"\{f(\d+)\}", lambda m: f"({ORDER} ROWS BETWEEN {int(m[1]) - 1} PRECEDING AND CURRENT ROW)", sql)
    sql = re.sub(r"\{b(\d+)\}", lambda m: f"({ORDER} ROWS BETWEEN {m[1]} PRECEDING AND 1 PRECEDING)", sql)
    return sql.replace("{w}", f"({ORDER})").replace("{all}", f"({ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)").replace("{p}", f"({KEY})")


def full(n: int, sql: str) -> str:
    return f"CASE WHEN rn >= {n} THEN {sql} END"


def _mid(n: int) -> str:
    return full(n, f"(max(high) OVER {{f{n}}} + min(low) OVER {{f{n}}}) / 2")


BASE = {"rn": "row_number() OVER {w}", "series": "count(*) OVER {p}", "prev_close": "lag(close) OVER {w}", "prev_high": "lag(high) OVER {w}", "prev_low": "lag(low) OVER {w}"}
SMA_COLUMNS = {f"sma_{n}": full(n, f"avg(close) OVER {{f{n}}}") for n in SMA}
BOLLINGER = {"bb_middle": full(20, "avg(close) OVER {f20}"), "bb_sigma": full(20, "stddev_pop(close) OVER {f20}")}
BOLLINGER_2 = {"bb_upper": "bb_middle + 2 * bb_sigma", "bb_lower": "bb_middle - 2 * bb_sigma", "bb_bandwidth": "CASE WHEN bb_middle <> 0 THEN 4 * bb_sigma / bb_middle * 100 END"}
STOCH = {"hh14": "max(high) OVER {f14}", "ll14": "min(low) OVER {f14}"}
STOCH_2 = {"stoch_k": "CASE WHEN series >= 14 THEN CASE WHEN rn >= 14 AND hh14 > ll14 THEN (close - ll14) / (hh14 - ll14) * 100 ELSE 50.0 END END"}
STOCH_3 = {"stoch_d": full(16, "avg(stoch_k) OVER {f3}")}
ICHI, ICHI_2 = {}, {}
for _t, _k, _b, _d in ICHIMOKU:
    _v = f"{_t}_{_k}_{_b}"
    ICHI |= {f"tenkan_{_v}": _mid(_t), f"kijun_{_v}": _mid(_k), f"spanb_{_v}": _mid(_b), f"chikou_{_v}": f"lead(close, {_d}) OVER {{w}}"}
    ICHI_2 |= {f"senkou_a_{_v}": f"lag((tenkan_{_v} + kijun_{_v}) / 2, {_d}) OVER {{w}}", f"senkou_b_{_v}": f"lag(spanb_{_v}, {_d}) OVER {{w}}"}
FLOW = {
    "flow": "CASE WHEN prev_close IS NULL OR close = prev_close THEN 0.0 WHEN close > prev_close THEN volume ELSE -volume END",
    "mfv": "CASE WHEN high <> low THEN ((close - low) - (high - close)) / (high - low) * volume ELSE 0.0 END",
    "hl2": "(high + low) / 2",
    "tr": "CASE WHEN prev_close IS NULL THEN high - low ELSE greatest(high - low, abs(high - prev_close), abs(low - prev_close)) END",
    "plus_dm": "CASE WHEN high - prev_high > prev_low - low AND high - prev_high > 0 THEN high - prev_high ELSE 0.0 END",
    "minus_dm": "CASE WHEN prev_low - low > high - prev_high AND prev_low - low > 0 THEN prev_low - low ELSE 0.0 END",
}
FLOW_2 = {
    "obv": "sum(flow) OVER {all}",
    "vol20": "sum(volume) OVER {f20}",
    "mfv20": "sum(mfv) OVER {f20}",
    "ao": full(34, "avg(hl2) OVER {f5} - avg(hl2) OVER {f34}"),
}
FLOW_3 = {"cmf": full(20, "CASE WHEN vol20 <> 0 THEN mfv20 / vol20 ELSE 0.0 END")}

LAYERS = [BASE, SMA_COLUMNS | BOLLINGER | STOCH | ICHI | FLOW, BOLLINGER_2 | STOCH_2 | ICHI_2 | FLOW_2, STOCH_3 | FLOW_3]
ICHI_COLUMNS = [f"{c}_{'_'.join(map(str, v[:3]))}" for v in ICHIMOKU for c in ("tenkan", "kijun", "senkou_a", "senkou_b", "chikou")]


def apply(df, layers=LAYERS):
    """df (bars) with the columns of all layers."""
    from pyspark.sql import functions as F

    for layer in layers:
        df = df.select("*", *[F.expr(expand(sql)).alias(name) for name, sql in layer.items()])
    return df
