"""Indicators with memory: exponential averages, RSI, MACD, ATR, ADX, Supertrend, Keltner.

One ordered pass over each series, linear in its length. A smoothing is seeded by the mean of its first
n values, counted from the first value that isn't missing; a value that is missing afterwards makes the
rest missing.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StructField, StructType

from ..params import DEMA, EMA, MACD, RSI, SUPERTREND

COLUMNS = [
    *[f"ema_{n}" for n in EMA], *[f"dema_{n}" for n in DEMA], *[f"rsi_{n}" for n in RSI],
    *[f"macd_{f}_{s}_{g}{part}" for f, s, g in MACD for part in ("", "_signal", "_histogram")],
    "atr_14", "atr_10", "plus_di_14", "minus_di_14", "adx_14",
    *[c for m in SUPERTREND for c in (f"supertrend_10_{m}", f"supertrend_dir_10_{m}")],
    "keltner_middle", "keltner_upper", "keltner_lower",
]


def smooth(x: np.ndarray, n: int, alpha: float) -> np.ndarray:
    out = np.full(len(x), np.nan)
    good = np.flatnonzero(~np.isnan(x))
    if not len(good) or len(x) < good[0] + n:
        return out
    at = good[0] + n - 1
    value = float(x[good[0] : at + 1].mean())
    out[at] = value
    keep = 1 - alpha
    rest = np.empty(len(x) - at - 1)
    for i, v in enumerate(x[at + 1 :].tolist()):
        value = alpha * v + keep * value
        rest[i] = value
    out[at + 1 :] = rest
    return out


def ema(x: np.ndarray, n: int) -> np.ndarray:
    return smooth(x, n, 2 / (n + 1))


def wilder(x: np.ndarray, n: int) -> np.ndarray:
    return smooth(x, n, 1 / n)


def _over(a: np.ndarray, b: np.ndarray, ok: np.ndarray, other: float = np.nan) -> np.ndarray:
    return np.where(ok, a / np.where(ok, b, 1), other)


def supertrend(mid: np.ndarray, close: np.ndarray, atr: np.ndarray, times: float) -> tuple[np.ndarray, np.ndarray]:
    """The trailing band that the close hasn't crossed, and on which side of the close it is (1: below)."""
    band, side = np.full(len(mid), np.nan), np.full(len(mid), np.nan)
    top, floor, way, before = np.nan, np.nan, -1, np.nan
    for i in np.flatnonzero(~np.isnan(atr)).tolist():
        up, down = mid[i] + times * atr[i], mid[i] - times * atr[i]
        if np.isnan(top):
            top, floor = up, down
        else:
            was_top = way < 0 or top == floor
            top = up if before > top else min(top, up)
            floor = down if before < floor else max(floor, down)
            way = (1 if close[i] > top else -1) if was_top else (-1 if close[i] < floor else 1)
        band[i], side[i] = (floor, 1) if way > 0 else (top, -1)
        before = close[i]
    return band, side


def series(df: pd.DataFrame) -> dict[str, np.ndarray]:
    """All columns of one series in order of time; needs close, hl2, tr, plus_dm, minus_dm."""
    close, out = df["close"].to_numpy(float), {}
    n = len(close)
    emas = {k: ema(close, k) for k in {*EMA, *DEMA, *(x for f, s, _ in MACD for x in (f, s))}}
    out |= {f"ema_{k}": emas[k] for k in EMA}
    for k in DEMA:
        out[f"dema_{k}"] = 2 * emas[k] - ema(emas[k], k) if n >= 2 * k else np.full(n, np.nan)
    step = np.diff(close, prepend=np.nan)
    for k in RSI:
        gain, loss = wilder(np.where(np.isnan(step), np.nan, np.maximum(step, 0)), k), wilder(np.where(np.isnan(step), np.nan, np.maximum(-step, 0)), k)
        rsi = 100 - 100 / (1 + _over(gain, loss, loss > 0, 0.0))
        out[f"rsi_{k}"] = np.where(np.isnan(loss), np.nan, np.where(loss == 0, 100.0, rsi))
    for f, s, g in MACD:
        line = emas[f] - emas[s]
        signal = ema(line, g)
        out |= {f"macd_{f}_{s}_{g}": line, f"macd_{f}_{s}_{g}_signal": signal, f"macd_{f}_{s}_{g}_histogram": line - signal}
    tr = df["tr"].to_numpy(float)
    atr14, atr10 = wilder(tr, 14), wilder(tr, 10)
    plus, minus = (100 * _over(wilder(df[c].to_numpy(float), 14), atr14, atr14 > 0) for c in ("plus_dm", "minus_dm"))
    dx = 100 * _over(np.abs(plus - minus), plus + minus, plus + minus > 0)
    out |= {"atr_14": atr14, "atr_10": atr10, "plus_di_14": plus, "minus_di_14": minus, "adx_14": wilder(dx, 14) if n >= 28 else np.full(n, np.nan)}
    for m in SUPERTREND:
        out[f"supertrend_10_{m}"], out[f"supertrend_dir_10_{m}"] = supertrend(df["hl2"].to_numpy(float), close, atr10, m)
    out |= {"keltner_middle": emas[20], "keltner_upper": emas[20] + 2 * atr10, "keltner_lower": emas[20] - 2 * atr10}
    return out


def with_recursive(df: DataFrame, extra=None, extra_columns: list[str] = ()) -> DataFrame:
    """df with COLUMNS; extra adds columns of its own in the same pass. A series is one task's group."""
    names = [*COLUMNS, *extra_columns]
    schema = StructType([*df.schema.fields, *[StructField(name, DoubleType()) for name in names]])

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("time", ignore_index=True)
        found = series(part) | (extra(part) if extra else {})
        return pd.concat([part, pd.DataFrame({k: found[k] for k in names})], axis=1)

    return df.groupBy("asset_id", "interval_min").applyInPandas(run, schema)
