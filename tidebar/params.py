"""Intervals, thresholds and the names and parameters of indicators and signals."""

from __future__ import annotations

#: Interval code to minutes (fixed values).
INTERVALS = {"1": 1, "3": 3, "5": 5, "15": 15, "30": 30, "60": 60, "120": 120, "240": 240, "360": 360, "720": 720, "D": 1440, "1440": 1440, "W": 10080, "10080": 10080, "M": 43200, "22222": 43200}
LOOKBACK = 1600

#: Default thresholds (fixed values); a table (indicator_base, threshold_name, threshold_value) overrides them.
THRESHOLDS = {
    ("RSI", "extreme_oversold"): 20.0, ("RSI", "oversold"): 30.0, ("RSI", "extreme_overbought"): 80.0, ("RSI", "overbought"): 70.0,
    ("STOCHASTIC", "extreme_oversold"): 10.0, ("STOCHASTIC", "oversold"): 20.0, ("STOCHASTIC", "extreme_overbought"): 90.0, ("STOCHASTIC", "overbought"): 80.0,
    ("MACD", "histogram_strong_threshold"): 0.001, ("MACD", "signal_ratio_strong"): 1.1,
    ("CMF", "strong_buying"): 0.15, ("CMF", "bullish_bias"): 0.05, ("CMF", "strong_selling"): -0.15, ("CMF", "bearish_bias"): -0.05,
    ("BOLLINGER", "lower_zone"): 0.25, ("BOLLINGER", "upper_zone"): 0.75, ("KELTNER", "lower_zone"): 0.25, ("KELTNER", "upper_zone"): 0.75,
    ("ATR", "extreme_expansion"): 2.0, ("ATR", "expansion"): 1.5, ("ATR", "extreme_squeeze"): 0.5, ("ATR", "contraction"): 0.75,
    ("ADX", "non_trending"): 25.0, ("ADX", "strong_trend"): 40.0,
}

SMA = (7, 20, 25, 50, 99, 100, 200)
EMA = (10, 12, 20, 26, 50, 100, 200)
DEMA = (10, 20, 50, 100, 200)
RSI = (7, 14, 21)
MACD = ((12, 26, 9), (6, 13, 4), (8, 24, 9), (5, 35, 5), (20, 50, 15))
#: tenkan, kijun, senkou b, displacement.
ICHIMOKU = ((9, 26, 52, 26), (10, 30, 60, 30), (7, 22, 44, 22), (6, 20, 52, 20))
SUPERTREND = (1, 2, 3)


def thresholds(table=None, most: int = 10_000) -> dict[tuple[str, str], float]:
    """Defaults with the rows of a threshold table (a few dozen) in their place; more than ``most`` rows are an error."""
    found = dict(THRESHOLDS)
    if table is not None:
        rows = table.select("indicator_base", "threshold_name", "threshold_value").where("threshold_value IS NOT NULL").limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"a threshold table has at most {most} rows")
        found |= {(r[0], r[1]): float(r[2]) for r in rows}
    return found
