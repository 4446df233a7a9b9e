"""The recursive and profile indicators as SQL for DuckDB: recursive queries that share nothing with the passes they check."""

from __future__ import annotations

from ..params import DEMA, EMA, MACD, RSI, SUPERTREND
from ..sources.bars import bars_sql
from .signal_oracle import windows_sql


def _smoothings() -> list[tuple[str, str, int, float]]:
    """(name, input, n, alpha) in an order in which inputs come first; n_ marks values of the current row."""
    out = []
    lengths = sorted({*EMA, *DEMA, *(x for f, s, _ in MACD for x in (f, s))})
    out += [(f"e{n}", "b.close", n, 2 / (n + 1)) for n in lengths]
    out += [(f"ee{n}", f"n_e{n}", n, 2 / (n + 1)) for n in DEMA]
    out += [(f"sig_{f}_{s}_{g}", f"(n_e{f} - n_e{s})", g, 2 / (g + 1)) for f, s, g in MACD]
    for n in RSI:
        out += [(f"gain{n}", "greatest(b.close - b.prev_close, 0 * b.prev_close)", n, 1 / n), (f"loss{n}", "greatest(b.prev_close - b.close, 0 * b.prev_close)", n, 1 / n)]
    out += [("atr14", "b.tr", 14, 1 / 14), ("atr10", "b.tr", 10, 1 / 10), ("pdm", "b.plus_dm", 14, 1 / 14), ("mdm", "b.minus_dm", 14, 1 / 14)]
    dx = "(CASE WHEN n_atr14 > 0 AND n_pdm + n_mdm > 0 THEN 100 * abs(n_pdm - n_mdm) / (n_pdm + n_mdm) END)"
    return [*out, ("adx", dx, 14, 1 / 14)]


def recursive_sql() -> str:
    """WITH clauses base (window indicators) and rec (recursive ones), by asset_id and rn."""
    start, step, names = [], [], []
    for name, x, n, alpha in _smoothings():
        c, s = f"{name}_c", f"{name}_s"
        names += [c, s, name]
        start += ["0", "0.0::DOUBLE", "NULL::DOUBLE"]
        x = f"CASE WHEN b.prev_close IS NULL THEN NULL ELSE {x} END" if name.startswith(("gain", "loss")) else x
        step += [
            f"CASE WHEN {x} IS NOT NULL OR r.{c} > 0 THEN r.{c} + 1 ELSE 0 END AS n_{c}",
            f"CASE WHEN n_{c} > 0 AND n_{c} <= {n} THEN r.{s} + {x} ELSE r.{s} END AS n_{s}",
            f"CASE WHEN n_{c} < {n} THEN NULL WHEN n_{c} = {n} THEN n_{s} / {n} ELSE {alpha!r} * ({x}) + {1 - alpha!r} * r.{name} END AS n_{name}",
        ]
    for m in SUPERTREND:
        up, down = f"(b.hl2 + {m} * n_atr10)", f"(b.hl2 - {m} * n_atr10)"
        names += [f"up{m}", f"lo{m}", f"dir{m}"]
        start += ["NULL::DOUBLE", "NULL::DOUBLE", "NULL::INT"]
        step += [
            f"CASE WHEN r.up{m} IS NULL OR {up} < r.up{m} OR b.prev_close > r.up{m} THEN {up} ELSE r.up{m} END AS n_up{m}",
            f"CASE WHEN r.lo{m} IS NULL OR {down} > r.lo{m} OR b.prev_close < r.lo{m} THEN {down} ELSE r.lo{m} END AS n_lo{m}",
            f"CASE WHEN n_up{m} IS NULL THEN NULL WHEN r.dir{m} IS NULL THEN -1 WHEN r.dir{m} < 0 OR r.up{m} = r.lo{m} THEN CASE WHEN b.close > n_up{m} THEN 1 ELSE -1 END ELSE CASE WHEN b.close < n_lo{m} THEN -1 ELSE 1 END END AS n_dir{m}",
        ]
    out = [f"e{n} AS ema_{n}" for n in EMA] + [f"CASE WHEN series >= {2 * n} THEN 2 * e{n} - ee{n} END AS dema_{n}" for n in DEMA]
    out += [f"CASE WHEN loss{n} = 0 THEN 100.0 WHEN loss{n} IS NOT NULL THEN 100 - 100 / (1 + gain{n} / loss{n}) END AS rsi_{n}" for n in RSI]
    for f, s, g in MACD:
        v = f"{f}_{s}_{g}"
        out += [f"e{f} - e{s} AS macd_{v}", f"sig_{v} AS macd_{v}_signal", f"e{f} - e{s} - sig_{v} AS macd_{v}_histogram"]
    out += ["atr14 AS atr_14", "atr10 AS atr_10", "CASE WHEN atr14 > 0 THEN 100 * pdm / atr14 END AS plus_di_14", "CASE WHEN atr14 > 0 THEN 100 * mdm / atr14 END AS minus_di_14", "CASE WHEN series >= 28 THEN adx END AS adx_14"]
    for m in SUPERTREND:
        out += [f"CASE WHEN dir{m} > 0 THEN lo{m} WHEN dir{m} < 0 THEN up{m} END AS supertrend_10_{m}", f"CAST(dir{m} AS DOUBLE) AS supertrend_dir_10_{m}"]
    out += ["e20 AS keltner_middle", "e20 + 2 * atr10 AS keltner_upper", "e20 - 2 * atr10 AS keltner_lower"]
    return f"""r({", ".join(["asset_id", "rn", *names])}) AS (
SELECT DISTINCT asset_id, 0::BIGINT, {", ".join(start)} FROM base
UNION ALL
SELECT b.asset_id, b.rn, {", ".join(step)} FROM r JOIN base b ON b.asset_id = r.asset_id AND b.rn = r.rn + 1),
full_rows AS (SELECT base.*, {", ".join(out)} FROM base JOIN r USING (asset_id, rn))"""


PROFILE_SQL = """
win AS (SELECT a.asset_id, a.rn, min(p.low) AS lo, max(p.high) AS hi, sum(CASE WHEN p.volume > 0 THEN p.volume ELSE 0 END) AS total
        FROM base a JOIN base p ON p.asset_id = a.asset_id AND p.rn BETWEEN a.rn - 50 AND a.rn - 1 WHERE a.rn >= 51 GROUP BY 1, 2),
sized AS (SELECT *, (CASE WHEN hi <= lo THEN lo + 1e-8 ELSE hi END - lo) / 50 AS size FROM win),
spans AS (SELECT s.asset_id, s.rn, greatest(0, least(49, trunc((p.low - s.lo) / s.size)))::INT AS b1, greatest(0, least(49, trunc((p.high - s.lo) / s.size)))::INT AS b2, p.volume
          FROM sized s JOIN base p ON p.asset_id = s.asset_id AND p.rn BETWEEN s.rn - 50 AND s.rn - 1 WHERE p.volume > 0),
filled AS (SELECT asset_id, rn, b, sum(volume / (b2 - b1 + 1)) AS h FROM (SELECT *, unnest(range(b1, b2 + 1)) AS b FROM spans) GROUP BY 1, 2, 3),
hist AS (SELECT s.asset_id, s.rn, s.lo, s.size, s.total, list(coalesce(f.h, 0.0) ORDER BY k.b) AS h
         FROM sized s CROSS JOIN (SELECT unnest(range(50)) AS b) k LEFT JOIN filled f ON f.asset_id = s.asset_id AND f.rn = s.rn AND f.b = k.b WHERE s.total > 0 GROUP BY 1, 2, 3, 4, 5),
peaks AS (SELECT *, list_position(h, list_max(h)) - 1 AS peak FROM hist),
area(asset_id, rn, h, total, step, dn, up, got) AS (
  SELECT asset_id, rn, h, total, 0, peak, peak, h[peak + 1] FROM peaks
  UNION ALL
  SELECT asset_id, rn, h, total, step + 1, CASE WHEN go_down THEN dn - 1 ELSE dn END, CASE WHEN go_down THEN up ELSE up + 1 END, got + CASE WHEN go_down THEN h[dn] ELSE h[up + 2] END
  FROM (SELECT *, dn > 0 AND (up = 49 OR h[dn] >= h[up + 2]) AS go_down FROM area WHERE got < 0.7 * total AND (dn > 0 OR up < 49))),
ends AS (SELECT asset_id, rn, arg_max(dn, step) AS dn, arg_max(up, step) AS up FROM area GROUP BY 1, 2),
nodes AS (SELECT f.asset_id, f.rn, min(b) FILTER (h >= 1.5 * total / 50) AS h1, max(b) FILTER (h >= 1.5 * total / 50) AS h2, min(b) FILTER (h <= 0.5 * total / 50) AS l1, max(b) FILTER (h <= 0.5 * total / 50) AS l2
          FROM filled f JOIN sized s ON s.asset_id = f.asset_id AND s.rn = f.rn WHERE h > 0 GROUP BY 1, 2),
profile AS (SELECT p.asset_id, p.rn, lo + (peak + 0.5) * size AS vpvr_poc, lo + (up + 1) * size AS vpvr_vah, lo + dn * size AS vpvr_val,
  lo + (coalesce(h2, peak) + 0.5) * size AS vpvr_hvn_upper, lo + (coalesce(h1, peak) + 0.5) * size AS vpvr_hvn_lower,
  lo + (coalesce(l2, 49) + 0.5) * size AS vpvr_lvn_upper, lo + (coalesce(l1, 0) + 0.5) * size AS vpvr_lvn_lower
  FROM peaks p JOIN ends e ON e.asset_id = p.asset_id AND e.rn = p.rn LEFT JOIN nodes n ON n.asset_id = p.asset_id AND n.rn = p.rn)"""


def with_base(interval: str = "60", recursive: bool = False, profile: bool = False) -> str:
    """WITH clauses down to base, full_rows and every_column, as far as they are asked for."""
    out = f"WITH RECURSIVE base AS MATERIALIZED (SELECT * FROM {windows_sql(f'({bars_sql(interval)})')})"
    if recursive:
        out += ",\n" + recursive_sql()
    if profile:
        out += "," + PROFILE_SQL
    if recursive and profile:
        out += ",\nevery_column AS (SELECT * FROM full_rows LEFT JOIN profile USING (asset_id, rn))"
    return out
