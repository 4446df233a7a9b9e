"""Volume profile of the previous bars: point of control, value area, high- and low-volume nodes."""

from __future__ import annotations

import numpy as np
import pandas as pd

COLUMNS = ["vpvr_poc", "vpvr_vah", "vpvr_val", "vpvr_hvn_upper", "vpvr_hvn_lower", "vpvr_lvn_upper", "vpvr_lvn_lower"]


def profile(df: pd.DataFrame, lookback: int = 50, bins: int = 50, area: float = 0.7, high_node: float = 1.5, low_node: float = 0.5, chunk: int = 512) -> dict[str, np.ndarray]:
    """Levels at each bar from the lookback bars before it, rows of a chunk at once."""
    n = len(df)
    out = {c: np.full(n, np.nan) for c in COLUMNS}
    if n <= lookback:
        return out
    low, high, volume = (np.lib.stride_tricks.sliding_window_view(df[c].to_numpy(float), lookback)[:-1] for c in ("low", "high", "volume"))
    for a in range(0, n - lookback, chunk):
        lo, hi, vol = low[a : a + chunk], high[a : a + chunk], volume[a : a + chunk]
        rows = np.arange(len(lo))
        base = lo.min(1)
        top = hi.max(1)
        size = (np.where(top <= base, base + 1e-8, top) - base) / bins
        first, last = (np.clip(((x - base[:, None]) / size[:, None]).astype(int), 0, bins - 1) for x in (lo, hi))
        part = np.where(vol > 0, vol, 0) / (last - first + 1)
        hist = np.zeros((len(lo), bins))
        for j in range(lookback):  # bar by bar, in order of time
            span = (np.arange(bins) >= first[:, j, None]) & (np.arange(bins) <= last[:, j, None])
            hist += np.where(span, part[:, j, None], 0)
        total = np.where(vol > 0, vol, 0).sum(1)
        peak = hist.argmax(1)
        down, up, got = peak.copy(), peak.copy(), hist[rows, peak]
        for _ in range(bins):
            open_ = (got < area * total) & ((down > 0) | (up < bins - 1))
            if not open_.any():
                break
            below = np.where(down > 0, hist[rows, np.maximum(down - 1, 0)], 0)
            above = np.where(up < bins - 1, hist[rows, np.minimum(up + 1, bins - 1)], 0)
            go_down = open_ & (down > 0) & ((below >= above) | (up == bins - 1))
            go_up = open_ & ~go_down
            got += np.where(go_down, below, 0) + np.where(go_up, above, 0)
            down, up = down - go_down, up + go_up
        middle = lambda b: base + (b + 0.5) * size  # noqa: B023, E731
        mean = hist.mean(1)[:, None]
        many, few = hist >= high_node * mean, (hist > 0) & (hist <= low_node * mean)
        ends = lambda mask: (mask.argmax(1), bins - 1 - mask[:, ::-1].argmax(1), mask.any(1))
        (h1, h2, h), (l1, l2, has_low) = ends(many), ends(few)
        levels = [middle(peak), base + (up + 1) * size, base + down * size, middle(np.where(h, h2, peak)), middle(np.where(h, h1, peak)), middle(np.where(has_low, l2, bins - 1)), middle(np.where(has_low, l1, 0))]
        for c, v in zip(COLUMNS, levels, strict=True):
            out[c][lookback + a : lookback + a + len(lo)] = np.where(total > 0, v, np.nan)
    return out
