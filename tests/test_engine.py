"""Every registered query against its SQL, and series made by hand."""

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry
from pyspark.sql import functions as F
from tidebar import params
from tidebar.functions import signals, windowed
from tidebar.operators import profile, recursive
from tidebar.plans import entries, maintenance, signal_tables, upkeep
from tidebar.sources import bars as B
from tidebar.streaming import tail

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


QUERIES, SQL = entries.QUERIES | upkeep.QUERIES, entries.SQL | upkeep.SQL


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
    cols = sorted(got.columns)
    key = [c for c in ("asset_id", "time", "time_1", "id") if c in cols]
    key += [c for c in cols if c not in key]
    got, want = (x[cols].sort_values(key, ignore_index=True) for x in (got, want))
    for c in cols:
        a, b = got[c], want[c]
        same = (a == b) | (a.isna() & b.isna()) if a.dtype.kind in "fiub" else a.astype(str) == b.astype(str)
        assert same.all(), c


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def make(spark, close, high=None, low=None, volume=None):
    n = len(close)
    df = pd.DataFrame({"asset_id": 1, "interval_min": "60", "time": pd.date_range("2024-01-01", periods=n, freq="h"), "open": close, "high": high if high is not None else close, "low": low if low is not None else close, "close": close, "volume": volume if volume is not None else np.ones(n)})
    return spark.createDataFrame(df.astype({c: float for c in ("open", "high", "low", "close", "volume")})).withColumn("time", __import__("pyspark").sql.functions.col("time").cast("timestamp_ntz"))


def frame(spark, *a, **k):
    return signal_tables.indicators(make(spark, *a, **k)).orderBy("time").toPandas()


@pytest.mark.parametrize("n", [6, 7, 8, 13, 14, 20, 28])
def test_warm_up(spark, n):
    f = frame(spark, np.arange(1.0, n + 1))
    assert f.sma_7.notna().sum() == max(0, n - 6)
    assert f.stoch_k.notna().sum() == (n if n >= 14 else 0)
    assert f.rsi_7.notna().sum() == max(0, n - 7)
    assert f.atr_14.notna().sum() == max(0, n - 13)
    assert f.ema_10.notna().sum() == max(0, n - 9)


def test_constant_series(spark):
    f = frame(spark, np.full(80, 5.0))
    assert (f.stoch_k == 50).all() and (f.cmf.dropna() == 0).all() and (f.rsi_14.dropna() == 100).all()
    assert f.adx_14.isna().all() and f.bb_upper.dropna().eq(5).all()
    assert f.vpvr_poc.notna().sum() == 30


def test_monotone_series(spark):
    up, down = frame(spark, np.arange(1.0, 61)), frame(spark, np.arange(61.0, 1, -1))
    assert (up.rsi_14.dropna() == 100).all() and np.allclose(down.rsi_14.dropna(), 0)
    assert up.supertrend_dir_10_1.iloc[-1] == 1 and down.supertrend_dir_10_1.iloc[-1] == -1


def test_no_volume(spark):
    f = frame(spark, np.arange(1.0, 61), volume=np.zeros(60))
    assert (f.cmf.dropna() == 0).all() and f[profile.COLUMNS].isna().all().all()


def test_profile_bounds_and_tie():
    n = 51
    df = pd.DataFrame({"low": [1.0] * n, "high": [2.0] * n, "volume": [1.0] * n})
    out = profile.profile(df)
    assert out["vpvr_poc"][50] == pytest.approx(1.01) and out["vpvr_val"][50] == pytest.approx(1.0)
    assert out["vpvr_val"][50] <= out["vpvr_poc"][50] <= out["vpvr_vah"][50]


def test_gap_in_dx_poisons_adx():
    x = np.concatenate([np.full(5, np.nan), np.ones(20), [np.nan], np.ones(5)])
    assert np.isnan(recursive.wilder(x, 14)[25:]).all()


def test_future_bars_change_nothing(spark):
    close = np.random.default_rng(1).random(90) + 1
    a, b = frame(spark, close[:70]), frame(spark, close)
    for c in [*recursive.COLUMNS, *profile.COLUMNS, "sma_20", "bb_upper", "stoch_d", "obv", "ao"]:
        assert np.allclose(a[c], b[c][:70], equal_nan=True), c


def test_signal_domains_and_counts(spark):
    f = signal_tables.indicators(make(spark, np.random.default_rng(2).random(120) + 1))
    for kind, flags in signals.boolean().items():
        t = signal_tables.signal_table(f, kind).toPandas()
        assert t[list(flags)].isin([0, 1]).all().all() and t.concordance_score.between(-1, 1).all()
        assert all(t[c].between(-2, 2).all() for c in signals.graded()[kind])
    assert {k: len(v) for k, v in signals.boolean().items()} == {"lead": 48, "coin": 39, "conf": 38}


def test_upsert_is_idempotent(spark):
    old, new = make(spark, [1.0, 2, 3]), make(spark, [9.0, 8])
    once = maintenance.upsert(old, new, signal_tables.KEY)
    twice = maintenance.upsert(once, new, signal_tables.KEY)
    assert sorted(r.close for r in twice.collect()) == [3, 8, 9] == sorted(r.close for r in once.collect())
    assert maintenance.missing(old, once, signal_tables.KEY).count() == 0


def test_upsert_takes_the_newest_and_null_keys(spark):
    old = spark.createDataFrame([(1, 10, 0), (None, 20, 0)], "k int, v int, at int")
    new = spark.createDataFrame([(1, 11, 1), (1, 12, 2), (None, 21, 1), (3, 30, 1)], "k int, v int, at int")
    assert sorted(map(str, ((r.k, r.v) for r in maintenance.upsert(old, new, ["k"], "at").collect()))) == ["(1, 12)", "(3, 30)", "(None, 21)"]


def test_stored_table_ignores_versions_that_are_not_whole(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    assert maintenance.stored(spark, path) is None
    rows = spark.createDataFrame([(1, 1), (2, 2)], "k int, v int")
    maintenance.write_upsert(rows, path, ["k"])
    (tmp_path / "t" / "v2").mkdir()  # what a run that failed leaves
    again = maintenance.write_upsert(rows.withColumn("v", F.lit(5)).limit(1), path, ["k"])
    assert maintenance.latest_version(spark, path) == 2 and sorted(r.v for r in again.collect()) == [2, 5]
    assert set(maintenance.write_all({"a": rows, "b": rows}, f"file://{tmp_path}", ["k"])) == {"a", "b"}


def test_enrichment_keeps_the_rows(spark):
    mtf = spark.sql("SELECT 1 asset_id, timestamp_ntz'2024-01-01' time_1, cast(null AS double) atr_at_signal")
    two = spark.sql("SELECT 1 asset_id, timestamp_ntz'2024-01-01' time, '1' interval_min, explode(array(1.0D, 2.0D)) atr_14")
    assert [r.atr_at_signal for r in maintenance.enrich_atr(mtf, two).collect()] == [2.0]


def test_threshold_table_is_read_whole_or_not_at_all(spark):
    table = spark.range(5).selectExpr("'RSI' indicator_base", "concat('x', id) threshold_name", "cast(id AS double) threshold_value")
    assert params.thresholds(table)["RSI", "x4"] == 4 and params.thresholds(table)["RSI", "oversold"] == 30
    with pytest.raises(ValueError, match="at most"):
        params.thresholds(table, most=4)


def test_chunks_of_months_leave_no_day_out(spark):
    first = spark.sql("SELECT 1 asset_id, timestamp_ntz'2023-12-31' first")
    got = sorted((r.chunk_start, r.chunk_end) for r in maintenance.date_chunks(first, "2024-07-15").collect())
    assert all(a[1] == b[0] for a, b in zip(got, got[1:], strict=False)) and str(got[0][0])[:10] == "2023-12-31" and str(got[-1][1])[:10] == "2024-07-15"
    assert maintenance.date_chunks(first.limit(0), "2024-07-15").count() == 0


def test_tail_equals_a_full_run(spark):
    close = np.random.default_rng(3).random(200) + 1
    every = make(spark, close)
    batch = every.where("time >= '2024-01-08 00:00:00'")
    got = []
    tail.recompute_tail(lambda: every, windowed.apply, lambda df: got.append(df.orderBy("time").toPandas()), 120)(batch, 0)
    full = windowed.apply(every).where("time >= '2024-01-08 00:00:00'").orderBy("time").toPandas()
    assert len(got[0]) == len(full) == 32
    for c in ("sma_100", "bb_upper", "cmf", "ao", "senkou_b_9_26_52"):
        assert np.allclose(got[0][c], full[c], equal_nan=True), c


def test_bars_of_a_stream(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet").select("event_type", "ts", "value").where("ts < '2024-01-08'")
    events.orderBy("ts").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = tail.event_bars(spark.readStream.schema(events.schema).parquet(f"{tmp_path}/in"), 60)
    run = stream.writeStream.format("memory").queryName("bars").outputMode("append").option("checkpointLocation", f"{tmp_path}/at").trigger(availableNow=True).start()
    run.awaitTermination(120)
    got = {(r.event_type, str(r.time)): r.close for r in spark.table("bars").collect()}
    names = dict(enumerate(B.TYPES, 1))
    want = {(names[r.asset_id], str(r.time)): r.close for r in B.bars_from_events(spark, SF).where("time < '2024-01-07 20:00:00'").collect()}
    assert want.items() <= got.items()


def test_bucket_join_picks_closed_bars(spark):
    base = spark.sql("select 1L asset_id, timestamp_ntz'2024-01-01 14:05:00' time, timestamp_ntz'2024-01-01 14:06:00' time_close, 0 s")
    side = lambda close: spark.sql(f"select 1L asset_id, timestamp_ntz'2023-12-31 00:00:00' time, timestamp_ntz'{close}' time_close, 1 s")
    out = signal_tables.multi_timeframe(base, {"60": side("2024-01-01 14:00:00"), "240": side("2024-01-01 12:00:00"), "D": side("2024-01-01 00:00:00")}, ["s"])
    assert out.count() == 1 and signal_tables.lookahead_violations(out).first()["violations_60"] == 0


def test_divergences_by_hand(spark):
    """Falling prices and a rising indicator, one window long, and one that is a bar too short."""
    n = 40
    close = np.concatenate([np.full(24, 50.0), 50 - np.arange(16) * 0.5])
    volume = np.concatenate([np.full(24, 1.0), np.full(16, 1e-3)])
    f = signal_tables.signal_table(signal_tables.indicators(make(spark, close, close + 0.3, close - 0.3, volume)), "lead").orderBy("time").toPandas()
    rsi = frame(spark, close, close + 0.3, close - 0.3, volume).rsi_14
    for i in range(n):
        at = slice(i - 14, i + 1)
        ok = i >= 14 and rsi[at].notna().all()
        bull = ok and close[i] <= np.percentile(close[at], 20) and rsi[i] > rsi[i - 14 : i].min()
        bear = ok and close[i] >= np.percentile(close[at], 80) and rsi[i] < rsi[i - 14 : i].max()
        assert (f.rsi_divergence_bullish[i], f.rsi_divergence_bearish[i]) == (bull, bear), i


def test_window_layers_share_one_shuffle(spark):
    plan = windowed.apply(B.bars_from_events(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # bars, series


def test_equal_obv_steps_are_not_parted_by_rounding(spark):
    close = np.concatenate([np.arange(1.0, 101), np.arange(101.0, 1, -1)])  # 100 steps of 0.1 up, 99 down, the first 0
    f = signal_tables.signal_table(signal_tables.indicators(make(spark, close, volume=np.full(200, 0.1))), "conf")
    assert f.where("obv_trend_strength_bull = 1 OR obv_trend_strength_bear = 1").count() == 0
