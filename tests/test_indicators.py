"""T1 goldens (hand-computed), blocked == per-symbol windows, plan shape."""

import datetime as dt
import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from finspark.operators.indicators import stock_analytics

SCHEMA = "symbol STRING, trade_date DATE, close_price DOUBLE"


def _series(spark, prices, symbol="A", start=dt.date(2024, 1, 1)):
    rows = [(symbol, start + dt.timedelta(days=i), p) for i, p in enumerate(prices)]
    return spark.createDataFrame(rows, SCHEMA)


def _collect(df):
    return [r.asDict() for r in df.orderBy("symbol", "trade_date").collect()]


@pytest.mark.parametrize("rows_per_block", [None, 200])
def test_constant_series_rsi_missing(spark, rows_per_block):
    out = _collect(stock_analytics(_series(spark, [10.0] * 16), rows_per_block=rows_per_block))
    assert all(r["rsi_14d"] is None for r in out)
    assert out[0]["daily_return"] is None
    assert all(r["daily_return"] == 0.0 for r in out[1:])
    assert out[0]["volatility_20d"] is None  # one value (none, really) -> missing
    assert out[2]["volatility_20d"] == 0.0


@pytest.mark.parametrize("rows_per_block", [None, 200])
def test_rising_and_falling_rsi(spark, rows_per_block):
    up = _collect(stock_analytics(_series(spark, [float(i) for i in range(1, 17)]),
                                  rows_per_block=rows_per_block))
    assert [r["rsi_14d"] for r in up[:13]] == [None] * 13
    assert [r["rsi_14d"] for r in up[13:]] == [100.0] * 3
    down = _collect(stock_analytics(_series(spark, [float(20 - i) for i in range(16)]),
                                    rows_per_block=rows_per_block))
    assert [r["rsi_14d"] for r in down[13:]] == [0.0] * 3


def test_rsi_value_by_hand(spark):
    prices = [44.0, 44.5, 44.0, 45.0, 46.0, 45.5, 46.5, 47.0, 46.0, 47.5, 48.0, 47.0, 48.5, 49.0]
    out = _collect(stock_analytics(_series(spark, prices)))
    deltas = [None] + [b - a for a, b in zip(prices, prices[1:])]
    gains = [d if d and d > 0 else 0.0 for d in deltas]
    losses = [-d if d and d < 0 else 0.0 for d in deltas]
    g, l = sum(gains) / 14, sum(losses) / 14
    assert out[-1]["rsi_14d"] == pytest.approx(100 - 100 / (1 + g / l))
    assert out[-1]["moving_avg_20d"] == pytest.approx(sum(prices) / 14)


def test_price_gap_forward_fill(spark):
    out = _collect(stock_analytics(_series(spark, [10.0, 11.0, None, 12.1])))
    assert out[2]["daily_return"] == 0.0
    assert out[3]["daily_return"] == pytest.approx(12.1 / 11.0 - 1)
    assert out[2]["moving_avg_20d"] == pytest.approx(10.5)


def test_null_symbol_rows_kept_without_indicators(spark):
    df = _series(spark, [1.0, 2.0, 3.0]).unionByName(_series(spark, [5.0, 6.0], symbol=None))
    out = stock_analytics(df).where(F.col("symbol").isNull()).collect()
    assert len(out) == 2
    assert all(r["daily_return"] is None and r["moving_avg_20d"] is None for r in out)


def test_forward_fill_carried_across_blocks(spark):
    # a long run of missing prices crossing block borders
    prices = [float(i + 1) for i in range(30)] + [None] * 300 + [100.0]
    out = _collect(stock_analytics(_series(spark, prices), rows_per_block=220))
    assert out[-1]["daily_return"] == pytest.approx(100.0 / 30.0 - 1)


def _close(a, b):
    if a is None or b is None:
        return a is b
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


def test_blocked_equals_per_symbol(spark):
    rnd = random.Random(7)
    rows = []
    for s, n in (("HOT", 2500), ("B", 300), ("C", 40)):
        p = 100.0
        for i in range(n):
            p = max(1.0, p + rnd.uniform(-2, 2))
            rows.append((s, dt.date(2000, 1, 1) + dt.timedelta(days=i), None if rnd.random() < 0.03 else p))
    df = spark.createDataFrame(rows, SCHEMA)
    a = _collect(stock_analytics(df, rows_per_block=None))
    b = _collect(stock_analytics(df, rows_per_block=200))
    assert len(a) == len(b) == 2840
    for x, y in zip(a, b):
        for k in x:
            assert _close(x[k], y[k]) if isinstance(x[k], float) or x[k] is None else x[k] == y[k], (k, x, y)


def test_plan_has_no_python_and_one_exchange_per_key(spark):
    df = _series(spark, [float(i) for i in range(30)])
    plan = stock_analytics(df, rows_per_block=None)._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan
    assert plan.count("Exchange hashpartitioning(symbol") <= 1


def test_blocked_plan_shuffles_data_once(spark, tmp_dir):
    rows = [("A" if i % 3 else "B", dt.date(2000, 1, 1) + dt.timedelta(days=i // 2), float(i)) for i in range(600)]
    spark.createDataFrame(rows, SCHEMA).dropDuplicates(["symbol", "trade_date"]).write.parquet(tmp_dir + "/q")
    df = spark.read.parquet(tmp_dir + "/q")
    out = stock_analytics(df, rows_per_block=250)
    out.write.format("noop").mode("overwrite").save()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1   # by (symbol, block) only
    assert "BroadcastHashJoin" in plan and "EvalPython" not in plan



@settings(max_examples=4, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(1, 1000)), min_size=1, max_size=60))
def test_rsi_bounded_and_ma_within_window(spark, prices):
    out = _collect(stock_analytics(_series(spark, prices), ma_windows=(5,), rows_per_block=None))
    for i, r in enumerate(out):
        if r["rsi_14d"] is not None:
            assert -1e-9 <= r["rsi_14d"] <= 100 + 1e-9
        window = [p for p in prices[max(0, i - 4): i + 1] if p is not None]
        if window:
            assert min(window) - 1e-9 <= r["moving_avg_5d"] <= max(window) + 1e-9
        else:
            assert r["moving_avg_5d"] is None


@pytest.mark.parametrize("rows_per_block", [None, 200])
def test_tie_break_orders_duplicate_dates(spark, rows_per_block):
    rows = [("A", dt.date(2024, 1, 1), 1, 10.0), ("A", dt.date(2024, 1, 1), 2, 20.0),
            ("A", dt.date(2024, 1, 2), 1, 40.0)]
    df = spark.createDataFrame(rows, "symbol STRING, trade_date DATE, seq INT, close_price DOUBLE")
    out = stock_analytics(df, rows_per_block=rows_per_block, tie_break=["seq"]).orderBy("trade_date", "seq")
    assert [r.daily_return for r in out.collect()] == [None, 1.0, 1.0]


def test_oversized_bucket_is_refined(spark):
    """Year cells (365-366 rows) exceed 250-row blocks: the count table is rebuilt
    by month, and the blocked result still equals the per-symbol one."""
    from finspark.operators.indicators import _count_table
    rnd = random.Random(11)
    rows, p = [], 50.0
    for i in range(1500):
        p = max(1.0, p + rnd.uniform(-1, 1))
        rows.append(("HOT", dt.date(2001, 1, 1) + dt.timedelta(days=i), p))
    rows += [("B", dt.date(2001, 1, 1) + dt.timedelta(days=i), 10.0 + i) for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    yearly = df.withColumn("_bkt", F.date_trunc("year", F.col("trade_date").cast("timestamp_ntz")))
    table, biggest = _count_table(yearly, ["symbol"], "trade_date", "close_price", (), 250, 199)
    # only HOT is longer than a block; 2004 is a leap year
    assert biggest == 366 and table.count() == 5
    a = _collect(stock_analytics(df, rows_per_block=None))
    b = _collect(stock_analytics(df, rows_per_block=250, bucket="year"))
    assert len(a) == len(b) == 1530
    for x, y in zip(a, b):
        for k in x:
            assert _close(x[k], y[k]) if isinstance(x[k], float) or x[k] is None else x[k] == y[k], (k, x, y)


def test_long_null_key_series_is_blocked_and_kept(spark):
    """More NULL-symbol rows than a block: they are split like any long series,
    every row comes back, and their indicators stay NULL."""
    rows = [(None, dt.date(2010, 1, 1) + dt.timedelta(days=i), float(i % 17 + 1)) for i in range(700)]
    rows += [("A", dt.date(2010, 1, 1) + dt.timedelta(days=i), 5.0 + i % 7) for i in range(120)]
    df = spark.createDataFrame(rows, SCHEMA)
    a = _collect(stock_analytics(df, rows_per_block=None))
    b = _collect(stock_analytics(df, rows_per_block=200))
    assert len(a) == len(b) == 820
    assert all(r["moving_avg_20d"] is None and r["rsi_14d"] is None for r in b if r["symbol"] is None)
    for x, y in zip(a, b):
        for k in x:
            assert _close(x[k], y[k]) if isinstance(x[k], float) or x[k] is None else x[k] == y[k], (k, x, y)


def test_short_series_plan_has_no_join(spark, tmp_dir):
    """No series longer than a block: plain per-symbol windows, one Exchange,
    no join with a count table."""
    rows = [(s, dt.date(2000, 1, 1) + dt.timedelta(days=i), float(i)) for s in "ABC" for i in range(100)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(tmp_dir + "/short")
    df = spark.read.parquet(tmp_dir + "/short")
    out = stock_analytics(df, rows_per_block=250)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
    assert len(out.collect()) == 300
