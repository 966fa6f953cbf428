"""Steps of queries that must not outgrow their input."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from finspark.operators import indicators
from finspark.operators.quality import _key_digest
from finspark.sinks import tables
from finspark.sinks.tables import Table, surrogate_key, upsert


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _prices(spark):
    r = random.Random(5)
    odd = [None, float("nan"), 0.0, float("inf")]
    rows = [(s, dt.date(2020, 1, 1) + dt.timedelta(days=i), r.choice(odd) if r.random() < 0.2 else r.random() * 100)
            for s, n in (("A", 1), ("B", 30), ("C", 420), (None, 300)) for i in range(n)]
    return spark.createDataFrame(rows, "symbol STRING, trade_date DATE, close_price DOUBLE").repartition(3)


@pytest.mark.parametrize("rows_per_block", [None, 210])
def test_frames_equal_the_windows(spark, monkeypatch, rows_per_block):
    df = _prices(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")  # series span batches
    try:
        out = indicators.stock_analytics(df, rows_per_block=rows_per_block)
        assert "MapInArrow" in _plan(out)
        got = sorted(map(repr, out.collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    monkeypatch.setattr(indicators, "_passes_arrow", lambda _: False)
    windows = indicators.stock_analytics(df, rows_per_block=rows_per_block)
    assert "MapInArrow" not in _plan(windows) and got == sorted(map(repr, windows.collect()))


def test_rows_without_a_key_are_no_series(spark):
    df = _prices(spark).where("symbol IS NULL OR symbol = 'B'")
    out = indicators.stock_analytics(df, rows_per_block=210)
    assert "Join" not in _plan(out)  # no series is longer than a block
    assert out.where("symbol IS NULL AND daily_return IS NULL AND moving_avg_20d IS NULL").count() == 300


def test_a_batch_and_its_state_are_not_written_again(spark, tmp_dir, monkeypatch):
    names, staged = [], indicators.staged
    monkeypatch.setattr(indicators, "staged", lambda df, name: names.append(name) or staged(df, name))
    state = Table(spark, f"{tmp_dir}/state")
    q = _prices(spark).where("symbol IS NOT NULL")
    for i, part in enumerate(("trade_date < '2020-03-01'", "trade_date >= '2020-03-01'")):
        indicators.stock_analytics_incremental(q.where(part), state, str(i))
    assert "t1_result" in names and "t1_input" not in names


def test_flawed_quotes_are_derived_once(spark, tmp_dir):
    from finspark.plans.q_jobs import _flawed_quotes
    rows = [(i, float(q), 10.0, dt.datetime(2024, 1, 1)) for i, q in enumerate((7, 10, 70, 3))]
    spark.createDataFrame(rows, "l_suppkey LONG, l_quantity DOUBLE, l_extendedprice DOUBLE, l_shipdate TIMESTAMP_NTZ"
                          ).write.parquet(f"{tmp_dir}/lineitem.parquet")
    out = _flawed_quotes(spark, tmp_dir)
    assert _plan(out).count("FileScan") == 1
    got = sorted(((r.symbol or "", r.volume) for r in out.collect()))
    assert got == [("", 10), ("", 70), ("S0", 7), ("S0", 7), ("S1", 10), ("S2", 70), ("S2", 70), ("S3", 3)]


def test_partitioned_upsert_merges_without_copies(spark, tmp_dir, monkeypatch):
    """The table is read while its new partitions are written; rows move, NULL keys and other partitions stay."""
    names, scratch = [], tables.scratch_path
    monkeypatch.setattr(tables, "scratch_path", lambda s, name: names.append(name) or scratch(s, name))
    t = Table(spark, f"{tmp_dir}/t", partition_by="m")
    rows = "k INT, m STRING, v INT"
    assert upsert(spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b", 3), (4, "c", 4)], rows), t, "k") == 4
    batch = f"{tmp_dir}/batch"
    spark.createDataFrame([(1, "b", 10), (5, "a", 5), (None, "a", 6), (4, "c", 4)], rows).write.parquet(batch)
    assert upsert(spark.read.parquet(batch), t, "k", stored=True) == 4
    got = sorted(map(repr, map(tuple, t.read().collect())))
    assert got == sorted(map(repr, [(1, "b", 10), (2, "a", 2), (3, "b", 3), (4, "c", 4), (5, "a", 5), (None, "a", 6)]))
    assert "upsert_source" not in names and "upsert_result" not in names


def test_failed_merge_leaves_the_partitions(spark, tmp_dir):
    t = Table(spark, f"{tmp_dir}/t", partition_by="m")
    upsert(spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k INT, m STRING, v INT"), t, "k")
    bad = spark.createDataFrame([(1, "a", 7), (1, "a", 8)], "k INT, m STRING, v INT")
    with pytest.raises(Exception, match="repeat a key differ"):
        upsert(bad, t, "k")
    assert sorted(map(tuple, t.read().collect())) == [(1, "a", 1), (2, "b", 2)]


def test_daily_job_casts_once(spark, tmp_dir, monkeypatch):
    from finspark.plans import jobs
    names, stage_once = [], jobs.stage_once
    monkeypatch.setattr(jobs, "stage_once", lambda df, name: names.append((name, df.columns)) or stage_once(df, name))
    rows = [("A" * 30, dt.date(2024, 1, 2), 1.0), ("B", dt.date(2024, 1, 2), 1.0), (None, dt.date(2024, 1, 2), 1.0)]
    q = spark.createDataFrame(rows, "symbol STRING, trade_date DATE, close_price DOUBLE")
    r = jobs.run_daily(spark, q, f"{tmp_dir}/w", dt.date(2024, 1, 2), 1)
    assert (r.extracted, r.validated, r.loaded, r.rejected) == (3, 1, 1, 2)
    [(name, columns)] = names
    assert name == "daily_analytics" and columns[-1] == "reject_reason"


def test_surrogate_key_ranges_are_bounded(spark, monkeypatch):
    asked, kind = [], type(spark.range(1))
    ranged = kind.repartitionByRange
    monkeypatch.setattr(kind, "repartitionByRange", lambda self, n, *c: asked.append(n) or ranged(self, n, *c))
    monkeypatch.setattr(tables, "MANY_RANGES", 20)
    df = spark.range(3000).select(F.lit("x").alias("o"), "id")
    ids = sorted(r.n for r in surrogate_key(df, "o", "n", rows_per_partition=10).collect())
    assert asked == [20] and ids == list(range(1, 3001))


def test_short_keys_are_no_longer_than_themselves(spark):
    rows = [(1, "ab", "c"), (1, "a", "bc"), (None, None, "-"), (2, "x" * 40, "y"), (2, "x" * 41, "y"), (3, "é" * 15, "")]
    df = spark.createDataFrame(rows, "a LONG, b STRING, c STRING")
    keys = [bytes(r[0]) for r in df.select(_key_digest(df, ["a", "b", "c"])).collect()]
    assert len(set(keys)) == len(rows) and [len(k) for k in keys][3:] == [32, 32, 32]
    assert max(len(k) for k in keys[:3]) < 12
