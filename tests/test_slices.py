"""The daily job in slices: bounded shuffle files, the same rows, all or nothing."""

import datetime as dt
import time

import pytest

from finspark.plans import jobs
from finspark.session import SHUFFLE_CLEANUP, path_exists, shuffles_end_with_actions
from finspark.sinks.tables import Table, upsert, upsert_slices

SCHEMA = "symbol STRING, trade_date DATE, open_price DOUBLE, close_price DOUBLE, volume LONG"


def _quotes(spark, more=0.0):
    day = lambda i: dt.date(2020, 1, 1) + dt.timedelta(days=11 * i)
    rows = [(f"S{s}", day(i), 1.0 + i, (s + 1) * 10.0 + i % 7 + more, i) for s in range(5) for i in range(40)]
    rows += [("S1", day(3), 2.0, 500.0, 9), ("S2", day(4), 2.0, None, 9), ("S2", None, 1.0, 1.0, 1), (None, day(5), 1.0, 1.0, 1),
             (None, None, None, None, None), ("L" * 30, day(6), 1.0, 2.0, 3), ("S3", day(50), 1.0, 1e300, 3),
             ("S4", day(41), None, float("nan"), None)]
    return spark.createDataFrame(rows, SCHEMA)


def _rows(df):
    return sorted(map(repr, map(tuple, df.select(*sorted(df.columns)).collect())))


def _run_twice(spark, root):
    counts = []
    for run_id, more in ((1, 0.0), (2, 0.5)):
        r = jobs.run_daily(spark, _quotes(spark, more), root, dt.date(2024, 1, 2), run_id)
        counts.append((r.extracted, r.validated, r.loaded, r.rejected))
    return counts


def _shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {x.rsplit("/", 1)[-1] for x in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in x}


def test_daily_job_in_slices_gives_the_same(spark, tmp_dir, monkeypatch):
    whole = _run_twice(spark, f"{tmp_dir}/whole")
    monkeypatch.setattr(jobs, "ROWS_PER_SLICE", 50)
    monkeypatch.setattr(jobs, "LOADS_PER_TRANSFORM", 3)
    sizes, load = [], jobs.upsert_slices
    monkeypatch.setattr(jobs, "upsert_slices", lambda slices, *a, **b: load((sizes.append(s.count()) or s for s in slices), *a, **b))
    assert _run_twice(spark, f"{tmp_dir}/sliced") == whole
    # the months of each run come in slices, none of which holds most rows
    assert len(sizes) >= 8 and max(sizes) < sum(sizes) / 4
    for table in (jobs.analytics_table, jobs.rejects_table):
        got, want = (table(spark, f"{tmp_dir}/{k}").read() for k in ("sliced", "whole"))
        assert got.schema == want.schema and _rows(got) == _rows(want)
    assert not path_exists(spark, f"{tmp_dir}/sliced/analytics/daily_stock_analytics/pending")


def test_daily_job_of_rejected_rows_in_slices(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(jobs, "ROWS_PER_SLICE", 1)
    q = spark.createDataFrame([(None, dt.date(2024, 1, i), 1.0, 1.0, 1) for i in (1, 2, 3)], SCHEMA)
    for _ in range(2):
        r = jobs.run_daily(spark, q, f"{tmp_dir}/w", dt.date(2024, 1, 2), 1)
        assert (r.extracted, r.validated, r.loaded, r.rejected) == (3, 0, 0, 3)
    assert jobs.analytics_table(spark, f"{tmp_dir}/w").read().count() == 0
    assert jobs.rejects_table(spark, f"{tmp_dir}/w").read().count() == 3


def test_daily_job_leaves_no_shuffle_files(spark, tmp_dir):
    before, setting = _shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP, None)
    q = _quotes(spark).repartition(3, "symbol")
    jobs.run_daily(spark, q, f"{tmp_dir}/w", dt.date(2024, 1, 2), 1)
    for _ in range(50):  # they are removed in the background
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left and spark.conf.get(SHUFFLE_CLEANUP, None) == setting
    with pytest.raises(ZeroDivisionError), shuffles_end_with_actions(spark):
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true" and 1 / 0
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == setting


def _table(spark, root):
    return Table(spark, root, partition_by="m", partition_of_key=True, sort_by="k")


def _frames(spark, root, *frames):
    for i, rows in enumerate(frames):
        spark.createDataFrame(rows, "k INT, m STRING, v INT").write.parquet(f"{root}/batch{i}")
        yield spark.read.parquet(f"{root}/batch{i}")


def test_upsert_in_slices_is_an_upsert(spark, tmp_dir):
    sliced, plain = _table(spark, f"{tmp_dir}/a"), _table(spark, f"{tmp_dir}/b")
    one, two = [(1, "a/b=c", 1), (2, "a/b=c", 2), (3, None, 3)], [(4, "01", 4), (4, "01", 4), (None, "", 5), (None, "", 5)]
    three, four = [(1, "a/b=c", 10), (6, None, 6)], [(None, "", 7), (7, "x", 7)]
    for i, (p, q) in enumerate(((one, two), (three, four))):
        applied = upsert_slices(_frames(spark, f"{tmp_dir}/{i}", p, q), sliced, "k", ["m", "v"])
        both = spark.createDataFrame(p + q, "k INT, m STRING, v INT")
        assert applied == upsert(both, plain, "k")
        assert _rows(sliced.read()) == _rows(plain.read()) and sliced.read().schema == plain.read().schema
    assert sliced.read().count() == 9


def test_failed_slices_leave_the_table(spark, tmp_dir):
    t = _table(spark, f"{tmp_dir}/t")
    upsert(spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k INT, m STRING, v INT"), t, "k")
    before = _rows(t.read())
    with pytest.raises(Exception, match="repeat a key differ"):
        upsert_slices(_frames(spark, f"{tmp_dir}/0", [(1, "a", 7)], [(2, "b", 8), (2, "b", 9)]), t, "k", ["m", "v"])
    with pytest.raises(ValueError, match="one partition"):
        upsert_slices(_frames(spark, f"{tmp_dir}/1", [(1, "a", 7)], [(5, "a", 8)]), t, "k", ["m", "v"])
    assert _rows(t.read()) == before and not path_exists(spark, f"{tmp_dir}/t/pending")
    with pytest.raises(ValueError, match="functions of its key"):
        upsert_slices([], Table(spark, f"{tmp_dir}/u"), "k", ["v"])
