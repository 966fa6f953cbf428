"""Sink semantics: versioning, insert-ignore, upsert, rewrites, conform, surrogate key."""

import datetime as dt
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from finspark.schemas import STOCK_PRICES
from finspark.sinks.tables import (Table, conform, delete_where, insert_ignore, load, read_staged, stage,
                                   surrogate_key, truncate_and_load, update_where, upsert)

KV = "k BIGINT, v STRING, seq INT"


def _rows(t):
    return sorted((r.k, r.v) for r in t.read().collect())


def test_load_modes_and_versions(spark, tmp_dir):
    t = Table(spark, tmp_dir + "/t")
    df = spark.createDataFrame([(1, "a", 0)], KV)
    assert load(df, t, "append") == 1
    assert load(df, t, "append") == 1
    assert len(t.read().collect()) == 2
    with pytest.raises(FileExistsError):
        load(df, t, "fail")
    assert load(spark.createDataFrame([(2, "b", 0)], KV), t, "replace") == 1
    assert _rows(t) == [(2, "b")]
    assert t.versions() == [1, 2]  # the previous version is kept
    with pytest.raises(ValueError):
        load(df, t, "merge")


def test_insert_ignore_keeps_existing_and_null_keys_never_conflict(spark, tmp_dir):
    t = Table(spark, tmp_dir + "/t")
    load(spark.createDataFrame([(1, "old", 0), (None, "n1", 0)], KV), t)
    batch = spark.createDataFrame([(1, "new", 1), (2, "first", 1), (2, "second", 2), (None, "n2", 1),
                                   (None, "n3", 2)], KV)
    assert insert_ignore(batch, t, "k", order_col="seq") == 3
    assert sorted((r.k or 0, r.v) for r in t.read().collect()) == [
        (0, "n1"), (0, "n2"), (0, "n3"), (1, "old"), (2, "first")]


def test_upsert_last_wins_partial_update_and_idempotent(spark, tmp_dir):
    schema = "k BIGINT, price DOUBLE, note STRING"
    t = Table(spark, tmp_dir + "/t")
    load(spark.createDataFrame([(1, 1.0, "keep"), (2, 2.0, "keep")], schema), t)
    batch = spark.createDataFrame([(1, 10.0, "x", 1), (1, 11.0, "y", 2), (3, 3.0, "ins", 1)],
                                  "k BIGINT, price DOUBLE, note STRING, seq INT")
    upsert(batch, t, "k", update_columns=["price"], order_col="seq")
    once = sorted(tuple(r) for r in t.read().collect())
    assert once == [(1, 11.0, "keep"), (2, 2.0, "keep"), (3, 3.0, "ins")]
    upsert(batch, t, "k", update_columns=["price"], order_col="seq")
    assert sorted(tuple(r) for r in t.read().collect()) == once


def test_upsert_without_update_columns_is_insert_ignore(spark, tmp_dir):
    t = Table(spark, tmp_dir + "/t")
    load(spark.createDataFrame([(1,)], "k BIGINT"), t)
    upsert(spark.createDataFrame([(1,), (2,)], "k BIGINT"), t, "k")
    assert sorted(r.k for r in t.read().collect()) == [1, 2]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.sampled_from("abc")), min_size=1, max_size=12))
def test_insert_ignore_never_changes_existing_rows(spark, rows):
    import tempfile
    t = Table(spark, tempfile.mkdtemp() + "/t")
    load(spark.createDataFrame([(0, "base", 0), (3, "base", 0)], KV), t)
    batch = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(rows)], KV)
    insert_ignore(batch, t, "k", order_col="seq")
    got = dict(_rows(t))
    assert got[0] == "base" and got[3] == "base"
    assert len(got) == len(t.read().collect())  # one row per key


def test_update_delete_truncate(spark, tmp_dir):
    t = Table(spark, tmp_dir + "/t")
    load(spark.createDataFrame([(1, "a", 0), (2, "b", 0), (3, "c", 0)], KV), t)
    assert update_where(t, {"v": "z"}, F.col("k") >= 2) == 2
    assert delete_where(t, "k = 3") == 1
    assert _rows(t) == [(1, "a"), (2, "z")]
    assert truncate_and_load(spark.createDataFrame([(9, "n", 0)], KV), t) == 1
    assert _rows(t) == [(9, "n")]


@pytest.mark.parametrize("fmt", ["parquet", "csv", "jsonl"])
def test_stage_round_trip(spark, tmp_dir, fmt):
    df = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 2, 3, 4, 5), 1.25)],
                               "k BIGINT, s STRING, ts TIMESTAMP_NTZ, x DOUBLE")
    path = stage(df, f"{tmp_dir}/{fmt}", fmt)
    assert read_staged(spark, path, fmt, schema=df.schema).collect() == df.collect()
    with pytest.raises(ValueError):
        stage(df, f"{tmp_dir}/x", "excel")


def test_conform_projects_casts_and_rejects(spark):
    df = spark.createDataFrame([("A", dt.date(2024, 1, 1), 1.23456, 10), (None, dt.date(2024, 1, 1), 2.0, 5),
                                ("B", dt.date(2024, 1, 2), 1e20, 7)],
                               "symbol STRING, trade_date DATE, close_price DOUBLE, volume BIGINT")
    good, rej = conform(df, STOCK_PRICES)
    g = good.collect()
    assert good.columns == STOCK_PRICES.schema.fieldNames()
    assert len(g) == 1 and str(g[0].close_price) == "1.2346" and g[0].open_price is None
    assert sorted(r.reject_reason for r in rej.collect()) == ["cast:close_price", "null:symbol"]


def test_surrogate_key_matches_global_order(spark):
    df = spark.createDataFrame([(f"S{i % 7}", i) for i in range(200)], "s STRING, n INT")
    out = surrogate_key(df, ["s", "n"], "id", partitions=5).collect()
    expect = sorted((r.s, r.n) for r in out)
    assert sorted((r.id, r.s, r.n) for r in out) == [(i + 1, s, n) for i, (s, n) in enumerate(expect)]


def test_stage_metrics_count_without_extra_jobs(spark, tmp_dir):
    from finspark.plans.jobs import StageMetrics, staged
    m = StageMetrics()
    df = m.observe(spark.range(10), "extract")
    m.timed("write", lambda: df.write.parquet(tmp_dir + "/m"))
    assert m.rows("extract") == 10 and m.seconds["write"] > 0
    d2, obs = staged(spark.range(3), "x")
    d2.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 3


def test_run_log_allocates_ids(spark, tmp_dir):
    from finspark.sinks.tables import log_run
    t = Table(spark, tmp_dir + "/log")
    start = dt.datetime(2024, 1, 2, 2)
    assert log_run(spark, t, None, "dag", "task", "src", "SUCCESS", start, loaded=5) == 1
    assert log_run(spark, t, None, "dag", "task", "src", "FAILED", start, error="boom") == 2
    rows = sorted((r.run_id, r.status, r.records_loaded) for r in t.read().collect())
    assert rows == [(1, "SUCCESS", 5), (2, "FAILED", None)]


def test_staged_path_prefix():
    from finspark.sinks.tables import staged_path
    assert staged_path("s3a://b/", "raw/x") == "s3a://b/staging/raw/x"
    assert staged_path("s3a://b", "staging/raw/x") == "s3a://b/staging/raw/x"


def _files(root):
    import glob
    return {p: os.path.getmtime(p) for p in glob.glob(root + "/**/*.parquet", recursive=True)}


def test_partitioned_upsert_rewrites_only_touched_partitions(spark, tmp_dir):
    schema = "k BIGINT, part STRING, v DOUBLE"
    t = Table(spark, tmp_dir + "/pt", partition_by="part")
    load(spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0), (3, "b", 3.0), (None, "b", 9.0)], schema), t)
    before = _files(tmp_dir + "/pt/data/part=b")
    batch = spark.createDataFrame([(1, "a", 10.0, 1), (1, "a", 11.0, 2), (4, "c", 4.0, 1)],
                                  "k BIGINT, part STRING, v DOUBLE, seq INT")
    assert upsert(batch, t, "k", order_col="seq") == 2
    got = sorted((r.k or 0, r.part, r.v) for r in t.read().collect())
    assert got == [(0, "b", 9.0), (1, "a", 11.0), (2, "a", 2.0), (3, "b", 3.0), (4, "c", 4.0)]
    assert _files(tmp_dir + "/pt/data/part=b") == before      # untouched partition kept as is


def test_partitioned_insert_ignore_update_delete(spark, tmp_dir):
    schema = "k BIGINT, part STRING, v DOUBLE"
    t = Table(spark, tmp_dir + "/pt", partition_by=["part"])
    load(spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)], schema), t)
    assert insert_ignore(spark.createDataFrame([(1, "a", 5.0), (4, "a", 4.0)], schema), t, "k") == 1
    assert update_where(t, {"v": F.col("v") * 10}, F.col("part") == "a") == 2
    assert delete_where(t, "part = 'c'") == 1
    assert not os.path.exists(tmp_dir + "/pt/data/part=c")    # emptied partition removed
    assert sorted((r.k, r.part, r.v) for r in t.read().collect()) == [
        (1, "a", 10.0), (2, "b", 2.0), (4, "a", 40.0)]


def test_sorted_files_let_filters_skip_row_groups(spark, tmp_dir):
    t = Table(spark, tmp_dir + "/s", sort_by=["k"])
    load(spark.range(2000).selectExpr("(id * 7919) % 2000 AS k", "id AS v").repartition(1), t)
    import pyarrow.parquet as pq
    import glob
    f = sorted(glob.glob(tmp_dir + "/s/v=*/*.parquet"))[0]
    col = pq.ParquetFile(f).read().column("k").to_pylist()
    assert col == sorted(col)


def test_failed_version_is_skipped_not_reused(spark, tmp_dir):
    t = Table(spark, tmp_dir + "/t")
    load(spark.createDataFrame([(1, "a", 0)], KV), t)
    os.makedirs(tmp_dir + "/t/v=000002")                 # a job died before its commit
    with open(tmp_dir + "/t/v=000002/part-0.parquet", "w") as f:
        f.write("partial")
    assert _rows(t) == [(1, "a")]                          # readers ignore it
    load(spark.createDataFrame([(2, "b", 0)], KV), t, "replace")
    assert t.versions() == [1, 3] and _rows(t) == [(2, "b")]


def test_range_partitions_grow_with_rows(spark):
    from finspark.session import range_partitions
    df = spark.range(0, 10_000)
    assert range_partitions(df, 1_000_000) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert range_partitions(df, 100) == 100
    assert range_partitions(df, 99) == 102


def test_surrogate_key_with_many_small_partitions(spark):
    from finspark.sinks.tables import surrogate_key
    df = spark.range(0, 5_000).select((F.col("id") * 7 % 5_000).alias("k"))
    out = surrogate_key(df, "k", rows_per_partition=300)
    got = sorted((r.k, r.id) for r in out.collect())
    assert got == [(k, k + 1) for k in range(5_000)]


def test_partitioned_replace_survives_failed_job(spark, tmp_dir):
    """A full replace of a partitioned table deletes nothing before its job
    commits: a failing job leaves the old content; a good one drops the
    partitions the new data does not hold."""
    from finspark.sinks.tables import Table, truncate_and_load
    t = Table(spark, tmp_dir + "/pt", partition_by="m")
    first = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id INT, m STRING")
    assert truncate_and_load(first, t) == 3 and t.exists()
    bad = spark.createDataFrame([(9, "c")], "id INT, m STRING").withColumn(
        "id", F.when(F.col("id") == 9, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).cast("int"))
    with pytest.raises(Exception):
        truncate_and_load(bad, t)
    assert sorted((r.id, r.m) for r in t.read().collect()) == [(1, "a"), (2, "a"), (3, "b")]
    second = spark.createDataFrame([(4, "b"), (5, "c")], "id INT, m STRING")
    assert truncate_and_load(second, t) == 2
    assert sorted((r.id, r.m) for r in t.read().collect()) == [(4, "b"), (5, "c")]
