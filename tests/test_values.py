"""CSV folders, bounded drains, carried state, distinct counts in one scan, run ids, ties and NaN."""

import datetime as dt
import gzip
import math
import os

import pytest
from pyspark.sql import functions as F

from finspark.functions.scalar import to_ts
from finspark.operators.aggregate import group_aggregate, resample
from finspark.operators.indicators import stock_analytics, stock_analytics_incremental
from finspark.operators.quality import Rules, evaluate
from finspark.operators.ratios import financial_ratios, portfolio_analytics
from finspark.session import list_names, path_exists, scratch_path, scratch_scope, staged
from finspark.sinks.tables import Table, load, log_run, reserve_run_id, surrogate_key
from finspark.sources import files
from finspark.streaming import drain as streams

NAN = math.nan


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


# ------------------------------------------------------------------- CSV
@pytest.mark.parametrize("second", ["b,a\ny,2\n", "a,b\n2,y\n"])
def test_csv_partition_folders(spark, tmp_dir, second):
    for day, text in {"01": "a,b\n1,x\n", "1": second, "__HIVE_DEFAULT_PARTITION__": "a,b\n3,z\n"}.items():
        os.makedirs(f"{tmp_dir}/day={day}")
        with open(f"{tmp_dir}/day={day}/f.csv", "w") as f:
            f.write(text)
    got = files.read_csv(spark, tmp_dir, "a INT, b STRING, day STRING")
    assert sorted(map(tuple, got.collect())) == [(1, "x", "01"), (2, "y", "1"), (3, "z", None)]
    inferred = files.read_csv(spark, tmp_dir)
    assert sorted(tuple(r[c] for c in "ab") for r in inferred.collect()) == [(1, "x"), (2, "y"), (3, "z")]
    assert dict(inferred.dtypes)["day"] == "bigint"


@pytest.mark.parametrize("by_scan", [False, True])
def test_csv_folder_of_several_writers(spark, tmp_dir, monkeypatch, by_scan):
    for name, text in {"a.csv": "a,b\n1,x\n", "b c.csv": "b,a\r\ny,2\r\n", "c.csv": "\n a,b\n3,z\n".replace(" ", ""), "d.csv": "b\nonly\n",
                       "e.csv": "", "f.csv": "a,b"}.items():
        with open(f"{tmp_dir}/{name}", "w", newline="") as f:
            f.write(text)
    with gzip.open(f"{tmp_dir}/g.csv.gz", "wt") as f:
        f.write("b,a\nw,4\n")
    if by_scan:  # a store that the workers can't open
        monkeypatch.setattr(files, "_openable", lambda file: False)
    got = files.read_csv(spark, tmp_dir, "a INT, b STRING")
    want = [(1, "x"), (2, "y"), (3, "z"), (4, "w"), (None, "only")]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert len(files.csv_headers(spark, tmp_dir)) == 3
    inferred = files.read_csv(spark, tmp_dir)
    assert dict(inferred.dtypes) == {"a": "bigint", "b": "string"} and inferred.count() == 5


def test_csv_headers_with_line_breaks_and_encodings(spark, tmp_dir):
    with open(f"{tmp_dir}/a.csv", "w", encoding="utf-16") as f:
        f.write("é,b\n1,x\n")
    assert files._first_line(f"file://{tmp_dir}/a.csv", "utf-16") == "é,b"
    with open(f"{tmp_dir}/b.csv", "w") as f:
        f.write('"two\nlines",b\n1,x\n')
    assert files._first_line(f"file://{tmp_dir}/b.csv", "utf-8") == '"two\nlines",b'


# ---------------------------------------------------------------- drains
def _land(tmp_dir, name, n, start=0):
    os.makedirs(f"{tmp_dir}/in", exist_ok=True)
    with open(f"{tmp_dir}/in/.{name}", "w") as f:
        f.writelines(f"m{i}\n" for i in range(start, start + n))
    os.rename(f"{tmp_dir}/in/.{name}", f"{tmp_dir}/in/{name}")


def _delivered(spark, sink):
    return sorted(r.value for r in spark.read.parquet(sink).collect())


def test_bounded_drains_deliver_each_message_once(spark, tmp_dir):
    sink, ckpt = f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    _land(tmp_dir, "a", 25)
    stream = streams.message_files(spark, f"{tmp_dir}/in", max_files_per_trigger=1)
    assert [streams.drain(stream, sink, ckpt, max_messages=10) for _ in range(2)] == [10, 10]
    _land(tmp_dir, "b", 7, start=25)
    assert streams.drain(stream, sink, ckpt, max_messages=10, timeout_s=60) == (10, True)
    assert streams.drain(stream, sink, ckpt, max_messages=10) == 2
    assert streams.drain(stream, sink, ckpt, max_messages=10) == 0
    assert _delivered(spark, sink) == sorted(f"m{i}" for i in range(32))
    assert sorted(r.portion for r in spark.read.parquet(sink).select("portion").distinct().collect()) == [0, 1, 2, 3]
    assert len([n for n in list_names(spark, f"{ckpt}/landed") if n.startswith("batch=")]) == 1  # delivered ones went
    with pytest.raises(ValueError, match="max_messages"):
        streams.drain(stream, sink, ckpt, max_messages=0)


def test_bounded_drain_finishes_a_cut_portion(spark, tmp_dir, monkeypatch):
    sink, ckpt = f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    _land(tmp_dir, "a", 12)
    stream = streams.message_files(spark, f"{tmp_dir}/in")
    deliver = streams._deliver

    def dies(*args):
        raise RuntimeError("cut")

    monkeypatch.setattr(streams, "_deliver", dies)
    with pytest.raises(RuntimeError):
        streams.drain(stream, sink, ckpt, max_messages=5)
    monkeypatch.setattr(streams, "_deliver", deliver)
    assert streams.drain(stream, sink, ckpt, max_messages=100) == 5  # the planned portion
    assert streams.drain(stream, sink, ckpt, max_messages=100) == 7
    assert _delivered(spark, sink) == sorted(f"m{i}" for i in range(12))


# --------------------------------------------------------- carried state
def _series(spark):
    rows = []
    for s, n in (("A", 260), ("B", 35), (None, 4)):
        for i in range(n):
            price = None if i % 9 == 4 or (s == "B" and i < 8) or s is None else (NAN if i % 13 == 6 else 50.0 + (i * 7919) % 23)
            rows.append((s, dt.date(2023, 1, 1) + dt.timedelta(days=i), price, i * 0.5))
    return spark.createDataFrame(rows, "symbol STRING, trade_date DATE, close_price DOUBLE, _d DOUBLE")


def _as_rows(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("rows_per_block", [None, 210])
def test_months_one_by_one_equal_the_whole(spark, tmp_dir, rows_per_block):
    q = _series(spark)
    whole = stock_analytics(q, rows_per_block=rows_per_block)
    assert whole.columns[:4] == q.columns and whole.where("_d <> 0").count() == 296  # input columns keep their values
    state, parts = Table(spark, f"{tmp_dir}/state"), []
    months = [r.m for r in q.select(F.trunc("trade_date", "month").alias("m")).distinct().orderBy("m").collect()]
    for m in months:
        batch = q.where(F.trunc("trade_date", "month") == F.lit(m))
        out = stock_analytics_incremental(batch, state, str(m), rows_per_block=rows_per_block)
        again = stock_analytics_incremental(batch, state, str(m), rows_per_block=rows_per_block)  # a retry
        assert _as_rows(out) == _as_rows(again)
        if m == months[1]:
            for _ in range(2):  # more retries continue from the same state
                again = stock_analytics_incremental(batch, state, str(m), rows_per_block=rows_per_block)
                assert _as_rows(out) == _as_rows(again) and len(state.versions()) == 2
        parts += out.collect()
    got = spark.createDataFrame(parts, whole.schema)
    assert _as_rows(got) == _as_rows(whole)
    assert state.read().groupBy("symbol").count().where("count > 199").count() == 0
    late = q.where("symbol = 'A'").limit(3)
    with pytest.raises(ValueError, match="after the state"):
        stock_analytics_incremental(late, state, "late")


# ------------------------------------------------- one scan, no Expand
def test_many_unique_keys_take_one_scan(spark):
    rows = [(1, "a", 2.0, None), (1, "b", -0.0, b"x"), (2, None, 0.0, b"x"), (2, None, NAN, None), (2, "", NAN, b"")]
    df = spark.createDataFrame(rows, "a INT, b STRING, c DOUBLE, d BINARY")
    keys = ["a", "b", "c", "d", ["a", "b"], ["b", "d"]]
    res = evaluate(df, Rules.consistency(unique_columns=keys))
    got = {r.column: r.failed for r in res.where("check = 'uniqueness'").collect()}
    assert got == {"a": 3, "b": 1, "c": 2, "d": 2, "a,b": 1, "b,d": 0}
    five = evaluate(spark.range(10).selectExpr("id a", "id b", "id c", "id d", "id e"),
                    Rules.consistency(unique_columns=["a", "b", "c", "d", "e"]))
    plan = plan_of(five)
    assert "Expand" not in plan and plan.count("Range (") == 2  # one for the five keys, one for the other checks
    assert all(r.failed == 0 for r in five.collect())


def test_many_distinct_counts_do_not_multiply_rows(spark):
    df = spark.createDataFrame([("g", 1, "x", 1.0), ("g", 1, None, NAN), ("g", 2, "x", NAN), ("h", None, None, NAN), (None, 9, "z", 1.0)],
                               "g STRING, a INT, b STRING, c DOUBLE")
    out = group_aggregate(df, "g", {"a": ["nunique", "sum"], "b": "nunique", "c": ["nunique", "count"]})
    assert [tuple(r) for r in out.collect()] == [("g", 2, 4, 1, 1, 1), ("h", 0, 0, 0, 0, 0)]
    assert "Expand" not in plan_of(out)


# ------------------------------------------------------------ ids, ties
def test_two_interleaved_runs_get_two_ids(spark, tmp_dir):
    t = Table(spark, f"{tmp_dir}/log")
    first, second = reserve_run_id(spark, t), reserve_run_id(spark, t)  # neither has logged its row yet
    start = dt.datetime(2024, 1, 2)
    assert {log_run(spark, t, i, "d", "t", "s", "SUCCESS", start) for i in (second, first)} == {1, 2}
    assert log_run(spark, t, None, "d", "t", "s", "SUCCESS", start) == 3 and len(t.read().collect()) == 3


def test_equal_order_values_span_partitions_and_ids_are_stable(spark):
    df = spark.range(3000).select(F.lit(1).alias("o"), (F.col("id") % 1500).alias("v"), F.lit(None).cast("string").alias("n"))
    ids = [sorted((r.id, r.v) for r in surrogate_key(d, "o", rows_per_partition=300).collect())
           for d in (df, df.repartition(7))]
    assert ids[0] == ids[1] and [i for i, _ in ids[0]] == list(range(1, 3001))


# -------------------------------------------------------------------- NaN
def test_nan_is_missing(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", NAN), ("a", 3.0), ("b", NAN)], "g STRING, x DOUBLE")
    got = group_aggregate(df, "g", {"x": ["sum", "mean", "max", "count", "std", "median"]}).collect()
    assert tuple(got[0])[:5] == ("a", 4.0, 2.0, 3.0, 2) and got[0].x_median == 2.0
    assert tuple(got[1])[:5] == ("b", 0.0, None, None, 0)
    days = df.withColumn("d", F.lit(dt.date(2024, 1, 2)))
    assert tuple(resample(days, "d", "D", ["x"]).first()) == (dt.date(2024, 1, 2), 2.0, 4.0, 1.0, 3.0, 2)
    p = spark.createDataFrame([("p", "2024", 1.0, 1.0, 2.0), ("p", "2024", 1.0, 1.0, NAN), ("p", "2024", 1.0, 1.0, 6.0)],
                              "portfolio_id STRING, position_date STRING, quantity DOUBLE, avg_cost DOUBLE, current_price DOUBLE")
    assert sorted((r.weight for r in portfolio_analytics(p).collect()), key=repr) == [0.25, 0.75, None]
    cols = "total_assets total_liabilities shareholders_equity net_income revenue".split()
    r = financial_ratios(spark.createDataFrame([(NAN, 1.0, 2.0, 3.0, NAN)], ", ".join(f"{c} DOUBLE" for c in cols))).first()
    assert (r.roa, r.profit_margin, r.debt_to_equity) == (None, None, 0.5)


def test_first_and_last_without_order_values(spark):
    df = spark.createDataFrame([("a", "y", None), ("a", "x", None), ("b", "q", 2), ("b", None, 1), ("b", "p", None)],
                               "g STRING, v STRING, o INT")
    got = group_aggregate(df, "g", {"v": ["first", "last"]}, order_col="o").collect()
    assert [tuple(r) for r in got] == [("a", "x", "y"), ("b", "q", "q")]


def test_two_digit_years(spark):
    texts = ["05/01/85", "05/01/69", "05/01/68", "29/02/72", "05/01/00"]
    got = spark.createDataFrame([(t,) for t in texts], "t STRING").select(to_ts("t", "%d/%m/%y").cast("string")).collect()
    assert [r[0][:10] for r in got] == [dt.datetime.strptime(t, "%d/%m/%y").strftime("%Y-%m-%d") for t in texts]


# ---------------------------------------------------------------- scratch
def test_scratch_folders_go_with_their_scope(spark, tmp_dir):
    with scratch_scope(spark):
        held = staged(spark.range(3), "x")
        inside = scratch_path(spark, "y")
        rows = held.count()
    path = held.inputFiles()[0].rsplit("/", 1)[0]
    assert rows == 3 and not path_exists(spark, path) and not path_exists(spark, inside)


def test_a_run_again_replaces_its_rejects(spark, tmp_dir):
    from finspark.plans.jobs import analytics_table, rejects_table, run_daily
    bad = spark.createDataFrame([("A" * 30, dt.date(2024, 1, 2), 1.0), ("B", dt.date(2024, 1, 2), 1.0)],
                                "symbol STRING, trade_date DATE, close_price DOUBLE")
    for _ in range(2):
        r = run_daily(spark, bad, f"{tmp_dir}/w", dt.date(2024, 1, 2), 7, incremental=True)
        assert (r.rejected, r.loaded) == (1, 1)
    assert rejects_table(spark, f"{tmp_dir}/w").read().count() == 1
    # the first load keeps the column that orders the batch, too
    assert analytics_table(spark, f"{tmp_dir}/w").read().first()["processed_at"] == dt.datetime(2024, 1, 2, 2)
