"""Awkward inputs: CSV line breaks, float texts, registered validators, one scan per table."""

import datetime as dt
import decimal
import math

import pytest
from pyspark.sql import functions as F

from finspark.functions.scalar import parses_as
from finspark.operators.quality import Rules, evaluate, python_float_text, raise_if_failed, register_validator, summarize
from finspark.plans.views import positions, quotes
from finspark.schemas import TableSpec
from finspark.sinks.tables import (Table, delete_where, insert_ignore, load, quality_log_rows, read_staged, stage,
                                   update_where, upsert)
from finspark.sources.files import read_csv

SF = "/root/testdata/sf0.001"


def test_csv_quoted_line_breaks(spark, tmp_dir):
    with open(f"{tmp_dir}/a.csv", "w") as f:
        f.write('b,a\n"two\nlines",1\n"q ""w"" e",2\n')
    got = read_csv(spark, tmp_dir, "a INT, b STRING", multi_line=True).collect()
    assert sorted(map(tuple, got)) == [(1, "two\nlines"), (2, 'q "w" e')]
    by_place = read_csv(spark, tmp_dir, "x STRING, y STRING", header=False, multi_line=True).collect()
    assert tuple(by_place[0]) == ("b", "a")


def test_float_texts_are_those_of_python(spark):
    values = [0.0, -0.0, 1.0, 1e7, 12345678.9, 1e15, 1e16, 1.5e16, -2.5e300, 1e-3, 1e-4, 1.25e-4, 1e-5, -1.5e-7, 1e100,
              5e-324, 0.1, 123.456, math.inf, -math.inf, 9007199254740993.0]
    df = spark.createDataFrame([(v,) for v in values], "x DOUBLE")
    for r in df.select("x", python_float_text("x").alias("t")).collect():
        if r.x != 5e-324:  # Java writes the smallest number with more digits
            assert r.t == repr(r.x)
    assert spark.range(1).select(F.lit(math.nan).alias("x")).select(python_float_text("x")).first()[0] == "nan"


def test_date_formats(spark):
    cases = [("20240131", "%Y%m%d", True), ("20241301", "%Y%m%d", False), ("2024-1-5", "%Y-%m-%d", True),
             ("Mon, 01 Jan 2024", "%a, %d %b %Y", True), ("Xon, 01 Jan 2024", "%a, %d %b %Y", False),
             ("Monday 01 January 2024", "%A %d %B %Y", True), ("2024-01-01T10:00:00+02:00", "%Y-%m-%dT%H:%M:%S%z", True),
             ("2024-01-01T10:00:00+0200", "%Y-%m-%dT%H:%M:%S%z", True), ("2024-01-01T10:00:00Z", "%Y-%m-%dT%H:%M:%S%z", True),
             ("2024-01-01T10:00:00", "%Y-%m-%dT%H:%M:%S%z", False), ("101530", "%H%M%S", True)]
    for text, fmt, want in cases:
        df = spark.createDataFrame([(text,)], "d STRING")
        assert df.select(parses_as("d", fmt)).first()[0] is want, (text, fmt)


def test_registered_validator_raises_in_strict_mode_and_is_logged(spark):
    register_validator("positive", lambda df, kw: [("positive", kw["column"], F.col(kw["column"]) <= 0)])
    df = spark.createDataFrame([(1,), (-1,), (None,)], "v INT")
    res = evaluate(df, [Rules.custom("positive", column="v")])
    assert [(r.validation_type, r.passed, r.failed, r.ok) for r in summarize(res).collect()] == [("positive", 2, 1, False)]
    with pytest.raises(ValueError, match="positive"):
        raise_if_failed(res, strict=True)
    row = quality_log_rows(res, 7, dt.datetime(2024, 1, 1)).first()
    assert (row.validation_type, row.passed_records, row.failed_records) == ("positive", 2, 1)


def test_upsert_cases(spark, tmp_dir):
    t = Table(spark, f"{tmp_dir}/a")
    load(spark.createDataFrame([(1, "a")], "k INT, v STRING"), t)
    batch = spark.createDataFrame([(1, "new", None), (3, "ins", None)], "k INT, v STRING, o INT")
    upsert(batch, t, "k", order_col="o")
    insert_ignore(spark.createDataFrame([(2, "x", None), (2, "y", 5), (1, "no", 1)], "k INT, v STRING, o INT"), t, "k", order_col="o")
    got = sorted((r.k, r.v) for r in t.read().collect())
    assert got == [(1, "new"), (2, "y"), (3, "ins")]
    twice = spark.createDataFrame([(9, "p"), (9, "q")], "k INT, v STRING")
    with pytest.raises(Exception, match="order_col"):
        upsert(twice, t, "k")
    assert upsert(twice.limit(1).unionAll(twice.limit(1)), t, "k") == 1
    assert len(t.versions()) == 2  # the current version and the one before


def test_null_keys_stay_out_of_joins_and_dedupe(spark, tmp_dir):
    """Rows with a NULL key part go by union, with no tag by row position that another run could give to other rows."""
    from finspark.sinks import tables
    df = spark.range(2_000).select(F.when(F.col("id") % 20 == 0, F.col("id")).alias("k"), "id")
    keyed, nameless = tables._by_key(df, ["k"])
    assert (keyed.count(), nameless.count()) == (100, 1900)
    plan = tables._one_per_key(keyed, ["k"], "id", last=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "monotonically_increasing_id" not in plan
    assert tables._by_key(spark.range(3), ["id"])[1] is None  # a column that is never NULL has no second branch


def test_rows_that_differ_in_their_nulls_are_different(spark, tmp_dir):
    t = Table(spark, f"{tmp_dir}/t")
    swapped = spark.createDataFrame([(1, "x", None), (1, None, "x")], "k INT, a STRING, b STRING")
    with pytest.raises(Exception, match="order_col"):
        upsert(swapped, t, "k")
    for batch in (swapped, swapped.orderBy("a")):
        t = Table(spark, f"{tmp_dir}/{id(batch)}")
        assert upsert(batch.withColumn("o", F.lit(None).cast("int")), t, "k", order_col="o") == 1
        assert tuple(t.read().first()) == (1, "x", None)
    maps = spark.createDataFrame([(1, {"a": 1, "b": 2}, 1), (1, {"b": 2, "a": 1}, 1)], "k INT, m MAP<STRING, INT>, o INT")
    assert upsert(maps.drop("o"), Table(spark, f"{tmp_dir}/m"), "k") == 1


@pytest.mark.parametrize("parts", [None, "p"])
def test_keys_are_compared_in_the_types_of_the_table(spark, tmp_dir, parts):
    t = Table(spark, f"{tmp_dir}/t", partition_by=parts)
    load(spark.createDataFrame([(1, "a", "x"), (None, "n", "x")], "k INT, v STRING, p STRING"), t)
    texts = "k STRING, v STRING, p STRING, o INT"
    rows = [("01", "b", "y", 1), ("1", "c", "x", 2), ("2", "d", "x", 1), ("02", "e", "y", 2), (None, "m", "x", 1)]
    assert upsert(spark.createDataFrame(rows, texts), t, "k", order_col="o") == 3
    rows = [("03", "f", "x", 1), ("3", "g", "y", 2), ("001", "no", "x", 1)]
    assert insert_ignore(spark.createDataFrame(rows, texts), t, "k", order_col="o") == 1
    want = [(1, "c", "x"), (2, "e", "y"), (3, "f", "x"), (None, "m", "x"), (None, "n", "x")]
    assert sorted(map(tuple, t.read().collect()), key=repr) == sorted(want, key=repr)


def test_order_column_of_the_table_is_updated(spark, tmp_dir):
    schema = "k INT, v STRING, at INT"
    spec = TableSpec("t", spark.createDataFrame([], schema).schema, key=("k",), not_null=())
    t = Table(spark, f"{tmp_dir}/t", spec)
    upsert(spark.createDataFrame([(1, "a", 1), (1, "b", 2)], schema), t, "k", order_col="at")
    assert t.read().collect() == [(1, "b", 2)]
    upsert(spark.createDataFrame([(1, "d", 4), (1, "c", 3)], schema), t, "k", order_col="at")
    assert t.read().collect() == [(1, "d", 4)]


def test_updated_partition_columns_move_rows(spark, tmp_dir):
    t = Table(spark, f"{tmp_dir}/t", partition_by="p")
    rows = [(1, 1.0, "a"), (2, 2.0, "b"), (3, 3.0, "c"), (4, 4.0, None)]
    load(spark.createDataFrame(rows, "k INT, w DOUBLE, p STRING"), t)
    assert update_where(t, {"p": "b", "w": 7}, "k = 1") == 1  # the rows of b stay
    assert update_where(t, {"p": None}, "k = 3") == 1
    assert update_where(t, {"p": "new"}, "p IS NULL AND k = 4") == 1
    assert update_where(t, {"p": "b"}, "k = 99") == 0
    want = [(1, 7.0, "b"), (2, 2.0, "b"), (3, 3.0, None), (4, 4.0, "new")]
    assert sorted(map(tuple, t.read().collect())) == want
    assert dict(t.read().dtypes) == {"k": "int", "w": "double", "p": "string"}


PARTITION_VALUES = {
    "STRING": ["", None, "01", "1", "~", "~x", "a/b", "50%", "a=b", " x ", "2024-01-05", "__HIVE_DEFAULT_PARTITION__", "é漢"],
    "DOUBLE": [0.1, -1.5, float("nan"), None, 1e300], "DATE": [dt.date(2024, 1, 5), None], "BOOLEAN": [True, False, None],
    "DECIMAL(10,2)": [decimal.Decimal("1.50"), decimal.Decimal("-3.00"), None], "BIGINT": [1, -7, None],
    "TIMESTAMP_NTZ": [dt.datetime(2024, 1, 2, 3, 4, 5, 678901), None], "BINARY": [b"", b"\x00/", None]}


@pytest.mark.parametrize("kind", PARTITION_VALUES)
def test_partition_values_survive_every_load(spark, tmp_dir, kind):
    values = PARTITION_VALUES[kind]
    rows = [(i, v, "old") for i, v in enumerate(values)]
    schema = f"k INT, p {kind}, v STRING"

    def held(t):
        assert t.read().schema["p"].dataType == spark.createDataFrame([], schema).schema["p"].dataType
        return sorted((r.k, repr(r.p), r.v) for r in t.read().collect())

    def as_held(rows):
        return sorted((k, repr(p), v) for k, p, v in rows)

    t = Table(spark, f"{tmp_dir}/t", partition_by="p")
    assert load(spark.createDataFrame(rows, schema), t) == len(rows) and held(t) == as_held(rows)
    assert load(spark.createDataFrame(rows, schema), t, "replace") == len(rows) and held(t) == as_held(rows)
    rows[::2] = [(k, p, "new") for k, p, _ in rows[::2]]
    assert upsert(spark.createDataFrame(rows[::2], schema), t, "k") == len(rows[::2])
    assert insert_ignore(spark.createDataFrame(rows, schema), t, "k") == 0 and held(t) == as_held(rows)
    moved = [(i, values[i - 1], "moved") for i in range(len(values))]
    upsert(spark.createDataFrame(moved, schema), t, "k")
    assert held(t) == as_held(moved)
    assert delete_where(t, F.col("p").isNull()) == values.count(None)
    kept = [r for r in moved if r[1] is not None]
    assert held(t) == as_held(kept)
    assert delete_where(t, F.col("p").eqNullSafe(F.lit(values[0]).cast(kind))) == (values[0] is not None)
    assert held(t) == as_held([r for r in kept if r[1] != values[0]])


TEXTS = ["", None, " lead ", "two\nlines", "cr\rlf\r\n", '"quoted"', "a,b", "\\N", "\\", "\\n", "\\e", "\\s", "\x00nul", "#c", "é漢😀", "\ufeff"]


@pytest.mark.parametrize("fmt", ["csv", "jsonl", "parquet"])
def test_staged_values_and_types_come_back(spark, tmp_dir, fmt):
    rows = [(i, t, 0.1 * i, dt.datetime(2024, 1, 2, 3, 4, 5, i), decimal.Decimal(i), i % 2 == 0) for i, t in enumerate(TEXTS)]
    rows.append((None,) * 6)
    df = spark.createDataFrame(rows, "`a b` INT, t STRING, x DOUBLE, at TIMESTAMP_NTZ, m DECIMAL(12,3), f BOOLEAN")
    for parts in (None, ["t"]):
        df_ = df if not parts else df.where("t IS NULL OR NOT contains(t, chr(0))")
        path = stage(df_, f"{tmp_dir}/{fmt}-{bool(parts)}", fmt, partition_by=parts)
        got = read_staged(spark, path, fmt)
        assert got.schema.simpleString() == df_.schema.simpleString()
        assert sorted(map(repr, got.collect())) == sorted(map(repr, df_.collect()))
    stage(df_, path, fmt, mode="append", partition_by=parts)
    assert read_staged(spark, path, fmt).count() == 2 * df_.count()
    assert read_staged(spark, path, fmt, schema="t STRING, x FLOAT").columns == ["t", "x"]
    with pytest.raises(ValueError, match="holds"):
        stage(df_.drop("x"), path, fmt, mode="append")
    if fmt == "csv":
        with pytest.raises(ValueError, match="lossless"):
            stage(df.select(F.array("x").alias("a")), f"{tmp_dir}/nested", fmt)


@pytest.mark.parametrize("build", ["portfolio", "resample", "t1"])
def test_each_table_is_scanned_once(spark, build):
    """Computed inputs are written once: the final plan reads the staged rows, not the tables again."""
    from finspark.operators.aggregate import resample
    from finspark.operators.indicators import stock_analytics
    from finspark.operators.ratios import portfolio_analytics
    from finspark.plans.views import table
    out = {"portfolio": lambda: portfolio_analytics(positions(spark, SF)),
           "t1": lambda: stock_analytics(quotes(spark, SF)),
           "resample": lambda: resample(table(spark, SF, "orders"), "o_orderdate", "W", ["o_totalprice"])}[build]()
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in plan.splitlines() if "Relation" in line]
    names = [n for n in ("lineitem", "o_orderkey", "o_orderdate") if n in plan]
    if build == "resample":
        assert len(scans) == 1
    else:
        assert not any("l_orderkey" in line for line in scans) and "l_orderkey" not in names


def test_uniqueness_checks_do_not_multiply_rows(spark):
    df = spark.createDataFrame([(1, "a", 2), (1, "b", 2), (2, None, None), (2, None, None)], "a INT, b STRING, c INT")
    res = evaluate(df, Rules.consistency(unique_columns=["a", "b", ["a", "c"]]))
    got = {r.column: r.failed for r in res.where("check = 'uniqueness'").collect()}
    assert got == {"a": 2, "b": 1, "a,c": 2}
    assert "Expand" not in res._jdf.queryExecution().executedPlan().toString()
