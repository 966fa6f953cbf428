"""Quality rules: the source system's own unit cases, plus one-pass plan checks."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from finspark.operators.quality import (Rules, evaluate, raise_if_failed, summarize, type_compatible)

QUOTE = "symbol STRING, price DOUBLE, volume BIGINT"


def _summary(res):
    return {r.validator: r for r in summarize(res).collect()}


def test_complete_data_passes(spark):
    df = spark.createDataFrame([("A", 1.0, 10), ("B", 2.0, 20), ("C", 3.0, 30)], QUOTE)
    s = _summary(evaluate(df, Rules.completeness(["symbol", "price", "volume"])))
    assert s["completeness_validator"].ok and s["completeness_validator"].failed == 0


def test_missing_required_column_fails(spark):
    df = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "symbol STRING, price DOUBLE")
    res = evaluate(df, Rules.completeness(["symbol", "volume"]))
    row = res.where(F.col("check") == "required_columns").collect()[0]
    assert not row.ok and "volume" in row.details


def test_null_over_threshold_fails(spark):
    df = spark.createDataFrame([("A", 1.0), (None, 2.0), ("C", 3.0)], "symbol STRING, price DOUBLE")
    s = _summary(evaluate(df, Rules.completeness(null_threshold=10)))
    assert not s["completeness_validator"].ok
    assert s["completeness_validator"].failed == 1 and s["completeness_validator"].passed == 5


def test_empty_frame(spark):
    df = spark.createDataFrame([], QUOTE)
    res = evaluate(df, Rules.completeness())
    rows = {(r.check, r.column): r for r in res.collect()}
    assert not rows[("min_row_count", None)].ok
    assert rows[("null_threshold", "price")].ok  # 0 % when there are no rows


def test_value_ranges(spark):
    ok = spark.createDataFrame([("A", 10.0, 100), ("B", 300.0, 10000), ("C", 0.0, 0)], QUOTE)
    bad = spark.createDataFrame([("A", 10.0, 100), ("B", 500.0, 10), ("C", None, 5)], QUOTE)
    rule = Rules.accuracy(value_ranges={"price": (0, 300), "volume": (0, 10000)})
    assert _summary(evaluate(ok, rule))["accuracy_validator"].ok
    s = _summary(evaluate(bad, rule))["accuracy_validator"]
    assert not s.ok and s.failed == 1 and s.passed == 5  # missing passes a range check


def test_categorical_regex_custom(spark):
    df = spark.createDataFrame([("AAPL", 1.0, 1), ("msft", 2.0, 2), (None, 3.0, 3)], QUOTE)
    res = evaluate(df, Rules.accuracy(categorical_values={"symbol": ["AAPL", "msft"]},
                                      regex_patterns={"symbol": "[A-Z]+"},
                                      custom_rules={"volume": lambda c: c > 1,
                                                    "price": lambda c: c * F.col("nope") > 0}))
    rows = {r.check: r for r in res.collect()}
    assert rows["categorical_values"].failed == 1          # missing fails membership
    assert rows["regex_pattern"].failed == 1               # 'msft' fails; None -> 'None' matches
    assert rows["custom_rule"].failed == 1
    assert rows["accuracy"].failed == 3 and rows["accuracy"].passed == 6


def test_data_types_and_uniqueness(spark):
    df = spark.createDataFrame([("A", 1.0, 1), ("B", 2.0, 2)], QUOTE)
    s = _summary(evaluate(df, Rules.consistency(data_types={"symbol": "object", "price": "float64",
                                                            "volume": "int64"})))
    assert s["consistency_validator"].ok
    dup = spark.createDataFrame([(1, 1), (2, 2), (2, 3), (3, 4)], "id BIGINT, value BIGINT")
    s = _summary(evaluate(dup, Rules.consistency(unique_columns=["id"])))
    assert not s["consistency_validator"].ok and s["consistency_validator"].failed == 1


def test_uniqueness_counts_missing_as_a_value(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "id BIGINT, v BIGINT")
    row = evaluate(df, Rules.consistency(unique_columns=["id", ("id", "v")])).collect()
    by = {r.column: r for r in row if r.check == "uniqueness"}
    assert by["id"].failed == 1 and by["id,v"].failed == 0


def test_date_format_and_cross_field(spark):
    df = spark.createDataFrame([("2024-01-02", 1.0, 2.0), ("02/01/2024", 3.0, 2.0), (None, None, 1.0)],
                               "d STRING, lo DOUBLE, hi DOUBLE")
    res = evaluate(df, Rules.consistency(date_formats={"d": "%Y-%m-%d"},
                                         cross_field_rules=[("lo", "hi", lambda a, b: a <= b)]))
    rows = {r.check: r for r in res.collect()}
    assert rows["date_format"].failed == 1
    assert rows["cross_field"].failed == 2  # missing fails a two-column rule


def test_schema_rules(spark):
    df = spark.createDataFrame([("A", None, dt.datetime(2024, 1, 1))], "symbol STRING, px DOUBLE, ts TIMESTAMP_NTZ")
    res = evaluate(df, Rules.schema({"symbol": {"type": "string"}, "px": {"type": "float", "nullable": False},
                                     "ts": {"type": "datetime"}}, allow_extra_columns=False))
    s = _summary(res)["schema_validator"]
    assert not s.ok and s.failed == 1
    assert type_compatible("uint64", "int") and not type_compatible("float64", "int")


def test_strict_mode_raises(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], "id BIGINT, v BIGINT")
    res = evaluate(df, Rules.consistency(unique_columns=["id"]))
    with pytest.raises(ValueError, match="consistency_validator"):
        raise_if_failed(res, strict=True)
    raise_if_failed(res, strict=False)


def test_rule_set_is_one_scan_one_aggregate(spark, tmp_dir):
    spark.range(1000).selectExpr("id", "id % 7 AS v", "CAST(id AS STRING) AS s").write.parquet(tmp_dir + "/t")
    df = spark.read.parquet(tmp_dir + "/t")
    res = evaluate(df, [Rules.completeness(), Rules.accuracy(value_ranges={"v": (0, 5)}),
                        Rules.consistency(date_formats={"s": "%Y"})])
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "EvalPython" not in plan



@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.floats(-10, 10)), st.integers(0, 5)), min_size=1, max_size=30))
def test_accuracy_passed_plus_failed_is_checks_times_rows(spark, rows):
    df = spark.createDataFrame(rows, "x DOUBLE, y BIGINT")
    res = evaluate(df, Rules.accuracy(value_ranges={"x": (0, 5), "y": (1, 3)},
                                      categorical_values={"y": [1, 2]},
                                      custom_rules={"x": lambda c: c > -1}))
    tot = res.where(F.col("check") == "accuracy").collect()[0]
    assert tot.passed + tot.failed == 4 * len(rows)


def test_registered_validator_runs_in_the_same_pass(spark, tmp_dir):
    """UD5: a user validator is compiled into the one aggregate with the
    built-in ones; NULL predicates are no violation."""
    from finspark.operators.quality import register_validator

    def band_checks(df, kw):
        return [("below_floor", "x", F.col("x") < kw["floor"]),
                ("y_not_after_x", "y", F.col("y") <= F.col("x"))]

    register_validator("band_test", band_checks)
    rows = [(1, 5), (2, 1), (None, 3), (7, None), (8, 9)]
    spark.createDataFrame(rows, "x INT, y INT").write.parquet(tmp_dir + "/b")
    df = spark.read.parquet(tmp_dir + "/b")
    res = evaluate(df, [Rules.custom("band_test", floor=3), Rules.completeness(["x"])])
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    got = {(r.check, r.column): (r.passed, r.failed, r.ok)
           for r in res.where(F.col("validator") == "band_test_validator").collect()}
    # x < 3: (1, 5) and (2, 1); y <= x: only (2, 1); a NULL comparison is no violation
    assert got == {("below_floor", "x"): (3, 2, False), ("y_not_after_x", "y"): (4, 1, False),
                   ("band_test", None): (7, 3, False)}


def test_custom_validator_names_are_checked(spark):
    from finspark.operators.quality import register_validator
    with pytest.raises(ValueError, match="unknown validator"):
        Rules.custom("never_registered")
    with pytest.raises(ValueError, match="built-in"):
        register_validator("accuracy", lambda df, kw: [])
