"""Catalogue phase 4: quality rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from finspark.operators.quality import (Rules, evaluate, invalid_values, range_violation,
                                        register_validator, sample_violations, summarize, violations)
from finspark.plans.catalogue import register
from finspark.plans.views import QUOTES_SQL, quotes, table, with_views

OUT = ["validator", "check", "column", "passed", "failed", "ok"]

LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                 "l_shipdate"]

# lineitem with cells nulled by fixed rules (the given tables have no NULLs)
_LI_NULLS_SQL = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       CASE WHEN l_linenumber = 6 THEN NULL ELSE l_discount END AS l_discount, l_tax,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE l_returnflag END AS l_returnflag,
       l_linestatus,
       CASE WHEN l_quantity > 49 THEN NULL ELSE l_shipdate END AS l_shipdate
FROM lineitem"""


def _li_nulls(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        F.when(F.col("l_linenumber") != 6, F.col("l_discount")).alias("l_discount"), "l_tax",
        F.when(F.col("l_linenumber") != 7, F.col("l_returnflag")).alias("l_returnflag"),
        "l_linestatus",
        F.when(F.col("l_quantity") <= 49, F.col("l_shipdate")).alias("l_shipdate"))


def _rows(df, checks):
    return df.where(F.col("check").isin(*checks)).select(*OUT)


def _q(s: str) -> str:
    return s.replace("'", "''")


def _row_sql(validator, check, column, passed, failed, ok, src):
    col = "NULL" if column is None else f"'{_q(column)}'"
    return (f"SELECT '{validator}' AS validator, '{check}' AS \"check\", CAST({col} AS VARCHAR) AS \"column\", "
            f"CAST({passed} AS BIGINT) AS passed, CAST({failed} AS BIGINT) AS failed, "
            f"CAST({ok} AS BOOLEAN) AS ok FROM ({src})")


# ------------------------------------------------------------ completeness
_NULL_THR = 5


def _null_rows_sql():
    parts = []
    for c in LINEITEM_COLS:
        nulls = f"COUNT_IF({c} IS NULL)"
        pct = f"CASE WHEN COUNT(*) > 0 THEN {nulls} / COUNT(*) * 100 ELSE 0.0 END"
        parts.append(_row_sql("completeness_validator", "null_threshold", c,
                              f"COUNT(*) - {nulls}", nulls, f"{pct} <= {float(_NULL_THR)}",
                              f"SELECT * FROM li"))
    return parts


@register("null_profile", with_views("\nUNION ALL\n".join(
    p.replace("FROM (SELECT * FROM li)", "FROM li") for p in _null_rows_sql()), li=_LI_NULLS_SQL))
def null_profile(spark, sf):
    res = evaluate(_li_nulls(spark, sf), Rules.completeness(null_threshold=_NULL_THR))
    return _rows(res, ["null_threshold"])


def _completeness_totals_sql():
    null_cells = " + ".join(f"COUNT_IF({c} IS NULL)" for c in LINEITEM_COLS)
    per_col_ok = " AND ".join(
        f"(CASE WHEN COUNT(*) > 0 THEN COUNT_IF({c} IS NULL) / COUNT(*) * 100 ELSE 0.0 END <= {float(_NULL_THR)})"
        for c in LINEITEM_COLS)
    ncols = len(LINEITEM_COLS)
    rows = [
        _row_sql("completeness_validator", "min_row_count", None,
                 "CASE WHEN COUNT(*) >= 1 THEN COUNT(*) ELSE 0 END",
                 "CASE WHEN COUNT(*) >= 1 THEN 0 ELSE COUNT(*) END", "COUNT(*) >= 1", "SELECT * FROM li"),
        _row_sql("completeness_validator", "required_columns", None,
                 "0", "COUNT(*)", "false", "SELECT * FROM li"),
        _row_sql("completeness_validator", "completeness", None,
                 f"COUNT(*) * {ncols} - ({null_cells})", f"({null_cells})",
                 f"COUNT(*) >= 1 AND false AND {per_col_ok}", "SELECT * FROM li"),
    ]
    return "\nUNION ALL\n".join(r.replace("FROM (SELECT * FROM li)", "FROM li") for r in rows)


@register("completeness_totals", with_views(_completeness_totals_sql(), li=_LI_NULLS_SQL))
def completeness_totals(spark, sf):
    # 'l_comment' is required but absent: the required-columns check fails
    res = evaluate(_li_nulls(spark, sf), Rules.completeness(
        required_columns=["l_orderkey", "l_comment"], null_threshold=_NULL_THR, min_row_count=1))
    return _rows(res, ["min_row_count", "required_columns", "completeness"])


@register("row_count_band", _row_sql(
    "completeness_validator", "expected_record_count", None,
    "CASE WHEN n BETWEEN 13500 AND 16500 THEN n ELSE 0 END",
    "CASE WHEN n BETWEEN 13500 AND 16500 THEN 0 ELSE n END",
    "n BETWEEN 13500 AND 16500", "SELECT COUNT(*) AS n FROM orders"))
def row_count_band(spark, sf):
    res = evaluate(table(spark, sf, "orders"), Rules.row_count_band(15000, tolerance=0.1))
    return res.select(*OUT)


# ---------------------------------------------------------------- accuracy
def _acc_sql(checks, src):
    """checks: list of (check, column, violation SQL)."""
    rows = [_row_sql("accuracy_validator", ck, c, f"COUNT(*) - COUNT_IF({v})", f"COUNT_IF({v})",
                     f"COUNT_IF({v}) = 0", src) for ck, c, v in checks]
    passed = " + ".join(f"(COUNT(*) - COUNT_IF({v}))" for _, _, v in checks)
    failed = " + ".join(f"COUNT_IF({v})" for _, _, v in checks)
    oks = " AND ".join(f"COUNT_IF({v}) = 0" for _, _, v in checks)
    rows.append(_row_sql("accuracy_validator", "accuracy", None, passed, failed, oks, src))
    return "\nUNION ALL\n".join(rows)


def _range_sql(c, lo, hi):
    return f"COALESCE({c} < {lo} OR {c} > {hi}, false)"


@register("value_range", with_views(_acc_sql([
    ("value_range", "close_price", _range_sql("close_price", 0, 2000)),
    ("value_range", "volume", _range_sql("volume", 0, 100)),
    ("value_range", "low_price", _range_sql("low_price", 950, 100000))], "SELECT * FROM quotes"),
    quotes=QUOTES_SQL))
def value_range(spark, sf):
    res = evaluate(quotes(spark, sf), Rules.accuracy(value_ranges={
        "close_price": (0, 2000), "volume": (0, 100), "low_price": (950, 100000),
        "not_a_column": (0, 1)}))
    return res.select(*OUT)


@register("categorical_values", _acc_sql([
    ("categorical_values", "o_orderpriority",
     "NOT COALESCE(o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED'), false)"),
    ("categorical_values", "o_orderstatus", "NOT COALESCE(o_orderstatus IN ('F', 'O'), false)")],
    "SELECT * FROM orders"))
def categorical_values(spark, sf):
    res = evaluate(table(spark, sf, "orders"), Rules.accuracy(categorical_values={
        "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"],
        "o_orderstatus": ["F", "O"]}))
    return res.select(*OUT)


@register("regex_pattern", _acc_sql([
    ("regex_pattern", "c_name",
     "NOT regexp_matches(COALESCE(CAST(c_name AS VARCHAR), 'None'), '^(?:Customer#00000[0-4])')"),
    ("regex_pattern", "c_mktsegment",
     "NOT regexp_matches(COALESCE(CAST(c_mktsegment AS VARCHAR), 'None'), '^(?:[A-Z]+)')"),
    ("regex_pattern", "c_nationkey",
     "NOT regexp_matches(COALESCE(CAST(c_nationkey AS VARCHAR), 'nan'), '^(?:1)')")],
    "SELECT * FROM customer"))
def regex_pattern(spark, sf):
    res = evaluate(table(spark, sf, "customer"), Rules.accuracy(regex_patterns={
        "c_name": "Customer#00000[0-4]", "c_mktsegment": "[A-Z]+", "c_nationkey": "1"}))
    return res.select(*OUT)


def even_volume(c):
    return c % 2 == 0


def broken_rule(c):
    return c * F.col("no_such_column") > 0


@register("custom_rule", with_views(_acc_sql([
    ("custom_rule", "volume", "NOT COALESCE(volume % 2 = 0, false)"),
    ("custom_rule", "close_price", "NOT COALESCE(close_price > 1000, false)")],
    "SELECT * FROM quotes"), quotes=QUOTES_SQL))
def custom_rule(spark, sf):
    res = evaluate(quotes(spark, sf), Rules.accuracy(custom_rules={
        "volume": even_volume, "close_price": lambda c: c > 1000,
        # fails analysis: logged and not counted
        "open_price": broken_rule}))
    return res.select(*OUT)


# ------------------------------------------------------------- consistency
def _cons_sql(checks, src):
    """checks: list of (check, column, failed-count SQL)."""
    rows = [_row_sql("consistency_validator", ck, c, f"COUNT(*) - ({bad})", f"({bad})", f"({bad}) = 0", src)
            for ck, c, bad in checks]
    passed = " + ".join(f"(COUNT(*) - ({bad}))" for _, _, bad in checks)
    failed = " + ".join(f"({bad})" for _, _, bad in checks)
    oks = " AND ".join(f"({bad}) = 0" for _, _, bad in checks)
    rows.append(_row_sql("consistency_validator", "consistency", None, passed, failed, oks, src))
    return "\nUNION ALL\n".join(rows)


@register("uniqueness", _cons_sql([
    ("uniqueness", "o_orderkey", "COUNT(*) - COUNT(DISTINCT o_orderkey) - MAX(CASE WHEN o_orderkey IS NULL THEN 1 ELSE 0 END)"),
    ("uniqueness", "o_custkey", "COUNT(*) - COUNT(DISTINCT o_custkey) - MAX(CASE WHEN o_custkey IS NULL THEN 1 ELSE 0 END)")],
    "SELECT * FROM orders"))
def uniqueness(spark, sf):
    res = evaluate(table(spark, sf, "orders"), Rules.consistency(unique_columns=["o_orderkey", "o_custkey"]))
    return res.select(*OUT)


@register("uniqueness_composite", _cons_sql([
    ("uniqueness", "l_orderkey,l_linenumber",
     "COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))")],
    "SELECT * FROM lineitem"))
def uniqueness_composite(spark, sf):
    res = evaluate(table(spark, sf, "lineitem"),
                   Rules.consistency(unique_columns=[("l_orderkey", "l_linenumber")]))
    return res.select(*OUT)


_DATES_SQL = """
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '5-LOW' THEN strftime(o_orderdate, '%d/%m/%Y')
            ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_day
FROM orders"""


def _order_days(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW",
                                         F.date_format("o_orderdate", "dd/MM/yyyy"))
                    .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("order_day"))


@register("date_format", _cons_sql([
    ("date_format", "order_day",
     "COUNT_IF(NOT (order_day IS NULL OR try_strptime(order_day, '%Y-%m-%d') IS NOT NULL))")],
    _DATES_SQL))
def date_format(spark, sf):
    res = evaluate(_order_days(spark, sf), Rules.consistency(date_formats={"order_day": "%Y-%m-%d"}))
    return res.select(*OUT)


@register("cross_field", with_views(_cons_sql([
    ("cross_field", "low_price,high_price", "COUNT_IF(NOT COALESCE(low_price <= high_price, false))"),
    ("cross_field", "open_price,close_price", "COUNT_IF(NOT COALESCE(open_price <= close_price, false))")],
    "SELECT * FROM quotes"), quotes=QUOTES_SQL))
def cross_field(spark, sf):
    res = evaluate(quotes(spark, sf), Rules.consistency(cross_field_rules=[
        ("low_price", "high_price", lambda a, b: a <= b),
        ("open_price", "close_price", lambda a, b: a <= b)]))
    return res.select(*OUT)


# ------------------------------------------------------------------ schema
@register("nullability", with_views("\nUNION ALL\n".join([
    _row_sql("schema_validator", "missing_columns", None, "0", "COUNT(*)", "false", "SELECT * FROM li"),
    _row_sql("schema_validator", "nullability", "l_returnflag", "COUNT(*) - COUNT_IF(l_returnflag IS NULL)",
             "COUNT_IF(l_returnflag IS NULL)", "COUNT_IF(l_returnflag IS NULL) = 0", "SELECT * FROM li"),
    _row_sql("schema_validator", "data_type", "l_returnflag", "COUNT(*)", "0", "true", "SELECT * FROM li"),
    _row_sql("schema_validator", "nullability", "l_orderkey", "COUNT(*)", "0", "true", "SELECT * FROM li"),
    _row_sql("schema_validator", "data_type", "l_orderkey", "COUNT(*)", "0", "true", "SELECT * FROM li"),
    _row_sql("schema_validator", "data_type", "l_quantity", "0", "COUNT(*)", "false", "SELECT * FROM li"),
    _row_sql("schema_validator", "schema", None, "0", "COUNT(*)", "false", "SELECT * FROM li"),
]), li=_LI_NULLS_SQL))
def nullability(spark, sf):
    res = evaluate(_li_nulls(spark, sf), Rules.schema({
        "l_orderkey": {"type": "int", "nullable": False},
        "l_returnflag": {"type": "string", "nullable": False},
        "l_quantity": {"type": "int"},          # is float64: type check fails
        "l_comment": {"type": "string"},        # missing column
    }))
    return res.select(*OUT)


# -------------------------------------------------------------- quality log
_QL_SRC = "SELECT * FROM li"


_QL_R = (_completeness_totals_sql() + "\nUNION ALL\n"
         + _acc_sql([("value_range", "l_quantity", _range_sql("l_quantity", 1, 45)),
                     ("value_range", "l_discount", _range_sql("l_discount", 0, 0.08))], _QL_SRC)
         .replace("FROM (SELECT * FROM li)", "FROM li"))


@register("quality_log", with_views("""
SELECT "check" AS validation_type, validator AS validation_rule,
       passed AS passed_records, failed AS failed_records, passed + failed AS total_records,
       COALESCE(passed * 100.0 / NULLIF(passed + failed, 0), 0.0) AS success_rate
FROM r WHERE "check" IN ('completeness', 'accuracy')""", li=_LI_NULLS_SQL, r=_QL_R))
def quality_log(spark, sf):
    res = evaluate(_li_nulls(spark, sf), [
        Rules.completeness(required_columns=["l_orderkey", "l_comment"], null_threshold=_NULL_THR),
        Rules.accuracy(value_ranges={"l_quantity": (1, 45), "l_discount": (0, 0.08)})])
    s = summarize(res)
    return s.select(F.col("validation_type"), F.col("validator").alias("validation_rule"),
                    F.col("passed").alias("passed_records"), F.col("failed").alias("failed_records"),
                    F.col("total").alias("total_records"), "success_rate")


# --------------------------------------------------------- violating rows
@register("violating_rows", with_views("""
SELECT * FROM quotes WHERE COALESCE(close_price < 0 OR close_price > 2000, false)""", quotes=QUOTES_SQL))
def violating_rows(spark, sf):
    return violations(quotes(spark, sf), range_violation("close_price", 0, 2000))


@register("violation_sample", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
WHERE COALESCE(l_quantity < 5 OR l_quantity > 45, false)
ORDER BY l_orderkey, l_linenumber, l_partkey LIMIT 5""")
def violation_sample(spark, sf):
    li = table(spark, sf, "lineitem")
    return sample_violations(li, range_violation("l_quantity", 5, 45), "l_quantity",
                             ["l_orderkey", "l_linenumber", "l_partkey"], n=5)


@register("invalid_value_sample", """
SELECT DISTINCT l_quantity FROM lineitem
WHERE COALESCE(l_quantity < 5 OR l_quantity > 45, false)
ORDER BY l_quantity LIMIT 10""")
def invalid_value_sample(spark, sf):
    li = table(spark, sf, "lineitem")
    return invalid_values(li, range_violation("l_quantity", 5, 45), "l_quantity", n=10)


# ------------------------------------------------------- UD5 user validator
def _price_sanity_checks(df, kw):
    lo, hi, close = F.col("low_price"), F.col("high_price"), F.col("close_price")
    return [("low_above_high", "low_price", lo > hi),
            ("close_outside_range", "close_price", (close < lo) | (close > hi)),
            ("volume_not_positive", "volume", F.col("volume") <= kw.get("min_volume", 0))]


register_validator("price_sanity", _price_sanity_checks)


def _sum_sql(validator, total, checks, src):
    """checks: list of (check, column, violation SQL); NULL is no violation."""
    vs = [(ck, c, f"COALESCE({v}, false)") for ck, c, v in checks]
    rows = [_row_sql(validator, ck, c, f"COUNT(*) - COUNT_IF({v})", f"COUNT_IF({v})",
                     f"COUNT_IF({v}) = 0", src) for ck, c, v in vs]
    passed = " + ".join(f"(COUNT(*) - COUNT_IF({v}))" for _, _, v in vs)
    failed = " + ".join(f"COUNT_IF({v})" for _, _, v in vs)
    oks = " AND ".join(f"COUNT_IF({v}) = 0" for _, _, v in vs)
    rows.append(_row_sql(validator, total, None, passed, failed, oks, src))
    return "\nUNION ALL\n".join(rows)


@register("custom_validator", with_views(_sum_sql("price_sanity_validator", "price_sanity", [
    ("low_above_high", "low_price", "low_price > high_price"),
    ("close_outside_range", "close_price", "close_price < low_price OR close_price > high_price"),
    ("volume_not_positive", "volume", "volume <= 10")],
    "SELECT * FROM quotes"), quotes=QUOTES_SQL))
def custom_validator(spark, sf):
    """UD5: a user-registered validator next to a built-in one, both in one
    aggregate pass over the quotes."""
    res = evaluate(quotes(spark, sf), [Rules.custom("price_sanity", min_volume=10),
                                       Rules.completeness(["symbol"])])
    return res.where(F.col("validator") == "price_sanity_validator").select(*OUT)

