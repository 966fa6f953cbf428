"""Catalogue phase 9: awkward inputs and options that the other phases leave out.

The test tables are clean, so the flaws (NaN, quotes in CSV fields, mixed date
texts, repeated keys, over-long symbols) are derived from them by fixed rules.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from finspark.functions.scalar import to_ts
from finspark.operators.aggregate import group_aggregate
from finspark.operators.enrich import Lookup, enrich
from finspark.operators.quality import COMPANY_FINANCIAL_RULES, Rules, evaluate
from finspark.plans.catalogue import register
from finspark.plans.q_quality import OUT, _acc_sql, _cons_sql, _row_sql
from finspark.plans.views import FINANCIALS_SQL, QUOTES_SQL, financials, quotes, table, with_views
from finspark.schemas import COMPANY_FINANCIALS
from finspark.session import scratch_path
from finspark.sinks.tables import Table, conform, duplicate_keys, load, quality_log_rows
from finspark.sources.documents import find
from finspark.sources.files import read_csv
from finspark.sinks.tables import stage


# ------------------------------------------------------------------- CSV
@register("csv_header_order", "SELECT o_orderkey, o_totalprice, o_orderstatus, CAST(NULL AS VARCHAR) AS note FROM orders")
def csv_header_order(spark, sf):
    """A file whose columns stand in another order than the schema, which also names one that the file lacks."""
    path = scratch_path(spark, "csv_order")
    o = table(spark, sf, "orders").select("o_orderstatus", F.col("o_totalprice").cast("string"), "o_orderkey")
    o.write.option("header", True).csv(path)
    return read_csv(spark, path, "o_orderkey BIGINT, o_totalprice DOUBLE, o_orderstatus STRING, note STRING")


@register("csv_quotes", """
SELECT o_orderkey, 'say "' || o_orderpriority || '", twice' AS remark FROM orders""")
def csv_quotes(spark, sf):
    """Fields with separators and doubled quotes."""
    path = scratch_path(spark, "csv_quotes")
    remark = F.concat(F.lit('say "'), "o_orderpriority", F.lit('", twice')).alias("remark")
    (table(spark, sf, "orders").select("o_orderkey", remark)
     .write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path))
    return read_csv(spark, path, "o_orderkey BIGINT, remark STRING")


@register("csv_infer_na", """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price,
       CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS customer,
       CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus = 'O' END AS open,
       CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority
FROM orders""")
def csv_infer_na(spark, sf):
    """Types inferred without a schema: NA tokens neither stay as text nor make a column text."""
    def na(keep, column, token):
        return F.when(keep, F.col(column).cast("string")).otherwise(F.lit(token))

    path = scratch_path(spark, "csv_infer")
    o = table(spark, sf, "orders").withColumn("open", (F.col("o_orderstatus") == "O"))
    o.select("o_orderkey", na(F.col("o_orderstatus") != "P", "o_totalprice", "N/A").alias("price"),
             na(F.col("o_orderkey") % 3 != 0, "o_custkey", "null").alias("customer"),
             na(F.col("o_orderkey") % 5 != 0, "open", "n/a").alias("open"),
             na(F.col("o_orderpriority") != "5-LOW", "o_orderpriority", "NA").alias("priority")
             ).write.option("header", True).csv(path)
    return read_csv(spark, path)


# ------------------------------------------------------------ validators
@register("value_range_nan", _acc_sql([("value_range", "l_discount", "l_linenumber <> 3 AND l_discount > 0.05")],
                                      "SELECT * FROM lineitem"))
def value_range_nan(spark, sf):
    """NaN is missing, not a value beyond the range."""
    nan = F.when(F.col("l_linenumber") == 3, F.lit(float("nan"))).otherwise(F.col("l_discount"))
    li = table(spark, sf, "lineitem").withColumn("l_discount", nan)
    return evaluate(li, Rules.accuracy(value_ranges={"l_discount": (0, 0.05)})).select(*OUT)


@register("regex_text_forms", _acc_sql([
    ("regex_pattern", "big", "l_linenumber = 2 OR l_linenumber = 3"),
    ("regex_pattern", "small", "l_linenumber <> 1"),
    ("regex_pattern", "flag", "l_returnflag <> 'R'")], "SELECT * FROM lineitem"))
def regex_text_forms(spark, sf):
    """Patterns see floats as 10000000.0, nan or 1e+16, small ones as 1e-05, booleans as True and False."""
    line = F.col("l_linenumber")
    big = F.when(line == 2, F.lit(float("nan"))).when(line == 3, F.lit(1e16)).otherwise(line * F.lit(1e7))
    li = table(spark, sf, "lineitem").select("l_linenumber", big.alias("big"), (F.lit(1e-5) * line).alias("small"),
                                             (F.col("l_returnflag") == "R").alias("flag"))
    return evaluate(li, Rules.accuracy(regex_patterns={
        "big": r"\d+0000000\.0$", "small": r"1e-05$", "flag": "True$"})).select(*OUT)


_DATE_CASES = ["compact", "offset", "weekday"]


@register("date_formats_compact", _cons_sql([
    ("date_format", "compact", "COUNT_IF(o_orderstatus = 'P')"),
    ("date_format", "offset", "COUNT_IF(o_orderstatus = 'F')"),
    ("date_format", "weekday", "COUNT_IF(o_orderpriority = '5-LOW')")], "SELECT * FROM orders"))
def date_formats_compact(spark, sf):
    """Fields without a separator, offsets in three spellings, weekday names."""
    day, key, status = F.col("o_orderdate"), F.col("o_orderkey"), F.col("o_orderstatus")
    stamp = F.date_format(day, "yyyy-MM-dd HH:mm:ss")
    zone = F.when(key % 3 == 0, "+0000").when(key % 3 == 1, "+00:00").otherwise("Z")
    o = table(spark, sf, "orders").select(
        F.when(status == "P", F.date_format(day, "yyyy-MMdd")).otherwise(F.date_format(day, "yyyyMMdd")).alias("compact"),
        F.concat(stamp, F.when(status == "F", F.lit(" somewhere")).otherwise(zone)).alias("offset"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.date_format(day, "'Nonday', dd MMM yyyy"))
        .otherwise(F.date_format(day, "EEE, dd MMM yyyy")).alias("weekday"))
    return evaluate(o, Rules.consistency(date_formats={
        "compact": "%Y%m%d", "offset": "%Y-%m-%d %H:%M:%S%z", "weekday": "%a, %d %b %Y"})).select(*OUT)


@register("to_timestamp", """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS at FROM orders""")
def q_to_timestamp(spark, sf):
    text = F.when(F.col("o_orderstatus") == "P", F.lit("soon")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    o = table(spark, sf, "orders").withColumn("text", text)
    return o.select("o_orderkey", to_ts("text", "%d/%m/%Y").cast("timestamp_ntz").alias("at"))


@register("custom_validator_log", with_views("""
SELECT 'price_sanity' AS validation_type, 'price_sanity_validator' AS validation_rule,
       CAST(3 * COUNT(*) - COUNT_IF(low_price > high_price) - COUNT_IF(close_price < low_price OR close_price > high_price)
            - COUNT_IF(volume <= 10) AS BIGINT) AS passed_records,
       CAST(COUNT_IF(low_price > high_price) + COUNT_IF(close_price < low_price OR close_price > high_price)
            + COUNT_IF(volume <= 10) AS BIGINT) AS failed_records
FROM quotes""", quotes=QUOTES_SQL))
def custom_validator_log(spark, sf):
    """A registered validator's row of the quality log has its type and counts."""
    res = evaluate(quotes(spark, sf), [Rules.custom("price_sanity", min_volume=10), Rules.completeness(["symbol"])])
    log = quality_log_rows(res, 1, dt.datetime(2024, 1, 2))
    return (log.where(F.col("validation_rule") == "price_sanity_validator")
            .select("validation_type", "validation_rule", "passed_records", "failed_records"))


@register("schema_extra_columns", "\nUNION ALL\n".join([
    _row_sql("schema_validator", "missing_columns", None, "COUNT(*)", "0", "TRUE", "SELECT * FROM customer"),
    _row_sql("schema_validator", "extra_columns", None, "0", "COUNT(*)", "FALSE", "SELECT * FROM customer"),
    _row_sql("schema_validator", "data_type", "c_custkey", "COUNT(*)", "0", "TRUE", "SELECT * FROM customer"),
    _row_sql("schema_validator", "schema", None, "0", "COUNT(*)", "FALSE", "SELECT * FROM customer")]))
def schema_extra_columns(spark, sf):
    return evaluate(table(spark, sf, "customer"), Rules.schema(
        {"c_custkey": {"type": "int"}}, allow_extra_columns=False)).select(*OUT)


@register("statement_rules", with_views("\nUNION ALL\n".join([
    _row_sql("accuracy_validator", "value_range", "revenue", "COUNT_IF(revenue >= 0)", "COUNT_IF(revenue < 0)",
             "COUNT_IF(revenue < 0) = 0", "SELECT * FROM f"),
    _row_sql("accuracy_validator", "value_range", "net_income", "COUNT(*)", "0", "TRUE", "SELECT * FROM f"),
    _row_sql("accuracy_validator", "accuracy", None, "COUNT(*) + COUNT_IF(revenue >= 0)", "COUNT_IF(revenue < 0)",
             "COUNT_IF(revenue < 0) = 0", "SELECT * FROM f"),
    _row_sql("completeness_validator", "required_columns", None, "COUNT(*)", "0", "TRUE", "SELECT * FROM f")]),
    f=FINANCIALS_SQL))
def statement_rules(spark, sf):
    """The configured rule set of company statements."""
    res = evaluate(financials(spark, sf), Rules.from_config(COMPANY_FINANCIAL_RULES))
    return res.where("validator = 'accuracy_validator' OR check = 'required_columns'").select(*OUT)


@register("check_details", """
SELECT "column", '{"range":[5,45],"violations":' || CAST(COUNT_IF(l_quantity < 5 OR l_quantity > 45) AS VARCHAR) || '}' AS details
FROM lineitem, (VALUES ('l_quantity')) v("column") GROUP BY "column" """)
def check_details(spark, sf):
    """The JSON details of a check row."""
    res = evaluate(table(spark, sf, "lineitem"), Rules.accuracy(value_ranges={"l_quantity": (5, 45)}))
    return res.where("NOT is_total").select("column", "details")


# ----------------------------------------------- aggregates, joins, loads
@register("group_agg_list_sum_mean", """
SELECT l_returnflag, SUM(l_quantity) AS l_quantity_sum, AVG(l_quantity) AS l_quantity_mean,
       CAST(SUM(l_linenumber) AS BIGINT) AS l_linenumber_sum
FROM lineitem GROUP BY l_returnflag""")
def group_agg_list_sum_mean(spark, sf):
    return group_aggregate(table(spark, sf, "lineitem"), "l_returnflag",
                           {"l_quantity": ["sum", "mean"], "l_linenumber": ["sum"]})


@register("lookup_fan_out", """
SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey""")
def lookup_fan_out(spark, sf):
    """Repeated lookup keys multiply rows; customers without an order stay."""
    right = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return enrich(table(spark, sf, "customer").select("c_custkey"), [Lookup("orders", right, key="c_custkey")])


@register("lookup_join_large", """
SELECT l_orderkey, l_linenumber, l_partkey, p_retailprice FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""")
def lookup_join_large(spark, sf):
    """Every line item with its part's price: the measured lookup."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    right = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    return enrich(li, [Lookup("part", right, key="l_partkey")])


@register("document_limit_ordered", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""")
def document_limit_ordered(spark, sf):
    """A positive pull limit over an ordered find."""
    path = stage(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), scratch_path(spark, "documents"), "jsonl")
    docs = spark.read.schema("o_orderkey BIGINT, o_totalprice DOUBLE").json(path)
    return find(docs.orderBy(F.col("o_totalprice").desc(), "o_orderkey"), limit=25)


@register("duplicate_key_report", """
SELECT o_custkey, CAST(COUNT(*) AS BIGINT) AS copies FROM orders GROUP BY o_custkey HAVING COUNT(*) > 1""")
def duplicate_key_report(spark, sf):
    return duplicate_keys(table(spark, sf, "orders"), "o_custkey")


@register("conform_varchar", with_views("""
SELECT fiscal_year, fiscal_period, CASE WHEN fiscal_period = 'Q1' THEN 'length:symbol' ELSE '' END AS reject_reason FROM f""",
    f=FINANCIALS_SQL))
def conform_varchar(spark, sf):
    """Symbols longer than VARCHAR(20) are rejects, in the target's column order."""
    f = financials(spark, sf)
    long = F.when(F.col("fiscal_period") == "Q1", F.rpad("symbol", 21, "x")).otherwise(F.col("symbol"))
    good, rejects = conform(f.withColumn("symbol", long), COMPANY_FINANCIALS)
    t = Table(spark, scratch_path(spark, "conform_varchar"), COMPANY_FINANCIALS)
    load(good, t)
    return (t.read().select("fiscal_year", "fiscal_period", F.lit("").alias("reject_reason"))
            .unionAll(rejects.select("fiscal_year", "fiscal_period", "reject_reason")))
