"""Catalogue phase 6: sources and payload normalizers.

Each query lands a file derived from the test tables (CSV with NA tokens,
JSON lines, arrays of records, XML, landed API responses), reads it back with
the library's readers and returns the rows; the oracle is SQL on the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from finspark.functions.scalar import QUOTE_RENAME, canonical_names
from finspark.operators.aggregate import Mergeable, SparkAggregate, group_aggregate
from finspark.plans.catalogue import register
from finspark.plans.views import QUOTES_SQL, quotes, table, with_views
from finspark.session import scratch_path
from finspark.sources.documents import find, warehouse_sql
from finspark.sources.files import read_csv, read_json, read_landed, read_xml
from finspark.sources.payloads import (explode_daily_series, explode_object_or_array, first_list_rows,
                                       stack_by_name)
from finspark.sinks.tables import stage

ORDERS_DDL = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING")


def _orders(spark, sf):
    return table(spark, sf, "orders")


# Landed responses group orders per (customer, month) and range of order keys,
# which are unique: a response holds at most so many orders, however busy the
# customer-month is.
RESPONSE_KEYS = 4096


def _response_keys():
    return ["o_custkey", F.trunc("o_orderdate", "month"), F.floor(F.col("o_orderkey") / RESPONSE_KEYS)]


@register("csv_scan", """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS o_totalprice,
       o_orderdate,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders""")
def csv_scan(spark, sf):
    """Landed CSV (';' separated) whose text holds NA tokens: 'N/A' in a
    numeric column and 'NA' / 'null' in a text column read back as NULL."""
    o = _orders(spark, sf)
    landed = o.select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.when(F.col("o_orderstatus") == "P", F.lit("N/A"))
        .otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"),
        F.when(F.col("o_orderpriority") == "5-LOW",
               F.when(F.col("o_custkey") > F.col("o_orderkey"), F.lit("NA")).otherwise(F.lit("null")))
        .otherwise(F.col("o_orderpriority")).alias("o_orderpriority"))
    path = scratch_path(spark, "landed_csv")
    landed.write.option("header", True).option("sep", ";").csv(path)
    return read_csv(spark, path, schema=ORDERS_DDL, sep=";")


@register("json_lines_scan", "SELECT * FROM orders")
def json_lines_scan(spark, sf):
    path = stage(_orders(spark, sf), scratch_path(spark, "landed_jsonl"), "jsonl")
    return read_json(spark, path, lines=True, schema=ORDERS_DDL)


@register("json_array_scan", "SELECT * FROM orders")
def json_array_scan(spark, sf):
    """Landed arrays of records: one array per (customer, month) response."""
    o = _orders(spark, sf)
    arrays = (o.groupBy(*_response_keys())
              .agg(F.to_json(F.collect_list(F.struct(*o.columns))).alias("value")))
    path = scratch_path(spark, "landed_json_arrays")
    arrays.select("value").write.text(path)
    return read_json(spark, path, lines=True, schema=ORDERS_DDL)


@register("parquet_column_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 200000")
def parquet_column_scan(spark, sf):
    """S3 with a column list and a filter: both reach the Parquet scan."""
    df = read_landed(spark, f"{sf.rstrip('/')}/orders.parquet", "parquet",
                     columns=["o_orderkey", "o_totalprice"])
    return df.where(F.col("o_totalprice") > 200000)


@register("xml_scan", """
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice, o_orderpriority
FROM orders""")
def xml_scan(spark, sf):
    """Landed XML: <order o_orderkey=".."> attributes, child tags, and an
    attribute clashing with a child tag (the attribute wins where present)."""
    o = _orders(spark, sf)
    landed = o.select(
        F.col("o_orderkey").alias("_o_orderkey"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("X")).alias("_o_orderstatus"),
        "o_orderstatus", "o_totalprice", "o_orderpriority")
    path = scratch_path(spark, "landed_xml")
    landed.write.format("xml").option("rowTag", "order").option("rootTag", "orders").save(path)
    schema = ("_o_orderkey BIGINT, _o_orderstatus STRING, o_orderstatus STRING, "
              "o_totalprice DOUBLE, o_orderpriority STRING")
    df = read_xml(spark, path, xpath="./orders/order", schema=schema)
    return df.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


def _documents(spark, sf):
    """Orders exported as JSON-lines documents with a {"$oid": ..} id."""
    o = _orders(spark, sf)
    docs = o.select(F.struct(F.concat(F.lit("oid"), F.col("o_orderkey").cast("string")).alias("$oid"))
                    .alias("_id"), *o.columns)
    path = stage(docs, scratch_path(spark, "documents"), "jsonl")
    return read_json(spark, path, lines=True, schema="_id STRUCT<`$oid`: STRING>, " + ORDERS_DDL)


@register("document_filter_project_limit", """
SELECT 'oid' || CAST(o_orderkey AS VARCHAR) AS _id, o_orderkey, o_totalprice
FROM orders WHERE o_orderstatus = 'F'""")
def document_filter_project_limit(spark, sf):
    return find(_documents(spark, sf), {"o_orderstatus": "F"},
                {"o_orderkey": 1, "o_totalprice": 1}, limit=0)


@register("document_group_stages", """
SELECT o_orderpriority, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
       COUNT(*) AS n
FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderpriority""")
def document_group_stages(spark, sf):
    """$match -> $group -> $sort -> $project written as DataFrame calls."""
    d = _documents(spark, sf)
    return (d.where(F.col("o_orderstatus") == "F")
            .groupBy("o_orderpriority")
            .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"),
                 F.count(F.lit(1)).alias("n"))
            .orderBy("o_orderpriority")
            .select("o_orderpriority", "total", "n"))


@register("warehouse_sql_params", """
SELECT o_orderpriority, COUNT(*) AS n FROM orders
WHERE o_orderstatus = 'O' AND o_totalprice > 100000 GROUP BY o_orderpriority""")
def warehouse_sql_params(spark, sf):
    """SQL with named parameter markers over a registered table."""
    _orders(spark, sf).createOrReplaceTempView("orders_wh")
    return warehouse_sql(spark, """
        SELECT o_orderpriority, COUNT(*) AS n FROM orders_wh
        WHERE o_orderstatus = :status AND o_totalprice > :min_total GROUP BY o_orderpriority""",
                         {"status": "O", "min_total": 100000})


@register("timeseries_payload", with_views("""
SELECT symbol, trade_date AS date, open_price AS open, high_price AS high, low_price AS low,
       close_price AS close, volume FROM quotes""", quotes=QUOTES_SQL))
def timeseries_payload(spark, sf):
    """N1 over landed daily-series responses, one response per (symbol, month)."""
    q = quotes(spark, sf)
    entry = F.create_map(
        F.lit("1. open"), F.col("open_price").cast("string"), F.lit("2. high"), F.col("high_price").cast("string"),
        F.lit("3. low"), F.col("low_price").cast("string"), F.lit("4. close"), F.col("close_price").cast("string"),
        F.lit("5. volume"), F.col("volume").cast("string"))
    landed = (q.groupBy("symbol", F.trunc("trade_date", "month").alias("m"))
              .agg(F.map_from_entries(F.collect_list(F.struct(F.col("trade_date").cast("string"), entry)))
                   .alias("series"))
              .select(F.col("symbol").alias("request_symbol"),
                      F.to_json(F.struct(F.col("series").alias("Time Series (Daily)"))).alias("payload")))
    return explode_daily_series(landed)


@register("object_or_array_payload", """
SELECT 'C' || CAST(o_custkey AS VARCHAR) AS symbol, o_orderkey, o_totalprice, o_orderstatus FROM orders""")
def object_or_array_payload(spark, sf):
    """A response per (customer, month) is an object for one order, an array otherwise."""
    o = _orders(spark, sf)
    item = F.struct("o_orderkey", "o_totalprice", "o_orderstatus")
    landed = (o.groupBy(*_response_keys())
              .agg(F.collect_list(item).alias("items"))
              .select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("request_symbol"),
                      F.when(F.size("items") == 1, F.to_json(F.col("items")[0]))
                      .otherwise(F.to_json("items")).alias("payload")))
    return explode_object_or_array(
        landed, "o_orderkey BIGINT, o_totalprice DOUBLE, o_orderstatus STRING")


@register("first_list_flatten", """
SELECT o_orderkey, o_totalprice AS "price.total", 'USD' AS "price.currency",
       o_orderstatus AS "status.code", [o_orderpriority] AS tags
FROM orders""")
def first_list_flatten(spark, sf):
    """Graph-style results {customer, orders: [{.., price: {total, currency}}]}."""
    o = _orders(spark, sf)
    item = F.struct("o_orderkey",
                    F.struct(F.col("o_totalprice").alias("total"), F.lit("USD").alias("currency")).alias("price"),
                    F.struct(F.col("o_orderstatus").alias("code")).alias("status"),
                    F.array("o_orderpriority").alias("tags"))
    landed = (o.groupBy(*_response_keys())
              .agg(F.to_json(F.struct(F.col("o_custkey").alias("customer"),
                                      F.collect_list(item).alias("orders"))).alias("payload")))
    schema = ("customer BIGINT, orders ARRAY<STRUCT<o_orderkey: BIGINT, price: STRUCT<total: DOUBLE, "
              "currency: STRING>, status: STRUCT<code: STRING>, tags: ARRAY<STRING>>>")
    return first_list_rows(landed, schema)


@register("stack_by_name", """
SELECT o_orderkey AS trade_date, o_totalprice AS close_price, o_orderstatus AS symbol,
       CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS note
FROM orders""")
def q_stack_by_name(spark, sf):
    """Per-source frames with raw names, canonicalized and stacked by name."""
    o = _orders(spark, sf)
    a = o.where(F.col("o_orderstatus") == "F").select(
        F.col("o_orderstatus").alias("Symbol"), F.col("o_orderkey").alias("Date"),
        F.col("o_totalprice").alias("Close"), F.col("o_orderpriority").alias("Note"))
    b = o.where(F.col("o_orderstatus") != "F").select(
        F.col("o_totalprice").alias("Close"), F.col("o_orderkey").alias("Date"),
        F.col("o_orderstatus").alias("Symbol"))
    frames = [canonical_names(f, {**QUOTE_RENAME, "close": "close_price"}) for f in (a, b)]
    return stack_by_name(frames)


@register("group_agg_callable", """
SELECT l_returnflag, MAX(l_quantity) - MIN(l_quantity) AS l_quantity
FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag""")
def group_agg_callable(spark, sf):
    """A11/UD3: a pandas user aggregate over three groups of about a third of
    the table each, as a ``Mergeable``: partials (max, min) per chunk of an
    input partition, merged per group, so no task holds a whole group."""
    spread = Mergeable(lambda s: (s.max(), s.min()),
                       lambda maxes, mins: maxes.max() - mins.min(), width=2, name="spread")
    return group_aggregate(table(spark, sf, "lineitem"), "l_returnflag", {"l_quantity": spread})


@register("group_agg_spark_callable", """
SELECT l_returnflag, MAX(l_quantity) - MIN(l_quantity) AS l_quantity
FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag""")
def group_agg_spark_callable(spark, sf):
    """A11/UD3: the same user aggregate written with Spark functions; Catalyst
    aggregates it partially before the shuffle."""
    spread = SparkAggregate(lambda c: F.max(c) - F.min(c), "spread")
    return group_aggregate(table(spark, sf, "lineitem"), "l_returnflag", {"l_quantity": spread})



@register("quote_payload", """
SELECT 'C' || CAST(o_custkey AS VARCHAR) AS symbol, TIMESTAMP '2024-01-02 16:00:00' AS timestamp,
       o_orderkey AS id, o_totalprice AS price, o_orderstatus AS status
FROM orders""")
def quote_payload(spark, sf):
    """One flat quote object per response, symbol and one fetch time stamped."""
    import datetime as dt

    from finspark.sources.payloads import parse_quote
    o = _orders(spark, sf)
    landed = o.select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("request_symbol"),
                      F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"),
                                         F.col("o_orderstatus").alias("status"))).alias("payload"))
    return parse_quote(landed, "id BIGINT, price DOUBLE, status STRING", run_ts=dt.datetime(2024, 1, 2, 16))


@register("sheet_range_scan", """
SELECT o_orderkey AS "Order", o_orderpriority AS "Priority", o_totalprice AS "Total" FROM orders""")
def sheet_range_scan(spark, sf):
    """A sheet range exported as CSV; the first row is the header."""
    from finspark.sources.files import read_sheet_range
    o = _orders(spark, sf)
    path = scratch_path(spark, "sheet_range")
    (o.select(F.col("o_orderkey").alias("Order"), F.col("o_orderpriority").alias("Priority"),
              F.col("o_totalprice").alias("Total"))
     .write.option("header", True).csv(path))
    return read_sheet_range(spark, path, schema='`Order` BIGINT, Priority STRING, Total DOUBLE')
