"""Catalogue phase 10: values that folders, files, NaN and ties make hard to keep.

Partition values that are empty or look like numbers, texts that break
delimited records, files with other headers, messages in bounded portions,
NaN as missing, and rows that differ in their NULLs alone, all derived from
the test tables by fixed rules.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finspark.functions.scalar import to_ts
from finspark.operators.aggregate import group_aggregate, resample
from finspark.operators.indicators import stock_analytics, stock_analytics_incremental
from finspark.operators.quality import Rules, evaluate
from finspark.operators.ratios import portfolio_analytics
from finspark.plans.catalogue import register
from finspark.plans.q_quality import OUT, _cons_sql
from finspark.plans.q_streams import EVENT_DDL, _land
from finspark.plans.q_transforms import _ALL_T1 as T1_ALL
from finspark.plans.q_transforms import _T1_SQL as T1_SQL
from finspark.plans.q_transforms import QUOTE_COLS
from finspark.plans.views import POSITIONS_SQL, QUOTES_SQL, cte, positions, quotes, table, with_views
from finspark.session import scratch_path, staged
from finspark.sinks.tables import (Table, delete_where, insert_ignore, load, read_staged, stage, surrogate_key,
                                   truncate_and_load, update_where, upsert)
from finspark.sources.files import read_csv
from finspark.streaming.drain import decode, drain, message_files

# ------------------------------------------------------- partition values
_CODES = {0: "", 1: "01", 2: "1", 3: None, 4: "a/b", 5: "50%", 6: "2024-01-05"}


def _code(number):
    """One of the awkward partition values, by a number."""
    out = F.lit(None).cast("string")
    for k, v in _CODES.items():
        out = F.when(number % 7 == k, F.lit(v).cast("string")).otherwise(out)
    return out


def _code_sql(number: str) -> str:
    cases = " ".join(f"WHEN {k} THEN " + ("NULL" if v is None else f"'{v}'") for k, v in _CODES.items())
    return f"CASE {number} % 7 {cases} END"


def _coded(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return o.withColumn("code", _code(F.col("o_custkey")))


_CODED_SQL = f"SELECT o_orderkey, o_custkey, o_totalprice, {_code_sql('o_custkey')} AS code FROM orders"


def _by_code(spark, sf, name):
    t = Table(spark, scratch_path(spark, name), partition_by="code")
    load(_coded(spark, sf), t)
    return t


@register("replace_empty_partition", f"SELECT * FROM ({_CODED_SQL}) WHERE code = '' OR code = '01' OR code IS NULL")
def replace_empty_partition(spark, sf):
    """Loaded, replaced by a part of the rows, then truncated and loaded: empty, NULL and number-like values stay."""
    o, t = _coded(spark, sf), _by_code(spark, sf, "replace_empty")
    load(o.where("code = '' OR code = 'a/b'"), t, "replace")
    kept = o.where("code = '' OR code = '01' OR code IS NULL")
    assert truncate_and_load(kept, t) == kept.count()
    return t.read()


@register("upsert_empty_partition", f"""
WITH c AS ({_CODED_SQL})
SELECT o_orderkey, o_custkey, CASE WHEN code = '' OR code = '50%' OR code IS NULL THEN o_totalprice * 2 ELSE o_totalprice END
       AS o_totalprice, CASE WHEN code = '50%' THEN '' ELSE code END AS code FROM c""")
def upsert_empty_partition(spark, sf):
    """Rows of the empty and the NULL partition are updated; those of another move into the empty one."""
    o, t = _coded(spark, sf), _by_code(spark, sf, "upsert_empty")
    batch = o.where("code = '' OR code = '50%' OR code IS NULL").withColumns({
        "o_totalprice": F.col("o_totalprice") * 2, "code": F.when(F.col("code") == "50%", F.lit("")).otherwise(F.col("code"))})
    upsert(batch, t, "o_orderkey")
    return t.read()


@register("delete_numeric_text_partition", f"""
WITH c AS ({_CODED_SQL})
SELECT o_orderkey, o_custkey, CASE WHEN code = '2024-01-05' THEN 0 ELSE o_totalprice END AS o_totalprice, code
FROM c WHERE code IS NULL OR code <> '01'""")
def delete_numeric_text_partition(spark, sf):
    """Deletes '01' but not '1'; updates a partition whose value looks like a date."""
    t = _by_code(spark, sf, "delete_numeric")
    assert delete_where(t, "code = '01'") == _coded(spark, sf).where("code = '01'").count()
    update_where(t, {"o_totalprice": F.lit(0.0)}, "code = '2024-01-05'")
    return t.read()


@register("upsert_numeric_text_partition", f"""
SELECT o_orderkey, o_custkey, CASE WHEN code = '01' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, code
FROM ({_CODED_SQL})""")
def upsert_numeric_text_partition(spark, sf):
    """'01' is updated in its own partition; an insert-ignore finds every key where it is."""
    o, t = _coded(spark, sf), _by_code(spark, sf, "upsert_numeric")
    upsert(o.where("code = '01'").withColumn("o_totalprice", F.col("o_totalprice") + 1), t, "o_orderkey")
    assert insert_ignore(o.withColumns({"code": F.lit("03"), "o_totalprice": F.lit(-1.0)}), t, "o_orderkey") == 0
    return t.read()


# ------------------------------------------------------------------- ties
@register("upsert_null_ties", """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE o_orderstatus END AS a,
       CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS b FROM orders""")
def upsert_null_ties(spark, sf):
    """Rows of one key and order value that differ in their NULLs alone: the largest by content wins, always."""
    o = table(spark, sf, "orders")
    t = Table(spark, scratch_path(spark, "upsert_null_ties"))
    none, even = F.lit(None).cast("string"), F.col("o_orderkey") % 2 == 0
    base = o.select("o_orderkey", F.when(even, F.col("o_orderpriority")).otherwise(F.col("o_orderstatus")).alias("a"),
                    F.when(even, F.col("o_orderstatus")).alias("b"), F.lit(1).alias("seq"))
    lesser = base.withColumns({"a": F.when(even, F.col("a")).otherwise(none), "b": F.when(even, none).otherwise(F.col("a"))})
    upsert(lesser.unionByName(base), t, "o_orderkey", order_col="seq")
    return t.read()


# --------------------------------------------------------- staged texts
@register("stage_roundtrip_csv_text", """
SELECT doc_id, text || CASE doc_id % 4 WHEN 0 THEN chr(10) || ' two' WHEN 1 THEN '  ' WHEN 2 THEN '\\N "q",' || chr(13) ELSE '' END
         AS text, CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN '  ' || lang END AS note, n_chars
FROM documents""")
def stage_roundtrip_csv_text(spark, sf):
    """Whole texts with line breaks, quotes, outer spaces, NULL and empty fields, types without a given schema."""
    d, n = table(spark, sf, "documents"), F.col("doc_id")
    tail = (F.when(n % 4 == 0, F.lit("\n two")).when(n % 4 == 1, F.lit("  ")).when(n % 4 == 2, F.lit('\\N "q",\r'))
            .otherwise(F.lit("")))
    note = F.when(n % 3 == 0, F.lit("")).when(n % 3 == 1, F.concat(F.lit("  "), "lang"))
    path = stage(d.select("doc_id", F.concat("text", tail).alias("text"), note.alias("note"), "n_chars"),
                 scratch_path(spark, "stage_text"), "csv")
    return read_staged(spark, path, "csv")


@register("update_partition_column", f"""
SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_orderkey % 4 = 0 THEN '01' ELSE code END AS code FROM ({_CODED_SQL})""")
def update_partition_column(spark, sf):
    """An update of the partition column moves a quarter of all rows to a partition that holds others."""
    t = _by_code(spark, sf, "update_code")
    update_where(t, {"code": "01"}, "o_orderkey % 4 = 0")
    return t.read()


# --------------------------------------------- order columns, types of keys
@register("upsert_order_column", """
SELECT o_orderkey, o_totalprice + CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 0 END AS o_totalprice,
       CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 0 END AS seq FROM orders""")
def upsert_order_column(spark, sf):
    """The order column belongs to the table: existing rows get the order value of the row that wins."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.lit(0).alias("seq"))
    t = Table(spark, scratch_path(spark, "upsert_order_column"))
    load(o, t)
    batch = o.where("o_orderkey % 3 = 0").withColumn("seq", F.explode(F.array(F.lit(2), F.lit(1))))
    upsert(batch.withColumn("o_totalprice", F.col("o_totalprice") + F.col("seq")), t, "o_orderkey", order_col="seq")
    return t.read()


@register("upsert_text_keys", """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice ELSE o_totalprice + 2 END AS o_totalprice FROM orders""")
def upsert_text_keys(spark, sf):
    """Keys that come as texts with and without leading zeros are compared as the table's numbers: half of
    them new, half of those held, each once."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    t = Table(spark, scratch_path(spark, "upsert_text_keys"))
    load(o.where("o_orderkey % 4 < 2"), t)
    both = o.withColumn("seq", F.explode(F.array(F.lit(2), F.lit(1)))).withColumn(
        "o_orderkey", F.concat(F.when(F.col("seq") == 2, "000").otherwise(""), F.col("o_orderkey").cast("string")))
    odd = F.col("o_orderkey").cast("bigint") % 2 == 1
    upsert(both.where(odd).withColumn("o_totalprice", F.col("o_totalprice") + F.col("seq")), t, "o_orderkey", order_col="seq")
    insert_ignore(both.where(~odd), t, "o_orderkey", order_col="seq")
    return t.read()


# ------------------------------------------------------------ CSV folders
@register("csv_partition_folders", """
SELECT o_orderkey, o_totalprice, printf('%02d', o_custkey % 5) AS part FROM orders""")
def csv_partition_folders(spark, sf):
    """Two column orders in partition folders whose names look like numbers: names and values stay."""
    path, o = scratch_path(spark, "csv_parts"), table(spark, sf, "orders")
    o = o.withColumn("part", F.lpad((F.col("o_custkey") % 5).cast("string"), 2, "0"))
    for i, own in enumerate((["o_orderkey", "o_totalprice"], ["o_totalprice", "o_orderkey"])):
        (o.where(F.col("o_orderkey") % 2 == i).select(*own, "part").write.mode("append").partitionBy("part")
         .option("header", True).csv(path))
    return read_csv(spark, path, "o_orderkey BIGINT, o_totalprice DOUBLE, part STRING")


@register("csv_mixed_headers", """
SELECT o_orderkey, o_totalprice, o_orderstatus, CASE WHEN o_orderkey % 4 <> 3 THEN o_orderpriority END AS o_orderpriority
FROM orders""")
def csv_mixed_headers(spark, sf):
    """A folder by several writers: three column orders, and files that lack a column."""
    path, o = scratch_path(spark, "csv_mixed"), table(spark, sf, "orders")
    cols = ["o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority"]
    orders = [cols, cols[::-1], [cols[2], cols[0], cols[3], cols[1]], cols[:3]]
    for i, own in enumerate(orders):
        (o.where(F.col("o_orderkey") % 4 == i).select(*own).write.mode("append")
         .option("header", True).csv(path))
    return read_csv(spark, path, "o_orderkey BIGINT, o_totalprice DOUBLE, o_orderstatus STRING, o_orderpriority STRING")


# ---------------------------------------------------------------- streams
@register("stream_bounded_resume", """
SELECT event_id, user_id, event_type, value, CAST(NULL AS VARCHAR) AS raw_message FROM events""")
def stream_bounded_resume(spark, sf):
    """Bounded drains in turn: each at most a third of the messages, all of them once in the end."""
    ev = table(spark, sf, "events")
    inbox, sink, ckpt = (scratch_path(spark, n) for n in ("inbox", "sink", "ckpt"))
    _land(ev, inbox, corrupt=False)
    stream = decode(message_files(spark, inbox, max_files_per_trigger=1), EVENT_DDL)
    bound = ev.count() // 3 + 1
    while True:
        added = drain(stream, sink, ckpt, max_messages=bound)
        assert added <= bound
        if not added:
            break
    return spark.read.parquet(sink).drop("portion")


# -------------------------------------------------------------------- NaN
def _nan():
    return F.lit(float("nan"))


@register("group_agg_nan", """
WITH l AS (SELECT l_returnflag, CASE WHEN l_linenumber <> 3 THEN l_quantity END AS q FROM lineitem)
SELECT l_returnflag, COALESCE(SUM(q), 0) AS q_sum, round(AVG(q), 6) AS q_mean, MIN(q) AS q_min, MAX(q) AS q_max, COUNT(q) AS q_count,
       round(stddev_samp(q), 6) AS q_std, COUNT(DISTINCT q) AS q_nunique, median(q) AS q_median
FROM l GROUP BY l_returnflag""")
def group_agg_nan(spark, sf):
    """NaN is no value: it is not counted and leaves sums, means and extremes alone."""
    li = table(spark, sf, "lineitem").select("l_returnflag", F.when(F.col("l_linenumber") == 3, _nan()).otherwise(
        F.col("l_quantity")).alias("q"))
    out = group_aggregate(li, "l_returnflag", {"q": ["sum", "mean", "min", "max", "count", "std", "nunique", "median"]})
    return out.withColumns({c: F.round(c, 6) for c in ("q_mean", "q_std")})


@register("group_agg_many_nunique", """
SELECT l_returnflag, l_linestatus, COUNT(DISTINCT l_partkey) AS l_partkey, COUNT(DISTINCT l_suppkey) AS l_suppkey,
       COUNT(DISTINCT CASE WHEN l_quantity > 10 THEN l_shipdate END) AS shipped, SUM(l_linenumber) AS l_linenumber
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def group_agg_many_nunique(spark, sf):
    """Three distinct counts without multiplying a row."""
    li = table(spark, sf, "lineitem").withColumn("shipped", F.when(F.col("l_quantity") > 10, F.col("l_shipdate")))
    return group_aggregate(li, ["l_returnflag", "l_linestatus"], {
        "l_partkey": "nunique", "l_suppkey": "nunique", "shipped": "nunique", "l_linenumber": "sum"})


@register("first_last_null_order", """
SELECT o_custkey, MIN(o_orderpriority) AS o_orderpriority_first, MAX(o_orderpriority) AS o_orderpriority_last
FROM orders GROUP BY o_custkey""")
def first_last_null_order(spark, sf):
    """Without any order value the smallest value is first and the largest last, not NULL."""
    o = table(spark, sf, "orders").withColumn("seq", F.lit(None).cast("bigint"))
    return group_aggregate(o, "o_custkey", {"o_orderpriority": ["first", "last"]}, order_col="seq")


@register("resample_nan", """
WITH o AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS p
           FROM orders)
SELECT last_day(m) AS o_orderdate, round(AVG(p), 6) AS p_mean, round(COALESCE(SUM(p), 0), 4) AS p_sum, MIN(p) AS p_min, MAX(p) AS p_max,
       COUNT(p) AS p_count FROM o GROUP BY m""")
def resample_nan(spark, sf):
    o = table(spark, sf, "orders").select("o_orderdate", F.when(F.col("o_orderkey") % 3 == 0, _nan()).otherwise(
        F.col("o_totalprice")).alias("p"))
    out = resample(o, "o_orderdate", "M", ["p"])
    return out.withColumns({"p_mean": F.round("p_mean", 6), "p_sum": F.round("p_sum", 4)})


# whole prices: their sums are exact, so averages don't depend on the order of a sum
_NAN_QUOTES = ("SELECT * REPLACE (CASE WHEN day(trade_date) % 5 <> 0 THEN CAST(floor(close_price) AS DOUBLE) END AS close_price) "
               f"FROM ({QUOTES_SQL})")


def _nan_quotes(spark, sf):
    return quotes(spark, sf).withColumn("close_price", F.when(F.dayofmonth("trade_date") % 5 == 0, _nan()).otherwise(
        F.floor("close_price").cast("double")))


def _analytics_columns(out):
    return out.select(*QUOTE_COLS, F.round("daily_return", 9).alias("daily_return"), *[F.round(c, 6).alias(c) for c in (
        "moving_avg_20d", "moving_avg_50d", "moving_avg_200d", "volatility_20d", "rsi_14d")])


_ANALYTICS = T1_ALL.replace("daily_return, ", "round(daily_return, 9) AS daily_return, ", 1)


@register("stock_analytics_nan", cte(quotes=_NAN_QUOTES) + ",\n" + T1_SQL.strip() + "\n" + _ANALYTICS)
def stock_analytics_nan(spark, sf):
    """A NaN price is a missing price, in plain windows and across block borders alike."""
    q = _nan_quotes(spark, sf)
    return _analytics_columns(stock_analytics(q, rows_per_block=250))


@register("stock_analytics_incremental", cte(quotes=_NAN_QUOTES) + ",\n" + T1_SQL.strip() + "\n" + _ANALYTICS)
def q_stock_analytics_incremental(spark, sf):
    """A year at a time, each from the state the year before left, equals the whole history at once."""
    q = staged(_nan_quotes(spark, sf), "quotes")
    state, out = Table(spark, scratch_path(spark, "t1_state")), []
    for r in q.select(F.year("trade_date").alias("y")).distinct().orderBy("y").collect():
        out.append(stock_analytics_incremental(q.where(F.year("trade_date") == r["y"]), state, str(r["y"])))
    return _analytics_columns(reduce(DataFrame.unionByName, out))


@register("portfolio_nan", with_views("""
SELECT portfolio_id, symbol, position_date, round(quantity * current_price, 6) AS market_value,
       round(quantity * current_price / NULLIF(SUM(quantity * current_price) OVER (PARTITION BY portfolio_id, position_date), 0), 9)
         AS weight
FROM (SELECT * REPLACE (CASE WHEN day(position_date) % 4 <> 0 THEN current_price END AS current_price) FROM positions)""",
    positions=POSITIONS_SQL))
def portfolio_nan(spark, sf):
    """A position without a price has no weight; the others share the total of those that have one."""
    p = positions(spark, sf).withColumn("current_price", F.when(F.dayofmonth("position_date") % 4 == 0, _nan()).otherwise(
        F.col("current_price")))
    return portfolio_analytics(p).select("portfolio_id", "symbol", "position_date",
                                         F.round("market_value", 6).alias("market_value"), F.round("weight", 9).alias("weight"))


# ------------------------------------------------- keys, ids, dates
_UNIQUE = {"l_orderkey": ["l_orderkey"], "l_partkey": ["l_partkey"], "l_orderkey,l_linenumber": ["l_orderkey", "l_linenumber"],
           "l_shipdate,l_suppkey": ["l_shipdate", "l_suppkey"], "flag": ["flag"]}


@register("uniqueness_many", _cons_sql([
    ("uniqueness", name, f"COUNT(*) - COUNT(DISTINCT ({', '.join(cols)},)) " if len(cols) > 1 else
     f"COUNT(*) - COUNT(DISTINCT {cols[0]}) - CAST(COUNT_IF({cols[0]} IS NULL) > 0 AS BIGINT)") for name, cols in _UNIQUE.items()],
    "SELECT *, CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS flag FROM lineitem"))
def uniqueness_many(spark, sf):
    """Five unique keys, two of them composite and one with NULLs, in one scan of their own."""
    li = table(spark, sf, "lineitem").withColumn("flag", F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")))
    return evaluate(li, Rules.consistency(unique_columns=[c if len(c) > 1 else c[0] for c in _UNIQUE.values()])).select(*OUT)


@register("surrogate_key_ties", """
SELECT row_number() OVER (ORDER BY l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id, l_returnflag
FROM lineitem""")
def surrogate_key_ties(spark, sf):
    """One order value on a third of lineitem: it spans partitions, and ids have no gap or repeat."""
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return surrogate_key(li, "l_returnflag", "id", rows_per_partition=5000).select("id", "l_returnflag")


@register("to_timestamp_two_digit_year", """
SELECT o_orderkey, CAST(CAST(CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate ELSE o_orderdate - INTERVAL 20 YEAR END AS DATE) AS TIMESTAMP) AS at
FROM orders""")
def to_timestamp_two_digit_year(spark, sf):
    """69 to 99 are years of the twentieth century."""
    day = F.when(F.col("o_orderkey") % 2 == 0, F.to_date("o_orderdate")).otherwise(F.add_months(F.to_date("o_orderdate"), -240))
    o = table(spark, sf, "orders").withColumn("text", F.date_format(day, "dd/MM/yy"))
    return o.select("o_orderkey", to_ts("text", "%d/%m/%y").cast("timestamp_ntz").alias("at"))
