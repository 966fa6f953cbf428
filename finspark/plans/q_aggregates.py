"""Catalogue phase 3: group-by aggregation and calendar-bucket resampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from finspark.operators.aggregate import group_aggregate, resample
from finspark.plans.catalogue import register
from finspark.plans.views import table


@register("group_agg_single", """
SELECT l_returnflag, l_linestatus,
       COALESCE(SUM(l_quantity), 0) AS l_quantity, MAX(l_extendedprice) AS l_extendedprice,
       MIN(l_discount) AS l_discount, COUNT(l_orderkey) AS l_orderkey
FROM lineitem WHERE l_returnflag IS NOT NULL AND l_linestatus IS NOT NULL
GROUP BY l_returnflag, l_linestatus""")
def group_agg_single(spark, sf):
    li = table(spark, sf, "lineitem")
    return group_aggregate(li, ["l_returnflag", "l_linestatus"], {
        "l_quantity": "sum", "l_extendedprice": "max", "l_discount": "min", "l_orderkey": "count"})


@register("group_agg_multi", """
SELECT o_orderstatus, o_orderpriority,
       MIN(o_totalprice) AS o_totalprice_min, MAX(o_totalprice) AS o_totalprice_max,
       COUNT(o_totalprice) AS o_totalprice_count,
       COUNT(DISTINCT o_custkey) AS o_custkey_nunique, COUNT(*) AS o_custkey_size
FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL
GROUP BY o_orderstatus, o_orderpriority""")
def group_agg_multi(spark, sf):
    o = table(spark, sf, "orders")
    return group_aggregate(o, ["o_orderstatus", "o_orderpriority"], {
        "o_totalprice": ["min", "max", "count"], "o_custkey": ["nunique", "size"]})


@register("group_agg_nunique_median_std", """
SELECT l_suppkey,
       COUNT(DISTINCT l_partkey) AS l_partkey_nunique,
       MEDIAN(l_quantity) AS l_quantity_median,
       ROUND(STDDEV_SAMP(l_quantity), 6) AS l_quantity_std,
       ROUND(VAR_SAMP(l_quantity), 6) AS l_quantity_var
FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY l_suppkey""")
def group_agg_nunique_median_std(spark, sf):
    li = table(spark, sf, "lineitem")
    out = group_aggregate(li, "l_suppkey", {"l_partkey": ["nunique"],
                                           "l_quantity": ["median", "std", "var"]})
    return out.withColumns({c: F.round(c, 6) for c in ("l_quantity_std", "l_quantity_var")})


@register("group_agg_median_hot_groups", """
SELECT l_returnflag,
       ROUND(MEDIAN(l_extendedprice), 6) AS l_extendedprice,
       MEDIAN(l_quantity) AS l_quantity
FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag""")
def group_agg_median_hot_groups(spark, sf):
    """Exact medians over three groups of about a third of lineitem each:
    every group spans many range partitions, none is ranked in one task."""
    li = table(spark, sf, "lineitem")
    out = group_aggregate(li, "l_returnflag", {"l_extendedprice": "median", "l_quantity": "median"})
    return out.withColumn("l_extendedprice", F.round("l_extendedprice", 6))


@register("group_agg_first_last", """
SELECT o_custkey,
       arg_min(o_totalprice, o_orderkey) FILTER (WHERE o_totalprice IS NOT NULL) AS o_totalprice_first,
       arg_max(o_totalprice, o_orderkey) FILTER (WHERE o_totalprice IS NOT NULL) AS o_totalprice_last,
       arg_min(o_orderstatus, o_orderkey) FILTER (WHERE o_orderstatus IS NOT NULL) AS o_orderstatus_first
FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey""")
def group_agg_first_last(spark, sf):
    o = table(spark, sf, "orders")
    return group_aggregate(o, "o_custkey", {"o_totalprice": ["first", "last"],
                                           "o_orderstatus": ["first"]}, order_col="o_orderkey")


@register("group_agg_prod_sem_skew", """
SELECT l_orderkey,
       COALESCE(PRODUCT(l_quantity), 1) AS l_quantity_prod,
       ROUND(STDDEV_SAMP(l_quantity) / SQRT(COUNT(l_quantity)), 6) AS l_quantity_sem,
       ROUND(CASE WHEN COUNT(l_extendedprice) < 3 THEN NULL
                  WHEN VAR_POP(l_extendedprice) = 0 THEN 0.0
                  ELSE SKEWNESS(l_extendedprice) END, 6) AS l_extendedprice_skew
FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey""")
def group_agg_prod_sem_skew(spark, sf):
    li = table(spark, sf, "lineitem")
    out = group_aggregate(li, "l_orderkey", {"l_quantity": ["prod", "sem"],
                                            "l_extendedprice": ["skew"]}, sort=False)
    return out.withColumns({c: F.round(c, 6) for c in ("l_quantity_sem", "l_extendedprice_skew")})


# DuckDB forms of the bucket start / label per frequency.
_DUCK_BUCKET = {
    "D": ("CAST(date_trunc('day', {c}) AS DATE)", "INTERVAL 1 DAY", "s"),
    "W": ("CAST(date_trunc('week', {c}) AS DATE)", "INTERVAL 7 DAY", "CAST(s + INTERVAL 6 DAY AS DATE)"),
    "M": ("CAST(date_trunc('month', {c}) AS DATE)", "INTERVAL 1 MONTH", "last_day(s)"),
    "Q": ("CAST(date_trunc('quarter', {c}) AS DATE)", "INTERVAL 3 MONTH",
          "last_day(CAST(s + INTERVAL 2 MONTH AS DATE))"),
    "Y": ("CAST(date_trunc('year', {c}) AS DATE)", "INTERVAL 1 YEAR", "make_date(year(s), 12, 31)"),
}


def _resample_sql(src: str, date_col: str, value: str, freq: str) -> str:
    start, step, label = _DUCK_BUCKET[freq]
    v = value
    return f"""
WITH d AS (SELECT {start.format(c=date_col)} AS s, CAST({v} AS DECIMAL(18,2)) AS v
           FROM ({src}) WHERE {date_col} IS NOT NULL),
g AS (SELECT s, SUM(v) AS sm, MIN(v) AS mn, MAX(v) AS mx, COUNT(v) AS n FROM d GROUP BY s),
cal AS (SELECT CAST(unnest(generate_series(MIN(s), MAX(s), {step})) AS DATE) AS s FROM g)
SELECT {label} AS {date_col},
       CAST(g.sm AS DOUBLE) / NULLIF(g.n, 0) AS {v}_mean,
       CAST(COALESCE(g.sm, 0) AS DOUBLE) AS {v}_sum,
       CAST(g.mn AS DOUBLE) AS {v}_min, CAST(g.mx AS DOUBLE) AS {v}_max,
       COALESCE(g.n, 0) AS {v}_count
FROM cal LEFT JOIN g USING (s)"""


def _money(df, c):
    return df.withColumn(c, F.col(c).cast("decimal(18,2)"))


def _events(spark, sf):
    return _money(table(spark, sf, "events").select("ts", "value"), "value")


def _orders(spark, sf):
    return _money(table(spark, sf, "orders").select("o_orderdate", "o_totalprice"), "o_totalprice")


@register("resample_day", _resample_sql("SELECT ts, value FROM events", "ts", "value", "D"))
def resample_day(spark, sf):
    return resample(_events(spark, sf), "ts", "D")


@register("resample_week", _resample_sql("SELECT o_orderdate, o_totalprice FROM orders",
                                         "o_orderdate", "o_totalprice", "W"))
def resample_week(spark, sf):
    return resample(_orders(spark, sf), "o_orderdate", "W")


@register("resample_month", _resample_sql("SELECT o_orderdate, o_totalprice FROM orders",
                                          "o_orderdate", "o_totalprice", "M"))
def resample_month(spark, sf):
    return resample(_orders(spark, sf), "o_orderdate", "M")


@register("resample_quarter", _resample_sql("SELECT o_orderdate, o_totalprice FROM orders",
                                            "o_orderdate", "o_totalprice", "Q"))
def resample_quarter(spark, sf):
    return resample(_orders(spark, sf), "o_orderdate", "Q")


@register("resample_year", _resample_sql("SELECT o_orderdate, o_totalprice FROM orders",
                                         "o_orderdate", "o_totalprice", "Y"))
def resample_year(spark, sf):
    return resample(_orders(spark, sf), "o_orderdate", "Y")


@register("resample_gap_fill", _resample_sql(
    "SELECT o_orderdate, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'",
    "o_orderdate", "o_totalprice", "D"))
def resample_gap_fill(spark, sf):
    """Daily totals of urgent orders: many days have none and are filled."""
    o = table(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    return resample(_money(o.select("o_orderdate", "o_totalprice"), "o_totalprice"), "o_orderdate", "D")
