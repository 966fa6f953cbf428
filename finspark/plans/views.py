"""Derived views over the driver's test tables.

The test tables are TPC-H-like; the reference works on quotes, statements and
portfolio positions.  These views derive such frames from the given tables
with plain aggregations, so every query's work grows with the input.
Money sums go through DECIMAL(18,4) so they are exact and order-free.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _money_sum(c) -> F.Column:
    return F.sum(F.col(c).cast("decimal(18,4)")).cast("double")


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily quotes per supplier: one row per (symbol, trade_date)."""
    li = table(spark, sf_dir, "lineitem")
    unit = F.try_divide(F.col("l_extendedprice"), F.nullif(F.col("l_quantity"), F.lit(0.0)))
    return (li.groupBy(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"),
                       F.to_date("l_shipdate").alias("trade_date"))
            .agg(((F.max(unit) + F.min(unit)) / 2).alias("open_price"),
                 F.max(unit).alias("high_price"),
                 F.min(unit).alias("low_price"),
                 F.try_divide(_money_sum("l_extendedprice"), F.sum("l_quantity")).alias("close_price"),
                 F.sum("l_quantity").cast("bigint").alias("volume")))


QUOTES_SQL = """
SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol,
       CAST(l_shipdate AS DATE) AS trade_date,
       (MAX(l_extendedprice / NULLIF(l_quantity, 0)) + MIN(l_extendedprice / NULLIF(l_quantity, 0))) / 2
         AS open_price,
       MAX(l_extendedprice / NULLIF(l_quantity, 0)) AS high_price,
       MIN(l_extendedprice / NULLIF(l_quantity, 0)) AS low_price,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) / SUM(l_quantity) AS close_price,
       CAST(SUM(l_quantity) AS BIGINT) AS volume
FROM lineitem
GROUP BY 1, 2
"""


def financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarterly statements per supplier."""
    li = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    margin = F.col("l_discount").cast("decimal(18,2)") - F.col("l_tax").cast("decimal(18,2)")
    revenue = F.sum(price).cast("double")
    liab = F.coalesce(F.sum(F.when(F.col("l_returnflag") == "R", price)), F.lit(0)).cast("double")
    return (li.groupBy(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"),
                       F.concat(F.lit("Q"), F.quarter("l_shipdate").cast("string")).alias("fiscal_period"),
                       F.year("l_shipdate").alias("fiscal_year"))
            .agg(revenue.alias("revenue"),
                 F.sum(price * margin).cast("double").alias("net_income"),
                 (revenue * 2).alias("total_assets"),
                 liab.alias("total_liabilities"),
                 (revenue * 2 - liab).alias("shareholders_equity")))


FINANCIALS_SQL = """
SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol,
       'Q' || CAST(quarter(l_shipdate) AS VARCHAR) AS fiscal_period,
       CAST(year(l_shipdate) AS INTEGER) AS fiscal_year,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))
                * (CAST(l_discount AS DECIMAL(18,2)) - CAST(l_tax AS DECIMAL(18,2)))) AS DOUBLE) AS net_income,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) * 2 AS total_assets,
       CAST(COALESCE(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END), 0) AS DOUBLE)
         AS total_liabilities,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) * 2
         - CAST(COALESCE(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END), 0) AS DOUBLE)
         AS shareholders_equity
FROM lineitem
GROUP BY 1, 2, 3
"""


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly portfolio positions: customer = portfolio, part = instrument."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
         .join(p, li.l_partkey == p.p_partkey))
    qty = F.sum("l_quantity")
    return (j.groupBy(F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("portfolio_id"),
                      F.concat(F.lit("S"), F.col("l_partkey").cast("string")).alias("symbol"),
                      F.trunc("o_orderdate", "month").alias("position_date"))
            .agg(qty.alias("quantity"),
                 F.try_divide(_money_sum("l_extendedprice"), qty).alias("avg_cost"),
                 F.max("p_retailprice").alias("current_price")))


POSITIONS_SQL = """
SELECT 'P' || CAST(o_custkey AS VARCHAR) AS portfolio_id,
       'S' || CAST(l_partkey AS VARCHAR) AS symbol,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS position_date,
       SUM(l_quantity) AS quantity,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) / SUM(l_quantity) AS avg_cost,
       MAX(p_retailprice) AS current_price
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
GROUP BY 1, 2, 3
"""


def cte(**views: str) -> str:
    """``WITH a AS (...), b AS (...)`` for the named derived views (no final query)."""
    return "WITH " + ",\n".join(f"{n} AS ({body.strip()})" for n, body in views.items())


def with_views(sql: str, **views: str) -> str:
    """Prefix an oracle query with WITH clauses for the named derived views."""
    return cte(**views) + "\n" + sql.strip()
