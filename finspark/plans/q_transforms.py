"""Catalogue phases 1-2: indicators (T1) and transforms."""

from __future__ import annotations

from pyspark.sql import functions as F

from finspark.operators.indicators import stock_analytics
from finspark.plans.catalogue import register
from finspark.plans.views import QUOTES_SQL, cte, quotes

QUOTE_COLS = ["symbol", "trade_date", "open_price", "high_price", "low_price",
              "close_price", "volume"]


def _r6(c):
    return F.round(F.col(c), 6).alias(c)


def _analytics(spark, sf):
    return stock_analytics(quotes(spark, sf))


# Oracle form of T1: same window semantics written in DuckDB SQL.
_T1_SQL = """
b AS (
  SELECT *,
         last_value(close_price IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY trade_date
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ff,
         close_price - lag(close_price) OVER (PARTITION BY symbol ORDER BY trade_date) AS d
  FROM quotes),
c AS (
  SELECT *,
         ff / NULLIF(lag(ff) OVER (PARTITION BY symbol ORDER BY trade_date), 0) - 1 AS daily_return,
         CASE WHEN d > 0 THEN d ELSE 0 END AS gain,
         CASE WHEN d < 0 THEN -d ELSE 0 END AS loss
  FROM b),
t1 AS (
  SELECT symbol, trade_date, open_price, high_price, low_price, close_price, volume, daily_return,
    avg(close_price) OVER (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)
      AS moving_avg_20d,
    avg(close_price) OVER (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)
      AS moving_avg_50d,
    avg(close_price) OVER (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 199 PRECEDING AND CURRENT ROW)
      AS moving_avg_200d,
    stddev_samp(daily_return) OVER (PARTITION BY symbol ORDER BY trade_date
      ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS volatility_20d,
    CASE WHEN count(*) OVER r14 >= 14 THEN
      CASE WHEN avg(loss) OVER r14 = 0 THEN CASE WHEN avg(gain) OVER r14 > 0 THEN 100.0 END
           ELSE 100.0 - 100.0 / (1.0 + avg(gain) OVER r14 / avg(loss) OVER r14) END
    END AS rsi_14d
  FROM c
  WINDOW r14 AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW))
"""


def _t1_sql(select: str) -> str:
    return cte(quotes=QUOTES_SQL) + ",\n" + _T1_SQL.strip() + "\n" + select.strip()


@register("daily_return", _t1_sql("SELECT symbol, trade_date, close_price, daily_return FROM t1"))
def daily_return(spark, sf):
    return _analytics(spark, sf).select("symbol", "trade_date", "close_price", "daily_return")


@register("moving_averages", _t1_sql(
    "SELECT symbol, trade_date, round(moving_avg_20d, 6) AS moving_avg_20d, "
    "round(moving_avg_50d, 6) AS moving_avg_50d, round(moving_avg_200d, 6) AS moving_avg_200d FROM t1"))
def moving_averages(spark, sf):
    return _analytics(spark, sf).select("symbol", "trade_date", _r6("moving_avg_20d"),
                                        _r6("moving_avg_50d"), _r6("moving_avg_200d"))


@register("volatility_20d", _t1_sql(
    "SELECT symbol, trade_date, round(volatility_20d, 6) AS volatility_20d FROM t1"))
def volatility_20d(spark, sf):
    return _analytics(spark, sf).select("symbol", "trade_date", _r6("volatility_20d"))


@register("rsi_14d", _t1_sql("SELECT symbol, trade_date, round(rsi_14d, 6) AS rsi_14d FROM t1"))
def rsi_14d(spark, sf):
    return _analytics(spark, sf).select("symbol", "trade_date", _r6("rsi_14d"))


_ALL_T1 = ("SELECT symbol, trade_date, open_price, high_price, low_price, close_price, volume, "
           "daily_return, round(moving_avg_20d, 6) AS moving_avg_20d, "
           "round(moving_avg_50d, 6) AS moving_avg_50d, round(moving_avg_200d, 6) AS moving_avg_200d, "
           "round(volatility_20d, 6) AS volatility_20d, round(rsi_14d, 6) AS rsi_14d FROM t1")


def stock_analytics_query(spark, sf, rows_per_block="default"):
    q = quotes(spark, sf)
    out = stock_analytics(q) if rows_per_block == "default" else stock_analytics(
        q, rows_per_block=rows_per_block)
    return out.select(*QUOTE_COLS, "daily_return", _r6("moving_avg_20d"), _r6("moving_avg_50d"),
                      _r6("moving_avg_200d"), _r6("volatility_20d"), _r6("rsi_14d"))


register("stock_analytics", _t1_sql(_ALL_T1))(stock_analytics_query)


@register("stock_analytics_small_blocks", _t1_sql(_ALL_T1))
def stock_analytics_small_blocks(spark, sf):
    """T1 with tiny blocks so that nearly every row sits near a block border:
    exercises the halo path on the whole table."""
    return stock_analytics_query(spark, sf, rows_per_block=250)


# ---------------------------------------------------------------- phase 2
from finspark.functions.scalar import enrich_with_metadata  # noqa: E402
from finspark.operators.enrich import Lookup, enrich  # noqa: E402
from finspark.operators.ratios import RATIO_COLUMNS, financial_ratios, portfolio_analytics  # noqa: E402
from finspark.plans.views import (FINANCIALS_SQL, POSITIONS_SQL, financials,  # noqa: E402
                                  positions, table, with_views)


@register("financial_ratios", with_views("""
SELECT symbol, fiscal_period, fiscal_year,
       total_liabilities / NULLIF(shareholders_equity, 0) AS debt_to_equity,
       (total_assets * 0.4::DOUBLE) / NULLIF(total_liabilities * 0.3::DOUBLE, 0) AS current_ratio,
       (total_assets * 0.3::DOUBLE) / NULLIF(total_liabilities * 0.3::DOUBLE, 0) AS quick_ratio,
       net_income / NULLIF(total_assets, 0) * 100.0 AS roa,
       net_income / NULLIF(shareholders_equity, 0) * 100.0 AS roe,
       net_income / NULLIF(revenue, 0) * 100.0 AS profit_margin,
       revenue / NULLIF(total_assets, 0) AS asset_turnover
FROM financials""", financials=FINANCIALS_SQL))
def q_financial_ratios(spark, sf):
    return financial_ratios(financials(spark, sf)).select(
        "symbol", "fiscal_period", "fiscal_year", *RATIO_COLUMNS)


_T3_SQL = """
SELECT portfolio_id, symbol, position_date, quantity, avg_cost, current_price,
       quantity * current_price AS market_value,
       (current_price - avg_cost) * quantity AS unrealized_pnl,
       round(quantity * current_price
             / NULLIF(SUM(quantity * current_price) OVER (PARTITION BY portfolio_id, position_date), 0), 6)
         AS weight,
       (current_price - avg_cost) * quantity / NULLIF(avg_cost * quantity, 0) * 100.0 AS pnl_percentage
FROM positions"""


@register("portfolio_positions", with_views(_T3_SQL, positions=POSITIONS_SQL))
def q_portfolio_positions(spark, sf):
    out = portfolio_analytics(positions(spark, sf))
    return out.withColumn("weight", F.round("weight", 6))


@register("position_weight", with_views(
    "SELECT portfolio_id, position_date, symbol, weight FROM (" + _T3_SQL + ")",
    positions=POSITIONS_SQL))
def q_position_weight(spark, sf):
    return q_portfolio_positions(spark, sf).select("portfolio_id", "position_date", "symbol", "weight")


def _customers(spark, sf):
    return table(spark, sf, "customer").withColumnsRenamed({"c_nationkey": "nationkey"})


def _nation_lookup(spark, sf):
    return table(spark, sf, "nation").withColumnsRenamed(
        {"n_nationkey": "nationkey", "n_regionkey": "regionkey"})


def _region_lookup(spark, sf):
    return table(spark, sf, "region").withColumnsRenamed({"r_regionkey": "regionkey"})


@register("lookup_join", """
SELECT c.c_custkey, c.c_name, c.c_nationkey AS nationkey, c.c_acctbal, c.c_mktsegment,
       n.n_name, n.n_regionkey AS regionkey, r.r_name
FROM customer c
LEFT JOIN nation n ON c.c_nationkey IS NOT DISTINCT FROM n.n_nationkey
LEFT JOIN region r ON n.n_regionkey IS NOT DISTINCT FROM r.r_regionkey""")
def q_lookup_join(spark, sf):
    return enrich(_customers(spark, sf), [
        Lookup("nation", _nation_lookup(spark, sf), key="nationkey"),
        Lookup("region", _region_lookup(spark, sf), key="regionkey")])


@register("lookup_join_suffix", """
SELECT c.c_custkey, c.c_name AS name, c.c_nationkey AS nationkey, n.n_name AS name_nation,
       n.n_regionkey
FROM customer c LEFT JOIN nation n ON c.c_nationkey IS NOT DISTINCT FROM n.n_nationkey""")
def q_lookup_join_suffix(spark, sf):
    left = _customers(spark, sf).select("c_custkey", F.col("c_name").alias("name"), "nationkey")
    nat = table(spark, sf, "nation").select(F.col("n_nationkey").alias("nationkey"),
                                            F.col("n_name").alias("name"), "n_regionkey")
    return enrich(left, [Lookup("nation", nat, key="nationkey")])


@register("null_safe_lookup", """
WITH l AS (SELECT c_custkey, CASE WHEN c_nationkey < 3 THEN NULL ELSE c_nationkey END AS nationkey FROM customer),
     r AS (SELECT CASE WHEN n_nationkey = 0 THEN NULL ELSE n_nationkey END AS nationkey, n_name FROM nation)
SELECT l.c_custkey, l.nationkey, r.n_name
FROM l LEFT JOIN r ON l.nationkey IS NOT DISTINCT FROM r.nationkey""")
def q_null_safe_lookup(spark, sf):
    c = table(spark, sf, "customer")
    left = c.select("c_custkey", F.when(F.col("c_nationkey") >= 3, F.col("c_nationkey")).alias("nationkey"))
    n = table(spark, sf, "nation")
    right = n.select(F.when(F.col("n_nationkey") != 0, F.col("n_nationkey")).alias("nationkey"), "n_name")
    return enrich(left, [Lookup("nation", right, key="nationkey")])


@register("derived_columns", with_views("""
SELECT symbol, trade_date,
       high_price - low_price AS spread,
       (high_price + low_price) / 2 AS mid,
       (high_price - low_price) / NULLIF((high_price + low_price) / 2, 0) * 100.0 AS spread_pct
FROM quotes""", quotes=QUOTES_SQL))
def q_derived_columns(spark, sf):
    q = quotes(spark, sf).select("symbol", "trade_date", "high_price", "low_price")
    out = enrich(q, derived={
        "spread": F.col("high_price") - F.col("low_price"),
        "mid": lambda d: (d["high_price"] + d["low_price"]) / 2,
        # refers to a column that does not exist: logged and skipped
        "broken": lambda d: d["no_such_column"] * 2,
        "spread_pct": lambda d: F.try_divide(d["spread"], F.nullif(d["mid"], F.lit(0.0))) * F.lit(100.0),
    })
    return out.drop("high_price", "low_price")


_HASH_COLS = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]


@register("record_hash_md5", """
SELECT c_custkey, c_name, c_nationkey, c_mktsegment,
       md5(concat_ws(chr(31), COALESCE(CAST(c_custkey AS VARCHAR), '\\N'), COALESCE(c_name, '\\N'),
                     COALESCE(CAST(c_nationkey AS VARCHAR), '\\N'), COALESCE(c_mktsegment, '\\N'))) AS record_hash,
       'tpch' AS source_system,
       TIMESTAMP '2024-01-01 00:00:00' AS load_timestamp
FROM (SELECT c_custkey, c_name, c_nationkey,
             CASE WHEN c_nationkey = 3 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer)""")
def q_record_hash_md5(spark, sf):
    import datetime as dt
    c = table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_nationkey",
        F.when(F.col("c_nationkey") != 3, F.col("c_mktsegment")).alias("c_mktsegment"))
    return enrich_with_metadata(c, "tpch", dt.datetime(2024, 1, 1))

