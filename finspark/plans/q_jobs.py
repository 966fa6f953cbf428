"""Catalogue phase 8: the daily job end to end."""

from __future__ import annotations

import datetime as dt

from finspark.plans.catalogue import register
from pyspark.sql import functions as F

from finspark.plans.jobs import analytics_table, rejects_table, run_daily
from finspark.plans.q_transforms import _T1_SQL
from finspark.plans.views import QUOTES_SQL, cte, quotes
from finspark.session import scratch_path
from finspark.sinks.tables import Table


@register("run_daily", cte(quotes=QUOTES_SQL) + ",\n" + _T1_SQL.strip() + """
SELECT symbol, trade_date, CAST(CAST(close_price AS VARCHAR) AS DECIMAL(18,4)) AS close_price, volume,
       CAST(CAST(daily_return AS VARCHAR) AS DECIMAL(10,6)) AS daily_return,
       CAST(CAST(rsi_14d AS VARCHAR) AS DECIMAL(6,2)) AS rsi_14d
FROM t1""")
def q_run_daily(spark, sf):
    """Run the job twice for the same day: the keyed load keeps one row per key."""
    root = scratch_path(spark, "warehouse")
    for run_id in (1, 2):
        run_daily(spark, quotes(spark, sf), root, dt.date(2024, 1, 2), run_id)
    return analytics_table(spark, root).read().select("symbol", "trade_date", "close_price", "volume", "daily_return", "rsi_14d")


def _flawed_quotes(spark, sf):
    """All quotes, those of a volume divisible by 7 twice, and those of a volume
    divisible by 10 once more without a symbol."""
    q, none = quotes(spark, sf), F.array().cast("array<string>")
    symbols = F.concat(F.array("symbol"), F.when(F.expr("volume % 7 = 0"), F.array("symbol")).otherwise(none),
                       F.when(F.expr("volume % 10 = 0"), F.array(F.lit(None).cast("string"))).otherwise(none))
    return q.withColumn("symbol", F.explode(symbols))


@register("run_daily_rejects", cte(quotes=QUOTES_SQL) + """
SELECT CAST(1 AS BIGINT) AS run_id, trade_date, volume, 'null:symbol' AS reject_reason FROM quotes WHERE volume % 10 = 0""")
def q_run_daily_rejects(spark, sf):
    """What the job could not load stays in its rejects table."""
    root = scratch_path(spark, "warehouse")
    run_daily(spark, _flawed_quotes(spark, sf), root, dt.date(2024, 1, 2), 1)
    return rejects_table(spark, root).read().select("run_id", "trade_date", "volume", "reject_reason")


@register("run_log_counts", cte(quotes=QUOTES_SQL) + """
SELECT CAST(r AS BIGINT) AS run_id, 'SUCCESS' AS status, n + twice + nameless AS records_extracted,
       n + twice AS records_validated, n AS records_loaded
FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE volume % 7 = 0) AS twice,
             COUNT(*) FILTER (WHERE volume % 10 = 0) AS nameless FROM quotes),
     (VALUES (1), (2)) v(r)""")
def q_run_log_counts(spark, sf):
    """The run log written by two runs of the job over quotes with repeated and rejected rows."""
    root = scratch_path(spark, "warehouse")
    for run_id in (1, 2):
        run_daily(spark, _flawed_quotes(spark, sf), root, dt.date(2024, 1, 2), run_id)
    log = Table(spark, f"{root}/metadata/etl_run_log").read()
    return log.select("run_id", "status", "records_extracted", "records_validated", "records_loaded")
