"""Catalogue phase 5: sinks (K1-K10), logs (A10, O2), J7 and F14.

Every query writes its input, derived from the test tables, into a fresh
folder under the shared checkpoint folder, runs the sink operation and reads
the table back; the oracle is plain SQL on the same tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from finspark.operators.quality import Rules, evaluate
from finspark.plans.catalogue import register
from finspark.plans.views import QUOTES_SQL, financials, quotes, table, with_views
from finspark.plans.views import FINANCIALS_SQL
from finspark.schemas import COMPANY_FINANCIALS
from finspark.session import scratch_path
from finspark.sinks.tables import (Table, conform, delete_where, extract_and_stage, fk_violations,
                                   insert_ignore, load,
                                   quality_log_rows, read_staged, stage, surrogate_key,
                                   truncate_and_load, update_where, upsert)

ORDERS = "SELECT * FROM orders"


def _orders(spark, sf):
    return table(spark, sf, "orders")


def _roundtrip(spark, sf, fmt):
    o = _orders(spark, sf)
    path = stage(o, scratch_path(spark, f"stage_{fmt}"), fmt)
    return read_staged(spark, path, fmt, schema=o.schema)


@register("stage_roundtrip_parquet", ORDERS)
def stage_roundtrip_parquet(spark, sf):
    return _roundtrip(spark, sf, "parquet")


@register("stage_roundtrip_csv", ORDERS)
def stage_roundtrip_csv(spark, sf):
    return _roundtrip(spark, sf, "csv")


@register("stage_roundtrip_jsonl", ORDERS)
def stage_roundtrip_jsonl(spark, sf):
    return _roundtrip(spark, sf, "jsonl")


@register("extract_and_stage", """
SELECT *, 'tpch' AS source_system, TIMESTAMP '2024-01-02 02:00:00' AS extracted_at FROM orders""")
def q_extract_and_stage(spark, sf):
    path, rows = extract_and_stage(_orders(spark, sf), scratch_path(spark, "staging_orders"), "tpch",
                                   dt.datetime(2024, 1, 2, 2, 0), partition_by="o_orderstatus")
    assert rows > 0
    return spark.read.parquet(path).select(*_orders(spark, sf).columns, "source_system", "extracted_at")


@register("conform_schema", with_views("""
SELECT symbol, fiscal_period, fiscal_year,
       CAST(revenue AS DECIMAL(20,2)) AS revenue, CAST(net_income AS DECIMAL(20,2)) AS net_income,
       CAST(total_assets AS DECIMAL(20,2)) AS total_assets,
       CAST(total_liabilities AS DECIMAL(20,2)) AS total_liabilities,
       CAST(shareholders_equity AS DECIMAL(20,2)) AS shareholders_equity,
       CAST(NULL AS DECIMAL(20,2)) AS cash_flow_operating, CAST(NULL AS DECIMAL(20,2)) AS cash_flow_investing,
       CAST(NULL AS DECIMAL(20,2)) AS cash_flow_financing,
       'tpch' AS source_system, TIMESTAMP '2024-01-01 00:00:00' AS extracted_at
FROM financials""", financials=FINANCIALS_SQL))
def conform_schema(spark, sf):
    good, _rejects = conform(financials(spark, sf), COMPANY_FINANCIALS,
                             defaults={"source_system": "tpch",
                                       "extracted_at": dt.datetime(2024, 1, 1)})
    return good


@register("conform_rejects", """
SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderpriority = '5-LOW' THEN 'null:symbol' END,
                             CASE WHEN o_totalprice >= 100000 THEN 'cast:open_price' END) AS reject_reason
FROM orders WHERE o_orderpriority = '5-LOW' OR o_totalprice >= 100000""")
def conform_rejects(spark, sf):
    """NOT NULL and decimal-overflow rejects: open_price DECIMAL(18,4) is fed
    the order total times 1e9, so totals >= 100000 overflow it."""
    from finspark.schemas import STOCK_PRICES
    o = _orders(spark, sf)
    src = o.select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "5-LOW",
               F.concat(F.lit("S"), F.col("o_custkey").cast("string"))).alias("symbol"),
        F.to_date("o_orderdate").alias("trade_date"),
        (F.col("o_totalprice") * F.lit(1e9)).alias("open_price"))
    _good, rejects = conform(src, STOCK_PRICES, carry=["o_orderkey"])
    return rejects.select("o_orderkey", "reject_reason")


@register("load_append", ORDERS)
def load_append(spark, sf):
    o = _orders(spark, sf)
    t = Table(spark, scratch_path(spark, "load_append"))
    load(o.where(F.col("o_orderstatus") == "F"), t, "append")
    load(o.where(~(F.col("o_orderstatus") == "F")), t, "append")
    return t.read()


@register("load_replace", "SELECT * FROM orders WHERE o_orderstatus = 'O'")
def load_replace(spark, sf):
    o = _orders(spark, sf)
    t = Table(spark, scratch_path(spark, "load_replace"))
    load(o, t, "append")
    load(o.where(F.col("o_orderstatus") == "O"), t, "replace")
    return t.read()


@register("insert_ignore", """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_totalprice ELSE o_totalprice + 1 END
         AS o_totalprice,
       o_orderdate, o_orderpriority
FROM orders""")
def q_insert_ignore(spark, sf):
    o = _orders(spark, sf)
    t = Table(spark, scratch_path(spark, "insert_ignore"))
    load(o.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")), t)
    # the batch holds every order twice (+1 and +2): the first copy wins
    b1 = o.withColumn("o_totalprice", F.col("o_totalprice") + 1).withColumn("seq", F.lit(1))
    b2 = o.withColumn("o_totalprice", F.col("o_totalprice") + 2).withColumn("seq", F.lit(2))
    insert_ignore(b1.unionByName(b2), t, "o_orderkey", order_col="seq", stored=True)
    return t.read()


@register("upsert", """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderstatus IN ('O', 'P') THEN o_totalprice * 3 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority
FROM orders""")
def q_upsert(spark, sf):
    """F rows untouched, O rows updated (price only: the priority in the batch
    is not in the update set), P rows inserted; last copy per key wins."""
    o = _orders(spark, sf)
    t = Table(spark, scratch_path(spark, "upsert"))
    load(o.where(F.col("o_orderstatus") != "P"), t)
    src = o.where(F.col("o_orderstatus").isin("O", "P"))
    b1 = src.withColumns({"o_totalprice": F.col("o_totalprice") * 2, "seq": F.lit(1),
                          "o_orderpriority": F.lit("9-CHANGED")})
    b2 = src.withColumns({"o_totalprice": F.col("o_totalprice") * 3, "seq": F.lit(2)})
    upsert(b1.unionByName(b2), t, "o_orderkey", update_columns=["o_totalprice"], order_col="seq", stored=True)
    return t.read()


@register("upsert_hot_keys", """
SELECT l_returnflag, l_orderkey, l_extendedprice
FROM (SELECT l_returnflag, l_orderkey, l_extendedprice,
             ROW_NUMBER() OVER (PARTITION BY l_returnflag
                                ORDER BY l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) AS rn
      FROM lineitem)
WHERE rn = 1""")
def q_upsert_hot_keys(spark, sf):
    """W8/K5 with hot keys: all lineitem rows upserted on l_returnflag (three
    keys, about a third of the batch each); the last row per key by
    (l_orderkey, l_linenumber, l_extendedprice) wins.  That pair of the first
    two is not unique in the data; rows that tie on all three carry the same
    output values.  The dedupe is a max_by aggregate, combined map-side."""
    li = table(spark, sf, "lineitem")
    t = Table(spark, scratch_path(spark, "upsert_hot"))
    load(li.groupBy("l_returnflag").agg(F.lit(0).cast("bigint").alias("l_orderkey"),
                                        F.lit(0.0).alias("l_extendedprice")), t)
    batch = li.select("l_returnflag", "l_orderkey", "l_extendedprice",
                      F.struct("l_orderkey", "l_linenumber", "l_extendedprice").alias("seq"))
    upsert(batch, t, "l_returnflag", order_col="seq")
    return t.read()


@register("upsert_null_order", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * CASE WHEN o_orderkey % 3 = 0 THEN 3 ELSE 2 END AS o_totalprice,
       o_orderdate, o_orderpriority
FROM orders""")
def q_upsert_null_order(spark, sf):
    """A row whose order value is NULL loses against any other row of its key, and wins alone."""
    o = _orders(spark, sf)
    t = Table(spark, scratch_path(spark, "upsert_null_order"))
    load(o, t)
    b1 = o.where("o_orderkey % 3 <> 0").withColumns({"o_totalprice": F.col("o_totalprice") * 2, "seq": F.lit(1)})
    b2 = o.withColumns({"o_totalprice": F.col("o_totalprice") * 3, "seq": F.lit(None).cast("int")})
    upsert(b1.unionByName(b2), t, "o_orderkey", order_col="seq")
    return t.read()


@register("upsert_moved_partition", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'O' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority
FROM orders""")
def q_upsert_moved_partition(spark, sf):
    """Keys that move to another partition leave their old one (here all of it)."""
    o = _orders(spark, sf)
    t = Table(spark, scratch_path(spark, "upsert_moved"), partition_by="o_orderstatus")
    load(o, t)
    moved = o.where("o_orderstatus = 'F'").withColumns({"o_orderstatus": F.lit("O"),
                                                        "o_totalprice": F.col("o_totalprice") + 1})
    upsert(moved, t, "o_orderkey")
    return t.read().select(*o.columns)


@register("upsert_null_keys", """
WITH k AS (SELECT * REPLACE (CASE WHEN o_orderkey % 2 = 1 THEN o_orderkey END AS o_orderkey) FROM orders)
SELECT * REPLACE (o_totalprice + 5 AS o_totalprice) FROM k
UNION ALL SELECT * FROM k WHERE o_orderkey IS NULL""")
def q_upsert_null_keys(spark, sf):
    """About half of all keys are NULL on both sides: such rows are kept and
    inserted, never matched, and spread over the tasks of the join."""
    o = _orders(spark, sf)
    k = o.withColumn("o_orderkey", F.when(F.col("o_orderkey") % 2 == 1, F.col("o_orderkey")))
    t = Table(spark, scratch_path(spark, "upsert_null_keys"))
    load(k, t)
    upsert(k.withColumn("o_totalprice", F.col("o_totalprice") + 5), t, "o_orderkey")
    return t.read()


@register("insert_ignore_moved_partition", """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority
FROM orders""")
def q_insert_ignore_moved_partition(spark, sf):
    """A key that the table holds in another partition is skipped."""
    o = _orders(spark, sf)
    t = Table(spark, scratch_path(spark, "insert_moved"), partition_by="o_orderstatus")
    load(o.where("o_orderstatus <> 'P'"), t)
    insert_ignore(o.withColumns({"o_orderstatus": F.lit("P"), "o_totalprice": F.col("o_totalprice") + 1}), t, "o_orderkey")
    return t.read().select(*o.columns)


@register("truncate_reload", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def truncate_reload(spark, sf):
    o = _orders(spark, sf)
    t = Table(spark, scratch_path(spark, "truncate_reload"))
    load(o, t)
    truncate_and_load(o.where(F.col("o_orderstatus") == "F"), t)
    return t.read()


@register("update_rewrite", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN o_totalprice > 300000 THEN '0-CRITICAL' ELSE o_orderpriority END AS o_orderpriority
FROM orders""")
def update_rewrite(spark, sf):
    t = Table(spark, scratch_path(spark, "update_rewrite"))
    load(_orders(spark, sf), t)
    update_where(t, {"o_orderpriority": "0-CRITICAL"}, F.col("o_totalprice") > 300000)
    return t.read()


@register("delete_rewrite", "SELECT * FROM orders WHERE NOT (o_orderstatus = 'P')")
def delete_rewrite(spark, sf):
    t = Table(spark, scratch_path(spark, "delete_rewrite"))
    load(_orders(spark, sf), t)
    delete_where(t, "o_orderstatus = 'P'")
    return t.read()


# --------------------------------------------- partitioned tables (scoped rewrites)
@register("upsert_partitioned", """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderstatus IN ('O', 'P') THEN o_totalprice * 3 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority
FROM orders""")
def q_upsert_partitioned(spark, sf):
    """As ``upsert`` on a table partitioned by status: the batch touches the
    O and P partitions only, so the F partition is neither read nor rewritten."""
    o = _orders(spark, sf)
    t = Table(spark, scratch_path(spark, "upsert_part"), partition_by="o_orderstatus")
    load(o.where(F.col("o_orderstatus") != "P"), t)
    src = o.where(F.col("o_orderstatus").isin("O", "P"))
    b1 = src.withColumns({"o_totalprice": F.col("o_totalprice") * 2, "seq": F.lit(1)})
    b2 = src.withColumns({"o_totalprice": F.col("o_totalprice") * 3, "seq": F.lit(2)})
    upsert(b1.unionByName(b2), t, "o_orderkey", update_columns=["o_totalprice"], order_col="seq")
    return t.read()


@register("update_rewrite_partitioned", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN o_totalprice > 300000 THEN '0-CRITICAL' ELSE o_orderpriority END AS o_orderpriority
FROM orders""")
def update_rewrite_partitioned(spark, sf):
    t = Table(spark, scratch_path(spark, "update_part"), partition_by="o_orderstatus")
    load(_orders(spark, sf), t)
    update_where(t, {"o_orderpriority": "0-CRITICAL"}, F.col("o_totalprice") > 300000)
    return t.read()


@register("delete_rewrite_partitioned", "SELECT * FROM orders WHERE NOT (o_orderpriority = '5-LOW')")
def delete_rewrite_partitioned(spark, sf):
    t = Table(spark, scratch_path(spark, "delete_part"), partition_by="o_orderpriority")
    load(_orders(spark, sf), t)
    delete_where(t, "o_orderpriority = '5-LOW'")   # empties one partition, which is removed
    return t.read()


# ----------------------------------------------------------- run / quality logs
_RUNS_SQL = """
SELECT o_orderkey AS run_id, 'financial_etl_pipeline' AS dag_id,
       'load_' || o_orderpriority AS task_id, 'orders' AS source_name,
       o_orderdate AS run_start_time,
       CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'RUNNING' ELSE 'FAILED' END AS status,
       CAST(FLOOR(o_totalprice) AS BIGINT) AS records_loaded
FROM orders"""


def _runs(spark, sf):
    """A run log derived from orders: one run per order."""
    o = _orders(spark, sf)
    status = (F.when(F.col("o_orderstatus") == "F", "SUCCESS")
              .when(F.col("o_orderstatus") == "O", "RUNNING").otherwise("FAILED"))
    runs = o.select(F.col("o_orderkey").alias("run_id"), F.lit("financial_etl_pipeline").alias("dag_id"),
                    F.concat(F.lit("load_"), F.col("o_orderpriority")).alias("task_id"),
                    F.lit("orders").alias("source_name"), F.col("o_orderdate").alias("run_start_time"),
                    status.alias("status"), F.floor("o_totalprice").cast("bigint").alias("records_loaded"))
    t = Table(spark, scratch_path(spark, "etl_run_log"))
    load(runs, t)
    return t.read()


@register("run_log_summary", with_views("""
SELECT dag_id, status, COUNT(*) AS runs, AVG(records_loaded) AS avg_records
FROM runs GROUP BY dag_id, status""", runs=_RUNS_SQL))
def run_log_summary(spark, sf):
    return _runs(spark, sf).groupBy("dag_id", "status").agg(
        F.count(F.lit(1)).alias("runs"), F.avg("records_loaded").alias("avg_records"))


@register("latest_runs_topk", with_views("""
SELECT * FROM runs ORDER BY run_start_time DESC, run_id DESC LIMIT 5""", runs=_RUNS_SQL))
def latest_runs_topk(spark, sf):
    return _runs(spark, sf).orderBy(F.col("run_start_time").desc(), F.col("run_id").desc()).limit(5)


@register("quality_log_summary", with_views("""
SELECT validation_type, SUM(passed) AS passed, SUM(failed) AS failed FROM (
  SELECT 'completeness' AS validation_type,
         COUNT(*) * 7 - (COUNT_IF(symbol IS NULL) + COUNT_IF(trade_date IS NULL) + COUNT_IF(open_price IS NULL)
           + COUNT_IF(high_price IS NULL) + COUNT_IF(low_price IS NULL) + COUNT_IF(close_price IS NULL)
           + COUNT_IF(volume IS NULL)) AS passed,
         COUNT_IF(symbol IS NULL) + COUNT_IF(trade_date IS NULL) + COUNT_IF(open_price IS NULL)
           + COUNT_IF(high_price IS NULL) + COUNT_IF(low_price IS NULL) + COUNT_IF(close_price IS NULL)
           + COUNT_IF(volume IS NULL) AS failed
  FROM quotes
  UNION ALL
  SELECT 'accuracy',
         5 * COUNT(*) - (COUNT_IF(COALESCE(open_price < 0 OR open_price > 100000, false))
           + COUNT_IF(COALESCE(high_price < 0 OR high_price > 100000, false))
           + COUNT_IF(COALESCE(low_price < 0 OR low_price > 100000, false))
           + COUNT_IF(COALESCE(close_price < 0 OR close_price > 100000, false))
           + COUNT_IF(COALESCE(volume < 0 OR volume > 1e15, false))),
         COUNT_IF(COALESCE(open_price < 0 OR open_price > 100000, false))
           + COUNT_IF(COALESCE(high_price < 0 OR high_price > 100000, false))
           + COUNT_IF(COALESCE(low_price < 0 OR low_price > 100000, false))
           + COUNT_IF(COALESCE(close_price < 0 OR close_price > 100000, false))
           + COUNT_IF(COALESCE(volume < 0 OR volume > 1e15, false))
  FROM quotes
  UNION ALL
  SELECT 'consistency', 3 * COUNT(*), COUNT(*) FROM quotes)
GROUP BY validation_type""", quotes=QUOTES_SQL))
def quality_log_summary(spark, sf):
    """The configured quote rule set, logged (K9) then summarized (A10)."""
    from finspark.operators.quality import STOCK_PRICE_RULES
    res = evaluate(quotes(spark, sf), Rules.from_config(STOCK_PRICE_RULES))
    t = Table(spark, scratch_path(spark, "data_quality_log"))
    load(quality_log_rows(res, run_id=1, created_at=dt.datetime(2024, 1, 1)), t)
    return t.read().groupBy("validation_type").agg(
        F.sum("passed_records").alias("passed"), F.sum("failed_records").alias("failed"))


@register("fk_violations", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def q_fk_violations(spark, sf):
    """Children (lineitems as quality rows, run = order) whose run is absent
    from a run log that holds only finished or open orders."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    runs = _orders(spark, sf).where(F.col("o_orderstatus") != "P")
    return fk_violations(li, runs, "l_orderkey", "o_orderkey")


@register("surrogate_key", with_views("""
SELECT row_number() OVER (ORDER BY symbol, trade_date) AS id, symbol, trade_date, close_price
FROM quotes""", quotes=QUOTES_SQL))
def q_surrogate_key(spark, sf):
    q = quotes(spark, sf).select("symbol", "trade_date", "close_price")
    return surrogate_key(q, ["symbol", "trade_date"], "id").select("id", "symbol", "trade_date", "close_price")
