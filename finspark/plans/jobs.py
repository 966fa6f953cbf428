"""The daily batch job -- stage, validate, transform, load, log -- as one
Spark application over versioned paths (scheduling itself is not built).

    quotes --(stage)--> staged parquet --(one rule aggregate)--> quality log
           --(T1, K7 conform)--> rejects table; upsert into analytics table --> run log

Counts come from Observations taken while writing; validation never gates
(non-strict), matching the source job, unless ``strict=True``.  Large runs
compute and load their rows in slices, so shuffle files are those of one slice.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from finspark.functions.scalar import ts_literal, with_lineage
from finspark.operators.indicators import stock_analytics, stock_analytics_incremental
from finspark.operators.quality import STOCK_PRICE_RULES, Rules, evaluate, raise_if_failed
from finspark.schemas import DAILY_STOCK_ANALYTICS
from finspark.session import list_names, path_exists, remove_path, scratch_path, scratch_scope, shuffles_end_with_actions
from finspark.session import staged as stage_once
from finspark.sinks.tables import (RUN_LOG_SCHEMA, Table, conformed, load, log_run, observed_rows,
                                   quality_log_rows, split_conformed, stage, upsert_slices)

# Past so many rows a run computes and loads its rows in slices, at most so many: shuffle files, which are
# larger than all that is kept, are those of one slice.  Indicators shuffle a few columns once, loads whole
# rows thrice, so the former take larger slices.
ROWS_PER_SLICE, MOST_SLICES, LOADS_PER_TRANSFORM = 2_000_000, 16, 4


class StageMetrics:
    """Row counts and durations of pipeline stages without extra jobs.

    ``observe(df, name)`` attaches a count that is filled by whatever action
    later runs the frame; ``timed(name, fn)`` measures the action itself.
    """

    def __init__(self):
        self._obs: dict[str, Observation] = {}
        self.seconds: dict[str, float] = {}

    def observe(self, df: DataFrame, name: str) -> DataFrame:
        obs = Observation(name)
        self._obs[name] = obs
        return df.observe(obs, F.count(F.lit(1)).alias("rows"))

    def timed(self, name: str, fn, *args, **kwargs):
        import time
        t0 = time.perf_counter()
        try:
            return fn(*args, **kwargs)
        finally:
            self.seconds[name] = time.perf_counter() - t0

    def rows(self, name: str) -> int:
        return observed_rows(self._obs[name])


def staged(df: DataFrame, name: str):
    """T7 signature: (frame with a row-count observation, the observation)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


@dataclass
class RunResult:
    run_id: int
    extracted: int
    validated: int
    loaded: int
    rejected: int
    staged_path: str


def analytics_table(spark: SparkSession, root: str) -> Table:
    """The daily analytics table: partitioned by trade month, files sorted by
    (symbol, trade_date) so symbol and date filters skip row groups."""
    return Table(spark, f"{root}/analytics/daily_stock_analytics", DAILY_STOCK_ANALYTICS,
                 partition_by="trade_month", partition_of_key=True, sort_by=["symbol", "trade_date"], compression="zstd")


def rejects_table(spark: SparkSession, root: str) -> Table:
    """Rows that a run could not load, with ``reject_reason`` and ``run_id``; one partition per run, which a
    retry of the run replaces."""
    return Table(spark, f"{root}/rejects/daily_stock_analytics", partition_by="run_id")


def analytics_state(spark: SparkSession, root: str) -> Table:
    """What indicators look back on: the last rows of every symbol."""
    return Table(spark, f"{root}/state/daily_stock_analytics")


def _ties(df: DataFrame) -> list[str]:
    """Quote columns that order rows of one symbol and day."""
    return [c for c in ("open_price", "high_price", "low_price", "close_price", "volume") if c in df.columns]


REJECTED = "rejected"


def _slice(slices: int) -> Column:
    """The slice that a row is loaded with: all rows of a month have one."""
    month = F.date_format("trade_date", "yyyy").cast("int") * 12 + F.month("trade_date")
    return F.when(F.col("reject_reason") != "", REJECTED).otherwise(F.pmod(month, F.lit(slices)).cast("string"))


def _rows_of(marked: DataFrame, held: str, name: str | int) -> DataFrame:
    """The rows of ``marked`` that were written for a slice."""
    spark, path = marked.sparkSession, f"{held}/slice={name}"
    return spark.read.schema(marked.schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], marked.schema)


def _good_slices(marked: DataFrame, held: str, slices: int) -> Iterator[DataFrame]:
    """Good rows by the slices they are loaded with; the files of one are removed when the next is asked for."""
    there = list_names(marked.sparkSession, held)
    for n in [n for n in range(slices) if f"slice={n}" in there] or [0]:
        yield split_conformed(_rows_of(marked, held, n))[0]
        remove_path(marked.sparkSession, f"{held}/slice={n}")


def run_daily(spark: SparkSession, quotes: DataFrame, root: str, run_date: dt.date, run_id: int,
              source: str = "stock_prices", strict: bool = False,
              rows_per_block: int | None = None, incremental: bool = False) -> RunResult:
    """Run the daily pipeline for ``run_date`` with tables under ``root``.

    ``incremental`` says that ``quotes`` are the rows after those of earlier
    runs: indicators continue from the state table instead of the history.
    Running a ``run_id`` again replaces what it loaded and rejected.  Scratch
    folders of the run are removed when it ends.  Past ``ROWS_PER_SLICE`` rows
    indicators are computed for some symbols at a time, and rows are loaded for
    some months at a time; the table changes when all months are written.
    """
    with scratch_scope(spark), shuffles_end_with_actions(spark):
        return _run_daily(spark, quotes, root, run_date, run_id, source, strict, rows_per_block, incremental)


def _run_daily(spark, quotes, root, run_date, run_id, source, strict, rows_per_block, incremental) -> RunResult:
    start = dt.datetime.combine(run_date, dt.time(2, 0))
    ds = run_date.isoformat()

    # extract + stage (lineage columns added, one fixed run timestamp)
    obs_x = Observation("extracted")
    staged = with_lineage(quotes, source, start).observe(obs_x, F.count(F.lit(1)).alias("rows"))
    staged_path = stage(staged, f"{root}/staging/{source}/{ds}", "parquet", compression="zstd")
    extracted = observed_rows(obs_x)
    df = spark.read.parquet(staged_path)

    # validate: the whole rule set is one aggregate over the staged data
    results = evaluate(df, Rules.from_config(STOCK_PRICE_RULES))
    qlog = Table(spark, f"{root}/metadata/data_quality_log")
    load(quality_log_rows(results, run_id, start), qlog)
    raise_if_failed(results, strict)

    # transform + conform to the target DDL
    df = df.select(*[c for c in df.columns if c in DAILY_STOCK_ANALYTICS.schema.names])
    kw = {} if rows_per_block is None else {"rows_per_block": rows_per_block}
    # written once, cast: good rows, rejects and their counts all come from there
    slices = max(1, min(MOST_SLICES, -(-extracted // ROWS_PER_SLICE)))
    parts = 1 if incremental else -(-slices // LOADS_PER_TRANSFORM)
    validated, held = 0, scratch_path(spark, "daily_analytics_slices")
    for i in range(parts):
        own = df if parts == 1 else df.where(F.pmod(F.xxhash64("symbol"), F.lit(parts)) == i)
        if incremental:
            analytics = stock_analytics_incremental(own, analytics_state(spark, root), str(run_id), tie_break=_ties(df), **kw)
        else:
            analytics = stock_analytics(own, stored=True, tie_break=_ties(df), **kw)
        obs_g = Observation("good")
        marked = conformed(analytics.withColumn("processed_at", ts_literal(start)), DAILY_STOCK_ANALYTICS)
        marked = marked.observe(obs_g, F.count_if(F.col("reject_reason") == "").alias("rows"))
        if slices == 1:
            marked = stage_once(marked, "daily_analytics")
        else:
            (marked.withColumn("slice", _slice(slices)).write.mode("append").option("compression", "zstd")
             .partitionBy("slice").parquet(held))
        validated += observed_rows(obs_g)
    good, rejects = split_conformed(marked if slices == 1 else _rows_of(marked, held, REJECTED))
    rejected = rejects_table(spark, root).replace_partitions(
        rejects.withColumn("run_id", F.lit(run_id).cast("bigint")), touched=[(str(run_id),)])
    remove_path(spark, f"{held}/slice={REJECTED}")
    goods = iter([good]) if slices == 1 else _good_slices(marked, held, slices)

    # load: keyed upsert (re-running a day replaces its rows, never duplicates).
    # Of rows that repeat a key one is applied, so loaded <= validated.
    # Physical layout: partitions by trade month (a function of the key), so
    # a day's load reads and rewrites only the months it touches
    target = analytics_table(spark, root)
    key = list(DAILY_STOCK_ANALYTICS.key)
    loaded = upsert_slices((g.withColumn("trade_month", F.date_format("trade_date", "yyyy-MM")) for g in goods), target, key,
                           update_columns=[c for c in (*good.columns, "trade_month") if c not in key],
                           order_col="processed_at")

    log_run(spark, Table(spark, f"{root}/metadata/etl_run_log"), run_id, "financial_etl_pipeline",
            "load_stock_prices", source, "SUCCESS", start, extracted=extracted,
            validated=validated, loaded=loaded)
    return RunResult(run_id, extracted, validated, loaded, rejected, staged_path)


__all__ = ["run_daily", "RunResult", "RUN_LOG_SCHEMA"]
