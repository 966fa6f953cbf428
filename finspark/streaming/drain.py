"""Bounded stream drains (X1-X3) with Structured Streaming.

The source system drains a topic / queue / socket into a table, stopping at
a message cap or a timeout, and remembers its position (consumer group /
acknowledgement).  Here that is a streaming query with a checkpoint (the
remembered position) and ``trigger(availableNow=True)`` (drain what is there,
then stop); batches may be sized by ``maxOffsetsPerTrigger`` /
``maxFilesPerTrigger``, which bounds a batch, and ``max_messages`` bounds the
whole drain.  A re-run with nothing new adds nothing; a new file or offset
range adds exactly its messages (exactly-once file sink).
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finspark.session import list_names, path_exists, read_text, remove_path, write_text

RAW = "raw_message"
_POLL_S = 0.5


def message_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed message files (one message per line) as a stream of ``value``."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def kafka_topic(spark: SparkSession, servers: str, topic: str, group: str = "etl_consumer",
                max_messages: int | None = 1000) -> DataFrame:
    """A topic read from the earliest offset on first run; later runs resume
    from the checkpoint.  Needs the Kafka connector on the classpath."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", "earliest")
         .option("kafka.group.id", group))
    if max_messages:
        r = r.option("maxOffsetsPerTrigger", max_messages)
    return r.load().select(F.col("value").cast("string").alias("value"))


def decode(df: DataFrame, schema, value_col: str = "value") -> DataFrame:
    """JSON-decode each message; an undecodable one keeps its text in
    ``raw_message`` (other fields NULL)."""
    st = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    with_raw = T.StructType(st.fields + [T.StructField(RAW, T.StringType(), True)])
    parsed = F.from_json(F.col(value_col), with_raw,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW})
    return df.select(parsed.alias("m")).select("m.*")


def drain(stream: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet",
          timeout_s: float | None = None, query_name: str | None = None,
          max_messages: int | None = None) -> int | tuple[int, bool]:
    """Drain what is available into ``sink_path`` and stop; returns the rows
    added by this run.  With ``timeout_s`` the run may be cut earlier and
    returns (rows, finished); a cut run resumes from the checkpoint.

    ``max_messages`` bounds the run (``drain_bounded``); a checkpoint is used
    either with a bound or without."""
    if max_messages is not None:
        return drain_bounded(stream, sink_path, checkpoint, max_messages, timeout_s, query_name)
    w = (stream.writeStream.format(fmt).option("checkpointLocation", checkpoint)
         .option("path", sink_path).outputMode("append").trigger(availableNow=True))
    added, finished = _run(w, timeout_s, query_name)
    return added if timeout_s is None else (added, finished)


def _run(writer, timeout_s: float | None, query_name: str | None, enough=lambda: False) -> tuple[int, bool]:
    """Run a query until it ends, the time is over or ``enough()``; (input rows, ended by itself)."""
    if query_name:
        writer = writer.queryName(query_name)
    q = writer.start()
    # the query keeps its latest progress reports only: gather them by batch as it runs
    rows: dict[int, int] = {}
    deadline = None if timeout_s is None else time.monotonic() + timeout_s
    finished = False
    while not finished and not enough():
        left = _POLL_S if deadline is None else deadline - time.monotonic()
        if left <= 0:
            break
        finished = q.awaitTermination(max(0.001, min(_POLL_S, left)))
        rows.update((p.batchId, p.numInputRows) for p in q.recentProgress)
    if not finished:
        q.stop()
    rows.update((p.batchId, p.numInputRows) for p in q.recentProgress)
    if q.exception() is not None:
        raise q.exception()
    return sum(rows.values()), finished


def drain_bounded(stream: DataFrame, sink_path: str, checkpoint: str, max_messages: int,
                  timeout_s: float | None = None, query_name: str | None = None) -> int | tuple[int, bool]:
    """Deliver at most ``max_messages`` further messages to ``sink_path``, each exactly once over all runs.

    Two steps with positions of their own below ``checkpoint``.  The stream is
    landed in batches (``landed/batch=<n>``, Parquet, a number per message)
    until enough wait or nothing is left.  Then the portion of this run is
    planned: the counts per batch and task (a small table) say at which
    (batch, number) it ends, and that plan is written before the messages go to
    ``sink_path/portion=<n>``.  A run that was cut after its plan is finished
    first, as this run's portion, by writing the same messages again over what
    it left.  Landed batches that were delivered whole are removed.
    Sizes of batches are those of the stream's own options.

    Read the sink with ``spark.read.parquet``; ``portion`` is the run that
    delivered a message.  With ``timeout_s`` landing may be cut; returns (rows,
    whether landing ended by itself) then.
    """
    if max_messages < 1:
        raise ValueError("max_messages must be at least 1")
    spark = stream.sparkSession
    landed = f"{checkpoint}/landed"
    plans = _plans(spark, checkpoint)
    if plans and not path_exists(spark, f"{sink_path}/portion={plans[-1]['portion']}/_SUCCESS"):
        _deliver(spark, stream.schema, landed, sink_path, plans[-1])
        return plans[-1]["rows"] if timeout_s is None else (plans[-1]["rows"], False)
    last = plans[-1]["upto"] if plans else [-1, -1]

    def land(batch: DataFrame, batch_id: int) -> None:
        path = f"{landed}/batch={batch_id}"
        # a batch that runs again after its commit was lost must keep its numbers
        if batch_id < last[0] or path_exists(spark, f"{path}/_SUCCESS"):
            return
        batch.withColumn(_NUMBER, F.monotonically_increasing_id()).write.mode("overwrite").parquet(path)

    def waiting() -> list[tuple]:
        """(batch, task, messages after ``last``), in order."""
        whole = _batches(spark, landed)
        if not whole:
            return []
        rows = _landed(spark, stream.schema, landed).where(F.col("batch").isin(whole) & _after(last))
        return sorted(map(tuple, rows.groupBy("batch", F.shiftright(_NUMBER, 33).alias("task"))
                          .agg(F.count(F.lit(1)), F.min(_NUMBER)).collect()))

    finished, seen, cells = True, None, waiting()
    if sum(c[2] for c in cells) < max_messages:
        def enough() -> bool:
            nonlocal seen, cells
            now = _batches(spark, landed)
            if now != seen:
                seen, cells = now, waiting()
            return sum(c[2] for c in cells) >= max_messages

        w = (stream.writeStream.foreachBatch(land).option("checkpointLocation", f"{checkpoint}/stream")
             .trigger(availableNow=True))
        _, finished = _run(w, timeout_s, query_name, enough)
        cells = waiting()
    left, upto = max_messages, None
    for batch, _task, n, first in cells:
        if left == 0:
            break
        # the numbers of a task's messages follow each other
        take = min(n, left)
        upto, left = [batch, first + take - 1], left - take
    rows = max_messages - left
    if rows:
        portion = plans[-1]["portion"] + 1 if plans else 0
        plan = {"portion": portion, "after": last, "upto": upto, "rows": rows}
        write_text(spark, f"{checkpoint}/plans/{portion:08d}.json", json.dumps(plan), overwrite=False)
        _deliver(spark, stream.schema, landed, sink_path, plan)
    return rows if timeout_s is None else (rows, finished)


_NUMBER = "__number"


def _landed(spark: SparkSession, schema: T.StructType, landed: str) -> DataFrame:
    own = T.StructType([*schema.fields, T.StructField(_NUMBER, T.LongType()), T.StructField("batch", T.LongType())])
    return spark.read.schema(own).parquet(landed)


def _after(position: list[int]):
    return F.struct("batch", _NUMBER) > F.struct(*[F.lit(p).cast("bigint") for p in position])


def _deliver(spark: SparkSession, schema: T.StructType, landed: str, sink_path: str, plan: dict) -> None:
    rows = _landed(spark, schema, landed).where(F.col("batch").between(max(plan["after"][0], 0), plan["upto"][0]))
    rows = rows.where(_after(plan["after"]) & ~_after(plan["upto"]))
    rows.select(*schema.names).write.mode("overwrite").parquet(f"{sink_path}/portion={plan['portion']}")
    for batch in _batches(spark, landed):
        if batch < plan["upto"][0]:
            remove_path(spark, f"{landed}/batch={batch}")


def _batches(spark: SparkSession, landed: str) -> list[int]:
    """The numbers of the batches that were landed whole."""
    return sorted(int(name.split("=")[1]) for name in list_names(spark, landed)
                  if name.startswith("batch=") and path_exists(spark, f"{landed}/{name}/_SUCCESS"))


def _plans(spark: SparkSession, checkpoint: str) -> list[dict]:
    """The last plan, if any."""
    names = sorted(list_names(spark, f"{checkpoint}/plans"))
    return [json.loads(read_text(spark, f"{checkpoint}/plans/{n}")) for n in names[-1:]] if names else []
