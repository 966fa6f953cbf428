"""Catalogue phase 7: stream drains (X1-X3, F9) over landed message files."""

from __future__ import annotations

from pyspark.sql import functions as F

from finspark.plans.catalogue import register
from finspark.plans.views import table
from finspark.session import scratch_path
from finspark.streaming.drain import decode, drain, message_files

EVENT_DDL = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE"


def _land(events, path, corrupt=True):
    """Messages as JSON text, one folder per event type; 'error' events arrive
    as undecodable bodies, unless ``corrupt`` is off."""
    msg = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    if corrupt:
        msg = F.when(F.col("event_type") == "error",
                     F.concat(F.lit("<<corrupt "), F.col("event_id").cast("string"), F.lit(">>"))).otherwise(msg)
    events.select(msg.alias("value"), "event_type").write.partitionBy("event_type").mode("append").text(path)


def _drain_events(spark, sf, splits, corrupt=True):
    ev = table(spark, sf, "events")
    inbox, sink, ckpt = (scratch_path(spark, n) for n in ("inbox", "sink", "ckpt"))
    for cond in splits:
        _land(ev.where(cond), inbox, corrupt)
        drain(decode(message_files(spark, inbox), EVENT_DDL), sink, ckpt)
    return spark.read.parquet(sink)


_EVENTS_SQL = """
SELECT CASE WHEN event_type = 'error' THEN NULL ELSE event_id END AS event_id,
       CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS user_id,
       CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS event_type,
       CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
       CASE WHEN event_type = 'error' THEN '<<corrupt ' || CAST(event_id AS VARCHAR) || '>>' END AS raw_message
FROM events"""


@register("stream_drain_json", """
SELECT event_id, user_id, event_type, value, CAST(NULL AS VARCHAR) AS raw_message FROM events""")
def stream_drain_json(spark, sf):
    return _drain_events(spark, sf, [F.lit(True)], corrupt=False)


@register("stream_raw_fallback", _EVENTS_SQL)
def stream_raw_fallback(spark, sf):
    return _drain_events(spark, sf, [F.lit(True)])


@register("stream_drain_resume", _EVENTS_SQL)
def stream_drain_resume(spark, sf):
    """Two drains on one checkpoint: the second run adds only the new files."""
    first = F.col("event_type").isin("click", "view")
    return _drain_events(spark, sf, [first, ~first])
