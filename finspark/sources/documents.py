"""Document collections (S7-S8) re-aimed at exported JSON-lines documents,
and relational pulls (S5, S6, S12).

A document query is expressed with DataFrame calls (no pipeline
interpreter): ``$match`` -> ``where``, ``$group`` -> ``groupBy().agg()``,
``$sort`` -> ``orderBy``, ``$limit`` -> ``limit``, ``$project`` -> ``select``,
``$unwind`` -> ``explode``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def find(df: DataFrame, query: dict | None = None, projection: dict | None = None,
         limit: int = 0) -> DataFrame:
    """Equality filter, inclusion (1) or exclusion (0) projection, limit
    (0 = all), and ``_id`` turned into text (``{"$oid": ..}`` -> the id)."""
    if query:
        df = df.where(reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in query.items()]))
    if projection:
        inc = [k for k, v in projection.items() if v]
        exc = [k for k, v in projection.items() if not v]
        if inc:
            keep = inc + (["_id"] if "_id" in df.columns and projection.get("_id", 1) else [])
            df = df.select(*dict.fromkeys(keep))
        if exc:
            df = df.drop(*exc)
    if "_id" in df.columns:
        t = df.schema["_id"].dataType
        if isinstance(t, T.StructType) and "$oid" in t.fieldNames():
            df = df.withColumn("_id", F.col("_id").getField("$oid"))
        else:
            df = df.withColumn("_id", F.col("_id").cast("string"))
    return df.limit(limit) if limit else df


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, query: str | None = None,
              where: str | None = None, schema: str | None = None, properties: dict | None = None,
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None) -> DataFrame:
    """A relational pull.  ``where`` is applied as a DataFrame filter,
    which Catalyst pushes to the database; with ``partition_column`` and
    bounds the read is split into ``num_partitions`` parallel range queries.
    """
    r = spark.read.format("jdbc").option("url", url)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if query is not None:
        r = r.option("query", query)
    else:
        r = r.option("dbtable", f"{schema}.{table}" if schema else table)
        if partition_column:
            r = (r.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
                 .option("upperBound", upper_bound).option("numPartitions", num_partitions))
    df = r.load()
    return df.where(where) if where else df


def warehouse_sql(spark: SparkSession, query: str, params: dict | None = None) -> DataFrame:
    """SQL over registered tables with named parameter markers (``:name``)."""
    return spark.sql(query, args=params or {})
