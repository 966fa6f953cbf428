"""Payload normalizers (N1-N5): landed API responses -> rows, on Spark.

Input is a frame of landed responses, e.g. ``(request_symbol STRING,
payload STRING)``.  The network clients are not part of this library; what
each client does with a response is data work and runs here as JSON
functions over the whole frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finspark.functions.scalar import flatten, ts_literal

# The daily-series payload layout (map key and field names).
DAILY_SERIES_KEY = "Time Series (Daily)"
DAILY_FIELDS = {"1. open": "open", "2. high": "high", "3. low": "low", "4. close": "close",
                "5. volume": "volume"}


def explode_daily_series(df: DataFrame, symbol_col: str = "request_symbol",
                         payload_col: str = "payload", key: str = DAILY_SERIES_KEY) -> DataFrame:
    """{key: {date: {"1. open": "..", ...}}} -> one row per (symbol, date).

    Values are text in the payload and cast to double / bigint; a payload
    without the key gives no rows."""
    st = T.StructType([T.StructField(key, T.MapType(T.StringType(),
                                                    T.MapType(T.StringType(), T.StringType())))])
    parsed = df.select(F.col(symbol_col).alias("symbol"),
                       F.from_json(F.col(payload_col), st)[key].alias("series"))
    rows = parsed.select("symbol", F.explode("series").alias("date", "v"))
    cols = [F.col("symbol"), F.to_date("date").alias("date")]
    for field, name in DAILY_FIELDS.items():
        t = "bigint" if name == "volume" else "double"
        cols.append(F.col("v")[field].try_cast(t).alias(name))
    return rows.select(*cols)


def parse_quote(df: DataFrame, schema, symbol_col: str = "request_symbol",
                payload_col: str = "payload", run_ts=None) -> DataFrame:
    """A flat quote object -> one row, with the symbol and one fetch time stamped."""
    ts = ts_literal(run_ts) if run_ts is not None else F.current_timestamp()
    return df.select(F.col(symbol_col).alias("symbol"), ts.alias("timestamp"),
                     F.from_json(F.col(payload_col), schema).alias("j")).select("symbol", "timestamp", "j.*")


def explode_object_or_array(df: DataFrame, schema, symbol_col: str = "request_symbol",
                            payload_col: str = "payload") -> DataFrame:
    """An object payload gives one row, an array payload one row per element;
    the symbol is stamped on each."""
    st = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    p = F.ltrim(F.col(payload_col))
    items = F.when(p.startswith("["), F.from_json(p, T.ArrayType(st))).otherwise(
        F.array(F.from_json(p, st)))
    return (df.select(F.col(symbol_col).alias("symbol"), F.explode(items).alias("j"))
            .select("symbol", "j.*"))


def first_list_rows(df: DataFrame, schema, payload_col: str = "payload", sep: str = ".") -> DataFrame:
    """The first list-valued field of the result is the row set; nested
    objects are flattened to dotted names, arrays kept; a result without a
    list is itself one row."""
    st = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    parsed = df.select(F.from_json(F.col(payload_col), st).alias("j"))
    first = next((f for f in st.fields if isinstance(f.dataType, T.ArrayType)), None)
    if first is None:
        return flatten(parsed.select("j.*"), sep)
    rows = parsed.select(F.explode(F.col("j")[first.name]).alias("r"))
    if isinstance(first.dataType.elementType, T.StructType):
        return flatten(rows.select("r.*"), sep)
    return rows.withColumnRenamed("r", first.name)


def stack_by_name(frames) -> DataFrame:
    """Stack frames aligning columns by name; missing columns are NULL."""
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
