"""T6 aggregation: generic group-by (A1-A3, A11/UD3) and calendar-bucket
aggregation with empty buckets filled (A4-A6).

All built-in aggregates here support partial (map-side) aggregation, so a
hot group is reduced inside each input task before the shuffle.

User aggregates (A11/UD3) come in three forms, fastest first:

* ``SparkAggregate(fn)``: ``fn(Column) -> Column`` written with Spark
  functions; Catalyst plans it like a built-in (partial aggregation).
* ``Mergeable(partial, merge)``: pandas code in two steps.  ``partial`` runs
  on chunks of at most ``rows_per_partial`` rows of one input partition
  (``mapInPandas``), ``merge`` on the partials of a group.  A group's merge
  task therefore sees at most (group rows / chunk) + (input partitions)
  values, however large the group is.
* a plain ``pandas.Series -> scalar`` callable: a grouped-aggregate pandas
  UDF, which needs a whole group in one task.  The caller must accept that
  with ``whole_group=True``, at every size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finspark.functions.scalar import nan_to_null
from finspark.session import checkpoint_dir, range_partitions, staged


DEFAULT_ROWS_PER_PARTIAL = 1_000_000


class SparkAggregate:
    """A user aggregate written with Spark functions: ``fn(Column) -> Column``,
    e.g. ``SparkAggregate(lambda c: F.max(c) - F.min(c), "spread")``."""

    def __init__(self, fn, name: str | None = None):
        self.fn = fn
        self.__name__ = name or getattr(fn, "__name__", "udf")

    def __call__(self, c: Column) -> Column:
        return self.fn(c)


class Mergeable:
    """A pandas user aggregate in two steps.

    ``partial(series)`` returns ``width`` numbers for a chunk of a group;
    ``merge(*series)`` gets one Series per partial value (all partials of the
    group) and returns the result.  ``partial`` must be meaningful on any
    non-empty subset of a group, e.g. spread = partial (max, min), merge
    ``max(maxes) - min(mins)``.
    """

    def __init__(self, partial, merge, width: int = 1, name: str | None = None):
        self.partial, self.merge, self.width = partial, merge, int(width)
        self.__name__ = name or getattr(merge, "__name__", "udf")


def mergeable_aggregate(df: DataFrame, keys: list[str], col: str, agg: Mergeable, name: str,
                        rows_per_partial: int = DEFAULT_ROWS_PER_PARTIAL) -> DataFrame:
    """One row per group: ``agg.merge`` over the partials of ``agg.partial``.

    Step 1 is a map-side combine: each input partition is cut into chunks of
    at most ``rows_per_partial`` rows and every chunk yields one partial row
    per group it holds (no shuffle of raw rows).  Step 2 shuffles only the
    partials and merges them per group.
    """
    import pandas as pd

    pcols = [f"_p{i}" for i in range(agg.width)]
    schema = T.StructType([T.StructField(k, df.schema[k].dataType, True) for k in keys]
                          + [T.StructField(p, T.DoubleType(), True) for p in pcols])
    partial, width, limit = agg.partial, agg.width, int(rows_per_partial)

    def _num(v):
        return None if v is None or pd.isna(v) else float(v)

    def _partials(pdf):
        rows = []
        for k, g in pdf.groupby(keys, sort=False, dropna=False)[col]:
            v = partial(g)
            vals = tuple(v) if width > 1 else (v,)
            rows.append((*(k if isinstance(k, tuple) else (k,)), *map(_num, vals)))
        return pd.DataFrame(rows, columns=keys + pcols)

    def chunks(batches):
        buf, n = [], 0
        for b in batches:
            buf.append(b)
            n += len(b)
            if n >= limit:
                yield _partials(pd.concat(buf, ignore_index=True))
                buf, n = [], 0
        if buf:
            yield _partials(pd.concat(buf, ignore_index=True))

    parts = df.select(*keys, col).mapInPandas(chunks, schema)
    merge = agg.merge
    out_schema = T.StructType([T.StructField(k, df.schema[k].dataType, True) for k in keys]
                              + [T.StructField(name, T.DoubleType(), True)])

    def merged(pdf):
        v = merge(*[pdf[p] for p in pcols])
        return pd.DataFrame([[*(pdf[k].iloc[0] for k in keys), _num(v)]], columns=keys + [name])

    return parts.groupBy(*keys).applyInPandas(merged, out_schema)


def _agg_expr(col: str, fn, order_col: str | None) -> Column:
    """One aggregate of the vocabulary accepted by name (A3)."""
    c = F.col(col)
    if isinstance(fn, SparkAggregate):
        return fn(c)
    if callable(fn):
        return _grouped_agg_udf(fn)(c)
    name = fn.lower()
    if name == "sum":
        return F.coalesce(F.sum(c), F.lit(0))
    if name in ("mean", "avg"):
        return F.avg(c)
    if name == "min":
        return F.min(c)
    if name == "max":
        return F.max(c)
    if name == "count":
        return F.count(c)
    if name == "size":
        return F.count(F.lit(1))
    if name == "nunique":
        return F.count_distinct(c)
    if name in ("first", "last"):
        # first / last non-missing value by the order column (rows of a
        # distributed table have no order of their own)
        if order_col is None:
            raise ValueError(f"{name!r} needs order_col")
        # never NULL for a value: a NULL order value is after all others for
        # the first and before all others for the last; ties go by value
        o = F.col(order_col)
        by = F.when(c.isNotNull(), F.struct(o.isNull() if name == "first" else o.isNotNull(), o, c))
        return F.min_by(c, by) if name == "first" else F.max_by(c, by)
    if name == "std":
        return F.stddev_samp(c)
    if name == "var":
        return F.var_samp(c)
    if name == "median":
        return F.median(c)  # group_aggregate routes medians to exact_median
    if name == "prod":
        return F.coalesce(F.product(c), F.lit(1.0))
    if name == "sem":
        return F.try_divide(F.stddev_samp(c), F.sqrt(F.count(c)))
    if name == "skew":
        return sample_skew(c)
    raise ValueError(f"unknown aggregate {fn!r}")


def sample_skew(c: Column) -> Column:
    """Bias-corrected sample skewness (pandas' ``skew``): population skewness
    times sqrt(n(n-1))/(n-2); NULL below 3 values, 0 for a constant column."""
    n = F.count(c).cast("double")
    g1 = F.skewness(c)
    adj = F.sqrt(n * (n - 1)) / (n - 2)
    return (F.when(n < 3, F.lit(None).cast("double"))
            .when(F.var_pop(c) == 0, F.lit(0.0))
            .otherwise(g1 * adj))


def _grouped_agg_udf(fn):
    """UD3: a pandas Series -> scalar callable as a grouped-aggregate pandas UDF.

    Slow path (no partial aggregation, whole group in one task); prefer a
    built-in name when one exists."""
    import pandas as pd

    def agg(s: pd.Series) -> float:
        v = fn(s)
        return None if v is None else float(v)

    agg.__name__ = getattr(fn, "__name__", "udf")
    # real classes, not the postponed string annotations of this module
    agg.__annotations__ = {"s": pd.Series, "return": float}
    return F.pandas_udf(agg, "double")


def _fn_name(fn) -> str:
    return fn if isinstance(fn, str) else getattr(fn, "__name__", "udf")


def exact_median(df: DataFrame, keys: list[str], col: str, name: str | None = None,
                 partitions: int | None = None, rows_per_partition: int = 5_000_000) -> DataFrame:
    """Exact per-group median (mean of the two middle values for an even count)
    without putting a whole group into one task.

    1. (key, value) -> count, written once: duplicates collapse map-side, and
       the number of pairs sizes the range partitions.
    2. Range-partition on (key, value): a large group spans many partitions.
       The result is materialized once (reliable checkpoint) so every later
       step sees the same partition ids.
    3. A small table of counts per (key, partition) places the two middle
       ranks; only the partitions holding them are ranked, inside one
       partition each.
    """
    name = name or col
    spark = df.sparkSession
    ok = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys] + [F.col(col).isNotNull()])
    counted = staged(df.where(ok).groupBy(*keys, F.col(col).alias("_v"))
                     .agg(F.count(F.lit(1)).alias("_c")), "median_counts")
    n_parts = partitions or range_partitions(counted, rows_per_partition)
    checkpoint_dir(spark)
    ranged = (counted.repartitionByRange(n_parts, *keys, "_v")
              .withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True))
    cells = ranged.groupBy(*keys, "_pid").agg(F.sum("_c").alias("_cc"))
    by_key = Window.partitionBy(*keys)
    cells = cells.withColumns({
        "_before": F.coalesce(F.sum("_cc").over(by_key.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)),
        "_n": F.sum("_cc").over(by_key)})
    lo, hi = F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)
    wanted = F.filter(F.array_distinct(F.array(lo - F.col("_before"), hi - F.col("_before"))),
                      lambda r: (r >= 0) & (r < F.col("_cc")))
    targets = cells.select(*keys, "_pid", F.explode(wanted).alias("_rank"))
    cell = Window.partitionBy(*keys, "_pid", "_rank").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    picked = (ranged.join(targets, keys + ["_pid"])
              .withColumn("_run", F.sum("_c").over(cell))
              .where((F.col("_run") > F.col("_rank")) & (F.col("_run") - F.col("_c") <= F.col("_rank"))))
    return picked.groupBy(*keys).agg(
        (F.sum(F.col("_v").cast("double")) / F.count(F.lit(1))).alias(name))


def group_aggregate(df: DataFrame, group_by, aggregations: dict,
                    order_col: str | None = None, sort: bool = True,
                    rows_per_partial: int = DEFAULT_ROWS_PER_PARTIAL,
                    whole_group: bool = False) -> DataFrame:
    """A1: ``aggregations`` maps column -> function name / callable / list of them.

    Output names (A2): with only single functions the column keeps its name;
    when any list is present every output is ``<col>_<func>``.  Rows with a
    NULL key are dropped; output sorted by the keys unless ``sort=False``.
    With no keys or no aggregations the input is returned unchanged.
    Medians are computed by ``exact_median`` and ``Mergeable`` aggregates by
    ``mergeable_aggregate``; both are joined on the keys (one row per group on
    each side).  NaN is missing, in keys and values.  Several ``nunique`` are
    counted column by column (distinct pairs of keys and value, then pairs per
    group), so no row is multiplied; each reads its columns only.  A plain pandas callable gets a whole group in one task, so it
    raises ``ValueError`` unless ``whole_group=True`` says that every group fits.
    """
    keys = [group_by] if isinstance(group_by, str) else list(group_by or [])
    if not keys or not aggregations:
        return df
    wide = any(isinstance(v, (list, tuple)) for v in aggregations.values())
    exprs, medians, merges, uniques, order = [], [], [], [], []
    for col, fns in aggregations.items():
        for fn in (fns if isinstance(fns, (list, tuple)) else [fns]):
            name = f"{col}_{_fn_name(fn)}".strip("_") if wide else col
            order.append(name)
            if isinstance(fn, str) and fn.lower() == "median":
                medians.append((col, name))
            elif isinstance(fn, str) and fn.lower() == "nunique":
                uniques.append((col, name))
            elif isinstance(fn, Mergeable):
                merges.append((col, fn, name))
            else:
                if callable(fn) and not isinstance(fn, SparkAggregate) and not whole_group:
                    raise ValueError(f"{_fn_name(fn)}: a pandas callable needs a whole group in one task; use "
                                     "SparkAggregate or Mergeable, or pass whole_group=True")
                exprs.append(_agg_expr(col, fn, order_col).alias(name))
    keep = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    data = nan_to_null(df, [*keys, *aggregations]).where(keep)
    if len(uniques) == 1:  # one distinct count multiplies no row
        exprs.append(F.count_distinct(F.col(uniques[0][0])).alias(uniques[0][1]))
        uniques = []
    merged = [mergeable_aggregate(data, keys, col, fn, name, rows_per_partial)
              for col, fn, name in merges]
    # a mergeable result has one row per group (every row yields a partial),
    # so it can stand in for the key list; a median skips NULL values and can't
    if exprs:
        out = data.groupBy(*keys).agg(*exprs)
    elif merged:
        out, merged = merged[0], merged[1:]
    else:
        out = data.select(*keys).distinct()
    for col, name in medians:
        out = out.join(exact_median(data, keys, col, name), keys, "left")
    for col, name in uniques:
        pairs = data.where(F.col(col).isNotNull()).groupBy(*keys, F.col(col).alias("_v")).agg(F.count(F.lit(1)))
        out = out.join(pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)), keys, "left").fillna(0, [name])
    for m in merged:
        out = out.join(m, keys, "left")
    out = out.select(*keys, *order)
    return out.orderBy(*keys) if sort else out


# Calendar buckets (A5): start of bucket, step between starts, label.
_FREQ = {
    "D": ("day", "1 day"),
    "W": ("week", "7 days"),
    "M": ("month", "1 month"),
    "Q": ("quarter", "3 months"),
    "Y": ("year", "1 year"),
}


def bucket_start(c: Column, freq: str) -> Column:
    unit = _FREQ[freq.upper()][0]
    return F.to_date(F.date_trunc(unit, c.cast("timestamp_ntz")))


def bucket_label(start: Column, freq: str) -> Column:
    """D = the day; W = the Sunday ending the (Monday-start) week; M/Q/Y = last day."""
    f = freq.upper()
    if f == "D":
        return start
    if f == "W":
        return F.date_add(start, 6)
    if f == "M":
        return F.last_day(start)
    if f == "Q":
        return F.last_day(F.add_months(start, 2))
    if f == "Y":
        return F.make_date(F.year(start), F.lit(12), F.lit(31))
    raise ValueError(f"unknown frequency {freq!r}")


RESAMPLE_STATS = ("mean", "sum", "min", "max", "count")


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Names of numeric columns."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def resample(df: DataFrame, date_col: str, freq: str = "D", value_cols=None, by=()) -> DataFrame:
    """mean/sum/min/max/count per value column and calendar bucket
    (of each ``by`` group, if given).

    Rows with a missing date are dropped; NaN is missing.  Every bucket between the first and
    the last one (of its group) is emitted; an empty one has sum 0, count 0
    and missing mean/min/max.  Output: the ``by`` columns, ``date_col`` (bucket
    label, DATE), then ``<col>_<stat>`` per value column.
    """
    by = [by] if isinstance(by, str) else list(by)
    cols = list(value_cols) if value_cols is not None else numeric_columns(df, exclude=(date_col, *by))
    start = bucket_start(F.col(date_col), freq)
    data = nan_to_null(df, [*by, *cols]).where(F.col(date_col).isNotNull()).select(*by, start.alias("_start"), *cols)
    exprs = []
    for c in cols:
        exprs += [F.sum(c).alias(f"_s_{c}"), F.min(c).alias(f"_lo_{c}"),
                  F.max(c).alias(f"_hi_{c}"), F.count(c).alias(f"_n_{c}")]
    grouped = data.groupBy(*by, "_start").agg(*exprs)
    # One row per bucket that holds data; each emits itself and the empty
    # buckets up to the next one, so the input is read and aggregated once.
    step = F.expr(f"INTERVAL {_FREQ[freq.upper()][1]}")
    following = F.lead("_start").over(Window.partitionBy(*by).orderBy("_start"))
    last = F.coalesce((F.col("_next") - step).cast("date"), F.col("_start"))
    out = (grouped.withColumn("_next", following)
           .withColumn("_bucket", F.explode(F.sequence("_start", last, step))))
    held = F.col("_bucket") == F.col("_start")
    out = out.withColumns({c: F.when(held, F.col(c)) for c in grouped.columns if c.startswith(("_s_", "_lo_", "_hi_", "_n_"))})
    stats = []
    for c in cols:
        dt = df.schema[c].dataType
        s_, n_ = F.col(f"_s_{c}"), F.col(f"_n_{c}")
        if isinstance(dt, T.DecimalType):
            # Money as DECIMAL: exact, order-free sum; mean = sum / count.
            mean = F.try_divide(s_.cast("double"), F.nullif(n_, F.lit(0)))
            total = F.coalesce(s_, F.lit(0)).cast("double")
            lo, hi = F.col(f"_lo_{c}").cast("double"), F.col(f"_hi_{c}").cast("double")
        else:
            mean = F.try_divide(s_.cast("double"), F.nullif(n_, F.lit(0)))
            total = F.coalesce(s_, F.lit(0))
            lo, hi = F.col(f"_lo_{c}"), F.col(f"_hi_{c}")
        stats += [mean.alias(f"{c}_mean"), total.alias(f"{c}_sum"), lo.alias(f"{c}_min"),
                  hi.alias(f"{c}_max"), F.coalesce(n_, F.lit(0)).alias(f"{c}_count")]
    return out.select(*by, bucket_label(F.col("_bucket"), freq).alias(date_col), *stats)
