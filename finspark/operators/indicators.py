"""T1 stock analytics: period return, moving averages, rolling volatility, RSI.

Semantics (per symbol, ordered by trade date, row frames):

* ``daily_return``  = ff / lag(ff) - 1 where ff is the forward-filled price
  (a missing price gives return 0, the next price compares with the last
  known one); undefined ratio -> NULL.
* ``moving_avg_<n>d`` = mean of the price over the last n rows, >= 1 value.
* ``volatility_<n>d`` = sample std-dev of ``daily_return`` over n rows
  (NULL below 2 values).
* ``rsi_<p>d``: d = price - previous price; gain = d if d > 0 else 0; loss =
  -d if d < 0 else 0 (a missing d counts as 0/0); simple p-row means g, l,
  defined only once the frame holds p rows; 100 - 100 / (1 + g / l); l = 0
  and g > 0 -> 100; l = g = 0 -> NULL.
* Rows whose key is NULL keep their values with all indicators NULL.
* NaN is missing, as NULL is.

Scale design.  A per-symbol window puts a whole series into one task, so a
symbol that holds a large share of all rows would become a single giant
task.  ``stock_analytics`` therefore splits every series into position-based
blocks of about ``rows_per_block`` rows.  Each block also receives the
``halo`` rows that precede it (the longest look-back of any indicator), so a
window partitioned by (symbol, block) sees exactly the rows a per-symbol
window would see for the block's own rows.  Block positions come from a small
count table per (symbol, calendar bucket), kept only for symbols longer than
one block (at most rows / rows_per_block of them); every other series is one
block.  Forward fill across block borders uses the last known price carried
in from that table.  Each row is copied to
at most two later blocks, and only rows within ``halo`` of a block border are
copied.  The data is shuffled once (by symbol and block).  The count table is
a small file: the planner broadcasts it by its bytes, or joins it by shuffle.
The input is written once (unless it is a stored table already), so the
counts and the indicators do not compute it twice.  Rows without a key have no
indicators: they pass no window, however many they are.

Spark's own sliding frames add up their whole frame again for each row, one row
at a time.  Over float prices the frames are added up in the same order by
numpy instead, a batch of the windows' sorted rows at a time (``_frames``), so
the values are the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finspark.functions.scalar import nan_to_null, safe_div
from finspark.session import remove_path, staged
from finspark.sinks.tables import Table

DEFAULT_ROWS_PER_BLOCK = 2_000_000
# Next finer date_trunc unit, used when one (key, bucket) cell holds more
# rows than a block.
FINER_BUCKET = {"year": "month", "quarter": "month", "month": "day", "week": "day",
                "day": "hour", "hour": "minute", "minute": "second"}


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _indicator_columns(df: DataFrame, part: list, order: str, price: str,
                       ma_windows, vol_window: int, rsi_period: int,
                       carry: Column | None, key_ok: Column, tie_break=(), known: str | None = None,
                       fill_as: str | None = None) -> DataFrame:
    """Add the indicator columns with windows partitioned by ``part``."""
    w = Window.partitionBy(*part).orderBy(order, *tie_break)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    p = F.col(price)

    ff = F.last(_filled(price, known), ignorenulls=True).over(run)
    if carry is not None:
        ff = F.coalesce(ff, F.first(carry).over(run))
    delta = p - F.lag(p).over(w)
    df = df.withColumns({"_ff": ff, "_d": delta, "_pos": F.row_number().over(w)})

    ma, vol = {f"moving_avg_{n}d": n for n in ma_windows}, f"volatility_{vol_window}d"
    if all(isinstance(df.schema[c].dataType, T.DoubleType) for c in (price, "_ff", "_d")) and _passes_arrow(df):
        # a narrow step: the rows come as the windows sorted them
        made = ["daily_return", *ma, vol, "_g", "_l"]
        spent = {"_d", "_pos", "_bkt", "_carry", *made} | (set() if fill_as else {"_ff"})
        df = df.drop(*made) if price not in made else df
        kept = [c for c in df.columns if c not in spent]
        types = T.StructType([*[df.schema[c] for c in kept], *[T.StructField(c, T.DoubleType()) for c in made]])
        df = df.mapInArrow(lambda batches: _frames(batches, kept, price, ma, vol_window, rsi_period, vol), types)
        full = F.lit(True)
    else:
        ret = safe_div(F.col("_ff"), F.lag("_ff").over(w)) - F.lit(1.0)
        gain = F.when(F.col("_d") > 0, F.col("_d")).otherwise(F.lit(0.0))
        loss = F.when(F.col("_d") < 0, -F.col("_d")).otherwise(F.lit(0.0))
        df = df.withColumns({"daily_return": ret, "_gain": gain, "_loss": loss})
        frame = lambda n: w.rowsBetween(-(n - 1), 0)
        df = df.withColumns({c: F.avg(p).over(frame(n)) for c, n in ma.items()}
                            | {vol: F.stddev_samp("daily_return").over(frame(vol_window)),
                               "_g": F.avg("_gain").over(frame(rsi_period)), "_l": F.avg("_loss").over(frame(rsi_period))})
        full = F.col("_pos") >= rsi_period
    g, l = F.col("_g"), F.col("_l")
    rsi = F.when(full, F.when(l == 0, F.when(g > 0, F.lit(100.0)))
                 .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + g / l)))
    df = df.withColumn(f"rsi_{rsi_period}d", rsi)

    out = _out_names(ma_windows, vol_window, rsi_period)
    if fill_as:
        df = df.withColumnRenamed("_ff", fill_as)
    return df.withColumns({c: F.when(key_ok, F.col(c)) for c in out})


def _filled(price: str, known: str | None) -> Column:
    return F.coalesce(F.col(price), F.col(known)) if known else F.col(price)


def _passes_arrow(df: DataFrame) -> bool:
    plain = (T.StringType, T.BinaryType, T.BooleanType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return all(isinstance(f.dataType, plain) for f in df.schema.fields) and len(set(df.columns)) == len(df.columns)


def _frames(batches: Iterator[pa.RecordBatch], kept: list[str], price: str, ma: dict, vol_window: int, rsi_period: int,
            vol: str) -> Iterator[pa.RecordBatch]:
    """The columns ``kept`` with returns, moving averages ``{name: rows}``, volatility, and the mean
    gains and losses (``_g``, ``_l``) of whole frames.

    Rows come sorted, a series after the other: ``_pos`` is a row's number in
    its series, ``_ff`` its filled price and ``_d`` its price difference.  As
    many rows as the longest frame looks back on are carried from batch to
    batch.  Frames are added up from their oldest value to their newest, as an
    aggregate does; a missing value is left out."""
    halo = max(*ma.values(), vol_window + 1, rsi_period + 1) - 1
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [batch.column("_pos").to_numpy(zero_copy_only=False)]
        for c in (price, "_ff", "_d"):
            v = batch.column(c)
            now += [pc.fill_null(v, 0.0).to_numpy(zero_copy_only=False), pc.is_valid(v).to_numpy(zero_copy_only=False)]
        if before is not None:
            now = [np.concatenate(two) for two in zip(before, now)]
        pos, p, p_known, ff, ff_known, d, d_known = now
        size = len(pos)
        before = [v[max(0, size - halo):] for v in now]
        with np.errstate(all="ignore"):
            last = np.concatenate([[0.0], ff[:-1]])
            known = ff_known & np.concatenate([[False], ff_known[:-1]]) & (pos > 1) & (last != 0)
            ret = np.where(known, ff / last - 1.0, 0.0)
            out = [(ret, ~known)]
            for n in ma.values():
                count = _counts(pos, p_known, n)
                out.append((_sums(pos, p, n) / count, count < 1))
            count, squares = _moments(pos, ret, known, vol_window)
            out.append((np.sqrt(squares / (count - 1)), count < 2))
            # NaN (of two infinite prices) is above all numbers
            gain = np.where(d_known & ~(d <= 0), d, 0.0)
            loss = np.where(d_known & (d < 0), -d, 0.0)
            out += [(_sums(pos, v, rsi_period) / rsi_period, pos < rsi_period) for v in (gain, loss)]
        first = size - batch.num_rows
        made = [pa.array(v[first:], mask=none[first:]) for v, none in out]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *made],
                                         [*kept, "daily_return", *ma, vol, "_g", "_l"])


def _back(pos: np.ndarray, n: int) -> range:
    """How far the frames of ``n`` rows reach back, the oldest first."""
    return range(min(n, int(pos.max()), len(pos)) - 1, -1, -1)


def _sums(pos: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    total = np.zeros(len(pos))
    for k in _back(pos, n):
        total[k:] += np.where(pos[k:] > k, values[:len(pos) - k], 0.0)
    return total


def _counts(pos: np.ndarray, known: np.ndarray, n: int) -> np.ndarray:
    so_far = np.concatenate([[0], np.cumsum(known)])
    at = np.arange(len(pos))
    return so_far[1:] - so_far[np.maximum(at + 1 - np.minimum(pos, n), 0)]


def _moments(pos: np.ndarray, values: np.ndarray, known: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Count and sum of squared differences from the mean, a value at a time (Welford)."""
    count, mean, squares = np.zeros(len(pos)), np.zeros(len(pos)), np.zeros(len(pos))
    for k in _back(pos, n):
        of = slice(0, len(pos) - k)
        there = (pos[k:] > k) & known[of]
        more = count[k:] + 1.0
        delta = values[of] - mean[k:]
        step = delta / more
        squares[k:] = np.where(there, squares[k:] + delta * (delta - step), squares[k:])
        mean[k:] = np.where(there, mean[k:] + step, mean[k:])
        count[k:] = np.where(there, more, count[k:])
    return count, squares


def stock_analytics(df: DataFrame, ma_windows=(20, 50, 200), vol_window: int = 20,
                    rsi_period: int = 14, key="symbol", order: str = "trade_date",
                    price: str = "close_price",
                    rows_per_block: int | None = DEFAULT_ROWS_PER_BLOCK,
                    bucket: str = "month", stored: bool = False,
                    tie_break=(), known: str | None = None, fill_as: str | None = None) -> DataFrame:
    """T1 on a quote table unique by (key, order); if it is not, name
    ``tie_break`` columns that make the row order deterministic.

    ``rows_per_block=None`` uses one window partition per key (fine when no
    key is large); otherwise series are split into blocks with a halo.
    ``bucket`` is the date_trunc unit of the count table that places the
    block borders; a block never splits a bucket.  When one (key, bucket)
    cell holds more than a block's rows (e.g. a busy intraday series with
    'month'), the count table is rebuilt with the next finer unit, down to
    seconds, so blocks stay near ``rows_per_block`` rows.

    ``stored=True`` says that ``df`` is read straight from files: it is then
    read again for the counts (key columns only) instead of being written to
    the shared folder once.  The count table (one row per bucket of each key
    longer than a block) is written when this function is called.

    ``known`` names a column whose value is the last known price where a row's
    own is missing (rows of carried state); ``fill_as`` adds the filled price
    under that name.  Input columns named like an output are replaced by it;
    any other name may stand in the input.
    """
    keys = _keys(key)
    clash = {c: f"in{i}{c}" for i, c in enumerate(df.columns) if c.startswith("_")}
    if clash:  # working columns start with an underscore
        new = lambda c: clash.get(c, c)
        out = stock_analytics(df.withColumnsRenamed(clash), ma_windows, vol_window, rsi_period, [new(k) for k in keys],
                              new(order), new(price), rows_per_block, bucket, stored, [new(c) for c in tie_break],
                              known and new(known), fill_as)
        return out.withColumnsRenamed({v: k for k, v in clash.items()})
    df = nan_to_null(df)
    key_ok = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    ma_windows = tuple(ma_windows)
    out_cols = [*_out_names(ma_windows, vol_window, rsi_period), *([fill_as] if fill_as else [])]
    base_cols = [c for c in df.columns if c not in out_cols]
    if rows_per_block is None:
        out = _indicator_columns(df, keys, order, price, ma_windows, vol_window,
                                 rsi_period, None, key_ok, tuple(tie_break), known, fill_as)
        return out.select(*base_cols, *out_cols)

    if not stored:
        df = staged(df, "t1_input")
    # rows without a key are no series: they would only fill up one
    kinds = {c: T.DoubleType() for c in out_cols} | ({fill_as: df.schema[price].dataType} if fill_as else {})
    nameless = df.where(~key_ok).select(*base_cols, *[
        (_filled(price, known) if c == fill_as else F.lit(None)).cast(t).alias(c) for c, t in kinds.items()])
    out = _keyed_analytics(df.where(key_ok), ma_windows, vol_window, rsi_period, keys, order, price, rows_per_block, bucket,
                           tuple(tie_break), known, fill_as, key_ok)
    return out.select(*base_cols, *out_cols).unionByName(nameless)


def _keyed_analytics(df: DataFrame, ma_windows, vol_window: int, rsi_period: int, keys: list[str], order: str, price: str,
                     rows_per_block: int, bucket: str, tie_break: tuple, known: str | None, fill_as: str | None,
                     key_ok: Column) -> DataFrame:
    """T1 of stored rows with whole keys, in blocks."""
    halo = max(max(ma_windows) - 1, vol_window, rsi_period)
    R = max(int(rows_per_block), halo)
    # Series longer than a block: at most rows / R of them.  Counting them
    # reads only the key columns; with none, every series is one block.
    long_keys, n_long = _long_series(df, keys, R)
    if n_long == 0:
        return stock_analytics(df, ma_windows, vol_window, rsi_period, keys, order, price,
                               rows_per_block=None, tie_break=tie_break, known=known, fill_as=fill_as)
    same_key = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys])
    long_rows = df.join(long_keys, same_key, "left_semi")
    while True:
        cells = long_rows.withColumn("_bkt", F.date_trunc(bucket, F.col(order).cast("timestamp_ntz")))
        stats, biggest = _count_table(cells, keys, order, _filled(price, known), tie_break, R, halo)
        if biggest <= R or bucket not in FINER_BUCKET:
            break
        # a cell larger than a block would make one oversized block: refine
        bucket = FINER_BUCKET[bucket]
    data = df.withColumn("_bkt", F.date_trunc(bucket, F.col(order).cast("timestamp_ntz")))

    cond = reduce(lambda a, b: a & b,
                  [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys]
                  + [F.col("_bkt") == F.col("_s_bkt")])
    # rows of series that fit one block find no cell: block 0, no copies
    placed = (data.join(stats, cond, "left").drop(*[f"_s_{k}" for k in keys], "_s_bkt")
              .withColumn("_own", F.coalesce(F.col("_own"), F.lit(0).cast("bigint"))))
    targets = F.concat(F.array(F.col("_own")),
                       F.when(F.col("_lo") <= F.col("_hi"), F.sequence("_lo", "_hi"))
                       .otherwise(F.array().cast("array<bigint>")))
    placed = placed.withColumn("_blk", F.explode(targets)).drop("_lo", "_hi")

    out = _indicator_columns(placed, keys + ["_blk"], order, price, ma_windows,
                             vol_window, rsi_period, F.col("_carry"), key_ok, tie_break, known, fill_as)
    return out.where(F.col("_blk") == F.col("_own"))


def stock_analytics_incremental(batch: DataFrame, state: Table, batch_id: str, ma_windows=(20, 50, 200),
                                vol_window: int = 20, rsi_period: int = 14, key="symbol", order: str = "trade_date",
                                price: str = "close_price", rows_per_block: int | None = DEFAULT_ROWS_PER_BLOCK,
                                tie_break=()) -> DataFrame:
    """T1 of a batch that continues what ``state`` holds, without the history.

    ``state`` (an unpartitioned ``Table`` that keeps at least two versions)
    holds of every key the last rows that indicators look back on, at most
    ``halo`` = 199 with the default windows: key, order, tie-break and price
    columns and the filled price.  The rows of the batch are computed after
    them, and each key of the batch gets its new last rows; the state of other
    keys stays.  Fed in order, batches give what ``stock_analytics`` gives on
    the whole.  The result is written to the shared folder before the state is
    replaced.  A batch fed again under its ``batch_id``, however often,
    continues from the state before it, so a retry gives the same rows.

    Rows that do not come after the state of their key raise ``ValueError``
    (recompute the series then).  Rows with a NULL key part have no indicators
    and no state; rows with a NULL order value raise, too.
    """
    keys, spark = _keys(key), batch.sparkSession
    ties = [c for c in tie_break if c not in (*keys, order, price)]
    halo = max(max(ma_windows) - 1, vol_window, rsi_period)
    marks = ["__known", "__new", "__fill"]
    if set(marks) & set(batch.columns):
        raise ValueError(f"columns {marks} are taken")
    batch = staged(batch, "t1_batch")
    own_keys = batch.select(*keys).distinct()
    if batch.where(F.col(order).isNull()).limit(1).count():
        raise ValueError(f"rows without {order}")
    before, made = _state_before(state, batch_id)
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__s_{k}") for k in keys])
    both = batch.withColumns({"__known": F.lit(None).cast(batch.schema[price].dataType), "__new": F.lit(True)})
    if before is not None:
        held = before.select(*keys, order, *ties, price, F.col("filled_price").alias("__known"))
        renamed = own_keys.select(*[F.col(k).alias(f"__s_{k}") for k in keys])
        old = staged(held.join(renamed, same, "left_semi"), "t1_state")
        last = old.groupBy(*keys).agg(F.max(order).alias("__last"))
        first = batch.groupBy(*keys).agg(F.min(order).alias("__first"))
        late = first.join(last, keys).where("__first <= __last").limit(1).collect()
        if late:
            raise ValueError(f"rows of the batch do not come after the state: {late[0]}")
        both = both.unionByName(old.withColumn("__new", F.lit(False)), allowMissingColumns=True)
    # batch and state are read from files
    out = staged(stock_analytics(both, ma_windows, vol_window, rsi_period, keys, order, price, rows_per_block,
                                 stored=True, tie_break=tie_break, known="__known", fill_as="__fill"), "t1_result")
    # the last rows of each key; Spark cuts a key to that many in each task before the shuffle
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in (order, *tie_break)])
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    tail = (out.where(whole).withColumn("__back", F.row_number().over(w)).where(F.col("__back") <= halo)
            .select(*keys, order, *ties, price, F.col("__fill").alias("filled_price")))
    if before is not None:
        renamed = own_keys.select(*[F.col(k).alias(f"__s_{k}") for k in keys])
        tail = tail.unionByName(before.drop("batch_id").join(renamed, same, "left_anti"))
    # what an earlier try made would push the state before the batch out of the kept versions
    for v in made:
        remove_path(spark, state.path(v))
    state.commit(tail.withColumn("batch_id", F.lit(batch_id)))
    return out.where("__new").drop(*marks)


def _state_before(state: Table, batch_id: str) -> tuple[DataFrame | None, list[int]]:
    """The state that a batch continues from, and the versions after it that the batch itself made."""
    if state.partition_by or state.keep_versions < 2:
        raise ValueError("the state is an unpartitioned table that keeps two versions")
    own = []
    for v in reversed(state.versions()):
        found = state.spark.read.parquet(state.path(v))
        made = found.select("batch_id").limit(1).collect()
        if not made or made[0][0] != batch_id:
            return found, own
        own.append(v)
    return None, own


def _long_series(df: DataFrame, keys: list[str], R: int):
    """Keys (as ``_h_<key>``) whose series holds more than ``R`` rows, and how
    many there are; a NULL key is a series of its own."""
    t = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > R)
         .select(*[F.col(k).alias(f"_h_{k}") for k in keys]))
    out = staged(t, "long_series")
    return out, out.count()


def _count_table(data: DataFrame, keys: list[str], order: str, price: Column | str, tie_break: tuple,
                 R: int, halo: int):
    """Block placement per (key, bucket) cell of the keys whose series holds
    more than one block (``R`` rows), written once; returns it with the rows
    of its largest cell.

    A series of at most ``R`` rows is one block: it needs no placement, halo
    or carry, so its cells are left out.  There are at most (rows / R) such
    long series, which keeps this table small however many keys there are.
    """
    price = F.col(price) if isinstance(price, str) else price
    cells = data.groupBy(*keys, "_bkt").agg(
        F.count(F.lit(1)).alias("_n"),
        F.max_by(price, F.when(price.isNotNull(),
                               F.struct(F.col(order), *[F.col(c) for c in tie_break])))
        .alias("_lastp"))
    sw = Window.partitionBy(*keys).orderBy("_bkt")
    before = sw.rowsBetween(Window.unboundedPreceding, -1)
    stats = cells.withColumns({
        "_q": F.coalesce(F.sum("_n").over(before), F.lit(0)),
        "_carry": F.last("_lastp", ignorenulls=True).over(before),
        "_tot": F.sum("_n").over(sw.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    }).where(F.col("_tot") > R)
    end = F.col("_q") + F.col("_n")
    own = F.floor(F.col("_q") / R)
    lo = F.greatest(own + 1, F.floor(end / R))
    hi = F.floor((end + F.lit(halo - 1)) / R)
    stats = stats.select(
        *[F.col(k).alias(f"_s_{k}") for k in keys], F.col("_bkt").alias("_s_bkt"),
        own.alias("_own"), lo.alias("_lo"), hi.alias("_hi"), "_carry", "_n")
    stats = staged(stats, "count_table")
    biggest = stats.agg(F.max("_n")).first()[0]
    return stats.drop("_n"), int(biggest or 0)


def _out_names(ma_windows, vol_window, rsi_period):
    return (["daily_return"] + [f"moving_avg_{n}d" for n in ma_windows]
            + [f"volatility_{vol_window}d", f"rsi_{rsi_period}d"])
