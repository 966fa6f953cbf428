"""T4 enrichment: left lookup joins (J1-J4) and derived columns (P3, UD2)."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


@dataclass
class Lookup:
    """A lookup table joined on one column of the same name on both sides.

    The planner broadcasts it by its size in bytes, or AQE by its real
    shuffle size (``spark.sql.autoBroadcastJoinThreshold``).
    """
    name: str
    df: DataFrame
    key: str = "id"
    null_safe: bool = True


def lookup_join(df: DataFrame, lk: Lookup) -> DataFrame:
    """Left join; colliding right columns get ``_<name>``; missing keys
    match each other (like a pandas merge); duplicate lookup keys fan out."""
    if lk.key not in df.columns:
        log.warning("lookup %s skipped: key %s not in frame", lk.name, lk.key)
        return df
    right = lk.df
    ren = {c: f"{c}_{lk.name}" for c in right.columns if c != lk.key and c in df.columns}
    rkey = f"__lk_{lk.name}_{lk.key}"
    right = right.withColumnsRenamed({**ren, lk.key: rkey})
    cond = (F.col(lk.key).eqNullSafe(F.col(rkey)) if lk.null_safe
            else F.col(lk.key) == F.col(rkey))
    return df.join(right, cond, "left").drop(rkey)


def add_derived(df: DataFrame, derived: dict) -> DataFrame:
    """Derived columns in declaration order; later ones may use earlier ones.

    Each value is a Column or a callable ``DataFrame -> Column``.  One that
    fails analysis is logged and skipped, the rest still apply.
    """
    for name, spec in (derived or {}).items():
        try:
            expr = spec if isinstance(spec, Column) else spec(df)
            df = df.withColumn(name, expr)
        except (AnalysisException, TypeError, ValueError) as e:
            log.error("derived column %s failed: %s", name, str(e).splitlines()[0])
    return df


def enrich(df: DataFrame, lookups: Iterable[Lookup] = (), derived: dict | None = None) -> DataFrame:
    """T4: lookups applied in turn, then derived columns."""
    for lk in lookups:
        df = lookup_join(df, lk)
    return add_derived(df, derived or {})


def pandas_column(fn: Callable, return_type: str, *cols: str) -> Callable[[DataFrame], Column]:
    """UD2 fallback: a frame -> column callable backed by a vectorized pandas UDF.

    ``fn`` receives one pandas Series per named column (Arrow batches) and
    returns a Series.  Use only when built-in expressions cannot express it.
    """
    udf = F.pandas_udf(fn, return_type)
    return lambda df: udf(*[F.col(c) for c in cols])
