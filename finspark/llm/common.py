"""Helpers shared by the document operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finspark.session import checkpoint_dir

#: Text bytes that a Python worker holds at once (a longer text is a slice of its own).
SLICE_BYTES = 4 << 20
#: Text bytes of a range of ids that one task takes.
RANGE_BYTES = 64 << 20


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) alone, so other columns of any name never meet an operator's own."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
                max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches into slices of about ``max_bytes`` of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes, dtype=np.int64) // max_bytes
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def byte_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The UTF-8 bytes of each text; null gives the empty text."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def fold(id_col: str, modulus: int):
    """crc32 of the id's text, modulo ``modulus`` (null for a null id)."""
    return F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % modulus


def range_bounds(rows: DataFrame, bytes_per_range: int) -> list:
    """The largest doc_id of all ranges but the last, ascending: ranges of about equal rows of a
    ``text_rows`` table, enough for ``bytes_per_range`` of text each.

    Spark samples the ids and deals them into ranges; one id a range, as many
    as the shuffle that follows has partitions, comes to the driver.
    """
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(least, -(-size // bytes_per_range))
    ids = rows.select("doc_id").where("doc_id IS NOT NULL").repartitionByRange(ranges, "doc_id")
    ends = ids.groupBy(F.spark_partition_id().alias("range")).agg(F.max("doc_id").alias("last")).collect()
    return sorted(r["last"] for r in ends)[:-1]


def bucket_of(id_col: str, bounds: list, id_type):
    """How many bounds lie below the id: its range, by a search in two levels."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    array = lambda values: F.lit(values).cast(f"array<{id_type.simpleString()}>")
    below = lambda b: b < F.col(id_col)
    coarse = F.size(F.filter(array(bounds[step - 1::step]), below)) if len(bounds) >= step else F.lit(0)
    fine = F.size(F.filter(F.slice(array(bounds), coarse * step + 1, F.lit(step)), below))
    return (coarse * step + fine).cast("int")
