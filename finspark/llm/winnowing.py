"""Document fingerprints by winnowing.

Every run of ``gram`` code points (A-Z folded) has a rolling hash; of each
``window`` consecutive hashes the smallest is chosen, the rightmost of equal
ones, and kept with its position.  Any passage of at least
``gram + window - 1`` code points that two texts share therefore gives both a
common hash, and the positions say where; shorter than ``gram`` never matches
by itself.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finspark.llm.common import RANGE_BYTES, bucket_of, range_bounds, text_rows, text_slices

GRAM = 16
WINDOW = 49
_CHUNK = 1 << 18  # windows of a long text taken at a time
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_LOW = np.uint64(0xFFFFFFFF)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


@lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = np.full(n, _BASE, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _rolling(cps: np.ndarray, gram: int) -> np.ndarray:
    """32-bit hashes of all grams, from prefix sums of a polynomial modulo 2^64."""
    n = len(cps)
    up, down = _powers(1 << max(12, n.bit_length()))
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((cps + np.uint64(1)) * up[:n], out=prefix[1:])
    h = (prefix[gram:] - prefix[:-gram]) * down[:n - gram + 1]
    h ^= h >> np.uint64(29)
    return (h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)


def _window_minima(keys: np.ndarray, window: int) -> np.ndarray:
    """Minimum of every window, from running minima within blocks to the left and to the right."""
    n = len(keys)
    blocks = -(-n // window)
    grid = np.full(blocks * window, _NONE, np.uint64)
    grid[:n] = keys
    grid = grid.reshape(blocks, window)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n - window + 1], left[window - 1:n])


def winnow(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) chosen from a text, by position; both unsigned 32-bit.

    The empty text has none; a text shorter than a gram is one gram; with fewer
    grams than a window the smallest of all is chosen.
    """
    cps = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = len(cps)
    if not n:
        return np.zeros(0, np.uint32), np.zeros(0, np.uint32)
    cps[(cps >= 65) & (cps <= 90)] += np.uint64(32)
    gram = min(gram, n)
    grams = n - gram + 1
    window = min(window, grams)
    chosen, last = [], _NONE
    for a in range(0, grams - window + 1, _CHUNK):
        b = min(grams - window + 1, a + _CHUNK)  # windows a..b
        h = _rolling(cps[a:b + window + gram - 2], gram)
        # the smallest key is the smallest hash at its rightmost position
        at = np.arange(a, a + len(h), dtype=np.uint64)
        low = _window_minima(h << np.uint64(32) | (_LOW - at), window)
        new = np.empty(len(low), bool)
        new[0] = low[0] != last
        np.not_equal(low[1:], low[:-1], out=new[1:])
        chosen.append(low[new])
        last = low[-1]
    keys = np.concatenate(chosen)
    return (keys >> np.uint64(32)).astype(np.uint32), (_LOW - (keys & _LOW)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of common hashes among all hashes of two fingerprints (two empty ones: 1)."""
    a, b = np.unique(a), np.unique(b)
    common = len(np.intersect1d(a, b, assume_unique=True))
    every = len(a) + len(b) - common
    return common / every if every else 1.0


def _packed(hashes: np.ndarray, positions: np.ndarray) -> bytes:
    """Eight bytes for each choice: hash, then position, both big-endian."""
    return np.column_stack((hashes, positions)).astype(">u4").tobytes()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """(doc_id, hashes, positions) per document row, arrays of long.

    Null is the empty text, without hashes; repeated rows each give a row.
    """
    rows = text_rows(docs, id_col, text_col)
    kind = pa.list_(pa.int64())

    def run(batches):
        for batch in text_slices(batches):
            got = [winnow(t or "", gram, window) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([h.astype(np.int64) for h, _ in got], kind),
                 pa.array([p.astype(np.int64) for _, p in got], kind)], ["doc_id", "hashes", "positions"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, "
                                "hashes array<long>, positions array<long>")


def _followed(docs: DataFrame, id_col: str, text_col: str, bytes_per_range: int) -> DataFrame:
    """Rows dealt into ranges of descending doc_id, sorted, each range ended by the row that follows it.

    The text moves once.  The first rows of the ranges (one id each) are all
    that the driver sees.
    """
    rows = text_rows(docs, id_col, text_col)
    bounds = range_bounds(rows, bytes_per_range)
    id_type = rows.schema["doc_id"].dataType
    own = rows.withColumn("bucket", F.when(F.col("doc_id").isNotNull(), bucket_of("doc_id", bounds, id_type))
                          .otherwise(F.pmod(F.xxhash64("text"), F.lit(len(bounds) + 1)).cast("int")))
    heads = (own.where("doc_id IS NOT NULL").groupBy("bucket").agg(F.max("doc_id").alias("doc_id"))
             .orderBy("bucket").collect())
    # the first row of a range follows the range above it, the very first the lowest
    above = [r["bucket"] for r in heads[1:]] + [r["bucket"] for r in heads[:1]]
    spark = docs.sparkSession
    kind = rows.schema["doc_id"].dataType.simpleString()
    extra = spark.createDataFrame([(r["doc_id"], b) for r, b in zip(heads, above)], f"doc_id {kind}, above int")
    both = own.join(F.broadcast(extra), "doc_id", "left").select(
        "doc_id", "text", F.explode(F.array_compact(F.array(
            F.struct(F.col("bucket"), F.lit(False).alias("after")),
            F.when(F.col("above").isNotNull(), F.struct(F.col("above").alias("bucket"), F.lit(True).alias("after"))),
        ))).alias("at"))
    dealt = both.select("at.bucket", "at.after", "doc_id", "text")
    return (dealt.repartitionById(len(bounds) + 1, "bucket")  # one range, one task
            .sortWithinPartitions("bucket", F.col("doc_id").isNotNull(), "after", F.col("doc_id").desc(), "text"))


def edited_text(text: str, following: str) -> str:
    """The last half of the code points (rounded down) replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM,
                   window: int = WINDOW, bytes_per_range: int = RANGE_BYTES) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The next document is that of the next smaller doc_id (after the smallest:
    the largest; a lone document follows itself).  Per document row: doc_id,
    n_chars, edited_sha256, selected and edited_selected (binary: hash and
    position of each choice), near_edited and near_next (0 to 1).

    Null is the empty text.  Rows that repeat a doc_id follow each other by
    text.  A row without doc_id has no next document: an empty one is taken.
    """
    ordered = _followed(docs, id_col, text_col, bytes_per_range)
    kind = ordered.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_chars", "edited_sha256", "selected", "edited_selected", "near_edited", "near_next"]

    def run(batches):
        held = id_type = None  # held: (bucket, doc_id, text, hashes, positions) of the row before

        def finish(following: str, hashes: np.ndarray):
            _, doc_id, text, own, at = held
            edited = edited_text(text, following)
            other, other_at = winnow(edited, gram, window)
            return (doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                    _packed(own, at), _packed(other, other_at), likeness(own, other), likeness(own, hashes))

        for batch in text_slices(batches):
            out = []
            for bucket, after, doc_id, text in zip(*(batch.column(c).to_pylist()
                                                     for c in ("bucket", "after", "doc_id", "text"))):
                text = text or ""
                if after and held is None:
                    continue  # further rows that repeat the first doc_id of the next range
                row = (bucket, doc_id, text, *winnow(text, gram, window))
                if held is not None:
                    alone = doc_id is None or held[1] is None or held[0] != bucket
                    out.append(finish("" if alone else text, row[3][:0] if alone else row[3]))
                held = None if after else row
            id_type = batch.schema.field("doc_id").type
            if out:
                yield as_batch(out, id_type)
        if held is not None:
            yield as_batch([finish("", np.zeros(0, np.uint32))], id_type)

    def as_batch(out, id_type):
        kinds = [id_type, pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return ordered.mapInArrow(run, f"doc_id {kind}, n_chars long, edited_sha256 string, selected binary, "
                                   "edited_selected binary, near_edited double, near_next double")
