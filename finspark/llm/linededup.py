"""Repeated lines: a sharded minimal perfect hash of line hashes, probed by documents.

A line's key is the line without white space at its ends, A-Z folded.  The
128-bit hashes of long keys are counted over all documents; those that at
least two documents hold go into shards.  A shard has a minimal perfect hash
(levels of bit arrays) that numbers its keys without gaps, and arrays by that
number: a 64-bit fingerprint, the count of documents, and the largest doc_id.
Documents look their lines up in the arrays; no line is joined with another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finspark.llm.common import text_rows, text_slices
from finspark.llm.shards import make_folder, read_shard, write_shard
from finspark.session import scratch_path, staged

MIN_CHARS = 40
MIN_DOCS = 5
KEYS_PER_SHARD = 1 << 19
#: Text bytes of documents that are looked up together, shard by shard.
PROBE_BYTES = 32 << 20
_BLANK = " \t\n\v\f\r"
_GAMMA = 2.0  # bits of a level for each key that is left
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _place(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
    """The bit that a key asks for in a level of ``size`` bits."""
    salt = np.uint64((level + 1) * int(_STEP) & 0xFFFFFFFFFFFFFFFF)
    return _mix(high ^ _mix(low + salt)) % np.uint64(size)


class MinimalHash:
    """Numbers 0..n-1 for n distinct 128-bit keys, without gaps.

    In each level a key that has its bit for itself sets it; the others go to
    the next level.  A key's number is how many bits are set before its own.
    """

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray) -> MinimalHash:
        sizes, parts, left = [], [], np.arange(len(high))
        while len(left):
            if len(sizes) == 256:
                raise ValueError("keys repeat")
            size = -(-int(_GAMMA * len(left) + 1) // 64) * 64
            at = _place(high[left], low[left], len(sizes), size)
            asked = np.bincount(at, minlength=size)
            parts.append(np.packbits(asked == 1, bitorder="little").view("<u8"))
            sizes.append(size)
            left = left[asked[at] > 1]
        return cls(np.array(sizes, np.int64), np.concatenate(parts) if parts else np.zeros(0, np.uint64))

    def numbers(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The number of each key; a key of no level gets -1, a foreign key -1 or any number."""
        out, left, base = np.full(len(high), -1, np.int64), np.arange(len(high)), 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            at = _place(high[left], low[left], level, size).astype(np.int64) + base
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            here = (word >> bit) & np.uint64(1) == 1
            under = word & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[here]] = (self.before[at >> 6] + np.bitwise_count(under))[here]
            left, base = left[~here], base + size
        return out


class Shard:
    """A shard as read: the hash and its arrays."""

    def __init__(self, batch: pa.RecordBatch):
        column = lambda name: batch.column(name)[0].values
        self.hash = MinimalHash(column("sizes").to_numpy(), column("words").to_numpy())
        self.fingerprint, self.count = column("fingerprint").to_numpy(), column("count").to_numpy()
        self.keeper = column("keeper")


def _shard_batch(high: np.ndarray, low: np.ndarray, count: np.ndarray, keeper: pa.Array) -> pa.RecordBatch:
    own = MinimalHash.build(high, low)
    order = np.empty(len(high), np.int64)
    order[own.numbers(high, low)] = np.arange(len(high))
    small = np.uint32 if count.max() < 1 << 32 else np.uint64
    columns = {"sizes": pa.array(own.sizes), "words": pa.array(own.words), "fingerprint": pa.array(low[order]),
               "count": pa.array(count[order].astype(small)), "keeper": keeper.take(pa.array(order))}
    return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays([0, len(c)], c) for c in columns.values()],
                                      list(columns))


def _lines(texts: pa.Array) -> pa.ListArray:
    return pc.split_pattern(pc.fill_null(texts, ""), "\n")


def _long_keys(lines: pa.ListArray, min_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """(line numbers within the flattened list, hashes as two columns) of the long keys."""
    keys = pc.ascii_lower(pc.ascii_trim(lines.flatten(), _BLANK))
    which = np.flatnonzero(pc.greater_equal(pc.utf8_length(keys), min_chars).to_numpy(zero_copy_only=False))
    chosen = keys.take(pa.array(which)).cast(pa.binary()).to_pylist()
    digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, chosen)), "<u8").reshape(-1, 2)
    return which, digests


def line_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_CHARS) -> DataFrame:
    """(high, low, n, keeper): per hash of a long key how many rows hold it and their largest doc_id.

    A row counts once however often it holds a key; counts are summed before
    the shuffle, so a line of all documents is one row a task.
    """
    rows = text_rows(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in text_slices(batches):
            lines = _lines(batch.column("text"))
            which, digests = _long_keys(lines, min_chars)
            parent = pc.list_parent_indices(lines).to_numpy()[which]
            held = pa.table({"row": parent, "high": digests[:, 0].view(np.int64), "low": digests[:, 1].view(np.int64)})
            held = held.group_by(["row", "high", "low"], use_threads=False).aggregate([]).combine_chunks()
            if held.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [held["high"].chunk(0), held["low"].chunk(0), batch.column("doc_id").take(held["row"].chunk(0))],
                    ["high", "low", "doc_id"])

    held = rows.mapInArrow(run, f"high long, low long, doc_id {kind}")
    return held.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"))


def _shard_of(high: np.ndarray, shards: int) -> np.ndarray:
    return ((high >> np.uint64(1)) % np.uint64(shards)).astype(np.int64)


def build_index(counts: DataFrame, folder: str, keys_per_shard: int = KEYS_PER_SHARD) -> tuple[int, frozenset]:
    """Write the shards of ``line_counts`` rows that at least two rows hold; returns how many there
    are and which of them have keys (one number a shard).

    A line of one document can never be dropped, so it is left out.  Shards
    are dealt by hash, so each has about ``keys_per_shard`` keys at any size.
    """
    keys = staged(counts.where("n > 1"), "line_keys")
    shards = -(-keys.count() // keys_per_shard)
    if not shards:
        return 0, frozenset()
    make_folder(folder)

    def run(table):
        table = table.combine_chunks()
        high, low = (table[c].to_numpy().view(np.uint64) for c in ("high", "low"))
        keeper = table["keeper"].chunk(0)
        shard = int(_shard_of(high[:1], shards)[0])
        write_shard(folder, shard, _shard_batch(high, low, table["n"].to_numpy(), keeper))
        return pa.table({"shard": [shard]})

    written = (keys.withColumn("shard", F.shiftrightunsigned("high", 1) % shards).groupBy("shard")
               .applyInArrow(run, "shard long").collect())
    return shards, frozenset(r["shard"] for r in written)


def _groups(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Slices put together to about ``most`` bytes of text."""
    held, size = [], 0
    for piece in text_slices(batches, max_bytes=most):
        held.append(piece)
        size += piece.column("text").nbytes
        if size >= most:
            yield from _whole(held)
            held, size = [], 0
    yield from _whole(held)


def _whole(held: list[pa.RecordBatch]):
    if held:
        yield pa.concat_batches(held)


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                        min_docs: int = MIN_DOCS, keys_per_shard: int = KEYS_PER_SHARD) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped): every text without its repeated lines.

    A key of at least ``min_chars`` code points that at least ``min_docs`` (two
    or more) rows hold loses all its lines but those of the row with the
    largest doc_id; the lines that are left are joined by line ends.

    Null and empty texts are one empty line and give ''.  Each row is a
    document: rows that repeat a doc_id count singly, and all of those with the
    largest doc_id keep their lines.  A row without doc_id is the smallest; if
    only such rows hold a key, they keep it.  Lines are compared by 128 bits.
    A row of more than ``PROBE_BYTES`` is looked up by itself.

    Reads ``docs`` twice.  The shards are written to the shared folder before
    this returns; a task reads all of them, one at a time.
    """
    if min_docs < 2:
        raise ValueError("min_docs must be at least 2")
    folder = scratch_path(docs.sparkSession, "line_index")
    shards, written = build_index(line_counts(docs, id_col, text_col, min_chars), folder, keys_per_shard)
    rows = text_rows(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def repeated(digests: np.ndarray, own: pa.Array) -> np.ndarray:
        """Whether each line goes; ``own`` has the doc_id of its row."""
        out = np.zeros(len(digests), bool)
        part = _shard_of(digests[:, 0], shards) if shards else np.zeros(0, np.int64)
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange(shards + 1))
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            if s not in written:
                continue
            at = order[cuts[s]:cuts[s + 1]]
            shard = read_shard(folder, s, Shard)
            number = shard.hash.numbers(digests[at, 0], digests[at, 1])
            number[number >= 0] = np.where(shard.fingerprint[number] == digests[at, 1], number, -1)[number >= 0]
            at, number = at[number >= 0], number[number >= 0]
            common = shard.count[number] >= min_docs
            at, number = at[common], pa.array(number[common])
            keeper, mine = shard.keeper.take(number), own.take(pa.array(at))
            # a key whose keeper is null is held by rows without doc_id alone
            keeps = pc.or_kleene(pc.is_null(keeper), pc.fill_null(pc.equal(keeper, mine), False))
            out[at] = ~keeps.to_numpy(zero_copy_only=False)
        return out

    def run(batches):
        for batch in _groups(batches, PROBE_BYTES):
            ids, lines = batch.column("doc_id"), _lines(batch.column("text"))
            parent = pc.list_parent_indices(lines).to_numpy()
            flat = lines.flatten()
            which, digests = _long_keys(lines, min_chars)
            goes = which[repeated(digests, ids.take(pa.array(parent[which])))]
            left = np.ones(len(flat), bool)
            left[goes] = False
            kept = np.concatenate(([0], np.cumsum(np.bincount(parent[left], minlength=len(lines))))).astype(np.int32)
            text = pc.binary_join(pa.ListArray.from_arrays(kept, flat.filter(pa.array(left))), "\n")
            dropped = np.bincount(parent[goes], minlength=len(lines))
            yield pa.RecordBatch.from_arrays(
                [ids, text, pc.list_value_length(lines).cast(pa.int64()), pa.array(dropped, pa.int64())],
                ["doc_id", "text", "n_lines", "n_dropped"])

    return rows.mapInArrow(run, f"doc_id {kind}, text string, n_lines long, n_dropped long")
