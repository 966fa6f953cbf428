"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The alphabet is words, a block is two consecutive words.  Patterns are the
windows of 13 consecutive words of each benchmark item (an item of fewer
words is one pattern).  Patterns of one length share a shift table (how far
the search may jump after seeing a block), suffix buckets (patterns that end
in the block) split by their first block, and a direct comparison of words.

Documents are scanned in place: no shuffle, no join.  The patterns are a
stated query set, taken in blocks of at most ``max_patterns`` (window, item)
pairs and ``MAX_BYTES`` of text, which bounds what a task holds; each block
scans all documents.  Words are integers in the tables, which a Python worker
builds once.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finspark.llm.common import byte_texts, text_rows, text_slices

WINDOW = 13
MAX_PATTERNS = 500_000
MAX_BYTES = 64 << 20

# Fixed by the matching rule: A-Z become a-z; 0-9, a-z and all bytes of
# non-ASCII characters belong to words; every other byte ends a word.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))

_PATTERN_SCHEMA = "item_id string, pattern string"
_HIT_SCHEMA = ("doc_id {id}, n_words long, n_hit long, items array<string>, "
               "spans array<struct<first:long,last:long>>, copy_key binary")


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


class Patterns:
    """Distinct (item, pattern) pairs in a compact form: words as integers, one matrix per pattern length."""

    def __init__(self, pairs: list[tuple[str, bytes]]):
        items: dict[bytes, list[str]] = {}
        for item, pattern in pairs:
            items.setdefault(pattern, []).append(item)
        number: dict[bytes, int] = {}
        by_length = defaultdict(list)
        for pattern in sorted(items):
            row = [number.setdefault(w, len(number)) for w in pattern.split(b" ")]
            by_length[len(row)].append((row, pattern))
        self.words = list(number)
        self.names = sorted({n for own in items.values() for n in own})
        place = {n: i for i, n in enumerate(self.names)}
        # per length: word numbers of each pattern; where its items start, and the items
        self.groups = []
        for m in sorted(by_length):
            own = [[place[n] for n in items[p]] for _, p in by_length[m]]
            self.groups.append((np.array([r for r, _ in by_length[m]], np.int32).reshape(-1, m),
                                np.cumsum([0, *map(len, own)]).astype(np.int32),
                                np.array([x for o in own for x in o], np.int32)))


class WuManber:
    """Search tables over ``Patterns``; ``find`` yields (first, last, items).

    A table per pattern length maps a block (the numbers of two words as one
    integer) to how far the search may jump, or, negative, to the bucket of the
    patterns that end in it.  A bucket is a range of the matrix, sorted by
    first block.
    """

    def __init__(self, patterns: Patterns):
        self._number = {w: i for i, w in enumerate(patterns.words)}
        self._names = patterns.names
        self._groups = [self._tables(*g) for g in patterns.groups]

    @staticmethod
    def _tables(rows: np.ndarray, starts: np.ndarray, items: np.ndarray):
        n, m = rows.shape
        size = min(2, m)  # words in a block
        block = rows.astype(np.int64) if size == 1 else rows[:, :-1].astype(np.int64) << 32 | rows[:, 1:]
        # the smallest jump of each block: its last place in any pattern
        keys, jumps = block.ravel(), np.tile(np.arange(m - size, -1, -1), n)
        order = np.lexsort((jumps, keys))
        keys, jumps = keys[order], jumps[order]
        new = np.concatenate(([True], keys[1:] != keys[:-1]))
        keys, jumps = keys[new], jumps[new]
        by = np.lexsort((block[:, 0], block[:, -1]))
        last = block[by, -1]
        bounds = np.flatnonzero(np.concatenate(([True], last[1:] != last[:-1], [True])))
        # both tables ascend by block, so buckets follow the blocks with no jump
        jumps[jumps == 0] = -1 - np.arange(len(bounds) - 1)
        shift = dict(zip(keys.tolist(), jumps.tolist()))
        return m, size, shift, bounds, block[by, 0], rows[by], by, starts, items

    def find(self, text: list[bytes]) -> Iterator[tuple[int, int, list[str]]]:
        number = self._number.get  # words are numbered where the search looks, most are jumped over
        for m, size, shift, bounds, first_block, rows, by, starts, items in self._groups:
            skip, n, i = m - size + 1, len(text), m - 1
            jump = shift.get
            while i < n:
                end = number(text[i], -1)
                if end < 0:  # a word of no pattern
                    i += m
                    continue
                step = jump(number(text[i - 1], -1) << 32 | end, skip) if size == 2 else jump(end, skip)
                if step > 0:
                    i += step
                    continue
                low, high = bounds[-1 - step], bounds[-step]
                first = i - m + 1
                own = [number(w, -1) for w in text[first:i + 1]]
                head, bucket = own[0] << 32 | own[1] if size == 2 else own[0], first_block[low:high]
                for p in range(low + bucket.searchsorted(head), low + bucket.searchsorted(head, "right")):
                    if rows[p].tolist() == own:
                        k = by[p]
                        yield first, i, [self._names[x] for x in items[starts[k]:starts[k + 1]]]
                i += 1


_built: dict[str, WuManber] = {}


def _tables_of(key: str, held) -> WuManber:
    """The tables of a broadcast, built once per Python worker."""
    if key not in _built:
        _built.clear()
        _built[key] = WuManber(held.value)
    return _built[key]


def _windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        ids, out = [], []
        for item, text in zip(batch.column("doc_id").to_pylist(), byte_texts(batch)):
            w = words(text)
            found = {b" ".join(w[i:i + window]) for i in range(max(1, len(w) - window + 1))} if w else ()
            ids += [item] * len(found)
            out += [x.decode("utf-8", "replace") for x in found]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(out, pa.string())],
                                         ["item_id", "pattern"])


def benchmark_patterns(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                       window: int = WINDOW) -> DataFrame:
    """Distinct (item_id, pattern) pairs; a null item_id is named by the empty string."""
    rows = text_rows(benchmark, id_col, text_col).withColumn(
        "doc_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return rows.mapInArrow(lambda it: _windows(it, window), _PATTERN_SCHEMA).distinct()


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _hit_batch(ids: pa.Array, n_words, spans, items, keys, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        ids, pa.array(n_words, pa.int64()),
        pa.array([sum(b - a + 1 for a, b in s) for s in spans], pa.int64()),
        pa.array([sorted(i) for i in items], schema.field("items").type),
        pa.array([[{"first": a, "last": b} for a, b in s] for s in spans], schema.field("spans").type),
        pa.array(keys, pa.binary())], names=schema.names)


def _arrow_schema(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("doc_id", id_type), ("n_words", pa.int64()), ("n_hit", pa.int64()),
                      ("items", pa.list_(pa.string())),
                      ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
                      ("copy_key", pa.binary())])


def _broadcast(patterns: DataFrame):
    """One block of pairs, which its bytes bound, in its compact form; and a name for it."""
    held = Patterns([(r["item_id"], r["pattern"].encode()) for r in patterns.collect()])
    return uuid.uuid4().hex, patterns.sparkSession.sparkContext.broadcast(held)


def _scan(docs: DataFrame, patterns: DataFrame, keyed: bool) -> DataFrame:
    key, held = _broadcast(patterns)

    def search(batches):
        tables = _tables_of(key, held)
        for batch in text_slices(batches):
            n_words, spans, items, keys = [], [], [], []
            for text in byte_texts(batch):
                w = words(text)
                found, who = set(), set()
                for first, last, names in tables.find(w):
                    found.add((first, last))
                    who.update(names)
                n_words.append(len(w))
                spans.append(_merged(list(found)))
                items.append(who)
                keys.append(hashlib.sha256(text).digest() if keyed else None)
            ids = batch.column("doc_id")
            yield _hit_batch(ids, n_words, spans, items, keys, _arrow_schema(ids.type))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(search, _HIT_SCHEMA.format(id=kind))


def _union(parts: DataFrame) -> DataFrame:
    """Hits of several pattern blocks to one row per document row (copies of a row stay)."""
    kind = parts.schema["doc_id"].dataType.simpleString()

    def merge(batches):
        for batch in batches:
            rows = batch.to_pylist()
            ids = batch.column("doc_id")
            yield _hit_batch(ids, [r["n_words"] for r in rows],
                             [_merged([(s["first"], s["last"]) for s in r["spans"]]) for r in rows],
                             [set(r["items"]) for r in rows], [r["copy_key"] for r in rows],
                             _arrow_schema(ids.type))

    one = (parts.groupBy("doc_id", "copy_key")
           .agg(F.max("n_words").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
                F.flatten(F.collect_list("items")).alias("items"),
                F.flatten(F.collect_list("spans")).alias("spans"),
                F.sum(F.when(F.col("block") == 0, 1).otherwise(0)).alias("copies"))
           .withColumn("copy", F.explode(F.expr("sequence(1, copies)"))))
    return (one.select("doc_id", "n_words", "n_hit", "items", "spans", "copy_key")
            .mapInArrow(merge, _HIT_SCHEMA.format(id=kind)))


def is_contaminated(n_words, n_hit):
    """The rule, for columns and numbers alike: some word is hit, and at least a twentieth."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, max_patterns: int):
    """The pattern pairs, in how many blocks they come, and the block of a pair."""
    pairs = benchmark_patterns(benchmark, item_col, text_col, window)
    n, size = pairs.agg(F.count(F.lit(1)), F.sum(F.octet_length("pattern") + F.octet_length("item_id"))).first()
    blocks = max(1, -(-n // max_patterns), -(-(size or 0) // MAX_BYTES))
    return pairs, blocks, F.pmod(F.xxhash64("item_id", "pattern"), F.lit(blocks))


def _hits(rows: DataFrame, pairs: DataFrame, blocks: int, block) -> DataFrame:
    """Hits of all pattern blocks, one row per document row; copy_key is the text's digest if blocks are several."""
    found = None
    for b in range(blocks):
        part = pairs if blocks == 1 else pairs.where(block == b)
        hits = _scan(rows, part, keyed=blocks > 1)
        hits = hits.withColumn("block", F.lit(b))
        found = hits if found is None else found.unionAll(hits)
    return found.drop("block") if blocks == 1 else _union(found)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  max_patterns: int = MAX_PATTERNS) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, items (sorted strings),
    spans (merged ranges of hit words), contaminated.

    ``contaminated``: some word is hit and hit words are at least a twentieth.
    A null or empty text has no words and no hits; an empty benchmark hits
    nothing; repeated rows each give a row; items with equal ids count once.
    """
    rows = text_rows(docs, id_col, text_col)
    out = _hits(rows, *_blocks(benchmark, item_col, item_text_col, window, max_patterns))
    return out.drop("copy_key").withColumn("contaminated", is_contaminated(F.col("n_words"), F.col("n_hit")))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                         max_patterns: int = MAX_PATTERNS) -> DataFrame:
    """The document rows that are not contaminated, with all their columns.

    Every row is judged by its own text.  One block of patterns filters rows
    where they are; with more blocks the hits are joined back by the digest of
    the text, which alone decides, so ids may be null or repeated.
    """
    pairs, blocks, block = _blocks(benchmark, item_col, item_text_col, window, max_patterns)
    if blocks > 1:
        hits = _hits(text_rows(docs, id_col, text_col), pairs, blocks, block)
        taken, name = {c.lower() for c in docs.columns}, "_found"
        while name in taken:
            name += "_"
        found = hits.where(is_contaminated(F.col("n_words"), F.col("n_hit"))).select(F.col("copy_key").alias(name))
        digest = F.unhex(F.sha2(F.col(f"`{text_col}`").cast("string").cast("binary"), 256))
        return docs.join(found, digest == F.col(name), "left_anti")
    key, held = _broadcast(pairs)

    def keep(batches):
        tables = _tables_of(key, held)
        for batch in text_slices(batches, text_col):
            clean = []
            for text in byte_texts(batch, text_col):
                w = words(text)
                hit = sum(b - a + 1 for a, b in _merged([(a, b) for a, b, _ in tables.find(w)]))
                clean.append(not is_contaminated(len(w), hit))
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(keep, docs.schema)
