"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A 64-bit fingerprint is eight positional bytes.  Two fingerprints that differ
in at most d bits share at least 8 - d of them, so they meet under some choice
of 8 - d positions.  The index posts every distinct fingerprint under each
such choice (28 of them for d = 2).  A posting list fixes 8 - d bytes, hence
holds at most 256^d distinct fingerprints whatever the data are; an index of
single bytes would have 2048 lists that each hold 1/256 of the corpus.  The
key of a list thereby guarantees the minimum count, so a tally of shared bytes
rejects nothing there, and the bits decide.  Lists of up to ``_ALL_PAIRS`` form
all pairs, longer ones look up each fingerprint with up to d bits of the d left
out bytes flipped, which does not grow with the square.  A pair is judged in the
first list that holds it, and a list gives a spanning forest of its links, so
links never outnumber postings.

Exact copies share a fingerprint and are grouped before the index.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate, combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finspark.llm.common import byte_texts, materialize, text_rows, text_slices
from finspark.llm.components import connected_components, hot_join

SHINGLE = 3
MAX_BITS = 2
SEED = 42
_CHUNK = 1 << 16  # shingles hashed at a time
_ALL_PAIRS = 128  # up to this list length pairs are formed directly
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_ONES = _BITS.sum(axis=1)


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash (signed) of the word shingles of a UTF-8 text; 0 without words.

    A-Z are lower-cased, words end at ASCII white space, a text of fewer words
    than a shingle is one shingle, repeated shingles count each time.
    """
    words = text.lower().split()  # bytes: ASCII rules only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda at, n: at + 1 + n, initial=-1))
    n = max(1, len(words) - shingle + 1)
    width = min(shingle, len(words))
    count = np.zeros((8, 8), np.int64)
    for a in range(0, n, _CHUNK):
        b = min(n, a + _CHUNK)
        cuts = map(slice, [e + 1 for e in ends[a:b]], ends[a + width:b + width])
        digests = b"".join(map(xxhash.xxh64_digest, map(joined.__getitem__, cuts), repeat(SEED)))
        hashes = np.frombuffer(digests, np.uint8).reshape(-1, 8)
        if len(hashes) < 1500:
            count += np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.int64).reshape(8, 8)
        else:
            for k in range(8):
                count[k] += np.bincount(hashes[:, k], minlength=256) @ _BITS
    return int.from_bytes(np.packbits(count.ravel() * 2 > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE, keyed: bool = False) -> DataFrame:
    """(doc_id, fp long) for every document row; with ``keyed`` also digest, the text's SHA-256."""
    rows = text_rows(docs, id_col, text_col)

    def run(batches):
        for batch in text_slices(batches):
            texts = byte_texts(batch)
            out = {"doc_id": batch.column("doc_id"), "fp": pa.array([simhash(t, shingle) for t in texts], pa.int64())}
            if keyed:
                out["digest"] = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            yield pa.RecordBatch.from_pydict(out)

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long"
                                + (", digest binary" if keyed else ""))


class _Index:
    """The position choices for d bits: masks of the kept bytes, and the first choice for a pair."""

    def __init__(self, max_bits: int):
        if not 1 <= max_bits <= 3:
            raise ValueError("max_bits must be 1, 2 or 3")
        self.max_bits = max_bits
        self.left_out = list(combinations(range(8), max_bits))
        self.masks = [~sum(0xFF << (8 * k) for k in c) & 0xFFFFFFFFFFFFFFFF for c in self.left_out]
        # by the set of differing bytes: the first choice that leaves all of them out
        self.first = np.full(256, 255, np.uint8)
        for diff in range(256):
            need = {k for k in range(8) if diff >> k & 1}
            self.first[diff] = next((i for i, c in enumerate(self.left_out) if need <= set(c)), 255)
        self.flips = []  # per choice: the XOR masks within the left-out bytes
        for c in self.left_out:
            bits = [1 << (8 * k + b) for k in c for b in range(8)]
            self.flips.append(np.array([sum(x) for r in range(1, max_bits + 1) for x in combinations(bits, r)],
                                       np.uint64))

    def linked(self, x: np.ndarray, choice: np.ndarray | int) -> np.ndarray:
        """Of the XORs of pairs in a list: tally shared bytes, keep the minimum, verify bits, judge once."""
        parts = x.view(np.uint8).reshape(-1, 8)
        differ = parts != 0
        enough = 8 - differ.sum(axis=1) >= 8 - self.max_bits
        near = _ONES[parts].sum(axis=1) <= self.max_bits
        which = np.packbits(differ, axis=1, bitorder="little").ravel()
        return enough & near & (self.first[which] == choice) & (x != 0)

    def links(self, fps: np.ndarray, choice: int) -> list[tuple[int, int]]:
        """Spanning forest of the links within one posting list (sorted distinct fingerprints)."""
        if len(fps) <= _ALL_PAIRS:
            i, j = np.triu_indices(len(fps), 1)
            ok = self.linked(fps[i] ^ fps[j], choice)
            pairs = zip(i[ok].tolist(), j[ok].tolist())
        else:
            pairs = self._probed(fps, choice)
        root = list(range(len(fps)))

        def top(k):
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        out = []
        for a, b in pairs:
            ra, rb = top(a), top(b)
            if ra != rb:
                root[max(ra, rb)] = min(ra, rb)
                out.append((a, b))
        return out

    def _probed(self, fps: np.ndarray, choice: int) -> Iterator[tuple[int, int]]:
        for flip in self.flips[choice]:
            want = fps ^ flip
            at = np.minimum(np.searchsorted(fps, want), len(fps) - 1)
            ok = (fps[at] == want) & (fps < want)
            ok[ok] = self.linked(fps[ok] ^ want[ok], choice)
            yield from zip(np.flatnonzero(ok).tolist(), at[ok].tolist())


def _list_links(batches, max_bits: int):
    """Links of posting lists that arrive sorted by (choice, key); a list may span batches."""
    index = _Index(max_bits)
    names = ["a", "b"]

    def emit(choice, key, fp):
        new = np.flatnonzero((choice[1:] != choice[:-1]) | (key[1:] != key[:-1])) + 1
        first = np.concatenate(([0], new))
        size = np.diff(np.append(first, len(fp)))
        two = first[size == 2]
        ok = index.linked(fp[two] ^ fp[two + 1], choice[two])
        a, b = [fp[two[ok]]], [fp[two[ok] + 1]]
        for at, n in zip(first[size > 2].tolist(), size[size > 2].tolist()):
            own = np.sort(fp[at:at + n])
            found = index.links(own, int(choice[at]))
            if found:
                i, j = np.array(found).T
                a.append(own[i])
                b.append(own[j])
        a, b = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names)

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("choice", "key", "fp")]
        now[2] = np.ascontiguousarray(now[2]).view(np.uint64)
        if held is not None:
            now = [np.concatenate(x) for x in zip(held, now)]
        choice, key, fp = now
        last = (choice == choice[-1]) & (key == key[-1])
        cut = len(fp) - int(np.argmin(last[::-1])) if not last.all() else 0
        held = [x[cut:] for x in now]
        if cut:
            yield emit(choice[:cut], key[:cut], fp[:cut])
    if held is not None:
        yield emit(*held)


def near_links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b) fingerprint links that connect all fingerprints (column fp, distinct) within ``max_bits`` bits."""
    index = _Index(max_bits)
    signed = [m - (1 << 64) if m >> 63 else m for m in index.masks]
    posts = F.array(*(F.struct(F.lit(i).cast("tinyint").alias("choice"),
                               F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key"))
                      for i, m in enumerate(signed)))
    posted = distinct.select("fp", F.explode(posts).alias("p")).select("p.choice", "p.key", "fp")
    lists = posted.repartition("choice", "key").sortWithinPartitions("choice", "key")
    return lists.mapInArrow(lambda it: _list_links(it, max_bits), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document row: doc_id, fp (long), component_id.

    ``component_id`` is the smallest doc_id reachable over links of at most
    ``max_bits`` differing bits.  Null and empty texts have fingerprint 0 and
    link like any other; a null doc_id is never the smallest (a component of
    null ids only has a null id); repeated rows each give a row.
    """
    rows = materialize(fingerprints(docs, id_col, text_col, shingle))
    linked = _rooted(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), max_bits)
    ids = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = hot_join(linked, ids, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def _rooted(groups: DataFrame, max_bits: int) -> DataFrame:
    """One row per fingerprint (column fp) with the root of its component."""
    groups = materialize(groups)
    roots = connected_components(near_links(groups.select("fp"), max_bits))
    return materialize(groups.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                       .withColumn("root", F.coalesce("root", "fp")))


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                            shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document row of each component (the smallest doc_id, then text digest), with all its columns.

    Rows are told apart by doc_id and text, so a repeated doc_id with unlike
    texts is judged by each text; of rows equal in both one stays, by the hash
    of their columns.  Of a component's rows without a doc_id one stays (the
    smallest digest), also beside a row with one.
    """
    rows = materialize(fingerprints(docs, id_col, text_col, shingle, keyed=True))
    has_id = F.col("doc_id").isNotNull()
    linked = _rooted(rows.groupBy("fp").agg(F.min(F.when(has_id, F.struct("doc_id", "digest"))).alias("named"),
                                            F.min(F.when(~has_id, F.col("digest"))).alias("nameless")), max_bits)
    kept = linked.groupBy("root").agg(F.min("named").alias("named"), F.min("nameless").alias("nameless"))
    key = lambda digest, doc_id: F.concat(digest, F.coalesce(F.concat(F.lit(":"), doc_id.cast("string")), F.lit("")))
    kept = kept.select(F.explode(F.array(
        key(F.lower(F.hex("named.digest")), F.col("named.doc_id")), F.lower(F.hex("nameless")))).alias("key")).where(
        "key IS NOT NULL")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    tie = F.xxhash64(*(F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()))
    return (docs.select(key(F.sha2(text, 256), F.col(f"`{id_col}`")).alias("key"), F.struct(*columns).alias("row"),
                        tie.alias("tie"))
            .join(kept, "key", "left_semi").groupBy("key").agg(F.min_by("row", "tie").alias("row")).select("row.*"))
