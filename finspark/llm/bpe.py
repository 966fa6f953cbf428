"""Byte-level BPE: encoding with offsets, and decoding.

Pieces come from ``pretokenize`` (no regex).  A piece's ids come from a table
in the worker; the pieces that a slice misses are merged together, one numpy
row per piece: each round merges the lowest-ranked (leftmost) pair of every
row.  A long piece is merged over a linked list with a heap.  Ranks are read
from a public vocabulary file that every machine has; ids, and the byte offset
at which each token ends, are kept for decoding.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from finspark.llm.common import byte_texts, text_rows, text_slices
from finspark.llm.pretokenize import PieceTable

VOCABULARY = "byte_bpe_50k.tiktoken"
_ROW = 48  # longest piece (bytes) merged as a numpy row
_ROWS = 1 << 15
_NONE = np.int64(1) << 40
_TOKENS = 1 << 20  # tokens decoded at a time


def vocabulary_path(name: str) -> str:
    """A file name of the public vocabularies, or a path as it is."""
    if "/" in name:
        return name
    import public_tokenizers

    return str(public_tokenizers.path(name))


class Ranks:
    """A vocabulary: token bytes by rank, and the rank of every mergeable pair of tokens."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        size = max(self.rank.values()) + 1
        self.token = [b""] * size
        for t, r in self.rank.items():
            self.token[r] = t
        self.of_byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        self.length = np.fromiter(map(len, self.token), np.int64, size)
        self.begin = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(self.token), np.uint8)
        self._pair_table()
        self.known = PieceTable(self.piece_ids, "<u4")

    def _pair_table(self) -> None:
        keys, ranks = [], []
        for t, r in self.rank.items():
            for i in range(1, len(t)):
                a, b = self.rank.get(t[:i]), self.rank.get(t[i:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    ranks.append(r)
        keys, ranks = np.array(keys, np.int64), np.array(ranks, np.int64)
        self._bits = max(12, int(len(keys)).bit_length() + 2)
        self._keys = np.full(1 << self._bits, -1, np.int64)
        self._ranks = np.full(1 << self._bits, _NONE, np.int64)
        slot, self._probes = self._slot(keys), 0
        while len(keys):  # open addressing: one probe length at a time
            self._probes += 1
            free = self._keys[slot] == -1
            _, one = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
            put = one[free[one]]
            self._keys[slot[put]], self._ranks[slot[put]] = keys[put], ranks[put]
            left = np.ones(len(keys), bool)
            left[put] = False
            keys, ranks, slot = keys[left], ranks[left], (slot[left] + 1) & ((1 << self._bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self._bits)).astype(np.int64)

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a << 32 | b
        slot = self._slot(keys)
        at = self._keys[slot]
        out = np.where(at == keys, self._ranks[slot], _NONE)
        todo = np.flatnonzero((at != keys) & (at != -1))
        for _ in range(self._probes):
            if not len(todo):
                break
            slot[todo] = (slot[todo] + 1) & ((1 << self._bits) - 1)
            at = self._keys[slot[todo]]
            hit = at == keys[todo]
            out[todo[hit]] = self._ranks[slot[todo[hit]]]
            todo = todo[~hit & (at != -1)]
        return out

    def merge_rows(self, pieces: list[bytes]) -> list[bytes]:
        """Ids (little-endian unsigned 32-bit) of pieces of at most ``_ROW`` bytes."""
        n, width = len(pieces), max(map(len, pieces))
        size = np.fromiter(map(len, pieces), np.int64, n)
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
        ids = self.of_byte[raw]
        ranks = np.full((n, width), _NONE, np.int64)
        inside = np.arange(width - 1) < size[:, None] - 1
        ranks[:, :-1][inside] = self.pair_ranks(ids[:, :-1][inside], ids[:, 1:][inside])
        rows, out = np.arange(n), [b""] * n

        def finish(done):
            for k in np.flatnonzero(done).tolist():
                out[rows[k]] = ids[k, :size[k]].astype("<u4").tobytes()

        while len(rows):
            at = ranks.argmin(axis=1)
            low = ranks[np.arange(len(rows)), at]
            done = low == _NONE
            if done.any():
                finish(done)
                ids, ranks, size, rows, at, low = (x[~done] for x in (ids, ranks, size, rows, at, low))
                if not len(rows):
                    break
            k = np.arange(len(rows))
            ids[k, at] = low
            right = np.arange(ids.shape[1] - 1) > at[:, None]
            ids[:, :-1] = np.where(right, ids[:, 1:], ids[:, :-1])
            ranks[:, :-1] = np.where(right, ranks[:, 1:], ranks[:, :-1])
            size -= 1
            self._renew(ids, ranks, size, k, at)
            self._renew(ids, ranks, size, k, at - 1)
        return out

    def _renew(self, ids, ranks, size, k, at) -> None:
        """Rank of the pair that starts at ``at`` in every row."""
        ok = (at >= 0) & (at < size - 1)
        end = ~ok & (at >= 0)
        ranks[k[end], at[end]] = _NONE
        k, at = k[ok], at[ok]
        ranks[k, at] = self.pair_ranks(ids[k, at], ids[k, at + 1])

    def merge_long(self, piece: bytes) -> bytes:
        """Ids of one long piece: lowest rank first, leftmost of equal ones."""
        n, rank = len(piece), self.rank
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))  # right[i]: where the token at i ends
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)

        def push(i, end):
            r = rank.get(piece[i:end])
            if r is not None:
                heapq.heappush(heap, (r, i, end))

        while heap:
            _, i, end = heapq.heappop(heap)
            j = right[i]
            if not alive[i] or j >= n or right[j] != end:
                continue  # a token of this pair has been merged meanwhile
            alive[j] = False
            right[i] = end
            if end < n:
                left[end] = i
                push(i, right[end])
            if left[i] >= 0:
                push(left[i], end)
        ids, i = [], 0
        while i < n:
            ids.append(rank[piece[i:right[i]]])
            i = right[i]
        return np.array(ids, "<u4").tobytes()

    def piece_ids(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, merged here and now."""
        out, rest = [b""] * len(pieces), []
        for k, p in enumerate(pieces):
            whole = self.rank.get(p)
            if whole is not None:
                out[k] = whole.to_bytes(4, "little")
            elif len(p) > _ROW:
                out[k] = self.merge_long(p)
            else:
                rest.append(k)
        rest.sort(key=lambda k: len(pieces[k]))
        for i in range(0, len(rest), _ROWS):
            part = rest[i:i + _ROWS]
            for k, ids in zip(part, self.merge_rows([pieces[k] for k in part])):
                out[k] = ids
        return out

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        return self.known.texts(texts)

    def ends(self, ids: np.ndarray) -> np.ndarray:
        """Byte offset at which each token ends."""
        return np.cumsum(self.length[ids])

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> bytes:
        """Bytes of ids, each token put where its offset says."""
        out = []
        for a in range(0, len(ids), _TOKENS):
            part, stop = ids[a:a + _TOKENS], ends[a:a + _TOKENS]
            n = self.length[part]
            begin = int(stop[0] - n[0])
            source = np.repeat(self.begin[part] - (stop - n), n)
            out.append(self.bytes[source + np.arange(begin, int(stop[-1]))].tobytes())
        return b"".join(out)


@lru_cache(4)
def ranks(name: str) -> Ranks:
    return Ranks(vocabulary_path(name))


def bpe_encode(docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """(doc_id, ids, ends) per document row: token ids and the byte offsets at which tokens
    end in the UTF-8 text, both binary, little-endian unsigned 32-bit.

    A null or empty text has no ids; texts of any length are encoded whole;
    repeated rows each give a row.
    """
    rows = text_rows(docs, id_col, text_col)

    def run(batches):
        table = ranks(vocabulary)
        for batch in text_slices(batches):
            ids = table.encode(byte_texts(batch))
            ends = [table.ends(np.frombuffer(x, "<u4")).astype("<u4").tobytes() for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(ends, pa.binary())],
                ["doc_id", "ids", "ends"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary, ends binary")


def bpe_decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids, decoded binary) of rows with doc_id, ids and ends; null ids give no bytes."""
    rows = encoded.select("doc_id", "ids", "ends")

    def run(batches):
        table = ranks(vocabulary)
        for batch in text_slices(batches, "ids"):
            out = [table.decode(np.frombuffer(i or b"", "<u4"), np.frombuffer(e or b"", "<u4").astype(np.int64))
                   for i, e in zip(batch.column("ids").to_pylist(), batch.column("ends").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(out, pa.binary())],
                                             ["doc_id", "ids", "decoded"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary, decoded binary")


def bpe_round_trip(docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) per document row: ``bpe_encode`` and ``bpe_decode`` in one pass, slice by
    slice, so that ids and offsets of a whole Arrow batch never stand in memory at once."""
    rows = text_rows(docs, id_col, text_col)

    def run(batches):
        table = ranks(vocabulary)
        for batch in text_slices(batches):
            ids, decoded = table.encode(byte_texts(batch)), []
            for x in ids:
                own = np.frombuffer(x, "<u4")
                decoded.append(table.decode(own, table.ends(own)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())],
                ["doc_id", "ids", "decoded"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary, decoded binary")
