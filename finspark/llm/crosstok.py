"""Alignment of two tokenizers: token groups, links and how often ids are linked.

A byte-level BPE file (A) and a sentencepiece file (B) encode the same bytes.
Everything after that is Arrow: lists are flattened with the index of their
parent, sums of token lengths that start anew at each document give the byte
where every token ends, and a hash join of both tables on (document, end)
finds the ends that both have.  Between two neighbouring ends of either kind
one A token meets one B token: a link.  Links are counted by ``group_by`` in
each slice, and Spark adds up the partial counts.  The counts go to sorted
shards in the shared folder, which tasks look up in a second pass over the
stored tokens.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finspark.llm.bpe import vocabulary_path
from finspark.llm.common import byte_texts, text_rows, text_slices
from finspark.llm.shards import make_folder, read_shard, write_shard
from finspark.llm.token_store import Encoder
from finspark.session import scratch_path, staged

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
PAIRS_PER_SHARD = 1 << 21
TOKENS = 1 << 18  # tokens (of A and B together) of a slice, one document at least
_HELD = 1 << 20  # distinct pairs that a task counts before it passes them on
_TEXT = 1 << 20  # bytes of text encoded together
_SEGMENT = 1 << 16  # code points of a text that sentencepiece encodes at a time
_SPACE = "▁"
_END = 40  # bits for the byte where a token ends; the document's index stands above


def _signs() -> dict[str, int]:
    """The sign that stands for each byte in byte-level vocabularies: printable Latin-1 itself, the rest from U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A byte-level file of the tokenizers library; strings of special tokens are plain text."""

    def __init__(self, name: str):
        self.encoder = Encoder(name, special_as_text=True)
        byte = _signs()
        vocabulary = self.encoder.library.get_vocab(with_added_tokens=False)
        self.token = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.token[i] = bytes(byte[s] for s in token)
        self.bytes = pa.array(self.token, pa.binary())

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of space + text."""
        return [np.frombuffer(i, self.encoder.dtype) for i in self.encoder.encode([b" " + t for t in texts])]


class Pieces:
    """A sentencepiece file with byte fallback that puts a space before the text."""

    def __init__(self, name: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(name))
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.token = [bytes([int(p[3:-1], 16)]) if self.model.is_byte(i) else p.replace(_SPACE, " ").encode()
                      for i, p in enumerate(pieces)]
        self.bytes = pa.array(self.token, pa.binary())
        # merges then never go over the start of a space that follows another sign
        self.apart = not any(_SPACE in p.lstrip(_SPACE) for p in pieces)

    def _segments(self, text: str) -> list[str]:
        """Cut before spaces that follow another sign; a segment lacks the space, which the model adds."""
        out, start = [], 0
        while self.apart and len(text) - start > 2 * _SEGMENT:
            end = text.find(" ", start + _SEGMENT)
            while 0 < end and (text[end - 1] in f" {_SPACE}" or end <= start):
                end = text.find(" ", end + 1)
            if end < 0 or end + 1 == len(text):
                break  # the model gives the empty text no tokens
            out.append(text[start:end])
            start = end + 1
        return [*out, text[start:]]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of texts, which the model puts a space before."""
        segments = [self._segments(t.decode()) for t in texts]
        ids = iter(self.model.encode([s for own in segments for s in own], num_threads=1))
        return [np.array([i for _ in own for i in next(ids)], np.uint32) for own in segments]


@lru_cache(2)
def _byte_level(name: str) -> ByteLevel:
    return ByteLevel(name)


@lru_cache(2)
def _pieces(name: str) -> Pieces:
    return Pieces(name)


def _returned(ids: list[np.ndarray], token: pa.Array, texts: list[bytes]) -> np.ndarray:
    """Whether the joined bytes of each document's tokens are those of space + text."""
    made = token.take(pa.array(np.concatenate(ids)))
    _, offsets, data = made.buffers()
    ends = np.frombuffer(offsets, np.int32)[np.cumsum([0, *map(len, ids)])].tolist()
    data = data.to_pybytes() if data else b""
    return np.array([data[i:j] == b" " + t for i, j, t in zip(ends, ends[1:], texts)], bool)


def _width(tokens: list[bytes]) -> np.dtype:
    """Ids are stored in two bytes where the vocabulary allows."""
    return np.dtype("<u2" if len(tokens) <= 1 << 16 else "<u4")


def token_pairs(docs: DataFrame, tokenizer_a: str = TOKENIZER_A, tokenizer_b: str = TOKENIZER_B,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, a, b): the ids of both tokenizers for space + text, as bytes of
    little-endian integers (two bytes each where the vocabulary allows).

    Both are empty for null and empty texts, and where the joined bytes of
    either tokenizer's tokens are not the bytes of space + text (a text holds
    U+2581, or a normaliser changed it).
    """
    rows = text_rows(docs, id_col, text_col)

    def run(batches):
        own = _byte_level(tokenizer_a), _pieces(tokenizer_b)
        for batch in text_slices(batches, max_bytes=_TEXT):
            texts = byte_texts(batch)
            ids = [t.encode(texts) for t in own]
            whole = np.array([bool(t) for t in texts])
            for t, x in zip(own, ids):
                whole &= _returned(x, t.bytes, texts)
            sides = [pa.array([i.astype(_width(t.token)).tobytes() if w else b"" for i, w in zip(x, whole)], pa.binary())
                     for t, x in zip(own, ids)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *sides], ["doc_id", "a", "b"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, a binary, b binary")


def _lists(column: pa.BinaryArray, width: np.dtype) -> pa.ListArray:
    """Stored ids as lists, without a copy."""
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1] // width.itemsize
    kind = pa.uint16() if width.itemsize == 2 else pa.uint32()
    size = (data.size if data else 0) // width.itemsize
    return pa.ListArray.from_arrays(pa.array(offsets), pa.Array.from_buffers(kind, size, [None, data or pa.py_buffer(b"")]))


def _token_slices(batches: Iterator[pa.RecordBatch], sides: tuple) -> Iterator[tuple]:
    """(doc_ids, lists of A, lists of B) of slices of about ``TOKENS`` tokens."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = [_lists(batch.column(c), side.width) for c, side in zip("ab", sides)]
        sizes = pc.add(*map(pc.list_value_length, lists)).to_numpy()
        group = np.cumsum(sizes, dtype=np.int64) // TOKENS
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            yield (batch.column("doc_id").slice(start, end - start) if "doc_id" in batch.schema.names else None,
                   *(x.slice(start, end - start) for x in lists))
    pa.default_memory_pool().release_unused()


class Side:
    """What the passes over stored tokens need of a tokenizer: how its ids are stored, and token lengths."""

    def __init__(self, tokens: list[bytes]):
        self.width, self.length = _width(tokens), np.fromiter(map(len, tokens), np.int64, len(tokens))


def _sides(tokenizer_a: str, tokenizer_b: str) -> tuple[Side, Side]:
    return Side(_byte_level(tokenizer_a).token), Side(_pieces(tokenizer_b).token)


def _token_ends(lists: pa.ListArray, length: np.ndarray, name: str) -> pa.Table:
    """(at, id) of every token: ``at`` is its document's index and the byte of the document where it ends."""
    ids, doc = pc.list_flatten(lists), pc.list_parent_indices(lists)
    run = pc.cumulative_sum(pa.array(length).take(ids))
    # sums start anew at each document: less what stands before its first token
    counts = pc.list_value_length(lists).to_numpy()
    total = np.concatenate(([0], run.to_numpy()))
    before = pa.array(total[np.cumsum(counts) - counts])
    return pa.table({"at": pc.add(pc.shift_left(doc.cast(pa.int64()), _END), pc.subtract(run, before.take(doc))), name: ids})


def link_table(a: pa.ListArray, b: pa.ListArray, sides: tuple) -> pa.Table:
    """One row per link, in order: doc, a, b, and whether an A token and a B token end there."""
    a, b = (_token_ends(lists, side.length, name) for lists, side, name in zip((a, b), sides, "ab"))
    met = a.join(b, "at", join_type="full outer", use_threads=False).combine_chunks()
    met = met.take(pc.array_sort_indices(met["at"].combine_chunks()))
    # an end that one kind lacks lies within the token of that kind that ends next
    return pa.table({"doc": pc.shift_right(met["at"], _END), "a": pc.fill_null_backward(met["a"]),
                     "b": pc.fill_null_backward(met["b"]),
                     "ends_a": pc.is_valid(met["a"]), "ends_b": pc.is_valid(met["b"])})


def _pair(links: pa.Table) -> pa.Array:
    pair = pc.add(pc.shift_left(links["a"].cast(pa.int64()), 32), links["b"].cast(pa.int64()))
    return pair.combine_chunks()


def pair_counts(tokens: DataFrame, tokenizer_a: str = TOKENIZER_A, tokenizer_b: str = TOKENIZER_B) -> DataFrame:
    """(a, b, n, best): how many links hold a pair of ids linked, and whether no other pair of its B id has more."""

    sides = _sides(tokenizer_a, tokenizer_b)

    def run(batches):
        held = None
        for _, a, b in _token_slices(batches, sides):
            part = pa.table({"pair": _pair(link_table(a, b, sides))})
            part = part.group_by("pair", use_threads=False).aggregate([([], "count_all")]).rename_columns(["pair", "n"])
            if held is not None:
                part = pa.concat_tables([held, part]).group_by("pair", use_threads=False).aggregate(
                    [("n", "sum")]).rename_columns(["pair", "n"])
            held = part.combine_chunks()
            if held.num_rows > _HELD:
                yield from held.to_batches()
                held = None
        if held is not None:
            yield from held.to_batches()

    pairs = tokens.select("a", "b").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = staged(pairs.select(F.shiftright("pair", 32).cast("int").alias("a"),
                                F.col("pair").bitwiseAND(0xFFFFFFFF).cast("int").alias("b"), "n"), "pair_counts")
    most = pairs.groupBy("b").agg(F.max("n").alias("most"))
    return pairs.join(most, "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def write_counts(counts: DataFrame, folder: str, pairs_per_shard: int = PAIRS_PER_SHARD) -> int:
    """Write (a, b, n, best) rows as shards, each sorted by pair; returns their number.

    There are at most as many pairs as pairs of ids, however long the corpus
    is; pairs are dealt by the remainder of their number, so shards are alike.
    """
    own = staged(counts.select((F.shiftleft(F.col("a").cast("long"), 32) + F.col("b")).alias("pair"), "n", "best"),
                 "pair_shards")
    shards = -(-own.count() // pairs_per_shard)
    if not shards:
        return 0
    make_folder(folder)

    def run(table):
        table = table.select(["pair", "n", "best"]).sort_by("pair").combine_chunks()
        shard = table["pair"][0].as_py() % shards
        write_shard(folder, shard, table.to_batches()[0])
        return pa.table({"shard": [shard], "pairs": [len(table)]})

    own.withColumn("shard", F.col("pair") % shards).groupBy("shard").applyInArrow(
        run, "shard long, pairs long").agg(F.sum("pairs")).first()
    return shards


def _load(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (batch.column("pair").to_numpy(), batch.column("n").to_numpy(),
            batch.column("best").to_numpy(zero_copy_only=False))


def _looked_up(pairs: np.ndarray, folder: str, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """(n, best) of distinct pairs that were all counted."""
    n, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
    part = pairs % shards if shards else pairs
    for s in np.unique(part).tolist():
        at = np.flatnonzero(part == s)
        keys, counts, tops = read_shard(folder, s, _load)
        place = np.searchsorted(keys, pairs[at])
        if not np.array_equal(keys[np.minimum(place, len(keys) - 1)], pairs[at]):
            raise ValueError("a pair was not counted")
        n[at], best[at] = counts[place], tops[place]
    return n, best


def _joined(values: pa.Array, sizes: np.ndarray, sign: str) -> pa.Array:
    """Neighbouring strings joined: the first sizes[0], the next sizes[1] and so on."""
    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(ends, values), sign)


def _groups_text(links: pa.Table, n_docs: int) -> pa.Array:
    """``a1,a2|b1;a3|b2,b3`` per document; '' for one without tokens."""
    doc = links["doc"].to_numpy()
    ends_a, ends_b = (links[c].to_numpy() for c in ("ends_a", "ends_b"))
    both = ends_a & ends_b
    group = np.cumsum(both) - both  # groups that ended before
    n_groups = int(both.sum())
    sides = []
    for name, ends in (("a", ends_a), ("b", ends_b)):
        ids = links[name].filter(pa.array(ends)).combine_chunks().cast(pa.string())
        sides.append(_joined(ids, np.bincount(group[ends], minlength=n_groups), ","))
    return _joined(pc.binary_join_element_wise(*sides, "|"), np.bincount(doc[both], minlength=n_docs), ";")


def align(docs: DataFrame, tokenizer_a: str = TOKENIZER_A, tokenizer_b: str = TOKENIZER_B, id_col: str = "doc_id",
          text_col: str = "text", pairs_per_shard: int = PAIRS_PER_SHARD) -> DataFrame:
    """Per document row: doc_id, n_a, n_b (tokens), n_groups, n_links, n_best, count_sum (long), groups.

    groups lists the ids of each group, A's and B's, as ``a1,a2|b1;a3|b2,b3``;
    n_best counts links whose pair has the most links of its B id (ties
    included), count_sum adds the counts of the links' pairs.

    Null and empty texts, and texts that either tokenizer doesn't return byte
    for byte, have zeros and ''.  Repeated rows count as often as they stand.
    Tokens are stored once in the shared folder and read twice.  A text of more
    than ``TOKENS`` tokens is a slice of its own (of at most 2^40 bytes).
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "token_pairs")
    made = token_pairs(docs, tokenizer_a, tokenizer_b, id_col, text_col)
    made.write.option("compression", "zstd").parquet(path)
    tokens = spark.read.schema(made.schema).parquet(path)
    folder = scratch_path(spark, "pair_index")
    shards = write_counts(pair_counts(tokens, tokenizer_a, tokenizer_b), folder, pairs_per_shard)
    kind = made.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]

    sides = _sides(tokenizer_a, tokenizer_b)

    def run(batches):
        for doc_ids, a, b in _token_slices(batches, sides):
            links = link_table(a, b, sides)
            pair = _pair(links).dictionary_encode()
            n, best = _looked_up(pair.dictionary.to_numpy(), folder, shards)
            at = pair.indices
            own = pa.table({"doc": links["doc"], "n": pa.array(n).take(at), "best": pa.array(best.astype(np.int64)).take(at),
                            "group": pc.and_(links["ends_a"], links["ends_b"]).cast(pa.int64())})
            sums = own.group_by("doc", use_threads=False).aggregate(
                [([], "count_all"), ("group", "sum"), ("best", "sum"), ("n", "sum")])
            at, columns = sums["doc"].to_numpy(), []
            for name in ("group_sum", "count_all", "best_sum", "n_sum"):
                column = np.zeros(len(doc_ids), np.int64)
                column[at] = sums[name].to_numpy()
                columns.append(pa.array(column))
            sizes = [pc.list_value_length(x).cast(pa.int64()) for x in (a, b)]
            yield pa.RecordBatch.from_arrays([doc_ids, *sizes, *columns, _groups_text(links, len(doc_ids))], names)

    return tokens.mapInArrow(run, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                                  "count_sum long, groups string")
