"""Token ids in Arrow stream files of fixed-size-list batches.

A store is a folder: ``tokens-<range>.arrows`` hold the ids of one range of
doc_id in ascending order, packed into sequences of ``length`` ids; each batch
has the columns ids, mask (token, not padding) and ends (last id of a
document), all fixed-size lists, and all batches but a file's last have the
same number of sequences.  Their messages are therefore of equal size, so the
place of any sequence in the stream follows by arithmetic and its ids are read
from a memory map without copying.  mask and ends are booleans of one bit each,
which keeps the files small; they are unpacked into new arrays on reading.  ``documents-<range>.arrows`` lists the doc_ids of
a range; a Parquet manifest has one row per range.

Texts are encoded by the tokenizers library.  For a byte-level BPE file the
texts are cut into pieces first (``pretokenize``) and the library encodes
pieces that a worker has not seen; other files encode whole texts.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finspark.llm.bpe import vocabulary_path
from finspark.llm.common import RANGE_BYTES, bucket_of, byte_texts, range_bounds, text_rows, text_slices
from finspark.llm.pretokenize import PieceTable

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
LENGTH = 2048
BATCH = 256  # sequences of a batch
_PIECES = 20_000  # pieces encoded in one call


class Encoder:
    """A tokenizer file of the tokenizers library; ids come as bytes of ``dtype``.

    Strings of special tokens in a text have the special ids, as the library
    gives them; with ``special_as_text`` they are ordinary text.
    """

    def __init__(self, name: str, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores already
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary_path(name))
        self.library.encode_special_tokens = True  # pieces hold no special token
        self.whole = self.library
        self.special: list[bytes] = []
        if not special_as_text:
            self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
            self.whole = Tokenizer.from_file(vocabulary_path(name))
        size = max(self.library.get_vocab(with_added_tokens=True).values()) + 1
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        spec = json.loads(self.library.to_str())
        before = spec["pre_tokenizer"] or {}
        self.by_piece = (spec["normalizer"] is None and spec["model"]["type"] == "BPE"
                         and not spec["model"].get("dropout") and before.get("type") == "ByteLevel"
                         and before.get("use_regex") and not before.get("add_prefix_space")
                         and len(self._ids("\n")) == 1)
        # signs of a byte-level token stand for one byte each
        self.length = np.zeros(size, np.int64)
        for token, i in self.library.get_vocab(with_added_tokens=True).items():
            self.length[i] = len(token)
        self.known = PieceTable(self._piece_ids, self.dtype)

    def _ids(self, text: str) -> list[int]:
        return self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _piece_ids(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, by the library.

        Pieces that start with a space follow each other without changing; the
        rest are kept apart by line ends; white space is encoded by itself.
        """
        out, spaced, plain = [b""] * len(pieces), [], []
        for k, p in enumerate(pieces):
            if p.decode().isspace():
                out[k] = np.array(self._ids(p.decode()), self.dtype).tobytes()
            else:
                (spaced if p[:1] == b" " else plain).append(k)
        gap = self._ids("\n")[0]
        for group, between in ((spaced, b""), (plain, b"\n")):
            for i in range(0, len(group), _PIECES):
                part = [pieces[k] for k in group[i:i + _PIECES]]
                ids = np.array(self._ids(between.join(part).decode()), self.dtype)
                if between:
                    ids = ids[ids != gap]
                ends = np.cumsum(self.length[ids])
                want = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)))
                last = np.searchsorted(ends, want) + 1
                if ends[-1] != want[-1] or not np.array_equal(ends[last - 1], want):
                    raise ValueError("the tokenizer doesn't keep pieces apart")
                raw, width = ids.tobytes(), self.dtype.itemsize
                bounds = np.append(0, last * width).tolist()
                for k, a, b in zip(group[i:i + _PIECES], bounds, bounds[1:]):
                    out[k] = raw[a:b]
        return out

    def _whole(self, texts: list[bytes]) -> list[bytes]:
        got = self.whole.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in got]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_piece:
            return self._whole(texts)
        special = [k for k, t in enumerate(texts) if any(s in t for s in self.special)]
        if not special:
            return self.known.texts(texts)
        out = self.known.texts([b"" if k in set(special) else t for k, t in enumerate(texts)])
        for k, ids in zip(special, self._whole([texts[k] for k in special])):
            out[k] = ids
        return out


@lru_cache(2)
def encoder(name: str, special_as_text: bool = False) -> Encoder:
    return Encoder(name, special_as_text)


def _schema(dtype: np.dtype, length: int, batch: int, end_id: int) -> pa.Schema:
    kind = {2: pa.uint16(), 4: pa.uint32()}[dtype.itemsize]
    return pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length)),
                      ("ends", pa.list_(pa.bool_(), length))],
                     metadata={"length": str(length), "batch": str(batch), "end_id": str(end_id)})


class Writer:
    """Writes one range under a name of its own; ``close`` moves it to its final name.

    A task that runs twice writes the same bytes twice; the move replaces whole files.
    """

    def __init__(self, folder: str, part: int, dtype: np.dtype, length: int, batch: int, end_id: int, id_type):
        self.fs, root = fs.FileSystem.from_uri(folder)
        self.names = [f"{root}/{kind}-{part:+07d}.arrows" for kind in ("tokens", "documents")]
        self.own = [f"{root}/.{uuid.uuid4().hex}-{kind}" for kind in ("tokens", "documents")]
        self.dtype, self.length, self.batch = dtype, length, batch
        self.schema = _schema(dtype, length, batch, end_id)
        self.end = np.array([end_id], dtype).tobytes()
        self.files = [self.fs.open_output_stream(p) for p in self.own]
        self.tokens = pa.ipc.new_stream(self.files[0], self.schema)
        self.ids = pa.ipc.new_stream(self.files[1], pa.schema([("doc_id", id_type)]))
        self.held: list[bytes] = []
        self.ends: list[int] = []  # where documents end, counted from the first id held
        self.size = self.n_tokens = self.n_docs = 0

    def add(self, doc_ids: pa.Array, texts: list[bytes]) -> None:
        self.ids.write_batch(pa.RecordBatch.from_arrays([doc_ids], ["doc_id"]))
        self.n_docs += len(texts)
        for ids in texts:
            self.held += [ids, self.end]
            self.size += len(ids) // self.dtype.itemsize + 1
            self.ends.append(self.size - 1)
        if self.size >= self.length * self.batch:
            self._flush(self.size // (self.length * self.batch) * self.length * self.batch)

    def _flush(self, n: int) -> None:
        """Write the first n ids (whole batches, or all that is left)."""
        ids = np.frombuffer(b"".join(self.held), self.dtype)
        ends = np.zeros(len(ids), bool)
        ends[self.ends] = True
        self.held, self.size = [ids[n:].tobytes()], len(ids) - n
        self.ends = [e - n for e in self.ends if e >= n]
        self.n_tokens += n
        step = self.length * self.batch
        for a in range(0, n, step):
            b = min(n, a + step)
            pad = -(b - a) % self.length
            columns = (np.pad(ids[a:b], (0, pad)), np.pad(np.ones(b - a, bool), (0, pad)), np.pad(ends[a:b], (0, pad)))
            self.tokens.write_batch(pa.RecordBatch.from_arrays(
                [pa.FixedSizeListArray.from_arrays(pa.array(c), self.length) for c in columns], schema=self.schema))

    def close(self) -> None:
        if self.size:
            self._flush(self.size)
        for writer, file, own, name in zip((self.tokens, self.ids), self.files, self.own, self.names):
            writer.close()
            file.close()
            self.fs.move(own, name)


class TokenFile:
    """Random access to the sequences of one file; local files are memory-mapped and not copied."""

    def __init__(self, path: str):
        own, name = fs.FileSystem.from_uri(path)
        local = isinstance(own, fs.LocalFileSystem)
        self.file = pa.memory_map(name) if local else own.open_input_file(name)
        self.size = self.file.size()
        self.schema = pa.ipc.read_schema(pa.ipc.read_message(self.file))
        self.first = self.file.tell()
        meta = {k.decode(): int(v) for k, v in self.schema.metadata.items()}
        self.length, self.batch, self.end_id = meta["length"], meta["batch"], meta["end_id"]
        self.stride = self._after(self.first) - self.first

    def _after(self, at: int) -> int:
        """Where the message after the one at ``at`` starts (``at`` itself at the end of the stream)."""
        self.file.seek(at)
        try:
            pa.ipc.read_message(self.file)
        except EOFError:
            return at
        return self.file.tell()

    def __len__(self) -> int:
        """Number of batches."""
        return -(-(self.size - self.first - 8) // self.stride) if self.stride else 0

    def read(self, i: int) -> pa.RecordBatch:
        self.file.seek(self.first + i * self.stride)
        return pa.ipc.read_record_batch(pa.ipc.read_message(self.file), self.schema)

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, mask) of sequence i of the file: ids a view of the memory map, mask unpacked from bits."""
        row, batch = i % self.batch, self.read(i // self.batch)
        return (batch.column("ids")[row].values.to_numpy(),
                batch.column("mask")[row].values.to_numpy(zero_copy_only=False))

    def documents(self):
        """The ids of each document, in order."""
        held: list[np.ndarray] = []
        for i in range(len(self)):
            batch = self.read(i)
            ids = batch.column("ids").flatten().to_numpy()
            mask, ends = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("mask", "ends"))
            ids = ids[:int(mask.sum())]  # padding stands at the end alone
            begin = 0
            for end in (np.flatnonzero(ends) + 1).tolist():
                yield np.concatenate((*held, ids[begin:end])) if held else ids[begin:end]
                held, begin = [], end
            if begin < len(ids):
                held.append(ids[begin:])


def write_store(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, end_id: int = END_ID,
                length: int = LENGTH, batch: int = BATCH, id_col: str = "doc_id", text_col: str = "text",
                bytes_per_range: int = RANGE_BYTES, special_as_text: bool = False) -> DataFrame:
    """Encode all documents, append ``end_id`` to each and write them in ascending doc_id order.

    Returns the manifest: part (ascending), n_docs, n_tokens, start (ids in the
    files before).  ``folder`` is a new folder that all executors share.

    Null and empty texts give the end id alone.  Rows without doc_id come
    first (by text), repeated doc_ids by text; ids of any ordered type do.  An
    empty table gives no files.  ``special_as_text``: as in ``Encoder``.
    """
    spark = docs.sparkSession
    rows = text_rows(docs, id_col, text_col)
    bounds = range_bounds(rows, bytes_per_range)
    nameless = -1 - F.pmod(F.xxhash64("text"), F.lit(len(bounds) + 1)).cast("int")
    part = F.when(F.col("doc_id").isNull(), nameless).otherwise(bucket_of("doc_id", bounds, rows.schema["doc_id"].dataType))
    # one range, one task; rows without doc_id go with a range as well
    dealt = (rows.withColumn("part", part).repartitionById(len(bounds) + 1, F.pmod("part", F.lit(len(bounds) + 1)))
             .sortWithinPartitions("part", "doc_id", "text"))
    fs_of, root = fs.FileSystem.from_uri(folder)
    fs_of.create_dir(root, recursive=True)

    def run(batches):
        own = encoder(tokenizer, special_as_text)
        part = writer = None
        done = []

        def close():
            writer.close()
            done.append((part, writer.n_docs, writer.n_tokens))

        for batch_in in batches:
            parts = batch_in.column("part").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if parts[a] != part:
                    if writer:
                        close()
                    part = int(parts[a])
                    writer = Writer(folder, part, own.dtype, length, batch, end_id, batch_in.schema.field("doc_id").type)
                for piece in text_slices([batch_in.slice(a, b - a)]):
                    writer.add(piece.column("doc_id"), own.encode(byte_texts(piece)))
        if writer:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*done)],
                                             ["part", "n_docs", "n_tokens"])

    path = f"{folder}/manifest"
    dealt.mapInArrow(run, "part long, n_docs long, n_tokens long").write.parquet(path)
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file (bounded by the ranges): part, n_docs, n_tokens, start."""
    parts = sorted(map(tuple, spark.read.parquet(f"{folder}/manifest").collect()))
    starts = np.cumsum([0, *(n for _, _, n in parts)]).tolist()
    return spark.createDataFrame([(*p, s) for p, s in zip(parts, starts)],
                                 "part long, n_docs long, n_tokens long, start long")


def read_store(listed: DataFrame, folder: str, id_type: str = "long") -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens
    (with the end id), ids_crc32 (of the ids as little-endian unsigned 32-bit integers)."""

    def run(batches):
        for batch in batches:
            for part, start in zip(batch.column("part").to_pylist(), batch.column("start").to_pylist()):
                own, root = fs.FileSystem.from_uri(folder)
                with own.open_input_stream(f"{root}/documents-{part:+07d}.arrows") as f:
                    ids = pa.ipc.open_stream(f).read_all().column("doc_id")
                sizes, sums = [], []
                for d in TokenFile(f"{folder}/tokens-{part:+07d}.arrows").documents():
                    sizes.append(len(d))
                    sums.append(zlib.crc32(d.astype("<u4").tobytes()))
                if len(sizes) != len(ids):
                    raise ValueError(f"range {part}: {len(ids)} doc_ids, {len(sizes)} documents")
                starts = start + np.cumsum([0, *sizes[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays(ids.chunks), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()),
                     pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return listed.select("part", "start").mapInArrow(
        run, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")
