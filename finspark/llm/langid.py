"""Language identification by unigrams marginalised over segmentations.

Each language has probabilities for the pieces of a fixed public vocabulary
(byte pieces, so every text can be segmented).  The likelihood of a word is
the sum over all its segmentations, computed by a forward pass; piece
probabilities are learned by expectation-maximisation with forward-backward
expected counts.

Learning: words are counted per language over all learning documents in
Spark; each EM round is a pass over that table whose partial expected counts
are summed in Spark.  The model (languages x pieces that occur) is bounded by
the vocabulary.  Scoring is a pass over all texts without a shuffle; a worker
remembers the likelihoods of words.

Words are runs of letters of any length, lower-cased, with a space before.
They are found by code-point classes over a whole slice of texts.  Words of up
to ``_SHORT`` bytes are summed with others of their length, longer ones
position by position side by side.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finspark.llm.bpe import vocabulary_path
from finspark.llm.common import fold, materialize, text_rows, text_slices
from finspark.llm.pretokenize import LETTER, PieceTable, classes, code_points

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
LONGEST = 33  # bytes of the longest piece of VOCABULARY
ROUNDS = 2
SMOOTH = 0.01
_CACHED = 1 << 22  # likelihoods a worker remembers (words x languages)
_ROWS = 1 << 14
_PER_BYTE = 100.0
_SHORT = 48  # bytes of a word; longer ones go through _Lattice
_GROUP = 1 << 17  # bytes of long words in a lattice (one word may be longer)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def word_bytes(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of all texts: their bytes without a gap, where each starts, and the number of words of each text."""
    raw = [t.lower().encode("utf-8", "replace") for t in texts]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    data = b"".join(raw)
    none = np.zeros(len(texts), np.int64)
    if not data:
        return b"", none[:0], none
    cps, at = code_points(data)
    at = np.append(at, len(data))
    letters = np.flatnonzero(classes()[cps] == LETTER)
    if not len(letters):
        return b"", none[:0], none
    ends = np.cumsum(sizes)
    text = np.searchsorted(ends, at[letters], side="right")
    new = np.ones(len(letters), bool)
    new[1:] = (letters[1:] != letters[:-1] + 1) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    width = at[letters + 1] - at[letters]
    where = np.cumsum(width) - width  # of each letter among the bytes of all letters
    kept = np.zeros(len(data), bool)
    for k in range(int(width.max())):
        kept[at[letters[width > k]] + k] = True
    return (np.frombuffer(data, np.uint8)[kept].tobytes(), where[first],
            np.bincount(text[first], minlength=len(texts)))


def words(text: str) -> list[str]:
    """Words of one text."""
    data, cuts, _ = word_bytes([text])
    return [data[a:b].decode() for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(data)])]


class Pieces:
    """All pieces of the vocabulary and the single bytes, found by a polynomial hash of their bytes."""

    def __init__(self, name: str):
        with open(vocabulary_path(name), "rb") as f:
            tokens = [base64.b64decode(line.split()[0]) for line in f]
        self.pieces = sorted({t for t in tokens if t} | {bytes([b]) for b in range(256)})
        self.sizes = sorted(set(map(len, self.pieces)))
        self.scale = _PER_BYTE ** np.fromiter(map(len, self.pieces), np.float64, len(self.pieces))
        self.bits = max(12, len(self.pieces).bit_length() + 2)
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.ids = np.full(1 << self.bits, -1, np.int64)
        self.probes = 1
        for i, p in enumerate(self.pieces):
            key, n = self.key(p), 1
            at = int(self._slot(np.array([key], np.uint64))[0])
            while self.ids[at] >= 0:
                at, n = (at + 1) % len(self.ids), n + 1
            self.keys[at], self.ids[at] = key, i
            self.probes = max(self.probes, n)

    @staticmethod
    def key(piece: bytes) -> int:
        h = 0
        for b in piece:
            h = (h * int(_BASE) + b + 1) % (1 << 64)
        return h

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = (keys ^ (keys >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Piece id of each key, or -1."""
        slot = self._slot(keys)
        out = np.where(self.keys[slot] == keys, self.ids[slot], -1)
        todo = np.flatnonzero((out < 0) & (self.ids[slot] >= 0))
        for _ in range(self.probes - 1):
            if not len(todo):
                break
            slot[todo] = (slot[todo] + 1) % len(self.ids)
            hit = self.keys[slot[todo]] == keys[todo]
            out[todo[hit]] = self.ids[slot[todo[hit]]]
            todo = todo[~hit & (self.ids[slot[todo]] >= 0)]
        return out

    def spans(self, rows: np.ndarray) -> list:
        """(start, end, which rows, their piece ids) of all spans of equally long words that hold a piece, by end."""
        n, size = rows.shape
        prefix = np.zeros((size + 1, n), np.uint64)
        for j in range(size):
            prefix[j + 1] = prefix[j] * _BASE + rows[:, j] + np.uint64(1)
        power = [np.uint64(1)]
        for _ in range(min(size, self.sizes[-1])):
            power.append(np.uint64(int(power[-1]) * int(_BASE) % (1 << 64)))
        out = []
        for j in range(1, size + 1):
            for k in self.sizes:
                if k > j:
                    break
                ids = self.find(prefix[j] - prefix[j - k] * power[k])
                hit = np.flatnonzero(ids >= 0)
                if len(hit):
                    out.append((j - k, j, hit, ids[hit]))
        return out


@lru_cache(2)
def pieces_of(name: str) -> Pieces:
    return Pieces(name)


def _by_length(found: list[str]):
    """(indices, byte matrix) of short words of equal length, a space before each."""
    groups = defaultdict(list)
    raw = [b" " + w.encode() for w in found]
    for i, w in enumerate(raw):
        groups[len(w)].append(i)
    for size, at in sorted(groups.items()):
        if size > _SHORT:
            continue
        for a in range(0, len(at), _ROWS):
            part = at[a:a + _ROWS]
            yield np.array(part), np.frombuffer(b"".join(raw[i] for i in part), np.uint8).reshape(-1, size)


class _Lattice:
    """All spans that hold a piece in words of any lengths; a word of n bytes has n + 1 states."""

    def __init__(self, pieces: Pieces, raw: list[bytes]):
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        self.first = np.cumsum(sizes + 1) - sizes - 1  # state before a word's first byte
        self.last = self.first + sizes
        data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64) + np.uint64(1)
        word = np.repeat(np.arange(len(raw)), sizes)
        held, key = [], np.zeros(len(data), np.uint64)
        for k in range(1, min(pieces.sizes[-1], int(sizes.max())) + 1):
            key = key[:len(data) - k + 1] * _BASE + data[k - 1:]
            inside = np.flatnonzero(word[:len(key)] == word[k - 1:])
            ids = pieces.find(key[inside])
            at = inside[ids >= 0]
            held.append((at + word[at], np.full(len(at), k), ids[ids >= 0], word[at]))
        self.start, size, self.piece, self.word = (np.concatenate(x) for x in zip(*held))
        self.end = self.start + size

    def _steps(self, state: np.ndarray):
        """Spans by their ``state``'s place in its word: (spans, where each state's begin, the states) of each place."""
        place = state - self.first[self.word]
        order = np.lexsort((state, place))
        cuts = np.flatnonzero(np.diff(place[order])) + 1
        for own in np.split(order, cuts):
            begins = np.append(0, np.flatnonzero(np.diff(state[own])) + 1)
            yield own, begins, state[own[begins]]

    def forward(self, logs: np.ndarray) -> np.ndarray:
        """log sums up to every state; logs: of each span, for one or more languages."""
        alpha = np.full((int(self.last[-1]) + 1, *logs.shape[1:]), -np.inf)
        alpha[self.first] = 0.0
        for own, begins, states in self._steps(self.end):
            alpha[states] = np.logaddexp.reduceat(alpha[self.start[own]] + logs[own], begins, axis=0)
        return alpha

    def backward(self, logs: np.ndarray, at_end: np.ndarray) -> np.ndarray:
        beta = np.full(int(self.last[-1]) + 1, -np.inf)
        beta[self.last] = at_end
        for own, begins, states in reversed(list(self._steps(self.start))):
            beta[states] = np.logaddexp.reduceat(beta[self.end[own]] + logs[own], begins)
        return beta


def _long(found: list[str], pieces: Pieces):
    """(indices, lattice) of long words, of similar lengths together, a space before each."""
    raw = {i: b" " + w.encode() for i, w in enumerate(found) if len(w) * 4 >= _SHORT}
    at, held = [], 0
    for i in sorted((i for i in raw if len(raw[i]) > _SHORT), key=lambda i: len(raw[i])):
        if at and held + len(raw[i]) > _GROUP:
            yield np.array(at), _Lattice(pieces, [raw[j] for j in at])
            at, held = [], 0
        at.append(i)
        held += len(raw[i])
    if at:
        yield np.array(at), _Lattice(pieces, [raw[j] for j in at])


def _scaled(pieces: Pieces, probs: np.ndarray) -> np.ndarray:
    """Probabilities times ``_PER_BYTE`` for each byte of a piece.  All segmentations of a word have its
    bytes, so this only scales their sum, and keeps it within the range of floats for most words."""
    return probs * pieces.scale[:, None]


def _sums(spans, shape, values: list[np.ndarray], log: bool = False) -> np.ndarray:
    """Forward sums of all positions, (size + 1, *shape); values: of each span's rows, logs if ``log``."""
    alpha = np.full(shape, -np.inf if log else 0.0)
    alpha[0] = 0.0 if log else 1.0
    for (i, j, hit, _), v in zip(spans, values):
        if log:
            alpha[j, hit] = np.logaddexp(alpha[j, hit], alpha[i, hit] + v)
        else:
            alpha[j, hit] += alpha[i, hit] * v
    return alpha


def _rare(total: np.ndarray) -> np.ndarray:
    """Rows whose sum has left the range in which floats are exact; they are summed as logs."""
    ok = (total > 1e-280) & (total < 1e280)
    return np.flatnonzero(~(ok if ok.ndim == 1 else ok.all(axis=1)))


def log_likelihoods(found: list[str], pieces: Pieces, probs: np.ndarray) -> np.ndarray:
    """log of the sum over all segmentations, (words, languages)."""
    out, scaled = np.empty((len(found), probs.shape[1])), _scaled(pieces, probs)
    for at, rows in _by_length(found):
        n, size = rows.shape
        spans = pieces.spans(rows)
        total = _sums(spans, (size + 1, n, probs.shape[1]), [scaled[ids] for *_, ids in spans])[size]
        with np.errstate(divide="ignore"):
            out[at] = np.log(total) - size * np.log(_PER_BYTE)
        if len(rare := _rare(total)):
            spans = pieces.spans(rows[rare])
            logs = [np.log(probs[ids]) for *_, ids in spans]
            out[at[rare]] = _sums(spans, (size + 1, len(rare), probs.shape[1]), logs, log=True)[size]
    for at, lattice in _long(found, pieces):
        for k in range(probs.shape[1]):
            out[at, k] = lattice.forward(np.log(probs[lattice.piece, k]))[lattice.last]
    return out


def expected_counts(found: list[str], lang: np.ndarray, weight: np.ndarray, pieces: Pieces,
                    probs: np.ndarray) -> np.ndarray:
    """Expected piece counts (pieces, languages) of words, each of one language and with a weight."""
    langs = probs.shape[1]
    total = np.zeros(probs.size)
    flat = _scaled(pieces, probs).ravel()

    def add(spans, rows, of, w, log):
        n, size = rows.shape
        where = [ids * langs + of[hit] for _, _, hit, ids in spans]
        values = [np.log(probs.ravel()[x]) if log else flat[x] for x in where]
        alpha = _sums(spans, (size + 1, n), values, log)
        left = _rare(alpha[size])[:0] if log else _rare(alpha[size])
        if len(left):
            w = w.copy()
            w[left] = 0
        beta = np.full_like(alpha, -np.inf if log else 0.0)
        beta[size] = -alpha[size] if log else w / np.where(w > 0, alpha[size], 1.0)
        for (i, j, hit, _), v in zip(reversed(spans), reversed(values)):
            if log:
                beta[i, hit] = np.logaddexp(beta[i, hit], beta[j, hit] + v)
            else:
                beta[i, hit] += beta[j, hit] * v
        seen, gains = [], []
        for (i, j, hit, _), v, x in zip(spans, values, where):
            seen.append(x)
            gains.append(np.exp(alpha[i, hit] + v + beta[j, hit]) * w[hit] if log else alpha[i, hit] * v * beta[j, hit])
        total[:] += np.bincount(np.concatenate(seen), np.concatenate(gains), len(total))
        return left

    for at, rows in _by_length(found):
        left = add(pieces.spans(rows), rows, lang[at], weight[at], False)
        if len(left):
            add(pieces.spans(rows[left]), rows[left], lang[at][left], weight[at][left], True)
    for at, lattice in _long(found, pieces):
        where = lattice.piece * langs + lang[at][lattice.word]
        logs = np.log(probs.ravel()[where])
        alpha = lattice.forward(logs)
        beta = lattice.backward(logs, -alpha[lattice.last])
        gains = np.exp(alpha[lattice.start] + logs + beta[lattice.end]) * weight[at][lattice.word]
        total += np.bincount(where, gains, len(total))
    return total.reshape(-1, langs)


@dataclass
class Model:
    vocabulary: str
    langs: list[str]
    probs: np.ndarray  # (pieces, languages)

    def __post_init__(self):
        size = max(1, len(self.langs))
        self._known = PieceTable(self._likelihoods, np.float64, max(1 << 12, _CACHED // size))

    def __getstate__(self):
        return {"vocabulary": self.vocabulary, "langs": self.langs, "probs": self.probs}

    def __setstate__(self, state):
        self.__init__(**state)

    def _likelihoods(self, found: list[bytes]) -> list[bytes]:
        rows = log_likelihoods([w.decode() for w in found], pieces_of(self.vocabulary), self.probs)
        raw, step = rows.tobytes(), rows.shape[1] * 8
        return [raw[i:i + step] for i in range(0, len(raw), step)]

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and its share of the likelihood (equal priors) of each text; ``und`` and 0 without a letter."""
        langs, scores = ["und"] * len(texts), [0.0] * len(texts)
        data, cuts, counts = word_bytes(texts)
        if not self.langs or not len(cuts):
            return langs, scores
        flat, _ = self._known.ids(data, cuts)
        held = np.flatnonzero(counts)
        begin = (np.cumsum(counts) - counts)[held]
        total = np.add.reduceat(flat.reshape(-1, len(self.langs)), begin, axis=0)
        best = total.argmax(axis=1)
        share = 1 / np.exp(total - total.max(axis=1)[:, None]).sum(axis=1)
        for i, k, p in zip(held.tolist(), best.tolist(), share.tolist()):
            langs[i], scores[i] = self.langs[k], p
        return langs, scores


def _word_counts(batches):
    """(lang, word, n) of each slice: equal words of a language once."""
    hashes = PieceTable(None, np.uint8, 1)
    for batch in text_slices(batches):
        data, cuts, counts = word_bytes([t or "" for t in batch.column("text").to_pylist()])
        if not len(cuts):
            continue
        lang = batch.column("lang").dictionary_encode()
        stops = np.append(cuts[1:], len(data))
        keys = hashes.hashes(np.frombuffer(data, np.uint8), cuts, stops - cuts)
        of = np.repeat(lang.indices.to_numpy().astype(np.int64), counts)
        order = np.lexsort((keys, of))
        new = np.ones(len(order), bool)
        new[1:] = ((keys[order][1:] != keys[order][:-1]) | (of[order][1:] != of[order][:-1])
                   | ((stops - cuts)[order][1:] > PieceTable.LONGEST))  # of long words the hash does not tell all
        at = np.flatnonzero(new)
        one = order[at]
        yield pa.RecordBatch.from_arrays(
            [lang.dictionary.take(pa.array(of[one])),
             pa.array([data[a:b].decode() for a, b in zip(cuts[one].tolist(), stops[one].tolist())], pa.string()),
             pa.array(np.diff(np.append(at, len(order))), pa.int64())], ["lang", "word", "n"])


def _expected(batches, vocabulary: str, langs: list[str], probs: np.ndarray):
    pieces, at = pieces_of(vocabulary), {x: i for i, x in enumerate(langs)}
    total = np.zeros((len(pieces.pieces), len(langs)))
    for batch in batches:
        if not batch.num_rows:
            continue
        lang = batch.column("lang").dictionary_encode()
        own = np.array([at[x] for x in lang.dictionary.to_pylist()])[lang.indices.to_numpy()]
        total += expected_counts(batch.column("word").to_pylist(), own, batch.column("n").to_numpy().astype(float),
                                 pieces, probs)
    piece, lang = np.nonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(lang), pa.array(total[piece, lang])],
                                     ["piece", "lang", "n"])


def _smoothed(counts: np.ndarray) -> np.ndarray:
    return (counts + SMOOTH) / (counts.sum(axis=0) + SMOOTH * len(counts))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        vocabulary: str = VOCABULARY, rounds: int = ROUNDS) -> Model:
    """Learn from all texts with a non-null language whose crc32(doc_id) mod 3 is not 1.

    A language without a word is not learned; without any the model answers ``und``.
    """
    learn = (docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                         F.col(f"`{lang_col}`").cast("string").alias("lang"))
             .where("text IS NOT NULL AND lang IS NOT NULL").where(fold("doc_id", 3) != 1).select("text", "lang"))
    table = materialize(learn.mapInArrow(_word_counts, "lang string, word string, n long")
                        .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    langs = [r["lang"] for r in table.select("lang").distinct().orderBy("lang").collect()]
    pieces = pieces_of(vocabulary)
    probs = _smoothed(np.ones((len(pieces.pieces), len(langs))))
    if not langs:
        return Model(vocabulary, langs, probs)
    for _ in range(rounds):
        held = docs.sparkSession.sparkContext.broadcast(probs)
        sums = (table.mapInArrow(lambda it, held=held: _expected(it, vocabulary, langs, held.value),
                                 "piece long, lang long, n double")
                .groupBy("piece", "lang").agg(F.sum("n").alias("n")).toArrow())
        counts = np.zeros((len(pieces.pieces), len(langs)))
        counts[sums.column("piece").to_numpy(), sums.column("lang").to_numpy()] = sums.column("n").to_numpy()
        probs = _smoothed(counts)
    return Model(vocabulary, langs, probs)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per document row.

    A null text or one without a letter is ``und`` with score 0; of equally
    likely languages the first by name is taken; a null doc_id is not held out.
    """
    rows = text_rows(docs, id_col, text_col)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = held.value
        for batch in text_slices(batches):
            langs, scores = own.predict([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()),
                                              pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    got = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")
    return got.select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
                      "lang_pred", "score")
