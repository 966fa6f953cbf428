"""Quality scores: random Fourier features, ridge by normal equations, isotonic calibration.

Statistics of every document (lengths, shares of kinds of characters,
repetition of words and lines) are standardised and mapped to random Fourier
features, whose inner products approximate a Gaussian kernel.  Partitions sum
their normal equations; the ridge solution is a small linear system.  Scores of
labelled rows that the ridge has not seen are counted by score bin in Spark and
made monotone (pool adjacent violators), which turns raw scores into
probabilities.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finspark.llm.common import byte_texts, fold, materialize, text_rows, text_slices

FEATURES = 256
RIDGE = 1e-3
BINS = 1000
SEED = 7

STATISTICS = [
    "log_bytes", "log_words", "word_length", "word_length_spread", "upper", "digits", "spaces", "stops",
    "exclaims", "signs", "non_ascii", "entropy", "distinct_words", "top_word", "short_words", "capital_words",
    "signed_words", "log_lines", "distinct_lines", "stopped_lines", "repeated_pairs", "longest_word",
]


def _kinds() -> np.ndarray:
    """Of every byte: is it upper case, digit, white space, stop, exclamation, other sign, non-ASCII."""
    kinds = np.zeros((256, 7))
    for b in range(256):
        c = chr(b)
        kinds[b] = (0x41 <= b <= 0x5A, 0x30 <= b <= 0x39, b < 128 and c.isspace(), c in ".,;:?", c == "!",
                    b < 128 and not c.isalnum() and not c.isspace() and c not in ".,;:?!", b >= 0xC0)
    return kinds


_KINDS = _kinds()
_SIGNS = b"!#$%&*+/<=>@[\\]^_`{|}~"
_NO_SIGNS = bytes(b for b in range(256) if b not in _SIGNS)


def _words_and_lines(text: bytes) -> list[float]:
    found = text.split()
    n = len(found)
    if not n:
        return [0.0] * 13
    sizes = np.fromiter(map(len, found), np.float64, n)
    count = Counter(found)
    pairs = len(set(zip(found, found[1:])))
    lines = [x for x in text.split(b"\n") if x.strip()]
    return [math.log1p(n), min(50.0, float(sizes.mean())), min(50.0, float(sizes.std())), len(count) / n,
            max(count.values()) / n, float((sizes <= 3).mean()),
            sum(map(bytes.isupper, found)) / n,
            sum(1 for w, c in count.items() for _ in range(c) if w.translate(None, _NO_SIGNS)) / n,
            math.log1p(len(lines)), len(set(lines)) / len(lines),
            sum(x.rstrip()[-1:] in (b".", b"!", b"?", b":") for x in lines) / len(lines),
            1 - pairs / max(1, n - 1), math.log1p(float(sizes.max()))]


def text_statistics(texts: list[bytes]) -> np.ndarray:
    """(texts, STATISTICS); an empty text has zeros."""
    n = len(texts)
    sizes = np.fromiter(map(len, texts), np.int64, n)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    own = np.repeat(np.arange(n) * 256, sizes)
    hist = np.bincount(own + raw, minlength=n * 256).reshape(n, 256).astype(float)
    share = hist / np.maximum(sizes, 1)[:, None]
    entropy = -(share * np.log(np.where(share > 0, share, 1))).sum(axis=1)
    kinds = share @ _KINDS
    w = np.array([_words_and_lines(t) for t in texts]).reshape(n, 13)
    return np.column_stack((np.log1p(sizes), w[:, 0], w[:, 1], w[:, 2], kinds, entropy, w[:, 3], w[:, 4], w[:, 5],
                            w[:, 6], w[:, 7], w[:, 8], w[:, 9], w[:, 10], w[:, 11], w[:, 12]))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, one double column per statistic) of every document row; null is the empty text."""
    rows = text_rows(docs, id_col, text_col)

    def run(batches):
        for batch in text_slices(batches):
            x = text_statistics(byte_texts(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c) for c in x.T)],
                                             ["doc_id", *STATISTICS])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{s} double" for s in STATISTICS))


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    waves: np.ndarray
    phase: np.ndarray
    weights: np.ndarray | None = None
    knots: tuple[np.ndarray, np.ndarray] | None = None  # raw scores and calibrated ones

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        z = math.sqrt(2 / self.waves.shape[1]) * np.cos(z @ self.waves + self.phase)
        return np.column_stack((z, np.ones(len(z))))

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        return np.clip(np.interp(self.raw(x), *self.knots), 0, 1)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(s).to_numpy(zero_copy_only=False) for s in STATISTICS])


def _equations(batches, model: Model):
    """Sums of one partition: features' products, features times label, as one row."""
    size = model.waves.shape[1] + 1
    left, right, n = np.zeros((size, size)), np.zeros(size), 0
    for batch in batches:
        z = model.features(_matrix(batch))
        left += z.T @ z
        right += z.T @ batch.column("label").to_numpy(zero_copy_only=False).astype(float)
        n += len(z)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([left.tobytes()]), pa.array([right.tobytes()]), pa.array([n])],
                                         ["xx", "xy", "n"])


def _added(batches):
    left = right = n = None
    for batch in batches:
        for a, b, c in zip(*(x.to_pylist() for x in batch.columns)):
            a, b = np.frombuffer(a), np.frombuffer(b)
            left, right, n = (a, b, c) if n is None else (left + a, right + b, n + c)
    if n is not None:
        yield pa.RecordBatch.from_arrays([pa.array([left.tobytes()]), pa.array([right.tobytes()]), pa.array([n])],
                                         ["xx", "xy", "n"])


def pool_adjacent(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the isotonic fit of y (means, weighted) on ascending x: block centres and block means."""
    blocks: list[list[float]] = []  # weight, sum of y, sum of x
    for a, b, w in zip(x, y, weight):
        blocks.append([w, w * b, w * a])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    w, sy, sx = np.array(blocks).T
    return sx / w, sy / w


def fit(stats: DataFrame, labels: DataFrame, label_col: str = "quality", label_id_col: str = "doc_id",
        features: int = FEATURES, ridge: float = RIDGE, seed: int = SEED) -> Model:
    """Learn from all labelled rows whose crc32(doc_id) mod 5 is not 0: remainders 1 to 3 give the
    ridge scores, remainder 4 the calibration.

    Null labels and ids teach nothing; of several labels of one document the
    highest counts.  Without labels every score is 0.5.
    """
    moments = stats.agg(F.count("*"), *(f(s) for s in STATISTICS for f in (F.avg, F.stddev_pop))).first()
    rng = np.random.default_rng(seed)
    d = len(STATISTICS)
    mean, spread = (np.array([m or 0.0 for m in moments[1 + i::2]], float) for i in (0, 1))
    model = Model(mean, np.where(spread > 1e-9, spread, 1.0), rng.normal(0, 1 / math.sqrt(d), (d, features)),
                  rng.uniform(0, 2 * math.pi, features))
    known = (labels.select(F.col(f"`{label_id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label"))
             .where("doc_id IS NOT NULL AND label IS NOT NULL").where(fold("doc_id", 5) != 0)
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    taught = materialize(stats.join(known, "doc_id").withColumn("part", fold("doc_id", 5)).drop("doc_id"))
    schema = "xx binary, xy binary, n long"
    sums = taught.where("part <> 4").mapInArrow(lambda it: _equations(it, model), schema)
    tasks = max(1, math.isqrt(taught.rdd.getNumPartitions()))
    got = sums.repartition(tasks).mapInArrow(_added, schema).collect()  # at most the root of the partitions
    if not got:
        return model
    size, n = features + 1, sum(r["n"] for r in got)
    left = sum(np.frombuffer(r["xx"]) for r in got).reshape(size, size)
    right = sum(np.frombuffer(r["xy"]) for r in got)
    penalty = np.eye(size) * ridge * n / 10
    penalty[-1, -1] = 0
    model.weights = np.linalg.solve(left + penalty + np.eye(size) * 1e-9, right)

    def binned(batches):
        for batch in batches:
            b = np.clip(model.raw(_matrix(batch)) * BINS / 2 + BINS / 4, 0, BINS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(b), batch.column("label")], ["bin", "label"])

    def curve(rows):
        return (rows.mapInArrow(binned, "bin long, label int").groupBy("bin")
                .agg(F.count("*").alias("n"), F.avg("label").alias("y")).orderBy("bin").collect())

    bins = curve(taught.where("part = 4")) or curve(taught)
    x = (np.array([r["bin"] for r in bins]) + 0.5 - BINS / 4) * 2 / BINS
    x, y = pool_adjacent(x, np.array([r["y"] for r in bins]), np.array([float(r["n"]) for r in bins]))
    # straight lines between blocks keep the order of raw scores, towards 0 and 1 outside
    model.knots = (np.concatenate(([min(x[0], -0.5) - 0.5], x, [max(x[-1], 1.5) + 0.5])),
                   np.concatenate(([0.0], y, [1.0])))
    return model


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            threshold: float = 0.3, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) per document row; the texts are read once.

    Null and empty texts are scored by their (zero) statistics; repeated rows
    each give a row; a null doc_id is not held out.
    """
    stats = materialize(statistics(docs, id_col, text_col))
    model = fit(stats, labels, **options)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(held.value.score(_matrix(batch)))],
                                             ["doc_id", "score"])

    kind = stats.schema["doc_id"].dataType.simpleString()
    return stats.mapInArrow(run, f"doc_id {kind}, score double").select(
        "doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
