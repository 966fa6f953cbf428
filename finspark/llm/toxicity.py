"""Toxicity by multiple-instance learning: noisy-or over sentence scores.

A document is a bag of sentences; a sentence is toxic with probability
sigmoid(bias + weights of its words), a document with 1 - prod(1 - sentence).
Only documents carry labels; the gradient of the document likelihood teaches
the sentence model, which then locates the offending sentences.

A word's features are the word and its first four to seven letters, hashed.
Learning uses at most ``max_docs`` labelled rows (the smallest hashes of
doc_id, so the choice does not depend on partitions); document frequencies of
all features over them are counted in Spark, all features tied to the label
are kept, and the sample, reduced to those features, is fitted by full-batch
Adam.  Scoring runs over all rows, without a shuffle.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finspark.llm.common import fold, materialize, text_rows, text_slices

MAX_DOCS = 20_000
MIN_DOCS = 3
_SPACE = 1 << 22  # hashed feature space
_CACHED = 300_000

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of the sentences that hold a letter, in code points."""
    return [m.span() for m in _SENTENCE.finditer(text) if _WORD.search(text, *m.span())]


def features(word: str) -> tuple[int, ...]:
    """Hashed ids of a lower-cased word and its prefixes."""
    names = [word] + [word[:n] + "*" for n in (4, 5, 6, 7) if len(word) > n]
    return tuple(zlib.crc32(x.encode()) % _SPACE for x in names)


@dataclass
class Model:
    bias: float
    weights: dict[int, float]  # by feature id

    def __post_init__(self):
        self._words: dict[str, float] = {}

    def __getstate__(self):
        return {"bias": self.bias, "weights": self.weights}

    def __setstate__(self, state):
        self.__init__(**state)

    def word(self, w: str) -> float:
        got = self._words.get(w)
        if got is None:
            if len(self._words) >= _CACHED:
                self._words.clear()
            got = self._words[w] = sum(self.weights.get(f, 0.0) for f in set(features(w)))
        return got

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """Probability of the document, and its sentences that are toxic (p >= 0.5)."""
        low = text.lower()
        if len(low) != len(text):  # a letter whose lower case is longer: keep offsets
            low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
        heavy = {w for w in set(_WORD.findall(low)) if self.word(w)}
        clean, log_none, found = 0, 0.0, []
        for start, end in sentences(low):
            own = set(_WORD.findall(low, start, end)) & heavy if heavy else ()
            if not own:
                clean += 1
                continue
            z = self.bias + sum(map(self.word, sorted(own)))
            log_none -= _softplus(z)
            if z >= 0:
                found.append((start, end, 1 / (1 + math.exp(-z))))
        log_none -= clean * _softplus(self.bias)
        return min(1.0, max(0.0, -math.expm1(log_none))), found


def _softplus(z: float) -> float:
    return max(z, 0.0) + math.log1p(math.exp(-abs(z)))


def _doc_frequencies(batches):
    toxic, clean = Counter(), Counter()
    for batch in text_slices(batches):
        for text, y in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            held = {f for w in set(_WORD.findall((text or "").lower())) for f in features(w)}
            (toxic if y else clean).update(held)
    ids = list(toxic.keys() | clean.keys())
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([toxic[i] for i in ids], pa.int64()),
                                      pa.array([clean[i] for i in ids], pa.int64())], ["feature", "pos", "neg"])


def _bags(batches, kept: dict[int, int]):
    """Per document: label, number of sentences without a kept feature, and the others' features."""
    for batch in text_slices(batches):
        ys, plain, bags = [], [], []
        for text, y in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            low, rest, bag = (text or "").lower(), 0, []
            for start, end in sentences(low):
                own = [kept[f] for w in sorted(set(_WORD.findall(low, start, end)))
                       for f in sorted(set(features(w))) if f in kept]
                if own:
                    bag.append(own)
                else:
                    rest += 1
            ys.append(y)
            plain.append(rest)
            bags.append(bag)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ys, pa.int32()), pa.array(plain, pa.int64()), pa.array(bags, pa.list_(pa.list_(pa.int32())))],
            ["label", "plain", "bags"])


def _fit_bags(y, plain, doc, where, feature, n_features, start, steps, decay):
    """Full-batch Adam on the noisy-or likelihood; returns (bias, weights).

    doc: the document of each sentence; where, feature: sentence and feature of each occurrence.
    """
    n_docs, n_sent = len(y), len(doc)
    theta = np.concatenate(([-7.0], start))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        z = theta[0] + np.bincount(where, theta[1:][feature], n_sent)
        p = np.exp(-np.logaddexp(0, -z))
        p0 = 1 / (1 + math.exp(-theta[0]))
        none = -np.bincount(doc, np.logaddexp(0, z), n_docs) - plain * np.logaddexp(0, theta[0])
        some = -np.expm1(none)
        # d loss / d log(none): 1 without toxicity, -none/(1-none) with it
        pull = np.where(y, -np.exp(none) / np.maximum(some, 1e-9), 1.0)
        by_sentence = pull[doc] * p
        grad = np.empty_like(theta)
        grad[0] = by_sentence.sum() + (pull * plain).sum() * p0
        grad[1:] = np.bincount(feature, by_sentence[where], n_features) + decay * theta[1:]
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        theta -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return float(theta[0]), theta[1:]


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
        text_col: str = "text", label_id_col: str = "doc_id", max_docs: int = MAX_DOCS,
        steps: int = 150, decay: float = 0.3) -> Model:
    """Learn from labelled rows whose crc32(doc_id) mod 5 is not 0.

    Null labels and ids teach nothing; of several labels of one document the
    highest counts.  Without toxic examples every score is near 0.
    """
    known = (labels.select(F.col(f"`{label_id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label"))
             .where("doc_id IS NOT NULL AND label IS NOT NULL").where(fold("doc_id", 5) != 0)
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)  # bounded, so it may be broadcast
    sample = materialize(text_rows(docs, id_col, text_col).join(F.broadcast(known), "doc_id")
                         .select("text", "label"))
    total = sample.agg(F.count("*"), F.sum("label")).first()
    n, pos = total[0], total[1] or 0
    if not pos or pos == n:
        return Model(-20.0 if not pos else 20.0, {})
    counts = (sample.mapInArrow(_doc_frequencies, "feature long, pos long, neg long")
              .groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
              .where(F.col("pos") >= MIN_DOCS))
    ahead = F.log((F.col("pos") + 0.1) / (pos + 0.2)) - F.log((F.col("neg") + 0.1) / (n - pos + 0.2))
    best = counts.withColumn("odds", ahead).where("odds > 1").orderBy("feature").collect()  # bounded by the sample
    kept = {r["feature"]: i for i, r in enumerate(best)}
    bags = sample.mapInArrow(lambda it: _bags(it, kept), "label int, plain long, bags array<array<int>>").toArrow()
    y = bags.column("label").to_numpy() > 0
    plain = bags.column("plain").to_numpy().astype(float)
    sentences_of = bags.column("bags").combine_chunks()
    own = sentences_of.flatten()
    doc = np.repeat(np.arange(len(y)), sentences_of.value_lengths().to_numpy())
    where = np.repeat(np.arange(len(own)), own.value_lengths().to_numpy())
    start = np.array([min(3.0, r["odds"]) for r in best]) * 0.5
    bias, weights = _fit_bags(y, plain, doc, where, own.flatten().to_numpy(), len(best), start, steps, decay)
    return Model(bias, {f: float(weights[i]) for f, i in kept.items() if abs(weights[i]) > 1e-3})


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, offending) per document row; ``offending`` lists the toxic
    sentences as (first, last, score), code points, ``last`` exclusive.

    A null or empty text has no sentences: score 0 and none offending.
    Repeated rows each give a row.
    """
    rows = text_rows(docs, id_col, text_col)
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())]))

    def run(batches):
        own = held.value
        for batch in text_slices(batches):
            got = [own.score(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([s for s, _ in got], pa.float64()),
                 pa.array([[{"first": a, "last": b, "score": p} for a, b, p in f] for _, f in got], kind)],
                ["doc_id", "score", "offending"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, "
                                "offending array<struct<first:long,last:long,score:double>>")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             **options) -> DataFrame:
    """``fit`` on docs and labels, then ``score``, with held_out and predicted (score >= 0.5).

    A null doc_id is not held out (and never learned from).
    """
    model = fit(docs, labels, id_col=id_col, text_col=text_col, **options)
    return score(docs, model, id_col, text_col).select(
        "doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending")


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The document rows that score below ``threshold``, with all their columns, where they are."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches):
        own = held.value
        for batch in text_slices(batches, text_col):
            texts = batch.column(text_col).to_pylist()
            yield batch.filter(pa.array([own.score(t or "")[0] < threshold for t in texts]))

    return docs.mapInArrow(keep, docs.schema)
