"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Base spans (email, ip, card, phone) come from fixed rules and always count.
Wider candidate shapes (spelled-out addresses, numbers without a country code,
numbers that fail a check, credentials) get votes from three labelers:

* regex: does the span satisfy a strict form of its kind,
* gazetteer: do its parts occur in lists (domain ends, issuer prefixes, credential names),
* context: do cue words stand before it.

Votes (+1, 0, -1) of all documents are counted per kind in Spark; expectation-
maximisation on those counts estimates each labeler's reliability and the
probability of every vote pattern.  A logistic span classifier is trained on
these probabilities over cells of span features and votes, also counted over
all documents, and decides on candidates that are not base spans.  The driver
sees vote cells only, whose number does not depend on the data.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finspark.llm.common import text_rows, text_slices

# Kinds in the order in which spans are listed, and the base patterns.
BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = BASE_KINDS + ["secret"]
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")

# Gazetteers and cues.
DOMAIN_ENDS = frozenset("com org net edu gov io de fr es it uk eu info biz co us".split())
ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35")
CREDENTIALS = frozenset("password passwd pwd passphrase token secret apikey api_key api-key access_key "
                        "accesskey auth credential private_key client_secret session_key".split())
CUES = {
    "email": frozenset("email e-mail mail contact write address".split()),
    "ip": frozenset("ip host server address addr client from".split()),
    "card": frozenset("card visa mastercard amex credit payment pay number".split()),
    "phone": frozenset("phone tel telephone call mobile cell fax contact dial".split()),
    "secret": frozenset("login user key auth bearer credentials".split()),
}
DECOYS = frozenset("example sample test dummy version section page figure table order isbn".split())

# Lengths have no upper bound; what repeats is possessive or starts where its run does, hence linear.
_AT = re.compile(r"[\[(]\s?at\s?[\])]\s?", re.I)
_SPELLED_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:(?:\.|\s?[\[(]\s?dot\s?[\])]\s?)[A-Za-z0-9-]++)++", re.I)
_SPELLED_LOCAL = _LOCAL | frozenset("İıſK")  # re.I takes these for letters I, S and K
_LOCAL_NUMBER = re.compile(r"(?<![\w+.-])(?:\(\d{3}\)\x20?|\d{3}[-.\x20])\d{3}[-.\x20]\d{4}(?![\w-])", re.A)
_ASSIGNED = re.compile(r"(?<![\w-])([A-Za-z][A-Za-z0-9_-]++)\x20?[:=]\x20?[\"']?([^\s\"'<>,;|]{6,}+)")
_HEX = re.compile(r"(?<![\w])[0-9a-fA-F]{32,}+(?![\w])")
_DIGIT = re.compile(r"[0-9]")
_WORDS = re.compile(r"[A-Za-z][A-Za-z-]*")
_BEFORE = 32  # code points of context that cue words are looked for in


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str):
    """Leftmost non-overlapping matches, found from their @ signs in linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _spelled(text: str):
    """Leftmost non-overlapping spelled-out addresses, found from their (at) in linear time."""
    done, m = 0, _AT.search(text)
    while m:
        end = m.start()
        end -= end > done and text[end - 1].isspace()
        start = end
        while start > done and text[start - 1] in _SPELLED_LOCAL:
            start -= 1
        domain = _SPELLED_DOMAIN.match(text, m.end()) if start < end else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        m = _AT.search(text, max(m.end(), done))


def _parts_fit(ip: str) -> bool:
    return all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in ip.split("."))


def _only_digits(s: str) -> str:
    return "".join(_DIGIT.findall(s))


def base_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans of the four kinds (by kind, then start), and the matches that fail a check."""
    good, failed = [], []
    if "@" in text:
        good += [("email", a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return good, failed

    def add(kind, found, fits):
        for m in found:
            (good if fits(m.group()) else failed).append((kind, *m.span()))

    add("ip", _IP.finditer(text), _parts_fit)
    add("card", _CARD.finditer(text), lambda s: 16 <= len(d := _only_digits(s)) <= 19 and luhn(d))
    if "+" in text:
        add("phone", _PHONE.finditer(text), lambda s: 8 <= len(_only_digits(s)) <= 15)
    return good, failed


@dataclass(frozen=True)
class Candidate:
    kind: str
    start: int
    end: int
    base: bool
    votes: tuple[int, int, int]  # regex, gazetteer, context
    shape: tuple[int, int, int]  # length, share of digits, distinct signs: each in four classes


def _shape(s: str) -> tuple[int, int, int]:
    n = len(s)
    return (min(3, n // 12), min(3, 4 * len(_DIGIT.findall(s)) // n), min(3, len(set(s)) // 6))


def _context(text: str, kind: str, start: int) -> int:
    near = {w.lower() for w in _WORDS.findall(text, max(0, start - _BEFORE), start)}
    return (1 if near & CUES[kind] else 0) or (-1 if near & DECOYS else 0)


def _gazetteer(kind: str, s: str, key: str | None) -> int:
    if kind == "email":
        return 1 if re.split(r"[.\s\])]+", s.lower())[-1] in DOMAIN_ENDS else -1
    if kind == "card":
        return 1 if _only_digits(s).startswith(ISSUERS) else -1
    if kind == "secret" and key is not None:
        return 1 if key.lower() in CREDENTIALS else -1
    if kind == "ip":
        return -1 if s.split(".")[0].lstrip("0") in ("", "127") else 1
    return 0


def candidates(text: str) -> list[Candidate]:
    """All candidate spans of a text, base spans first; others never overlap a base span or each other."""
    good, failed = base_spans(text)
    found = [(k, a, b, True, 1, None) for k, a, b in good]
    # a number of few digits that fails a check is no candidate of anything
    wide = [(k, a, b, False, -1, None) for k, a, b in failed
            if k != "card" or 13 <= len(_only_digits(text[a:b])) <= 19]
    if "at" in text and ("(" in text or "[" in text):
        wide += [("email", a, b, False, 0, None) for a, b in _spelled(text)]
    if "=" in text or ":" in text:
        wide += [("secret", *m.span(2), False, 1 if re.search(r"[0-9]", m[2]) else 0, m[1])
                 for m in _ASSIGNED.finditer(text)]
    if _DIGIT.search(text):
        wide += [("phone", *m.span(), False, 1, None) for m in _LOCAL_NUMBER.finditer(text)]
        wide += [("secret", *m.span(), False, 1, None) for m in _HEX.finditer(text)]
    taken: list[tuple[int, int]] = []  # apart from each other: base spans that overlap are one range
    for a, b in sorted((a, b) for _, a, b, *_ in found):
        if taken and a < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(b, taken[-1][1]))
        else:
            taken.append((a, b))
    out = [Candidate(k, a, b, base, (rule, _gazetteer(k, text[a:b], key), _context(text, k, a)), _shape(text[a:b]))
           for k, a, b, base, rule, key in found]
    for k, a, b, base, rule, key in sorted(wide, key=lambda x: (x[1], -x[2], KINDS.index(x[0]))):
        i = bisect.bisect_left(taken, (a, a))
        if i and taken[i - 1][1] > a or i < len(taken) and taken[i][0] < b:
            continue
        bisect.insort(taken, (a, b))
        out.append(Candidate(k, a, b, base, (rule, _gazetteer(k, text[a:b], key), _context(text, k, a)),
                             _shape(text[a:b])))
    return out


def _posteriors(counts: dict[tuple[int, int, int], float], rounds: int = 50) -> dict:
    """EM over one kind's vote patterns: P(span is personal) of each pattern, and labeler reliabilities."""
    patterns = sorted(counts)
    weight = np.array([counts[p] for p in patterns], float)
    votes = np.array(patterns)
    prior = 0.5
    # tables[labeler][class][vote + 1], a labeler is right in 0.8 of its votes at first
    right = np.array([[[0.35, 0.5, 0.15], [0.1, 0.5, 0.4]]] * 3)
    for _ in range(rounds):
        like = np.ones((2, len(patterns)))
        for c in (0, 1):
            for j in range(3):
                like[c] *= right[j, c][votes[:, j] + 1]
        both = np.array([1 - prior, prior])[:, None] * like
        post = both / both.sum(axis=0)
        mass = post * weight
        prior = min(0.99, max(0.01, mass[1].sum() / weight.sum()))
        for j in range(3):
            for c in (0, 1):
                seen = np.bincount(votes[:, j] + 1, mass[c], 3) + 20 * np.array([[[0.35, 0.5, 0.15],
                                                                                  [0.1, 0.5, 0.4]]])[0, c]
                right[j, c] = seen / seen.sum()
    return {p: float(post[1, i]) for i, p in enumerate(patterns)}, right


def _span_features(kind: str, votes, shape) -> list[int]:
    """Indices of the one-hot features of a cell."""
    at = [0, 1 + KINDS.index(kind)]
    at += [6 + 3 * j + v + 1 for j, v in enumerate(votes)]
    at += [15 + 4 * j + s for j, s in enumerate(shape)]
    return at


_N_FEATURES = 27


def _fit_spans(cells: dict, target: dict, rounds: int = 300) -> list[float]:
    """Weighted logistic regression on soft labels, full-batch gradient steps."""
    keys = sorted(cells)
    x = np.zeros((len(keys), _N_FEATURES))
    for i, (kind, votes, shape) in enumerate(keys):
        x[i, _span_features(kind, votes, shape)] = 1
    weight = np.sqrt(np.array([cells[k] for k in keys], float))  # common cells shall not drown rare ones
    y = np.array([target[k[0]][k[1]] for k in keys])
    theta = np.zeros(_N_FEATURES)
    step = 4 / (x.sum(axis=1).max() * weight.sum())
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ theta))
        theta -= step * (x.T @ (weight * (p - y)) + 0.05 * theta)
    return theta.tolist()


@dataclass
class Model:
    theta: list[float] | None = None  # none learned: only base spans count
    reliabilities: dict[str, list] = field(default_factory=dict)

    def probability(self, c: Candidate) -> float:
        if c.base:
            return 1.0
        if self.theta is None:
            return 0.0
        z = sum(self.theta[i] for i in _span_features(c.kind, c.votes, c.shape))
        return 1 / (1 + math.exp(-z))

    def spans(self, text: str) -> list[tuple[str, int, int, bool]]:
        """(kind, start, end, base) by kind, then start."""
        got = [(c.kind, c.start, c.end, c.base) for c in candidates(text)
               if c.base or self.probability(c) >= 0.5]
        return sorted(got, key=lambda s: (KINDS.index(s[0]), s[1]))


def _cells(batches):
    seen = Counter()
    for batch in text_slices(batches):
        for text in batch.column("text").to_pylist():
            if text:
                seen.update((c.kind, *c.votes, *c.shape) for c in candidates(text))
    names = ["kind", "v0", "v1", "v2", "s0", "s1", "s2"]
    columns = list(zip(*seen)) or [()] * 7
    yield pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.string()), *(pa.array(c, pa.int32()) for c in columns[1:]),
         pa.array(list(seen.values()), pa.int64())], [*names, "n"])


def fit(docs: DataFrame, text_col: str = "text") -> Model:
    """Count votes over all documents, estimate reliabilities, train the span classifier."""
    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = "kind string, v0 int, v1 int, v2 int, s0 int, s1 int, s2 int, n long"
    found = (rows.mapInArrow(_cells, schema).groupBy("kind", "v0", "v1", "v2", "s0", "s1", "s2")
             .agg(F.sum("n").alias("n")).collect())  # at most 5 * 3^3 * 4^3 cells
    if not found:
        return Model()
    cells = {(r["kind"], (r["v0"], r["v1"], r["v2"]), (r["s0"], r["s1"], r["s2"])): r["n"] for r in found}
    target, reliabilities = {}, {}
    for kind in KINDS:
        counts = Counter()
        for (k, votes, _shape_), n in cells.items():
            if k == kind:
                counts[votes] += n
        if counts:
            target[kind], right = _posteriors(counts)
            reliabilities[kind] = right.tolist()
    return Model(_fit_spans(cells, target), reliabilities)


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("first", pa.int64()), ("last", pa.int64()),
                             ("base", pa.bool_())]))


def find(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) per document row: kind, first, last (code points, ``last`` exclusive), base.

    A null or empty text has no spans; repeated rows each give a row.
    """
    rows = text_rows(docs, id_col, text_col)

    def run(batches):
        for batch in text_slices(batches):
            got = [[{"kind": k, "first": a, "last": b, "base": base} for k, a, b, base in model.spans(t or "")]
                   for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(got, _SPANS)], ["doc_id", "spans"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, "
                                "spans array<struct<kind:string,first:long,last:long,base:boolean>>")


def masked(text: str | None, model: Model) -> str | None:
    """The text with each span replaced by its kind in brackets (overlapping spans: one mask).

    A mask can turn what stood beside it into a span of its own (a number that
    was too long is no longer), so it is repeated until none is left; each
    round takes signs away, and masks hold none of their own.
    """
    while text and (new := _masked_once(text, model)) != text:
        text = new
    return text


def _masked_once(text: str, model: Model) -> str:
    out, done = [], 0
    merged: list[list] = []
    for kind, a, b, _base in sorted(model.spans(text), key=lambda s: (s[1], -s[2])):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([kind, a, b])
    for kind, a, b in merged:
        out += [text[done:a], f"[{kind.upper()}]"]
        done = b
    return "".join(out) + text[done:]


def redact(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents with personal data masked in ``text_col``; all rows and other columns stay."""

    def run(batches):
        for batch in text_slices(batches, text_col):
            at = batch.schema.get_field_index(text_col)
            new = pa.array([masked(t, model) for t in batch.column(at).to_pylist()], batch.schema.field(at).type)
            yield batch.set_column(at, text_col, new)

    return docs.mapInArrow(run, docs.schema)
