"""Pre-token boundaries of byte-level BPE without a regex.

The split rule (contractions, letters, numbers, other signs, white space, with
one leading space) is a finite automaton over code-point classes.  Every code
point becomes a transition function of the automaton; functions form a small
monoid, so a batch of texts is scanned by composing function ids with a table
look-up, block by block: the scan is associative, runs over whole numpy
columns, and restarts at each text because its first code point is composed
with a constant function.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np

# Fixed values of the split rule: white space (Unicode property White_Space)
# and the letters after an apostrophe that form a contraction.
WHITE_SPACE = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
               0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]

LETTER, NUMBER, OTHER, SPACE = range(4)  # code-point classes

# Symbols: a class, refined by the neighbours that the rule looks at.
S_LETTER, S_NUMBER, S_OTHER, S_SHORT, S_LONG, S_PREFIX, S_GAP, S_MORE_GAP = range(8)
# States: what the code point just read belongs to.
CLOSED, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_PREFIX, ONE_LEFT, TWO_LEFT = range(7)
N_STATES = 7


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """(next state, whether the code point starts a piece)."""
    if symbol == S_LETTER:
        if state == TWO_LEFT:
            return ONE_LEFT, False
        if state == ONE_LEFT:
            return CLOSED, False
        return IN_LETTERS, state not in (IN_LETTERS, AFTER_PREFIX)
    if symbol == S_NUMBER:
        return IN_NUMBERS, state not in (IN_NUMBERS, AFTER_PREFIX)
    if symbol in (S_OTHER, S_SHORT, S_LONG):
        if state in (IN_OTHERS, AFTER_PREFIX):
            return IN_OTHERS, False  # an apostrophe inside a run of signs is a sign
        return {S_OTHER: IN_OTHERS, S_SHORT: ONE_LEFT, S_LONG: TWO_LEFT}[symbol], True
    if symbol == S_PREFIX:
        return AFTER_PREFIX, True
    return CLOSED, symbol == S_GAP


@lru_cache(1)
def _tables():
    """Code-point classes, the monoid's composition and value tables, the start table."""
    classes = np.full(0x110000, OTHER, np.uint8)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind in "LN":
            classes[cp] = LETTER if kind == "L" else NUMBER
    classes[WHITE_SPACE] = SPACE

    first = [tuple(_step(q, s)[0] for q in range(N_STATES)) for s in range(8)]
    ids = {f: i for i, f in enumerate(dict.fromkeys([tuple(range(N_STATES)), *first]))}
    ids |= {f: len(ids) + i for i, f in enumerate(
        dict.fromkeys(f for f in ((g[CLOSED],) * N_STATES for g in first) if f not in ids))}
    todo = list(ids)
    while todo:  # closure under composition
        f = todo.pop()
        for g in list(ids):
            for h in (tuple(g[q] for q in f), tuple(f[q] for q in g)):
                if h not in ids:
                    ids[h] = len(ids)
                    todo.append(h)
    members = list(ids)
    compose = np.array([[ids[tuple(g[q] for q in f)] for g in members] for f in members], np.uint16)
    value = np.array(members, np.uint8)
    plain = np.array([ids[f] for f in first], np.uint16)
    reset = np.array([ids[(f[CLOSED],) * N_STATES] for f in first], np.uint16)
    starts = np.array([[_step(q, s)[1] for s in range(8)] for q in range(N_STATES)], bool)
    return classes, compose, value, plain, reset, starts


def classes() -> np.ndarray:
    """The class of every code point."""
    return _tables()[0]


_WIDTH = 256


def _scan(fns: np.ndarray, compose: np.ndarray) -> np.ndarray:
    """Inclusive scan by composition: blocks in parallel, then block totals, then both."""
    n, size = len(fns), len(compose)
    if n <= _WIDTH:
        out = fns.copy()
        for i in range(1, n):
            out[i] = compose[out[i - 1], out[i]]
        return out
    rows = -(-n // _WIDTH)
    grid = np.zeros(rows * _WIDTH, np.uint16)  # id 0 is the identity
    grid[:n] = fns
    grid = np.ascontiguousarray(grid.reshape(rows, _WIDTH).T)
    flat = compose.ravel()
    for j in range(1, _WIDTH):
        grid[j] = flat[grid[j - 1].astype(np.int32) * size + grid[j]]
    totals = _scan(grid[-1], compose)
    before = np.concatenate((np.zeros(1, np.uint16), totals[:-1]))
    return flat[before.astype(np.int32) * size + grid].T.ravel()[:n]


def code_points(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes and the byte offset of each."""
    cps = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)
    raw = np.frombuffer(data, np.uint8)
    return cps, np.flatnonzero((raw & 0xC0) != 0x80)


def boundaries(data: bytes, text_starts: np.ndarray) -> np.ndarray:
    """Byte offsets at which pieces start in concatenated UTF-8 texts.

    ``text_starts``: byte offset of each text that is not empty, ascending.
    """
    if not data:
        return np.zeros(0, np.int64)
    classes, compose, value, plain, reset, starts = _tables()
    cps, at = code_points(data)
    n = len(cps)
    begin = np.searchsorted(at, text_starts)
    is_first = np.zeros(n + 1, bool)
    is_first[begin] = True
    is_first[n] = True
    cls = classes[cps]
    space = cls == SPACE
    # next code point of the same text is no white space / the previous one is
    before_text = np.zeros(n, bool)
    before_text[:-1] = ~space[1:]
    before_text &= ~is_first[1:]
    after_space = np.zeros(n, bool)
    after_space[1:] = space[:-1]
    after_space &= ~is_first[:-1]

    symbol = np.array([S_LETTER, S_NUMBER, S_OTHER, S_MORE_GAP], np.uint8)[cls]
    symbol[space & (before_text | ~after_space)] = S_GAP
    symbol[(cps == 0x20) & before_text] = S_PREFIX
    marks = np.flatnonzero(cps == 0x27)
    if len(marks):
        end = np.append(begin, n)[np.searchsorted(begin, marks, side="right")]
        padded = np.append(cps, [0, 0])
        for word in CONTRACTIONS:
            hit = marks + len(word) < end
            for k, letter in enumerate(word, 1):
                hit &= padded[marks + k] == ord(letter)
            symbol[marks[hit]] = S_SHORT if len(word) == 1 else S_LONG
    fns = plain[symbol]
    fns[begin] = reset[symbol[begin]]
    state = np.empty(n, np.uint8)
    state[0] = CLOSED
    state[1:] = value[:, CLOSED][_scan(fns, compose)[:-1]]
    state[begin] = CLOSED
    return at[starts.ravel()[state.astype(np.int16) * 8 + symbol]]


def split(text: str) -> list[str]:
    """Pieces of one text."""
    data = text.encode()
    cuts = [*boundaries(data, np.zeros(1, np.int64)).tolist(), len(data)]
    return [data[a:b].decode() for a, b in zip(cuts, cuts[1:])]


#: Bytes of a long text that are scanned at once.
SEGMENT = 4 << 20
_CUT = re.compile(rb"(?<=[0-9A-Za-z])[ \n]")


def segments(text: bytes) -> list[bytes]:
    """A long text cut before white space that follows a letter or number: a piece starts there whatever
    stands around, so the pieces of the segments are those of the text."""
    out, at = [], 0
    while len(text) - at > SEGMENT and (m := _CUT.search(text, at + SEGMENT)):
        out.append(text[at:m.start()])
        at = m.start()
    return [*out, text[at:]] if at else [text]


class PieceTable:
    """Ids of the pieces a worker has met: numpy columns under an open-addressing table, no object per piece.

    A piece is known by a 64-bit tabulation hash: the sum of a random number
    for each (offset, byte).  Pieces of over ``LONGEST`` bytes are not kept.
    ``encode(list of pieces) -> list of ids as bytes`` gives those not met.
    A table of more than ``limit`` pieces starts anew.
    """

    LONGEST = 64

    def __init__(self, encode, dtype: np.dtype, limit: int = 1 << 20):
        self.encode, self.dtype, self.limit = encode, np.dtype(dtype), limit
        self._random = np.random.default_rng(11).integers(0, 1 << 64, self.LONGEST << 8, np.uint64)
        self._reset(0)

    def _reset(self, expected: int) -> None:
        self._bits = max(10, (2 * max(self.limit, expected) - 1).bit_length())
        self._keys = np.zeros(1 << self._bits, np.uint64)
        self._rows = np.full(1 << self._bits, -1, np.int32)
        self._probes = self.pieces = self.used = 0
        self._first = np.zeros(1024, np.int64)  # of each row: where its ids start, and how many they are
        self._count = np.zeros(1024, np.int64)
        self._ids = np.zeros(4096, self.dtype)

    def hashes(self, raw: np.ndarray, cuts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """64-bit hash of each piece; pieces longer than ``LONGEST`` may share one."""
        at = np.arange(len(raw), dtype=np.int32) - np.repeat(cuts.astype(np.int32), sizes)
        np.minimum(at, self.LONGEST - 1, out=at)
        return np.add.reduceat(self._random[(at << 8) | raw], cuts)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self._bits)).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        row = self._rows[slot]
        out = np.where(self._keys[slot] == keys, row, -1)
        todo = np.flatnonzero((out < 0) & (row >= 0))
        for _ in range(self._probes - 1):
            if not len(todo):
                break
            slot[todo] = (slot[todo] + 1) & ((1 << self._bits) - 1)
            row = self._rows[slot[todo]]
            hit = self._keys[slot[todo]] == keys[todo]
            out[todo[hit]] = row[hit]
            todo = todo[~hit & (row >= 0)]
        return out

    def _insert(self, keys: np.ndarray, rows: np.ndarray) -> None:
        slot, probes = self._slot(keys), 0
        while len(keys):
            probes += 1
            free = self._rows[slot] < 0
            _, one = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
            put = one[free[one]]
            self._keys[slot[put]], self._rows[slot[put]] = keys[put], rows[put]
            left = np.ones(len(keys), bool)
            left[put] = False
            keys, rows, slot = keys[left], rows[left], (slot[left] + 1) & ((1 << self._bits) - 1)
        self._probes = max(self._probes, probes)

    def _store(self, ids: list[bytes]) -> np.ndarray:
        """Append the ids of new pieces; their rows."""
        new = np.frombuffer(b"".join(ids), self.dtype)
        count = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        rows = np.arange(self.pieces, self.pieces + len(ids))
        while self.used + len(new) > len(self._ids):
            self._ids = np.concatenate((self._ids, np.zeros_like(self._ids)))
        while rows[-1] >= len(self._first):
            self._first, self._count = (np.concatenate((x, np.zeros_like(x))) for x in (self._first, self._count))
        self._ids[self.used:self.used + len(new)] = new
        self._first[rows] = self.used + np.cumsum(count) - count
        self._count[rows] = count
        self.pieces += len(ids)
        self.used += len(new)
        return rows

    def ids(self, data: bytes, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces of ``data`` that start at ``cuts``, and where each piece's ids start (one more at the end)."""
        if not len(cuts):
            return np.zeros(0, self.dtype), np.zeros(1, np.int64)
        stops = np.append(cuts[1:], len(data))
        sizes = stops - cuts
        keys = self.hashes(np.frombuffer(data, np.uint8), cuts, sizes)
        short = sizes <= self.LONGEST
        row = np.where(short, self._find(keys), -1)
        new = np.flatnonzero(row < 0)
        if len(new) and self.pieces + len(new) > self.limit:
            self._reset(len(cuts))
            row[:] = -1
            new = np.arange(len(cuts))
        if len(new):
            # equal short pieces once, long ones each by itself
            brief, long = new[short[new]], new[~short[new]]
            _, one, same = np.unique(keys[brief], return_index=True, return_inverse=True)
            asked = np.concatenate((brief[one], long))
            rows = self._store(self.encode([data[a:b] for a, b in zip(cuts[asked].tolist(), stops[asked].tolist())]))
            row[brief], row[long] = rows[:len(one)][same], rows[len(one):]
            self._insert(keys[brief[one]], rows[:len(one)].astype(np.int32))
        count = self._count[row]
        at = np.append(0, np.cumsum(count))
        source = np.repeat(self._first[row] - at[:-1], count)
        source += np.arange(at[-1])
        return self._ids[source], at

    def texts(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as bytes; long texts go segment by segment."""
        if max(map(len, texts), default=0) > SEGMENT:
            return [b"".join(self._texts([s])[0] for s in segments(t)) for t in texts]
        return self._texts(texts)

    def _texts(self, texts: list[bytes]) -> list[bytes]:
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(lengths)
        begins = ends - lengths
        data = b"".join(texts)
        cuts = boundaries(data, begins[lengths > 0])
        ids, at = self.ids(data, cuts)
        bounds = at[np.append(np.searchsorted(cuts, begins), len(cuts))].tolist()
        return [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
