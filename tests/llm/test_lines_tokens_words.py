"""Line dedup, cross-tokenizer alignment and spelling variants against brute-force versions."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from finspark.llm import crosstok, linededup, queries, shards, spelling
from finspark.plans.views import table

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BLANK = " \t\n\v\f\r"


def folded(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def clashing(df):
    return df.withColumns({c: F.lit("clash") for c in ("high", "low", "n", "keeper", "word", "number", "a", "b", "pair",
                                                       "part", "n_lines", "row", "shard")})


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, clashing columns."""
    rng = random.Random(3)
    words = "alpha beta gamma delta epsilon zeta theta iota kappa lambda".split()
    texts = {1: None, 2: "", 3: " \n\t ", 4: "Footer line " + "x" * 40 + "\nown", 5: "q" * 30_000,
             6: " ".join(rng.choices(words, k=30_000)), 7: "É漢😀 don't▁ 12 34\r\n", 8: "a  b   c\n\n d "}
    rows = [(i, t, "en" if i % 2 else None, None, None) for i, t in texts.items()]
    rows += [rows[3], rows[3], rows[4], rows[4], (10, "  FOOTER line " + "x" * 40 + "\t\nsecond", None, "s", 5),
             (None, "footer Line " + "x" * 40, "en", "s", 1), (None, None, None, None, None)]
    return clashing(spark.createDataFrame(rows, SCHEMA))


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# 11 line dedup

def brute_lines(rows, min_chars, min_docs):
    """[(doc_id, text, n_lines, n_dropped)] of (doc_id, text) rows; a row is a document."""
    def key(line):
        return folded(line.strip(BLANK))

    held, keeper = Counter(), {}
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= min_chars:
                held[k] += 1
                keeper[k] = max((x for x in (keeper.get(k), i) if x is not None), default=None)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if held[key(x)] < min_docs or keeper[key(x)] is None or keeper[key(x)] == i]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def in_order(rows):
    return sorted(map(tuple, rows), key=repr)


def test_minimal_hash_numbers_every_key_once():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 63, 64, 5000):
        high, low = rng.integers(0, 1 << 64, (2, n), np.uint64)
        high[:n // 2] = 7  # equal upper halves are told apart by the lower ones
        own = linededup.MinimalHash.build(high, low)
        assert sorted(own.numbers(high, low).tolist()) == list(range(n))
    with pytest.raises(ValueError, match="repeat"):
        linededup.MinimalHash.build(np.zeros(2, np.uint64), np.zeros(2, np.uint64))


@pytest.mark.parametrize("per_shard", [1 << 19, 5])
def test_lines_against_brute_force(spark, per_shard, monkeypatch):
    monkeypatch.setattr(shards, "CACHE_BYTES", 1)  # every shard leaves the cache at once
    rng = random.Random(per_shard)
    lines = [f"{'Line' if i % 2 else 'line'} {i % 37} of the shared text" + "É" * (i % 3) for i in range(60)]
    rows = [(i, "\n".join(rng.choice(BLANK) + rng.choice(lines) + rng.choice(["", " \r", "\x1f"])
                          for _ in range(rng.randrange(12)))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = linededup.drop_repeated_lines(docs, min_chars=26, min_docs=4, keys_per_shard=per_shard)
    assert in_order(got.collect()) == in_order(brute_lines(rows, 26, 4))
    as_text = linededup.drop_repeated_lines(docs.withColumn("doc_id", F.format_string("d%03d", "doc_id")), min_chars=26,
                                            min_docs=4, keys_per_shard=per_shard)
    assert in_order(as_text.collect()) == in_order(brute_lines([(f"d{i:03d}", t) for i, t in rows], 26, 4))


def test_lines_odd_rows(spark, odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    for n in (2, 5):
        got = linededup.drop_repeated_lines(odd_docs, min_docs=n)
        assert in_order(got.collect()) == in_order(brute_lines(rows, 40, n))
    nameless = spark.createDataFrame([(None, "z" * 50)] * 6, "doc_id long, text string")
    assert {r["n_dropped"] for r in linededup.drop_repeated_lines(nameless).collect()} == {0}
    assert linededup.drop_repeated_lines(empty(spark)).collect() == []
    with pytest.raises(ValueError, match="min_docs"):
        linededup.drop_repeated_lines(odd_docs, min_docs=1)


# 12 cross-tokenizer alignment

def brute_alignment(texts):
    """{key: (n_a, n_b, n_groups, n_links, n_best, count_sum, groups)} by walking both token lists."""
    P, sentencepiece = pytest.importorskip("public_tokenizers"), pytest.importorskip("sentencepiece")
    from tokenizers import Tokenizer
    first = Tokenizer.from_file(str(P.path(crosstok.TOKENIZER_A)))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=str(P.path(crosstok.TOKENIZER_B)))
    signs = crosstok._signs()

    def a_bytes(i):
        return bytes(signs[s] for s in first.id_to_token(i))

    def b_bytes(i):
        p = second.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()

    found, counts = {}, Counter()
    for key, text in texts.items():
        a = [(i, a_bytes(i)) for i in first.encode(" " + text, add_special_tokens=False).ids] if text else []
        b = [(i, b_bytes(i)) for i in second.encode(text)] if text else []
        if any(b"".join(x for _, x in ids) != (" " + text).encode() for ids in (a, b) if text):
            a = b = []
        of_byte = [[i for i, (_, x) in enumerate(ids) for _ in x] for ids in (a, b)]
        met = list(dict.fromkeys(zip(*of_byte)))
        ends = [list(np.cumsum([len(x) for _, x in ids])) for ids in (a, b)]
        groups, begin = [], [0, 0]
        for end in sorted(set(ends[0]) & set(ends[1])):
            at = [e.index(end) + 1 for e in ends]
            groups.append("|".join(",".join(str(i) for i, _ in ids[s:t]) for ids, s, t in zip((a, b), begin, at)))
            begin = at
        links = [(a[x][0], b[y][0]) for x, y in met]
        counts.update(links)
        found[key] = (len(a), len(b), len(groups), links, ";".join(groups))
    top = defaultdict(int)
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    return {k: (na, nb, ng, len(links), sum(counts[p] == top[p[1]] for p in links), sum(counts[p] for p in links), text)
            for k, (na, nb, ng, links, text) in found.items()}


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


def test_alignment_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(crosstok, "_SEGMENT", 50)
    rng = random.Random(8)
    texts = ["", "a", " ", "  ", "   lead and   inner   runs  ", "café naïve 漢字 \U0001f600!", "x▁y", "<|endoftext|> </s> <0x41>",
             "tab\tline\n\n  end\r\n", "1234567 3.14e-10", "x" * 400, " " * 300 + "z", "\x00\x01"]
    texts += ["".join(rng.choices("abc  de\n.é", k=rng.randrange(400))) for _ in range(12)]
    want = brute_alignment(dict(enumerate(texts)))
    assert want[6] == (0, 0, 0, 0, 0, 0, "") and want[7][0] > 3  # U+2581 can't be returned; special strings are text
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)] + [(None, None, None, None, None)]
    docs = clashing(spark.createDataFrame(rows, SCHEMA)).repartition(3)
    for per_shard, tokens in ((1 << 21, 1 << 19), (20, 1)):
        monkeypatch.setattr(crosstok, "TOKENS", tokens)
        got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in crosstok.align(docs, pairs_per_shard=per_shard).collect()}
        assert got == want | {None: (0, 0, 0, 0, 0, 0, "")}
    assert crosstok.align(empty(spark)).collect() == []
    void = crosstok.align(spark.createDataFrame([("k", None), ("k", "")], "doc_id string, text string")).collect()
    assert [tuple(r) for r in void] == [("k", 0, 0, 0, 0, 0, 0, "")] * 2


def test_long_texts_are_encoded_alike_in_segments(monkeypatch):
    pytest.importorskip("public_tokenizers")
    own = crosstok.Pieces(crosstok.TOKENIZER_B)
    rng = random.Random(4)
    texts = ["".join(rng.choices(["word", " ", "  ", "a", "\n", "été", "▁"], k=300)) for _ in range(40)]
    whole = [own.model.encode(t) for t in texts]
    monkeypatch.setattr(crosstok, "_SEGMENT", 5)
    assert [ids.tolist() for ids in own.encode([t.encode() for t in texts])] == whole
    assert max(map(len, map(own._segments, texts))) > 20


@needs_data
def test_op12(spark):
    docs = table(spark, SF, "documents")
    want = brute_alignment({r["doc_id"]: r["text"] or "" for r in docs.collect()})
    got = queries.QUERIES["op12_cross_tokenizer"](spark, SF).collect()
    assert len(got) == len(want)
    for r in got:
        *numbers, groups = want[r["doc_id"]]
        digest = hashlib.sha256(groups.encode()).hexdigest() if numbers[0] else ""
        assert [r[c] for c in COLUMNS[:-1]] == numbers and r["groups_sha256"] == digest


# 13 spelling variants

def brute_variants(counts):
    """{word: (form, root, n, n_near, form_n)} by trying every edit."""
    letters = {c for w in counts for c in w}

    def near(w):
        cuts = [(w[:i], w[i:]) for i in range(len(w) + 1)]
        tried = {a + b[1:] for a, b in cuts if b} | {a + c + b for a, b in cuts for c in letters}
        tried |= {a + c + b[1:] for a, b in cuts if b for c in letters}
        return (tried & counts.keys()) - {w}

    found = {w: near(w) for w in counts}
    form = {}
    for w, others in found.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        if best and counts[best] >= 2 * counts[w]:
            form[w] = best
    out = {}
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, len(found[w]), counts.get(form.get(w)))
    return out


def brute_words(rows, every):
    counts = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = folded(w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if every and h % every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def found_variants(df):
    rows = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("per_partition", [100_000, 7])
def test_variants_against_brute_force(spark, per_partition):
    rng = random.Random(per_partition)
    counts = {}
    for _ in range(220):  # few letters: repeated letters, shared prefixes and long chains
        counts["".join(rng.choices("abé", k=rng.randrange(1, 8)))] = 3 * 2 ** rng.randrange(12)
    counts |= {"q" * 5000: 9, "q" * 5001: 40, "q" * 2500 + "r" + "q" * 2499: 9}
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(4)
    assert found_variants(spelling.variants(words, words_per_partition=per_partition)) == brute_variants(counts)


def test_words_odd_rows(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(spelling, "_PART", 100)
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    for every in (None, 3):
        got = {r["word"]: r["n"] for r in spelling.word_counts(odd_docs, damage_every=every).collect()}
        assert got == brute_words(rows, every) and got
    assert spelling.variants(spelling.word_counts(empty(spark))).collect() == []
    words = spark.createDataFrame([(None, 4), ("", 4), ("hello", 2), ("hello", 1), ("hallo", 6)], "word string, n long")
    assert found_variants(spelling.variants(words)) == {"hello": ("hallo", "hallo", 3, 1, 6), "hallo": (None, "hallo", 6, 1, None)}
    with pytest.raises(ValueError, match="ratio"):
        spelling.variants(words, ratio=1)


@needs_data
def test_op13(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    assert found_variants(queries.QUERIES["op13_spelling"](spark, SF)) == brute_variants(brute_words(rows, 97))
