"""Brute-force versions, round trips and edge cases of the document operators."""

import base64
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from finspark.llm import (bpe, components, langid, merkle, pii, pretokenize, quality, simhash, token_store,
                          toxicity, winnowing, wumanber)

WORDS = "alpha beta gamma delta eps zeta eta theta iota kappa lam mu nu xi omi pi rho sigma tau ups phi".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join(rng.choices(WORDS, k=n))


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows and ties, columns with clashing names."""
    rng = random.Random(1)
    texts = {1: None, 2: "", 3: " \n\t ", 4: prose(rng, 40), 5: prose(rng, 40), 6: "x" * 30_000,
             7: prose(rng, 20_000), 8: "É漢😀 don't 'twas 12 34\r\n", 9: "!!!"}
    rows = [(i, t, "en" if i % 2 else None, None, None) for i, t in texts.items()]
    rows += [rows[3], rows[3], (10, texts[4], None, "s", 5), (None, "no id here", "en", "s", 1), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in ("fp", "score", "ids", "bucket", "part", "label", "node", "items")})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# 1 winnowing

def brute_winnow(text, gram, window):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    if not text:
        return []
    gram = min(gram, len(text))
    hashes = [int(winnowing.winnow(text[i:i + gram], gram, 1)[0][0]) for i in range(len(text) - gram + 1)]
    window, out = min(window, len(hashes)), []
    for i in range(len(hashes) - window + 1):
        at = max(range(i, i + window), key=lambda j: (-hashes[j], j))
        if not out or out[-1] != (hashes[at], at):
            out.append((hashes[at], at))
    return out


def test_winnow_is_rightmost_minimum_of_every_window(monkeypatch):
    monkeypatch.setattr(winnowing, "_CHUNK", 7)
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choices("abABé😀 ", k=rng.randint(0, 60)))
        gram, window = rng.randint(1, 6), rng.randint(1, 9)
        h, p = winnowing.winnow(text, gram, window)
        assert list(zip(h.tolist(), p.tolist())) == brute_winnow(text, gram, window)


def test_shared_passage_gives_common_hash_with_positions():
    rng = random.Random(3)
    passage = "".join(rng.choices("abcdefgh ", k=winnowing.GRAM + winnowing.WINDOW - 1))
    a, b = ("".join(rng.choices("ijklmnop", k=n)) + passage + "".join(rng.choices("qrst", k=99)) for n in (50, 333))
    found = [dict(zip(*(x.tolist() for x in winnowing.winnow(t)))) for t in (a, b)]
    common = found[0].keys() & found[1].keys()
    assert common and all(found[1][h] - found[0][h] == 333 - 50 for h in common)


def test_compare_edited_follows_descending_ids(spark):
    rng = random.Random(4)
    texts = {i: prose(rng, rng.randint(0, 60)) for i in rng.sample(range(1000), 60)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in winnowing.compare_edited(df, bytes_per_range=300).collect()}
    ids = sorted(texts, reverse=True)
    assert len(got) == len(ids)
    for at, i in enumerate(ids):
        after = texts[ids[(at + 1) % len(ids)]]
        edited = texts[i][:len(texts[i]) - len(texts[i]) // 2] + after[:len(texts[i]) // 2]
        own = winnowing.winnow(texts[i])[0]
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i]["near_edited"] == winnowing.likeness(own, winnowing.winnow(edited)[0])
        assert got[i]["near_next"] == winnowing.likeness(own, winnowing.winnow(after)[0])


def test_winnowing_odd_rows(spark, odd_docs):
    got = winnowing.compare_edited(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by_text = {}
    for r in got:
        by_text.setdefault(r["doc_id"], set()).add(bytes(r["selected"]))
    assert by_text[4] == by_text[10] and len(by_text[4]) == 1 and by_text[1] == by_text[2] == {b""}
    assert winnowing.compare_edited(empty(spark)).count() == 0
    alone = spark.createDataFrame([(5, "abcd")], "doc_id long, text string")
    assert winnowing.compare_edited(alone).first()["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()
    assert winnowing.fingerprints(odd_docs).count() == odd_docs.count()


# 2 simhash

def brute_simhash(text):
    import xxhash
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, bits):
    ids = sorted(fps)
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(ids, 2):
        if (fps[a] ^ fps[b]).bit_count() <= bits and top(a) != top(b):
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


def test_simhash_bits():
    rng = random.Random(5)
    for n in (0, 1, 2, 3, 4, 50, 3000):
        text = prose(rng, n).title() + " \n"
        assert simhash.simhash(text.encode()) % (1 << 64) == brute_simhash(text)


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_near_links_connect_what_pairs_connect(spark, bits, monkeypatch):
    rng = random.Random(bits)
    fps = {rng.getrandbits(64) for _ in range(40)}
    for f in list(fps):  # chains, and a ball of near fingerprints
        for _ in range(rng.randint(0, 6)):
            f ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, bits + 1)))
            fps.add(f)
    centre = rng.getrandbits(64)
    fps |= {centre ^ sum(1 << b for b in rng.sample(range(12), rng.randint(0, 3))) for _ in range(150)}
    signed = {f: f - (1 << 64) if f >> 63 else f for f in fps}
    df = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    for limit in (simhash._ALL_PAIRS, 4):  # the second takes the way of long lists
        rows = []
        real = simhash._Index.links
        index = simhash._Index(bits)
        monkeypatch.setattr(simhash, "_ALL_PAIRS", limit)
        arr = np.sort(np.array(list(fps), np.uint64))
        by_list = {}
        for c, m in enumerate(index.masks):
            for f in arr.tolist():
                by_list.setdefault((c, f & m), []).append(f)
        for (c, _), own in by_list.items():
            own = np.array(own, np.uint64)
            rows += [(int(own[i]), int(own[j])) for i, j in real(index, own, c)]
        root = {f: f for f in fps}

        def top(i):
            while root[i] != i:
                i = root[i]
            return i

        for a, b in rows:
            assert (a ^ b).bit_count() <= bits
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
        assert {f: top(f) for f in fps} == brute_components({f: f for f in fps}, bits)
    links = simhash.near_links(df, bits)
    got = {r["node"]: r["root"] for r in components.connected_components(links).collect()}
    want = brute_components({s: f for f, s in signed.items()}, bits)
    assert {s: got.get(s, s) for s in signed.values()} == want


def test_near_duplicates_whole(spark, odd_docs):
    rng = random.Random(6)
    base = [prose(rng, 300) for _ in range(10)]
    docs = [(i, t) for i, t in enumerate(base)] + [(100 + i, t) for i, t in enumerate(base[:5])]
    docs += [(200 + i, t.replace(" ", "  ") + " x") for i, t in enumerate(base)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: (r["fp"] % (1 << 64), r["component_id"]) for r in simhash.near_duplicates(df).collect()}
    fps = {i: brute_simhash(t) for i, t in docs}
    parts = brute_components(fps, 2)
    assert got == {i: (fps[i], parts[i]) for i in fps}
    kept = {r["doc_id"] for r in simhash.without_near_duplicates(df).collect()}
    assert kept == set(parts.values())

    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    of = {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] is not None}
    assert of[1] == of[2] == of[3] == 1 and of[4] == of[10] == 4
    left = simhash.without_near_duplicates(odd_docs)
    assert left.columns == odd_docs.columns
    ids = sorted((r["doc_id"] for r in left.collect()), key=str)
    assert ids.count(4) == 1 and ids.count(None) == 2 and 10 not in ids and 2 not in ids
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_near_duplicates_go_by_row(spark):
    rng = random.Random(41)
    a, b, c, d = (prose(rng, 200) for _ in range(4))
    rows = [(1, a, "x"), (1, b, "x"), (1, b, "y"), (2, b, "x"), (2, c, "x"), (3, c, "x"), (None, d, "x"), (None, d, "x"),
            (None, d, "y"), (None, a + " ", "x")]
    shuffled = rng.sample(rows, len(rows))
    got = []
    for own in (rows, shuffled):
        df = spark.createDataFrame(own, "doc_id long, text string, source string").repartition(5)
        got.append(sorted(map(tuple, simhash.without_near_duplicates(df).collect()), key=str))
    assert got[0] == got[1]
    assert sorted((r[:2] for r in got[0]), key=str) == sorted([(1, a), (1, b), (2, c), (None, d), (None, a + " ")], key=str)


def test_components_of_chains_hubs_and_loops(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 80)] + [(500, 500), (None, 3), (7, None)]
    got = {r["node"]: r["root"] for r in
           components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(80)}, 500: 500}


# 3 byte-level BPE

@pytest.fixture(scope="module")
def library():
    tiktoken = pytest.importorskip("tiktoken")
    P = pytest.importorskip("public_tokenizers")
    import base64
    with open(P.path(bpe.VOCABULARY), "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return P, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=table, special_tokens={})


SIGNS = list(" \n\t'srtvemld aZé9²!.?  漢😀\x1c\x85᠎​　") + ["'s", "'re", " '", "'ll", "  ", "<|endoftext|>"]


def odd_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(SIGNS, k=rng.randint(0, 14))) for _ in range(n)]


def test_pieces_are_those_of_the_pattern(library):
    import regex
    pattern = regex.compile(library[0].PATTERN)
    for t in odd_texts(3000, 7) + [" " * 700 + "a", "ab" * 400 + "\n" * 300]:
        assert pretokenize.split(t) == pattern.findall(t)


def test_encode_like_the_library_and_back(library):
    table = bpe.ranks(bpe.VOCABULARY)
    texts = odd_texts(5000, 8) + ["a" * 5000, "x y" * 3000, "ab" * 40, "é" * 30, "'" * 100, "日本語" * 40]
    for text, ids in zip(texts, table.encode([t.encode() for t in texts])):
        own = np.frombuffer(ids, "<u4")
        assert own.tolist() == library[1].encode_ordinary(text)
        ends = table.ends(own)
        assert table.decode(own, ends) == text.encode()
        if len(own) > 3:  # any range of tokens decodes by its offsets
            assert table.decode(own[1:3], ends[1:3] - ends[0]) == text.encode()[ends[0]:ends[2]]


def test_long_texts_go_by_segments(library, monkeypatch):
    monkeypatch.setattr(pretokenize, "SEGMENT", 20)
    monkeypatch.setattr(bpe, "_TOKENS", 7)
    rng = random.Random(20)
    texts = ["".join(rng.choices([*SIGNS, "word", " it's", "\n\n", "9  "], k=200)) for _ in range(60)]
    table = bpe.ranks(bpe.VOCABULARY)
    assert any(len(pretokenize.segments(t.encode())) > 3 for t in texts)
    for t, ids in zip(texts, table.encode([t.encode() for t in texts])):
        own = np.frombuffer(ids, "<u4")
        assert own.tolist() == library[1].encode_ordinary(t)
        assert table.decode(own, table.ends(own)) == t.encode()


@pytest.mark.parametrize("limit", [5, 60, 400])
def test_full_table_of_pieces(library, limit, monkeypatch):
    monkeypatch.setattr(pretokenize.PieceTable, "LONGEST", 6)
    table = bpe.Ranks(bpe.vocabulary_path(bpe.VOCABULARY))
    table.known = pretokenize.PieceTable(table.piece_ids, "<u4", limit)
    for seed in range(8):
        texts = odd_texts(40, seed % 6) + ["longer than six", ""]
        got = table.encode([t.encode() for t in texts])
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [library[1].encode_ordinary(t) for t in texts]
    # a piece met before is not encoded again
    table.known = pretokenize.PieceTable(table.piece_ids, "<u4")
    table.encode([b"some words"])
    table.known.encode = None
    assert table.encode([b"some words words"])


def test_bpe_operators(spark, odd_docs, library):
    apart = bpe.bpe_decode(bpe.bpe_encode(odd_docs)).collect()
    once = bpe.bpe_round_trip(odd_docs).collect()
    assert sorted(map(str, apart)) == sorted(map(str, once)) and len(once) == odd_docs.count()
    texts = {r["doc_id"]: r["text"] or "" for r in odd_docs.collect() if r["doc_id"]}
    for r in once:
        if r["doc_id"]:
            assert bytes(r["decoded"]).decode() == texts[r["doc_id"]]
            assert np.frombuffer(r["ids"], "<u4").tolist() == library[1].encode_ordinary(texts[r["doc_id"]])
    assert bpe.bpe_round_trip(empty(spark)).count() == 0


# 4 toxicity

def toxic_corpus(spark, n=600):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(n):
        sentences = [prose(rng, 8) for _ in range(rng.randint(1, 12))]
        bad = rng.random() < 0.25
        if bad:
            sentences[rng.randrange(len(sentences))] += " " + rng.choice(["vilestuff", "grimslur", "oafish"])
        docs.append((i, ". ".join(sentences) + "."))
        labels.append((i, int(bad)))
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(labels + [(3, None), (None, 1)], "doc_id long, toxic int"), dict(labels))


def test_toxicity_held_out_and_located(spark):
    docs, labels, truth = toxic_corpus(spark)
    got = toxicity.toxicity(docs, labels).collect()
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in got:
        for s in r["offending"]:
            assert re.search("vilestuff|grimslur|oafish", texts[r["doc_id"]][s["first"]:s["last"]])
    # labels of held-out rows change nothing
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
                                                1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, flipped).collect()}
    assert again == {r["doc_id"]: r["score"] for r in got}


def test_toxicity_odd_rows(spark, odd_docs):
    docs, labels, _ = toxic_corpus(spark, 200)
    model = toxicity.fit(docs, labels)
    got = toxicity.score(odd_docs, model).collect()
    assert len(got) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["score"] == 0 for r in got if r["doc_id"] in (1, 2, 3, 9))
    left = toxicity.without_toxic(odd_docs, model)
    assert left.columns == odd_docs.columns and left.count() == odd_docs.count()
    none = labels.where("false")
    assert toxicity.toxicity(docs, none).agg(F.max("predicted")).first()[0] == 0
    assert toxicity.toxicity(empty(spark), labels).count() == 0


def test_toxicity_keeps_rare_words_beside_many_common_ones(spark):
    rng = random.Random(37)
    common = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(1200))
    texts = [common] * 40 + ["zqvile " + prose(rng, 5)] * 10 + [prose(rng, 30) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 50)) for i in range(len(texts))], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert model.word("zqvile") > 1 and model.score("some zqvile words")[0] >= 0.5


# 5 Merkle audit

def test_audit_locates_every_difference(spark):
    ids = [-5, -1, 0, 3, 4, 70, 71, 4095, 4096, 70_000, None]
    rows = [(i, f"http://x/{i}", f"<p>{i}</p>") for i in ids] + [(70, "u", "again")]
    a = merkle.records(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert merkle.audit(a, a).count() == 0
    changed = [r if r[0] != 71 else (71, r[1], r[2].upper()) for r in rows if r[0] not in (3, 70_000)]
    changed[-1] = (70, "u", "other")
    changed.append((5, None, None))
    b = merkle.records(spark.createDataFrame(changed, "page_id long, url string, html string"))
    got = {r["record_id"]: r for r in merkle.audit(a, b).collect()}
    assert {i: r["kind"] for i, r in got.items()} == {3: "missing", 70_000: "missing", 71: "changed", 70: "changed", 5: "extra"}
    size = {r["record_id"]: 0 for r in a.collect()}
    for r in a.collect():
        size[r["record_id"]] += len(r["record"])
    assert (got[3]["first_offset"], got[3]["end_offset"]) == (size[0], size[0] + size[3])
    assert got[71]["first_offset"] == size[0] + size[3] + size[4] + size[70]
    assert (got[5]["first_offset"], got[5]["archive"]) == (None, 0)
    none = a.where("false")
    assert merkle.audit(none, none).count() == 0 and merkle.audit(a, none).count() == len(set(ids))
    assert {r["kind"] for r in merkle.audit(none, a).collect()} == {"extra"}


def test_audit_ignores_row_order_of_repeated_records(spark):
    rows = [(1, f"u{i}", "x") for i in range(20)]
    a, b = (merkle.records(spark.createDataFrame(r, "page_id long, url string, html string")) for r in (rows, rows[::-1]))
    assert merkle.audit(a, b).count() == 0
    assert merkle.audit(a, b.limit(19)).first()["kind"] == "changed"


# 6 PII

def brute_pii(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0][::-1] if c not in " -"]
        total = sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d))
        if 16 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
            if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(10)
    parts = ["a.b@c.d", "10.20.30.40", "+1 (504) 555-2652", "4179672074533673", "4111 1111 1111 1111", "@", "é"]
    for k in range(8000):
        t = "".join(rng.choices("a.@@-+ 0123459()é", k=rng.randint(0, 40)))
        if k % 3 == 0:
            t = re.sub("a", lambda m: rng.choice(parts), t)
        assert pii.base_spans(t)[0] == brute_pii(t)


def test_pii_linear_on_hostile_texts():
    for t in ("1" * 200_000, "a@" * 100_000, "1.1." * 50_000, "+1" + " " * 200_000, "a" * 200_000 + "@"):
        pii.base_spans(t)


def test_pii_spans_and_masks(spark, odd_docs):
    rows = [(1, "mail jo.doe@mail.example.com now, ip 10.0.0.12"), (2, 'token = "%s" end' % ("a1" * 20)),
            (3, "order 1234567890123456 is no card"), (4, None), (5, "nothing here")]
    rows += [(10 + i, f"call +1 (504) 555-26{i:02d} or password=s3cret{i}x") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.fit(df)
    got = {r["doc_id"]: [(s["kind"], s["first"], s["last"], s["base"]) for s in r["spans"]]
           for r in pii.find(df, model).collect()}
    texts = dict(rows)
    for i, spans in got.items():
        assert [s[:3] for s in spans if s[3]] == brute_pii(texts[i] or "")
        assert spans == sorted(spans, key=lambda s: (pii.KINDS.index(s[0]), s[1]))
    assert [s[0] for s in got[2]] == ["secret"] and [s[0] for s in got[11]] == ["phone", "secret"]
    assert got[3] == got[4] == got[5] == []
    clean = {r["doc_id"]: r["text"] for r in pii.redact(df, model).collect()}
    assert clean[1] == "mail [EMAIL] now, ip [IP]" and clean[11] == "call [PHONE] or password=[SECRET]"
    assert clean[3] == texts[3] and clean[4] is None
    # masking the address makes the number before it a phone number
    beside = pii.masked("at +1 (826) 55 4081 10.20.30.40 end", pii.Model())
    assert not pii.base_spans(beside)[0] and beside == "at [PHONE] [IP] end"

    assert pii.find(odd_docs, pii.fit(odd_docs)).count() == odd_docs.count()
    assert pii.redact(odd_docs, pii.Model()).columns == odd_docs.columns
    assert pii.find(empty(spark), pii.fit(empty(spark))).count() == 0


def test_pii_spans_have_no_longest_length():
    token, digits = "a1B2c3D4-_" * 100, "0123456789abcdef" * 32
    local, domain, key = "first.last" * 10, ".".join(f"part{i}" for i in range(9)) + ".com", "my_" * 20 + "token"
    for kind, text, span in (("secret", f"password={token} end", token), ("secret", f"key is {digits}, end", digits),
                             ("secret", f"{key} = {token}", token),
                             ("email", f"mail {local} (at) {domain} now", f"{local} (at) {domain}"),
                             ("email", f"mail a[at]{'b' * 80} dot c (dot) org", None)):
        spans = [(c.kind, text[c.start:c.end]) for c in pii.candidates(text) if c.kind == kind]
        assert spans == ([(kind, span)] if span else [])
    # within the former lengths addresses are those of one pattern
    pattern = re.compile(r"[A-Za-z0-9._%+-]{1,64}\s?[\[(]\s?at\s?[\])]\s?[A-Za-z0-9-]{1,63}"
                         r"(?:(?:\.|\s?[\[(]\s?dot\s?[\])]\s?)[A-Za-z0-9-]{1,63}){1,5}", re.I)
    rng = random.Random(31)
    for _ in range(20_000):
        t = "".join(rng.choices(["a", "b_", "(at)", " [ At ] ", ".c", " ", "(dot)", "[ DOT ]", "\u017f", "\u212a", "-", "("],
                                k=rng.randint(0, 14)))
        assert list(pii._spelled(t)) == [m.span() for m in pattern.finditer(t)]
    for t in ("a" * 200_000, "a(at)" * 50_000, "ab=" * 70_000, "f" * 200_000 + "x", "a(at)b" + ".c" * 90_000 + "(dot)"):
        pii.candidates(t)


# 7 language ID

def test_whole_vocabulary_is_used():
    pieces = langid.pieces_of(langid.VOCABULARY)
    with open(bpe.vocabulary_path(langid.VOCABULARY), "rb") as f:
        tokens = {base64.b64decode(line.split()[0]) for line in f} - {b""}
    assert tokens <= set(pieces.pieces) and max(map(len, tokens)) == langid.LONGEST
    rng = np.random.default_rng(3)
    probs = rng.random((len(pieces.pieces), 2)) * 1e-3
    index = {p: i for i, p in enumerate(pieces.pieces)}
    found = ["relationship", "unfortunately", "particularly", "просто"]
    assert all(b" " + w.encode() in index for w in found)
    for w, row in zip(found, langid.log_likelihoods(found, pieces, probs)):
        w, sums = b" " + w.encode(), [np.ones(2)]
        for j in range(1, len(w) + 1):
            sums.append(sum((sums[i] * probs[index[w[i:j]]] for i in range(j) if w[i:j] in index), np.zeros(2)))
        assert np.allclose(row, np.log(sums[-1]))


def test_forward_sums_all_segmentations():
    P = pytest.importorskip("public_tokenizers")
    assert P
    pieces = langid.pieces_of(langid.VOCABULARY)
    rng = np.random.default_rng(1)
    probs = rng.random((len(pieces.pieces), 3)) * 1e-3
    index = {p: i for i, p in enumerate(pieces.pieces)}

    def brute(w):
        w, sums = b" " + w.encode(), [np.ones(3)]
        for j in range(1, len(w) + 1):
            sums.append(sum((sums[i] * probs[index[w[i:j]]] for i in range(max(0, j - langid.LONGEST), j)
                             if w[i:j] in index), np.zeros(3)))
        return np.log(sums[-1])

    found = ["the", "straße", "él", "a", "internationalisation"]
    got = langid.log_likelihoods(found, pieces, probs)
    for w, row in zip(found, got):
        assert np.allclose(row, brute(w))
    # a word beyond the range of floats is summed as logs
    far = ["漢字" * 12]
    low = langid.log_likelihoods(far, pieces, probs * 1e-9)
    for k, row in ((1e-9, low),):
        w, sums = b" " + far[0].encode(), [np.zeros(3)]
        for j in range(1, len(w) + 1):
            parts = [sums[i] + np.log(probs[index[w[i:j]]] * k) for i in range(max(0, j - langid.LONGEST), j) if w[i:j] in index]
            sums.append(np.logaddexp.reduce(parts, axis=0))
        assert np.allclose(row[0], sums[-1]) and (sums[-1] < -800).all()
    # expected counts: every byte of a word lies in exactly one piece
    words, lang, weight = found + far, np.array([0, 1, 2, 1, 0, 2]), np.array([1.0, 2, 3, 1, 2, 4])
    length = np.array([len(p) for p in pieces.pieces])
    sizes = np.array([len(w.encode()) + 1 for w in words])
    for scale in (1.0, 1e-9):
        counts = langid.expected_counts(words, lang, weight, pieces, probs * scale)
        want = np.bincount(lang, weight * sizes, 3)
        assert np.allclose((counts * length[:, None]).sum(axis=0), want)
    one = langid.expected_counts(["ab"], np.array([1]), np.array([5.0]), pieces, probs)
    paths = {s: np.prod([probs[index[p], 1] for p in s]) for s in ((b" ", b"a", b"b"), (b" a", b"b"), (b" ", b"ab"), (b" ab",))
             if all(p in index for p in s)}
    assert np.isclose(one[index[b"b"], 1], 5 * sum(v for s, v in paths.items() if b"b" in s) / sum(paths.values()))


def test_words_of_any_length(monkeypatch):
    pieces = langid.pieces_of(langid.VOCABULARY)
    probs = np.random.default_rng(5).random((len(pieces.pieces), 2)) * 1e-3
    index = {p: i for i, p in enumerate(pieces.pieces)}
    found = ["donaudampfschifffahrtsgesellschaftskapitän", "漢字" * 300, "relationship" * 9, "просто" * 20, "ab", "x" * 3000]
    assert [langid.words(w) for w in found] == [[w] for w in found]
    for w, row in zip(found, langid.log_likelihoods(found, pieces, probs)):
        w, sums = b" " + w.encode(), [np.zeros(2)]
        for j in range(1, len(w) + 1):
            parts = [sums[i] + np.log(probs[index[w[i:j]]]) for i in range(max(0, j - 33), j) if w[i:j] in index]
            sums.append(np.logaddexp.reduce(parts, axis=0))
        assert np.allclose(row, sums[-1])
    lang, weight = np.array([0, 1, 0, 1, 1, 0]), np.array([1.0, 2, 3, 4, 5, 6])
    counts = langid.expected_counts(found, lang, weight, pieces, probs)
    sizes = np.array([len(w.encode()) + 1 for w in found])
    assert np.allclose(np.array([len(p) for p in pieces.pieces]) @ counts, np.bincount(lang, weight * sizes, 2))
    # both ways of summing give the same counts
    found, ways = ["gesellschaftskapitän", "relationship" * 3, "просто" * 3, "ab"], []
    for short in (1, 48):
        monkeypatch.setattr(langid, "_SHORT", short)
        ways.append(langid.expected_counts(found, lang[:4], weight[:4], pieces, probs))
    assert np.allclose(*ways)
    # long words that begin alike are counted apart
    alike = ["x" * 200 + "a", "x" * 200 + "b"]
    batch = pa.RecordBatch.from_pydict({"text": [" ".join(alike + alike[:1])], "lang": ["aa"]})
    rows = [r for b in langid._word_counts([batch]) for r in b.to_pylist()]
    assert {w: sum(r["n"] for r in rows if r["word"] == w) for w in alike} == {alike[0]: 2, alike[1]: 1}


def test_words_over_a_slice():
    rng = random.Random(21)
    texts = ["".join(rng.choices("abéÉ ß.1_漢😀²\n" + "x" * 3, k=rng.randint(0, 60))) for _ in range(500)]
    data, cuts, counts = langid.word_bytes(texts)
    got = [data[a:b].decode() for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(data)])]
    import regex
    want = [regex.findall(r"\p{L}{1,24}", t.lower()) for t in texts]
    assert got == [w for ws in want for w in ws] and counts.tolist() == list(map(len, want))
    assert langid.words("² 12 _") == []


def test_langid_held_out(spark, odd_docs):
    rng = random.Random(11)
    stems = {"aa": "the and of ing tion house water".split(), "bb": "der und die ung keit haus wasser".split(),
             "cc": "le et que ment eau maison".split()}
    rows = [(i, " ".join(rng.choice(stems[x]) + rng.choice(["", rng.choice(stems[x])]) for _ in range(20)), x)
            for i, x in enumerate(rng.choices(sorted(stems), k=300))]
    df = spark.createDataFrame(rows + [(900, "12 ?", "aa"), (901, None, "bb"), (902, "the house", None)],
                               "doc_id long, text string, lang string")
    model = langid.fit(df)
    got = {r["doc_id"]: r for r in langid.predict(df, model).collect()}
    truth = {i: x for i, _, x in rows}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i]["held_out"] for i in held) and sum(r["held_out"] for r in got.values() if r["doc_id"] < 900) == len(held)
    assert sum(got[i]["lang_pred"] == truth[i] for i in held) >= 0.98 * len(held)
    assert [(got[i]["lang_pred"], got[i]["score"]) for i in (900, 901)] == [("und", 0.0)] * 2
    assert got[902]["lang_pred"] == "aa" and 0 < got[902]["score"] <= 1
    out = langid.predict(odd_docs, langid.fit(odd_docs)).collect()
    assert len(out) == odd_docs.count() and {r["lang_pred"] for r in out} == {"en", "und"}
    assert langid.predict(df, langid.fit(empty(spark))).select("lang_pred").distinct().collect() == [("und",)]
    assert langid.predict(empty(spark), model).count() == 0


# 8 token store

def check_store(spark, df, folder, **sizes):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(bpe.vocabulary_path(token_store.TOKENIZER))
    listed = token_store.write_store(df, folder, **sizes)
    got = token_store.read_store(listed, folder).collect()
    rows = sorted((r["doc_id"], r["text"] or "") for r in df.collect() if r["doc_id"] is not None)
    named = sorted((r for r in got if r["doc_id"] is not None), key=lambda r: r["start"])
    assert len(got) == df.count()
    at = sum(r["n_tokens"] for r in got if r["doc_id"] is None)
    for r, (i, text) in zip(named, rows):
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [2], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    return listed


def test_token_store_round_trip(spark, odd_docs, tmp_dir):
    pytest.importorskip("tokenizers")
    check_store(spark, odd_docs, f"file://{tmp_dir}/a", length=16, batch=4, bytes_per_range=9000)
    rng = random.Random(12)
    many = spark.createDataFrame([(i, prose(rng, rng.randint(0, 90))) for i in range(200)], "doc_id long, text string")
    listed = check_store(spark, many, f"{tmp_dir}/b", length=32, batch=3, bytes_per_range=2000)
    part = listed.orderBy("part").first()
    file = token_store.TokenFile(f"{tmp_dir}/b/tokens-{part['part']:+07d}.arrows")
    flat = np.concatenate(list(file.documents()))
    assert len(flat) == part["n_tokens"]
    for i in range(-(-len(flat) // 32)):
        ids, mask = file.sequence(i)
        assert len(ids) == len(mask) == 32 and ids[mask].tolist() == flat[32 * i:32 * i + 32].tolist()
    listed = token_store.write_store(empty(spark), f"{tmp_dir}/c")
    assert token_store.read_store(listed, f"{tmp_dir}/c").count() == 0


def test_token_store_special_strings_and_text_ids(spark, tmp_dir):
    pytest.importorskip("tokenizers")
    texts = ["a <|endoftext|> b", "<|endoftext|>", "plain", "<|endof", "x<|endoftext|><|endoftext|>y\n"]
    special = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check_store(spark, special, f"{tmp_dir}/a")
    own = token_store.encoder(token_store.TOKENIZER)
    ids = np.frombuffer(own.encode([texts[0].encode()])[0], own.dtype)
    assert ids.tolist() == [64, 220, 50256, 275]
    as_text = token_store.encoder(token_store.TOKENIZER, special_as_text=True)
    assert 50256 not in np.frombuffer(as_text.encode([texts[0].encode()])[0], as_text.dtype)
    named = spark.createDataFrame([(f"a{i:02d}", f"text {i}") for i in range(30)], "doc_id string, text string")
    listed = token_store.write_store(named, f"{tmp_dir}/b", bytes_per_range=20)
    got = token_store.read_store(listed, f"{tmp_dir}/b", "string").orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [f"a{i:02d}" for i in range(30)] and listed.count() > 3


def test_winnowing_text_ids(spark):
    rng = random.Random(14)
    texts = {f"a{i:02d}": prose(rng, 30) for i in range(40)}
    df = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    got = {r["doc_id"]: r["edited_sha256"] for r in winnowing.compare_edited(df, bytes_per_range=100).collect()}
    ids = sorted(texts, reverse=True)
    assert got == {i: hashlib.sha256(winnowing.edited_text(texts[i], texts[j]).encode()).hexdigest()
                   for i, j in zip(ids, ids[1:] + ids[:1])}


def test_pieces_encode_like_whole_texts():
    pytest.importorskip("tokenizers")
    own = token_store.encoder(token_store.TOKENIZER)
    assert own.by_piece
    texts = odd_texts(4000, 13)
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(bpe.vocabulary_path(token_store.TOKENIZER))
    for as_text in (False, True):
        library.encode_special_tokens = as_text
        want = library.encode_batch(texts, add_special_tokens=False)
        got = token_store.encoder(token_store.TOKENIZER, as_text).encode([t.encode() for t in texts])
        assert [np.frombuffer(g, own.dtype).tolist() for g in got] == [w.ids for w in want]


# 9 quality

def test_pool_adjacent_is_the_isotonic_fit():
    x = np.arange(6.0)
    at, y = quality.pool_adjacent(x, np.array([0, 1, 0.5, 0.5, 2, 1]), np.array([1, 1, 1, 2, 1, 1.0]))
    assert np.all(np.diff(y) > 0) and np.allclose(y, [0, 0.625, 1.5]) and np.allclose(at, [0, 2.25, 4.5])


def test_quality_held_out(spark, odd_docs):
    rng = random.Random(14)
    rows, truth = [], {}
    for i in range(800):
        good = rng.random() < 0.7
        text = ". ".join(prose(rng, rng.randint(4, 12)).capitalize() for _ in range(rng.randint(1, 6))) + "."
        if not good:
            text = rng.choice([text.upper().replace(" ", "!! "), re.sub(" ", "%%% ", text), (text[:9] + "\n") * 30])
        rows.append((i, text))
        truth[i] = int(good)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([*truth.items(), (5, None), (None, 1)], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality.quality(docs, labels).collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i]["held_out"] for i in held)
    assert sum(got[i]["predicted"] == truth[i] for i in held) >= 0.95 * len(held)
    out = quality.quality(odd_docs, labels).collect()
    assert len(out) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in out)
    none = quality.quality(docs, labels.where("false")).select("score").distinct().collect()
    assert none == [(0.5,)]
    assert quality.quality(empty(spark), labels).count() == 0


def test_partition_sums_do_not_depend_on_partitions(spark):
    rng = random.Random(15)
    docs = spark.createDataFrame([(i, prose(rng, rng.randint(1, 50))) for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, quality int")
    a, b = ({r["doc_id"]: r["score"] for r in quality.quality(docs.repartition(n), labels, features=32).collect()}
            for n in (1, 7))
    assert all(abs(a[i] - b[i]) < 1e-6 for i in a)


# 10 decontamination

def brute_contamination(docs, items):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 12)) if w else ():
            windows.setdefault(tuple(w[i:i + 13]), set()).add(str(item))
    out = {}
    for doc, text in docs:
        w, hit, who = words(text), set(), set()
        for m in {len(p) for p in windows}:
            for i in range(len(w) - m + 1):
                if (found := windows.get(tuple(w[i:i + m]))) is not None:
                    hit |= set(range(i, i + m))
                    who |= found
        out[doc] = (len(w), len(hit), sorted(who), bool(hit) and 20 * len(hit) >= len(w))
    return out


@pytest.mark.parametrize("block", [500_000, 40])
def test_contamination_like_brute_force(spark, block):
    rng = random.Random(16)
    items = [(i, prose(rng, rng.choice([0, 1, 2, 5, 12, 13, 14, 30]))) for i in range(1, 25)]
    items += [(3, prose(rng, 20)), (99, None), (98, "?!"), (97, items[10][1])]
    docs = []
    for i in range(80):
        text = prose(rng, rng.randint(0, 60))
        if i % 3 == 0:
            w = (rng.choice(items)[1] or "").split()
            a = rng.randint(0, max(0, len(w) - 13))
            text += " " + ", ".join(w[a:a + rng.randint(5, 20)]).upper() + "! " + prose(rng, rng.randint(0, 300))
        docs.append((i, text))
    docs.append((80, None))
    got = wumanber.contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                                 spark.createDataFrame(items, "item_id long, text string"), max_patterns=block)
    want = brute_contamination(docs, items)
    rows = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in got.collect()}
    assert rows == want


@pytest.mark.parametrize("block", [500_000, 5])
def test_contamination_odd_rows(spark, odd_docs, block):
    items = spark.createDataFrame([(None, prose(random.Random(1), 40)), (2, ""), (2, None)], "item_id long, text string")
    got = wumanber.contamination(odd_docs, items, max_patterns=block).collect()
    assert len(got) == odd_docs.count()
    assert {r["doc_id"] for r in got if r["contaminated"]} == {4, 10}
    assert sum(r["doc_id"] == 4 for r in got) == 3
    left = wumanber.without_contaminated(odd_docs, items, max_patterns=block)
    assert left.count() == odd_docs.count() - 4 and sorted(left.columns) == sorted(odd_docs.columns)
    assert wumanber.contamination(empty(spark), items).count() == 0
    assert wumanber.contamination(odd_docs, items.where("false")).where("n_hit > 0").count() == 0


@pytest.mark.parametrize("block", [500_000, 1])
def test_every_row_is_judged_by_its_own_text(spark, block):
    rng = random.Random(29)
    bad, part = prose(rng, 13), prose(rng, 15)
    docs = [(None, bad), (None, "clean"), (None, None), (1, bad), (1, "clean too"), (2, part), (2, bad), (2, prose(rng, 60)), (3, ""), (3, bad)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(1, bad), (2, part)], "item_id long, text string")
    left = [tuple(r) for r in wumanber.without_contaminated(df, items, max_patterns=block).collect()]
    assert sorted(left, key=str) == sorted((d for d in docs if d[1] not in (bad, part)), key=str)


# odd cases of several operators

def test_pii_added_spans_stay_outside_base_spans():
    """However many base spans lie between the start of one and the candidate."""
    text = ".".join(["1.2.3.4"] * 6) + "-" + "0123456789abcdef" * 3 + "@x.example and key=" + "9f" * 20
    got = pii.candidates(text)
    base, other = ([(c.start, c.end) for c in got if c.base == which] for which in (True, False))
    assert base and other
    assert not any(a < d and c < b for a, b in other for c, d in base)


def test_contamination_with_clashing_columns_and_several_blocks(spark):
    rng = random.Random(15)
    passage = prose(rng, 30)
    bench = spark.createDataFrame([("i", passage)], "item_id string, text string")
    docs = spark.createDataFrame([(1, passage, "x"), (2, prose(random.Random(16), 60), None), (None, passage, "y")],
                                 "doc_id long, text string, _found string")
    for most in (1, 500_000):
        kept = wumanber.without_contaminated(docs, bench, max_patterns=most)
        assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [2]


def test_toxicity_scores_are_noisy_or():
    """Plain noisy-or over all sentences, one word at a time, without caches or shortcuts."""
    rng = random.Random(17)
    model = toxicity.Model(-3.0, {f: rng.uniform(-1, 4) for w in WORDS[:6] for f in toxicity.features(w)})
    for n in (0, 1, 7, 60, 400):
        text = "".join(rng.choice(WORDS) + rng.choice([" ", " ", " ", ". ", "!\n", "? "]) for _ in range(n))
        spared = 1.0
        for a, b in toxicity.sentences(text.lower()):
            z = model.bias + sum(model.weights.get(f, 0.0) for w in set(re.findall(toxicity._WORD.pattern, text.lower()[a:b]))
                                 for f in set(toxicity.features(w)))
            spared *= 1 - 1 / (1 + np.exp(-z))
        assert model.score(text)[0] == pytest.approx(1 - spared, abs=1e-9)


def test_toxicity_fit_is_steady():
    with np.errstate(over="raise"):
        toxicity._fit_bags(np.array([True, False]), np.array([0.0, 3.0]), np.array([0, 1]), np.array([0, 1]), np.array([0, 0]),
                           1, np.array([-900.0]), 5, 0.0)


def test_quality_is_dense_ridge_and_isotonic(spark):
    """All rows in one matrix, the normal equations solved at once, and an isotonic fit by min-max means."""
    rng = random.Random(18)
    texts = {i: prose(rng, rng.randint(1, 60)) + rng.choice(["", "!!! $$$ 00 11", "\nA line.\nB line."]) for i in range(400)}
    label = {i: int("$" not in t and rng.random() < 0.9) for i, t in texts.items()}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame(list(label.items()), "doc_id long, quality int")
    model = quality.fit(quality.statistics(docs), labels, features=32)
    x = quality.text_statistics([texts[i].encode() for i in texts])
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.spread, np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1))
    rest = np.array([zlib.crc32(str(i).encode()) % 5 for i in texts])
    y = np.array([label[i] for i in texts], float)
    z = np.column_stack((np.sqrt(2 / 32) * np.cos(np.clip((x - model.mean) / model.spread, -8, 8) @ model.waves + model.phase),
                         np.ones(len(x))))
    taught = (rest != 0) & (rest != 4)
    own = z[taught]
    penalty = np.diag([quality.RIDGE * len(own) / 10] * 32 + [0.0]) + np.eye(33) * 1e-9
    weights = np.linalg.solve(own.T @ own + penalty, own.T @ y[taught])
    assert np.allclose(model.weights, weights, atol=1e-7)
    raw = z[rest == 4] @ weights
    b = np.clip(raw * quality.BINS / 2 + quality.BINS / 4, 0, quality.BINS).astype(int)
    bins = sorted(set(b.tolist()))
    mean, size = np.array([y[rest == 4][b == k].mean() for k in bins]), np.array([float((b == k).sum()) for k in bins])

    def average(i, j):
        return float((mean[i:j + 1] * size[i:j + 1]).sum() / size[i:j + 1].sum())

    fit = [max(min(average(i, j) for j in range(k, len(bins))) for i in range(k + 1)) for k in range(len(bins))]
    at = (np.array(bins) + 0.5 - quality.BINS / 4) * 2 / quality.BINS
    knots_x, knots_y = model.knots
    assert np.allclose(sorted(set(np.round(knots_y[1:-1], 9))), sorted(set(np.round(fit, 9))))
    blocks = {v: np.average(at[np.isclose(fit, v)], weights=size[np.isclose(fit, v)]) for v in set(np.round(fit, 9))}
    assert np.allclose(sorted(knots_x[1:-1]), sorted(blocks.values()))
