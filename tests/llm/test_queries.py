"""The registered queries and the pipeline against brute-force versions on the smallest test tables."""

import hashlib
import os
import zlib

import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline
from finspark.llm import bpe, pii, queries, token_store, toxicity, winnowing
from finspark.plans.views import table
from finspark.session import scratch_path

from test_operators import brute_components, brute_contamination, brute_pii, brute_simhash

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in table(spark, SF, "documents").collect()}


def rows(spark, name):
    return {r["doc_id"]: r for r in queries.QUERIES[name](spark, SF).collect()}


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


@pytest.fixture(scope="module")
def library():
    import base64
    tiktoken, P = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    with open(P.path(bpe.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_registered():
    names = sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert E.queries()["pipeline"] is corpus_pipeline.run and set(queries.ORACLE_SQL) <= set(E.oracle_sql())
    assert set(queries.QUERIES) <= set(E.queries())


def test_op1(spark, texts):
    got, ids = rows(spark, "op1_winnowing"), sorted(texts, reverse=True)

    def printed(text):
        return b"".join(int(x).to_bytes(4, "big") for pair in zip(*winnowing.winnow(text)) for x in pair).hex()

    assert len(got) == len(ids)
    for i, after in zip(ids, ids[1:] + ids[:1]):
        edited = winnowing.edited_text(texts[i], texts[after])
        assert (got[i]["n_chars"], got[i]["edited_sha256"]) == (len(texts[i]), hashlib.sha256(edited.encode()).hexdigest())
        assert (got[i]["fingerprint"], got[i]["edited_fingerprint"]) == (printed(texts[i]), printed(edited))
        held = [set(winnowing.winnow(t)[0].tolist()) for t in (texts[i], edited, texts[after])]
        for name, other in (("near_edited", held[1]), ("near_next", held[2])):
            assert got[i][name] == pytest.approx(len(held[0] & other) / len(held[0] | other) if held[0] | other else 1.0)
    assert np.mean([r["near_edited"] > r["near_next"] for r in got.values()]) > 0.95


def test_op2(spark, texts):
    fps = {i: brute_simhash(t) for i, t in texts.items()}
    parts = brute_components(fps, 2)
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in rows(spark, "op2_simhash").items()} == {
        i: (f"{fps[i]:016x}", parts[i]) for i in texts}


def test_op3(spark, texts, library):
    for i, r in rows(spark, "op3_byte_bpe").items():
        ids = np.array(library.encode_ordinary(texts[i]), "<u4")
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[i].encode()).hexdigest()


@pytest.mark.parametrize("name, modulus, rest", [("op4_toxicity", 5, 0), ("op7_langid", 3, 1), ("op9_quality", 5, 0)])
def test_scores(spark, texts, name, modulus, rest):
    got = rows(spark, name)
    assert got.keys() == texts.keys()
    assert all(r["held_out"] == (fold(i, modulus) == rest) and 0 <= r["score"] <= 1 for i, r in got.items())


def test_op6(spark, texts):
    for i, r in rows(spark, "op6_pii").items():
        base = [f"{k}:{a}:{b}" for k, a, b in brute_pii(texts[i])]
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(s.startswith(k) for s in base) for k in pii.BASE_KINDS]
        assert set(base) <= set(r["spans"].split(","))


def test_op8(spark, texts):
    Tokenizer = pytest.importorskip("tokenizers").Tokenizer
    own, at, got = Tokenizer.from_file(bpe.vocabulary_path(token_store.TOKENIZER)), 0, rows(spark, "op8_token_store")
    for i in sorted(texts):
        ids = np.array(own.encode(texts[i], add_special_tokens=False).ids + [2], "<u4")
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_pipeline_stages(spark, library):
    """Each stage judged on its own input, by versions that compare everything with everything."""
    docs = table(spark, SF, "documents")
    benchmark = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_dedup", "benchmark_decontamination", "pii", "byte_bpe"]
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        path = scratch_path(spark, name)
        stage(spark, docs, SF).write.parquet(path)
        out = spark.read.parquet(path)
        after = {r["doc_id"]: r for r in out.collect()}
        assert out.count() == len(after)
        if name != "byte_bpe":
            assert out.columns == columns
        if name == "toxicity":
            model = toxicity.fit(docs, table(spark, SF, "labels"))
            kept = {i for i, r in before.items() if model.score(r["text"] or "")[0] < 0.5}
        elif name == "simhash_near_dedup":
            kept = set(brute_components({i: brute_simhash(r["text"]) for i, r in before.items()}, 2).values())
        elif name == "benchmark_decontamination":
            hits = brute_contamination([(i, r["text"]) for i, r in before.items()], benchmark)
            kept = {i for i, h in hits.items() if not h[3]}
            assert len(kept) < len(before)
        else:
            kept = set(before)
        assert after.keys() == kept
        if name == "pii":
            model = pii.fit(docs)
            assert any(r["text"] != after[i]["text"] for i, r in before.items())
            for i, r in before.items():
                assert after[i]["text"] == pii.masked(r["text"], model) and after[i]["n_chars"] == len(after[i]["text"])
                assert not brute_pii(after[i]["text"])
        elif name == "byte_bpe":
            for i, r in before.items():
                assert np.frombuffer(after[i]["ids"], "<u4").tolist() == library.encode_ordinary(r["text"])
                assert after[i]["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()
        else:
            assert all(after[i] == before[i] for i in after)
        docs = out
    assert corpus_pipeline.run(spark, SF).count() == docs.count()
