"""Catalogue entries of the document operators: opN_<name> over whole tables.

Each query derives the digest columns of its contract from its operator's
real outputs.  ``ORACLE_SQL`` holds DuckDB SQL where SQL can express it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finspark.llm import (bpe, crosstok, langid, linededup, merkle, pii, quality, simhash, spelling, token_store,
                          toxicity, winnowing, wumanber)
from finspark.plans.views import table
from finspark.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_winnowing(spark, sf_dir):
    out = winnowing.compare_edited(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", "edited_sha256", F.lower(F.hex("selected")).alias("fingerprint"),
                      F.lower(F.hex("edited_selected")).alias("edited_fingerprint"), "near_edited", "near_next")


@query
def op2_simhash(spark, sf_dir):
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op3_byte_bpe(spark, sf_dir):
    out = bpe.bpe_round_trip(table(spark, sf_dir, "documents"))
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op4_toxicity(spark, sf_dir):
    out = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted", F.size("offending").alias("n_offending"))


@query
def op5_merkle_fixity(spark, sf_dir):
    """Two stored replicas of all pages as WARC records; the second has lost every 211th record
    (ids 3 mod 211) and has a wrong first byte in every 101st (ids 7 mod 101)."""
    folder = scratch_path(spark, "warc")
    merkle.records(table(spark, sf_dir, "pages")).write.parquet(f"{folder}/a")
    first = spark.read.parquet(f"{folder}/a")
    record = F.when(F.col("record_id") % 101 == 7, F.overlay("record", F.lit(b"X"), 1)).otherwise(F.col("record"))
    lost = F.coalesce(F.col("record_id") % 211 == 3, F.lit(False))
    first.where(~lost).select("record_id", record.alias("record")).write.parquet(f"{folder}/b")
    return merkle.audit(first, spark.read.parquet(f"{folder}/b")).select(
        "archive", F.col("record_id").alias("page_id"), "kind", "first_offset", "end_offset", "digest_a", "digest_b")


ORACLE_SQL["op5_merkle_fixity"] = r"""
WITH r AS (
  SELECT page_id, concat('WARC/1.1', n, 'WARC-Type: resource', n, 'WARC-Record-ID: <urn:page:', page_id, '>', n,
         'WARC-Target-URI: ', coalesce(url, ''), n, 'Content-Type: text/html', n, 'Content-Length: ',
         strlen(coalesce(html, '')), n, n, coalesce(html, ''), n, n) AS record
  FROM pages, (SELECT chr(13) || chr(10) AS n)),
o AS (
  SELECT page_id // 4096 AS archive, page_id, record, CAST(sum(strlen(record)) OVER (
         PARTITION BY page_id // 4096 ORDER BY page_id) AS BIGINT) AS end_offset FROM r)
SELECT CAST(archive AS BIGINT) AS archive, page_id, CASE WHEN page_id % 211 = 3 THEN 'missing' ELSE 'changed' END AS kind,
       CAST(end_offset - strlen(record) AS BIGINT) AS first_offset, end_offset, sha256(record) AS digest_a,
       CASE WHEN page_id % 211 <> 3 THEN sha256('X' || substr(record, 2)) END AS digest_b
FROM o WHERE page_id % 211 = 3 OR page_id % 101 = 7
"""


@query
def op6_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = pii.find(docs, pii.fit(docs))
    base = F.filter("spans", lambda s: s["base"])

    def listed(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"], s["last"])))

    def number(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = map(number, pii.BASE_KINDS)
    return out.select("doc_id", *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
                      listed(F.col("spans")).alias("spans"))


@query
def op7_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


@query
def op8_token_store(spark, sf_dir):
    docs, folder = table(spark, sf_dir, "documents"), scratch_path(spark, "token_store")
    listed = token_store.write_store(docs, folder)
    files = max(1, listed.count())
    return token_store.read_store(listed.repartition(files), folder, docs.schema["doc_id"].dataType.simpleString())


@query
def op9_quality(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_wu_manber(spark, sf_dir):
    out = wumanber.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
                      "contaminated")


ORACLE_SQL["op10_wu_manber"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bi AS (SELECT item, w, least(13, len(w)) AS m FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, m, array_to_string(w[i:i + m - 1], ' ') AS p
       FROM (SELECT item, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM bi)),
ms AS (SELECT DISTINCT m FROM bw),
dw AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS p
       FROM (SELECT doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i
             FROM d, ms WHERE len(w) >= m)),
h AS (SELECT doc_id, dw.m, i, item FROM dw JOIN bw ON dw.m = bw.m AND dw.p = bw.p),
n AS (SELECT doc_id, count(DISTINCT k) AS n_hit
      FROM (SELECT doc_id, unnest(generate_series(i, i + m - 1)) AS k FROM h) GROUP BY doc_id),
s AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
      FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN s ON d.doc_id = s.doc_id
"""


@query
def op11_line_dedup(spark, sf_dir):
    out = linededup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL["op11_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(w) AS line, unnest(generate_series(1, len(w))) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents))),
c AS (SELECT k, count(DISTINCT doc_id) AS n, max(doc_id) AS keeper FROM l WHERE length(k) >= 40 GROUP BY k),
m AS (SELECT l.*, coalesce(n >= 5 AND l.doc_id <> keeper, false) AS goes FROM l LEFT JOIN c ON l.k = c.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (goes) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT goes), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query
def op12_cross_tokenizer(spark, sf_dir):
    out = crosstok.align(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))


@query
def op13_spelling(spark, sf_dir):
    return spelling.variants(spelling.word_counts(table(spark, sf_dir, "documents"), damage_every=97))
