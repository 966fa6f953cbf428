"""Fixity audit of WARC replicas by Merkle trees.

A replica is a table of records (record_id, record): the bytes of WARC records,
in archives of 4096 consecutive ids, ordered by id.  A leaf is the digest and
byte length of a record; a node of the next level is the digest of the sixteen
id-consecutive children (id, digest and length of each, in order), so it covers
an ordered range of offsets; three levels up is an archive, and levels go on
until one root is left.  The audit compares roots, then only the children of
nodes that differ, level by level, down to records.

Built from DataFrame functions alone.  Record bytes are read once per replica
and never shuffled; trees hold a digest per record and a sixteenth more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finspark.llm.common import materialize

FAN_BITS = 4  # sixteen children
ARCHIVE_LEVEL = 3  # an archive is 16^3 ids
_NO_ID = -(1 << 63)  # stands for a null id


def warc_record(record_id: Column, uri: Column, body: Column) -> Column:
    """A WARC resource record as text; a null uri or body is empty."""
    uri, body = F.coalesce(uri, F.lit("")), F.coalesce(body, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(record_id.cast("string"), F.lit("")), F.lit(">\r\nWARC-Target-URI: "), uri,
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def records(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", body_col: str = "html") -> DataFrame:
    """(record_id long, record binary) of every page row."""
    record = warc_record(F.col(f"`{id_col}`"), F.col(f"`{uri_col}`").cast("string"), F.col(f"`{body_col}`").cast("string"))
    return pages.select(F.col(f"`{id_col}`").cast("long").alias("record_id"), record.cast("binary").alias("record"))


def leaves(replica: DataFrame) -> DataFrame:
    """(node, digest, n_records, bytes) by record id.

    A null record is empty.  Records that repeat an id make one leaf: the digest
    of their number and of the sums of their digests, which no order changes.
    """
    record = F.coalesce("record", F.lit(b""))
    own = replica.select(F.coalesce("record_id", F.lit(_NO_ID)).alias("node"),
                         F.sha2(record, 256).alias("d"), F.octet_length(record).cast("long").alias("b"))
    quarters = [F.sum(F.conv(F.substring("d", 1 + 16 * i, 16), 16, 10).cast("decimal(38,0)")) for i in range(4)]
    mixed = F.sha2(F.concat_ws(",", F.count("*").cast("string"), *(q.cast("string") for q in quarters)).cast("binary"), 256)
    return (own.groupBy("node").agg(F.when(F.count("*") == 1, F.max("d")).otherwise(mixed).alias("digest"),
                                    F.count("*").alias("n_records"), F.sum("b").alias("bytes")))


def _parents(level: DataFrame) -> DataFrame:
    """The next level: each node from its children (sixteen at most) in order."""
    child = F.struct("node", "digest", "bytes")
    text = F.concat_ws(";", F.transform(F.array_sort(F.collect_list(child)), lambda c: F.concat_ws(
        ",", c["node"].cast("string"), c["digest"], c["bytes"].cast("string"))))
    return (level.groupBy(F.shiftright("node", FAN_BITS).alias("node"))
            .agg(F.sha2(text.cast("binary"), 256).alias("digest"), F.sum("n_records").alias("n_records"),
                 F.sum("bytes").alias("bytes")))


def tree(replica: DataFrame) -> list[DataFrame]:
    """Levels from the leaves up to a level of at most one node (two where ids have both signs)."""
    levels = [materialize(leaves(replica))]
    lo, hi = levels[0].agg(F.min("node"), F.max("node")).first()
    while lo is not None and lo != hi and (lo, hi) != (-1, 0):
        levels.append(materialize(_parents(levels[-1])))
        lo, hi = lo >> FAN_BITS, hi >> FAN_BITS
    return levels


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Nodes whose digest or length differs, or that one replica lacks."""
    x = a.select("node", F.struct("digest", "bytes").alias("of_a"))
    y = b.select("node", F.struct("digest", "bytes").alias("of_b"))
    return x.join(y, "node", "full_outer").where(~F.col("of_a").eqNullSafe(F.col("of_b")))


def audit(replica_a: DataFrame, replica_b: DataFrame) -> DataFrame:
    """One row per record id at which the replicas differ.

    archive, record_id, kind (changed: other bytes; missing: only in a; extra:
    only in b), first_offset and end_offset of the record in a's archive (null
    for extra ones), digest_a, digest_b.  Equal or two empty replicas give no row.
    """
    a, b = tree(replica_a), tree(replica_b)
    top = max(len(a), len(b)) - 1
    while len(a) <= top:
        a.append(materialize(_parents(a[-1])))
    while len(b) <= top:
        b.append(materialize(_parents(b[-1])))
    bad = materialize(_differing(a[top], b[top]).select("node"))
    for level in range(top - 1, -1, -1):
        up = bad.withColumnRenamed("node", "parent")
        below = [t[level].join(up, F.shiftright(t[level]["node"], FAN_BITS) == up["parent"], "left_semi") for t in (a, b)]
        found = _differing(*below)
        bad = materialize(found.select("node") if level else found)
    if not top:
        bad = _differing(a[0], b[0])
    bits = FAN_BITS * ARCHIVE_LEVEL
    archives = bad.select(F.shiftright("node", bits).alias("archive")).distinct()
    archive = F.shiftright("node", bits).alias("archive")
    inside = Window.partitionBy("archive").orderBy("node")  # at most 4096 records
    ranges = (a[0].select("node", "bytes", archive).join(archives, "archive", "left_semi")
              .select("node", (F.sum("bytes").over(inside) - F.col("bytes")).alias("first_offset"),
                      F.sum("bytes").over(inside).alias("end_offset")))
    kind = F.when(F.col("of_a").isNull(), "extra").when(F.col("of_b").isNull(), "missing").otherwise("changed")
    return (bad.join(ranges, "node", "left")
            .select(archive, F.when(F.col("node") != _NO_ID, F.col("node")).alias("record_id"), kind.alias("kind"),
                    "first_offset", "end_offset", F.col("of_a.digest").alias("digest_a"),
                    F.col("of_b.digest").alias("digest_b")))
