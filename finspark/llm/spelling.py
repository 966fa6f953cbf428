"""Spelling variants: words at one inserted, deleted or replaced code point.

Two tries hold the vocabulary, one of the words and one of the reversed words.
Their nodes are numbered, so a word cut at a position is a pair of integers:
the node of what stands before and the node of what stands after.  A word gives
the pairs of all its cuts, and the pairs that leave out one position.  Words
that meet at a pair are exact neighbours: two that leave out a position there
differ in that code point alone, and one that is cut there lacks it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finspark.llm.common import byte_texts, materialize, text_rows, text_slices
from finspark.session import range_partitions

MIN_CHARS = 5
MIN_COUNT = 3
RATIO = 2
WORDS_PER_PARTITION = 100_000
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")  # A-Z folded; U+00C0 to U+00FF have two bytes
_BREAK = re.compile(rb"[\x00-`{-\x7f]")  # ends a run
_HELD = 200_000  # words that a task counts before it passes them on
_PART = 1 << 20  # bytes of a text searched at a time, to the next break
_SHIFT = 40  # a number is its partition's, then the count within


def _parts(text: bytes):
    start = 0
    while len(text) - start > 2 * _PART:
        end = _BREAK.search(text, start + _PART)
        if not end:
            break
        yield text[start:end.end()]
        start = end.end()
    yield text[start:]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                min_count: int = MIN_COUNT, damage_every: int | None = None) -> DataFrame:
    """(word, n): maximal runs of a-z and U+00C0 to U+00FF (A-Z folded) of at least ``min_chars`` code
    points that stand at least ``min_count`` times in all texts.

    With ``damage_every`` a run loses a code point (and may then be too short) where that number divides
    the crc32 of ``<doc_id>:<run>``: the code point at the crc32 modulo the run's length.

    Null and empty texts have no words; the text of a null doc_id is empty.  Long texts are searched in
    parts that end where no run goes on.
    """
    rows = text_rows(docs, id_col, text_col).withColumn("doc_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))

    def run(batches):
        held: Counter = Counter()

        def counted():
            got = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())],
                ["word", "n"])
            held.clear()
            return got

        for batch in text_slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), byte_texts(batch)):
                head = zlib.crc32(f"{doc_id}:".encode())
                for part in _parts(text.lower()):  # bytes: A-Z alone
                    for word, n in Counter(_RUN.findall(part)).items():
                        if len(word) < min_chars:
                            continue
                        if damage_every and (h := zlib.crc32(word, head)) % damage_every == 0:
                            letters = word.decode()
                            at = h % len(letters)
                            word = (letters[:at] + letters[at + 1:]).encode()
                        if len(word) - word.count(b"\xc3") >= min_chars:
                            held[word] += n
                    if len(held) >= _HELD:
                        yield counted()
        if held:
            yield counted()

    return (rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


def _common(a: str, b: str) -> int:
    """Length of the longest common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    return low


def trie_nodes(words: DataFrame, partitions: int) -> DataFrame:
    """(word, number, nodes) for a table of distinct words: numbers ascend with the words in code-point
    order; nodes[d] is the number of the trie node of the word's first d code points (0: the root).

    The words are sorted into ranges.  In a range the nodes that a word adds are those deeper than what
    it shares with the word before.  A range's first word may share a prefix with the ranges before: a
    fold over one row a range (its first word, its last word and that one's nodes) finds the numbers
    that those prefixes have already.
    """
    ordered = materialize(words.select("word").repartitionByRange(partitions, "word").sortWithinPartitions("word")
                          .withColumn("part", F.spark_partition_id().cast("long")))

    def number(batches):
        before, nodes, made, row = None, [0], 0, 0
        for batch in batches:
            out = []
            for word, part in zip(batch.column("word").to_pylist(), batch.column("part").to_pylist()):
                shared = _common(before, word) if before is not None else 0
                base = part << _SHIFT
                nodes = nodes[:shared + 1] + list(range(base + made + 1, base + made + 1 + len(word) - shared))
                made += len(word) - shared
                row += 1
                before = word
                out.append((word, part, base + row, nodes))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64())))],
                    ["word", "part", "number", "nodes"])

    own = materialize(ordered.mapInArrow(number, "word string, part long, number long, nodes array<long>"))
    ends = own.groupBy("part").agg(F.min("word").alias("first"), F.max("word").alias("last"),
                                   F.max_by("nodes", "word").alias("nodes"))

    def join_ranges(batches):
        before, nodes = None, [0]
        out = []
        for batch in batches:
            for part, first, last, local in zip(*(batch.column(c).to_pylist() for c in ("part", "first", "last", "nodes"))):
                # the first word's nodes are the first that the range made, so the count within is the depth
                known = nodes[:_common(before, first) + 1] if before is not None else [0]
                base = part << _SHIFT
                nodes = [known[x - base] if base < x < base + len(known) else x for x in local]
                before = last
                out.append((part, known))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.list_(pa.int64())))],
                                             ["part", "known"])

    known = ends.coalesce(1).sortWithinPartitions("part").mapInArrow(join_ranges, "part long, known array<long>")
    base = F.shiftleft("part", _SHIFT)
    true = F.transform("nodes", lambda x: F.when((x > base) & (x < base + F.size("known")),
                                                 F.get("known", (x - base).cast("int"))).otherwise(x))
    return own.join(F.broadcast(known), "part").select("word", "number", true.alias("nodes"))


def neighbours(words: DataFrame, words_per_partition: int = WORDS_PER_PARTITION) -> DataFrame:
    """(word, n, number, n_near, best) for distinct words (word, n): how many words are near, and of
    those the one of largest n as (n, -number) (ties: smallest in code-point order; null: none is near).

    At a pair meet at most one word that is cut there and, of words that leave a position out there,
    one for each code point: a group is bounded by the alphabet.  Each member gives one row, its
    number of neighbours there and the best of them, not the pairs themselves.
    """
    words = materialize(words.select("word", "n"))
    partitions = range_partitions(words, words_per_partition)
    ahead = trie_nodes(words, partitions).withColumnRenamed("nodes", "ahead")
    back = trie_nodes(words.select(F.reverse("word").alias("word")), partitions).select(
        F.reverse("word").alias("word"), F.reverse("nodes").alias("back"))  # back[j]: node of what follows position j
    both = materialize(words.join(ahead, "word").join(back, "word"))

    # 0: cut at a position; 1: leaves it out; 2: leaves it out, and the code point before is the same,
    # so what is left was met already where 1 left out the first of the equal code points
    def cell(p, i):
        again = (i > 0) & (F.get("letters", i) == F.get("letters", i - 1))
        return F.struct(p.alias("p"), F.get("back", i).alias("cut"), F.get("back", i + 1).alias("rest"),
                        F.when(again, 2).otherwise(1).alias("kind"))

    cells = (both.withColumn("letters", F.split("word", "")).withColumn("cells", F.transform("ahead", cell))
             .select("number", "n", F.explode("cells").alias("c")))
    pairs = cells.select("number", "n", F.col("c.p").alias("p"), F.explode(F.array(
        F.struct(F.col("c.cut").alias("s"), F.lit(0).alias("kind")),
        F.struct(F.col("c.rest").alias("s"), F.col("c.kind").alias("kind")))).alias("at")).where("at.s IS NOT NULL")
    met = (pairs.select("p", "at.s", F.struct(F.col("n"), (-F.col("number")).alias("low"), F.col("at.kind").alias("kind")).alias("m"))
           .groupBy("p", "s").agg(F.sort_array(F.collect_list("m"), asc=False).alias("all")).where("size(all) > 1"))

    def near(m, x):
        """Whether x is a neighbour of the member m of the same pair."""
        return (x["low"] != m["low"]) & F.when(m["kind"] == 0, x["kind"] == 1).when(
            x["kind"] == 0, m["kind"] == 1).otherwise(True)

    each = met.select(F.explode(F.transform("all", lambda m: F.struct(
        m["low"].alias("low"), F.filter("all", lambda x: near(m, x)).alias("near")))).alias("e")).where("size(e.near) > 0")
    total = each.groupBy((-F.col("e.low")).alias("number")).agg(
        F.sum(F.size("e.near")).cast("long").alias("n_near"),
        F.max(F.struct(F.get("e.near", F.lit(0))["n"].alias("n"), F.get("e.near", F.lit(0))["low"].alias("low"))).alias("best"))
    return (both.select("word", "n", "number").join(total, "number", "left")
            .withColumn("n_near", F.coalesce("n_near", F.lit(0).cast("long"))))


def variants(words: DataFrame, ratio: int = RATIO, words_per_partition: int = WORDS_PER_PARTITION) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for distinct words (word, n).

    A word's form is its near word of largest n (ties: smallest in code-point order) if that n is at
    least ``ratio`` times (two or more) the word's; root is the last word reached by following forms.  Since n doubles
    at every step, chains have at most log2 of the largest n steps, and doubling them takes the log2 of
    that in rounds; the driver sees one number a round.

    Repeated words count together; null and empty words are left out.  An empty table gives no rows.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2")
    given = words.where("word <> ''").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    own = neighbours(given, words_per_partition)
    has = F.col("best.n") >= ratio * F.col("n")
    own = materialize(own.select("word", "number", "n", "n_near", F.when(has, -F.col("best.low")).alias("form"),
                                 F.when(has, F.col("best.n")).alias("form_n")))
    links = own.where("form IS NOT NULL").select("number", F.col("form").alias("root"))
    while True:
        step = links.select(F.col("number").alias("root"), F.col("root").alias("next"))
        links = materialize(links.join(step, "root", "left").select(
            "number", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if not links.where("moved").count():
            break
        links = links.select("number", "root")
    names = own.select(F.col("number").alias("form"), F.col("word").alias("form_word"))
    ends = links.select("number", F.col("root").alias("form")).join(names, "form").select(
        "number", F.col("form_word").alias("root"))
    return (own.join(names, "form", "left").join(ends, "number", "left")
            .select("word", F.col("form_word").alias("form"), F.coalesce("root", "word").alias("root"),
                    "n", "n_near", "form_n"))
