"""File sources (S1-S4, S9-S11): CSV, JSON, Parquet, XML and typed dispatch.

All readers return lazy DataFrames; filters and projections applied later
are pushed into the scan by Catalyst (Parquet) or pruned after parsing.
"""

from __future__ import annotations

import codecs
import re
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finspark.functions.scalar import nan_to_null

# Text tokens read as missing by default (the frame library's
# documented default NA set).
DEFAULT_NA = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
              "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def _as_struct(schema) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    return T.StructType.fromDDL(schema)


def read_csv(spark: SparkSession, path: str, schema=None, sep: str = ",", encoding: str = "utf-8",
             header: bool = True, na_values=None, multi_line: bool = False) -> DataFrame:
    """CSV with header, separator and encoding; doubled quotes inside quoted
    fields; NA tokens become NULL.

    With a header, columns are taken by name, whatever their order in each
    file of a folder; a column that a file lacks is NULL.  The headers of all
    files are read first (``csv_headers``); there is one scan per distinct
    header.  Without a header columns go by position.  Partition folders
    (``day=01``) below ``path`` are columns, read as the text they hold.
    With a schema every column is read as text, NA tokens are nulled, then the
    text is cast to the declared type (unparsable -> NULL).  Without one, types
    are inferred from the text without its NA tokens (BIGINT, DOUBLE, BOOLEAN,
    else text; one more pass over the data, for exploratory reads).

    ``multi_line=True`` allows line breaks inside quoted fields; such a file
    can't be split, so each file is parsed by one task.
    """
    na = DEFAULT_NA if na_values is None else list(na_values)

    def scan(files, **options) -> DataFrame:
        """All columns as text: those of partition folders, too, whose types Spark would guess."""
        def reader():  # readers keep their schema
            return (spark.read.option("header", header).option("sep", sep).option("encoding", encoding)
                    .option("quote", '"').option("escape", '"').option("multiLine", multi_line)
                    .option("nullValue", None).option("emptyValue", "").options(**options))
        if schema is not None and not header:
            return reader().schema(_all_text(_as_struct(schema).names)).csv(files)
        found = reader().csv(files)
        if all(isinstance(f.dataType, T.StringType) for f in found.schema.fields):
            return found
        return reader().schema(_all_text(found.columns)).csv(files)

    # named by the header of the files of each scan
    groups = csv_headers(spark, path, encoding) if header else []
    if len(groups) > 1:
        base = {} if any(c in path for c in "*?[{") else {"basePath": path}
        raw = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), [scan(files, **base) for files in groups])
    else:
        raw = scan(path)

    def known(name: str) -> Column:
        c = F.col(f"`{name}`")
        return F.when(c.isNull() | c.isin(na), F.lit(None)).otherwise(c)

    if schema is None:
        return nan_to_null(_inferred(raw.select(*[known(c).alias(c) for c in raw.columns])))
    cols = []
    for f in _as_struct(schema).fields:
        c = known(f.name) if f.name in raw.columns else F.lit(None).cast("string")
        cols.append((c if isinstance(f.dataType, T.StringType) else c.try_cast(f.dataType)).alias(f.name))
    return nan_to_null(raw.select(*cols))


def _all_text(names) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in names])


def csv_headers(spark: SparkSession, path: str, encoding: str = "utf-8") -> list[list[str]]:
    """Header catalogue: the files of ``path`` grouped by their first line that is not blank, the
    groups in order of their first file.  Empty files are left out.

    One row per file, read by tasks that open their files and stop after the
    header.  Where the Python workers can't open the store, a text scan finds
    the first lines instead.
    """
    files = sorted(spark.read.text(path).inputFiles())
    if len(files) < 2:
        return [[unquote(f) for f in files]]
    tasks = max(1, min(len(files), 4 * spark.sparkContext.defaultParallelism))
    listed = spark.createDataFrame([(f,) for f in files], "file STRING").repartition(tasks)

    def first_lines(batches):
        for batch in batches:
            names = batch.column("file").to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column("file"), pa.array([_first_line(f, encoding) for f in names], pa.string())],
                                             ["file", "line"])

    if _openable(files[0]):
        found = listed.mapInArrow(first_lines, "file STRING, line STRING")
    else:
        text = spark.read.text(path).where("_metadata.file_block_start = 0 AND trim(value) <> ''")
        # the lines of a file's first block are in order and in one task
        found = text.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.first("value").alias("line"))
    groups: dict[str, list[str]] = {}
    for r in sorted(found.where("line IS NOT NULL").collect()):
        groups.setdefault(r["line"], []).append(unquote(r["file"]))
    return list(groups.values())


def _openable(file: str) -> bool:
    try:
        fs.FileSystem.from_uri(file)
    except (pa.ArrowInvalid, OSError):
        return False
    return True


def _first_line(file: str, encoding: str) -> str | None:
    """The first line of a file that is not blank; with its quoted line breaks."""
    own, name = fs.FileSystem.from_uri(file)
    decode, text = codecs.getincrementaldecoder(encoding)(), ""
    with own.open_input_stream(name) as f:
        while True:
            chunk = f.read(1 << 16)
            text = (text + decode.decode(chunk, final=not chunk)).lstrip("\ufeff\r\n ")
            ends = [m.start() for m in re.finditer("[\r\n]", text)]
            for end in ends:
                if text.count('"', 0, end) % 2 == 0:
                    return text[:end]
            if not chunk:
                return text or None


def _inferred(text: DataFrame) -> DataFrame:
    """Text columns cast to the narrowest of BIGINT, DOUBLE and BOOLEAN that holds all their values."""
    kinds = ["bigint", "double", "boolean"]
    bad = [F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(k).isNull())
           for c in text.columns for k in kinds]
    seen = [F.count(F.col(f"`{c}`")) for c in text.columns]
    if not text.columns:
        return text
    got = text.agg(*[e.alias(f"m{i}") for i, e in enumerate(bad + seen)]).first()
    cols = []
    for i, c in enumerate(text.columns):
        misses, n = got[3 * i:3 * i + 3], got[3 * len(text.columns) + i]
        kind = next((k for k, m in zip(kinds, misses) if n and m == 0), None)
        cols.append((F.col(f"`{c}`").try_cast(kind) if kind else F.col(f"`{c}`")).alias(c))
    return text.select(*cols)


def read_json(spark: SparkSession, path: str, lines: bool = False, schema=None) -> DataFrame:
    """An array of records per file (lines=False) or JSON lines (lines=True).
    In line mode a line may also hold an array of records.

    A whole-file array cannot be split: each file is parsed by one task, so
    land large exports as JSON lines (or one array per line), which Spark
    splits by size."""
    r = spark.read.option("multiLine", not lines)
    if schema is not None:
        r = r.schema(schema)
    return nan_to_null(r.json(path))


def read_parquet(spark: SparkSession, path: str, columns=None, normalize_nan: bool = False) -> DataFrame:
    """S3: Parquet; a column list is a projection Catalyst pushes into the scan.

    ``normalize_nan`` turns float NaN into NULL, as the text sources do.  It is
    off by default: a filter on a wrapped column is not pushed into the scan,
    and the operators take NaN as missing all the same."""
    df = spark.read.parquet(path)
    df = df.select(*columns) if columns else df
    return nan_to_null(df) if normalize_nan else df


def read_xml(spark: SparkSession, path: str, row_tag: str | None = None, xpath: str | None = None,
             schema=None) -> DataFrame:
    """Each ``row_tag`` element is a row; child tags and attributes become
    columns; on a name clash the attribute wins.  ``xpath`` uses its last step
    as the row tag."""
    if row_tag is None:
        if not xpath:
            raise ValueError("row_tag or xpath required")
        row_tag = xpath.rstrip("/").split("/")[-1]
    r = spark.read.format("xml").option("rowTag", row_tag).option("attributePrefix", "_")
    if schema is not None:
        r = r.schema(schema)
    df = r.load(path)
    names = df.columns
    attrs = {c[1:]: c for c in names if c.startswith("_") and c != "_VALUE"}
    cols = []
    for c in names:
        if c in attrs.values():
            base = c[1:]
            if base in names:
                cols.append(F.coalesce(F.col(c), F.col(base)).alias(base))
            else:
                cols.append(F.col(c).alias(base))
        elif c in attrs:
            continue  # merged into the attribute column above
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def read_landed(spark: SparkSession, path: str, file_type: str = "csv", **kw) -> DataFrame:
    """Typed dispatch over landed files; anything else is an error."""
    readers = {"csv": read_csv, "json": read_json, "parquet": read_parquet, "xml": read_xml}
    if file_type not in readers:
        raise ValueError(f"unsupported file type {file_type!r}")
    return readers[file_type](spark, path, **kw)


def read_sheet_range(spark: SparkSession, path: str, schema=None, fmt: str = "csv") -> DataFrame:
    """A landed sheet range; the first row is the header.

    ``fmt='csv'``: a CSV export.  ``fmt='json'``: one array of arrays per file
    (a range is one small document).  An empty range gives an empty frame
    with the declared schema (text columns when none is given)."""
    if fmt == "csv":
        return read_csv(spark, path, schema=schema, na_values=[""])
    raw = spark.read.option("wholetext", True).text(path)
    rows = raw.select(F.posexplode(F.from_json("value", "array<array<string>>")).alias("i", "r"))
    head = rows.where(F.col("i") == 0).select("r").take(1)  # header only: one small row
    if not head:
        st = _as_struct(schema) if schema is not None else T.StructType([])
        return spark.createDataFrame([], st)
    names = list(head[0]["r"])
    body = rows.where(F.col("i") > 0).select(*[F.col("r")[i].alias(n) for i, n in enumerate(names)])
    if schema is not None:
        st = _as_struct(schema)
        body = body.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in st.fields])
    return body
