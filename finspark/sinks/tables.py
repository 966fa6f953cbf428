"""Sinks (K1-K10): staged files and versioned tables with append, replace,
insert-ignore, upsert, truncate-and-load and conditional rewrites.

Storage layout of a table: ``<root>/v=<NNNNNN>/`` parquet directories.  A
version is committed once Spark's job commit has written its ``_SUCCESS``
marker; readers use the highest committed version.  Read-modify-write
operations (upsert, update, delete, truncate) always write a *new* version
(never overwrite a path the same plan reads) and keep the previous one, so a
failed or lost job leaves the last good version readable.  Appends and
insert-ignore only add files to the current version.

Row counts come from an ``Observation`` on the written frame: the count is
taken in the same pass as the write, never by an extra ``count()`` job.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Iterable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finspark.functions.scalar import (HIVE_NULL, from_field, from_partition, to_field, to_partition,
                                       ts_literal)
from finspark.schemas import TableSpec
from finspark.session import (checkpoint_dir, observed, range_partitions, read_text, remove_path, scratch_path, staged,
                              write_text)

FORMATS = {"parquet": "parquet", "csv": "csv", "jsonl": "json", "json": "json"}
# JSON times with all their digits
_JSON_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
SCHEMA_FILE = "_schema.json"


# ------------------------------------------------------------ staged files
def _partition_texts(df: DataFrame, partition_by) -> DataFrame:
    return df.withColumns({c: to_partition(c, df.schema[c].dataType) for c in partition_by})


def _stored_as(schema: T.StructType, texts) -> T.StructType:
    """The schema of files in which the columns ``texts`` are text."""
    return T.StructType([T.StructField(f.name, T.StringType() if f.name in texts else f.dataType, True)
                         for f in schema.fields])


def stage(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
          partition_by=None, compression: str | None = None) -> str:
    """K1: write a frame as parquet / csv / jsonl under ``path``; returns the path.

    A ``_schema.json`` beside the files keeps the types.  CSV fields are quoted
    texts in which line breaks, NULL and the empty text have codes, so the
    files can be split and come back as they were; nested columns raise
    ``ValueError``.  Partition folders tell NULL from the empty text.
    Appended frames must have the schema of the files.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}")
    spark, schema = df.sparkSession, df.schema
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    known = _stored_schema(spark, path) if mode == "append" else None
    if known and known[0].simpleString() != schema.simpleString():
        raise ValueError(f"{path} holds {known[0].simpleString()}, not {schema.simpleString()}")
    df = _partition_texts(df, parts)
    if fmt == "csv":
        df = df.select(*[c if c in parts else to_field(F.col(f"`{c}`"), schema[c].dataType).alias(c) for c in df.columns])
    w = df.write.mode(mode).format(FORMATS[fmt])
    if compression:
        w = w.option("compression", compression)
    if fmt == "csv":
        w = w.option("header", True).option("quoteAll", True).option("escape", '"')
        w = w.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if FORMATS[fmt] == "json":
        w = w.options(**_JSON_TIMES)
    if parts:
        w = w.partitionBy(*parts)
    w.save(path)
    write_text(spark, f"{path}/{SCHEMA_FILE}", json.dumps({"schema": schema.jsonValue(), "partition_by": parts}))
    return path


def _stored_schema(spark: SparkSession, path: str) -> tuple[T.StructType, list[str]] | None:
    """(schema, partition columns) that this library wrote beside the files."""
    text = read_text(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}")
    if text is None:
        return None
    found = json.loads(text)
    return T.StructType.fromJson(found["schema"]), found["partition_by"]


def staged_path(base: str, key: str, prefix: str = "staging/") -> str:
    """The staged location of ``key`` under ``base``; the staging prefix
    is added when the key does not already carry it."""
    key = key.lstrip("/")
    if not key.startswith(prefix):
        key = prefix + key
    return f"{base.rstrip('/')}/{key}"


def read_staged(spark: SparkSession, path: str, fmt: str = "parquet",
                schema: T.StructType | str | None = None) -> DataFrame:
    """Read a staged dataset back by format.

    What ``stage`` wrote comes back with its values and types; a ``schema``
    then picks columns by name and casts them.  Files of other writers are
    read plainly (CSV with a header) by ``schema``, or by inference.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}")
    r = spark.read.format(FORMATS[fmt])
    known = _stored_schema(spark, path)
    if known is None:
        if schema is not None:
            r = r.schema(schema)
        if fmt == "csv":
            r = r.option("header", True)
        return r.load(path)
    stored, parts = known
    texts = stored.names if fmt == "csv" else parts
    if fmt == "csv":
        r = r.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
        r = r.option("ignoreTrailingWhiteSpace", False)
    if FORMATS[fmt] == "json":
        r = r.options(**_JSON_TIMES)
    df = r.schema(_stored_as(stored, texts)).load(path)
    decode = {f.name: (from_partition if f.name in parts else from_field)(F.col(f"`{f.name}`"), f.dataType)
              for f in stored.fields if f.name in texts}
    df = df.select(*[decode[c].alias(c) if c in decode else F.col(f"`{c}`") for c in stored.names])
    if schema is None:
        return df
    st = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in st.fields])


def extract_and_stage(df: DataFrame, path: str, source: str, run_ts: _dt.datetime,
                      fmt: str = "parquet", partition_by=None) -> tuple[str, int]:
    """K2: source frame -> lineage columns (F11) -> staged files, as one lazy
    plan executed by the write; returns (path, rows staged)."""
    from finspark.functions.scalar import with_lineage
    out, obs = _count_while_writing(with_lineage(df, source, run_ts), "staged")
    stage(out, path, fmt, partition_by=partition_by)
    return path, observed_rows(obs)


def _count_while_writing(df: DataFrame, name: str):
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def observed_rows(obs: Observation) -> int:
    """Rows counted by an Observation.  When AQE proves the input empty it
    drops the plan; the metric is then absent, and that means 0 rows."""
    return int(observed(obs).get("rows") or 0)


# --------------------------------------------------------- versioned table
class Table:
    """A parquet table rooted at ``root`` (local, HDFS or object store).

    Unpartitioned (default): versioned, ``<root>/v=<NNNNNN>/``; every
    read-modify-write writes a new complete version.

    ``partition_by=[...]``: one directory ``<root>/data/`` with Hive-style
    partitions; read-modify-write operations rewrite only the partitions
    they touch (dynamic partition overwrite of a materialized result).  The
    schema stands in a file beside the data, so partition values have their
    declared types: nothing is guessed from folder names.  A partition is
    known by its text (``to_partition``) in writing, reading, finding and
    removal alike; any NULL, empty or number-like value survives.  A key
    may move between partitions: keyed loads find the partitions that hold
    the batch's keys with a scan of key and partition columns.
    ``partition_of_key=True`` declares the partition columns functions of the
    key (e.g. the month of the trade date), which saves that scan.

    ``keep_versions``: committed versions kept by an unpartitioned table.
    ``compression``: the codec of the files, the session's by default.
    """

    def __init__(self, spark: SparkSession, root: str, spec: TableSpec | None = None,
                 partition_by=None, sort_by=None, partition_of_key: bool = False, keep_versions: int = 2,
                 compression: str | None = None):
        self.spark, self.root, self.spec, self.compression = spark, root.rstrip("/"), spec, compression
        self.partition_of_key, self.keep_versions = partition_of_key, max(1, int(keep_versions))
        self.partition_by = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
        # sorted files: Parquet min/max statistics then skip row groups for
        # filters on these columns (the role of the warehouse's indexes)
        self.sort_by = [sort_by] if isinstance(sort_by, str) else list(sort_by or [])

    # Hadoop FileSystem of the root path (the same one Spark writes with)
    def _fs(self):
        sc = self.spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(self.root)
        return p.getFileSystem(sc._jsc.hadoopConfiguration()), p

    def _path(self, *parts):
        sc = self.spark.sparkContext
        return sc._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    @property
    def data_path(self) -> str:
        return f"{self.root}/data"

    def versions(self, committed: bool = True) -> list[int]:
        """Version numbers; with ``committed=False`` also folders of jobs that
        died before their commit (never read, but never reused either)."""
        fs, root = self._fs()
        if self.partition_by:
            return [1] if fs.exists(self._path("data", "_SUCCESS")) else []
        if not fs.exists(root):
            return []
        out = []
        for st in fs.listStatus(root):
            name = st.getPath().getName()
            if not name.startswith("v="):
                continue
            if not committed or fs.exists(
                    self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(int(name[2:]))
        return sorted(out)

    def exists(self) -> bool:
        return bool(self.versions())

    def path(self, v: int) -> str:
        return f"{self.root}/v={v:06d}"

    def current_path(self) -> str | None:
        vs = self.versions()
        if not vs:
            return None
        return self.data_path if self.partition_by else self.path(vs[-1])

    def read(self) -> DataFrame:
        cur = self.current_path()
        if cur is None:
            if self.spec is None:
                raise FileNotFoundError(f"table {self.root} has no committed version")
            return self.spark.createDataFrame([], self.spec.schema)
        if not self.partition_by:
            return self.spark.read.parquet(cur)
        df = self._stored()
        schema = self._schema()
        return df.select(*[from_partition(F.col(c), schema[c].dataType).alias(c) if c in self.partition_by else F.col(c)
                           for c in schema.names])

    def _schema(self) -> T.StructType:
        known = _stored_schema(self.spark, self.data_path)
        if known is None:
            raise FileNotFoundError(f"{self.data_path} lacks {SCHEMA_FILE}")
        return known[0]

    def _stored(self) -> DataFrame:
        """A partitioned table as it is stored: partition columns as texts."""
        return self.spark.read.schema(_stored_as(self._schema(), self.partition_by)).parquet(self.data_path)

    def _writer(self, df: DataFrame, mode: str):
        options = {"compression": self.compression} if self.compression else {}
        if not self.partition_by:
            if self.sort_by:
                df = df.sortWithinPartitions(*self.sort_by)
            return df.write.mode(mode).options(**options)
        # Rebalance on the partition columns: each task writes few partition
        # folders (few files); AQE splits a hot partition value over several
        # tasks and merges small ones.  No sampling pass over the input.
        # Partition columns are texts from here on; a sort by them sorts texts.
        balanced = df.hint("rebalance", *self.partition_by)
        if self.sort_by:
            rest = [c for c in self.sort_by if c not in self.partition_by]
            balanced = balanced.sortWithinPartitions(*self.partition_by, *rest)
        return balanced.write.mode(mode).options(**options).partitionBy(*self.partition_by)

    def commit(self, df: DataFrame) -> int:
        """Replace the whole content; returns the rows written.  Unpartitioned:
        a new version.  Partitioned: dynamic overwrite of the partitions in
        ``df``, then removal of the old partitions it does not hold.  Nothing
        old is deleted before the job commits, so a failed job leaves the
        previous content (``df`` must not read this table)."""
        if self.partition_by:
            old = self.values(self._stored().select(*self.partition_by).distinct()) if self.exists() else []
            return self.replace_partitions(df, touched=old, replace_schema=True)
        vs = self.versions(committed=False)
        nxt = (vs[-1] + 1) if vs else 1
        out, obs = _count_while_writing(df, f"commit_{nxt}")
        self._writer(out, "errorifexists").parquet(self.path(nxt))
        for v in self.versions()[:-self.keep_versions]:
            remove_path(self.spark, self.path(v))
        return observed_rows(obs)

    def append(self, df: DataFrame) -> int:
        cur = self.current_path()
        if cur is None:
            return self.commit(df)
        if self.partition_by:
            df = _partition_texts(df, self.partition_by)
        out, obs = _count_while_writing(df, "append")
        self._writer(out, "append").parquet(cur)
        return observed_rows(obs)

    def replace_partitions(self, df: DataFrame, touched: list[tuple] | None = None, replace_schema: bool = False) -> int:
        """Partitioned tables: replace exactly the partitions present in ``df``
        (which must not read this table: materialize it first).  Partitions in
        ``touched`` (their texts) that ``df`` no longer holds are removed."""
        written, left = self._overwrite(df, replace_schema)
        fs, _ = self._fs()
        for texts in touched or ():
            if tuple(texts) not in left:
                fs.delete(self._path("data", *self._folders(texts)), True)
        self._mark()
        return written

    def _overwrite(self, df: DataFrame, replace_schema: bool = False) -> tuple[int, set[tuple]]:
        """Write the partitions in ``df``; returns the rows written and the partitions' texts."""
        # one evaluation of df: rows and partition texts are observed by the write
        obs = Observation("replace_partitions")
        schema, df = df.schema, _partition_texts(df, self.partition_by)
        values = F.collect_set(F.struct(*[F.col(c) for c in self.partition_by]))
        out = df.observe(obs, F.count(F.lit(1)).alias("rows"), values.alias("values"))
        new = not self.exists()
        self._writer(out, "overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.data_path)
        written = observed_rows(obs)
        if new or replace_schema:
            write_text(self.spark, f"{self.data_path}/{SCHEMA_FILE}",
                       json.dumps({"schema": schema.jsonValue(), "partition_by": self.partition_by}))
        return written, {tuple(r) for r in observed(obs).get("values") or ()}

    def _folders(self, texts) -> list[str]:
        """The nested folders of a partition."""
        escape = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        return [f"{escape(c)}={HIVE_NULL if v is None else escape(v)}" for c, v in zip(self.partition_by, texts)]

    def _mark(self) -> None:
        """Dynamic overwrite writes no _SUCCESS at the root: a partitioned table
        is marked as committed here, after its job succeeded."""
        fs, marker = self._fs()[0], self._path("data", "_SUCCESS")
        if not fs.exists(marker):
            fs.create(marker, True).close()

    def take_partitions(self, made: "Table", touched: list[tuple] = ()) -> None:
        """Partitioned tables: replace the partitions that ``made`` holds, a table
        of the same columns on the same file system, by its folders, which are
        moved here.  Partitions in ``touched`` that ``made`` lacks are removed."""
        fs, _ = self._fs()
        if not self.exists():
            write_text(self.spark, f"{self.data_path}/{SCHEMA_FILE}", read_text(self.spark, f"{made.data_path}/{SCHEMA_FILE}"))
        found = [[]]
        for _ in self.partition_by:
            found = [[*parts, name] for parts in found for st in fs.listStatus(made._path("data", *parts))
                     if st.isDirectory() and "=" in (name := st.getPath().getName()) and name[0] not in "._"]
        for parts in found:
            to = self._path("data", *parts)
            fs.mkdirs(to.getParent())
            fs.delete(to, True)
            if not fs.rename(made._path("data", *parts), to):
                raise OSError(f"{made._path('data', *parts)} could not be moved to {to}")
        for texts in touched:
            if (parts := self._folders(texts)) not in found:
                fs.delete(self._path("data", *parts), True)
        self._mark()

    def touched(self, df: DataFrame) -> DataFrame:
        """Distinct partitions (texts) that the rows of ``df`` belong to."""
        return _partition_texts(_as_types(df.select(*self.partition_by), self._schema()), self.partition_by).distinct()

    def holding(self, keys: DataFrame, key: list[str]) -> DataFrame:
        """Partitions (texts) of the rows whose key is in ``keys`` (reads key and partition columns)."""
        schema = self._schema()
        own = self._stored().select(
            *[F.col(c).alias(f"__p_{c}") for c in self.partition_by],
            *[from_partition(F.col(c), schema[c].dataType).alias(c) if c in self.partition_by else F.col(c) for c in key])
        return (own.join(keys.select(*key), key, "left_semi")
                .select(*[F.col(f"__p_{c}").alias(c) for c in self.partition_by]).distinct())

    def values(self, parts: DataFrame) -> list[tuple]:
        """Partition texts, one tuple per partition."""
        return [tuple(r) for r in parts.select(*self.partition_by).collect()]

    def read_partitions(self, parts: DataFrame) -> DataFrame:
        """The table's rows in the given partitions, by their texts (NULL-safe;
        the semi join lets Spark prune partitions at run time)."""
        p = parts.select(*[F.col(c).alias(f"__p_{c}") for c in self.partition_by])
        cond = reduce(lambda a, b: a & b,
                      [F.col(c).eqNullSafe(F.col(f"__p_{c}")) for c in self.partition_by])
        schema = self._schema()
        return self._stored().join(p, cond, "left_semi").select(
            *[from_partition(F.col(c), schema[c].dataType).alias(c) if c in self.partition_by else F.col(c)
              for c in schema.names])


def _as_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in df.columns])


def _align_to(df: DataFrame, target: DataFrame) -> DataFrame:
    have = set(df.columns)
    return df.select(*[F.col(f.name).cast(f.dataType) if f.name in have
                       else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in target.schema.fields])


def _known_columns(table: Table) -> dict[str, T.DataType]:
    """Columns and types of the table, or those its spec declares before the first load."""
    if not table.exists() and table.spec is None:
        return {}
    return {f.name: f.dataType for f in table.read().schema.fields}


def _keys_as_stored(df: DataFrame, key: list[str], known: dict[str, T.DataType]) -> DataFrame:
    """Key columns in the table's types: ``01`` and ``1`` are one key of an integer column, so they
    must be equal before rows are compared, not only when they are written."""
    own = {k: F.col(k).cast(known[k]) for k in key if k in known and known[k] != df.schema[k].dataType}
    return df.withColumns(own) if own else df


# ------------------------------------------------------------------ loads
def load(df: DataFrame, table: Table, if_exists: str = "append") -> int:
    """K3: append / replace / fail; returns the rows loaded."""
    if if_exists not in ("append", "replace", "fail"):
        raise ValueError(f"if_exists must be append, replace or fail, not {if_exists!r}")
    if table.exists():
        if if_exists == "fail":
            raise FileExistsError(f"table {table.root} exists")
        if if_exists == "replace":
            return table.commit(df)
        return table.append(_align_to(df, table.read()))
    return table.commit(df)


def truncate_and_load(df: DataFrame, table: Table) -> int:
    """K6: the new content replaces the table in one version switch (no empty window)."""
    return table.commit(df)


def _by_key(df: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """(rows with a whole key, rows with a NULL key part).  The latter never
    conflict (SQL unique semantics): they go through no dedupe and no join, and
    come back by union.  None where the schema says that no key part is NULL."""
    if not any(df.schema[k].nullable for k in key):
        return df, None
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    return df.where(~has_null), df.where(has_null)


def _and(df: DataFrame, more: DataFrame | None) -> DataFrame:
    return df if more is None else df.unionByName(more)


def _one_per_key(df: DataFrame, key: list[str], order_col: str | None, last: bool) -> DataFrame:
    """One row per key (whole keys), the last (or first) by ``order_col``.

    The smallest or largest row by (order value, then all columns) is taken, an
    aggregate rather than a row_number window: it is combined map-side, so a
    key repeated many times is reduced before the shuffle.  Rows are compared
    by content, NULLs included, so the pick never depends on the run.  A NULL
    order value comes before all others when the last row is wanted and after
    all others when the first is.

    Without ``order_col`` rows that repeat a key must be equal: rows of a
    distributed table have no order, so different ones raise an error."""
    cols = list(df.columns)
    rest = [c for c in cols if c not in key]
    if not rest:
        return df.dropDuplicates(key)

    def ordered(c):  # maps have no order; their sorted entries do
        kind = df.schema[c].dataType
        if "map<" not in kind.simpleString():
            return F.col(c)
        if isinstance(kind, T.MapType) and "map<" not in kind.valueType.simpleString():
            return F.array_sort(F.map_entries(c))
        return F.to_json(F.struct(F.col(c)), {"ignoreNullFields": "false"})

    by, row = [ordered(c).alias(f"c{i}") for i, c in enumerate(rest)], F.struct(*rest)
    if order_col is not None:
        o = F.col(order_col)
        by = [(o.isNotNull() if last else o.isNull()).alias("known"), o.alias("o"), *by]
    by, maps = F.struct(*by), any("map<" in df.schema[c].dataType.simpleString() for c in rest)
    if maps:
        low, high = F.min_by(row, by), F.max_by(row, by)
    else:
        low, high = F.min(by), F.max(by)
    if order_col is None:
        mixed = F.raise_error(F.concat(F.lit("rows that repeat a key differ, pass order_col: "),
                                       F.to_json(F.struct(*key))))
        picked = F.when(F.min(by).eqNullSafe(F.max(by)), high).otherwise(mixed)
    else:
        picked = high if last else low
    out = df.groupBy(*key).agg(picked.alias("__row"))
    names = rest if maps else [f"c{i}" for i in range(len(rest))]
    return out.select(*key, *[F.col(f"__row.{n}").alias(c) for n, c in zip(names, rest)]).select(*cols)


def insert_ignore(df: DataFrame, table: Table, key, order_col: str | None = None, stored: bool = False) -> int:
    """K4: rows whose key already exists (anywhere in the table, or earlier in
    the batch) are skipped.  A NULL key part never conflicts (SQL unique
    semantics): such rows are never deduplicated and never match the table.
    Keys are compared in the table's types.

    The batch is written once to the shared folder and read for both kinds of
    rows, unless ``stored`` says that it is read straight from files."""
    key = [key] if isinstance(key, str) else list(key)
    if not stored and any(df.schema[k].nullable for k in key):
        df = staged(df, "insert_batch")
    df = _keys_as_stored(df, key, _known_columns(table))
    keyed, nameless = _by_key(df, key)
    first = _one_per_key(keyed, key, order_col, last=False)
    if not table.exists():
        return table.commit(_and(first, nameless))
    cur = table.read()
    if table.partition_by and table.partition_of_key:
        existing = table.read_partitions(table.touched(df))
    else:
        existing = cur
    held, _ = _by_key(existing.select(*key), key)
    new = first.join(held, key, "left_anti").select(*first.columns)
    return table.append(_align_to(_and(new, nameless), cur))


def upsert(df: DataFrame, table: Table, key, update_columns=None,
           order_col: str | None = None, stored: bool = False) -> int:
    """K5: insert new keys; on an existing key update ``update_columns``
    (default: every non-key column); within the batch the last row per key
    wins.  An empty update set behaves as insert-ignore.  Rows with a NULL key
    part are inserted, and kept in the table.  An unpartitioned table gets a
    new complete version; a partitioned one has only the partitions rewritten
    that the batch goes to or that hold its keys (a key may move): they are
    read while the new ones are written beside them, and replaced when the job
    commits.  Returns the
    number of source rows applied (after in-batch dedupe).  Keys are compared
    in the table's types.  ``order_col`` is loaded and updated like any other
    column where the table (or its spec) has it, and only orders the batch
    where it has not.

    The batch is written once to the shared folder, unless ``stored`` says that
    it is read straight from files."""
    key = [key] if isinstance(key, str) else list(key)
    known = _known_columns(table)
    if update_columns is None:
        update_columns = [c for c in df.columns if c not in key and (c != order_col or c in known)]
    if not update_columns:
        return insert_ignore(df, table, key, order_col, stored)
    merges = table.partition_by and table.exists()
    if not stored and (merges or any(df.schema[k].nullable for k in key)):
        df = staged(df, "upsert_batch")
    merged, touched, counts, scratch = _merged(df, table, key, update_columns, order_col, known)
    if not table.exists():
        return table.commit(merged)
    if table.partition_by:
        # dynamic overwrite removes the files that are read here only after the last task
        table.replace_partitions(merged, touched)
    else:
        table.commit(merged)
    for path in scratch:
        remove_path(table.spark, path)
    return sum(map(observed_rows, counts))


def upsert_slices(slices: Iterable[DataFrame], table: Table, key, update_columns: list[str],
                  order_col: str | None = None) -> int:
    """K5 of a batch that comes as several frames read from files, one after the
    other, to a table whose partition columns are functions of the key.  Rows of
    one partition must be in one frame.

    Shuffle files then are those of one frame.  What the frames make is written
    beside the table and moved there when all are written, so a failure before
    that leaves the table as it was.  A frame may be removed as soon as the next
    one is asked for.  Returns what ``upsert`` does."""
    if not (table.partition_by and table.partition_of_key and update_columns):
        raise ValueError("slices need a table partitioned by functions of its key, and columns to update")
    key = [key] if isinstance(key, str) else list(key)
    spark, known, exists = table.spark, _known_columns(table), table.exists()
    pending = Table(spark, f"{table.root}/pending", partition_by=table.partition_by, sort_by=table.sort_by,
                    compression=table.compression)
    remove_path(spark, pending.root)
    applied, replaced, written = 0, set(), set()
    try:
        for df in slices:
            merged, touched, counts, scratch = _merged(df, table, key, update_columns, order_col, known)
            rows, made = pending._overwrite(merged)
            pending._mark()
            if (made | set(touched)) & (replaced | written):
                raise ValueError(f"rows of one partition stand in several slices: {sorted(made & written, key=str)}")
            replaced, written = replaced | set(touched), written | made
            applied += sum(map(observed_rows, counts)) if exists else rows
            for path in scratch:
                remove_path(spark, path)
        if pending.exists():
            table.take_partitions(pending, sorted(replaced - written, key=str))
    finally:
        remove_path(spark, pending.root)
    return applied


def _merged(df: DataFrame, table: Table, key: list[str], update_columns: list[str], order_col: str | None,
            known: dict[str, T.DataType]) -> tuple[DataFrame, list[tuple], list[Observation], list[str]]:
    """What an upsert writes: the batch ``df``, merged with the table's rows (of a partitioned table those
    of the partitions that change) where the table exists; then also the texts of these partitions, counts of
    the rows applied, and scratch folders to be removed when the rows are written."""
    df = _keys_as_stored(df, key, known)
    keyed, nameless = _by_key(df, key)
    src = _one_per_key(keyed, key, order_col, last=True)
    if order_col and order_col not in known:
        src, nameless = src.drop(order_col), nameless and nameless.drop(order_col)
    if not table.exists():
        return _and(src, nameless), [], [], []
    spark, tgt = table.spark, table.read()
    cols = tgt.columns
    scratch, touched, counts = [], None, []
    if table.partition_by:
        missing = [c for c in table.partition_by if c not in df.columns]
        if missing:
            raise ValueError(f"source lacks partition columns {missing}")
        # the batch says which partitions are read and rewritten
        parts = table.touched(df)
        if not table.partition_of_key:
            parts = parts.unionByName(table.holding(df, key)).distinct()
        scratch.append(scratch_path(spark, "upsert_parts"))
        parts.write.parquet(scratch[0])
        parts = spark.read.schema(parts.schema).parquet(scratch[0])
        touched = table.values(parts)
        tgt = table.read_partitions(parts)
    src, obs = _count_while_writing(src, "upsert_source")
    counts.append(obs)
    if nameless is not None:
        nameless, obs = _count_while_writing(nameless, "upsert_nameless")
        counts.append(obs)
    t, t_nameless = _by_key(tgt, key)
    s = _align_to(src, tgt).select(*[F.col(c).alias(f"s__{c}") for c in cols], F.lit(True).alias("s____s"))
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"s__{k}") for k in key])
    j = t.withColumn("__t", F.lit(True)).join(s, cond, "full_outer")
    src_present = F.coalesce(F.col("s____s"), F.lit(False))
    tgt_present = F.coalesce(F.col("__t"), F.lit(False))
    out = []
    for c in cols:
        if c in update_columns and c not in key:
            e = F.when(src_present, F.col(f"s__{c}")).otherwise(F.col(c))
        else:
            e = F.when(tgt_present, F.col(c)).otherwise(F.col(f"s__{c}"))
        out.append(e.alias(c))
    merged = _and(_and(j.select(*out), t_nameless), nameless and _align_to(nameless, tgt))
    return merged, touched or [], counts, scratch


def _rewrite(table: Table, cond: Column, rewrite, moves: bool = False) -> int:
    """Shared UPDATE / DELETE path; returns the rows matching ``cond``.  ``moves``: rows may change partition."""
    cur = table.read()
    obs = Observation("matched")
    if not table.partition_by:
        table.commit(rewrite(cur.observe(obs, F.count_if(cond).alias("rows"))))
        return observed_rows(obs)
    # partitioned: rewrite only partitions that hold a matching row or get one
    hit = cur.where(cond)
    parts = table.touched(hit)
    if moves:
        parts = parts.union(table.touched(rewrite(hit))).distinct()
    parts = staged(parts, "rewrite_parts")
    touched = table.values(parts)
    if not touched:
        return 0
    sub = table.read_partitions(parts).observe(obs, F.count_if(cond).alias("rows"))
    path = scratch_path(table.spark, "rewrite_result")
    new = rewrite(sub)
    new.write.parquet(path)
    table.replace_partitions(table.spark.read.schema(new.schema).parquet(path), touched)
    remove_path(table.spark, path)
    return observed_rows(obs)


def update_where(table: Table, updates: dict, where) -> int:
    """K10 UPDATE: rewrite with ``c = when(where, value).otherwise(c)``; returns rows matched.

    Values are cast to the column's type.  A row whose partition column is
    updated moves to that partition, beside the rows that are there."""
    cond = F.coalesce(where if not isinstance(where, str) else F.expr(where), F.lit(False))

    def rewrite(df: DataFrame) -> DataFrame:
        new = {c: v if isinstance(v, Column) else F.lit(v) for c, v in updates.items()}
        return df.withColumns({c: F.when(cond, v.cast(df.schema[c].dataType)).otherwise(F.col(c))
                               for c, v in new.items()})

    return _rewrite(table, cond, rewrite, moves=any(c in table.partition_by for c in updates))


def delete_where(table: Table, where) -> int:
    """K10 DELETE: rewrite without the matching rows; returns rows deleted."""
    cond = F.coalesce(where if not isinstance(where, str) else F.expr(where), F.lit(False))
    return _rewrite(table, cond, lambda d: d.where(~cond))


# ---------------------------------------------------------------- conform
def conform(df: DataFrame, spec: TableSpec, defaults: dict | None = None, carry=()):
    """K7: project to the target schema (order, types, NULL for absent columns,
    defaults), and split rows breaking NOT NULL, overflowing a decimal or
    longer than a VARCHAR.

    Returns (good, rejects); ``rejects`` carries a ``reject_reason`` and the
    ``carry`` columns of the input (e.g. a source row id).  Decimal
    casts round half away from zero; a value that does not fit becomes a
    reject instead of an error.
    """
    carry = list(carry)
    return split_conformed(conformed(df, spec, defaults, carry), carry)


def split_conformed(marked: DataFrame, carry=()):
    """(good, rejects) of what ``conformed`` made."""
    good = marked.where(F.col("reject_reason") == "").drop("reject_reason", *carry)
    return good, marked.where(F.col("reject_reason") != "")


def conformed(df: DataFrame, spec: TableSpec, defaults: dict | None = None, carry=()) -> DataFrame:
    """K7 before its split: all rows in the target's columns, with ``carry`` and
    ``reject_reason`` (empty for good rows).  Written once, the casts are made once."""
    defaults = defaults or {}
    have = set(df.columns)
    cols, broken = [], []
    for f in spec.schema.fields:
        if f.name in have:
            src = F.col(f.name)
            e = src.try_cast(f.dataType) if not isinstance(f.dataType, T.StringType) else src.cast("string")
            broken.append(F.when(src.isNotNull() & e.isNull(), F.lit(f"cast:{f.name}")))
        else:
            e = F.lit(None).cast(f.dataType)
        if f.name in defaults:
            d = defaults[f.name]
            if isinstance(d, (_dt.datetime, _dt.date)):
                lit = ts_literal(d).cast(f.dataType)
            elif isinstance(d, (str, int, float)):
                lit = F.lit(d).cast(f.dataType)
            else:
                lit = d
            e = F.coalesce(e, lit)
        cols.append(e.alias(f.name))
        if f.name in spec.lengths:
            broken.append(F.when(F.length(e) > spec.lengths[f.name], F.lit(f"length:{f.name}")))
        if f.name in spec.not_null:
            broken.append(F.when(e.isNull(), F.lit(f"null:{f.name}")))
    reason = F.concat_ws(",", *broken) if broken else F.lit("")
    return df.select(*cols, *carry, reason.alias("reject_reason"))


def duplicate_keys(df: DataFrame, key) -> DataFrame:
    """K7 key report: keys present more than once (pre-aggregated count per key)."""
    key = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


# -------------------------------------------------------------- run logs
RUN_LOG_SCHEMA = ("run_id BIGINT, dag_id STRING, task_id STRING, source_name STRING, "
                  "run_start_time TIMESTAMP_NTZ, run_end_time TIMESTAMP_NTZ, status STRING, "
                  "records_extracted BIGINT, records_validated BIGINT, records_loaded BIGINT, "
                  "error_message STRING, created_at TIMESTAMP_NTZ")


def reserve_run_id(spark: SparkSession, table: Table) -> int:
    """K8: a run id that no other run has: the first number after the log's
    largest whose file this run is the first to create in ``<root>/_ids``.

    HDFS and local folders create a file once; object stores must support
    conditional writes for that.
    """
    last = table.read().agg(F.max("run_id")).first()[0] if table.exists() else None
    sc = spark.sparkContext
    fs, _ = table._fs()
    folder = table._path("_ids")
    fs.mkdirs(folder)
    run_id = (last or 0) + 1
    while True:
        name = sc._jvm.org.apache.hadoop.fs.Path(folder, str(run_id))
        if fs.getScheme() == "file":
            if sc._jvm.java.io.File(name.toUri().getPath()).createNewFile():
                return run_id
        elif not fs.exists(name):
            try:
                fs.create(name, False).close()
                return run_id
            except Py4JJavaError:
                if not fs.exists(name):
                    raise
        run_id += 1


def log_run(spark: SparkSession, table: Table, run_id: int | None, dag_id: str, task_id: str,
            source_name: str, status: str, run_start: _dt.datetime, run_end: _dt.datetime | None = None,
            extracted: int | None = None, validated: int | None = None, loaded: int | None = None,
            error: str | None = None) -> int:
    """K8: append one run-log row (counts come from Observations of the run).

    With ``run_id=None`` the next id is reserved (``reserve_run_id``), so runs
    at the same time never share one; returns the id used."""
    if run_id is None:
        run_id = reserve_run_id(spark, table)
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    row = [(run_id, dag_id, task_id, source_name, run_start, run_end or now, status,
            extracted, validated, loaded, error, now)]
    table.append(spark.createDataFrame(row, RUN_LOG_SCHEMA))
    return run_id


def quality_log_rows(results: DataFrame, run_id: int | None, created_at: _dt.datetime) -> DataFrame:
    """K9: one quality-log row per validator from ``quality.evaluate`` output,
    with the failing checks as JSON details."""
    total = F.col("is_total")
    detail = F.to_json(F.collect_list(F.when(~F.col("ok") & ~total,
                                             F.struct("check", "column", "failed", "details"))))
    g = results.groupBy("validator").agg(
        F.max(F.when(total, F.col("check"))).alias("validation_type"),
        F.sum(F.when(total, F.col("passed"))).alias("passed_records"),
        F.sum(F.when(total, F.col("failed"))).alias("failed_records"),
        detail.alias("validation_details"))
    return g.select(
        F.lit(None).cast("bigint").alias("quality_id"), F.lit(run_id).cast("bigint").alias("run_id"),
        "validation_type", F.col("validator").alias("validation_rule"),
        "passed_records", "failed_records", "validation_details",
        ts_literal(created_at).alias("created_at"))


def fk_violations(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent (NULL keys are not violations)."""
    p = parent.select(F.col(parent_key).alias("__pk")).distinct()
    return (child.where(F.col(child_key).isNotNull())
            .join(p, F.col(child_key) == F.col("__pk"), "left_anti"))


MANY_RANGES = 1000


def surrogate_key(df: DataFrame, order_cols, name: str = "id", partitions: int | None = None,
                  rows_per_partition: int = 2_000_000) -> DataFrame:
    """stable 1-based id = position in ``order_cols`` order (row_number over
    a global order) without a single-partition window.

    Rows of equal order values follow each other by all their columns (a digest
    of the content), so ids do not depend on the run; rows that are equal
    throughout are interchangeable.  Rows are range-partitioned on the order
    columns, that digest and a number of the row, so a value or a row that
    repeats often spans partitions.  Per-partition counts (one row per
    partition, a proven small table) give each partition its offset, and the id
    is offset + row number inside the partition.  The partition count grows
    with the input (``rows_per_partition`` rows each).  The driver holds a
    sample and a task's end for every partition: past ``MANY_RANGES`` of them,
    partitions are larger rather than more, up to 2 million rows each.
    """
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    spark = df.sparkSession
    columns = df.columns
    content = F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false", **_JSON_TIMES})
    # computed once: counted, sampled and dealt from there
    df = staged(df.withColumns({"__tie": F.unhex(F.sha2(content, 256))}), "surrogate_key")
    n = partitions or range_partitions(df, rows_per_partition)
    if not partitions and n > MANY_RANGES:
        n = min(n, max(MANY_RANGES, range_partitions(df, 2_000_000)))
    # Materialized (reliable checkpoint in the shared checkpoint folder),
    # so the counts and the numbering see the very same partition ids.
    checkpoint_dir(spark)
    ranged = (df.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(n, *order_cols, "__tie", "__row")
              .withColumn("__pid", F.spark_partition_id()).checkpoint(eager=True))
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    from pyspark.sql import Window
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(
        Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"))
    w = Window.partitionBy("__pid").orderBy(*order_cols, "__tie")
    out = ranged.join(F.broadcast(offsets), "__pid").withColumn(
        name, F.col("__off") + F.row_number().over(w))
    return out.select(*[F.col(f"`{c}`") for c in columns if c != name], name)
