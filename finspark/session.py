"""Session builder and cluster-level settings.

Everything here is plain SparkSession configuration; the library never
hand-schedules work that Catalyst / AQE already do.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from contextlib import contextmanager

from py4j.protocol import Py4JError, Py4JJavaError
from pyspark.sql import SparkSession

# Settings every job in the library assumes.  ANSI mode stays on (Spark 4
# default) so bad casts fail loudly; every operator that can divide by zero
# uses try_divide / nullif instead.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE sizes post-shuffle partitions to ~128 MB; set shuffle.partitions high
    # on a cluster and let AQE coalesce.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "finspark",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's base settings.

    On a cluster ``master`` stays None so spark-submit decides; tests pass
    ``local[*]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must point at shared storage (HDFS, object
    store) and is used as is; a missing setting is an error there.  Only a
    local-mode session (tests) without the setting gets a scratch folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not d:
        d = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store)")
        d = tempfile.mkdtemp(prefix="finspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc.setCheckpointDir(d)
    return d


# open scopes of scratch folders, innermost last; the folders of each application
_scopes: list[list[str]] = []
_applications: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for written tables, below a folder of this application in
    the shared checkpoint folder.  It goes with the enclosing ``scratch_scope``,
    or else when the application's Python ends."""
    app = f"{checkpoint_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}"
    if app not in _applications:
        _applications.add(app)
        sc = spark.sparkContext
        atexit.register(_remove_at_exit, sc._jvm.org.apache.hadoop.fs.Path(app), sc._jsc.hadoopConfiguration())
    path = f"{app}/{name}-{uuid.uuid4().hex[:12]}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def _remove_at_exit(path, conf) -> None:
    try:
        path.getFileSystem(conf).delete(path, True)
    except (Py4JError, OSError):
        pass  # the JVM has gone already


@contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch folders made inside are removed at the end: frames that read them
    must have been written or collected by then."""
    own: list[str] = []
    _scopes.append(own)
    try:
        yield
    finally:
        _scopes.remove(own)
        for path in own:
            remove_path(spark, path)


def staged(df, name: str):
    """``df`` written once as Parquet in the shared folder and read back: a plan
    that several steps need is computed once, and they read their columns only."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_end_with_actions(spark: SparkSession):
    """Shuffle files of an action made inside are removed when it ends, not when
    the driver happens to collect its garbage: the steps of a job do not add up
    on disk.  A frame run twice inside makes its shuffle files again."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def observed(obs) -> dict:
    """The metrics of an Observation; empty when AQE proved the input empty and
    dropped the plan (its metric row then has no schema).  Other errors are raised."""
    try:
        return obs.get
    except Py4JJavaError as e:
        if e.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return {}


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder written by this library (scratch files, old versions)."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    """A small file, through the Hadoop file system that Spark writes with; without ``overwrite`` an
    existing file is an error."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(sc._jsc.hadoopConfiguration()).create(p, overwrite)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None when there is none."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return sc._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def path_exists(spark: SparkSession, path: str) -> bool:
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()).exists(p)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none when it doesn't exist."""
    if not path_exists(spark, path):
        return []
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return [st.getPath().getName() for st in p.getFileSystem(sc._jsc.hadoopConfiguration()).listStatus(p)]


def range_partitions(df, rows_per_partition: int) -> int:
    """Partition count for a range repartition of ``df``, a staged frame (its
    rows are counted from file footers).

    AQE coalesces small shuffle partitions but never splits range partitions,
    so the count must grow with the data: at least
    ``spark.sql.shuffle.partitions``, and enough for ``rows_per_partition``
    rows each.
    """
    base = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.count()
    return max(base, -(-rows // int(rows_per_partition)))
