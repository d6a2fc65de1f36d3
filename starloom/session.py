"""Session settings and the shared folder that intermediate tables live in."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# Settings a session should carry for this library. They can all be changed at
# run time; adaptive execution is what splits hot join keys and merges small
# shuffle partitions.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_roots: dict[str, str] = {}
_handed_out: dict[str, list[str]] = {}
_to_drop: dict[str, list[str]] = {}


def apply_runtime(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "starloom", cores: int | str = 8, partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own: a
    machine-local folder would be lost with its executor on a cluster.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        _local_roots[app] = tempfile.mkdtemp(prefix="starloom-")
        atexit.register(shutil.rmtree, _local_roots[app], True)
    return _local_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder name under the shared root."""
    app = spark.sparkContext.applicationId
    path = f"{shared_root(spark)}/starloom-{app}/{label}-{uuid.uuid4().hex[:12]}"
    _handed_out.setdefault(app, []).append(path)
    return path


def drop_later(spark: SparkSession, *names: str, kind: str = "TABLE") -> None:
    """Have ``release_scratch`` drop tables, or databases with all they hold."""
    tail = " CASCADE" if kind == "DATABASE" else ""
    dropped = _to_drop.setdefault(spark.sparkContext.applicationId, [])
    dropped.extend(f"DROP {kind} IF EXISTS {name}{tail}" for name in names)


def release_scratch(spark: SparkSession) -> int:
    """Drop what ``drop_later`` named and delete the scratch folders this session was given.

    Results read from them end here.
    """
    app = spark.sparkContext.applicationId
    for statement in _to_drop.pop(app, []):
        spark.sql(statement)
    return sum(delete_path(spark, path) for path in _handed_out.pop(app, []))


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write to the shared root and read back.

    The copy outlives any executor, and values that would differ on a second
    evaluation (range bounds, generated ids) are fixed from here on.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of each query in here go when it ends, not when the driver collects its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def child_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def child_files(spark: SparkSession, path: str) -> list[str]:
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()]
    return sorted(n for n in names if not n.startswith((".", "_")))


def read_file(spark: SparkSession, path: str) -> str:
    """A small text file, whole."""
    fs, p = _file_system(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file that must not exist yet; False when it does."""
    fs, p = _file_system(spark, path)
    try:
        stream = fs.create(p, False)
    except Py4JJavaError as error:
        if fs.exists(p):
            return False
        raise error
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.delete(p, True)
