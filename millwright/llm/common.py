"""Helpers shared by the corpus operators: tables, shared scratch space, names."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space in the sense of every contract here: space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

#: Hadoop's checksum layer starts a chmod process for each local file and each checksum beside it, twice for
#: every part of a scratch table; a process that a JVM is starting counts as large as that JVM. Other stores ignore this.
_PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}

_OWN_DIRS: dict[str, str] = {}
_ROOTS: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` below ``sf_dir`` (any path Spark can read)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A folder of this application that driver and executors share.

    It lies below ``spark.checkpoint.dir``. Where the session names none, as in
    tests on one machine, a temporary folder of the driver takes its place.
    """
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        if not top:
            top = _OWN_DIRS.setdefault(app, "file://" + tempfile.mkdtemp(prefix="millwright-"))
        root = f"{top.rstrip('/')}/millwright-{uuid.uuid4().hex}"
        _ROOTS[app] = root
        atexit.register(_remove, spark, root)
    return _ROOTS[app]


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex[:12]}"


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Deletes a scratch table that no later plan reads."""
    _remove(spark, path)


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    This cuts lineage and outlives lost executors; it is used where a result
    feeds several plans, so that none of them computes it again.
    """
    return stored(df, tag)[0]


def stored(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """Like ``materialise``, with the path, for tables that can be dropped early."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.options(compression="zstd", **_PLAIN_FILES).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def one_task_each(manifest: DataFrame, part: str = "part") -> DataFrame:
    """A materialised manifest of files dealt out to one task per file; ``part`` is the number of the task that wrote it."""
    last = manifest.agg(F.max(part)).first()[0]
    return manifest.repartitionById((last or 0) + 1, F.col(part).cast("int"))


_HELD: dict = {}


def held(key, make):
    """What ``make`` gave for ``key`` in this Python worker, which holds one such thing at a time.

    Workers serve the tasks of many operators; their caches would add up.
    """
    if key not in _HELD:
        release()
        _HELD[key] = make()
    return _HELD[key]


def release() -> None:
    """Gives back what this Python worker holds, also to the system where it can."""
    if _HELD:
        _HELD.clear()
        trim()


def tidy(run):
    """``run``, a function from batches to batches, in a worker that holds no cache and gives its memory back at the end.

    Workers stay while other tasks run, and keep what their allocators have not returned.
    """

    @functools.wraps(run)
    def tidied(batches):
        release()
        yield from run(batches)
        trim()

    return tidied


def trim() -> None:
    """Gives freed memory of this process back to the system: Arrow's pool, and the C library's where it can."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def fresh(columns: list[str], *wanted: str) -> list[str]:
    """Column names like ``wanted`` that clash with none of ``columns`` (case ignored)."""
    taken = {c.lower() for c in columns}
    out = []
    for name in wanted:
        new, k = name, 0
        while new.lower() in taken:
            k += 1
            new = f"{name}_{k}"
        taken.add(new.lower())
        out.append(new)
    return out
