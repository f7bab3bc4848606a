"""Tables an operator writes for itself in the folder that all executors share."""

from __future__ import annotations

import ctypes
import hashlib
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Spark's setting by which a query's shuffle files go when it ends.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset on a single machine (as in tests), one made here."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="millrace-")
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def ship(spark: SparkSession) -> None:
    """Give the workers this package, once a context, in case that it isn't installed on them."""
    context = spark.sparkContext
    if getattr(context, "_millrace_shipped", False):
        return
    top = Path(__file__).resolve().parent.parent
    sources = {str(p.relative_to(top.parent)): p.read_bytes() for p in sorted(top.rglob("*.py"))}
    digest = hashlib.sha256(repr(sources).encode()).hexdigest()[:12]
    with zipfile.ZipFile(path := f"{tempfile.mkdtemp()}/millrace-{digest}.zip", "w") as z:
        for name, data in sources.items():
            z.writestr(name, data)
    context.addPyFile(path)
    context._millrace_shipped = True


_HELD: dict = {}


def held(key, make):
    """The one large thing that a worker keeps from task to task; that of another key goes."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def let_go() -> None:
    """Called by tasks that keep nothing."""
    _HELD.clear()
    trim()


@cache
def _malloc_trim() -> Callable[[int], int] | None:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError, TypeError):  # no glibc
        return None


def trim() -> None:
    """Give the system what is free in this process. Its allocators keep it otherwise: a worker that waits for
    its next task would hold the most that any task before took, beside those that work."""
    pa.default_memory_pool().release_unused()
    if (give := _malloc_trim()) is not None:
        give(0)


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow`` as a task that finds nothing kept by others and leaves nothing."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        yield from run(batches)
        trim()

    return task


class Scratch:
    """Parquet tables under a folder of their own; each cuts lineage and survives lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        self.spark = spark
        self.path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table; the shuffle files of this are removed once it is there."""
        before = self.spark.conf.get(CLEAN_UP, "false")
        self.spark.conf.set(CLEAN_UP, "true")
        try:
            df.write.mode("overwrite").parquet(f"{self.path}/{name}")
        finally:
            self.spark.conf.set(CLEAN_UP, before)
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            p.getFileSystem(conf).delete(p, True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def apart(docs: DataFrame, used: list[str], run: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``run`` on a table whose columns other than ``used`` bear names that nothing clashes with; they get
    their own back. ``run`` keeps the columns and their order."""
    columns = docs.columns
    out = run(docs.toDF(*(c if c in used else f"__column_{i}__" for i, c in enumerate(columns))))
    return out.toDF(*columns)
