"""Counts and times of what has been applied, from a log of (table, worker, at, rows)."""

from __future__ import annotations

import json
import time

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.store import Store


def rows_per_table(log: DataFrame) -> DataFrame:
    return log.groupBy("table").agg(F.sum("rows").cast("long").alias("rows"))


def last_write(log: DataFrame) -> DataFrame:
    return log.groupBy("table").agg(F.max("at").alias("last_write"))


def running_rows(log: DataFrame, order: str) -> DataFrame:
    """Rows of each table and worker so far."""
    w = Window.partitionBy("table", "worker").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return log.withColumn("so_far", F.sum("rows").over(w).cast("long"))


def throughput(samples: DataFrame) -> DataFrame:
    """Rows a second between a table's samples (at_ms, total), not below 0; null at its first."""
    w = Window.partitionBy("table").orderBy("at_ms")
    rows, ms = F.col("total") - F.lag("total").over(w), F.col("at_ms") - F.lag("at_ms").over(w)
    rate = F.when(ms > 0, F.floor(F.greatest(rows, F.lit(0)) * 1000 / ms)).cast("long")
    return samples.withColumn("per_second", rate)


def count_flushes(log: DataFrame, order: str, every: int) -> DataFrame:
    """A column ``flush``: which flush of its table and worker a row is in, one for each ``every`` rows."""
    so_far = running_rows(log, order)
    return so_far.withColumn("flush", F.floor((F.col("so_far") - 1) / F.lit(every)).cast("long"))


def idle_flushes(log: DataFrame, at_ms: str, idle_ms: int, tie: str) -> DataFrame:
    """A column ``flush``: a table's rows up to a gap of more than ``idle_ms`` are one flush."""
    w = Window.partitionBy("table").orderBy(at_ms, tie)
    gap = F.when(F.col(at_ms) - F.lag(at_ms).over(w) > idle_ms, 1).otherwise(0)
    return log.withColumn("__gap", gap).withColumn("flush", F.sum("__gap").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).drop("__gap")


def to_json(per_table: DataFrame) -> DataFrame:
    """One JSON document a table."""
    return per_table.select(F.to_json(F.struct(F.col("table").alias("tableName"), F.col("rows").alias("rowsProcessed"))).alias("json"))


def base_table(key: Column) -> Column:
    """db.table of db.table.worker."""
    return F.substring_index(key, ".", 2)


def report(spark: SparkSession, stores: dict[str, Store], pending: dict[str, int] | None = None, queries: dict | None = None) -> str:
    """One JSON document: the system, the engine's queries, and the tables in the order of their names."""
    runtime = spark._jvm.java.lang.Runtime.getRuntime()
    used, most = runtime.totalMemory() - runtime.freeMemory(), runtime.maxMemory()
    system = {"timestamp": int(time.time() * 1000), "heapUsedBytes": used, "heapMaxBytes": most, "heapUsedPercent": round(100 * used / most, 1), "processors": runtime.availableProcessors()}
    tables = []
    for key, store in sorted(stores.items()):
        s = store.snapshots()
        rows = sum(a.get("rows") or 0 for x in s for a in x.added if a["kind"] == "data")
        waiting = (pending or {}).get(key, 0)
        rate = None
        if len(s) > 1 and s[-1].at_ms > s[-2].at_ms:
            rate = sum(a.get("rows") or 0 for a in s[-1].added if a["kind"] == "data") * 1000 // (s[-1].at_ms - s[-2].at_ms)
        tables.append({"tableName": key, "rowsProcessed": rows, "rowsPending": waiting, "rowsTotal": rows + waiting, "throughputPerSec": rate, "lastWriteMs": s[-1].at_ms if s else None, "snapshots": len(s), "version": s[-1].version if s else 0})
    return json.dumps({"system": system, "engine": {"queries": queries or {}, "tables": len(tables)}, "tables": tables})
