"""Compaction, de-duplication and expiry of a store's snapshots."""

from __future__ import annotations

import json
import time
from itertools import accumulate, groupby

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..sources.store import BASE_EVERY, Store

SMALL_BYTES, LEAST_FILES, KEEP_HOURS, KEEP_LAST = 128 << 20, 3, 24, 5
#: What one task of a de-duplication sorts: bytes of files or rows, whichever are sooner reached.
DEAL_BYTES, DEAL_ROWS = 16 << 20, 1 << 20


def last_wins(df: DataFrame, pk: list[str], *order: str) -> DataFrame:
    """One row a key: the last by ``order``."""
    last = F.max_by(F.struct(*df.columns), F.struct(*order))  # combined before the shuffle
    return df.groupBy(*[F.col(c).alias(f"__{i}") for i, c in enumerate(pk)]).agg(last.alias("__last")).select("__last.*")


def small_files(files: DataFrame, below: int = SMALL_BYTES, least: int = LEAST_FILES, group: list[str] | None = None) -> DataFrame:
    """The files to merge: those under the threshold, where there are enough of them."""
    few = files.where(F.col("size") < below)
    w = Window.partitionBy(*(group or ["table"]))
    return few.withColumn("__n", F.count("*").over(w)).where(F.col("__n") >= least).drop("__n")


def expired(snapshots: DataFrame, now_ms, hours: int = KEEP_HOURS, keep: int = KEEP_LAST, group: list[str] | None = None) -> DataFrame:
    """Snapshots older than ``hours`` and not among the newest ``keep`` of their table."""
    w = Window.partitionBy(*(group or ["table"])).orderBy(F.desc("version"))
    old = F.col("at_ms") < F.lit(now_ms) - hours * 3_600_000
    return snapshots.withColumn("__n", F.row_number().over(w)).where(old & (F.col("__n") > keep)).drop("__n")


def deduplicate(store: Store) -> int | None:
    """Rewrite the table with one row a key: the one of the highest commit, in it the last one written.
    Rows are dealt out evenly before they are combined, so that no task sorts what a whole file, or a hot
    key, has."""

    def plan():
        live = store.live()
        data = [a for a in live if a["kind"] == "data"]
        found = sorted((a["seq"], f, n) for a in data for f, n in store._files(a["folder"]) if f not in a.get("without", ()))
        tasks = max(store.spark.sparkContext.defaultParallelism, -(-sum(n for *_, n in found) // DEAL_BYTES), -(-sum(a.get("rows") or 0 for a in data) // DEAL_ROWS))
        rows = store._rows(numbers={f: i for i, (_, f, _) in enumerate(found)}).select(*store.schema.names, "__nr", "__row")
        new = store._write(last_wins(rows.repartition(tasks, "__nr", "__row"), store.pk, "__nr", "__row").select(*store.schema.names), "data")
        return [(new, "data")], [a["folder"] for a in live]

    return store.commit("replace", plan)


def merge_small(store: Store, below: int = SMALL_BYTES, least: int = LEAST_FILES) -> int | None:
    """Merge the small files, their rows alone, with deletes applied, into files of about ``below`` bytes,
    each of one partition and of neighbours by commit. They are read by as many tasks as they ask for; a task that
    writes a file only passes its rows on. Equality deletes that then precede all live data are dropped."""
    found = small_files(store.files().withColumn("table", F.lit("")), below, least).select("path", "size").collect()  # one row a small file
    if not found:
        return None
    size = {r["path"]: r["size"] for r in found}

    def plan():
        live = store.live()
        there = {f: (f.split("/")[2:-1], a["seq"], f) for a in live if a["kind"] == "data" for f, _ in store._files(a["folder"]) if f not in a.get("without", ())}
        some = sorted(there.keys() & size.keys(), key=there.get)
        numbers, merged = {}, 0
        for _, group in groupby(some, key=lambda f: there[f][0]):  # a task writes rows of one partition
            own = list(group)
            total = sum(size[f] for f in own)
            into = max(1, total // below)
            numbers |= {f: merged + before * into // total for f, before in zip(own, accumulate((size[f] for f in own), initial=0))}
            merged += into
        rows = store._rows(files=some, numbers=numbers).repartitionById(max(1, merged), "__nr")
        new = store._write(rows.select(*store.schema.names), "data")
        left = [a["seq"] for a in live if a["kind"] == "data" and any(f not in size for f, _ in store._files(a["folder"]) if f not in a.get("without", ()))]
        return [(new, "data")], some + [a["folder"] for a in live if a["kind"] == "delete" and a["seq"] <= min(left, default=a["seq"])]

    return store.commit("replace", plan)


def expire(store: Store, now_ms: int | None = None, hours: int = KEEP_HOURS, keep: int = KEEP_LAST) -> list[int]:
    """Prune old snapshots: what they left live goes into a base at the oldest that stays; folders that no
    snapshot has any more are deleted. Gives the pruned versions. Where it is lost midway, the base
    already stands for what it prunes, and the next expiry deletes what this one left."""
    now_ms = int(time.time() * 1000) if now_ms is None else now_ms
    all_ = store.snapshots()
    if not all_:
        return []
    rows = store.spark.createDataFrame([("", s.version, s.at_ms) for s in all_], "`table` string, version long, at_ms long")
    out = sorted(r["version"] for r in expired(rows, now_ms, hours, keep).select("version").collect())
    if out:
        store.put_base(next(s.version for s in all_ if s.version > out[-1]))
    sweep(store)
    return out


def sweep(store: Store) -> None:
    """Delete log entries that a base stands for, and the folders that only these have."""
    base = next((s.version for s in store.snapshots()), 0)
    names = [s.getPath().getName() for s in store.fs.listStatus(store._Path(f"{store.path}/log"))]
    old = [n for n in names if n.endswith(".json") and (int(n[:12]) < base or (int(n[:12]) == base and f"{base:012d}.base.json" in names and not n.endswith(".base.json")))]
    seen = {a["folder"] for n in old for a in json.loads(store._read_file(f"log/{n}"))["added"]}
    kept = {a["folder"] for s in store.snapshots() for a in s.added}
    for folder in seen - kept:
        store.fs.delete(store._Path(f"{store.path}/{folder}"), True)
    for n in old:
        store.fs.delete(store._Path(f"{store.path}/log/{n}"), False)


def compact(store: Store, config: Config, now_ms: int | None = None) -> dict:
    """The compaction of one table, as its settings ask: old snapshots go, one row a key stays (or, without
    that, small files are merged), and the log gets a base."""
    out: dict = {"expired": expire(store, now_ms)}
    if config.compact_dedup and store.pk:
        out["deduplicated"] = deduplicate(store)
    elif config.compact_small_files:
        out["merged"] = merge_small(store, config.compact_file_bytes)
    if len(store.snapshots()) > BASE_EVERY:
        store.put_base(store.snapshots()[-KEEP_LAST].version)
    return out
