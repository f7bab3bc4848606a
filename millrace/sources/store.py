"""A table as Parquet files under a snapshot log.

``data/`` and ``delete/`` hold the files of each commit in a folder of its own; ``log/<version>.json``
says which commit folders were added, and which folders or single files removed. An entry is written
under a name of its own and then published as a whole, unless another writer was first: then the log is
read again and the commit tried once more, at most ``ATTEMPTS`` times. A batch id is stored with its
commit, and a batch that is there already is skipped, so that replays change nothing. Readers drop the
data rows whose key an equality delete of a higher commit has.

``log/<version>.base.json`` stands for all entries up to its version: the state that they left. Whatever
moment a writer, an expiry or a base is lost in, readers find a whole log. Entries never change, so
a store reads each of them once.
"""

from __future__ import annotations

import contextlib
import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ATTEMPTS, CONFLICT_SECONDS, OTHER_SECONDS = 3, 0.2, 0.5
#: Commit folders whose numbers, and rows of delete files, that are sent to all executors; more are joined by key.
BROADCAST_FOLDERS, BROADCAST_KEYS = 100_000, 500_000
#: Commits after which the state is published in one file.
BASE_EVERY = 50


class Conflict(Exception):
    """Another writer made this version."""


def writer_options(columns: int, full_load: bool = False) -> dict[str, int]:
    """Rows a file and sizes of row groups and pages, by the table's width."""
    mib = 1 << 20
    if full_load:
        rows, group, page = (10_000, 8 * mib, 128 << 10) if columns > 300 else (30_000, 16 * mib, 256 << 10) if columns > 100 else (80_000, 64 * mib, 512 << 10)
        return {"maxRecordsPerFile": rows, "parquet.block.size": group, "parquet.page.size": page}
    return {"parquet.block.size": 32 * mib, "parquet.page.size": 512 << 10} if columns > 100 else {"parquet.block.size": 128 * mib, "parquet.page.size": mib}


@dataclass
class Snapshot:
    version: int
    kind: str
    at_ms: int
    added: list[dict]
    removed: list[str]
    batch_id: str | None = None
    rows: dict | None = None


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self.fs = self._Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        #: Rows of each folder written here, counted while they were written.
        self.counts: dict[str, int] = {}
        self._entries: dict[str, Snapshot] = {}

    # -- the log
    def create(self, schema: StructType, pk: list[str], partition_col: str | None = None, recreate: bool = False) -> None:
        """Create the table, or take the one that is there as it is; ``recreate`` drops it first."""
        if recreate:
            self.fs.delete(self._Path(self.path), True)
            self._entries.clear()
        if not self.exists():
            if partition_col and partition_col not in schema.names:
                partition_col = None
            if missing := [c for c in pk if c not in schema.names]:
                raise ValueError(f"key columns that the table lacks: {', '.join(missing)}")
            self._create_file("table.json", json.dumps({"schema": json.loads(schema.json()), "pk": pk, "partition": partition_col}))

    def exists(self) -> bool:
        return self.fs.exists(self._Path(f"{self.path}/table.json"))

    def meta(self) -> dict:
        return json.loads(self._read_file("table.json"))

    @property
    def schema(self) -> StructType:
        return StructType.fromJson(self.meta()["schema"])

    @property
    def pk(self) -> list[str]:
        return self.meta()["pk"]

    def _create_file(self, name: str, text: str) -> None:
        """Publish a file as a whole, or not at all where there is one of this name."""
        target, tmp = self._Path(f"{self.path}/{name}"), self._Path(f"{self.path}/_tmp/{uuid.uuid4().hex}")
        out = self.fs.create(tmp, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        try:
            self._publish(tmp, target)
        finally:
            self.fs.delete(tmp, False)

    def _publish(self, tmp, target) -> None:
        """Give a written file its name, in one step and never over another."""
        jvm = self.spark._jvm
        self.fs.mkdirs(target.getParent())
        try:
            if self.fs.getUri().getScheme() == "file":  # a local rename would replace; a link doesn't
                at = lambda p: jvm.java.nio.file.Paths.get(p.toUri().getPath(), self.spark._sc._gateway.new_array(jvm.java.lang.String, 0))
                jvm.java.nio.file.Files.createLink(at(target), at(tmp))
            else:
                context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.spark._jsc.hadoopConfiguration())
                none = self.spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
                none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
                context.rename(tmp, target, none)
        except Exception as e:
            if self.fs.exists(target):
                raise Conflict(target.getName()) from e
            raise

    def _read_file(self, name: str) -> str:
        stream = self.fs.open(self._Path(f"{self.path}/{name}"))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def snapshots(self) -> list[Snapshot]:
        """All snapshots in order, from the latest base on. What a base has pruned is part of it."""
        p = self._Path(f"{self.path}/log")
        if not self.fs.exists(p):
            return []
        names = sorted(s.getPath().getName() for s in self.fs.listStatus(p) if s.getPath().getName().endswith(".json"))
        bases = [n for n in names if n.endswith(".base.json")]
        first = bases[-1][:12] if bases else ""
        names = bases[-1:] + [n for n in names if not n.endswith(".base.json") and n[:12] > first]
        for n in names:
            if n not in self._entries:
                self._entries[n] = Snapshot(**json.loads(self._read_file(f"log/{n}")))
        return [self._entries[n] for n in names]

    def version(self) -> int:
        s = self.snapshots()
        return s[-1].version if s else 0

    def live(self, version: int | None = None) -> list[dict]:
        """Added folders that are live at a version: {"folder", "kind": data or delete, "seq", "without":
        files of it that are removed}."""
        out: dict[str, dict] = {}
        for s in self.snapshots():
            if version is None or s.version <= version:
                for f in s.removed:
                    folder = "/".join(f.split("/")[:2])
                    if f == folder:
                        out.pop(f, None)
                    elif folder in out:
                        out[folder] = out[folder] | {"without": [*out[folder].get("without", []), f]}
                out |= {a["folder"]: a for a in s.added}
        return list(out.values())

    def put_base(self, version: int | None = None) -> None:
        """Publish the state up to a version (the newest) in one file, so that readers need no older entry."""
        s = [x for x in self.snapshots() if version is None or x.version <= version]
        if s:
            with contextlib.suppress(Conflict):
                self._create_file(f"log/{s[-1].version:012d}.base.json", json.dumps({**s[-1].__dict__, "added": self.live(s[-1].version), "removed": []}))

    # -- writing
    def _write(self, df: DataFrame, kind: str, full_load: bool = False) -> str:
        folder = f"{kind}/{uuid.uuid4().hex}"
        partition = self.meta()["partition"]
        seen = Observation()
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        if partition and kind == "data" and partition in df.columns:
            df = df.withColumn("__partition", F.col(partition))  # files keep the column, so that all folders are one scan
        w = df.write.options(**writer_options(len(df.columns), full_load)).option("compression", "snappy")
        if partition and kind == "data" and partition in df.columns:
            w = w.partitionBy("__partition")
        w.parquet(f"{self.path}/{folder}")
        self.counts[folder] = seen.get["rows"]
        return folder

    def commit(self, kind: str, plan: Callable[[], tuple[list[tuple[str, str]], list[str]]], batch_id: str | None = None, rows: dict | None = None) -> int | None:
        """``plan`` gives (added (folder, kind) pairs, removed folders) for the newest version; it is made
        anew after a conflict. Gives the version, or None if this batch was there already."""
        for attempt in range(1, ATTEMPTS + 1):
            snapshots = self.snapshots()
            if batch_id is not None and any(s.batch_id == batch_id for s in snapshots):
                return None
            version = (snapshots[-1].version if snapshots else 0) + 1
            added, removed = plan()
            entry = {"version": version, "kind": kind, "at_ms": int(time.time() * 1000), "added": [{"folder": f, "kind": k, "seq": version, "rows": self.counts.get(f)} for f, k in added], "removed": removed, "batch_id": batch_id, "rows": rows}
            try:
                self._create_file(f"log/{version:012d}.json", json.dumps(entry))
            except Conflict:
                if attempt == ATTEMPTS:
                    raise
                time.sleep(CONFLICT_SECONDS * attempt)
                continue
            except ValueError:
                raise
            except Exception:
                if attempt == ATTEMPTS:
                    raise
                time.sleep(OTHER_SECONDS * attempt)
                continue
            return version
        return None

    def append(self, df: DataFrame, batch_id: str | None = None, full_load: bool = False) -> int | None:
        folder = self._write(df, "data", full_load)
        return self.commit("append", lambda: ([(folder, "data")], []), batch_id)

    def row_delta(self, inserts: DataFrame, deletes: DataFrame, batch_id: str | None = None) -> int | None:
        """New rows and equality deletes in one snapshot; deletes without a whole key are left out."""
        ready = deletes.select(*self.pk)
        for c in self.pk:
            ready = ready.where(F.col(c).isNotNull() & (F.col(c).cast("string") != ""))
        gone, data = self._write(ready.distinct(), "delete"), self._write(inserts, "data")
        return self.commit("row_delta", lambda: ([(data, "data"), (gone, "delete")], []), batch_id)

    def copy_on_write(self, inserts: DataFrame, affected: DataFrame, batch_id: str | None = None) -> int | None:
        """Rewrite the files that hold an affected key; others stay."""

        def plan() -> tuple[list[tuple[str, str]], list[str]]:
            keys = affected.select(*self.pk).distinct()
            hit = self.hit_files(keys)
            rows = inserts.select(*self.schema.names)
            if hit:
                rows = self._rows(files=hit).join(keys, self.pk, "left_anti").select(*self.schema.names).unionByName(rows)
            return [(self._write(rows, "data"), "data")], hit

        return self.commit("overwrite", plan, batch_id)

    def hit_files(self, keys: DataFrame) -> list[str]:
        """Live data files that hold one of the keys: one row a file comes to the driver."""
        return sorted(r["__file"] for r in self._rows().join(keys, self.pk, "left_semi").select("__file").distinct().collect())

    # -- reading
    def _paths(self, live: list[dict]) -> list[str]:
        """What to read of live folders: the folder, or its files but for those removed."""
        out = []
        for a in live:
            gone = {*a.get("without", ())}
            out += [f"{self.path}/{f}" for f, _ in self._files(a["folder"]) if f not in gone] if gone else [f"{self.path}/{a['folder']}"]
        return out

    def _files(self, folder: str) -> list[tuple[str, int]]:
        """Parquet files of a folder, by their name below the table, and their sizes."""
        out, it = [], self.fs.listFiles(self._Path(f"{self.path}/{folder}"), True)
        while it.hasNext():
            s = it.next()
            if (name := s.getPath().getName()).endswith(".parquet") and name[0] not in "._":
                out.append((f"{folder}/" + s.getPath().toString().split(f"/{folder}/", 1)[1], s.getLen()))
        return out

    def _tagged(self, live: list[dict], schema: StructType, seq: str, paths: list[str] | None = None) -> DataFrame:
        """Rows of live folders with their file, their place in it and their commit, in one scan."""
        wanted = self._paths(live) if paths is None else paths
        if not wanted:
            empty = self.spark.createDataFrame([], schema)
            return empty.withColumns({"__folder": F.lit(""), "__file": F.lit(""), "__row": F.lit(0).cast("long"), seq: F.lit(0).cast("long")})
        df = self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*wanted)
        place = F.regexp_extract("_metadata.file_path", r"((?:data|delete)/[0-9a-f]{32}/.*)$", 1)
        df = df.select(*schema.names, place.alias("__file"), F.col("_metadata.row_index").alias("__row"))
        df = df.withColumn("__folder", F.substring_index("__file", "/", 2))
        seqs = self.spark.createDataFrame([(a["folder"], a["seq"]) for a in live], f"__of string, {seq} long")
        seqs = F.broadcast(seqs) if len(live) <= BROADCAST_FOLDERS else seqs
        return df.join(seqs, F.col("__folder") == F.col("__of")).drop("__of")

    def _data(self, version: int | None = None, files: list[str] | None = None) -> DataFrame:
        """Raw rows with the folder and file that they are in, their place in it, and their seq."""
        live = [a for a in self.live(version) if a["kind"] == "data"]
        return self._tagged(live, self.schema, "__seq", None if files is None else [f"{self.path}/{f}" for f in files])

    def _numbered(self, data: DataFrame, numbers: dict[str, int]) -> DataFrame:
        """Raw rows with their file's number ``__nr`` in place of the names of folder and file, which are
        most of a row's bytes where it is sorted or sent."""
        uri = lambda f: self._Path(f).toUri().toString()  # noqa: E731  as _metadata.file_path has it
        of = self.spark.createDataFrame([(uri(f), n) for f, n in numbers.items()], "__of string, __nr int")
        of = F.broadcast(of) if len(numbers) <= BROADCAST_FOLDERS else of
        number = F.coalesce("__nr", F.raise_error(F.concat(F.lit("a file without a number: "), "__file")).cast("int"))
        return data.join(of, F.col("__file") == F.col("__of"), "left").withColumn("__nr", number).drop("__of", "__file", "__folder")

    def _rows(self, version: int | None = None, files: list[str] | None = None, numbers: dict[str, int] | None = None) -> DataFrame:
        """Rows after equality deletes, with folder, file (or its number), place and seq. Deletes that no
        live data folder comes before can't hit a row and aren't read."""
        live = self.live(version)
        oldest = min((a["seq"] for a in live if a["kind"] == "data"), default=0)
        data, gone = self._data(version, files), [a for a in live if a["kind"] == "delete" and a["seq"] > oldest]
        data = data if numbers is None else self._numbered(data, numbers)
        if not gone:
            return data
        keys = self._tagged(gone, StructType([f for f in self.schema if f.name in self.pk]), "__gone")
        last = keys.groupBy(*self.pk).agg(F.max("__gone").alias("__gone"))
        if sum(a.get("rows") or BROADCAST_KEYS for a in gone) <= BROADCAST_KEYS:
            last = F.broadcast(last)
        return data.join(last, self.pk, "left").where("__gone is null or __gone <= __seq").drop("__gone")

    def read(self, version: int | None = None) -> DataFrame:
        """The table, now or as of a version."""
        return self._rows(version).select(*self.schema.names)

    def applied(self) -> DataFrame:
        """The apply log, as ``metrics`` takes it: table, worker, version, kind, at, rows and files of each snapshot."""
        name = ".".join(self.path.split("/")[-2:])
        rows = [(name, 0, s.version, s.kind, s.at_ms, sum(a.get("rows") or 0 for a in s.added if a["kind"] == "data"), len(s.added)) for s in self.snapshots()]
        df = self.spark.createDataFrame(rows, "`table` string, worker int, version long, kind string, at_ms long, rows long, folders int")
        return df.withColumn("at", F.timestamp_millis("at_ms"))

    def files(self) -> DataFrame:
        """folder, path and size of every live data file."""
        rows = []
        for a in self.live():
            if a["kind"] == "data":
                rows += [(a["folder"], f, n) for f, n in self._files(a["folder"]) if f not in a.get("without", ())]
        return self.spark.createDataFrame(rows, "folder string, path string, size long")
