"""The same operators over a stream of packets, one commit a micro-batch and table."""

from __future__ import annotations

import json
import signal
import threading
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..config import Config
from ..functions.types import ColumnSpec, TableSpec
from ..operators import apply, classify, decode, maintain
from ..sources.dictionary import Dictionary, open_table
from ..sources.store import Store


def packets(spark: SparkSession, folder: str, config: Config) -> DataFrame:
    """Packet files (JSON lines) as they arrive; how many a trigger takes is bounded."""
    reader = spark.readStream.schema(decode.EVENT).option("maxFilesPerTrigger", config.max_files_per_trigger)
    if config.source_cleanup != "off":
        reader = reader.option("cleanSource", config.source_cleanup)
        if config.source_cleanup == "archive":
            reader = reader.option("sourceArchiveDir", f"{folder.rstrip('/')}-archive")
    return reader.json(folder)


class Engine:
    """Applies event batches to the tables of a dictionary, which is read anew for each batch.

    Events are told apart by ``kind``: data packets (data or null) are applied; ``ddl`` and
    ``source_ddl`` define a table or its source and take effect before the data of their batch; SQL
    and any other kind go to the dead letters, as data of unknown tables does.
    """

    def __init__(self, spark: SparkSession, root: str, dictionary: Dictionary, config: Config):
        self.spark, self.root, self.dictionary, self.config = spark, root.rstrip("/"), dictionary, config
        self.stores: dict[str, Store] = {}
        self.compacted_at = time.monotonic()
        self.failed: dict[str, int] = {}

    def route(self, batch: DataFrame) -> dict[str, DataFrame]:
        """data, ddl, source_ddl and other: branches of one batch of events."""
        if "kind" not in batch.columns:
            none = batch.where(F.lit(False))
            return {"data": batch, "ddl": none, "source_ddl": none, "other": none}
        kind = F.coalesce(F.lower("kind"), F.lit("data"))
        data = batch.where(kind == "data").drop("kind", "ddl")
        return {"data": data, "ddl": batch.where(kind == "ddl"), "source_ddl": batch.where(kind == "source_ddl"), "other": batch.where(~kind.isin("data", "ddl", "source_ddl"))}

    def define(self, events: DataFrame, source: bool) -> list[str]:
        """Put the definitions of DDL events into the dictionary, in order; a key column is never an added
        one. With ``recreate``, a target table that is there is dropped and made anew."""
        out = []
        for e in events.where("ddl is not null").orderBy("pkt_seq").collect():  # one row a DDL event
            columns = [ColumnSpec(**c.asDict()) for c in e["ddl"]["columns"]]
            keys = {*(e["ddl"]["pk_column_no"] or ())}
            spec = TableSpec(e["owner"], e["table"], [replace(c, added=bool(c.added) and c.column_no not in keys) for c in columns], sorted(keys))
            self.dictionary.put(spec, source)
            if self.config.recreate and not source:
                open_table(self.spark, self.root, spec, self.config.transaction, self.config.partition_col, recreate=True)
            out.append(spec.key)
        return out

    def apply(self, batch: DataFrame, batch_id: int | str) -> list[dict]:
        """Apply a batch; what belongs to no known table goes to the dead letters, and so does a table's
        data that has failed ``attempts_before_dead_letter`` times. Safe to repeat."""
        batch = batch.persist()
        done = []
        try:
            events = self.route(batch)
            if "kind" in batch.columns:
                self.define(events["source_ddl"], True)
                self.define(events["ddl"], False)
            known, unknown = decode.split_known(events["data"], self.dictionary.tables().select("key"))
            letters = unknown.drop("key").select(F.to_json(F.struct("*")).alias("value")).unionByName(events["other"].select(F.to_json(F.struct("*")).alias("value")))
            letters.write.mode("overwrite").text(f"{self.root}/_dead_letters/batch={batch_id}")
            keys = [row["key"] for row in known.select("key").distinct().orderBy("key").collect()]  # one row a table
            with ThreadPoolExecutor(self.config.tables_at_once) as pool:  # a table's commit is its own
                done = list(pool.map(lambda key: self._attempt(key, known.where(F.col("key") == key), str(batch_id)), keys))
            if time.monotonic() - self.compacted_at >= self.config.compact_interval_seconds:
                self.compact()
        finally:
            batch.unpersist()
        return done

    def _attempt(self, key: str, rows: DataFrame, batch_id: str) -> dict:
        try:
            out = {"table": key, **self._apply_table(key, rows, batch_id)}
            self.failed.pop(key, None)
            return out
        except Exception:
            self.failed[key] = self.failed.get(key, 0) + 1
            if self.failed[key] < self.config.attempts_before_dead_letter:
                raise
            rows.drop("key").select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(f"{self.root}/_dead_letters/batch={batch_id}-{key}")
            self.failed.pop(key, None)
            return {"table": key, "kind": "dead_letter", "version": None}

    def _apply_table(self, key: str, rows: DataFrame, batch_id: str) -> dict:
        spec, config = self.dictionary.get(key), self.config
        store, names = open_table(self.spark, self.root, spec, config.transaction, config.partition_col)
        self.stores[key] = store
        images = decode.decoded(rows.drop("key"), store.schema, names)
        ops = classify.operations(images, store.pk, config.transaction)
        return apply.apply_batch(store, ops, config, batch_id)

    def compact(self) -> dict[str, dict]:
        """Compaction of the tables met so far, as the settings ask."""
        self.compacted_at = time.monotonic()
        return {key: maintain.compact(store, self.config) for key, store in sorted(self.stores.items())}

    def start(self, source: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
        writer = source.writeStream.foreachBatch(lambda df, batch_id: self.apply(df, batch_id) and None).option("checkpointLocation", checkpoint)
        writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{self.config.trigger_seconds} seconds")
        return writer.start()


class Heartbeat(StreamingQueryListener):
    """Writes a JSON line for each start, progress, exception and end of a query; keeps the last of each query."""

    def __init__(self, path: str | None = None):
        self.path, self.state = path, {}

    def _note(self, query: str, **what) -> None:
        self.state[query] = {"at_ms": int(time.time() * 1000), **what}
        if self.path:
            with open(self.path, "a") as f:
                f.write(json.dumps({"query": query, **self.state[query]}) + "\n")

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self._note(str(event.id), state="started")

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self._note(str(p.id), state="running", batch=p.batchId, rows=p.numInputRows, rows_per_second=p.processedRowsPerSecond)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        self._note(str(event.id), state="idle")

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._note(str(event.id), state="failed" if event.exception else "stopped", exception=(event.exception or "")[:500] or None)


def run_until_stopped(query: StreamingQuery, stop: threading.Event | None = None, patience: float = 300) -> None:
    """Wait for a query until ``stop`` is set (by default, by TERM or INT); then let the running batch end,
    for at most ``patience`` seconds, and stop. What wasn't committed is read again at the next start."""
    if stop is None:
        stop = threading.Event()
        for s in (signal.SIGTERM, signal.SIGINT):
            signal.signal(s, lambda *_: stop.set())
    while query.isActive and not stop.wait(0.2):
        pass
    until = time.monotonic() + patience
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < until:
        time.sleep(0.1)
    query.stop()
    if (e := query.exception()) is not None:
        raise e
