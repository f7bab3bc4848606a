"""What happens between the steps of a commit, and the engine's events, compaction and reports."""

import json
import threading

import pytest
from pyspark.sql import functions as F
from test_store import SCHEMA, frame, packet, rows

from millrace.config import Config
from millrace.functions.types import ColumnSpec, TableSpec
from millrace.operators import apply, decode, maintain, metrics
from millrace.sources.dictionary import Dictionary
from millrace.sources.store import Conflict, Store
from millrace.streaming.stream import Engine, Heartbeat, packets, run_until_stopped


class Lost(BaseException):
    """The driver is gone."""


@pytest.fixture
def store(spark, tmp_path):
    s = Store(spark, str(tmp_path / "t"))
    s.create(SCHEMA, ["id"])
    return s


def fails_at(store, monkeypatch, name, nth=1):
    """The nth call of a method (of the store, or its file system) loses the driver before it does anything."""
    real, seen = getattr(store, name), []

    def call(*a, **b):
        seen.append(1)
        if len(seen) == nth:
            raise Lost
        return real(*a, **b)

    monkeypatch.setattr(store, name, call)


@pytest.mark.parametrize("step", ["_write", "_create_file", "_publish"])
def test_a_commit_lost_at_any_step_leaves_the_table_whole(spark, store, monkeypatch, step):
    store.append(frame(spark, (1, "a"), (2, "b")))
    with monkeypatch.context() as m, pytest.raises(Lost):
        fails_at(store, m, step)
        store.copy_on_write(frame(spark, (2, "B")), frame(spark, (2, None)))
    again = Store(spark, store.path)
    assert rows(again) == [(1, "a"), (2, "b")]
    again.copy_on_write(frame(spark, (2, "B")), frame(spark, (2, None)))
    assert rows(again) == [(1, "a"), (2, "B")]


def test_an_entry_is_never_replaced(spark, store):
    store.append(frame(spark, (1, "a")))
    with pytest.raises(Conflict):
        store._create_file("log/000000000001.json", "{}")
    assert rows(Store(spark, store.path)) == [(1, "a")]


@pytest.mark.parametrize("step", ["_create_file", "_publish", "_read_file"])
def test_an_expiry_lost_at_any_step_leaves_the_table_whole(spark, store, monkeypatch, step):
    for i in range(4):
        store.append(frame(spark, (i, "a")))
    store.row_delta(frame(spark, (0, "new")), frame(spark, (0, None)))
    before = rows(store)
    with monkeypatch.context() as m, pytest.raises(Lost):
        fails_at(store, m, step)
        maintain.expire(store, now_ms=10**15, keep=2)
    again = Store(spark, store.path)
    assert rows(again) == before
    maintain.expire(again, now_ms=10**15, keep=2)
    assert rows(Store(spark, store.path)) == before and len(again.snapshots()) == 2
    again.append(frame(spark, (7, "x")))
    assert rows(Store(spark, store.path)) == sorted([*before, (7, "x")])


def test_copy_on_write_rewrites_the_hit_files_alone(spark, store):
    store.append(spark.range(1000).selectExpr("id", "'a' as v").repartitionByRange(8, "id"))
    files = {r.path for r in store.files().collect()}
    store.copy_on_write(frame(spark, (5, "new")), frame(spark, (5, None)))
    now = {r.path for r in store.files().collect()}
    assert len(files - now) == 1 and len(files) == 8
    assert store.read().count() == 1000 and store.read().where("v = 'new'").count() == 1
    store.copy_on_write(frame(spark, (5, "newer"), (999, "z")), frame(spark, (5, None), (999, None)))
    assert store.read().count() == 1000 and store.read().where("v = 'newer'").count() == 1 and store.read(1).where("v = 'a'").count() == 1000


def test_a_missing_key_column_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="b"):
        Store(spark, str(tmp_path / "t")).create(SCHEMA, ["id", "b"])


def test_bases_and_retired_deletes(spark, store):
    for i in range(5):
        store.row_delta(frame(spark, (i % 2, str(i))), frame(spark, (i % 2, None)))
    store.put_base()
    assert len(Store(spark, store.path).snapshots()) == 1 and rows(Store(spark, store.path)) == [(0, "4"), (1, "3")]
    maintain.merge_small(store)
    assert [a for a in store.live() if a["kind"] == "delete"] == [] and rows(store) == [(0, "4"), (1, "3")]
    out = maintain.compact(store, Config(compact_dedup=True), now_ms=10**15)
    assert out["deduplicated"] and rows(store) == [(0, "4"), (1, "3")]


def test_the_last_row_of_one_commit_wins(spark, store):
    store.append(frame(spark, (1, "a"), (1, "b"), (2, "x"), (1, "c")).coalesce(1))
    maintain.deduplicate(store)
    assert rows(store) == [(1, "c"), (2, "x")]


def test_order_numbers_don_t_run_into_the_next_packet(spark):
    df = spark.createDataFrame([(0, 2_000_000, 1), (1, 0, 0), (2**40, 5, 0), (2**40, 4, 1)], "pkt_seq long, row_no int, sub_no int")
    got = [r[0] for r in df.select(apply.order_key(F.col("pkt_seq"), F.col("row_no"), F.col("sub_no"))).collect()]
    assert got[0] < got[1] < got[3] < got[2]


def test_numbered_counts_rows_by_their_order(spark):
    df = spark.range(1000).selectExpr("id * 7 % 1000 * 3 as seq").repartition(5)
    assert all(r.n * 3 == r.seq for r in apply.numbered(df, "seq").collect())


def event(seq, kind, table, pk, *columns):
    ddl = {"pk_column_no": pk, "columns": [{"name": n, "column_type": t, "column_no": i + 1, "length": "18", "precision": "0", "number_type": 1100, "source_type": 0, "added": a, "comment": ""} for i, (n, t, a) in enumerate(columns)]}
    return {"pkt_seq": seq, "owner": "App", "table": table, "kind": kind, "ddl": ddl}


def test_events_are_routed(spark, tmp_path):
    d = Dictionary(spark, str(tmp_path / "dict"))
    d.put(TableSpec("App", "Old", [ColumnSpec("ID", 2, 1, "18", "0", 1100)], [1]))
    lines = [event(0, "ddl", "T", [1], ("ID", 2, True), ("V", 1, False)), packet(1, "T", "I", (None, {"ID": 1, "V": "a"}), (None, {"ID": 2, "V": "b"})), {"pkt_seq": 2, "kind": "sql", "owner": "App", "table": "T"}, packet(3, "T", "D", ({"ID": 2}, None)), packet(4, "None", "I", (None, {"ID": 1}))]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/0.json").write_text("\n".join(map(json.dumps, lines)))
    config = Config(write_mode="transaction", strict_fold=True, compact_interval_seconds=1, compact_small_files=True)
    engine, beat = Engine(spark, str(tmp_path / "lake"), d, config), Heartbeat(str(tmp_path / "beat.json"))
    engine.compacted_at -= 10
    spark.streams.addListener(beat)
    q = engine.start(packets(spark, str(tmp_path / "in"), config), str(tmp_path / "cp"))
    stop = threading.Event()
    threading.Timer(0.1, lambda: (q.processAllAvailable(), stop.set())).start()
    run_until_stopped(q, stop)
    spark.streams.removeListener(beat)
    assert not q.isActive
    assert [(int(r.id), r.v) for r in Store(spark, str(tmp_path / "lake/app/t")).read().collect()] == [(1, "a")]
    assert spark.read.text(str(tmp_path / "lake/_dead_letters")).count() == 2
    assert not [c for c in d.get("app.t").columns if c.added]
    document = json.loads(metrics.report(spark, engine.stores, {"app.t": 4}, beat.state))
    assert [t["tableName"] for t in document["tables"]] == ["app.t"] and document["tables"][0]["rowsTotal"] == document["tables"][0]["rowsProcessed"] + 4
    assert document["system"]["heapMaxBytes"] > 0 and "started" in (tmp_path / "beat.json").read_text()
    assert metrics.base_table(F.lit("a.b.3")) is not None


def test_what_fails_again_and_again_goes_to_the_dead_letters(spark, tmp_path, monkeypatch):
    d = Dictionary(spark, str(tmp_path / "dict"))
    d.put(TableSpec("App", "T", [ColumnSpec("ID", 2, 1, "18", "0", 1100)], [1]))
    (tmp_path / "x.json").write_text(json.dumps(packet(0, "T", "I", (None, {"ID": 1}))))
    engine = Engine(spark, str(tmp_path / "lake"), d, Config(attempts_before_dead_letter=2))
    batch = spark.read.schema(decode.EVENT).json(str(tmp_path / "x.json"))
    monkeypatch.setattr(engine, "_apply_table", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        engine.apply(batch, 1)
    assert engine.apply(batch, 1)[0]["kind"] == "dead_letter"
    assert spark.read.text(str(tmp_path / "lake/_dead_letters/batch=1-app.t")).count() == 1


def test_recreate_drops_the_table(spark, tmp_path):
    d = Dictionary(spark, str(tmp_path / "dict"))
    (tmp_path / "x.json").write_text("\n".join(map(json.dumps, [event(0, "ddl", "T", [1], ("ID", 2, False)), packet(1, "T", "I", (None, {"ID": 1}))])))
    engine = Engine(spark, str(tmp_path / "lake"), d, Config(write_mode="transaction", recreate=True))
    for batch_id in (1, 2):
        engine.apply(spark.read.schema(decode.EVENT).json(str(tmp_path / "x.json")), batch_id)
    assert Store(spark, str(tmp_path / "lake/app/t")).read().count() == 1
