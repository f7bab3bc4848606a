import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from millrace.config import Config
from millrace.functions.types import ColumnSpec, TableSpec
from millrace.operators import maintain, metrics
from millrace.sources.dictionary import Dictionary
from millrace.sources.store import Conflict, Store
from millrace.sources.validate import validate
from millrace.streaming.stream import Engine, packets

SCHEMA = StructType([StructField("id", LongType()), StructField("v", StringType())])


def rows(store, version=None):
    return sorted(map(tuple, store.read(version).collect()))


def frame(spark, *r):
    return spark.createDataFrame(list(r), SCHEMA)


@pytest.fixture
def store(spark, tmp_path):
    s = Store(spark, str(tmp_path / "t"))
    s.create(SCHEMA, ["id"])
    return s


def test_append_delta_and_time_travel(spark, store):
    assert rows(store) == []
    store.append(frame(spark, (1, "a"), (2, "b")))
    store.row_delta(frame(spark, (2, "B"), (3, "c")), frame(spark, (2, None), (1, None), (None, "x")))
    assert rows(store) == [(2, "B"), (3, "c")] and rows(store, 1) == [(1, "a"), (2, "b")]


def test_copy_on_write_applies_deletes_and_spares_other_folders(spark, store):
    store.append(frame(spark, (1, "a")))
    store.append(frame(spark, (2, "b"), (3, "c")))
    store.row_delta(frame(spark, (9, "z")), frame(spark, (3, None)))
    first = store.live()[0]["folder"]
    store.copy_on_write(frame(spark, (2, "B")), frame(spark, (2, None)))
    assert rows(store) == [(1, "a"), (2, "B"), (9, "z")] and first in {a["folder"] for a in store.live()}


def test_a_batch_counts_once_and_conflicts_are_tried_again(spark, store):
    assert store.append(frame(spark, (1, "a")), "b1") == 1
    assert store.append(frame(spark, (1, "a")), "b1") is None
    real, lost = store._create_file, []

    def once(name, text):
        if not lost:
            lost.append(name)
            raise Conflict(name)
        return real(name, text)

    store._create_file = once
    assert store.append(frame(spark, (2, "b"))) == 2 and rows(store) == [(1, "a"), (2, "b")]


def test_files_without_a_commit_stay_unseen(spark, store):
    store._write(frame(spark, (7, "lost")), "data")
    assert rows(store) == []


def test_maintenance_keeps_the_rows(spark, store):
    for i in range(4):
        store.append(frame(spark, (i, "a"), (100, str(i))))
    store.row_delta(frame(spark, (0, "new")), frame(spark, (0, None)))
    before = rows(store)
    maintain.merge_small(store)
    assert rows(store) == before and store.files().count() == 1
    maintain.deduplicate(store)
    assert [k for k, _ in rows(store)] == [0, 1, 2, 3, 100]
    now = rows(store)
    gone = maintain.expire(store, now_ms=10**15, keep=2)
    assert gone == [1, 2, 3, 4, 5] and rows(store) == now


def test_a_task_of_compaction_has_a_share_of_a_file_or_hot_key(spark, store, monkeypatch):
    hot = spark.range(6000).selectExpr("if(id % 2 = 0, 0, id) as id", "concat('v', id) as v").coalesce(1)
    store.append(hot)
    monkeypatch.setattr(maintain, "DEAL_ROWS", 500, raising=False)
    given, real = [], maintain.last_wins
    monkeypatch.setattr(maintain, "last_wins", lambda df, *a: given.append(df) or real(df, *a))
    maintain.deduplicate(store)
    shares = [r["count"] for r in given[0].groupBy(F.spark_partition_id()).count().collect()]
    assert sum(shares) == 6000 and max(shares) < 1000 and "__file" not in given[0].columns
    assert rows(store)[0] == (0, "v5998") and len(rows(store)) == 3001


def test_a_merge_reads_side_by_side(spark, store, monkeypatch):
    for i in range(8):
        store.append(frame(spark, (i, "a"), (i + 100, "b")))
    store.row_delta(frame(spark, (0, "new")), frame(spark, (0, None)))
    before, plans, real = rows(store), [], store._write
    monkeypatch.setattr(store, "_write", lambda df, *a, **k: plans.append((df.coalesce(k["files"]) if k.get("files") else df)._jdf.queryExecution().executedPlan().toString()) or real(df, *a, **k))
    maintain.merge_small(store)
    assert rows(store) == before and store.files().count() == 1
    assert "Coalesce" not in plans[0] and "REPARTITION_BY_NUM" in plans[0]


def test_merge_and_deduplication_find_files_of_odd_names(spark, tmp_path):
    odd = ["a b", "x:y%", "é+", "%20", None]
    s = Store(spark, str(tmp_path / "odd"))
    s.create(SCHEMA, ["id"], "v")
    for i in range(4):
        s.append(frame(spark, *[(10 * i + k, v) for k, v in enumerate(odd)]))
    s.append(frame(spark, (0, "later")))
    before = rows_of(s)
    maintain.merge_small(s, below=sum(r["size"] for r in s.files().collect()) // 3)
    assert rows_of(s) == before and s.files().count() == 6  # one a value
    s.append(frame(spark, (0, "last")))
    maintain.deduplicate(s)
    assert len(rows_of(s)) == 20 and ("0", "last") in rows_of(s)


def rows_of(store):
    return sorted((str(r.id), str(r.v)) for r in store.read().collect())


def test_partitions(spark, tmp_path):
    s = Store(spark, str(tmp_path / "p"))
    s.create(SCHEMA, ["id"], "v")
    s.append(frame(spark, (1, "a"), (2, "b")))
    s.row_delta(frame(spark, (1, "b")), frame(spark, (1, None)))  # the row moves to another partition
    assert rows(s) == [(1, "b"), (2, "b")]


def test_apply_log_and_validation(spark, store, tmp_path):
    store.append(frame(spark, (1, "a"), (2, "b")))
    store.row_delta(frame(spark, (3, "c")), frame(spark, (1, None)))
    log = store.applied()
    assert [(r.kind, r.rows) for r in log.orderBy("version").collect()] == [("append", 2), ("row_delta", 1)]
    assert metrics.rows_per_table(log).first().rows == 3 and metrics.last_write(log).count() == 1
    validate(spark, str(tmp_path))
    assert not list((tmp_path / "_validation").glob("*"))


def test_config():
    assert Config.of({"write_mode": "transaction", "trigger_seconds": "7"}).trigger_seconds == 7
    for bad in ({"write_mode": "x"}, {"nope": "1"}, {"trigger_seconds": "0"}):
        with pytest.raises(ValueError):
            Config.of(bad)


def packet(seq, table, op, *changes):
    cells = lambda img, flag: [{"name": k, "value": None if v is None else str(v), "cflag": flag} for k, v in (img or {}).items()]
    return {"pkt_seq": seq, "owner": "App", "table": table, "op_type": op, "rows": [{"row_no": i, "cols": cells(o, 1) + cells(n, 0)} for i, (o, n) in enumerate(changes)]}


@pytest.mark.parametrize("cow", ["none", "batch"])
def test_stream_equals_replay(spark, tmp_path, cow):
    rng = random.Random(3)
    d = Dictionary(spark, str(tmp_path / "dict"))
    d.put(TableSpec("App", "T", [ColumnSpec("ID", 2, 1, "18", "0", 1100), ColumnSpec("V", 1, 2)], [1]))
    live, seq, folder = {}, 0, tmp_path / "in"
    folder.mkdir()
    for batch in range(3):
        lines = []
        for _ in range(12):
            k = rng.randrange(6)
            old = {"ID": k, "V": live[k]} if k in live else None
            if old is None:
                live[k] = f"v{seq}"
                lines.append(packet(seq, "T", "i" if seq % 5 == 0 else "I", (None, {"ID": k, "V": live[k]})))
            elif rng.random() < 0.3:
                del live[k]
                lines.append(packet(seq, "t", "D", (old, None)))
            else:
                to = k if rng.random() < 0.7 or 9 in live else 9
                live.pop(k)
                live[to] = f"v{seq}"
                lines.append(packet(seq, "T", "U", (old, {"ID": to, "V": live[to]})))
            seq += 1
        lines.append(packet(seq, "Other", "I", (None, {"ID": 1})))
        seq += 1
        (folder / f"{batch}.json").write_text("\n".join(map(json.dumps, lines)))
        os.utime(folder / f"{batch}.json", (1_700_000_000 + batch, 1_700_000_000 + batch))  # files are taken by age
    config = Config(write_mode="transaction", cow_mode=cow, max_files_per_trigger=1, strict_fold=True)
    engine = Engine(spark, str(tmp_path / "lake"), d, config)
    q = engine.start(packets(spark, str(folder), config), str(tmp_path / "cp"), once=True)
    q.awaitTermination(120)
    store = Store(spark, str(tmp_path / "lake/app/t"))
    assert {int(r.id): r.v for r in store.read().collect()} == live
    assert spark.read.json(str(tmp_path / "lake/_dead_letters")).count() == 3
    version = store.version()
    batch = spark.read.schema("pkt_seq long, owner string, table string, op_type string, rows array<struct<row_no: int, cols: array<struct<name: string, value: string, cflag: int>>>>").json(str(folder / "0.json"))
    engine.apply(batch, 0)  # a replayed batch changes nothing
    assert store.version() == version


def test_trajectory_and_tables_without_key(spark, tmp_path):
    d = Dictionary(spark, str(tmp_path / "dict"))
    for name, pk in (("A", [1]), ("B", [])):
        d.put(TableSpec("App", name, [ColumnSpec("ID", 2, 1, "18", "0", 1100), ColumnSpec("V", 1, 2)], pk))
    o, n = {"ID": 1, "V": "a"}, {"ID": 1, "V": "b"}
    lines = [packet(i, t, op, c) for i, (t, op, c) in enumerate((t, op, c) for t in "AB" for op, c in (("I", (None, o)), ("U", (o, n)), ("D", (n, None))))]
    (tmp_path / "x.json").write_text("\n".join(map(json.dumps, lines)))
    engine = Engine(spark, str(tmp_path / "lake"), d, Config())
    engine.apply(spark.read.schema("pkt_seq long, owner string, table string, op_type string, rows array<struct<row_no: int, cols: array<struct<name: string, value: string, cflag: int>>>>").json(str(tmp_path / "x.json")), 1)
    for t in "ab":
        assert sorted(r.v for r in Store(spark, str(tmp_path / f"lake/app/{t}")).read().collect()) == ["a", "a", "b", "b"]
