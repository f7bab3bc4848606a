import random

import pytest

from millrace.operators import fold

STEP = {("N", "I"): "I", ("N", "U"): "U", ("N", "D"): "D", ("I", "I"): "I", ("I", "U"): "I", ("I", "D"): "N", ("U", "I"): "I", ("U", "U"): "U", ("U", "D"): "D", ("D", "I"): "U", ("D", "U"): "U", ("D", "D"): "D"}


def replay(ops):
    s = "N"
    for o in ops:
        s = STEP[s, o]
    return s


@pytest.mark.parametrize("runs", [1, 3, 64])
def test_states_equal_replay(spark, runs):
    rng = random.Random(runs)
    log = [(rng.randrange(12), i, rng.choice("IUD"), float(i)) for i in range(400)] + [(99, 1000 + i, o, 0.0) for i, o in enumerate("IDIUD")]
    got = {r.pk: (r.state, r.v) for r in fold.states(spark.createDataFrame(log, "pk long, seq long, op string, v double"), ["pk"], runs=runs, v="v").collect()}
    keys = {k for k, *_ in log}
    assert got == {k: (replay(o for p, _, o, _ in log if p == k), max((s, v) for p, s, _, v in log if p == k)[1]) for k in keys}


def test_strict_turns_nothing_into_delete(spark):
    log = spark.createDataFrame([(1, 0, "I"), (1, 1, "D")], "pk long, seq long, op string")
    assert [r.state for r in fold.states(log, ["pk"], strict=True).collect()] == ["D"]


def test_empty_log(spark):
    assert fold.states(spark.createDataFrame([], "pk long, seq long, op string"), ["pk"]).count() == 0


def test_null_key_and_composite_key(spark):
    log = spark.createDataFrame([(1, None, 0, "I"), (1, "a", 1, "D"), (1, None, 2, "U")], "a long, b string, seq long, op string")
    assert {(r.a, r.b): r.state for r in fold.states(log, ["a", "b"]).collect()} == {(1, None): "I", (1, "a"): "D"}


def test_one_key_in_all_rows_and_clustered_numbers(spark):
    log = spark.range(20_000).selectExpr("1 as k", "case when id < 19990 then id else 1000000000 * id end as seq", "case id % 3 when 0 then 'I' when 1 then 'U' else 'D' end as op").repartition(7)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building the plan")
    folded = fold.states(log, ["k"], op="op", v="seq")
    assert not tracker.getJobIdsForGroup("building")
    state = "N"
    for i in range(20_000):
        state = dict(zip(fold.STATES, fold.STEP["IUD"[i % 3]], strict=True))[state]
    r = folded.collect()
    assert [(x.state, x.last_seq, x.v) for x in r] == [(state, 19_999 * 1_000_000_000, 19_999 * 1_000_000_000)]
