"""Folding an ordered log of inserts (I), updates (U) and deletes (D) by key.

States: N nothing, I insert, U update, D delete. An insert and a later delete of one batch cancel out
(N, which leaves the table as it is), unless ``strict``, when they are a delete.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATES = "NIUD"
#: What an operation makes of each of STATES.
STEP = {"I": "IIIU", "U": "UIUU", "D": "DNDD"}


def _apply(op: Column, state: Column) -> Column:
    """The state after an operation; an unknown operation changes nothing."""
    table = F.create_map(*[F.lit(x) for o, to in STEP.items() for pair in zip((o + s for s in STATES), to, strict=True) for x in pair])
    return F.coalesce(F.try_element_at(table, F.concat(op, state)), state)


def _place(state: Column) -> Column:
    """Place of a state in STATES, from 1."""
    return F.when(state == "N", 1).when(state == "I", 2).when(state == "U", 3).otherwise(4)


def states(log: DataFrame, keys: list[str], seq: str = "seq", op: str = "op", runs: int | None = None, strict: bool = False, **last: str) -> DataFrame:
    """keys, state, last_seq, and for each name in ``last`` the value of that column at the last operation.

    The log is range-partitioned by ``seq`` (into ``runs`` partitions, by default as many as shuffles
    have), so that runs hold about as many rows whatever the numbers. Each run is folded where it is
    into the state that it leads to from each of the four; a key's whole log never meets in one list.
    The runs' maps, one row a key and run, then compose. No job runs before the result is asked for.
    """
    dealt = log.repartitionByRange(runs, seq) if runs else log.repartitionByRange(seq)
    dealt = dealt.withColumn("__run", F.spark_partition_id())
    order = lambda c: F.array_sort(F.collect_list(c))
    carried = [F.max_by(c, seq).alias(f"__{n}") for n, c in last.items()]
    parts = dealt.groupBy(*keys, "__run").agg(order(F.struct(F.col(seq).alias("s"), F.col(op).alias("o"))).alias("ops"), F.max(seq).alias("__seq"), *carried)
    ends = F.array(*[F.aggregate("ops", F.lit(s), lambda acc, x: _apply(x["o"], acc)) for s in STATES])
    parts = parts.withColumn("to", ends).drop("ops")
    runs_of = order(F.struct(F.col("__run").alias("r"), F.col("to").alias("to")))
    folded = parts.groupBy(*keys).agg(runs_of.alias("runs"), F.max("__seq").alias("last_seq"), *[F.max_by(f"__{n}", "__seq").alias(n) for n in last])
    state = F.aggregate("runs", F.lit("N"), lambda acc, x: F.element_at(x["to"], _place(acc)))
    if strict:
        state = F.when(state == "N", "D").otherwise(state)
    return folded.select(*keys, state.alias("state"), "last_seq", *last)


def inserts(folded: DataFrame) -> DataFrame:
    return folded.where(F.col("state").isin("I", "U"))


def deletes(folded: DataFrame) -> DataFrame:
    """Keys to delete: an insert also deletes its own key, so that it replaces a row that is there."""
    return folded.where(F.col("state") != "N")


def fast(log: DataFrame, op: str = "op") -> tuple[DataFrame, DataFrame]:
    """Without folding: (rows to insert, rows whose keys to delete)."""
    return log.where(F.col(op).isin("I", "U")), log.where(F.col(op).isin("U", "D"))


def slices(log: DataFrame, size: int, seq: str = "seq") -> DataFrame:
    """A column ``slice`` for a log whose ``seq`` counts its rows from 0."""
    return log.withColumn("slice", F.floor(F.col(seq) / F.lit(size)).cast("long"))


def folded_slices(log: DataFrame, keys: list[str], seq: str = "seq", op: str = "op", strict: bool = False, **last: str) -> DataFrame:
    """Slice by slice, the last slice that does something to a key decides: keys, state and carried values."""
    each = states(log, [*keys, "slice"], seq, op, strict=strict, **last)
    what = F.struct("state", "last_seq", *last)
    done = each.where("state <> 'N'").groupBy(*keys).agg(F.max_by(what, "slice").alias("w"))
    return done.select(*keys, "w.*")
