"""Mixing sources to target weights by systematic sampling.

Targets. A source's size is the number of words in its documents. Sources, in code-point order with
null last, weigh 1, 2, 3, 1, ... and share the total size by weight; no target exceeds ``CAP`` times
its source's size, and the excess is shared again by weight among the rest. The share a unit of weight
gets is found in closed form: with sources in order of the share at which they are full, it is what is
left after the full ones over the weight that is left.

Sampling. Every document of a source is expected target / size times. The expected copies are summed
up over the source's documents in a fixed order, one random offset (from a hash of the source) is
added, and a document is taken once for each integer that the sum crosses at it. As all documents of a
source have the same expectation and stand in order of size, the words taken differ from the target by
little more than the largest document's size. Sums are integers (``FRACTION`` bits after the point), so
that no document is taken more often than its expectation rounded up.

The order is (size, hash of doc_id, doc_id). The running sum is each row's rank, found by a range
partition of narrow rows on (source, order), a count within each partition, and the short table of
counts by partition; a source that holds a third of the rows is spread like any other.

Null text has no words. A source without words gets the target 0. Null doc_ids and repeated rows are
rows like others. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from .tables import Scratch, apart, frugal

CAP, WEIGHTS, FRACTION = 3, 3, 26
_WHITE = " \\t\\n\\x0B\\f\\r"


def n_words(text: Column) -> Column:
    """Number of runs of characters other than space and U+0009..U+000D; 0 for null."""
    trimmed = F.rtrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.coalesce(F.length(F.regexp_replace(trimmed, f"[{_WHITE}]*[^{_WHITE}]+", "x")), F.lit(0)).cast("long")


def _hash32(value: Column) -> Column:
    return F.conv(F.substring(F.md5(value.cast("string")), 1, 8), 16, 10).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size) -> the same with weight and target; one row a source."""
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    w = sizes.withColumn("weight", (F.row_number().over(by_name) - 1) % WEIGHTS + 1)
    #: 6 is divisible by every weight, so this is an integer: the share at which a source is full.
    w = w.withColumn("full_at", F.expr(f"{CAP} * source_size * (6 div weight)"))
    order = Window.orderBy("full_at", F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    w = w.withColumn("total", F.sum("source_size").over(everything)).withColumn("all_weight", F.sum("weight").over(everything))
    w = w.withColumn("filled", F.coalesce(F.sum(F.lit(CAP) * F.col("source_size")).over(before), F.lit(0))).withColumn("gone", F.coalesce(F.sum("weight").over(before), F.lit(0)))
    left, weight = F.col("total") - F.col("filled"), F.col("all_weight") - F.col("gone")
    w = w.withColumn("is_full", left * 6 >= F.col("full_at") * weight).withColumn("share", left.cast("double") / weight.cast("double"))
    share = F.min(F.when(~F.col("is_full"), F.struct("full_at", "gone", "share"))).over(everything)["share"]
    target = F.when(F.col("is_full"), (F.lit(CAP) * F.col("source_size")).cast("double")).otherwise(F.col("weight") * share)
    return w.select("source", "source_size", F.col("weight").cast("int").alias("weight"), target.alias("target"))


@frugal
def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the partition and each row's place (from 1) among its source's rows; rows come sorted."""
    part, source, seen = TaskContext.get().partitionId(), object(), 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = pc.dictionary_encode(batch.column("source"), null_encoding="encode").indices.to_pylist()
        values = pc.unique(batch.column("source")).to_pylist()
        ranks = []
        for k in keys:
            if values[k] != source:
                source, seen = values[k], 0
            seen += 1
            ranks.append(seen)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(ranks), pa.int32()), pa.array(ranks, pa.int64())], names=[*batch.schema.names, "part", "place"])


def decisions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Each row's doc_id, size, source_size, target, copies, taken (= size * copies), and its source."""
    scratch = Scratch(docs.sparkSession, "mixing")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"))
    rows = scratch.keep(rows.withColumn("key", F.md5(F.col("doc_id").cast("string"))), "sizes")
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    #: The last key only splits rows that are alike; it changes no row's result.
    order = [F.col("source").asc_nulls_first(), "size", "key", "doc_id"]
    dealt = rows.repartitionByRange(*order, F.xxhash64("key", F.monotonically_increasing_id())).sortWithinPartitions(*order)
    placed = scratch.keep(dealt.drop("key").mapInArrow(_ranked, dealt.drop("key").schema.add("part", IntegerType()).add("place", LongType())), "placed")
    counts = placed.groupBy("part", "source").agg(F.max("place").alias("n"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    one = 1 << FRACTION
    rate = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * one)).otherwise(0).cast("long")
    offset = F.coalesce(_hash32(F.col("of")), F.lit(1 << 31)) % one
    counts = counts.withColumnRenamed("source", "of")
    table = counts.join(sources, F.col("of").eqNullSafe(F.col("source"))).select("of", F.col("part").alias("in"), "before", "source_size", "target", rate.alias("rate"), offset.alias("offset"))
    table = scratch.keep(table, "table")
    scratch.drop("sizes")
    upto = F.col("before") + F.col("place")
    crossed = lambda k: F.shiftright(k * F.col("rate") + F.col("offset"), FRACTION)
    joined = placed.join(table, (F.col("part") == F.col("in")) & F.col("source").eqNullSafe(F.col("of")))
    copies = (crossed(upto) - crossed(upto - 1)).cast("int")
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies"), "source")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents taken, each as often as the mix takes it, with the columns of ``docs``.

    Rows alike in doc_id, source and size (there are some only where doc_ids repeat) share the copies
    that they have together as evenly as possible.
    """
    d = decisions(docs, doc_id, text, source)
    alike = d.groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("__copies"), F.count("*").alias("__rows")).where("__copies > 0")
    alike = alike.select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__of"), "__copies", "__rows")
    return apart(docs, [doc_id, text, source], lambda d: _taken(d, alike, doc_id, text, source))


def _taken(docs: DataFrame, alike: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    keyed = docs.withColumn("__size", n_words(F.col(text)))
    out = keyed.join(alike, F.col(doc_id).eqNullSafe(F.col("__id")) & F.col(source).eqNullSafe(F.col("__source")) & (F.col("__size") == F.col("__of")))
    one = out.where("__rows = 1").withColumn("__n", F.col("__copies"))
    place = F.row_number().over(Window.partitionBy("__id", "__source", "__of").orderBy(F.xxhash64(text)))
    some = out.where("__rows > 1").withColumn("__n", F.floor(place * F.col("__copies") / F.col("__rows")) - F.floor((place - 1) * F.col("__copies") / F.col("__rows")))
    both = one.unionByName(some).withColumn("__n", F.col("__n").cast("int"))
    return both.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), F.col("__n")))).select(*docs.columns)
