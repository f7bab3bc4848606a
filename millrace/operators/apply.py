"""Applying the operations of one batch to a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..sources.store import Store
from . import classify, fold


def order_key(pkt_seq: Column, row_no: Column, sub_no: Column) -> Column:
    """One number that orders operations: packet, then row, then half of a split row. A packet has room
    for any row number, and a decimal for any packet."""
    wide = lambda c, by: c.cast("decimal(19,0)") * F.lit(by).cast("decimal(19,0)")
    return (wide(pkt_seq, 1 << 32) + (row_no.cast("long") * 2 + sub_no).cast("decimal(19,0)")).cast("decimal(38,0)")


def mirror(base: DataFrame, folded: DataFrame, keys: list[str], rows: DataFrame) -> DataFrame:
    """``base`` without the keys that a fold touches, and with the fold's new rows."""
    gone = fold.deletes(folded).select(*keys)
    return base.join(gone, keys, "left_anti").unionByName(rows)


def split_full_load(ops: DataFrame, pk: list[str]) -> tuple[DataFrame, DataFrame]:
    """(full-load inserts of keys that nothing else in the batch touches, the rest)."""
    loads = F.coalesce(F.col("full_load") & (F.col("op") == "I"), F.lit(False))
    if not pk:
        return ops.where(loads), ops.where(~loads)
    whole = F.lit(True)
    for c in pk:
        whole = whole & F.col("new")[c].isNotNull()
    loads = loads & whole
    img = classify.key_image(F.col("op"), F.col("old"), F.col("new"), pk)
    touched = ops.where(~loads & img.isNotNull()).select(*[img[c].alias(f"__{c}") for c in pk]).distinct()
    same = [F.col("new")[c] == F.col(f"__{c}") for c in pk]
    return ops.where(loads).join(touched, same, "left_anti"), ops.where(~loads).unionByName(ops.where(loads).join(touched, same, "left_semi"))


def numbered(log: DataFrame, seq: str) -> DataFrame:
    """A column ``n``: a row's place (from 0) by ``seq``. Rows are range-partitioned and counted within
    their partition; the short table of counts puts these together."""
    width = 33  # of a row's place in its partition, in monotonically_increasing_id
    dealt = log.repartitionByRange(seq).sortWithinPartitions(seq).withColumn("__id", F.monotonically_increasing_id()).persist()
    part = F.shiftright("__id", width)
    counts = dealt.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return dealt.join(F.broadcast(counts), part == F.col("__part")).withColumn("n", F.col("__before") + F.col("__id").bitwiseAND((1 << width) - 1)).drop("__id", "__part", "__before")


def apply_batch(store: Store, ops: DataFrame, config: Config, batch_id: str | None = None) -> dict:
    """Write one batch of operations (op, old, new, pkt_seq, row_no, sub_no, full_load) by the table's mode.

    Full-load inserts are one plain append with files sized by the table's width; those whose key
    another operation of the batch touches go with the changes, in order. A batch of more than
    ``slice_rows`` operations is folded slice by slice, and the last slice that does something to a key
    decides. Rows whose key has a null are left out of the mirror, by every way of writing it.
    """
    pk, names = store.pk, store.schema.names
    history = not pk or not config.transaction
    full, rest = split_full_load(ops, [] if history else pk)
    rows_of = classify.history_without_key if not pk else classify.history
    loaded = rows_of(full).select("row.*") if history else full.select("new.*")
    out: dict = {}
    if full.limit(1).count():
        out["full_load"] = store.append(loaded.select(*names), None if batch_id is None else f"{batch_id}/full", full_load=True)
        if not rest.limit(1).count():
            return out | {"kind": "append", "version": out["full_load"]}
    if history:
        return out | {"kind": "append", "version": store.append(rows_of(rest).select("row.*").select(*names), batch_id)}
    img = classify.key_image(F.col("op"), F.col("old"), F.col("new"), pk)
    log = rest.withColumns({"__img": img, "seq": order_key(F.col("pkt_seq"), F.col("row_no"), F.col("sub_no"))}).where("__img is not null")
    log = log.select("seq", "op", "new", *[F.col("__img")[c].alias(c) for c in pk])
    if rest.count() > config.slice_rows:
        log = numbered(log, "seq")
        folded = fold.folded_slices(fold.slices(log, config.slice_rows, "n"), pk, new="new", strict=config.strict_fold)
    else:
        folded = fold.states(log, pk, strict=config.strict_fold, new="new")
    folded = folded.persist()
    try:
        rows, gone = fold.inserts(folded).select("new.*").select(*names), fold.deletes(folded).select(*pk)
        if config.cow_mode == "batch":
            return out | {"kind": "overwrite", "version": store.copy_on_write(rows, gone, batch_id)}
        return out | {"kind": "row_delta", "version": store.row_delta(rows, gone, batch_id)}
    finally:
        folded.unpersist()
