"""What a change row does: one expression that yields its operations, then one explode.

With a key in transaction mode rows become I, U and D; otherwise (trajectory mode, or a table without
a key) they become the images to append. ``sub_no`` orders the two halves of a split row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_ready(img: Column, pk: list[str]) -> Column:
    """Whether an image has every key column, neither null nor empty."""
    ready = img.isNotNull()
    for c in pk:
        ready = ready & img[c].isNotNull() & (img[c].cast("string") != "")
    return F.coalesce(ready, F.lit(False))


def delete_image(old: Column, new: Column, pk: list[str]) -> Column:
    """The image to delete by: the old one if it has the key, else the new one if it has, else none."""
    return F.when(key_ready(old, pk), old).when(key_ready(new, pk), new)


def key_image(op: Column, old: Column, new: Column, pk: list[str]) -> Column:
    """The image that says a row's key: deletes prefer the old one, others the new one."""
    first, second = F.when(op == "D", old).otherwise(new), F.when(op == "D", new).otherwise(old)
    return F.when(key_ready(first, pk), first).when(key_ready(second, pk), second)


def same_key(old: Column, new: Column, pk: list[str]) -> Column:
    same = F.lit(True)
    for c in pk:
        same = same & old[c].eqNullSafe(new[c])
    return same


def operations(df: DataFrame, pk: list[str], transaction: bool, op: str = "op", old: str = "old", new: str = "new") -> DataFrame:
    """``df``, a row for each operation: ``op``, ``old`` and ``new`` as that has them, and ``sub_no``."""
    o, n, kind = F.col(old), F.col(new), F.col(op)
    none = F.lit(None).cast(df.schema[new].dataType)
    act = lambda k, a, b, i: F.struct(F.lit(k).alias("op"), a.alias("old"), b.alias("new"), F.lit(i).alias("sub_no"))
    delete, insert = lambda a, i: act("D", a, none, i), lambda b, i: act("I", none, b, i)
    has_o, has_n = o.isNotNull(), n.isNotNull()
    if transaction and pk:
        image = delete_image(o, n, pk)
        made = (
            F.when((kind == "U") & has_o & has_n & same_key(o, n, pk), F.array(act("U", o, n, 0)))
            .when((kind == "U") & has_o & has_n, F.array(delete(o, 0), insert(n, 1)))
            .when((kind == "U") & has_n, F.array(delete(n, 0), insert(n, 1)))
            .when((kind == "U") & has_o, F.array(delete(o, 0)))
            .when(kind == "I", F.array(insert(n, 0)))
            .when((kind == "D") & image.isNotNull(), F.array(delete(image, 0)))
        )
    else:
        image = F.coalesce(delete_image(o, n, pk), o, n) if pk else F.coalesce(o, n)
        made = (
            F.when((kind == "U") & has_o & has_n, F.array(insert(o, 0), insert(n, 1)))
            .when((kind == "U") & has_n, F.array(insert(n, 1)))
            .when((kind == "U") & has_o, F.array(delete(o, 0)))
            .when(kind == "I", F.array(insert(n, 0)))
            .when((kind == "D") & image.isNotNull(), F.array(insert(image, 0)))
        )
    rest = [c for c in df.columns if c not in (op, old, new)]
    return df.withColumn("__a", F.explode(made)).select(*rest, F.col("__a.op").alias(op), F.col("__a.old").alias(old), F.col("__a.new").alias(new), F.col("__a.sub_no").alias("sub_no"))


def history(df: DataFrame, old: str = "old", new: str = "new") -> DataFrame:
    """Rows to append for a table with a key: the new image, else the old one."""
    return df.withColumn("row", F.coalesce(new, old)).where("row is not null")


def history_without_key(df: DataFrame, op: str = "op", old: str = "old", new: str = "new") -> DataFrame:
    """Rows to append for a table without a key: every image there is, the old one of an update first."""
    both = F.when(F.col(op) == "I", F.array(new)).when(F.col(op) == "D", F.array(old)).otherwise(F.array(old, new))
    return df.select("*", F.posexplode(both).alias("image_no", "row")).where("row is not null")
