"""What the two vector searches share: clean vectors, cells of rows and queries, and the final merge.

A cell holds at most about ``CELL_ROWS`` rows and meets a block of at most about ``CELL_QUERIES``
queries; a stated set of queries is held against the rows cell by cell. Vectors that are null or hold
a null or a number that isn't finite take no part. Rows alike in id and vector count once. A query's
own rows, which it doesn't find, are those of its id. Vectors meet only vectors of their own length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELL_ROWS, CELL_QUERIES = 8192, 4096


def clean(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, vec (array of double), dim and key (a hash of id and vector) of the vectors that take part."""
    vec = F.col(vector).cast("array<double>")
    sound = F.coalesce(F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), vec.alias("vec")).where(sound & F.col("vec_id").isNotNull())
    rows = rows.withColumns({"dim": F.size("vec"), "key": F.sha2(F.concat_ws(" ", F.col("vec_id").cast("string"), F.col("vec").cast("array<string>")), 256)})
    return rows.dropDuplicates(["key"])


def spread(key: Column, n: Column) -> Column:
    """A number below n from a hash of the key."""
    return F.pmod(F.xxhash64(key, F.lit(17)), n).cast("int")


def cells_of(count: Column, size: int) -> Column:
    return F.greatest(F.ceil(count / F.lit(size)), F.lit(1)).cast("int")


def best(found: DataFrame, k: int, exact_type: str) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best: high scores first, then small ids."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("score").cast(exact_type).alias("score"))
