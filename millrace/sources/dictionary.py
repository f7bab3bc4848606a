"""The dictionary of tables: target definitions, and source definitions under ``<key>_source``."""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.types import ColumnSpec, TableSpec, schema_of, type_name
from .store import Store

SCHEMA = "key string, owner string, table string, pk_column_no array<int>, columns array<struct<name: string, column_type: int, column_no: int, length: string, precision: string, number_type: int, source_type: int, added: boolean, comment: string>>"


def merged(target: DataFrame, source: DataFrame) -> DataFrame:
    """Target columns (key, name, ...) with the source's type of the same table and column, where it has one."""
    s = source.select("key", "name", F.col("source_type").alias("__s"))
    return target.join(s, ["key", "name"], "left").withColumn("source_type", F.coalesce("__s", "source_type")).drop("__s")


class Dictionary:
    """Definitions as rows of a Parquet table; the last written of a key counts."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def put(self, spec: TableSpec, source: bool = False) -> None:
        key = f"{spec.key}_source" if source else spec.key
        row = (key, spec.owner, spec.table, list(spec.pk_column_no), [asdict(c) for c in spec.columns])
        new = self.spark.createDataFrame([row], SCHEMA).withColumn("at", F.expr("unix_micros(current_timestamp())"))
        new.coalesce(1).write.mode("append").parquet(self.path)

    def rows(self) -> DataFrame:
        every = self.spark.read.schema(SCHEMA + ", at long").parquet(self.path)
        return every.groupBy("key").agg(F.max_by(F.struct("owner", "table", "pk_column_no", "columns"), "at").alias("d")).select("key", "d.*")

    def tables(self) -> DataFrame:
        """Target tables alone."""
        return self.rows().where(~F.col("key").endswith("_source"))

    def get(self, key: str) -> TableSpec:
        """A table's definition with the types of its source merged in."""
        found = {r["key"]: r for r in self.rows().where(F.col("key").isin(key, f"{key}_source")).collect()}
        t = found[key]
        source = {c["name"].lower(): c["source_type"] for c in (found[f"{key}_source"]["columns"] if f"{key}_source" in found else [])}
        columns = [ColumnSpec(**{**c.asDict(), "source_type": source.get(c["name"].lower(), c["source_type"])}) for c in t["columns"]]
        return TableSpec(t["owner"], t["table"], columns, list(t["pk_column_no"]))


def open_table(spark: SparkSession, root: str, spec: TableSpec, transaction: bool, partition_col: str | None = None, recreate: bool = False) -> tuple[Store, dict[str, str]]:
    """The table's store, made if there is none (an existing one keeps its schema), and its columns' type names."""
    store = Store(spark, f"{root.rstrip('/')}/{spec.owner.lower()}/{spec.table.lower()}")
    store.create(schema_of(spec, transaction, partition_col), spec.pk, partition_col, recreate)
    return store, {c.name.lower(): type_name(c) for c in spec.columns}
