"""A smoke test of a place for tables: make one, append a row, read it back, remove it."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .store import Store


def validate(spark: SparkSession, root: str) -> None:
    """Raises where tables can't be made, written or read under ``root``."""
    store = Store(spark, f"{root.rstrip('/')}/_validation/{uuid.uuid4().hex}")
    row = spark.range(1).select(F.uuid().alias("validation_id"), F.current_timestamp().cast("timestamp_ntz").alias("at"))
    try:
        store.create(row.schema, ["validation_id"])
        store.append(row)
        if store.read().count() != 1:
            raise OSError(f"a row written under {root} can't be read back")
    finally:
        store.fs.delete(store._Path(store.path), True)
