"""Column types of a source dictionary as Spark types."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DecimalType, DoubleType, StringType, StructField, StructType, TimestampNTZType, TimestampType

#: Codes of column types, of source types and of number types in the dictionaries.
CHAR, DATE, TIMESTAMP, TIMESTAMP_TZ, FLOATING, NUMBER = (96,), (12,), (180,), (181, 231), (100, 101), 2
SOURCE_BOOLEAN, SOURCE_DATE, SOURCE_TIME, SOURCE_TEXT = (5018,), (2020, 5014), (2019, 5010), (5011,)
PLAIN, INTEGER, WHOLE, SCALED, FLOAT = 1000, 1100, 1200, 3000, 3100


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    column_type: int
    column_no: int = 0
    length: str | None = None
    precision: str | None = None
    number_type: int = 0
    source_type: int = 0
    added: bool = False
    comment: str | None = None


@dataclass(frozen=True)
class TableSpec:
    """A table of the dictionary."""

    owner: str
    table: str
    columns: list[ColumnSpec]
    pk_column_no: list[int] = field(default_factory=list)

    @property
    def key(self) -> str:
        return f"{self.owner}.{self.table}".lower()

    @property
    def pk(self) -> list[str]:
        return [c.name.lower() for c in self.columns if c.column_no in self.pk_column_no]


def _int(value: str | None, default: int) -> int:
    try:
        return int(str(value).strip())
    except ValueError:
        return default


def number_type(kind: int, length: str | None, precision: str | None) -> str:
    """decimal(p,s) or string; a scale is held between 0 and the precision, which Spark asks for."""
    p = max(_int(length, 38 if kind == FLOAT else 18), 1)
    if kind == PLAIN:
        return "decimal(38,0)"
    if kind == INTEGER:
        return f"decimal({min(p, 38)},0)"
    if kind == WHOLE:
        return "string" if p > 38 else f"decimal({p},0)"
    if kind == SCALED:
        p = min(p, 38)
        return f"decimal({p},{min(max(_int(precision, 0), 0), p)})"
    if kind == FLOAT:
        return "string" if p > 38 else f"decimal({max(p, 10)},10)"
    return "decimal(38,18)"


def type_name(c: ColumnSpec) -> str:
    """The type's simple name, as ``convert.converter`` takes it ("time" is kept as a string column)."""
    if c.column_type in CHAR:
        return "boolean" if c.source_type in SOURCE_BOOLEAN else "string"
    if c.column_type in DATE:
        return "date" if c.source_type in SOURCE_DATE else "timestamp_ntz"
    if c.column_type in TIMESTAMP:
        return "time" if c.source_type in SOURCE_TIME else "string" if c.source_type in SOURCE_TEXT else "timestamp_ntz"
    if c.column_type in TIMESTAMP_TZ:
        return "timestamp"
    if c.column_type in FLOATING:
        return "double"
    if c.column_type == NUMBER:
        return number_type(c.number_type, c.length, c.precision)
    return "string"


def spark_type(name: str):
    if name.startswith("decimal"):
        p, s = name[8:-1].split(",")
        return DecimalType(int(p), int(s))
    return {"boolean": BooleanType(), "date": DateType(), "timestamp_ntz": TimestampNTZType(), "timestamp": TimestampType(), "double": DoubleType()}.get(name, StringType())


def column_order(t: TableSpec, partition_col: str | None = None) -> list[ColumnSpec]:
    """Own columns, then added ones; without a partition column one named busi_date is left out."""
    ordered = [c for c in t.columns if not c.added] + [c for c in t.columns if c.added]
    return [c for c in ordered if partition_col or c.name.lower() != "busi_date"]


def schema_of(t: TableSpec, transaction: bool, partition_col: str | None = None) -> StructType:
    """Key columns are required in transaction mode only."""
    pk = set(t.pk)
    return StructType([StructField(c.name.lower(), spark_type(type_name(c)), not (transaction and c.name.lower() in pk)) for c in column_order(t, partition_col)])


def type_name_column(column_type: Column, source_type: Column, number: Column, length: Column, precision: Column) -> Column:
    """``type_name`` of dictionary rows, as one native expression."""
    p = F.greatest(F.coalesce(F.trim(length).try_cast("int"), F.when(number == FLOAT, 38).otherwise(18)), F.lit(1))
    capped = F.least(p, F.lit(38))
    scale = F.least(F.greatest(F.coalesce(F.trim(precision).try_cast("int"), F.lit(0)), F.lit(0)), capped)
    decimal = lambda a, b: F.concat(F.lit("decimal("), a.cast("string"), F.lit(","), b.cast("string"), F.lit(")"))
    of_number = (
        F.when(number == PLAIN, "decimal(38,0)")
        .when(number == INTEGER, decimal(capped, F.lit(0)))
        .when(number == WHOLE, F.when(p > 38, "string").otherwise(decimal(p, F.lit(0))))
        .when(number == SCALED, decimal(capped, scale))
        .when(number == FLOAT, F.when(p > 38, "string").otherwise(decimal(F.greatest(p, F.lit(10)), F.lit(10))))
        .otherwise("decimal(38,18)")
    )
    return (
        F.when(column_type.isin(*CHAR), F.when(source_type.isin(*SOURCE_BOOLEAN), "boolean").otherwise("string"))
        .when(column_type.isin(*DATE), F.when(source_type.isin(*SOURCE_DATE), "date").otherwise("timestamp_ntz"))
        .when(column_type.isin(*TIMESTAMP), F.when(source_type.isin(*SOURCE_TIME), "time").when(source_type.isin(*SOURCE_TEXT), "string").otherwise("timestamp_ntz"))
        .when(column_type.isin(*TIMESTAMP_TZ), "timestamp")
        .when(column_type.isin(*FLOATING), "double")
        .when(column_type == NUMBER, of_number)
        .otherwise("string")
    )
