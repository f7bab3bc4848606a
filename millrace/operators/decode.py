"""Change packets as rows of before and after images.

A packet: pkt_seq, owner, table, op_type, rows array<struct<row_no, cols array<struct<name, value, cflag>>>>.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.convert import converter

ROW_SPAN = 1_000_000
#: The column that may name a row's own operation.
CONTROL = "mergercolkeyname"
PACKET = "pkt_seq long, owner string, table string, op_type string, rows array<struct<row_no: int, cols: array<struct<name: string, value: string, cflag: int>>>>"
#: An event may also be no data (kind: data or null, ddl, source_ddl, sql, ...); DDL events define a table.
EVENT = PACKET + ", kind string, ddl struct<pk_column_no: array<int>, columns: array<struct<name: string, column_type: int, column_no: int, length: string, precision: string, number_type: int, source_type: int, added: boolean, comment: string>>>"


def table_key(owner: Column, table: Column) -> Column:
    return F.lower(F.concat_ws(".", owner, table))


def split_known(packets: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(packets of tables in ``known``, which has a column ``key``; the rest, for the dead letters)."""
    keyed = packets.withColumn("key", table_key(F.col("owner"), F.col("table")))
    return keyed.join(known.select("key"), "key", "left_semi"), keyed.join(known.select("key"), "key", "left_anti")


def is_full_load(op_type: Column) -> Column:
    return op_type == "i"


def row_seq(pkt_seq: Column, row_no: Column) -> Column:
    return (pkt_seq * ROW_SPAN + row_no).cast("long")


def operation(op_type: Column, control: Column) -> Column:
    """A row's operation: the control column's where it names one, else the packet's."""
    own = F.upper(F.trim(control))
    own = F.when(own == "I", "I").when(own.isin("U", "UA", "UB"), "U").when(own == "D", "D")
    return F.coalesce(own, F.upper(F.trim(op_type)))


def image(cols: Column, before: bool) -> Column:
    """The cells of one image as a map from lower-case name to value; the last of a name counts."""
    wanted = F.filter(cols, lambda c: (c["cflag"].bitwiseAND(1) == (1 if before else 0)) & c["name"].isNotNull())
    names = F.transform(wanted, lambda c: F.lower(c["name"]))
    last = F.filter(F.zip_with(wanted, F.sequence(F.lit(1), F.size(wanted)), lambda c, i: F.struct(F.lower(c["name"]).alias("k"), c["value"].alias("v"), i.alias("i"))), lambda x: F.array_position(F.reverse(names), x["k"]) == F.size(names) - x["i"] + 1)
    return F.when(F.size(wanted) > 0, F.map_from_entries(F.transform(last, lambda x: F.struct(x["k"], x["v"]))))


def typed(img: Column, schema: StructType, names: dict[str, str] | None = None) -> Column:
    """A struct of the table's columns from an image: unknown cells are dropped, missing ones null."""
    cell = lambda f: F.try_element_at(img, F.lit(f.name.lower()))
    type_of = lambda f: (names or {}).get(f.name, f.dataType.simpleString())
    return F.when(img.isNotNull(), F.struct(*[converter(type_of(f))(cell(f)).alias(f.name) for f in schema.fields]))


def rows_of(packets: DataFrame) -> DataFrame:
    """One row a change: key, pkt_seq, row_no, seq, op, full_load, old_map and new_map."""
    r = packets.withColumn("r", F.explode("rows"))
    r = r.select(table_key(F.col("owner"), F.col("table")).alias("key"), "pkt_seq", "op_type", F.col("r.row_no").alias("row_no"), F.col("r.cols").alias("cols"))
    control = F.filter("cols", lambda c: F.lower(c["name"]) == CONTROL)
    cells = F.filter("cols", lambda c: F.lower(c["name"]) != CONTROL)
    r = r.withColumns({"control": F.try_element_at(control, F.lit(1))["value"], "cols": cells})
    r = r.withColumn("op", operation(F.col("op_type"), F.col("control")))
    return r.select("key", "pkt_seq", "row_no", row_seq(F.col("pkt_seq"), F.col("row_no")).alias("seq"), "op", is_full_load(F.col("op_type")).alias("full_load"), image(F.col("cols"), True).alias("old_map"), image(F.col("cols"), False).alias("new_map"))


def decoded(packets: DataFrame, schema: StructType, names: dict[str, str] | None = None) -> DataFrame:
    """pkt_seq, row_no, seq, op, full_load and typed ``old`` and ``new`` images."""
    return rows_of(packets).select("key", "pkt_seq", "row_no", "seq", "op", "full_load", typed(F.col("old_map"), schema, names).alias("old"), typed(F.col("new_map"), schema, names).alias("new"))
