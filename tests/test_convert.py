import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.functions import convert, types

D, T = dt.date, dt.datetime
CASES = [
    ("boolean", {"1": True, "TRUE": True, " t ": True, "0": False, "yes": False, "x": False, "": None}),
    ("bigint", {"12345.0": 12345, "1.23E+10": 12300000000, "12.9": 12, "1.23E+1": 1, "abc": None, "": None, "-7": -7, " 8 ": 8}),
    ("int", {"5": 5, "5.0": None, "99999999999": None, "x": None}),
    ("decimal(10,2)", {"1.005": Decimal("1.01"), "-1.005": Decimal("-1.01"), "1E+3": Decimal("1000.00"), "123456789012": None, "x": None}),
    ("double", {"1.5": 1.5, "1e3": 1000.0, "x": None}),
    ("date", {"2024-01-02": D(2024, 1, 2), "2024/01/02": D(2024, 1, 2), "2024-01-02 10:00:00": D(2024, 1, 2), "2023-02-30": D(2023, 2, 28), "02-01-2024": None, "2024-13-01": None, "2024-01-32": None, "": None}),
    ("time", {"10:20:30": "10:20:30.000000", "10:20:30.123": "10:20:30.123000", "10:20:30.123456 +08:00": "10:20:30.123456", "1970-01-01 10:20:30.123": "10:20:30.123000", "x": None, "24:00:00": None}),
    ("timestamp_ntz", {
        "2024-01-02 03:04:05.123456789": T(2024, 1, 2, 3, 4, 5, 123456), "2024-01-02 03:04:05.123456": T(2024, 1, 2, 3, 4, 5, 123456), "2024-01-02 03:04:05.123": T(2024, 1, 2, 3, 4, 5, 123000),
        "2024-01-02 03:04:05": T(2024, 1, 2, 3, 4, 5), "2024/01/02 03:04:05": T(2024, 1, 2, 3, 4, 5), "2024-01-02 03:04": T(2024, 1, 2, 3, 4), "2024-01-02": T(2024, 1, 2), "2024/01/02": T(2024, 1, 2),
        "03:04:05": T(1970, 1, 1, 3, 4, 5), "03:04:05.250": T(1970, 1, 1, 3, 4, 5, 250000), "03:04:05.250001": T(1970, 1, 1, 3, 4, 5, 250001),
        "2024-01-02T03:04:05": None, "2024-01-02 03:04:05.1": None, "2024-01-02 03:04:05 +08:00": None, "2023-02-30 00:00:00": T(2023, 2, 28), "2023-12-31 24:00:00": T(2024, 1, 1), "2024-01-02 25:00:00": None,
    }),
    ("timestamp", {"2024-01-02 03:04:05 +08:00": T(2024, 1, 1, 19, 4, 5), "2024-01-02 03:04:05.123 -05:30": T(2024, 1, 2, 8, 34, 5, 123000), "2024-01-02 03:04:05": T(2024, 1, 2, 3, 4, 5), "x": None}),
    ("binary", {"abc": None}),
]


@pytest.mark.parametrize(("kind", "cases"), CASES, ids=[k for k, _ in CASES])
def test_conversion(spark, kind, cases):
    value = convert.converter(kind)(F.col("v"))
    value = value.cast("timestamp_ntz") if kind == "timestamp" else value
    rows = spark.createDataFrame([(k,) for k in cases] + [(None,)], "v string").select("v", value.alias("x")).collect()
    assert {r.v: r.x for r in rows} == {**cases, None: None}


def test_schema_of_a_dictionary_table():
    c = types.ColumnSpec
    t = types.TableSpec("App", "T", [c("ID", 2, 1, "12", "0", 1200), c("Added", 1, 9, added=True), c("BUSI_DATE", 12, 3), c("X", 2, 4, "5", "9", 3000), c("F", 2, 5, "5", None, 3100), c("B", 96, 6, source_type=5018)], [1])
    s = types.schema_of(t, True)
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in s] == [("id", "decimal(12,0)", False), ("x", "decimal(5,5)", True), ("f", "decimal(10,10)", True), ("b", "boolean", True), ("added", "string", True)]
    assert "busi_date" in types.schema_of(t, False, "busi_date").names and types.schema_of(t, False)["id"].nullable


def test_many_fraction_digits_are_cut_not_rounded(spark):
    cases = {"11.9999999999999999999": 11, "11.00000000000000000000": 11, "-0.00000000000000000001": 0, "5.": 5, "1.5e1": 15}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    assert {r.v: r.x for r in df.select("v", convert.to_long(df.v).alias("x")).collect()} == cases
