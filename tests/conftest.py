import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
os.environ.setdefault("TZ", "UTC")

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def same_rows(df, con, sql):
    """Whether a DataFrame and a query have the same rows, columns by name."""
    rows, cols = df.collect(), df.columns
    q = con.execute(sql)
    names, expected = [d[0] for d in q.description], q.fetchall()
    assert sorted(cols) == sorted(names)
    plain = lambda v: "null" if v is None or v != v else str(v)
    order = sorted(cols)
    got = sorted(str([plain(r[cols.index(c)]) for c in order]) for r in rows)
    want = sorted(str([plain(r[names.index(c)]) for c in order]) for r in expected)
    assert got == want
