"""Named queries over the driver's tables, each with the SQL it is held against.

Change logs are derived from the tables: ``E`` takes events as changes by user, ``O`` takes orders as
changes to customers.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..config import Config
from ..functions import convert, types
from ..operators import apply, classify, decode, fold, maintain, metrics
from ..sources import dictionary
from ..sources.store import Store

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql.strip()
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def log_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("pk"), F.col("event_id").alias("seq"), op.alias("op"), F.col("value").alias("v"))


def log_o(spark: SparkSession, sf_dir: str) -> DataFrame:
    op = F.when(F.col("o_orderstatus") == "O", "I").when(F.col("o_orderstatus") == "F", "U").otherwise("D")
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("pk"), F.col("o_orderkey").alias("seq"), op.alias("op"), F.col("o_totalprice").alias("v"))


E_SQL = "SELECT user_id AS pk, event_id AS seq, CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op, value AS v FROM events"
O_SQL = "SELECT o_custkey AS pk, o_orderkey AS seq, CASE o_orderstatus WHEN 'O' THEN 'I' WHEN 'F' THEN 'U' ELSE 'D' END AS op, o_totalprice AS v FROM orders"
FOLD = """list_reduce(list_prepend('N', list(op ORDER BY seq)), lambda s, o:
  CASE WHEN o = 'I' THEN (CASE WHEN s = 'D' THEN 'U' ELSE 'I' END)
       WHEN o = 'U' THEN (CASE WHEN s = 'I' THEN 'I' ELSE 'U' END)
       ELSE (CASE WHEN s = 'I' THEN 'N' ELSE 'D' END) END)"""
FOLDED_E = f"f AS (SELECT pk, {FOLD} AS state, max(seq) AS last_seq, arg_max(v, seq) AS v FROM ({E_SQL}) GROUP BY pk)"
FOLDED_O = f"f AS (SELECT pk, {FOLD} AS state, max(seq) AS last_seq, arg_max(v, seq) AS v FROM ({O_SQL}) GROUP BY pk)"
SLICE = 5000
SLICED_O = f"""g AS (SELECT pk, slice, {FOLD} AS state, arg_max(v, seq) AS v FROM (SELECT *, seq // {SLICE} AS slice FROM ({O_SQL})) GROUP BY pk, slice),
f AS (SELECT pk, arg_max(state, slice) AS state, arg_max(v, slice) AS v FROM g WHERE state <> 'N' GROUP BY pk)"""


# -- folding


@query(f"WITH {FOLDED_E} SELECT pk, state, last_seq, v FROM f")
def fold_pk(spark, sf_dir):
    return fold.states(log_e(spark, sf_dir), ["pk"], v="v")


@query(f"WITH {FOLDED_E} SELECT pk, v FROM f WHERE state IN ('I', 'U')")
def fold_inserts(spark, sf_dir):
    return fold.inserts(fold.states(log_e(spark, sf_dir), ["pk"], v="v")).select("pk", "v")


@query(f"WITH {FOLDED_E} SELECT pk FROM f WHERE state <> 'N'")
def fold_deletes(spark, sf_dir):
    return fold.deletes(fold.states(log_e(spark, sf_dir), ["pk"])).select("pk")


@query(f"WITH {FOLDED_E} SELECT pk, CASE state WHEN 'N' THEN 'D' ELSE state END AS state FROM f")
def fold_strict(spark, sf_dir):
    return fold.states(log_e(spark, sf_dir), ["pk"], strict=True).select("pk", "state")


@query(f"SELECT 'insert' AS what, pk, seq, v FROM ({E_SQL}) WHERE op IN ('I', 'U') UNION ALL SELECT 'delete', pk, seq, v FROM ({E_SQL}) WHERE op IN ('U', 'D')")
def fold_fast_mode(spark, sf_dir):
    rows, gone = fold.fast(log_e(spark, sf_dir))
    pick = lambda d, w: d.select(F.lit(w).alias("what"), "pk", "seq", "v")
    return pick(rows, "insert").unionByName(pick(gone, "delete"))


@query(f"WITH {SLICED_O} SELECT pk, state, v FROM f")
def fold_sliced(spark, sf_dir):
    return fold.folded_slices(fold.slices(log_o(spark, sf_dir), SLICE), ["pk"], v="v").select("pk", "state", "v")


MIRROR = "SELECT CAST(c_custkey AS BIGINT) AS pk, CAST(c_acctbal AS DOUBLE) AS v FROM customer WHERE c_custkey NOT IN (SELECT pk FROM f WHERE state <> 'N') UNION ALL SELECT pk, v FROM f WHERE state IN ('I', 'U')"


def _customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pk"), F.col("c_acctbal").alias("v"))


@query(f"WITH {FOLDED_O} {MIRROR}")
def mirror_apply(spark, sf_dir):
    folded = fold.states(log_o(spark, sf_dir), ["pk"], v="v")
    return apply.mirror(_customers(spark, sf_dir), folded, ["pk"], fold.inserts(folded).select("pk", "v"))


@query(f"WITH {SLICED_O} {MIRROR}")
def mor_read(spark, sf_dir):
    """Rows tagged with their commit, less those whose key a later commit deletes."""
    each = fold.states(fold.slices(log_o(spark, sf_dir), SLICE), ["pk", "slice"], v="v").withColumn("commit", F.col("slice") + 1)
    data = _customers(spark, sf_dir).withColumn("commit", F.lit(0).cast("long")).unionByName(fold.inserts(each).select("pk", "v", "commit"))
    last = fold.deletes(each).groupBy("pk").agg(F.max("commit").alias("gone"))
    return data.join(last, "pk", "left").where("gone is null or gone <= commit").select("pk", "v")


@query(f"WITH {FOLDED_O} SELECT DISTINCT CAST(c_custkey % 64 AS BIGINT) AS bucket FROM customer WHERE c_custkey IN (SELECT pk FROM f WHERE state <> 'N')")
def cow_hit_files(spark, sf_dir):
    keys = fold.deletes(fold.states(log_o(spark, sf_dir), ["pk"])).select("pk")
    return _customers(spark, sf_dir).join(keys, "pk", "left_semi").select((F.col("pk") % 64).alias("bucket")).distinct()


@query(f"WITH {FOLDED_E} SELECT DISTINCT pk FROM f WHERE state <> 'N'")
def affected_pks(spark, sf_dir):
    folded = fold.states(log_e(spark, sf_dir), ["pk"])
    return fold.inserts(folded).select("pk").union(fold.deletes(folded).select("pk")).distinct()


# -- classification: images are (k, v); the old one is the key's previous value


IMAGES = f"""i AS (SELECT pk, seq, op, v, lag(v) OVER (PARTITION BY pk ORDER BY seq) AS ov, seq % 7 = 0 AS no_old, seq % 11 = 0 AS no_new, seq % 13 = 0 AS moved FROM ({E_SQL})),
m AS (SELECT seq, op, CASE WHEN ov IS NULL OR no_old OR op = 'I' THEN NULL ELSE CASE WHEN moved THEN pk + 1000000 ELSE pk END END AS ok, CASE WHEN NOT (no_old OR op = 'I') THEN ov END AS ov,
      CASE WHEN op = 'I' OR NOT no_new THEN pk END AS nk, CASE WHEN op = 'I' OR NOT no_new THEN v END AS nv FROM i)"""


def images(spark, sf_dir) -> DataFrame:
    e = log_e(spark, sf_dir)
    ov = F.lag("v").over(Window.partitionBy("pk").orderBy("seq"))
    e = e.withColumn("ov", ov)
    is_i = F.col("op") == "I"
    old_key = F.when(F.col("seq") % 13 == 0, F.col("pk") + 1_000_000).otherwise(F.col("pk"))
    old = F.when(F.col("ov").isNotNull() & (F.col("seq") % 7 != 0) & ~is_i, F.struct(old_key.alias("k"), F.col("ov").alias("v")))
    new = F.when(is_i | (F.col("seq") % 11 != 0), F.struct(F.col("pk").alias("k"), F.col("v").alias("v")))
    return e.select("seq", "op", old.alias("old"), new.alias("new"))


def _flat(ops: DataFrame) -> DataFrame:
    return ops.select("seq", "op", "sub_no", F.col("old.k").alias("old_k"), F.col("old.v").alias("old_v"), F.col("new.k").alias("new_k"), F.col("new.v").alias("new_v"))


NONE = "CAST(NULL AS BIGINT)", "CAST(NULL AS DOUBLE)"
UPDATES_SQL = f"""
SELECT seq, 'U' AS op, 0 AS sub_no, ok AS old_k, ov AS old_v, nk AS new_k, nv AS new_v FROM m WHERE op = 'U' AND ok = nk
UNION ALL SELECT seq, 'D', 0, ok, ov, NULL, NULL FROM m WHERE op = 'U' AND ok <> nk
UNION ALL SELECT seq, 'I', 1, NULL, NULL, nk, nv FROM m WHERE op = 'U' AND ok <> nk
UNION ALL SELECT seq, 'D', 0, nk, nv, NULL, NULL FROM m WHERE op = 'U' AND ok IS NULL AND nk IS NOT NULL
UNION ALL SELECT seq, 'I', 1, NULL, NULL, nk, nv FROM m WHERE op = 'U' AND ok IS NULL AND nk IS NOT NULL
UNION ALL SELECT seq, 'D', 0, ok, ov, NULL, NULL FROM m WHERE op = 'U' AND ok IS NOT NULL AND nk IS NULL"""


@query(f"WITH {IMAGES} {UPDATES_SQL}")
def classify_update(spark, sf_dir):
    return _flat(classify.operations(images(spark, sf_dir).where("op = 'U'"), ["k"], True))


@query(f"WITH {IMAGES} SELECT seq, 'D' AS op, 0 AS sub_no, coalesce(ok, nk) AS old_k, CASE WHEN ok IS NOT NULL THEN ov ELSE nv END AS old_v, {NONE[0]} AS new_k, {NONE[1]} AS new_v FROM m WHERE op = 'D' AND coalesce(ok, nk) IS NOT NULL")
def classify_delete(spark, sf_dir):
    return _flat(classify.operations(images(spark, sf_dir).where("op = 'D'"), ["k"], True))


@query(f"WITH {IMAGES} SELECT seq, op, sub_no, old_k, new_k FROM ({UPDATES_SQL}) WHERE seq % 13 = 0 AND seq % 7 <> 0 AND seq % 11 <> 0 AND op <> 'U' AND seq IN (SELECT seq FROM m WHERE ok IS NOT NULL)")
def pk_change_split(spark, sf_dir):
    i = images(spark, sf_dir).where("op = 'U' and old is not null and new is not null and old.k <> new.k")
    return _flat(classify.operations(i, ["k"], True)).select("seq", "op", "sub_no", "old_k", "new_k")


@query(f"WITH {IMAGES} SELECT seq, 'D' AS op, 0 AS sub_no, nk AS k FROM m WHERE op = 'U' AND ok IS NULL AND nk IS NOT NULL UNION ALL SELECT seq, 'I', 1, nk FROM m WHERE op = 'U' AND ok IS NULL AND nk IS NOT NULL")
def update_after_only(spark, sf_dir):
    ops = classify.operations(images(spark, sf_dir).where("op = 'U' and old is null"), ["k"], True)
    return _flat(ops).select("seq", "op", "sub_no", F.coalesce("old_k", "new_k").alias("k"))


TRAJECTORY = """
SELECT seq, 0 AS sub_no, ok AS k, ov AS v FROM m WHERE op = 'U' AND ok IS NOT NULL
UNION ALL SELECT seq, 1, nk, nv FROM m WHERE op = 'U' AND nk IS NOT NULL
UNION ALL SELECT seq, 0, nk, nv FROM m WHERE op = 'I'
UNION ALL SELECT seq, 0, CASE WHEN ok IS NOT NULL THEN ok ELSE nk END, CASE WHEN ok IS NOT NULL THEN ov ELSE nv END FROM m WHERE op = 'D' AND (ok IS NOT NULL OR nk IS NOT NULL)"""


@query(f"WITH {IMAGES} {TRAJECTORY}")
def trajectory_append(spark, sf_dir):
    ops = classify.operations(images(spark, sf_dir), ["k"], False)
    return classify.history(ops).select("seq", "sub_no", "row.k", "row.v")


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, l_quantity, CASE l_returnflag WHEN 'A' THEN 'I' WHEN 'N' THEN 'U' ELSE 'D' END AS op FROM lineitem)
SELECT op, 0 AS image_no, l_orderkey, l_linenumber, l_quantity FROM l
UNION ALL SELECT op, 1, l_orderkey, l_linenumber, l_quantity + 1 FROM l WHERE op = 'U'""")
def trajectory_no_pk(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    op = F.when(F.col("l_returnflag") == "A", "I").when(F.col("l_returnflag") == "N", "U").otherwise("D")
    img = lambda q: F.struct("l_orderkey", "l_linenumber", q.alias("l_quantity"))
    q = F.col("l_quantity")
    rows = l.select(op.alias("op"), F.when(op != "I", img(q)).alias("old"), F.when(op == "I", img(q)).when(op == "U", img(q + 1)).alias("new"))
    return classify.history_without_key(rows).select("op", "image_no", "row.*")


# -- packets


def packets(spark, sf_dir) -> DataFrame:
    """Ten events a packet; each row has its old value (cflag 1), its new one (cflag 0) and now and then a control cell."""
    e = table(spark, sf_dir, "events")
    cell = lambda n, v, c: F.struct(F.lit(n).alias("name"), v.cast("string").alias("value"), F.lit(c).cast("int").alias("cflag"))
    control = F.when(F.col("event_id") % 9 == 0, "UA").when(F.col("event_id") % 9 == 1, "d").when(F.col("event_id") % 9 == 2, "x")
    cells = F.array(cell("USER_ID", F.col("user_id"), 1), cell("KIND", F.concat(F.col("event_type"), F.lit("-old")), 1), cell("User_Id", F.col("user_id"), 2), cell("KIND", F.when(F.col("event_id") % 5 != 0, F.col("event_type")).otherwise(""), 0))
    cells = F.when(F.col("event_id") % 9 < 3, F.concat(cells, F.array(cell("MergerColKeyName", control, 0)))).otherwise(cells)
    rows = e.select(F.floor(F.col("event_id") / 10).alias("pkt_seq"), (F.col("event_id") % 10).cast("int").alias("row_no"), cells.alias("cols"))
    owner, name = F.lit("App"), F.when(F.col("pkt_seq") % 4 == 3, "Unknown").otherwise("Events")
    grouped = rows.groupBy("pkt_seq").agg(F.array_sort(F.collect_list(F.struct("row_no", "cols"))).alias("rows"))
    return grouped.select("pkt_seq", owner.alias("owner"), name.alias("table"), F.when(F.col("pkt_seq") % 6 == 0, "i").otherwise("I").alias("op_type"), "rows")


@query("""SELECT event_id // 10 * 1000000 + event_id % 10 AS seq, CAST(user_id AS VARCHAR) AS old_id, event_type || '-old' AS old_kind, CAST(user_id AS VARCHAR) AS new_id,
CASE WHEN event_id % 5 <> 0 THEN event_type ELSE '' END AS new_kind FROM events""")
def image_split(spark, sf_dir):
    r = decode.rows_of(packets(spark, sf_dir))
    return r.select("seq", F.col("old_map")["user_id"].alias("old_id"), F.col("old_map")["kind"].alias("old_kind"), F.col("new_map")["user_id"].alias("new_id"), F.col("new_map")["kind"].alias("new_kind"))


@query("SELECT event_id // 10 * 1000000 + event_id % 10 AS seq, user_id AS id, CASE WHEN event_id % 5 <> 0 THEN event_type END AS kind, CAST(NULL AS DOUBLE) AS missing FROM events")
def name_projection(spark, sf_dir):
    from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

    schema = StructType([StructField("user_id", LongType()), StructField("kind", StringType()), StructField("missing", DoubleType())])
    d = decode.decoded(packets(spark, sf_dir), schema)
    return d.select("seq", F.col("new.user_id").alias("id"), F.col("new.kind").alias("kind"), F.col("new.missing").alias("missing"))


@query("SELECT event_id // 10 * 1000000 + event_id % 10 AS seq, CASE event_id % 9 WHEN 0 THEN 'U' WHEN 1 THEN 'D' ELSE 'I' END AS op, event_id // 10 % 6 = 0 AS full_load FROM events")
def merger_control_op(spark, sf_dir):
    return decode.rows_of(packets(spark, sf_dir)).select("seq", "op", "full_load")


@query("SELECT event_id // 10 AS pkt_seq, CAST(event_id % 10 AS INTEGER) AS row_no, event_id // 10 * 1000000 + event_id % 10 AS seq FROM events")
def row_offsets(spark, sf_dir):
    return decode.rows_of(packets(spark, sf_dir)).select("pkt_seq", "row_no", "seq")


@query("SELECT CASE WHEN event_id // 10 % 4 = 3 THEN 'app.unknown' ELSE 'app.events' END AS key, event_id // 10 % 4 <> 3 AS known, count(*) AS n FROM events GROUP BY 1, 2")
def known_tables_filter(spark, sf_dir):
    names = spark.createDataFrame([("app.events",)], "key string")
    good, rest = decode.split_known(packets(spark, sf_dir), names)
    both = good.withColumn("known", F.lit(True)).unionByName(rest.withColumn("known", F.lit(False)))
    return both.groupBy("key", "known").agg(F.sum(F.size("rows")).cast("long").alias("n"))


@query("SELECT user_id AS pk, event_id AS seq, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place FROM events")
def global_order(spark, sf_dir):
    """Operations of four workers, merged and put in order within each key."""
    e = log_e(spark, sf_dir)
    workers = [e.where(F.col("seq") % 4 == i) for i in range(4)]
    merged = workers[0].unionByName(workers[1]).unionByName(workers[2]).unionByName(workers[3])
    return merged.select("pk", "seq", F.row_number().over(Window.partitionBy("pk").orderBy("seq")).cast("long").alias("place"))


# -- casts: strings built from columns, among malformed ones


def _texts(spark, sf_dir, name: str, *forms: Column) -> DataFrame:
    """id and a text: form number id % len(forms) of each row."""
    key = {"events": "event_id", "orders": "o_orderkey"}[name]
    t = table(spark, sf_dir, name)
    value = F.lit(None).cast("string")
    for i, f in enumerate(forms):
        value = F.when(F.col(key) % len(forms) == i, f).otherwise(value)
    return t.select(F.col(key).alias("id"), value.alias("text"))


@query("SELECT event_id AS id, CASE event_id % 8 WHEN 0 THEN TRUE WHEN 1 THEN TRUE WHEN 2 THEN TRUE WHEN 3 THEN FALSE WHEN 4 THEN FALSE WHEN 5 THEN NULL WHEN 6 THEN FALSE ELSE event_type = 't' END AS value FROM events")
def cast_bool(spark, sf_dir):
    d = _texts(spark, sf_dir, "events", F.lit("1"), F.lit("TRUE"), F.lit(" t "), F.lit("0"), F.lit("yes"), F.lit(""), F.lit("x"), F.col("event_type"))
    return d.select("id", convert.to_boolean(F.col("text")).alias("value"))


@query("""SELECT event_id AS id, CASE event_id % 8 WHEN 0 THEN user_id WHEN 1 THEN -user_id WHEN 2 THEN user_id WHEN 3 THEN user_id WHEN 4 THEN user_id * 100000000 WHEN 5 THEN 1 ELSE NULL END AS value FROM events""")
def cast_long(spark, sf_dir):
    u = F.col("user_id").cast("string")
    d = _texts(spark, sf_dir, "events", u, F.concat(F.lit(" -"), u), F.concat(u, F.lit(".0")), F.concat(u, F.lit(".9")), F.concat(u, F.lit("E+8")), F.lit("1.23E+1"), F.lit("abc"), F.lit(""))
    return d.select("id", convert.to_long(F.col("text")).alias("value"))


@query("SELECT event_id AS id, CASE event_id % 5 WHEN 0 THEN CAST(user_id AS INTEGER) WHEN 1 THEN CAST(-user_id AS INTEGER) ELSE NULL END AS value FROM events")
def cast_int(spark, sf_dir):
    u = F.col("user_id").cast("string")
    d = _texts(spark, sf_dir, "events", F.concat(F.lit(" "), u), F.concat(F.lit("-"), u), F.concat(u, F.lit(".0")), F.lit("9999999999"), F.lit("x1"))
    return d.select("id", convert.to_int(F.col("text")).alias("value"))


@query("""SELECT event_id AS id, CASE event_id % 6 WHEN 0 THEN CAST(user_id AS DECIMAL(10,2)) WHEN 1 THEN CAST(user_id + 0.01 AS DECIMAL(10,2)) WHEN 2 THEN CAST(-user_id - 0.01 AS DECIMAL(10,2))
WHEN 3 THEN CAST(user_id * 1000 AS DECIMAL(10,2)) ELSE NULL END AS value FROM events""")
def cast_decimal(spark, sf_dir):
    u = F.col("user_id").cast("string")
    d = _texts(spark, sf_dir, "events", u, F.concat(u, F.lit(".005")), F.concat(F.lit("-"), u, F.lit(".005")), F.concat(u, F.lit("E+3")), F.lit("123456789012.5"), F.lit("1,5"))
    return d.select("id", convert.to_decimal(F.col("text"), 10, 2).alias("value"))


@query("SELECT event_id AS id, CASE event_id % 5 WHEN 0 THEN CAST(user_id AS DOUBLE) WHEN 1 THEN user_id + 0.5 WHEN 2 THEN user_id * 1000.0 ELSE NULL END AS value FROM events")
def cast_double(spark, sf_dir):
    u = F.col("user_id").cast("string")
    d = _texts(spark, sf_dir, "events", u, F.concat(F.lit(" "), u, F.lit(".5 ")), F.concat(u, F.lit("e3")), F.lit("1,5"), F.lit(""))
    return d.select("id", convert.to_double(F.col("text")).alias("value"))


@query("""SELECT o_orderkey AS id, CASE o_orderkey % 7 WHEN 0 THEN CAST(o_orderdate AS DATE) WHEN 1 THEN CAST(o_orderdate AS DATE) WHEN 2 THEN CAST(o_orderdate AS DATE)
WHEN 3 THEN last_day(CAST(o_orderdate AS DATE)) ELSE NULL END AS value FROM orders""")
def cast_date(spark, sf_dir):
    d, f = F.col("o_orderdate"), F.date_format
    t = _texts(spark, sf_dir, "orders", f(d, "yyyy-MM-dd"), f(d, "yyyy/MM/dd"), f(d, "yyyy-MM-dd HH:mm:ss"), F.concat(f(d, "yyyy-MM-"), F.lit("31")), F.concat(f(d, "yyyy-MM-"), F.lit("32")), f(d, "dd-MM-yyyy"), F.lit("2023-13-01"))
    return t.select("id", convert.to_date(F.col("text")).alias("value"))


@query("""SELECT event_id AS id, CASE event_id % 6 WHEN 0 THEN strftime(ts, '%H:%M:%S.000000') WHEN 1 THEN strftime(ts, '%H:%M:%S.120000') WHEN 2 THEN strftime(ts, '%H:%M:%S.123456')
WHEN 3 THEN strftime(ts, '%H:%M:%S.500000') WHEN 4 THEN strftime(ts, '%H:%M:00.000000') ELSE NULL END AS value FROM events""")
def cast_time(spark, sf_dir):
    t, f = F.col("ts"), F.date_format
    s = f(t, "HH:mm:ss")
    d = _texts(spark, sf_dir, "events", s, F.concat(s, F.lit(".120")), F.concat(s, F.lit(".123456 +08:00")), F.concat(F.lit("1970-01-01 "), s, F.lit(".500")), f(t, "HH:mm"), F.lit("25:00:00"))
    return d.select("id", convert.to_time(F.col("text")).alias("value"))


STAMPS = """SELECT event_id AS id, CASE event_id % 16 WHEN 0 THEN s WHEN 1 THEN s WHEN 2 THEN s + INTERVAL 123 MILLISECOND WHEN 3 THEN s + INTERVAL 123456 MICROSECOND WHEN 4 THEN s + INTERVAL 123456 MICROSECOND
WHEN 5 THEN date_trunc('minute', s) WHEN 6 THEN date_trunc('day', s) WHEN 7 THEN date_trunc('day', s) WHEN 8 THEN TIMESTAMP '1970-01-01' + (s - date_trunc('day', s)) WHEN 9 THEN TIMESTAMP '1970-01-01' + (s - date_trunc('day', s)) + INTERVAL 5 MILLISECOND
WHEN 10 THEN CAST(last_day(CAST(s AS DATE)) AS TIMESTAMP) + (s - date_trunc('day', s)) WHEN 11 THEN date_trunc('day', s) + INTERVAL 1 DAY ELSE NULL END AS value FROM (SELECT event_id, CAST(date_trunc('second', ts) AS TIMESTAMP) AS s FROM events)"""


def _stamps(spark, sf_dir):
    t, f = F.col("ts"), F.date_format
    s, d = f(t, "yyyy-MM-dd HH:mm:ss"), f(t, "yyyy-MM-dd")
    return _texts(spark, sf_dir, "events", s, f(t, "yyyy/MM/dd HH:mm:ss"), F.concat(s, F.lit(".123")), F.concat(s, F.lit(".123456")), F.concat(s, F.lit(".123456789")), f(t, "yyyy-MM-dd HH:mm"), d, f(t, "yyyy/MM/dd"), f(t, "HH:mm:ss"), F.concat(f(t, "HH:mm:ss"), F.lit(".005")), F.concat(f(t, "yyyy-MM-"), F.lit("31 "), f(t, "HH:mm:ss")), F.concat(d, F.lit(" 24:00:00")), F.concat(d, F.lit("T"), f(t, "HH:mm:ss")), F.concat(s, F.lit(".1")), F.concat(s, F.lit(" +08:00")), F.lit(""))


@query(STAMPS)
def cast_timestamp(spark, sf_dir):
    return _stamps(spark, sf_dir).select("id", convert.to_timestamp(F.col("text")).alias("value"))


@query("""SELECT event_id AS id, CAST(epoch_us(CASE event_id % 5 WHEN 0 THEN s - INTERVAL 8 HOUR WHEN 1 THEN s + INTERVAL 5 HOUR + INTERVAL 30 MINUTE + INTERVAL 250 MILLISECOND WHEN 2 THEN s WHEN 3 THEN date_trunc('day', s) ELSE NULL END) AS BIGINT) AS micros
FROM (SELECT event_id, CAST(date_trunc('second', ts) AS TIMESTAMP) AS s FROM events)""")
def cast_timestamptz(spark, sf_dir):
    t, f = F.col("ts"), F.date_format
    s = f(t, "yyyy-MM-dd HH:mm:ss")
    d = _texts(spark, sf_dir, "events", F.concat(s, F.lit(" +08:00")), F.concat(s, F.lit(".250 -05:30")), s, f(t, "yyyy-MM-dd"), F.concat(s, F.lit("+08:00")))
    return d.select("id", F.unix_micros(convert.to_timestamptz(F.col("text"))).alias("micros"))


@query("SELECT event_id AS id, nullif(CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN ' ' ELSE event_type END, '') AS value FROM events")
def empty_to_null(spark, sf_dir):
    return _texts(spark, sf_dir, "events", F.lit(""), F.lit(" "), F.col("event_type")).select("id", convert.to_string(F.col("text")).alias("value"))


# -- types


CODES = [(c, s) for c in (1, 9, 8, 112, 69, 23, 113, 96, 12, 180, 181, 231, 100, 101, 7777) for s in (0, 5018, 2020, 5014, 2019, 5010, 5011)]
NUMBERS = [(k, n, s) for k in (1000, 1100, 1200, 3000, 3100, 9) for n in (None, "", "5", "12", "38", "40", "x") for s in (None, "2", "-3", "50")]
_values = lambda rows: ", ".join("(" + ", ".join("NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


@query(f"""SELECT c AS column_type, s AS source_type, CASE WHEN c = 96 AND s = 5018 THEN 'boolean' WHEN c = 12 AND s IN (2020, 5014) THEN 'date' WHEN c = 12 THEN 'timestamp_ntz'
WHEN c = 180 AND s IN (2019, 5010) THEN 'time' WHEN c = 180 AND s = 5011 THEN 'string' WHEN c = 180 THEN 'timestamp_ntz' WHEN c IN (181, 231) THEN 'timestamp' WHEN c IN (100, 101) THEN 'double' ELSE 'string' END AS type
FROM (VALUES {_values(CODES)}) AS t(c, s)""")
def type_mapping(spark, sf_dir):
    d = spark.createDataFrame(CODES, "column_type int, source_type int")
    none = F.lit(None)
    return d.select("column_type", "source_type", types.type_name_column(F.col("column_type"), F.col("source_type"), none.cast("int"), none.cast("string"), none.cast("string")).alias("type"))


@query(f"""SELECT k AS number_type, n AS length, s AS scale, CASE k WHEN 1000 THEN 'decimal(38,0)' WHEN 1100 THEN 'decimal(' || least(p, 38) || ',0)'
WHEN 1200 THEN CASE WHEN p > 38 THEN 'string' ELSE 'decimal(' || p || ',0)' END
WHEN 3000 THEN 'decimal(' || least(p, 38) || ',' || least(greatest(coalesce(TRY_CAST(s AS INTEGER), 0), 0), least(p, 38)) || ')'
WHEN 3100 THEN CASE WHEN p > 38 THEN 'string' ELSE 'decimal(' || greatest(p, 10) || ',10)' END ELSE 'decimal(38,18)' END AS type
FROM (SELECT *, greatest(coalesce(TRY_CAST(n AS INTEGER), CASE k WHEN 3100 THEN 38 ELSE 18 END), 1) AS p FROM (VALUES {_values(NUMBERS)}) AS t(k, n, s))""")
def number_mapping(spark, sf_dir):
    d = spark.createDataFrame(NUMBERS, "number_type int, length string, scale string")
    return d.select("number_type", "length", "scale", types.type_name_column(F.lit(2), F.lit(0), F.col("number_type"), F.col("length"), F.col("scale")).alias("type"))


# -- partitions, full load, files


@query("SELECT c_nationkey AS part, count(*) AS rows FROM customer GROUP BY 1")
def partition_route(spark, sf_dir):
    return table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("part")).agg(F.count("*").alias("rows"))


@query(f"WITH {FOLDED_O} SELECT CAST(c_nationkey AS INTEGER) AS part, pk FROM f JOIN customer ON c_custkey = pk WHERE state <> 'N'")
def partition_deletes(spark, sf_dir):
    """A key is deleted in the partition that its row is in, wherever a new row goes."""
    keys = fold.deletes(fold.states(log_o(spark, sf_dir), ["pk"])).select("pk")
    return keys.join(table(spark, sf_dir, "customer"), F.col("pk") == F.col("c_custkey")).select(F.col("c_nationkey").alias("part"), "pk")


@query("SELECT event_id AS id, user_id AS k FROM events WHERE event_id % 5 > 1")
def delete_pk_guard(spark, sf_dir):
    key = F.when(F.col("event_id") % 5 == 0, F.lit(None)).when(F.col("event_id") % 5 == 1, F.lit("")).otherwise(F.col("user_id").cast("string"))
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.struct(key.alias("k")).alias("img"))
    return e.where(classify.key_ready(F.col("img"), ["k"])).select("id", F.col("img.k").cast("long").alias("k"))


@query("SELECT c_custkey AS id, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation FROM customer")
def full_load_append(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    cols = F.create_map(F.lit("id"), F.col("c_custkey").cast("string"), F.lit("name"), F.col("c_name"), F.lit("nation"), F.col("c_nationkey").cast("string"))
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    schema = StructType([StructField("id", LongType()), StructField("name", StringType()), StructField("nation", LongType())])
    return c.select(decode.typed(cols, schema).alias("row")).select("row.*")


@query(f"""WITH w AS (SELECT pk, seq, op, v FROM ({O_SQL}) UNION ALL SELECT c_custkey, c_custkey - 10000000, 'I', c_acctbal FROM customer),
f AS (SELECT pk, {FOLD} AS state, arg_max(v, seq) AS v FROM w GROUP BY pk) SELECT pk, v FROM f WHERE state IN ('I', 'U')""")
def full_then_incremental(spark, sf_dir):
    """A full load in the same order as the changes after it."""
    load = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pk"), (F.col("c_custkey") - 10_000_000).alias("seq"), F.lit("I").alias("op"), F.col("c_acctbal").alias("v"))
    folded = fold.states(load.unionByName(log_o(spark, sf_dir)), ["pk"], v="v")
    return fold.inserts(folded).select("pk", "v")


@query("""SELECT c AS columns, r AS rows, CASE WHEN c > 300 THEN 10000 WHEN c > 100 THEN 30000 ELSE 80000 END AS rows_per_file,
CAST(ceil(r / CASE WHEN c > 300 THEN 10000.0 WHEN c > 100 THEN 30000.0 ELSE 80000.0 END) AS BIGINT) AS files
FROM (SELECT unnest([16, 100, 101, 300, 301]) AS c), (SELECT count(*) AS r FROM lineitem)""")
def roll_file_assignment(spark, sf_dir):
    from ..sources.store import writer_options

    widths = spark.createDataFrame([(c, writer_options(c, True)["maxRecordsPerFile"]) for c in (16, 100, 101, 300, 301)], "columns int, rows_per_file int")
    n = table(spark, sf_dir, "lineitem").groupBy(F.lit(1).alias("one")).agg(F.count("*").alias("rows"))
    return widths.withColumn("one", F.lit(1)).join(n, "one").select("columns", "rows", "rows_per_file", F.ceil(F.col("rows") / F.col("rows_per_file")).alias("files"))


# -- maintenance


@query("SELECT user_id AS pk, event_id AS seq, value AS v FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events) WHERE n = 1")
def dedup_last_wins(spark, sf_dir):
    return maintain.last_wins(log_e(spark, sf_dir).select("pk", "seq", "v"), ["pk"], "seq")


FILES_SQL = "SELECT CAST(p_partkey AS BIGINT) AS file, 't' || p_size AS tbl, CAST(p_retailprice * 100000 AS BIGINT) AS size FROM part"


@query(f"SELECT file, tbl, size FROM (SELECT *, count(*) OVER (PARTITION BY tbl) AS n FROM ({FILES_SQL}) WHERE size < 134217728) WHERE n >= 3")
def small_file_plan(spark, sf_dir):
    files = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("file"), F.concat(F.lit("t"), F.col("p_size")).alias("tbl"), F.round(F.col("p_retailprice") * 100000).cast("long").alias("size"))
    return maintain.small_files(files, group=["tbl"])


@query("""SELECT tbl, version, at_ms FROM (SELECT *, row_number() OVER (PARTITION BY tbl ORDER BY version DESC) AS n
FROM (SELECT event_type AS tbl, event_id AS version, epoch_us(ts) // 1000 AS at_ms FROM events)) WHERE at_ms < 1893456000000 - 24 * 3600000 AND n > 5""")
def expire_snapshots(spark, sf_dir):
    s = table(spark, sf_dir, "events").select(F.col("event_type").alias("tbl"), F.col("event_id").alias("version"), F.unix_millis(F.col("ts").cast("timestamp")).alias("at_ms"))
    return maintain.expired(s, 1893456000000, group=["tbl"])


# -- through a table on disk


def _store(spark, name: str) -> Store:
    """A new table of (pk, v) in the shared folder (or, on a single machine, a temporary one)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="millrace-")
    store = Store(spark, f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    store.create(StructType([StructField("pk", LongType()), StructField("v", DoubleType())]), ["pk"])
    return store


def _loaded(spark, sf_dir, name: str) -> Store:
    store = _store(spark, name)
    store.append(_customers(spark, sf_dir).select(F.col("pk").cast("long").alias("pk"), F.col("v").cast("double").alias("v")), full_load=True)
    return store


def _ops(spark, sf_dir) -> DataFrame:
    """The log of orders as operations on (pk, v)."""
    row = F.struct(F.col("pk").cast("long").alias("pk"), F.col("v").cast("double").alias("v"))
    old, new = F.when(F.col("op") != "I", row), F.when(F.col("op") != "D", row)
    return log_o(spark, sf_dir).select("op", old.alias("old"), new.alias("new"), F.col("seq").alias("pkt_seq"), F.lit(0).alias("row_no"), F.lit(0).alias("sub_no"), F.lit(False).alias("full_load"))


def _applied_to(spark, sf_dir, name: str, **settings) -> Store:
    store = _loaded(spark, sf_dir, name)
    apply.apply_batch(store, _ops(spark, sf_dir), Config(write_mode="transaction", slice_rows=10**9, **settings), "1")
    return store


@query(f"WITH {FOLDED_O} {MIRROR}")
def store_row_delta(spark, sf_dir):
    """A full load and a batch of changes, read through the table's equality deletes."""
    return _applied_to(spark, sf_dir, "row-delta").read()


@query(f"WITH {FOLDED_O} {MIRROR}")
def store_copy_on_write(spark, sf_dir):
    """The same, with the files rewritten that hold a changed key."""
    return _applied_to(spark, sf_dir, "copy-on-write", cow_mode="batch").read()


@query(f"WITH {FOLDED_O} {MIRROR}")
def store_compacted(spark, sf_dir):
    """The same after merging small files, dropping all but the last row of a key, and expiry."""
    store = _applied_to(spark, sf_dir, "compacted")
    maintain.merge_small(store, least=1)
    maintain.compact(store, Config(write_mode="transaction", compact_dedup=True), now_ms=10**15)
    return store.read()


@query(f"WITH {FOLDED_O} {MIRROR}")
def store_expired(spark, sf_dir):
    """The same after pruning all snapshots but the last two."""
    store = _applied_to(spark, sf_dir, "expired")
    store.append(store.read().limit(0))
    maintain.expire(store, now_ms=10**15, keep=2)
    return store.read()


@query("SELECT CAST(c_custkey AS BIGINT) AS pk, CAST(c_acctbal AS DOUBLE) AS v FROM customer")
def store_full_load(spark, sf_dir):
    """Full-load packets as one plain append."""
    ops = _customers(spark, sf_dir).select(F.lit("I").alias("op"), F.lit(None).cast("struct<pk:bigint,v:double>").alias("old"), F.struct(F.col("pk").cast("long").alias("pk"), F.col("v").cast("double").alias("v")).alias("new"), F.col("pk").cast("long").alias("pkt_seq"), F.lit(0).alias("row_no"), F.lit(0).alias("sub_no"), F.lit(True).alias("full_load"))
    store = _store(spark, "full-load")
    apply.apply_batch(store, ops, Config(write_mode="transaction"), "1")
    return store.read()


@query(f"WITH n AS (SELECT *, row_number() OVER (ORDER BY seq) - 1 AS n FROM ({O_SQL})), g AS (SELECT pk, n // 700 AS slice, {FOLD} AS state, arg_max(v, seq) AS v FROM n GROUP BY pk, slice), f AS (SELECT pk, arg_max(state, slice) AS state, arg_max(v, slice) AS v FROM g WHERE state <> 'N' GROUP BY pk) {MIRROR}")
def store_slices(spark, sf_dir):
    """A batch larger than a slice, folded slice by slice."""
    store = _loaded(spark, sf_dir, "slices")
    apply.apply_batch(store, _ops(spark, sf_dir), Config(write_mode="transaction", slice_rows=700), "1")
    return store.read()


# -- metrics and triggers


def _applied(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_type").alias("table"), (F.col("user_id") % 4).alias("worker"), F.col("ts").alias("at"), F.col("event_id").alias("id"), (F.col("event_id") % 3 + 1).alias("rows"))


A_SQL = "SELECT event_type AS \"table\", user_id % 4 AS worker, ts AS done_at, event_id AS id, event_id % 3 + 1 AS rows FROM events"


@query(f'SELECT "table", CAST(sum(rows) AS BIGINT) AS rows FROM ({A_SQL}) GROUP BY 1')
def rows_per_table(spark, sf_dir):
    return metrics.rows_per_table(_applied(spark, sf_dir))


@query(f'SELECT "table", max(done_at) AS last_write FROM ({A_SQL}) GROUP BY 1')
def last_write_per_table(spark, sf_dir):
    return metrics.last_write(_applied(spark, sf_dir))


@query(f"""SELECT "table", at_ms, total, CASE WHEN at_ms - lag(at_ms) OVER w > 0 THEN CAST(floor(greatest(total - lag(total) OVER w, 0) * 1000 / (at_ms - lag(at_ms) OVER w)) AS BIGINT) END AS per_second
FROM (SELECT "table", epoch_ms(CAST(date_trunc('hour', done_at) AS TIMESTAMP)) AS at_ms, CAST(sum(rows) * 3600000 AS BIGINT) AS total FROM ({A_SQL}) GROUP BY 1, 2) WINDOW w AS (PARTITION BY "table" ORDER BY at_ms)""")
def throughput(spark, sf_dir):
    at = F.unix_millis(F.date_trunc("hour", "at").cast("timestamp"))
    samples = _applied(spark, sf_dir).groupBy("table", at.alias("at_ms")).agg((F.sum("rows") * 3_600_000).cast("long").alias("total"))
    return metrics.throughput(samples)


@query(f'SELECT id, (CAST(sum(rows) OVER (PARTITION BY "table", worker ORDER BY id) AS BIGINT) - 1) // 100 AS flush FROM ({A_SQL})')
def flush_trigger_count(spark, sf_dir):
    return metrics.count_flushes(_applied(spark, sf_dir), "id", 100).select("id", "flush")


@query(f"""SELECT id, CAST(sum(gap) OVER (PARTITION BY "table" ORDER BY at_ms, id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS flush FROM
(SELECT *, CASE WHEN at_ms - lag(at_ms) OVER (PARTITION BY "table" ORDER BY at_ms, id) > 600000 THEN 1 ELSE 0 END AS gap FROM (SELECT *, epoch_us(done_at) // 1000 AS at_ms FROM ({A_SQL})))""")
def flush_trigger_idle(spark, sf_dir):
    a = _applied(spark, sf_dir).withColumn("at_ms", F.unix_millis(F.col("at").cast("timestamp")))
    return metrics.idle_flushes(a, "at_ms", 600_000, "id").select("id", "flush")


@query("""SELECT 'nation.' || n_regionkey AS key, n_name AS name, CAST(coalesce(CASE WHEN n_nationkey % 3 <> 0 THEN 2020 + n_nationkey END, 0) AS INTEGER) AS source_type FROM nation""")
def dictionary_merge(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    key = F.concat(F.lit("nation."), F.col("n_regionkey"))
    target = n.select(key.alias("key"), F.col("n_name").alias("name"), F.lit(0).alias("source_type"))
    source = n.where(F.col("n_nationkey") % 3 != 0).select(key.alias("key"), F.col("n_name").alias("name"), (F.col("n_nationkey") + 2020).cast("int").alias("source_type"))
    return dictionary.merged(target, source)
