"""Reading and writing tables. What is read back is compared with what was written."""

from pyspark.sql import functions as F

from ..operators import project
from ..session import new_path
from ..sources import scan, snapshot
from ..sources.seeds import seed_dimensions
from .base import query
from .standin import domain, load, sql


@query("scan_table", "select o_orderkey, o_custkey, o_orderkey as row_pos from orders")
def _(spark, d):
    df = scan.scan_table(spark, d, "orders", with_order=True)
    return df.select("o_orderkey", "o_custkey", F.col("_src_ord.row").alias("row_pos"))


@query(
    "scan_matching_tables",
    """select 'customer' as table_name, count(*) as n from customer union all select 'conversations', count(*)
    from conversations union all select 'part', count(*) from part union all select 'pages', count(*) from pages""",
)
def _(spark, d):
    found = scan.scan_matching_tables(spark, d, "^[cp]")
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("table_name"), "n") for n, df in found.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.union(c)
    return out


@query("exclude_keys", "select o_orderkey, o_custkey from orders where o_orderkey not in (3, 418)")
def _(spark, d):
    return project.exclude_keys(load(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", [3, 418])


def _bundle(spark, d):
    return {"customer": load(spark, d, "customer"), "orders": load(spark, d, "orders")}


def _counts(tables):
    o = tables["orders"].groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), F.max("o_orderdate").alias("last_order")
    )
    c = tables["customer"].select("c_custkey", "c_name")
    return c.join(o, F.col("c_custkey") == F.col("o_custkey"), "left").drop("o_custkey")


_COUNTS = """select c_custkey, c_name, n_orders, last_order from customer left join (select o_custkey,
    count(*) {} as n_orders, max(o_orderdate) as last_order from orders group by 1) on o_custkey = c_custkey"""


@query("write_snapshot", _COUNTS.format(""))
def _(spark, d):
    base = new_path(spark, "snapshot")
    snapshot_id = snapshot.write_snapshot(_bundle(spark, d), base)
    folder = f"{base}/data/{snapshot_id}"
    return _counts({n: spark.read.parquet(f"{folder}/{n}") for n in ("customer", "orders")})


@query("load_snapshot", _COUNTS.format(""))
def _(spark, d):
    base = new_path(spark, "snapshot")
    snapshot.write_snapshot({n: df.where(F.lit(False)) for n, df in _bundle(spark, d).items()}, base)
    snapshot.write_snapshot(_bundle(spark, d), base)
    return _counts(snapshot.load_snapshot(spark, base))


@query("append_tables", _COUNTS.format("* 2"))
def _(spark, d):
    base = new_path(spark, "snapshot")
    tables = _bundle(spark, d)
    snapshot.write_snapshot(tables, base)
    swapped = tables["orders"].select(*reversed(tables["orders"].columns))
    snapshot.append_tables({"orders": swapped}, base)
    return _counts(snapshot.load_snapshot(spark, base))


@query("replace_snapshot", _COUNTS.format(""))
def _(spark, d):
    src, dst = new_path(spark, "source"), new_path(spark, "serving")
    snapshot.write_snapshot(_bundle(spark, d), src)
    snapshot.write_snapshot({n: df.where(F.lit(False)) for n, df in _bundle(spark, d).items()}, dst)
    snapshot.replace_snapshot(spark, src, dst)
    return _counts(snapshot.load_snapshot(spark, dst))


@query("freshness_marker", "select max(ts) as last_update from events")
def _(spark, d):
    return snapshot.freshness_marker(load(spark, d, "events"), "ts")


@query(
    "seed_dimensions",
    sql("dropcode note", """select c.dropcode, c.droplevel, count(n.nid) as n_notes from dropcode c
        left join note n on n.dropcode = c.dropcode group by 1, 2"""),
)
def _(spark, d):
    codes = seed_dimensions(spark)["dropcode"].select("dropcode", "droplevel")
    used = domain(spark, d, "note")["note"].groupBy("dropcode").agg(F.count("nid").alias("n"))
    return codes.join(used, "dropcode", "left").select(
        "dropcode", "droplevel", F.coalesce("n", F.lit(0)).alias("n_notes")
    )
