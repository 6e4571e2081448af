"""Duplicates, remapping and surrogate keys over whole tables."""

from pyspark.sql import functions as F

from ..operators import identity
from ..session import written
from .base import query
from .standin import load, sources, sql

_NAME = ["nat", "seg"]
_PEOPLE = "select c_custkey as id, c_nationkey as nat, nullif(c_mktsegment, 'BUILDING') as seg from customer"
_FIRST = "min(id) over (partition by nat, seg)"


def _people(spark, d):
    return load(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nat"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"),
    )


def _lookup(spark, d):
    return identity.alias_key_lookup(_people(spark, d), _NAME, "id", ["id"])


@query("keep_first", sql("", f"with p as ({_PEOPLE}) select * from p qualify {_FIRST} = id"))
def _(spark, d):
    return identity.keep_first(_people(spark, d), _NAME, ["id"])


@query(
    "keep_first_all_columns",
    "select distinct l_partkey, l_suppkey, l_returnflag, l_linestatus from lineitem",
)
def _(spark, d):
    return identity.keep_first_all_columns(
        load(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    )


@query(
    "split_duplicates",
    sql("", f"with p as ({_PEOPLE}) select *, case when {_FIRST} = id then 'first' else 'repeat' end as part from p"),
)
def _(spark, d):
    kept, dups = identity.split_duplicates(_people(spark, d), _NAME, "id", ["id"])
    return kept.withColumn("part", F.lit("first")).unionByName(dups.withColumn("part", F.lit("repeat")))


@query(
    "alias_key_lookup",
    sql("", f"with p as (select *, {_FIRST} as use_id from ({_PEOPLE})) select id as dup_id, use_id from p where id <> use_id"),
)
def _(spark, d):
    return _lookup(spark, d)


@query(
    "alias_key_lookup_visits",
    """select dup_id, use_id from (select o_orderkey as dup_id, min(o_orderkey) over (
        partition by o_custkey, o_orderpriority, date_trunc('month', o_orderdate)) as use_id from orders)
    where dup_id <> use_id""",
)
def _(spark, d):
    visits = load(spark, d, "orders").withColumn("month", F.trunc(F.col("o_orderdate").cast("date"), "month"))
    return identity.alias_key_lookup(visits, ["o_custkey", "o_orderpriority", "month"], "o_orderkey", ["o_orderkey"])


@query("reattach_alias_rows", sql("", f"with p as ({_PEOPLE}) select {_FIRST} as id, nat, seg from p"))
def _(spark, d):
    return identity.reattach_alias_rows(_people(spark, d), _NAME, "id", ["id"])


@query(
    "remap_keys",
    sql("", f"""with p as (select *, {_FIRST} as use_id from ({_PEOPLE}))
        select distinct p.use_id as o_custkey, o.o_orderpriority from orders o join p on p.id = o.o_custkey"""),
)
def _(spark, d):
    orders = load(spark, d, "orders").select("o_custkey", "o_orderpriority")
    return identity.remap_keys(orders, written(_lookup(spark, d), "aliases"), "o_custkey", distinct=True)


@query(
    "dense_surrogate_key",
    """select row_number() over (order by o_orderdate, o_orderkey) as pid, o_orderkey, o_orderdate from orders""",
)
def _(spark, d):
    return identity.dense_surrogate_key(
        load(spark, d, "orders").select("o_orderkey", "o_orderdate"), "pid", ["o_orderdate", "o_orderkey"]
    )


@query(
    "offset_surrogate_key",
    """select (select max(o_orderkey) from orders) + row_number() over (order by l_shipdate, l_orderkey, l_linenumber,
        l_partkey, l_suppkey, l_extendedprice) as eid, l_orderkey, l_linenumber from lineitem""",
)
def _(spark, d):
    lines = load(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    keyed = identity.offset_surrogate_key(
        lines, "eid", ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"],
        load(spark, d, "orders"), "o_orderkey",
    )
    return keyed.select("eid", "l_orderkey", "l_linenumber")


@query(
    "keep_first_pasted_names",
    sql("phone_screen", """select "ScreenID", "SubjectFirstName", "SubjectLastName" from phone_screen
        where "SubjectLastName" <> '' qualify row_number() over (
        partition by "SubjectFirstName" || ' ' || "SubjectLastName" order by "ScreenID") = 1"""),
)
def _(spark, d):
    rows = sources(spark, d)["phone_screen"].select("ScreenID", "SubjectFirstName", "SubjectLastName")
    return identity.keep_first(
        rows.where(F.col("SubjectLastName") != ""), ["SubjectFirstName", "SubjectLastName"], ["ScreenID"], faithful=True
    )
