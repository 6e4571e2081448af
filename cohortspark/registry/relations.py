"""Joins, aggregations and per-group picks over whole tables."""

from pyspark.sql import functions as F

from ..functions import codes
from ..operators import aggs, identity, joins
from ..schema import DROP_LEVELS, FIXED_STUDIES
from ..sources.seeds import seed_dimensions
from .base import query
from .reports import _LEVELS
from .standin import domain, load, sources, sql


# Joins -----------------------------------------------------------------------------------


@query(
    "join_common_columns",
    """select l.seg, l.nat, l.id, r.first_id from
        (select nullif(c_mktsegment, 'BUILDING') as seg, c_nationkey as nat, c_custkey as id from customer) l
    join (select nullif(c_mktsegment, 'BUILDING') as seg, c_nationkey as nat, min(c_custkey) as first_id
        from customer group by 1, 2) r
    on l.seg is not distinct from r.seg and l.nat is not distinct from r.nat""",
)
def _(spark, d):
    seg = F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg")
    rows = load(spark, d, "customer").select(seg, F.col("c_nationkey").alias("nat"), F.col("c_custkey").alias("id"))
    first = rows.groupBy("seg", "nat").agg(F.min("id").alias("first_id"))
    return joins.join_common_columns(rows, first, spread_by=["id"])


@query("join_renamed_key", "select o_orderkey, o_custkey, c_name from orders join customer on o_custkey = c_custkey")
def _(spark, d):
    return joins.join_renamed_key(
        load(spark, d, "orders").select("o_orderkey", "o_custkey"),
        load(spark, d, "customer").select("c_custkey", "c_name"),
        "o_custkey", "c_custkey", spread_by=["o_orderkey"],
    )


@query(
    "left_join_lookup",
    """select l.l_orderkey, l.l_linenumber, l.key, p.p_name from
        (select l_orderkey, l_linenumber, case when l_returnflag <> 'N' then l_partkey end as key from lineitem) l
    left join (select nullif(p_partkey, 0) as key, p_name from part) p on l.key is not distinct from p.key""",
)
def _(spark, d):
    key = F.when(F.col("l_returnflag") != "N", F.col("l_partkey")).alias("key")
    facts = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", key)
    lookup = load(spark, d, "part").select(F.nullif("p_partkey", F.lit(0)).alias("key"), "p_name")
    return joins.left_join_lookup(facts, lookup, ["key"], spread_by=["l_orderkey", "l_linenumber"])


@query(
    "anti_join_missing",
    "select o_orderkey, o_custkey from orders where o_orderkey not in (select l_orderkey from lineitem)",
)
def _(spark, d):
    orders = load(spark, d, "orders").select("o_orderkey", "o_custkey")
    lines = load(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.anti_join_missing(orders, lines, ["o_orderkey"])


@query("in_list", "select o_orderkey, o_orderstatus in ('O', 'F') as hit from orders")
def _(spark, d):
    return load(spark, d, "orders").select("o_orderkey", codes.in_list("o_orderstatus", ["O", "F"]).alias("hit"))


@query(
    "not_in_list",
    "select o_orderkey, nullif(o_orderstatus, 'P') not in ('O', 'X') as hit from orders",
)
def _(spark, d):
    status = F.nullif("o_orderstatus", F.lit("P"))
    return load(spark, d, "orders").select("o_orderkey", codes.not_in_list(status, ["O", "X"]).alias("hit"))


@query(
    "natural_join",
    sql("visit visit_study", "select vid, pid, vstatus, study, cohort from visit natural join visit_study"),
)
def _(spark, d):
    t = domain(spark, d, "visit", "visit_study")
    return joins.natural_join(t["visit"].select("vid", "pid", "vstatus"), t["visit_study"], spread_by=["study"])


@query(
    "natural_left_join",
    sql("visit visit_action", """select vid, pid, vstatus, aid, action, ra, vatimestamp
        from visit natural left join visit_action"""),
)
def _(spark, d):
    t = domain(spark, d, "visit", "visit_action")
    return joins.natural_left_join(t["visit"].select("vid", "pid", "vstatus"), t["visit_action"], spread_by=["aid"])


@query(
    "left_join_with_predicate",
    sql("person visit", """select p.pid, p.fname, v.vid, v.vstatus from person p left join visit v
        on v.pid = p.pid and v.vstatus in ('sched', 'checkedin', 'complete')"""),
)
def _(spark, d):
    t = domain(spark, d, "person", "visit")
    return joins.left_join_with_predicate(
        t["person"].select("pid", "fname"), t["visit"].select("vid", "pid", "vstatus"), ["pid"],
        F.col("vstatus").isin("sched", "checkedin", "complete"), spread_by=["vid"],
    )


@query(
    "left_join_on_expression",
    sql("visit visit_study", """select v.vid, v.vtype, n.n_studies from visit v
        left join (select vid, count(*) as n_studies from visit_study group by vid) n on n.vid = v.vid"""),
)
def _(spark, d):
    t = domain(spark, d, "visit", "visit_study")
    view = aggs.tally_groups(t["visit_study"], ["vid"], "n_studies").withColumnRenamed("vid", "key")
    return joins.left_join_on_expression(t["visit"].select("vid", "vtype"), view, {"vid": "key"})


@query(
    "star_join_fanout",
    sql("visit visit_study visit_task visit_action", """select v.vid, count(distinct s.study) as n_studies,
        count(distinct t.task) as n_tasks, count(distinct a.aid) as n_actions, max(a.vatimestamp) as last_action
        from visit v left join visit_study s on s.vid = v.vid left join visit_task t on t.vid = v.vid
        left join visit_action a on a.vid = v.vid group by v.vid"""),
)
def _(spark, d):
    t = domain(spark, d, "visit", "visit_study", "visit_task", "visit_action")
    children = [
        aggs.count_distinct(t["visit_study"], ["vid"], {"n_studies": "study"}),
        aggs.count_distinct(t["visit_task"], ["vid"], {"n_tasks": "task"}),
        t["visit_action"].groupBy("vid").agg(
            F.count(F.lit(1)).alias("n_actions"), F.max("vatimestamp").alias("last_action")
        ),
    ]
    return joins.star_join(t["visit"].select("vid"), children, ["vid"]).na.fill(
        0, ["n_studies", "n_tasks", "n_actions"]
    )


@query(
    "scalar_lookup",
    sql("visit person", "select vid, (select dob from person p where p.pid = v.pid) as dob from visit v"),
)
def _(spark, d):
    t = domain(spark, d, "visit", "person")
    found = joins.scalar_lookup(t["visit"].select("vid", "pid"), t["person"], "pid", "dob", spread_by=["vid"])
    return found.select("vid", "dob")


@query("skew_join", "select o_orderkey, o_custkey, c_name from orders join customer on o_custkey = c_custkey")
def _(spark, d):
    customer = load(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    orders = load(spark, d, "orders").select("o_orderkey", "o_custkey")
    return joins.skew_join(orders, customer, ["o_custkey"], spread_by=["o_orderkey"], min_rows=12)


# Aggregations ----------------------------------------------------------------------------


@query("group_max", sql("note", "select vid, max(ndate) as lastnstamp from note where vid is not null group by vid"))
def _(spark, d):
    note = domain(spark, d, "note")["note"].where("vid is not null")
    return aggs.group_max(note, ["vid"], "ndate", "lastnstamp")


@query("max_text", sql("note", "select pid, max(dropcode) as maxdrop from note group by pid"))
def _(spark, d):
    return aggs.max_text(domain(spark, d, "note")["note"], ["pid"], "dropcode", "maxdrop")


@query(
    "max_ordinal",
    sql("note dropcode", f"""select pid, (select {_LEVELS}[max(list_position({_LEVELS}, x.droplevel))] from note n, dropcode x
        where x.dropcode = n.dropcode and n.pid = k.pid) as maxdrop
        from (select distinct pid from note where dropcode in (select dropcode from dropcode)) k"""),
)
def _(spark, d):
    t = domain(spark, d, "note")
    coded = joins.lookup_join(
        t["note"], seed_dimensions(spark)["dropcode"], ["dropcode"], "inner", spread_by=["nid"]
    )
    return aggs.max_ordinal(coded, ["pid"], "droplevel", DROP_LEVELS, "maxdrop")


@query(
    "conditional_max",
    sql("enroll", "select pid, max(id) filter (where etype = 'PrimaryID') as primary_id from enroll group by pid"),
)
def _(spark, d):
    return aggs.conditional_max(
        domain(spark, d, "enroll")["enroll"], ["pid"], "id", F.col("etype") == "PrimaryID", "primary_id"
    )


@query(
    "filtered_first",
    """select o_custkey, min(cast(o_orderkey as varchar)) filter (where o_orderstatus = 'F') as first_id
    from orders group by o_custkey""",
)
def _(spark, d):
    orders = load(spark, d, "orders").withColumn("id", F.col("o_orderkey").cast("string"))
    return aggs.filtered_first(orders, ["o_custkey"], "id", F.col("o_orderstatus") == "F", "first_id")


@query(
    "json_agg_distinct",
    """select o_custkey, to_json(list_sort(list(distinct nullif(o_orderpriority, '5-LOW')), 'ASC', 'NULLS LAST'))::varchar
    as priorities from orders group by o_custkey""",
)
def _(spark, d):
    return aggs.json_agg_distinct(
        load(spark, d, "orders"), ["o_custkey"], F.nullif("o_orderpriority", F.lit("5-LOW")), "priorities"
    )


@query(
    "json_agg_all",
    """select o_custkey, to_json(list(nullif(o_orderpriority, '5-LOW') order by nullif(o_orderpriority, '5-LOW')
    asc nulls last))::varchar as priorities from orders group by o_custkey""",
)
def _(spark, d):
    return aggs.json_agg_all(
        load(spark, d, "orders"), ["o_custkey"], F.nullif("o_orderpriority", F.lit("5-LOW")), "priorities"
    )


@query(
    "collect_json_array",
    """select conv_id, to_json(list(role order by turn))::varchar as roles from conversations group by conv_id""",
)
def _(spark, d):
    return aggs.collect_json_array(load(spark, d, "conversations"), ["conv_id"], "role", "turn", "roles")


@query(
    "count_distinct",
    sql("visit", """select pid, count(distinct vid) as numvisits, count(distinct vtype) as ntypes,
        count(distinct googleuri) as nuris from visit group by pid"""),
)
def _(spark, d):
    return aggs.count_distinct(
        domain(spark, d, "visit")["visit"], ["pid"], {"numvisits": "vid", "ntypes": "vtype", "nuris": "googleuri"}
    )


@query("tally_groups", sql("visit_task", "select task, count(*) as n from visit_task group by task"))
def _(spark, d):
    return aggs.tally_groups(domain(spark, d, "visit_task")["visit_task"], ["task"])


@query(
    "distinct_values",
    sql("visit_study", """select distinct study from visit_study union select * from
        (values ('SlotReward'), ('RingReward'), ('RewardR21')) as t(study)"""),
)
def _(spark, d):
    return aggs.distinct_values(domain(spark, d, "visit_study")["visit_study"], "study", FIXED_STUDIES)


@query(
    "count_guards",
    sql("visit visit_action visit_enroll visit_task", """select vid,
        (select count(*) from visit_action a where a.vid = v.vid and a.action not in ('sched', 'assigned'))
        + (select count(*) from visit_enroll e where e.vid = v.vid)
        + (select count(*) from visit_task t where t.vid = v.vid) as n_blocking from visit v"""),
)
def _(spark, d):
    t = domain(spark, d, "visit", "visit_action", "visit_enroll", "visit_task")
    acted = t["visit_action"].where(codes.not_in_list("action", ["sched", "assigned"]))
    return aggs.count_guards(t["visit"].select("vid"), [acted, t["visit_enroll"], t["visit_task"]], "vid")


@query("scalar_max", "select max(l_shipdate) as last_ship from lineitem")
def _(spark, d):
    return aggs.scalar_max(load(spark, d, "lineitem"), "l_shipdate", "last_ship")


# Picks per group -------------------------------------------------------------------------


@query(
    "first_per_group",
    sql("person visit", """select p.pid, v.vid, v.vtimestamp from person p left join visit v on v.pid = p.pid
        qualify row_number() over (partition by p.pid order by v.vtimestamp nulls last, v.vid) = 1"""),
)
def _(spark, d):
    t = domain(spark, d, "person", "visit")
    first = identity.first_per_group(
        t["visit"].select("pid", "vid", "vtimestamp"), ["pid"], [F.col("vtimestamp").asc_nulls_last(), F.col("vid")]
    )
    return t["person"].select("pid").join(first, "pid", "left")


@query(
    "latest_per_key",
    sql("visit_action", """select * from visit_action qualify row_number() over (
        partition by vid order by vatimestamp desc nulls first, aid desc) = 1"""),
)
def _(spark, d):
    return identity.latest_per_key(
        domain(spark, d, "visit_action")["visit_action"], ["vid"], "vatimestamp", [F.col("aid").desc()]
    )


@query(
    "left_join_lookup_dimension",
    sql("visit_log disorders", """select v."VisitID", x."Disorder" from visit_log v
        left join disorders x on x."DisorderID" = v."DisorderID" """),
)
def _(spark, d):
    s = sources(spark, d)
    log = s["visit_log"].select("VisitID", "DisorderID")
    return joins.left_join_lookup(log, s["disorders"], ["DisorderID"], spread_by=["VisitID"]).drop("DisorderID")
