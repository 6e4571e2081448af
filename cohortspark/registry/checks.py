"""Constraint checks over whole tables."""

from pyspark.sql import functions as F

from ..operators import quality
from ..schema import STATUS, TABLES
from .base import query
from .standin import domain, load, sql


@query(
    "check_not_null",
    sql("visit", " union all ".join(
        f"select '{c}' as column_name, count(*) filter (where {c} is null) as n_null from visit"
        for c in ("vid", "pid", "vtype", "vscore", "googleuri"))),
)
def _(spark, d):
    return quality.check_not_null(domain(spark, d, "visit")["visit"], ["vid", "pid", "vtype", "vscore", "googleuri"])


@query(
    "check_unique",
    sql("visit", """select pid, vtimestamp, vtype, count(*) as n from visit where pid is not null
        and vtimestamp is not null and vtype is not null group by 1, 2, 3 having count(*) > 1"""),
)
def _(spark, d):
    return quality.check_unique(domain(spark, d, "visit")["visit"], ["pid", "vtimestamp", "vtype"])


@query(
    "check_unique_visit_task",
    sql("visit_task", "select vid, task, count(*) as n from visit_task group by 1, 2 having count(*) > 1"),
)
def _(spark, d):
    return quality.check_unique(domain(spark, d, "visit_task")["visit_task"], ["vid", "task"])


@query(
    "check_foreign_key",
    sql("visit_action", """select vid, count(*) as n from visit_action where vid is not null
        and vid not in (select l_orderkey from lineitem) group by vid"""),
)
def _(spark, d):
    return quality.check_foreign_key(
        domain(spark, d, "visit_action")["visit_action"], "vid", load(spark, d, "lineitem"), "l_orderkey"
    )


@query(
    "orphan_rows",
    "select o_orderkey, o_custkey from orders where o_custkey not in (select s_suppkey from supplier)",
)
def _(spark, d):
    orders = load(spark, d, "orders").select("o_orderkey", "o_custkey")
    return quality.orphan_rows(orders, "o_custkey", load(spark, d, "supplier"), "s_suppkey", ["o_orderkey"])


@query(
    "check_enum_domain",
    "select event_type as value, count(*) as n from events where event_type not in ('sched', 'view', 'click') group by 1",
)
def _(spark, d):
    return quality.check_enum_domain(load(spark, d, "events"), "event_type", ["sched", "view", "click"])


@query(
    "check_length",
    """select 'text' as column_name, count(*) filter (where length(text) > 200) as n_too_long,
        cast(max(length(text)) as integer) as longest from documents
    union all select 'source', count(*) filter (where length(source) > 3), cast(max(length(source)) as integer)
    from documents""",
)
def _(spark, d):
    return quality.check_length(load(spark, d, "documents").select("text", "source"), {"text": 200, "source": 3})


@query(
    "check_numeric_range",
    """select event_id, value from events where value is not null and try_cast(value as decimal(3, 2)) is null""",
)
def _(spark, d):
    return quality.check_numeric_range(load(spark, d, "events").select("event_id", "value"), "value", 3, 2)


_STATUSES = "'" + "','".join(STATUS) + "'"


@query(
    "check_table",
    sql("visit person", f"""select 'visit' as table_name, * from (
        select 'length' as check_name, 'vtype' as subject, count(*) as n_bad from visit where length(vtype) > 20
        union all select 'unique', 'pid,vtimestamp,vtype', (select count(*) from (select 1 from visit
            group by pid, vtimestamp, vtype having count(*) > 1))
        union all select 'not_null', 'pid', count(*) from visit where pid is null
        union all select 'enum', 'vstatus', count(*) from visit where vstatus not in ({_STATUSES})
        union all select 'range', 'vscore', count(*) from visit where vscore is not null
            and try_cast(vscore * 3 as decimal(3, 2)) is null
        union all select 'foreign_key', 'pid->person.pid', count(*) from visit v
            where not exists (select 1 from person p where p.pid = v.pid)) where n_bad > 0"""),
)
def _(spark, d):
    t = domain(spark, d, "visit", "person")
    t["visit"] = t["visit"].withColumn("vscore", F.col("vscore") * 3)
    return quality.check_table("visit", t, TABLES["visit"])


@query(
    "check_tables",
    sql("visit person visit_study note enroll dropcode visit_action visit_enroll visit_task", """
        select * from (
        select 'visit' as table_name, 'unique' as check_name, 'pid,vtimestamp,vtype' as subject, count(*) as n_bad
            from (select 1 from visit group by pid, vtimestamp, vtype having count(*) > 1)
        union all select 'visit_task', 'unique', 'vid,task', count(*)
            from (select 1 from visit_task group by vid, task having count(*) > 1)
        union all select 'visit_task', 'unique', 'vtid', count(*)
            from (select 1 from visit_task group by vtid having count(*) > 1)
        union all select 'person', 'not_null', 'sex', count(*) from person where sex is null
        union all select 'visit_enroll', 'foreign_key', 'vid->visit.vid', count(*) from visit_enroll
            where vid not in (select vid from visit)
        union all select 'visit_enroll', 'foreign_key', 'eid->enroll.eid', count(*) from visit_enroll
            where eid not in (select eid from enroll)
        union all select 'note', 'foreign_key', 'vid->visit.vid', count(*) from note where vid is not null
            and vid not in (select vid from visit)) where n_bad > 0"""),
)
def _(spark, d):
    return quality.check_tables(domain(spark, d))
