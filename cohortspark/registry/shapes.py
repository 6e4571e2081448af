"""Reshaping and stacking over whole tables."""

from pyspark.sql import functions as F

from ..operators import reshape
from .base import query
from .standin import load, sources, sql

_FIELDS = ["FirstName", "LastName", "Address1", "Address2", "City", "State", "ZipCode", "Email", "Phone"]
_C1 = ", ".join(f'"Contact1{f}" as "{f}"' for f in _FIELDS)
_C2 = ", ".join(
    f'"Contact2{f}" as "{f}"' if f in ("FirstName", "LastName", "Phone") else f'null as "{f}"' for f in _FIELDS
)


@query(
    "ungroup_column_families",
    sql("subject_info", f"""select "PersonID", 'Contact1' as relation, {_C1} from subject_info
        union all select "PersonID", 'Contact2', {_C2} from subject_info"""),
)
def _(spark, d):
    return reshape.ungroup_column_families(
        sources(spark, d)["subject_info"], "^Contact[0-9]", "relation", ["PersonID"]
    )


@query(
    "unpivot_values",
    """select l_orderkey, l_linenumber, 'l_quantity' as name, cast(l_quantity as varchar) as value from lineitem
    union all select l_orderkey, l_linenumber, 'l_returnflag', l_returnflag from lineitem
    union all select l_orderkey, l_linenumber, 'l_partkey', cast(l_partkey as varchar) from lineitem""",
)
def _(spark, d):
    df = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_partkey")
    return reshape.unpivot_values(df, ["l_orderkey", "l_linenumber"], "name", "value")


def _flags_sql(pred: str) -> str:
    return " union all ".join(
        f"""select "VisitID", '{f}' as vtype from visit_log where "{f}" {pred}""" for f in ("Behavioral", "MEG", "Scan")
    )


@query("unpivot_flags", sql("visit_log", _flags_sql("> 0")))
def _(spark, d):
    return reshape.unpivot_flags(
        sources(spark, d)["visit_log"], ["VisitID"], ["Behavioral", "MEG", "Scan"], "vtype", lambda v: v > 0
    )


@query(
    "unpivot_dynamic_flags",
    sql("visit_study_flags", " union all ".join(
        f"""select "VisitID", '{f}' as study from visit_study_flags where "{f}" = 1"""
        for f in ("AlphaStudy", "BetaStudy", "GammaStudy"))),
)
def _(spark, d):
    return reshape.unpivot_dynamic_flags(
        sources(spark, d)["visit_study_flags"], ["VisitID"], ["PersonID", "VisitDate"], "study"
    )


@query(
    "unpivot_actions",
    sql("visit_log", """select "VisitID", 'ScheduledBy' as action, "ScheduledBy" as value, cast(0 as integer) as col_ord
        from visit_log where "ScheduledBy" <> '' union all
        select "VisitID", 'CheckedInBy', "CheckedInBy", 1 from visit_log where "CheckedInBy" <> ''"""),
)
def _(spark, d):
    return reshape.unpivot_actions(
        sources(spark, d)["visit_log"], ["VisitID"], ["ScheduledBy", "CheckedInBy"], order="col_ord"
    )


@query(
    "collapse_labels",
    sql("visit_log", """select "VisitID", string_agg(vtype, ',' order by o) as vtype from (
        select "VisitID", 0 as o, 'Behavioral' as vtype from visit_log where "Behavioral" > 0 union all
        select "VisitID", 1, 'MEG' from visit_log where "MEG" > 0 union all
        select "VisitID", 2, 'Scan' from visit_log where "Scan" > 0) group by "VisitID" """),
)
def _(spark, d):
    long = reshape.unpivot_flags(
        sources(spark, d)["visit_log"], ["VisitID"], ["Behavioral", "MEG", "Scan"], "vtype", lambda v: v > 0, "o"
    )
    return reshape.collapse_labels(long, ["VisitID"], "vtype", "o", "vtype")


@query(
    "collapsed_flags",
    sql("visit_log", """select "VisitID", nullif(concat_ws(',', case when "Behavioral" > 0 then 'Behavioral' end,
        case when "MEG" > 0 then 'MEG' end, case when "Scan" > 0 then 'Scan' end), '') as vtype from visit_log"""),
)
def _(spark, d):
    return sources(spark, d)["visit_log"].select(
        "VisitID", reshape.collapsed_flags(["Behavioral", "MEG", "Scan"]).alias("vtype")
    )


@query(
    "union_by_name",
    """select c_custkey as id, c_name as label, c_acctbal as balance from customer
    union all select s_suppkey, s_name, s_acctbal from supplier""",
)
def _(spark, d):
    a = load(spark, d, "customer").selectExpr("c_custkey as id", "c_name as label", "c_acctbal as balance")
    b = load(spark, d, "supplier").selectExpr("s_acctbal as balance", "s_name as label", "s_suppkey as id")
    return reshape.union_by_name(a, b)


@query(
    "union_fill_missing",
    """select c_custkey as id, c_mktsegment as segment, null as size, null as value from customer
    union all select p_partkey, null, p_size, null from part
    union all select event_id, null, null, value from events""",
)
def _(spark, d):
    return reshape.union_fill_missing([
        load(spark, d, "customer").selectExpr("c_custkey as id", "c_mktsegment as segment"),
        load(spark, d, "part").selectExpr("p_partkey as id", "p_size as size"),
        load(spark, d, "events").select(F.col("event_id").alias("id"), "value"),
    ])
