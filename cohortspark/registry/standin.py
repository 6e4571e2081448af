"""Domain tables and source tables derived from the given Parquet tables.

Each is written twice: as a Spark frame, and as an SQL common table expression for the check.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from ..operators.jsonpack import pack_row_json
from ..schema import DROP_CODES
from ..sources.layout import Layout
from ..sources.scan import scan_table

AS_OF = "2020-01-01"
LAYOUT = Layout()
MDY = "MM/dd/yy HH:mm:ss"


# Schemas of the given tables, so that opening one starts no job to find its columns.
SCHEMAS = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan_table(spark, sf_dir, name, SCHEMAS[name])


def cases(key: Column, *values) -> Column:
    """The value at position ``key mod len(values)``."""
    return F.get(F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values]), (key % len(values)).cast("int"))


def _mod(c: str, n: int) -> Column:
    return F.col(c) % n


def _div(c: Column, n: int) -> Column:
    return F.floor(c / n)


def _flag(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0)


STATUS_OF = {"F": "complete", "O": "sched", "P": "cancelled"}
ACTION_OF = {
    "signup": "sched", "view": "assigned", "click": "checkedin", "purchase": "complete", "error": "cancelled"
}


def _recode(col: str, mapping: dict) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(F.col(col) == k, v) if out is None else out.when(F.col(col) == k, v)
    return out


def person(spark, d) -> DataFrame:
    k = F.col("c_custkey")
    return load(spark, d, "customer").select(
        k.alias("pid"),
        F.col("c_mktsegment").alias("fname"),
        F.col("c_name").alias("lname"),
        F.date_add(F.lit("1950-01-01").cast("date"), ((k * 37) % 18000).cast("int")).alias("dob"),
        cases(k, None, "U", "M", "F").alias("sex"),
        cases(k, "U", "R", "L", "A").alias("hand"),
        F.date_add(F.lit("2000-01-01").cast("date"), (k % 365).cast("int")).alias("adddate"),
        F.concat(F.lit("src"), F.col("c_nationkey").cast("string")).alias("source"),
    )


def visit(spark, d) -> DataFrame:
    k = F.col("o_orderkey")
    return load(spark, d, "orders").select(
        k.alias("vid"),
        F.col("o_custkey").alias("pid"),
        F.col("o_orderpriority").alias("vtype"),
        F.when(k % 7 != 0, (k % 5).cast("double")).alias("vscore"),
        (k % 4).cast("double").alias("dur_hr"),
        (k % 80).cast("double").alias("age"),
        F.col("o_orderdate").alias("vtimestamp"),
        (k % 9).cast("int").alias("visitno"),
        F.when(k % 10 == 0, F.concat(F.lit("uri"), k.cast("string"))).alias("googleuri"),
        _recode("o_orderstatus", STATUS_OF).alias("vstatus"),
    )


def _lines(spark, d, col: str, *cols: str) -> DataFrame:
    """Order lines with one column of their part; a part may own many lines."""
    line = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *cols)
    part = load(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), col)
    return lookup_join(line, part, ["l_partkey"], "inner", spread_by=["l_orderkey", "l_linenumber"])


def visit_study(spark, d) -> DataFrame:
    both = _lines(spark, d, "p_brand", "l_returnflag")
    return both.groupBy(F.col("l_orderkey").alias("vid"), F.col("p_brand").alias("study")).agg(
        F.min("l_returnflag").alias("cohort")
    )


def visit_task(spark, d) -> DataFrame:
    both = _lines(spark, d, "p_type", "l_quantity", "l_extendedprice", "l_discount", "l_tax").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("vtid"),
        F.col("l_orderkey").alias("vid"),
        F.col("p_type").alias("task"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
    )
    return pack_row_json(both, ["vtid", "vid", "task"])


def visit_action(spark, d) -> DataFrame:
    k = F.col("event_id")
    return load(spark, d, "events").select(
        k.alias("aid"),
        _div(k, 4).alias("vid"),
        _recode("event_type", ACTION_OF).alias("action"),
        F.concat(F.lit("ra"), _mod("user_id", 7).cast("string")).alias("ra"),
        F.when(k % 17 != 0, F.col("ts")).alias("vatimestamp"),
    )


def note(spark, d) -> DataFrame:
    k = F.col("doc_id")
    docs = load(spark, d, "documents").select("doc_id", "source")
    labels = load(spark, d, "labels")
    code = F.when(F.col("toxic") == 1, "BADSUBJ").when(F.col("quality") == 0, "TECH_ISSUE")
    return docs.join(labels, "doc_id", "left").select(
        k.alias("nid"),
        _div(k, 3).alias("pid"),
        F.when(k % 3 != 0, _div(k, 2)).alias("vid"),
        code.when(F.col("quality") == 1, "NOINTEREST").alias("dropcode"),
        F.concat(F.lit("ra"), (k % 5).cast("string")).alias("ra"),
        F.date_add(F.lit("2024-01-01").cast("date"), (k % 20000).cast("int")).cast("timestamp_ntz").alias("ndate"),
        F.col("source").alias("note"),
    )


def enroll(spark, d) -> DataFrame:
    cust = load(spark, d, "customer")
    kind = F.when(F.col("c_mktsegment") == "BUILDING", "OtherID").otherwise("PrimaryID")
    k, s = F.col("c_custkey"), F.col("s_suppkey")
    primary = cust.select(
        (k * 2).alias("eid"), k.alias("pid"), kind.alias("etype"), k.cast("string").alias("id"),
        F.date_add(F.lit("2010-01-01").cast("date"), (k % 1000).cast("int")).alias("edate"),
    )
    scans = load(spark, d, "supplier").select(
        (s * 2 + 1).alias("eid"), s.alias("pid"), F.lit("ScanID").alias("etype"), F.col("s_name").alias("id"),
        F.lit(None).cast("date").alias("edate"),
    )
    return primary.unionByName(scans)


def visit_enroll(spark, d) -> DataFrame:
    s = F.col("s_suppkey")
    return load(spark, d, "supplier").select((s * 2 + 1).alias("eid"), (s * 3).alias("vid"))


DOMAIN = {
    "person": person, "visit": visit, "visit_study": visit_study, "visit_task": visit_task,
    "visit_action": visit_action, "note": note, "enroll": enroll, "visit_enroll": visit_enroll,
}


def domain(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """The named domain tables, by default all."""
    return {n: DOMAIN[n](spark, sf_dir) for n in (names or DOMAIN)}


# Source tables ---------------------------------------------------------------------------


def _birth(k: Column) -> Column:
    day = F.date_add(F.lit("1950-01-01").cast("date"), ((k % 40) * 450).cast("int"))
    return F.date_format(day.cast("timestamp_ntz"), MDY)


def _contacts(k: Column, first: Column, last: Column) -> list[Column]:
    text = k.cast("string")
    return [
        first.alias("Contact1FirstName"),
        last.alias("Contact1LastName"),
        F.concat(F.lit("No "), text).alias("Contact1Address1"),
        F.lit(None).cast("string").alias("Contact1Address2"),
        F.when(k % 3 != 0, F.concat(F.lit("City"), (k % 50).cast("string"))).alias("Contact1City"),
        F.lit("PA").alias("Contact1State"),
        (k % 1000 + 15000).cast("string").alias("Contact1ZipCode"),
        cases(k, F.lit("- -"), F.concat(F.lit("a"), text, F.lit("@x.org")), F.lit(None).cast("string"), F.lit("PA"))
        .alias("Contact1Email"),
        F.concat(F.lit("(412) 555-"), F.lpad((k % 10000).cast("string"), 4, "0")).alias("Contact1Phone"),
        F.when(k % 2 == 0, first).alias("Contact2FirstName"),
        F.lit(None).cast("string").alias("Contact2LastName"),
        F.when(k % 2 == 0, F.lit("()")).otherwise(F.concat(F.lit("412."), text)).alias("Contact2Phone"),
    ]


def subject_info(spark, d) -> DataFrame:
    k = F.col("c_custkey")
    last = F.concat(F.lit("Fam"), F.col("c_nationkey").cast("string"))
    return load(spark, d, "customer").select(
        k.alias("PersonID"),
        F.col("c_mktsegment").alias("SubjectFirstName"),
        last.alias("SubjectLastName"),
        (k % 4 - 1).alias("SexID"),
        cases(k, -1, 1, 2, 3).alias("HandID"),
        _birth(k).alias("DateOfBirth"),
        cases(k, 1, 0, None, 0, 0).alias("Dropped"),
        cases(k, F.lit(""), F.lit(None).cast("string"), F.col("c_name")).alias("Notes"),
        *_contacts(k, F.col("c_mktsegment"), last),
    )


def phone_screen(spark, d) -> DataFrame:
    k = F.col("s_suppkey")
    last = cases(k, F.lit(""), F.lit(None).cast("string"), *[F.concat(F.lit("Fam"), F.col("s_nationkey").cast("string"))] * 8)
    first = cases(k, "MACHINERY", "BUILDING", "NEW")
    return load(spark, d, "supplier").select(
        k.alias("ScreenID"),
        first.alias("SubjectFirstName"),
        last.alias("SubjectLastName"),
        (k % 4 - 1).alias("SexID"),
        cases(k, -1, 1, 2, 3).alias("HandID"),
        _birth(k).alias("DateOfBirth"),
        cases(k, 1, 0, None, 0, 0).alias("Dropped"),
        F.col("s_name").alias("Notes"),
        *_contacts(k, first, last),
    )


def _month(c: str) -> Column:
    return F.date_format(F.trunc(F.col(c).cast("date"), "month").cast("timestamp_ntz"), MDY)


def visit_log(spark, d) -> DataFrame:
    k = F.col("o_orderkey")
    text = k.cast("string")
    none = F.lit(None).cast("string")
    return load(spark, d, "orders").select(
        k.alias("VisitID"),
        F.col("o_custkey").alias("PersonID"),
        _month("o_orderdate").alias("VisitDate"),
        cases(k, none, F.lit("12/30/99 13:15:00")).alias("VisitTime"),
        cases(k, 1, 0, None).alias("Behavioral"),
        cases(k, 0, 1, 1).alias("MEG"),
        cases(k, 0, 1, 0).alias("Scan"),
        cases(
            k, F.lit(""), none, F.concat(F.lit("x"), (k % 9).cast("string"), F.lit(" ok")),
            F.concat(F.lit("scan x"), (k % 30).cast("string"), F.lit(" 4.5/5")), F.lit("good 4"), F.lit("a4 max3"),
            F.concat(F.lit("10/5 on "), text),
        ).alias("Notes"),
        (k % 6).cast("int").alias("DisorderID"),
        cases(k, 0, 1).alias("Diagnosed"),
        cases(k, 0, 1, 1, 0, None).alias("Control"),
        cases(k, 1, 0, None, 0).alias("Dropped"),
        cases(k, F.lit(""), none, *[F.concat(F.lit("1dom\\user"), (k % 7).cast("string"))] * 3).alias("ScheduledBy"),
        cases(k, F.lit(""), none, F.concat(F.lit("user"), (k % 4).cast("string"))).alias("CheckedInBy"),
    )


def visit_study_flags(spark, d) -> DataFrame:
    k = F.col("o_orderkey")
    return load(spark, d, "orders").select(
        k.alias("VisitID"), F.col("o_custkey").alias("PersonID"), _month("o_orderdate").alias("VisitDate"),
        cases(k, 0, 1).alias("AlphaStudy"), cases(k, 1, 0, 0).alias("BetaStudy"),
        cases(k, 1, 0, None, 2, 0).alias("GammaStudy"),
    )


def disorders(spark, d) -> DataFrame:
    k = F.col("r_regionkey")
    name = F.when(k == 0, "None").when(k == 1, "control").otherwise(F.col("r_name"))
    return load(spark, d, "region").select(k.alias("DisorderID"), name.alias("Disorder"))


def scan_ids(spark, d) -> DataFrame:
    k = F.col("o_orderkey")
    return load(spark, d, "orders").select(
        k.alias("VisitID"), F.concat(F.lit("S"), k.cast("string")).alias("ScanID"),
        F.col("o_custkey").alias("PersonID"), _month("o_orderdate").alias("VisitDate"),
    )


def tasks(spark, d) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    flags = ["Cannabis", "MEGEmo", "CogR01", "RewardR01", "EBS", "PVL", "SlotReward", "RingReward"]
    return load(spark, d, "part").select(
        F.when(k == 0, "Line").otherwise(F.concat(F.lit("T"), k.cast("string"))).alias("Task"),
        F.concat(F.lit("d"), k.cast("string")).alias("TableName"),
        (size % 2).alias("Behavioral"),
        _flag(size % 3 == 0).alias("Scan"),
        F.when(size % 7 != 0, _flag(size % 5 == 0)).alias("MEG"),
        _flag(size % 11 == 0).alias("Questionnaire"),
        *[_flag((k + i) % (i + 3) == 0).alias(f) for i, f in enumerate(flags)],
    )


def d_line(spark, d) -> DataFrame:
    return load(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("VisitID"), F.col("l_suppkey").alias("PersonID"),
        F.col("l_shipdate").alias("VisitDate"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
        F.when(F.col("l_returnflag") != "N", F.col("l_discount")).alias("discount"),
        F.col("l_returnflag").alias("flag"),
    )


def d_order(spark, d) -> DataFrame:
    return load(spark, d, "orders").select(
        F.col("o_orderkey").alias("VisitID"), F.col("o_custkey").alias("PersonID"),
        F.col("o_orderdate").alias("VisitDate"),
        F.col("o_totalprice").alias("total"), F.col("o_orderpriority").alias("priority"),
    )


def d_event(spark, d) -> DataFrame:
    return load(spark, d, "events").select(
        _div(F.col("event_id"), 4).alias("VisitID"), F.col("user_id").alias("PersonID"), F.col("ts").alias("VisitDate"),
        F.col("event_type").alias("kind"), F.col("value"),
    )


SOURCE = {
    "subject_info": subject_info, "phone_screen": phone_screen, "visit_log": visit_log,
    "visit_study_flags": visit_study_flags, "disorders": disorders, "scan_ids": scan_ids, "tasks": tasks,
    "dLine": d_line, "dOrder": d_order, "dEvent": d_event,
}


class sources(Mapping):
    """The source tables by name, each opened when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._open = lru_cache(lambda name: SOURCE[name](spark, sf_dir))

    def __getitem__(self, name: str) -> DataFrame:
        return self._open(name)

    def __iter__(self):
        return iter(SOURCE)

    def __len__(self) -> int:
        return len(SOURCE)


# The same in SQL -------------------------------------------------------------------------


def _pick(key: str, *values: str) -> str:
    whens = " ".join(f"when {i} then {v}" for i, v in enumerate(values))
    return f"case ({key}) % {len(values)} {whens} end"


def _sql_birth(k: str) -> str:
    return f"strftime(date '1950-01-01' + cast(({k} % 40) * 450 as integer), '%m/%d/%y %H:%M:%S')"


def _sql_contacts(k: str, first: str, last: str) -> str:
    email = _pick(k, "'- -'", f"'a' || {k} || '@x.org'", "cast(null as varchar)", "'PA'")
    return f"""
      {first} as "Contact1FirstName", {last} as "Contact1LastName",
      'No ' || {k} as "Contact1Address1", cast(null as varchar) as "Contact1Address2",
      case when {k} % 3 <> 0 then 'City' || ({k} % 50) end as "Contact1City", 'PA' as "Contact1State",
      cast({k} % 1000 + 15000 as varchar) as "Contact1ZipCode", {email} as "Contact1Email",
      '(412) 555-' || lpad(cast({k} % 10000 as varchar), 4, '0') as "Contact1Phone",
      case when {k} % 2 = 0 then {first} end as "Contact2FirstName", cast(null as varchar) as "Contact2LastName",
      case when {k} % 2 = 0 then '()' else '412.' || {k} end as "Contact2Phone" """


_MONTH = "strftime(date_trunc('month', o_orderdate), '%m/%d/%y %H:%M:%S')"
_FAM = "'Fam' || c_nationkey"
_SLAST = _pick("s_suppkey", "''", "null", *["'Fam' || s_nationkey"] * 8)
_SFIRST = _pick("s_suppkey", "'MACHINERY'", "'BUILDING'", "'NEW'")
_CODE = "case when toxic = 1 then 'BADSUBJ' when quality = 0 then 'TECH_ISSUE' when quality = 1 then 'NOINTEREST' end"
_FLAGS = ["Cannabis", "MEGEmo", "CogR01", "RewardR01", "EBS", "PVL", "SlotReward", "RingReward"]


def _sql_map(col: str, mapping: dict) -> str:
    return f"case {col} " + " ".join(f"when '{k}' then '{v}'" for k, v in mapping.items()) + " end"


CTE = {
    "person": f"""select c_custkey as pid, c_mktsegment as fname, c_name as lname,
        date '1950-01-01' + cast((c_custkey * 37) % 18000 as integer) as dob,
        {_pick("c_custkey", "null", "'U'", "'M'", "'F'")} as sex,
        {_pick("c_custkey", "'U'", "'R'", "'L'", "'A'")} as hand,
        date '2000-01-01' + cast(c_custkey % 365 as integer) as adddate, 'src' || c_nationkey as source
        from customer""",
    "visit": f"""select o_orderkey as vid, o_custkey as pid, o_orderpriority as vtype,
        case when o_orderkey % 7 <> 0 then cast(o_orderkey % 5 as double) end as vscore,
        cast(o_orderkey % 4 as double) as dur_hr, cast(o_orderkey % 80 as double) as age,
        o_orderdate as vtimestamp, cast(o_orderkey % 9 as integer) as visitno,
        case when o_orderkey % 10 = 0 then 'uri' || o_orderkey end as googleuri,
        {_sql_map("o_orderstatus", STATUS_OF)} as vstatus from orders""",
    "visit_study": """select l_orderkey as vid, p_brand as study, min(l_returnflag) as cohort
        from lineitem join part on l_partkey = p_partkey group by 1, 2""",
    "visit_task": """select l_orderkey * 10 + l_linenumber as vtid, l_orderkey as vid, p_type as task,
        to_json({'quantity': l_quantity, 'price': l_extendedprice, 'discount': l_discount, 'tax': l_tax})::varchar
        as measures from lineitem join part on l_partkey = p_partkey""",
    "visit_action": f"""select event_id as aid, event_id // 4 as vid, {_sql_map("event_type", ACTION_OF)} as action,
        'ra' || (user_id % 7) as ra, case when event_id % 17 <> 0 then ts end as vatimestamp from events""",
    "note": f"""select d.doc_id as nid, d.doc_id // 3 as pid,
        case when d.doc_id % 3 <> 0 then d.doc_id // 2 end as vid, {_CODE} as dropcode,
        'ra' || (d.doc_id % 5) as ra,
        cast(date '2024-01-01' + cast(d.doc_id % 20000 as integer) as timestamp) as ndate, d.source as note
        from documents d left join labels l on l.doc_id = d.doc_id""",
    "enroll": """select c_custkey * 2 as eid, c_custkey as pid,
        case when c_mktsegment = 'BUILDING' then 'OtherID' else 'PrimaryID' end as etype, cast(c_custkey as varchar) as id,
        date '2010-01-01' + cast(c_custkey % 1000 as integer) as edate from customer
        union all select s_suppkey * 2 + 1, s_suppkey, 'ScanID', s_name, null from supplier""",
    "visit_enroll": "select s_suppkey * 2 + 1 as eid, s_suppkey * 3 as vid from supplier",
    "dropcode": "select * from (values " + ", ".join(f"('{c}', '{level}')" for c, level in DROP_CODES)
    + ") as t(dropcode, droplevel)",
    "subject_info": f"""select c_custkey as "PersonID", c_mktsegment as "SubjectFirstName", {_FAM} as "SubjectLastName",
        c_custkey % 4 - 1 as "SexID", {_pick("c_custkey", "-1", "1", "2", "3")} as "HandID",
        {_sql_birth("c_custkey")} as "DateOfBirth", {_pick("c_custkey", "1", "0", "null", "0", "0")} as "Dropped",
        {_pick("c_custkey", "''", "null", "c_name")} as "Notes",
        {_sql_contacts("c_custkey", "c_mktsegment", _FAM)} from customer""",
    "phone_screen": f"""select s_suppkey as "ScreenID", {_SFIRST} as "SubjectFirstName", {_SLAST} as "SubjectLastName",
        s_suppkey % 4 - 1 as "SexID", {_pick("s_suppkey", "-1", "1", "2", "3")} as "HandID",
        {_sql_birth("s_suppkey")} as "DateOfBirth", {_pick("s_suppkey", "1", "0", "null", "0", "0")} as "Dropped",
        s_name as "Notes", {_sql_contacts("s_suppkey", _SFIRST, _SLAST)} from supplier""",
    "visit_log": f"""select o_orderkey as "VisitID", o_custkey as "PersonID", {_MONTH} as "VisitDate",
        {_pick("o_orderkey", "null", "'12/30/99 13:15:00'")} as "VisitTime",
        {_pick("o_orderkey", "1", "0", "null")} as "Behavioral", {_pick("o_orderkey", "0", "1", "1")} as "MEG",
        {_pick("o_orderkey", "0", "1", "0")} as "Scan",
        {_pick("o_orderkey", "''", "null", "'x' || (o_orderkey % 9) || ' ok'",
               "'scan x' || (o_orderkey % 30) || ' 4.5/5'", "'good 4'", "'a4 max3'", "'10/5 on ' || o_orderkey")} as "Notes",
        cast(o_orderkey % 6 as integer) as "DisorderID", {_pick("o_orderkey", "0", "1")} as "Diagnosed",
        {_pick("o_orderkey", "0", "1", "1", "0", "null")} as "Control",
        {_pick("o_orderkey", "1", "0", "null", "0")} as "Dropped",
        {_pick("o_orderkey", "''", "null", *["'1dom' || chr(92) || 'user' || (o_orderkey % 7)"] * 3)} as "ScheduledBy",
        {_pick("o_orderkey", "''", "null", "'user' || (o_orderkey % 4)")} as "CheckedInBy" from orders""",
    "visit_study_flags": f"""select o_orderkey as "VisitID", o_custkey as "PersonID", {_MONTH} as "VisitDate",
        {_pick("o_orderkey", "0", "1")} as "AlphaStudy", {_pick("o_orderkey", "1", "0", "0")} as "BetaStudy",
        {_pick("o_orderkey", "1", "0", "null", "2", "0")} as "GammaStudy" from orders""",
    "disorders": """select r_regionkey as "DisorderID", case r_regionkey when 0 then 'None' when 1 then 'control'
        else r_name end as "Disorder" from region""",
    "scan_ids": f"""select o_orderkey as "VisitID", 'S' || o_orderkey as "ScanID", o_custkey as "PersonID",
        {_MONTH} as "VisitDate" from orders""",
    "tasks": """select case p_partkey when 0 then 'Line' else 'T' || p_partkey end as "Task",
        'd' || p_partkey as "TableName",
        p_size % 2 as "Behavioral", case when p_size % 3 = 0 then 1 else 0 end as "Scan",
        case when p_size % 7 <> 0 then case when p_size % 5 = 0 then 1 else 0 end end as "MEG",
        case when p_size % 11 = 0 then 1 else 0 end as "Questionnaire", """
    + ", ".join(f'case when (p_partkey + {i}) % {i + 3} = 0 then 1 else 0 end as "{f}"' for i, f in enumerate(_FLAGS))
    + " from part",
    "d_line": """select l_orderkey as "VisitID", l_quantity as quantity, l_extendedprice as price,
        case when l_returnflag <> 'N' then l_discount end as discount, l_returnflag as flag from lineitem""",
    "d_order": """select o_orderkey as "VisitID", o_totalprice as total, o_orderpriority as priority from orders""",
    "d_event": """select event_id // 4 as "VisitID", event_type as kind, value from events""",
}


def sql(needs: str, body: str, **more: str) -> str:
    """``body`` after the named table expressions; ``more`` adds expressions of the query's own."""
    parts = [f"{n} as ({CTE[n]})" for n in needs.split()] + [f"{n} as ({q})" for n, q in more.items()]
    recursive = "recursive " if any(f"from {n} " in q for n, q in more.items()) else ""
    return f"with {recursive}{', '.join(parts)} {body}" if parts else body
