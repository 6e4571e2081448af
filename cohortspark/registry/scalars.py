"""Projections, filters and scalar functions over whole tables."""

from pyspark.sql import functions as F

from ..functions import codes, dates, text
from ..operators import project
from ..operators.joins import lookup_join
from .base import query
from .standin import AS_OF, domain, load, sources, sql


@query("project_rename", "select s_suppkey as id, s_name as label, s_acctbal as balance from supplier")
def _(spark, d):
    return project.project_rename(
        load(spark, d, "supplier"), {"id": "s_suppkey", "label": "s_name", "balance": "s_acctbal"}
    )


@query(
    "select_columns_matching",
    sql("subject_info", """select "PersonID", "Contact1City", "Contact1Email", "Contact1Phone", "Contact1ZipCode",
        "Contact1State", "Contact1FirstName", "Contact1LastName", "Contact1Address1", "Contact1Address2"
        from subject_info"""),
)
def _(spark, d):
    df = project.select_columns_matching(sources(spark, d)["subject_info"], "contact.*", keep=["PersonID"])
    return project.select_columns_matching(df, "^contact2", invert=True)


@query(
    "tag_source",
    "select c_custkey, 'subj' as origin, 'checkedin' as status, cast(0 as integer) as version from customer",
)
def _(spark, d):
    df = load(spark, d, "customer").select("c_custkey")
    return project.tag_source(df, origin="subj", status="checkedin", version=0)


@query(
    "cast_all_to_string",
    """select cast(p_partkey as varchar) as p_partkey, p_name, p_brand, p_type, cast(p_size as integer) as p_size
    from part""",
)
def _(spark, d):
    return project.cast_all_to_string(load(spark, d, "part").drop("p_retailprice"), {"p_size": "int"})


@query(
    "filter_nonblank",
    sql("phone_screen", """select "ScreenID", "SubjectFirstName", "SubjectLastName" from phone_screen
        where "SubjectFirstName" <> '' and "SubjectLastName" <> ''"""),
)
def _(spark, d):
    df = sources(spark, d)["phone_screen"].select("ScreenID", "SubjectFirstName", "SubjectLastName")
    return project.filter_nonblank(df, ["SubjectFirstName", "SubjectLastName"])


@query(
    "filter_three_valued",
    sql("visit_log", """select "VisitID", "Dropped", "Notes" from visit_log where "Notes" <> '' or "Dropped" <> 0"""),
)
def _(spark, d):
    return project.filter_three_valued(sources(spark, d)["visit_log"].select("VisitID", "Dropped", "Notes"))


@query(
    "parse_mdy_timestamp",
    """with t as (select o_orderkey, case when o_orderkey % 13 = 0 then 'not a date'
            when o_orderkey % 2 = 0 then strftime(old, '%-m/%-d/%Y %-H:%-M:%-S')
            else strftime(old, '%m/%d/%y %H:%M:%S') end as x
        from (select o_orderkey, case when o_orderkey % 3 = 0 then o_orderdate - interval 30 year
            else o_orderdate end as old from orders))
    select o_orderkey, case when regexp_matches(x, '/[0-9]{4} ') then try_strptime(x, '%m/%d/%Y %H:%M:%S')
        else try_strptime(x, '%m/%d/%y %H:%M:%S') end as parsed from t""",
)
def _(spark, d):
    key, ts = F.col("o_orderkey"), F.col("o_orderdate")
    old = F.when(key % 3 == 0, ts - F.make_ym_interval(F.lit(30))).otherwise(ts)
    long_year = F.date_format(old, "M/d/yyyy H:m:s")
    short_year = F.date_format(old, "MM/dd/yy HH:mm:ss")
    written = F.when(key % 13 == 0, "not a date").when(key % 2 == 0, long_year).otherwise(short_year)
    return load(spark, d, "orders").select("o_orderkey", dates.parse_mdy_timestamp(written).alias("parsed"))


@query(
    "correct_future_date",
    sql("subject_info", f"""select "PersonID", cast(case when b > timestamp '{AS_OF}' + interval 730 day + interval 12 hour
            then b - interval 36525 day else b end as date) as dob
        from (select "PersonID", strptime("DateOfBirth", '%m/%d/%y %H:%M:%S') as b from subject_info)"""),
)
def _(spark, d):
    parsed = dates.parse_mdy_timestamp("DateOfBirth")
    return sources(spark, d)["subject_info"].select(
        "PersonID", dates.correct_future_date(parsed, AS_OF).cast("date").alias("dob")
    )


@query(
    "bin_code",
    sql("subject_info", """select "PersonID", case when "SexID" > -1 and "SexID" <= 0 then 'U'
        when "SexID" > 0 and "SexID" <= 1 then 'M' when "SexID" > 1 and "SexID" <= 2 then 'F' end as sex
        from subject_info"""),
)
def _(spark, d):
    return sources(spark, d)["subject_info"].select("PersonID", codes.bin_code("SexID").alias("sex"))


@query(
    "map_code_labels",
    sql("subject_info", """select "PersonID", case "HandID" when -1 then 'U' when 1 then 'R' when 2 then 'L'
        when 3 then 'A' end as hand from subject_info"""),
)
def _(spark, d):
    return sources(spark, d)["subject_info"].select("PersonID", codes.map_code_labels("HandID").alias("hand"))


@query(
    "combine_date_time",
    """select event_id, date_trunc('day', ts) + case when event_id % 4 = 0 then interval 0 hour
        else ts - date_trunc('day', ts) end as stamp from events""",
)
def _(spark, d):
    clock = F.when(F.col("event_id") % 4 != 0, F.col("ts") - F.make_dt_interval(days=F.lit(40000)))
    return load(spark, d, "events").select("event_id", dates.combine_date_time("ts", clock).alias("stamp"))


_VISIT_DOB = "select v.vid, {} as age from visit v join person p on p.pid = v.pid"


def _with_dob(spark, d):
    t = domain(spark, d, "visit", "person")
    return lookup_join(
        t["visit"].select("vid", "pid", "vtimestamp"), t["person"].select("pid", "dob"), ["pid"], "inner",
        spread_by=["vid"],
    )


@query(
    "age_years_exact",
    sql("visit person", _VISIT_DOB.format("date_diff('day', p.dob, cast(v.vtimestamp as date)) / 365.25")),
)
def _(spark, d):
    return _with_dob(spark, d).select("vid", dates.age_years_exact("vtimestamp", "dob").alias("age"))


@query(
    "age_years_whole_days",
    sql("visit person", _VISIT_DOB.format("date_part('day', v.vtimestamp - p.dob) / 365.25")),
)
def _(spark, d):
    return _with_dob(spark, d).select("vid", dates.age_years_whole_days("vtimestamp", "dob").alias("age"))


@query(
    "current_age",
    sql("person", f"select pid, date_part('day', timestamp '{AS_OF}' - dob) / 365.25 as curage from person"),
)
def _(spark, d):
    return domain(spark, d, "person")["person"].select("pid", dates.current_age("dob", AS_OF).alias("curage"))


@query(
    "current_age_floor",
    sql("person", f"""select pid, cast(floor(date_part('day', timestamp '{AS_OF}' - dob) / 365.25) as double)
        as curagefloor from person"""),
)
def _(spark, d):
    return domain(spark, d, "person")["person"].select(
        "pid", dates.current_age_floor("dob", AS_OF).alias("curagefloor")
    )


@query(
    "extract_visit_number",
    sql("visit_log", """select "VisitID", try_cast(replace(nullif(regexp_extract("Notes", '(^| )x[0-9]+'), ''), 'x', '')
        as integer) as visitno from visit_log"""),
)
def _(spark, d):
    return sources(spark, d)["visit_log"].select("VisitID", text.extract_visit_number("Notes").alias("visitno"))


@query(
    "extract_score",
    sql("visit_log", r"""select "VisitID", try_cast(replace(nullif(regexp_extract("Notes",
        '([^0-9-]|^)[0-5](\.[0-9])?(/5)?$|[0-5](\.[0-9])?/5'), ''), '/5', '') as double) as vscore from visit_log"""),
)
def _(spark, d):
    return sources(spark, d)["visit_log"].select(
        "VisitID", text.extract_score("Notes").cast("double").alias("vscore")
    )


_ADDRESS = ["Address1", "Address2", "City", "State", "ZipCode"]
_JOINED = "concat_ws(' ', " + ", ".join(f"""coalesce("Contact1{c}", 'NA')""" for c in _ADDRESS) + ")"


@query("concat_fields", sql("subject_info", f'select "PersonID", {_JOINED} as address from subject_info'))
def _(spark, d):
    return sources(spark, d)["subject_info"].select(
        "PersonID", text.concat_fields([f"Contact1{c}" for c in _ADDRESS]).alias("address")
    )


@query(
    "clean_joined_text",
    sql("subject_info", f"""select "PersonID", regexp_replace(regexp_replace(regexp_replace({_JOINED},
        '(^| )NA( |$)', ' ', 'g'), ' +', ' ', 'g'), '^ ?PA ?$', '', 'g') as address from subject_info"""),
)
def _(spark, d):
    joined = text.concat_fields([f"Contact1{c}" for c in _ADDRESS])
    return sources(spark, d)["subject_info"].select("PersonID", text.clean_joined_text(joined).alias("address"))


@query(
    "digits_only_if",
    sql("subject_info", """select "PersonID", 'HomePhone' as ctype,
            regexp_replace("Contact1Phone", '[^0-9]', '', 'g') as cvalue from subject_info
        union all select "PersonID", 'Email', "Contact1Email" from subject_info"""),
)
def _(spark, d):
    df = sources(spark, d)["subject_info"].select(
        "PersonID", F.col("Contact1Phone").alias("HomePhone"), F.col("Contact1Email").alias("Email")
    )
    long = df.unpivot(["PersonID"], ["HomePhone", "Email"], "ctype", "cvalue")
    return long.withColumn("cvalue", text.digits_only_if("cvalue", "ctype"))


@query(
    "filter_blank_values",
    sql("subject_info", """select "PersonID", "Contact1Email" as cvalue from subject_info
        where not regexp_matches("Contact1Email", '^[-() ,]*$')"""),
)
def _(spark, d):
    df = sources(spark, d)["subject_info"].select("PersonID", F.col("Contact1Email").alias("cvalue"))
    return project.filter_blank_values(df, "cvalue")


_COHORT = """case when l = '' then 'control' else l end from (select "VisitID", replace(regexp_replace(
    coalesce(replace("Disorder", 'None', ''), 'NA') || '_' || case when "Control" is null then 'NA'
    when "Control" = 1 then 'control' else '' end, '^_|_$', '', 'g'), 'control_control', 'control') as l
    from visit_log v left join disorders x on x."DisorderID" = v."DisorderID")"""


@query("build_cohort_label", sql("visit_log disorders", f'select "VisitID", {_COHORT}'.replace(
    'end from', 'end as cohort from', 1)))
def _(spark, d):
    s = sources(spark, d)
    log = s["visit_log"].select("VisitID", "DisorderID", "Control")
    both = lookup_join(log, s["disorders"], ["DisorderID"], "left", spread_by=["VisitID"])
    disorder = F.replace("Disorder", F.lit("None"), F.lit(""))
    return both.select("VisitID", text.build_cohort_label(disorder, "Control").alias("cohort"))


@query(
    "strip_domain_prefix",
    sql("visit_log", r"""select "VisitID", regexp_replace("ScheduledBy", '.*\\', '') as ra from visit_log"""),
)
def _(spark, d):
    return sources(spark, d)["visit_log"].select("VisitID", text.strip_domain_prefix("ScheduledBy").alias("ra"))


@query(
    "strip_table_prefix",
    sql("tasks", """select "Task", regexp_replace("TableName", '^d', '') as task_table from tasks"""),
)
def _(spark, d):
    return sources(spark, d)["tasks"].select("Task", text.strip_table_prefix("TableName").alias("task_table"))


@query(
    "default_when_all_blank",
    sql("visit_log", """select "VisitID", case when coalesce("ScheduledBy", '') || coalesce("CheckedInBy", '') = ''
        then 'OLDDB' else "CheckedInBy" end as checkedin from visit_log"""),
)
def _(spark, d):
    filled = text.default_when_all_blank(["ScheduledBy", "CheckedInBy"], "CheckedInBy", "OLDDB")
    return sources(spark, d)["visit_log"].select("VisitID", filled.alias("checkedin"))


@query(
    "classify_drop",
    sql("visit_log", """select "VisitID", case when "Dropped" <> 0 then case when "VisitID" % 3 = 0
        then 'OLDDBDSUBJ' else 'OLDDBDVIST' end end as dropcode from visit_log"""),
)
def _(spark, d):
    vid = F.when(F.col("VisitID") % 3 != 0, F.col("VisitID"))
    code = codes.classify_drop("Dropped", vid, "OLDDBDSUBJ", "OLDDBDVIST")
    return sources(spark, d)["visit_log"].select("VisitID", code.alias("dropcode"))


@query("format_day_stamp", "select event_id, strftime(ts, '%Y%m%d') as ymd from events")
def _(spark, d):
    return load(spark, d, "events").select("event_id", dates.format_day_stamp("ts").alias("ymd"))


@query(
    "full_name",
    sql("subject_info", """select "PersonID", coalesce("SubjectFirstName", '') || ' ' || coalesce(nullif(
        "SubjectLastName", 'Fam7'), '') as fullname from subject_info"""),
)
def _(spark, d):
    last = F.nullif("SubjectLastName", F.lit("Fam7"))
    return sources(spark, d)["subject_info"].select("PersonID", text.full_name("SubjectFirstName", last).alias("fullname"))


@query(
    "text_null_to_int",
    sql("enroll", """select eid, try_cast(nullif(case when eid % 4 = 0 then 'null' else id end, 'null') as integer)
        as num from enroll"""),
)
def _(spark, d):
    raw = F.when(F.col("eid") % 4 == 0, "null").otherwise(F.col("id"))
    return domain(spark, d, "enroll")["enroll"].select("eid", codes.text_null_to_int(raw).alias("num"))


@query(
    "patch_coalesce",
    """select o.o_orderkey, coalesce(n.p, o.o_totalprice) as o_totalprice, coalesce(n.s, o.o_orderstatus) as o_orderstatus
    from orders o left join (select l_orderkey, max(l_extendedprice) as p,
        max(case when l_returnflag = 'R' then l_linestatus end) as s from lineitem group by 1) n
    on n.l_orderkey = o.o_orderkey""",
)
def _(spark, d):
    new = load(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_extendedprice").alias("o_totalprice"),
        F.max(F.when(F.col("l_returnflag") == "R", F.col("l_linestatus"))).alias("o_orderstatus"),
    )
    both = load(spark, d, "orders").alias("o").join(new.alias("n"), "o_orderkey", "left")
    return both.select("o_orderkey", *codes.patch_coalesce("n", "o", ["o_totalprice", "o_orderstatus"]))
