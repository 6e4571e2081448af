"""The twelve output tables, built from source tables derived from the given ones."""

from pyspark.sql import functions as F

from ..operators import reshape
from ..plans import load, tables
from ..schema import BUILT, DROP_CODES, STAFF, TABLES
from ..session import new_path
from ..sources import snapshot
from .base import ORACLE, query
from .standin import AS_OF, sources, sql

_FAMILY = {f: f'"Contact1{f}"' for f in ("FirstName", "LastName", "Address1", "Address2", "City", "State", "ZipCode",
                                         "Email", "Phone")}
_NA = "coalesce({}, 'NA')"

# The build in plain SQL: windows over whole tables, star joins, no shared lookups.
_PEOPLE = f"""select *, min(own_pid) over (partition by fname, lname, dob) as pid from (
    select *, row_number() over (order by rk, "ID") as own_pid,
        case when "SexID" > -1 and "SexID" <= 0 then 'U' when "SexID" = 1 then 'M' when "SexID" = 2 then 'F' end as sex,
        case "HandID" when -1 then 'U' when 1 then 'R' when 2 then 'L' when 3 then 'A' end as hand,
        cast(case when b > timestamp '{AS_OF}' + interval 730 day + interval 12 hour
            then b - interval 36525 day else b end as date) as dob,
        "SubjectFirstName" as fname, "SubjectLastName" as lname
    from (select *, strptime("DateOfBirth", '%m/%d/%y %H:%M:%S') as b from (
        select 'subj' as origin, 0 as rk, "PersonID" as "ID", * exclude ("PersonID") from subject_info
        union all by name
        select * from (select 'screen' as origin, 1 as rk, "ScreenID" as "ID", * exclude ("ScreenID")
            from phone_screen where "SubjectLastName" <> '' qualify row_number() over (
            partition by "SubjectFirstName", "SubjectLastName" order by "ScreenID") = 1))))"""
_ALL_VISITS = r"""select v."VisitID" as vid, strptime("VisitDate", '%m/%d/%y %H:%M:%S') + coalesce(
        strptime("VisitTime", '%m/%d/%y %H:%M:%S') - date_trunc('day', strptime("VisitTime", '%m/%d/%y %H:%M:%S')),
        interval 0 hour) as vtimestamp,
    (select string_agg(x.t, ',' order by x.o) from (values (0, 'Behavioral', v."Behavioral"), (1, 'MEG', v."MEG"),
        (2, 'Scan', v."Scan")) as x(o, t, f) where x.f > 0) as vtype,
    p.pid, date_diff('day', p.dob, cast(strptime("VisitDate", '%m/%d/%y %H:%M:%S') as date)) / 365.25 as age,
    try_cast(replace(nullif(regexp_extract(v."Notes", '(^| )x[0-9]+'), ''), 'x', '') as integer) as visitno,
    try_cast(replace(nullif(regexp_extract(v."Notes", '([^0-9-]|^)[0-5](\.[0-9])?(/5)?$|[0-5](\.[0-9])?/5'), ''),
        '/5', '') as double) as vscore, 'checkedin' as vstatus
    from visit_log v left join people p on p.origin = 'subj' and p."ID" = v."PersonID" """
_MAPPED = "select *, min(vid) over (partition by pid, vtype, vtimestamp) as use_vid from all_visits"
_SCANS = """select row_number() over (order by "VisitID") as eid, p.pid, 'ScanID' as etype, "ScanID" as id,
    cast(strptime("VisitDate", '%m/%d/%y %H:%M:%S') as date) as edate, "VisitID" as vid
    from scan_ids s left join people p on p.origin = 'subj' and p."ID" = s."PersonID" """
_P = {"people": _PEOPLE}
_V = {**_P, "all_visits": _ALL_VISITS, "mapped": _MAPPED}
_SRC = "subject_info phone_screen visit_log"

_ADDRESS = "concat_ws(' ', " + ", ".join(
    _NA.format(_FAMILY[f]) for f in ("Address1", "Address2", "City", "State", "ZipCode")) + ")"
_WHO1 = f"""concat_ws(' ', {_NA.format('"Contact1FirstName"')}, {_NA.format('"Contact1LastName"')})"""
_WHO2 = f"""concat_ws(' ', {_NA.format('"Contact2FirstName"')}, {_NA.format('"Contact2LastName"')})"""
_LONG = f"""select pid, 'Contact1' as relation, {_WHO1} as who, 'Address' as ctype, {_ADDRESS} as raw from people
    union all select pid, 'Contact1', {_WHO1}, 'Email', "Contact1Email" from people
    union all select pid, 'Contact1', {_WHO1}, 'Phone', "Contact1Phone" from people
    union all select pid, 'Contact2', {_WHO2}, 'Phone', "Contact2Phone" from people
    union all select pid, 'Contact2', {_WHO2}, 'Address', 'NA NA NA NA NA' from people"""
_CLEAN = """regexp_replace(regexp_replace(regexp_replace(raw, '(^| )NA( |$)', ' ', 'g'), ' +', ' ', 'g'),
    '^ ?PA ?$', '')"""


def _q(needs: str, body: str, **more: str) -> str:
    return sql(f"{_SRC} {needs}".strip(), body, **more)


@query("build_person", _q("", "select pid, fname, lname, sex, hand, dob from people where pid = own_pid", **_P))
def _(spark, d):
    return tables.build_person(sources(spark, d), AS_OF)


@query(
    "build_contact",
    _q("", f"""select distinct pid, relation, who, ctype, cvalue from (select pid, relation, who, ctype,
        case when ctype like '%Phone%' then regexp_replace({_CLEAN}, '[^0-9]', '', 'g') else {_CLEAN} end as cvalue
        from long) where not regexp_matches(cvalue, '^[-() ,]*$')""", **_P, long=_LONG),
)
def _(spark, d):
    return tables.build_contact(sources(spark, d), AS_OF)


@query(
    "build_visit",
    _q("", """select vid, vtimestamp, vtype, pid, age, visitno, vscore, vstatus from mapped where vid = use_vid""", **_V),
)
def _(spark, d):
    visit = tables.build_visit(sources(spark, d), AS_OF)
    return visit.withColumn("vscore", visit.vscore.cast("double"))


_FLAGS = " union all ".join(
    f"""select "VisitID" as vid, '{f}' as study from visit_study_flags where "{f}" = 1"""
    for f in ("AlphaStudy", "BetaStudy", "GammaStudy")
)
_COHORT = """select "VisitID" as vid, case when l = '' then 'control' else l end as cohort from (
    select "VisitID", replace(regexp_replace(coalesce(replace("Disorder", 'None', ''), 'NA') || '_'
        || case when "Control" is null then 'NA' when "Control" = 1 then 'control' else '' end, '^_|_$', '', 'g'),
        'control_control', 'control') as l
    from visit_log v left join disorders x on x."DisorderID" = v."DisorderID")"""


@query(
    "build_visit_study",
    _q("visit_study_flags disorders", """select distinct m.use_vid as vid, f.study, c.cohort from flags f
        left join cohort c on c.vid = f.vid join mapped m on m.vid = f.vid""", **_V, flags=_FLAGS, cohort=_COHORT),
)
def _(spark, d):
    return tables.build_visit_study(sources(spark, d), AS_OF)


_PACKED = """select "VisitID" as vid, 'Line' as task, to_json({'quantity': quantity, 'price': price,
        'discount': discount, 'flag': flag})::varchar as measures from d_line
    union all select "VisitID", 'Order', to_json({'total': total, 'priority': priority})::varchar from d_order
    union all select "VisitID", 'Event', to_json({'kind': kind, 'value': value})::varchar from d_event"""


@query(
    "build_visit_task",
    _q("d_line d_order d_event", """select distinct coalesce(m.use_vid, p.vid) as vid, p.measures, p.task
        from packed p left join mapped m on m.vid = p.vid""", **_V, packed=_PACKED),
)
def _(spark, d):
    return tables.build_visit_task(sources(spark, d), AS_OF)


@query(
    "build_enroll",
    _q("scan_ids", """select eid, pid, etype, id, edate from scans union all
        select (select max(eid) from scans) + row_number() over (order by p.pid), p.pid, 'PrimaryID',
            cast(p."ID" as varchar), cast(f.first as date)
        from people p left join (select pid, min(vtimestamp) as first from mapped where vid = use_vid group by pid) f
            on f.pid = p.pid
        where p.origin = 'subj' and p.pid = p.own_pid""", **_V, scans=_SCANS),
)
def _(spark, d):
    return tables.build_enroll(sources(spark, d), AS_OF)


@query(
    "build_visit_enroll",
    _q("scan_ids", "select s.eid, m.use_vid as vid from scans s join mapped m on m.vid = s.vid", **_V, scans=_SCANS),
)
def _(spark, d):
    return tables.build_visit_enroll(sources(spark, d), AS_OF)


_NOTES = """select 0 as rk, "ID" as ord, pid, null as vid, cast(null as timestamp) as ndate, "Dropped", "Notes"
    from people where origin = 'subj'
    union all select 1, n.ord, v.pid, n.vid, v.vtimestamp, n."Dropped", n."Notes" from (
        select m.use_vid as vid, l."Dropped", l."Notes", min(l."VisitID") as ord
        from visit_log l join mapped m on m.vid = l."VisitID" group by 1, 2, 3) n
    left join mapped v on v.vid = n.vid"""


@query(
    "build_note",
    _q("", """select row_number() over (order by rk, ord) as nid, pid, vid,
        case when "Dropped" <> 0 then case when vid is null then 'OLDDBDSUBJ' else 'OLDDBDVIST' end end as dropcode,
        ndate, "Notes" as note from notes where "Notes" <> '' or "Dropped" <> 0""", **_V, notes=_NOTES),
)
def _(spark, d):
    return tables.build_note(sources(spark, d), AS_OF)


_MODES = " union all ".join(
    f"""select "Task" as task, {i} as o, '{m}' as mode from tasks where "{m}" = 1"""
    for i, m in enumerate(("Behavioral", "Scan", "MEG", "Questionnaire"))
)
_CATALOGUE = """select * from (values ('Line', '["quantity","price","discount","flag"]'),
    ('Order', '["total","priority"]'), ('Event', '["kind","value"]')) as c(task, measures)"""


@query(
    "build_task",
    sql("tasks d_line d_order d_event", """select k.task, k.modes, c.measures from known k
            left join catalogue c on c.task = k.task
        union all select distinct task, '[]', '[]' from packed where task not in (select task from known)""",
        modes=_MODES, catalogue=_CATALOGUE, packed=_PACKED,
        known="select task, to_json(list(mode order by o))::varchar as modes from modes group by task"),
)
def _(spark, d):
    return tables.build_task(sources(spark, d), AS_OF)


_STUDY_TASK = " union all ".join(
    f"""select '{s}' as study, "Task" as task from tasks where "{s}" = 1"""
    for s in ("Cannabis", "MEGEmo", "CogR01", "RewardR01", "EBS", "PVL", "SlotReward", "RingReward")
)


@query("build_study_task", sql("tasks", _STUDY_TASK))
def _(spark, d):
    return tables.build_study_task(sources(spark, d), AS_OF)


@query(
    "build_study",
    sql("tasks", f"""select study, study as grantname from (select study from ({_STUDY_TASK})
        union values ('SlotReward'), ('RingReward'), ('RewardR21'))"""),
)
def _(spark, d):
    return tables.build_study(sources(spark, d), AS_OF)


_ACTIONS = """select 0 as co, 'sched' as action, "VisitID" as vid, "ScheduledBy" as value from visit_log
    union all select 1, 'checkedin', "VisitID", case when coalesce("ScheduledBy", '') || coalesce("CheckedInBy", '') = ''
        then 'OLDDB' else "CheckedInBy" end from visit_log"""


@query(
    "build_visit_action",
    _q("", r"""select a.aid, m.use_vid as vid, a.action, regexp_replace(a.value, '.*\\', '') as ra from (
        select row_number() over (order by co, vid) as aid, * from actions where value <> '') a
        join mapped m on m.vid = a.vid""", **_V, actions=_ACTIONS),
)
def _(spark, d):
    return tables.build_visit_action(sources(spark, d), AS_OF)


@query(
    "rebuild",
    " union all ".join(
        f"select '{name}' as table_name, count(*) as n from ({ORACLE['build_' + name]})" for name in BUILT
    ),
)
def _(spark, d):
    base = new_path(spark, "rebuild")
    load.rebuild(spark, sources(spark, d), base, AS_OF)
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in snapshot.load_snapshot(spark, base).items() if name in BUILT
    ]
    return reshape.union_by_name(*counts)


_SQL_TYPE = {"long": "bigint", "int": "integer", "string": "varchar", "timestamp_ntz": "timestamp"}


def _conformed(name: str, built: str) -> str:
    """All declared columns of a table; what the build lacks is null, but a serial key numbers the rows."""
    pairs = [c.split() for c in TABLES[name].columns.split(", ")]
    none = ", ".join(f"null::{_SQL_TYPE.get(kind, kind)} as {c}" for c, kind in pairs)
    key = load.SERIAL.get(name, ("",))[0]
    if key:
        built = f"select row_number() over () as {key}, * from ({built})"
    return f"select {none} where false union all by name ({built})"


def _violations() -> str:
    """What each declared constraint of the built tables finds, one plain statement for each."""
    names, found = [*BUILT, "dropcode", "ra"], []
    for name in names:
        spec = TABLES[name]
        rows = {("not_null", c): f"{c} is null" for c in (*spec.pk, *spec.not_null)}
        rows |= {("enum", c): f"{c} not in ({', '.join(map(repr, levels))})" for c, levels in spec.enums.items()}
        rows |= {("length", c): f"length({c}) > {n}" for c, n in spec.lengths.items()}
        rows |= {("range", c): f"{c} is not null and try_cast({c} as decimal({a}, {b})) is null" for c, (a, b) in spec.numerics.items()}
        counts = {k: f"select count(*) from {name} where {test}" for k, test in rows.items()}
        for keys in dict.fromkeys((spec.pk, *spec.unique)):
            if keys:
                told = " and ".join(f"{k} is not null" for k in keys)
                counts["unique", ",".join(keys)] = (
                    f"select count(*) from (select 1 from {name} where {told} group by {', '.join(keys)} having count(*) > 1)"
                )
        for fk, (parent, pk) in spec.refs.items():
            if parent in names:
                counts["foreign_key", f"{fk}->{parent}.{pk}"] = (
                    f"select count(*) from {name} c where {fk} is not null and not exists (select 1 from {parent} p where p.{pk} = c.{fk})"
                )
        found += [f"select '{name}' as table_name, '{check}' as check_name, '{subject}' as subject, ({n}) as n_bad"
                  for (check, subject), n in counts.items()]
    codes = ", ".join(f"('{code}', '{level}')" for code, level in DROP_CODES)
    staff = ", ".join(f"('{who}', '{abbr}')" for who, abbr in STAFF)
    seeds = {"dropcode": f"select * from (values {codes}) t(dropcode, droplevel)", "ra": f"select * from (values {staff}) t(ra, abbr)"}
    tables = [f"{n} as materialized ({_conformed(n, seeds.get(n) or ORACLE['build_' + n])})" for n in names]
    return f"with {', '.join(tables)} select * from ({' union all '.join(found)}) where n_bad > 0"


@query("rebuild_violations", _violations())
def _(spark, d):
    return load.rebuild(spark, sources(spark, d), new_path(spark, "rebuild"), AS_OF)
