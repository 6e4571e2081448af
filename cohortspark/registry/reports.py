"""Reporting views. The SQL gives every output column as a subquery of its own, so it shares nothing with the star joins."""

from ..plans import views
from ..schema import DROP_LEVELS
from .base import query
from .standin import AS_OF, domain, sql

_LEVELS = "['" + "','".join(DROP_LEVELS) + "']"


def _set_of(col: str, rows: str) -> str:
    """Distinct values of a column as a sorted JSON array."""
    return f"(select to_json(list_sort(list(distinct {col}), 'ASC', 'NULLS LAST'))::varchar from {rows})"


def _level(rows: str) -> str:
    """The highest drop level among coded notes."""
    return f"(select {_LEVELS}[max(list_position({_LEVELS}, x.droplevel))] from note n, dropcode x where x.dropcode = n.dropcode and {rows})"


def _coded(of: str) -> str:
    return f"note n where n.dropcode in (select dropcode from dropcode) and {of}"


def _by_person(of: str, drop: str) -> str:
    own = f"n.pid = k.pid and {of}"
    return f"""select k.pid, (select max(n.ndate) from {_coded(own)}) as lastnstamp, {_set_of('n.note', _coded(own))} as notes,
        {_level(own)} as {drop} from (select distinct n.pid from {_coded(of)}) k"""


_VISIT_NOTES = f"""select k.vid, (select max(ndate) from note where vid = k.vid) as lastnstamp,
    {_set_of('n.note', 'note n where n.vid = k.vid')} as notes, (select max(dropcode) from note where vid = k.vid) as maxvdrop
    from (select distinct vid from note where vid is not null) k"""


@query("visit_notes", sql("note", _VISIT_NOTES))
def _(spark, d):
    return views.visit_notes(domain(spark, d, "note"))


@query(
    "person_only_notes",
    sql("note dropcode", _by_person("n.vid is null", "maxpdrop")),
)
def _(spark, d):
    return views.person_only_notes(domain(spark, d, "note"))


@query("person_all_notes", sql("note dropcode", _by_person("true", "maxdrop")))
def _(spark, d):
    return views.person_all_notes(domain(spark, d, "note"))


SUMMARY = f"""select
        (select first(action order by vatimestamp desc nulls first, aid desc) from visit_action where vid = v.vid) as action,
        (select first(ra order by vatimestamp desc nulls first, aid desc) from visit_action where vid = v.vid) as ra,
        (select first(study order by study, cohort) from visit_study where vid = v.vid) as study,
        (select first(cohort order by study, cohort) from visit_study where vid = v.vid) as cohort,
        (select date_part('day', v.vtimestamp - dob) / 365.25 from person where pid = v.pid) as age,
        case when exists (select 1 from note n where n.vid = v.vid) then {_set_of('n.note', 'note n where n.vid = v.vid')} end as notes,
        (select max(dropcode) from note where vid = v.vid) as dvisit, {_level('n.pid = v.pid')} as dperson,
        vid, pid, vtype, vtimestamp, vscore, dur_hr, visitno, googleuri
        from visit v where pid in (select pid from person)"""


@query(
    "visit_summary",
    sql("visit person visit_action visit_study note dropcode", SUMMARY),
)
def _(spark, d):
    return views.visit_summary(
        domain(spark, d, "visit", "person", "visit_action", "visit_study", "note")
    )


_SHOWN = {"e": "struct_pack(etype := e.etype, id := e.id)", "a": "struct_pack(action := a.action, ra := a.ra, vatimestamp := a.vatimestamp::varchar)"}
_SORTED = {"e": "e.etype nulls first, e.id nulls first, e.eid", "a": "a.action nulls first, a.ra nulls first, a.vatimestamp nulls first, a.aid"}
_ROWS = {"e": "enroll e where e.pid = v.pid", "a": "visit_action a where a.vid = v.vid"}
_BLANK = {"e": "{'etype': null::varchar, 'id': null::varchar}", "a": "{'action': null::varchar, 'ra': null::varchar, 'vatimestamp': null::varchar}"}
_SIZES = {"e": "enroll where pid = v.pid", "a": "visit_action where vid = v.vid", "s": "visit_study where vid = v.vid", "t": "visit_task where vid = v.vid"}
_CHILDREN = "visit person visit_study visit_task visit_action enroll note dropcode"


def _entries(kind: str, repeats: bool) -> str:
    """All child rows as a JSON array, each once or as often as a join of all children would show it."""
    times = " * ".join(f"greatest(1, (select count(*) from {rows}))" for k, rows in _SIZES.items() if k != kind) if repeats else "1"
    rows = f"(select list({_SHOWN[kind]} order by {_SORTED[kind]}) from {_ROWS[kind]})"
    return f"""(select to_json(flatten(list_transform(r.items, lambda x: list_transform(range(r.times), lambda i: x))))::varchar
        from (select coalesce({rows}, [{_BLANK[kind]}]) as items, {times} as times) r)"""


def _view(repeats: bool) -> str:
    person = lambda col: f"(select {col} from person where pid = v.pid) as {col}"
    return sql(_CHILDREN, f"""select v.vid, v.pid, v.vtimestamp, v.visitno, v.vtype, v.vstatus, v.age, v.dur_hr, v.vscore, v.googleuri,
        {person('dob')}, {person('sex')}, {person('fname')}, {person('lname')}, strftime(v.vtimestamp, '%Y%m%d') as ymd,
        (select max(id) from enroll where pid = v.pid and etype = 'PrimaryID') as primary_id, {_level('n.pid = v.vid')} as subjmaxdrop,
        to_json([(select max(dropcode) from note where vid = v.vid)])::varchar as visit_dropped,
        (select to_json(list_sort(list(distinct struct_pack(study := study, cohort := cohort))))::varchar from visit_study where vid = v.vid) as studies,
        {_entries('e', repeats)} as enrolls, {_entries('a', repeats)} as actions,
        case when exists (select 1 from note n where n.vid = v.vid) then {_set_of('n.note', 'note n where n.vid = v.vid')} else 'null' end as notes,
        coalesce({_set_of('t.task', 'visit_task t where t.vid = v.vid')}, '[null]') as tasks
        from visit v where v.vid in (select vid from visit_study)""")


@query("visits_view", _view(False))
def _(spark, d):
    return views.visits_view(domain(spark, d))


@query("visits_view_fanout", _view(True))
def _(spark, d):
    return views.visits_view(domain(spark, d), fanout="reference")


_SEEN = "visit where pid = p.pid and vstatus in ('sched', 'checkedin', 'complete')"
_SEEN_STUDY = f"(select vid from {_SEEN}) seen left join visit_study s on s.vid = seen.vid"
_NO_ID = """'[{"id":null,"etype":null,"edate":null}]'"""


@query(
    "person_search_view",
    sql("person visit enroll visit_study note dropcode", f"""select pid, fname, lname, sex, hand, dob, source, adddate,
        coalesce(fname, '') || ' ' || coalesce(lname, '') as fullname,
        date_part('day', timestamp '{AS_OF}' - dob) / 365.25 as curage,
        floor(date_part('day', timestamp '{AS_OF}' - dob) / 365.25)::double as curagefloor,
        (select try_cast(nullif(min(id), 'null') as integer) from enroll where pid = p.pid and etype = 'PrimaryID') as primary_id,
        (select max(vtimestamp) from {_SEEN}) as lastvisit, (select count(*) from {_SEEN}) as numvisits,
        (select count(distinct study) from {_SEEN_STUDY}) as nstudies,
        (select count(*) from note where pid = p.pid and dropcode is not null) as ndrops,
        coalesce((select to_json(list(struct_pack(id := id, etype := etype, edate := edate::varchar) order by id nulls first, etype nulls first,
            edate nulls first))::varchar from (select distinct id, etype, edate from enroll where pid = p.pid)), {_NO_ID}) as ids,
        coalesce({_set_of('study', _SEEN_STUDY)}, '[null]') as studies, coalesce({_set_of('vtype', _SEEN)}, '[null]') as visittypes,
        {_level('n.pid = p.pid')} as maxdrop
        from person p"""),
)
def _(spark, d):
    return views.person_search_view(
        domain(spark, d, "person", "visit", "enroll", "visit_study", "note"), AS_OF
    )


@query(
    "visit_items",
    sql("visit_study visit_task visit_action note", """
        select vid, 'study' as kind, to_json({'study': study, 'cohort': cohort})::varchar as item from visit_study
        union select vid, 'task', to_json({'task': task})::varchar from visit_task
        union select vid, 'action', to_json({'action': action, 'ra': ra,
            'vatimestamp': cast(vatimestamp as varchar)})::varchar from visit_action
        union select vid, 'note', to_json({'note': note})::varchar from note where vid is not null"""),
)
def _(spark, d):
    return views.visit_items(domain(spark, d, "visit_study", "visit_task", "visit_action", "note"))
