"""Change sets and the latest-status stream, fed with requests derived from whole tables."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.jsons import json_text
from ..plans import changes, refresh, views
from ..session import new_path, written
from ..sources import snapshot
from ..streaming import status
from .base import query
from .reports import SUMMARY
from .standin import AS_OF, CTE, _recode, ACTION_OF, cases, domain, load, sql

# Requests: one per order, some of them invalid.
_NEW = """select o_orderkey as req_id, case when o_orderkey % 11 = 0 then -1 - o_custkey else o_custkey end as pid,
    case when o_orderkey % 17 <> 0 then o_orderpriority end as vtype, o_orderdate + interval 365 day as vtimestamp,
    case when o_orderkey % 23 = 0 then 'maybe' when o_orderkey % 3 <> 0 then 'complete' end as action,
    case when o_orderkey % 19 <> 0 then 'ra' || (o_orderkey % 5) end as ra,
    o_orderkey % 4 = 0 as has_notes, case when o_orderkey % 2 = 0 then 'S' || (o_orderkey % 6) end as study,
    case when o_orderkey % 7 <> 0 then 'control' end as cohort from orders"""
_JUDGED = """select * exclude (reason), case when reason is null and vtimestamp is not null and (
        exists (select 1 from visit v where v.pid = j.pid and v.vtimestamp = j.vtimestamp and v.vtype = j.vtype)
        or row_number() over (partition by reason is null, pid, vtimestamp, vtype order by req_id) > 1)
    then 'visit exists' else reason end as reason from valid j"""
_VALID = """select n.*, p.dob, case when p.pid is null then 'unknown person' when vtype is null then 'missing visit type'
    when ra is null then 'missing staff' when action not in ('sched','resched','assigned','complete','checkedin',
    'cancelled','noshow','unknown','other') then 'unknown action'
    when study is not null and cohort is null then 'missing cohort' end as reason
    from req n left join person p on p.pid = n.pid"""
_GOOD = """select *, (select max(vid) from visit) + row_number() over (order by req_id) as vid,
    date_part('day', vtimestamp - dob) / 365.25 as age, coalesce(action, 'sched') as act,
    case when action is null then timestamp '2020-01-01' else vtimestamp end as happened from judged where reason is null"""
_CHECKED = {"req": _NEW, "valid": _VALID, "judged": _JUDGED}
_REG = {**_CHECKED, "good": _GOOD}


def _notes(k):
    return F.when(k % 4 == 0, json_text(F.array(F.concat(F.lit("called "), k.cast("string")), F.lit("moved"))))


def _new_requests(spark, d):
    k = F.col("o_orderkey")
    return load(spark, d, "orders").select(
        k.alias("req_id"),
        F.when(k % 11 == 0, -1 - F.col("o_custkey")).otherwise(F.col("o_custkey")).alias("pid"),
        F.when(k % 17 != 0, F.col("o_orderpriority")).alias("vtype"),
        (F.col("o_orderdate") + F.make_dt_interval(days=F.lit(365))).alias("vtimestamp"),
        F.when(k % 23 == 0, "maybe").when(k % 3 != 0, "complete").alias("action"),
        F.when(k % 19 != 0, F.concat(F.lit("ra"), (k % 5).cast("string"))).alias("ra"),
        _notes(k).alias("notes"),
        F.when(k % 2 == 0, F.concat(F.lit("S"), (k % 6).cast("string"))).alias("study"),
        F.when(k % 7 != 0, "control").alias("cohort"),
    )


def _register(spark, d):
    return changes.register_visits(_new_requests(spark, d), domain(spark, d), AS_OF)


@query(
    "register_visits",
    sql("visit person", "select vid, pid, vtype, age, vtimestamp, act as vstatus from good", **_REG),
)
def _(spark, d):
    return _register(spark, d).add["visit"].select("vid", "pid", "vtype", "age", "vtimestamp", "vstatus")


@query(
    "register_visits_actions",
    sql("visit person visit_action", """select (select max(aid) from visit_action) + row_number() over (order by req_id)
        as aid, vid, act as action, ra, happened as vatimestamp from good""", **_REG),
)
def _(spark, d):
    return _register(spark, d).add["visit_action"]


@query(
    "register_visits_notes",
    sql("visit person note", f"""select (select max(nid) from note) + row_number() over (order by req_id, i) as nid, pid,
        vid, ra, timestamp '{AS_OF}' as ndate, note from (
        select *, 0 as i, 'called ' || req_id as note from good where has_notes
        union all select *, 1, 'moved' from good where has_notes)""", **_REG),
)
def _(spark, d):
    return _register(spark, d).add["note"].drop("dropcode")


@query(
    "register_visits_studies",
    sql("visit person", "select vid, study, cohort from good where study is not null", **_REG),
)
def _(spark, d):
    return _register(spark, d).add["visit_study"]


@query(
    "register_visits_rejected",
    sql("person visit", "select req_id, reason from judged where reason is not null", **_CHECKED),
)
def _(spark, d):
    return _register(spark, d).rejected


# Requests: a move of every visit; a second, later one of every third; and a claim of the place that the customer's order before had at first.
_BASE = "case when o_orderkey % 97 = 0 then -1 - o_orderkey else o_orderkey end"
_MOVE = f"""select o_orderkey as req_id, {_BASE} as vid,
    case when o_orderkey % 2 = 0 then o_orderdate + interval 30 day end as vtimestamp, cast(null as varchar) as vtype,
    case o_orderkey % 5 when 0 then 'assigned' when 1 then 'maybe' end as action,
    case when o_orderkey % 3 <> 0 then 'new' || (o_orderkey % 4) end as ra, o_orderkey % 4 = 0 as has_notes,
    case when o_orderkey % 6 = 0 then 'Moved' end as study, cast(null as varchar) as cohort from orders
    union all select 1000000000 + o_orderkey, {_BASE}, case when o_orderkey % 2 = 0 then o_orderdate end, null,
    case o_orderkey % 4 when 0 then 'complete' end, null, o_orderkey % 4 = 1, case when o_orderkey % 2 = 0 then 'Moved' else 'Again' end, 'late'
    from orders where o_orderkey % 3 = 0
    union all select 2000000000 + o_orderkey, o_orderkey, place.vtimestamp, place.vtype, null, 'next', false, null, null from (
        select o_orderkey, lag({{'vtimestamp': o_orderdate, 'vtype': o_orderpriority}}) over (partition by o_custkey order by o_orderkey) as place from orders)
    where place is not null"""
# The state before each of a person's requests: one row for each visit, and the verdict on the request that led here.
_REPLAY = """select 0 as nth, pid, vid, vtimestamp, vtype, vscore, visitno, googleuri, dur_hr, null::varchar as vstatus,
        latest, coalesce(studies, []) as studies, null::bigint as req_id, null::varchar as reason, null::varchar as action, null::varchar as ra
    from visit left join (select vid, arg_max({'action': action, 'ra': ra, 'since': vatimestamp}, (vatimestamp is null, vatimestamp, aid)) as latest
        from visit_action group by vid) using (vid)
    left join (select vid, list({'was': study, 'study': study, 'cohort': cohort, 'touched': false}) as studies from visit_study group by vid) using (vid)
    where pid in (select pid from queue)
    union all
    select nth + 1, pid, vid, case when ok then to_time else vtimestamp end, case when ok then to_type else vtype end, vscore, visitno, googleuri, dur_hr,
        case when ok then to_action else vstatus end,
        case when ok and (to_time is null or latest is null or to_time >= latest.since) then {'action': to_action, 'ra': to_ra, 'since': to_time} else latest end,
        case when ok and asked is not null then list_transform(studies, lambda s: case when s.study = shown.study
            then {'was': s.was, 'study': asked, 'cohort': coalesce(asked_cohort, shown.cohort), 'touched': true} else s end) else studies end,
        case when own then asked_id end, why, to_action, to_ra
    from (select *, own and why is null as ok from (
        select *, case when not own then null
                when latest.action not in ('sched', 'resched', 'assigned') then 'not scheduled or assigned'
                when to_action = 'maybe' then 'unknown action' when to_ra is null then 'missing staff'
                when asked is distinct from shown.study and list_contains(list_transform(studies, lambda s: s.study), asked) then 'study exists'
                when to_time is not null and (to_time is distinct from vtimestamp or to_type is distinct from vtype)
                    and coalesce(list_contains(places, {'t': to_time, 'k': to_type}), false) then 'visit exists' end as why
        from (select s.*, s.vid = q.vid as own, q.req_id as asked_id, coalesce(q.vtimestamp, s.vtimestamp) as to_time, coalesce(q.vtype, s.vtype) as to_type,
                coalesce(q.action, 'resched') as to_action, coalesce(q.ra, s.latest.ra) as to_ra, q.study as asked, q.cohort as asked_cohort,
                list_min(list_transform(s.studies, lambda x: {'study': x.study, 'cohort': x.cohort})) as shown,
                list({'t': s.vtimestamp, 'k': s.vtype}) filter (s.vtimestamp is not null) over (partition by s.pid) as places
            from replay s join queue q on q.pid = s.pid and q.nth = s.nth + 1)))"""
_QUEUE = "select m.*, v.pid, row_number() over (partition by v.pid order by m.req_id) as nth from req m join visit v on v.vid = m.vid"
_MOV = {
    "req": _MOVE, "queue": _QUEUE, "replay": _REPLAY, "told": "select * from replay where req_id is not null",
    "taken": "select t.*, m.has_notes from told t join req m using (req_id) where t.reason is null",
    "ends": "select * from replay where vstatus is not null qualify row_number() over (partition by vid order by nth desc) = 1",
}
_MOV_NEEDS = "visit visit_action visit_study"


def _move_requests(spark, d):
    k, c, none = F.col("o_orderkey"), F.col, F.lit(None).cast("string")
    orders = load(spark, d, "orders")
    vid = F.when(k % 97 == 0, -1 - k).otherwise(k).alias("vid")
    first = orders.select(
        k.alias("req_id"), vid,
        F.when(k % 2 == 0, c("o_orderdate") + F.make_dt_interval(days=F.lit(30))).alias("vtimestamp"), none.alias("vtype"),
        cases(k, "assigned", "maybe", None, None, None).alias("action"),
        F.when(k % 3 != 0, F.concat(F.lit("new"), (k % 4).cast("string"))).alias("ra"),
        _notes(k).alias("notes"), F.when(k % 6 == 0, "Moved").alias("study"), none.alias("cohort"),
    )
    again = orders.where(k % 3 == 0).select(
        k + 1_000_000_000, vid, F.when(k % 2 == 0, c("o_orderdate")), none, F.when(k % 4 == 0, "complete"), none,
        F.when(k % 4 == 1, json_text(F.array(F.concat(F.lit("called "), (k + 1_000_000_000).cast("string")), F.lit("moved")))),
        F.when(k % 2 == 0, "Moved").otherwise("Again"), F.lit("late"),
    )
    before = W.partitionBy("o_custkey").orderBy("o_orderkey")
    places = orders.withColumns({"t": F.lag("o_orderdate").over(before), "p": F.lag("o_orderpriority").over(before), "has": F.lag(F.lit(True)).over(before)})
    chained = places.where("has").select(k + 2_000_000_000, k, "t", "p", none, F.lit("next"), none, none, none)
    return first.union(again).union(chained)


def _move(spark, d):
    return changes.reschedule_visits(_move_requests(spark, d), domain(spark, d), AS_OF)


@query(
    "reschedule_visits",
    sql(_MOV_NEEDS + " person", """select vid, vtype, vscore, date_part('day', vtimestamp - dob) / 365.25 as age, vtimestamp, visitno,
        googleuri, dur_hr, vstatus from ends left join person using (pid)""", **_MOV),
)
def _(spark, d):
    return _move(spark, d).update["visit"][1]


@query(
    "reschedule_visits_actions",
    sql(_MOV_NEEDS, """select (select max(aid) from visit_action) + row_number() over (order by req_id) as aid, vid,
        action, ra, vtimestamp as vatimestamp from taken""", **_MOV),
)
def _(spark, d):
    return _move(spark, d).add["visit_action"]


@query(
    "reschedule_visits_notes",
    sql(_MOV_NEEDS + " note", f"""select (select max(nid) from note) + row_number() over (order by req_id, i) as nid, pid,
        vid, ra, timestamp '{AS_OF}' as ndate, note from (
        select *, 0 as i, 'called ' || req_id as note from taken where has_notes
        union all select *, 1, 'moved' from taken where has_notes)""", **_MOV),
)
def _(spark, d):
    return _move(spark, d).add["note"].drop("dropcode")


@query(
    "reschedule_visits_studies",
    sql(_MOV_NEEDS, """select s.vid, coalesce(m.study, s.study) as study, coalesce(m.cohort, s.cohort) as cohort from visit_study s left join (
        select vid, t.was, t.study, t.cohort from (select vid, unnest(studies) as t from ends) where t.touched) m on m.vid = s.vid and m.was = s.study""", **_MOV),
)
def _(spark, d):
    t = domain(spark, d)
    moved = changes.reschedule_visits(_move_requests(spark, d), t, AS_OF)
    return changes.apply_changes(t, moved)["visit_study"]


@query(
    "reschedule_visits_rejected",
    sql(_MOV_NEEDS, """select req_id, vid, reason from told where reason is not null
        union all select req_id, vid, 'unknown visit' from req where vid is null or vid not in (select vid from visit)""", **_MOV),
)
def _(spark, d):
    return _move(spark, d).rejected


# Two batches of actions: one per order, numbered on; then a late one that brings its keys, some of them old, some there already.
_LOGGED = """select o_orderkey as req_id, case when o_orderkey % 31 = 0 then -1 else o_orderkey end as vid,
    case o_orderkey % 5 when 0 then 'cancelled' when 1 then 'checkedin' when 2 then 'maybe' else 'complete' end as action,
    case when o_orderkey % 13 <> 0 then 'ra' || (o_orderkey % 3) end as ra, o_orderdate as vatimestamp from orders where o_orderkey % 3 <> 0"""
_LATE = """select o_orderkey as req_id, o_orderkey as vid, case o_orderkey % 4 when 0 then 'noshow' else 'sched' end as action, 'late' as ra,
    o_orderdate as vatimestamp, case o_orderkey % 4 when 0 then 2000000000 + o_orderkey // 8 when 1 then -o_orderkey - 1 else o_orderkey // 2 end as aid from orders"""
_FIRST = """select (select max(aid) from visit_action) + row_number() over (order by req_id) as aid, vid, action, ra, vatimestamp from logged
    where vid in (select vid from visit) and action <> 'maybe' and ra is not null"""
_SECOND = """select aid, vid, action, ra, vatimestamp from late where vid in (select vid from visit)
    and aid not in (select aid from visit_action union all select aid from firsts) qualify row_number() over (partition by aid order by req_id) = 1"""
_ACTS = {"logged": _LOGGED, "late": _LATE, "firsts": _FIRST, "seconds": _SECOND,
         "every": "select aid, vid, action, ra, vatimestamp from visit_action union all select * from firsts union all select * from seconds"}


def _first_actions(spark, d):
    k, c = F.col("o_orderkey"), F.col
    return load(spark, d, "orders").where(k % 3 != 0).select(
        k.alias("req_id"), F.when(k % 31 == 0, -1).otherwise(k).alias("vid"), cases(k, "cancelled", "checkedin", "maybe", "complete", "complete").alias("action"),
        F.when(k % 13 != 0, F.concat(F.lit("ra"), (k % 3).cast("string"))).alias("ra"), c("o_orderdate").alias("vatimestamp"))


def _record(spark, d):
    """The tables after both batches."""
    k, c = F.col("o_orderkey"), F.col
    t = domain(spark, d, "visit", "visit_action")
    t = changes.apply_changes(t, changes.record_actions(_first_actions(spark, d), t))
    late = load(spark, d, "orders").select(
        k.alias("req_id"), k.alias("vid"), cases(k, "noshow", "sched", "sched", "sched").alias("action"), F.lit("late").alias("ra"), c("o_orderdate").alias("vatimestamp"),
        F.when(k % 4 == 0, F.floor(k / 8) + 2_000_000_000).when(k % 4 == 1, -k - 1).otherwise(F.floor(k / 2)).alias("aid"))
    return changes.apply_changes(t, changes.record_actions(late, t, key="aid"))


@query(
    "record_actions",
    sql("visit visit_action", """select vid, vtype, case when vid in (select vid from firsts union all select vid from seconds)
        and l.aid not in (select aid from visit_action) then l.action else vstatus end as vstatus, l.aid as last_aid, l.n as n_actions
        from visit left join (select vid, max(aid) as aid, arg_max(action, aid) as action, count(*) as n from every group by vid) l using (vid)""", **_ACTS),
)
def _(spark, d):
    t = _record(spark, d)
    last = t["visit_action"].groupBy("vid").agg(F.max("aid").alias("last_aid"), F.count("*").alias("n_actions"))
    return t["visit"].select("vid", "vtype", "vstatus").join(last, "vid", "left")


@query(
    "freshness_after_commit",
    sql("visit visit_action", """select 'visit' as tbl, case when vid in (select vid from firsts) then timestamp '2024-05-01' else timestamp '2020-01-01' end
            as ingest_ts, count(*) as n from visit group by 2
        union all select 'visit_action', timestamp '2020-01-01', count(*) from visit_action
        union all select 'visit_action', timestamp '2024-05-01', count(*) from firsts
        union all select 'last_update', timestamp '2024-05-01', 2""", **_ACTS),
)
def _(spark, d):
    base = new_path(spark, "fresh")
    snapshot.append_tables(domain(spark, d, "visit", "visit_action"), base, ingest_ts="2020-01-01")
    at, t = snapshot.sequence(spark, base), snapshot.load_snapshot(spark, base)
    changes.commit_changes(spark, base, changes.record_actions(_first_actions(spark, d), t), ingest_ts="2024-05-01", based_on=at)
    t = snapshot.load_snapshot(spark, base)
    marks = spark.read.parquet(f"{base}/last_update").agg(F.max("last_update").alias("ingest_ts"), F.count("*").alias("n"))
    rows = [t[n].groupBy("ingest_ts").agg(F.count("*").alias("n")).select(F.lit(n).alias("tbl"), "ingest_ts", "n") for n in ("visit", "visit_action")]
    return rows[0].union(rows[1]).union(marks.select(F.lit("last_update").alias("tbl"), "ingest_ts", "n"))


@query(
    "refresh_visit_summary",
    sql("visit person visit_study note dropcode", SUMMARY, logged=_LOGGED, old_action=CTE["visit_action"], firsts=_FIRST.replace("visit_action", "old_action"),
        visit_action="select aid, vid, action, ra, vatimestamp from old_action union all select * from firsts"),
)
def _(spark, d):
    before = domain(spark, d, "visit", "person", "visit_action", "visit_study", "note")
    done = changes.record_actions(_first_actions(spark, d), before)
    stored = written(views.visit_summary(before), "stored")
    return refresh.refresh_view("visit_summary", stored, done, before, changes.apply_changes(before, done))


_HELD = """select r.vid, v.vid is not null as known,
    (select count(*) from visit_action a where a.vid = r.vid and a.action not in ('sched', 'assigned'))
    + (select count(*) from visit_enroll e where e.vid = r.vid)
    + (select count(*) from visit_task t where t.vid = r.vid) as n_blocking
    from (select distinct case when o_orderkey % 97 = 0 then -1 - o_orderkey else o_orderkey end as vid from orders) r
    left join visit v on v.vid = r.vid"""


def _cancel(spark, d, t):
    k = F.col("o_orderkey")
    asked = load(spark, d, "orders").select(F.when(k % 97 == 0, -1 - k).otherwise(k).alias("vid"))
    return changes.cancel_visits(asked, t)


@query(
    "cancel_visits",
    sql("visit visit_action visit_enroll visit_task", """select vid, case when not known then 'unknown visit'
        when n_blocking > 0 then 'has other actions, enrolments or tasks' else 'removed' end as outcome,
        n_blocking from held""", held=_HELD),
)
def _(spark, d):
    done = _cancel(spark, d, domain(spark, d))
    gone = done.delete["visit"][1].select("vid", F.lit("removed").alias("outcome"), F.lit(0).cast("long").alias("n_blocking"))
    return gone.unionByName(done.rejected.select("vid", F.col("reason").alias("outcome"), "n_blocking"))


@query(
    "apply_changes",
    sql("visit visit_action visit_enroll visit_task note visit_study", """select tbl, count(*) as n from (
        select 'visit' as tbl, vid from visit union all select 'visit_action', vid from visit_action
        union all select 'visit_study', vid from visit_study union all select 'note', vid from note)
        where vid is null or vid not in (select vid from held where known and n_blocking = 0) group by tbl""", held=_HELD),
)
def _(spark, d):
    t = domain(spark, d)
    after = changes.apply_changes(t, _cancel(spark, d, t))
    names = ["visit", "visit_action", "visit_study", "note"]
    rows = [after[n].select(F.lit(n).alias("tbl")) for n in names]
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return out.groupBy("tbl").agg(F.count(F.lit(1)).alias("n"))


@query(
    "apply_latest_status",
    sql("visit visit_action", """select v.vid, v.vtype, coalesce(a.action, v.vstatus) as vstatus from visit v
        left join (select vid, arg_max(action, aid) as action from visit_action group by vid) a on a.vid = v.vid"""),
)
def _(spark, d):
    t = domain(spark, d, "visit", "visit_action")
    return changes.apply_latest_status(t["visit"].select("vid", "vtype", "vstatus"), t["visit_action"])


@query(
    "stream_latest_status",
    sql("visit_action", "select vid, arg_max(action, aid) as status from visit_action group by vid"),
)
def _(spark, d):
    schema = load(spark, d, "events").schema
    log = status.read_action_log(spark, f"{d}/events.parquet*", schema).select(
        F.col("event_id").alias("aid"), F.floor(F.col("event_id") / 4).alias("vid"),
        _recode("event_type", ACTION_OF).alias("action"),
    )
    out = new_path(spark, "status")
    status.stream_latest_status(log, out, new_path(spark, "status-checkpoint")).awaitTermination()
    return status.read_latest_status(spark, out)
