"""Visit registrations, reschedules and cancellations as change sets.

Each job takes a frame of requests and the current tables and returns frames to append
(``add``), to replace by key (``update``) or to remove by key (``delete``), and ``rejected``
with a reason. ``order`` names a request column that tells requests apart and orders them.
``apply_changes`` gives the tables that result; publish them as one snapshot.
Current tables are only read by key columns; keys continue after the largest in use.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import dates
from ..functions.bind import bound
from ..functions.jsons import json_array_items
from ..operators import identity
from ..operators.aggs import count_guards
from ..operators.joins import broadcast_join, fits_broadcast, lookup_join, star_join
from ..session import written
from ..sources.snapshot import INGEST_TS, aligned, load_snapshot, revise_snapshot, save_freshness, sequence, stamped

Tables = Mapping[str, DataFrame]
VISIT_KEY = ["pid", "vtimestamp", "vtype"]
MOVABLE = ["sched", "resched", "assigned"]
REMOVABLE = ["sched", "assigned"]


@dataclass
class ChangeSet:
    add: dict[str, DataFrame] = field(default_factory=dict)
    update: dict[str, tuple[list[str], DataFrame]] = field(default_factory=dict)
    delete: dict[str, tuple[str, DataFrame]] = field(default_factory=dict)
    rejected: DataFrame | None = None


def _with_columns(df: DataFrame, wanted: Mapping[str, str]) -> DataFrame:
    """Add what a request frame leaves out, as nulls of the right type."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in wanted.items() if c not in df.columns})


REQUEST = {
    "vid": "long", "pid": "long", "vtype": "string", "vscore": "decimal(3,2)", "vtimestamp": "timestamp_ntz",
    "visitno": "int", "googleuri": "string", "dur_hr": "double", "action": "string", "ra": "string",
    "notes": "string", "study": "string", "cohort": "string",
}


def _first_reason(reasons: Sequence[tuple[Column, str]]) -> Column:
    """The first reason whose test holds; null when none does."""
    out = F.lit(None).cast("string")
    for test, name in reversed(reasons):
        out = F.when(test, F.lit(name)).otherwise(out)
    return out


def apply_latest_status(visits: DataFrame, actions: DataFrame, col: str = "vstatus") -> DataFrame:
    """Status of each visit = action with the highest key, i.e. inserted last, whatever its time."""
    last = actions.groupBy("vid").agg(F.max_by("action", "aid").alias("_last"))
    found = visits.join(last, "vid", "left")
    order = [F.coalesce("_last", F.col(c)).alias(c) if c == col else F.col(c) for c in visits.columns]
    return found.select(*order)


def _note_rows(requests: DataFrame, existing: DataFrame, as_of: Column, order: str) -> DataFrame:
    """Supplied notes, one row per array element, numbered on."""
    rows = requests.select(
        order, "pid", "vid", "ra", F.posexplode(json_array_items("notes")).alias("_i", "note")
    )
    keyed = identity.offset_surrogate_key(rows, "nid", [order, "_i"], existing)
    return keyed.select(
        "nid", "pid", "vid", F.lit(None).cast("string").alias("dropcode"), "ra", as_of.alias("ndate"), "note"
    )


def _numbered(requests: DataFrame, order: str) -> DataFrame:
    """Accepted requests with their place ``_nth`` from 0, from which all their keys follow."""
    return identity.dense_surrogate_key(requests, "_nth", [order], 0)


def _key(existing: DataFrame, key: str) -> Column:
    return (F.col("_nth") + F.lit(identity.next_key(existing, key))).alias(key)


def _with_study_known(df: DataFrame, tables: Tables, order: str) -> DataFrame:
    """Add ``_study_known``; without a study table every name is accepted."""
    if "study" not in tables:
        return df.withColumn("_study_known", F.lit(True))
    known = tables["study"].select("study").distinct().withColumn("_study_known", F.lit(True))
    return lookup_join(df, known, ["study"], "left", spread_by=[order])


def _clashing(open_requests: DataFrame, visit: DataFrame, order: str) -> DataFrame:
    """Requests for a (person, time, type) that a visit or an earlier request already has."""
    wanted = open_requests.where(F.col("vtimestamp").isNotNull()).select(order, *VISIT_KEY)
    firsts = wanted.groupBy(*VISIT_KEY).agg(F.min(order).alias("_first"))
    taken = visit.select(*VISIT_KEY)
    if fits_broadcast([wanted]):
        taken = broadcast_join(taken, firsts.select(*VISIT_KEY), VISIT_KEY, "left_semi")
    taken = taken.distinct().withColumn("_taken", F.lit(True))
    state = firsts.join(taken, VISIT_KEY, "left")
    met = lookup_join(wanted, state, VISIT_KEY, "inner", spread_by=[order], bound_by=[wanted])
    return met.where(F.col("_taken").isNotNull() | (F.col(order) != F.col("_first"))).select(order)


def register_visits(requests: DataFrame, tables: Tables, as_of: str, order: str = "req_id") -> ChangeSet:
    """New visits with an action, notes and a study.

    Without an action the visit is scheduled now; a given action happened at the visit's time.
    Of several valid requests for one person, time and type the first is taken.
    """
    wanted = {k: t for k, t in REQUEST.items() if k != "vid"}
    req = _with_columns(requests, wanted).select(order, *wanted)
    person = tables["person"].select("pid", "dob").withColumn("_known", F.lit(True))
    found = lookup_join(req, person, ["pid"], "left", spread_by=[order])
    found = _with_study_known(found, tables, order)
    reason = _first_reason([
        (F.col("_known").isNull(), "unknown person"),
        (F.col("vtype").isNull(), "missing visit type"),
        (F.col("ra").isNull(), "missing staff"),
        (~F.col("action").isin(S.STATUS), "unknown action"),
        (F.col("study").isNotNull() & F.col("cohort").isNull(), "missing cohort"),
        (F.col("study").isNotNull() & F.col("_study_known").isNull(), "unknown study"),
    ])
    judged = written(found.withColumn("reason", reason).drop("_known", "_study_known"), "register")
    clash = _clashing(judged.where(F.col("reason").isNull()), tables["visit"], order)
    clash = clash.withColumn("_clash", F.lit("visit exists"))
    judged = judged.join(clash, order, "left").withColumn("reason", F.coalesce("reason", "_clash")).drop("_clash")
    good = judged.where(F.col("reason").isNull()).drop("reason").withColumns({
        "age": dates.age_years_whole_days("vtimestamp", "dob"),
        "_when": F.when(F.col("action").isNull(), dates.moment(as_of)).otherwise(F.col("vtimestamp")),
        "action": F.coalesce("action", F.lit("sched")),
    })
    good = _numbered(good, order)
    good = good.withColumn("vid", _key(tables["visit"], "vid"))
    now = dates.moment(as_of)
    return ChangeSet(
        add={
            "visit": good.select(
                "vid", "pid", "vtype", "vscore", "dur_hr", "age", "vtimestamp", "visitno", "googleuri",
                F.col("action").alias("vstatus"),
            ),
            "visit_action": good.select(
                _key(tables["visit_action"], "aid"), "vid", "action", "ra", F.col("_when").alias("vatimestamp")
            ),
            "note": _note_rows(good, tables["note"], now, order),
            "visit_study": good.where(F.col("study").isNotNull()).select("vid", "study", "cohort"),
        },
        rejected=judged.where(F.col("reason").isNotNull()).select(order, "reason"),
    )


def _of_requested(vids: DataFrame):
    """A filter to the requested visits where these are few, else none: the children are then
    reduced to one row per visit anyway before they meet the requests."""
    if fits_broadcast([vids]):
        return lambda df: broadcast_join(df, vids, ["vid"], "left_semi")
    return lambda df: df


def _old_rows(tables: Tables, vids: DataFrame) -> DataFrame:
    """The requested visits with their latest action and all their studies, one row for each visit."""
    of_requested = _of_requested(vids)
    action = identity.latest_per_key(
        of_requested(tables["visit_action"].select("vid", "aid", "action", "ra", "vatimestamp")),
        ["vid"], "vatimestamp", [F.col("aid").desc()],
    ).select("vid", F.struct("action", "ra", F.col("vatimestamp").alias("since")).alias("latest"))
    study = F.struct(F.col("study").alias("was"), "study", "cohort", F.lit(False).alias("touched"))
    studies = of_requested(tables["visit_study"]).groupBy("vid").agg(F.sort_array(F.collect_set(study)).alias("studies"))
    return star_join(of_requested(tables["visit"]), [action, studies], ["vid"])


MOVED = ["vtimestamp", "vtype", "vscore", "visitno", "googleuri", "dur_hr"]
_SLOT = ["vtimestamp", "vtype"]
STUDIES = "array<struct<was:string,study:string,cohort:string,touched:boolean>>"
PLACES = "array<struct<vtimestamp:timestamp_ntz,vtype:string>>"


def _wanted(state: Column, r: Column) -> Column:
    """What a request asks for in the state that its visit is in, and the study shown for it: the least by name and cohort."""
    shown = F.array_min(F.transform(state["studies"], lambda x: F.struct(x["study"].alias("study"), x["cohort"].alias("cohort"))))
    return F.struct(
        *(F.coalesce(r[c], state[c]).alias(c) for c in MOVED), F.coalesce(r["action"], F.lit("resched")).alias("action"),
        F.coalesce(r["ra"], state["latest"]["ra"]).alias("ra"), shown.alias("shown"))


def _refusal(state: Column, r: Column, new: Column) -> Column:
    """Why a visit in this state can't have it, whatever the other visits do."""
    other = r["study"].isNotNull() & ~r["study"].eqNullSafe(new["shown"]["study"])
    return _first_reason([
        (~state["latest"]["action"].isin(MOVABLE), "not scheduled or assigned"),
        (~new["action"].isin(S.STATUS), "unknown action"),
        (new["ra"].isNull(), "missing staff"),
        (r["study"].isNotNull() & ~r["study_known"], "unknown study"),
        (other & F.exists(state["studies"], lambda x: x["study"] == r["study"]), "study exists"),
    ])


def _replayed(groups: DataFrame) -> DataFrame:
    """Fold the requests of each group of visits, in order, over the visits' state: ``visits`` at the end, and ``log``.

    A claim is refused where another visit of the group or one of ``places`` has the place then, or its order is among
    ``refused``. ``log`` has an entry for each request: its verdict, what it claims, and the place it leaves.
    """
    kind = groups.schema["visits"].dataType.simpleString()
    one = groups.schema["visits"].dataType.elementType
    order, when, key = (f.dataType.simpleString() for f in (groups.schema["requests"].dataType.elementType["order"], one["vtimestamp"], one["vid"]))
    entry = (f"struct<order:{order},vid:{key},pid:{one['pid'].dataType.simpleString()},reason:string,claims:boolean,action:string,ra:string,"
             f"vtimestamp:{when},vtype:string,from_vtimestamp:{when},from_vtype:string>")
    state_type = f"struct<visits:{kind},log:array<{entry}>>"
    begin = F.struct(F.col("visits"), F.array().cast(f"array<{entry}>").alias("log")).cast(state_type)

    def replaced(me: Column, r: Column, shown: Column) -> Column:
        new = F.struct(r["study"].alias("study"), F.coalesce(r["cohort"], shown["cohort"]).alias("cohort"))
        return F.transform(me["studies"], lambda x: F.when(
            x["study"] == shown["study"], F.struct(x["was"].alias("was"), new["study"].alias("study"), new["cohort"].alias("cohort"), F.lit(True).alias("touched"))).otherwise(x))

    def moved(me: Column, r: Column, new: Column) -> Column:
        # Latest is by time, a missing time counting as latest, and of equal ones the one added last.
        late = new["vtimestamp"].isNull() | me["latest"].isNull() | (new["vtimestamp"] >= me["latest"]["since"])
        added = F.struct(new["action"].alias("action"), new["ra"].alias("ra"), new["vtimestamp"].alias("since"))
        latest = F.when(F.coalesce(late, F.lit(False)), added).otherwise(me["latest"])
        studies = F.when(r["study"].isNotNull(), replaced(me, r, new["shown"])).otherwise(me["studies"])
        return F.struct(me["vid"].alias("vid"), me["pid"].alias("pid"), *(new[c].alias(c) for c in MOVED), latest.alias("latest"),
                        studies.alias("studies"), new["action"].alias("vstatus"))

    def after(state: Column, me: Column, r: Column, new: Column, verdict: Column) -> Column:
        line = F.struct(
            r["order"].alias("order"), r["vid"].alias("vid"), me["pid"].alias("pid"), verdict["reason"].alias("reason"), verdict["claims"].alias("claims"),
            new["action"].alias("action"), new["ra"].alias("ra"), new["vtimestamp"].alias("vtimestamp"), new["vtype"].alias("vtype"),
            me["vtimestamp"].alias("from_vtimestamp"), me["vtype"].alias("from_vtype"))
        # The other visits are kept as they are: a transform would copy every one of them.
        others = F.filter(state["visits"], lambda v: v["vid"] != r["vid"])
        visits = F.when(verdict["reason"].isNotNull(), state["visits"]).otherwise(bound(
            others, lambda o: F.concat(o, F.array_repeat(moved(me, r, new), F.size(state["visits"]) - F.size(o)))))
        return F.struct(visits.alias("visits"), F.concat(state["log"], F.array(line)).alias("log"))

    def step(state: Column, r: Column) -> Column:
        def judged(me: Column, new: Column) -> Column:
            stays = new["vtimestamp"].eqNullSafe(me["vtimestamp"]) & new["vtype"].eqNullSafe(me["vtype"])
            place = new["vtimestamp"].isNotNull() & ~stays
            there = lambda v: (v["vtimestamp"] == new["vtimestamp"]) & (v["vtype"] == new["vtype"])
            full = (F.array_contains(F.col("refused"), r["order"]) | F.exists(state["visits"], lambda v: (v["vid"] != r["vid"]) & there(v))
                    | F.exists(F.col("places"), there))

            def ruled(reason: Column) -> Column:
                verdict = F.struct(F.when(reason.isNull() & place & full, "visit exists").otherwise(reason).alias("reason"), (reason.isNull() & place).alias("claims"))
                return bound(verdict, lambda v: after(state, me, r, new, v))

            return bound(_refusal(me, r, new), ruled)

        me = F.get(F.filter(state["visits"], lambda v: v["vid"] == r["vid"]), F.lit(0))
        return bound(me, lambda me: bound(_wanted(me, r), lambda new: judged(me, new)))

    return groups.select(F.aggregate("requests", begin, step).alias("end")).select("end.*")


def _log(done: DataFrame, order: str) -> DataFrame:
    return done.select(F.explode("log").alias("e")).select(F.col("e.order").alias(order), "e.*").drop("order")


def _refused(log: DataFrame, held: DataFrame, order: str) -> DataFrame:
    """Requests that find the (person, time, type) they claim taken: more visits came there before than left.

    Only accepted requests come and leave; ``held`` are the places before the first request.
    """
    ok = F.col("reason").isNull()
    none = F.lit(None).cast(log.schema["vid"].dataType)
    events = held.select(
        *VISIT_KEY, F.lit(None).cast(log.schema[order].dataType).alias(order), F.lit(1).alias("come"), none.alias("vid"))
    claims = log.where("claims")
    came = claims.select(*VISIT_KEY, order, F.when(ok, 1).otherwise(0).alias("come"), "vid")
    left = claims.where(ok & F.col("from_vtimestamp").isNotNull()).select("pid", F.col("from_vtimestamp"), F.col("from_vtype"), order, F.lit(-1), none)
    before = W.partitionBy(*VISIT_KEY).orderBy(F.col(order).asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    met = events.union(came).union(left).withColumn("before", F.sum("come").over(before))
    return met.where(F.col("vid").isNotNull() & (F.col("before") > 0)).select("vid", order)


def _replayed_apart(asked: DataFrame, held: DataFrame, order: str) -> DataFrame:
    """The same for persons with many requests: each visit by itself, the claims of all visits against each other.

    Folds and claims alternate until no claim's verdict changes. A verdict depends on requests before it only, hence
    the verdicts that agree with themselves are those of a replay one by one. Rounds grow with the longest chain of
    places handed on.
    """
    kind = asked.schema["requests"].dataType.elementType["order"].dataType.simpleString()
    none = F.array().cast(f"array<{kind}>")
    alone = asked.select("vid", F.array("visit").alias("visits"), "requests", F.array().cast(PLACES).alias("places"))
    refused = None
    while True:
        told = alone.withColumn("refused", none)
        if refused is not None:
            told = alone.join(refused.groupBy("vid").agg(F.collect_list(order).alias("refused")), "vid", "left").withColumn("refused", F.coalesce("refused", none))
        done = written(_replayed(told), "reschedule")
        now = written(_refused(_log(done, order), held, order), "reschedule")
        if (now if refused is None else _unlike(now, refused, order)).isEmpty():
            return done
        refused = now


def _unlike(a: DataFrame, b: DataFrame, order: str) -> DataFrame:
    """Orders that only one of two frames has."""
    return a.join(b, order, "left_anti").select(order).union(b.join(a, order, "left_anti").select(order))


def reschedule_visits(requests: DataFrame, tables: Tables, as_of: str, order: str = "req_id", together: int = 256) -> ChangeSet:
    """Move visits that have not happened: patch given fields, recompute the age, log an action.

    Requests act one after the other in ``order``, each on what the accepted ones before it left: several may move one
    visit, each adds an action and its notes, and the last given value of a field stays. A request is rejected where the
    visit's latest action is none of sched, resched and assigned, the place (person, time and type) is taken at that
    moment, or the visit has the study already. A place that an accepted request left is free, one that a
    rejected request asked for stays free. Only supplied notes are added; a supplied study replaces the one shown for
    the visit. A visit without any action may be moved.

    Visits meet in the places of their person only. The requests of a person with at most ``together`` of them are
    folded over all the visits they name; for other persons each visit has a fold of its own, and the places are
    settled between them. Both ways give the same result.
    """
    wanted = {k: t for k, t in REQUEST.items() if k != "pid"}
    req = written(_with_columns(requests, wanted).select(order, *wanted), "requests")
    visit_types = {f.name: f.dataType for f in tables["visit"].schema}
    asked = _with_study_known(req.drop("notes"), tables, order).select("vid", F.struct(
        F.col(order).alias("order"), "vid", *(F.col(c).cast(visit_types[c]).alias(c) for c in MOVED), "action", "ra", "study", "cohort",
        F.coalesce("_study_known", F.lit(False)).alias("study_known")).alias("request"))
    asked = asked.where(F.col("vid").isNotNull()).groupBy("vid").agg(F.array_sort(F.collect_list("request")).alias("requests"))
    old = _old_rows(tables, req.select("vid").distinct()).select("vid", "pid", F.struct(
        "vid", "pid", *MOVED, "latest", F.coalesce("studies", F.array().cast(STUDIES)).alias("studies"), F.lit(None).cast("string").alias("vstatus")).alias("visit"))
    asked = written(asked.join(old, "vid"), "reschedule")
    # Only a time that a request gives, or that one of these visits has, can be claimed.
    times = F.array_append(F.transform("requests", lambda r: r["vtimestamp"]), F.col("visit.vtimestamp"))
    times = written(asked.select("pid", F.explode(times).alias("vtimestamp")).where(F.col("vtimestamp").isNotNull()).distinct(), "times")
    held = lookup_join(tables["visit"].select("vid", *VISIT_KEY), times, ["pid", "vtimestamp"], "left_semi", spread_by=["vid"])
    held = lookup_join(held, asked.select("vid"), ["vid"], "left_anti", unique=True)
    many = written(asked.groupBy("pid").agg(F.sum(F.size("requests")).alias("n")).where(F.col("n") > together).select("pid"), "reschedule")
    some = not many.isEmpty()
    close = lookup_join(asked, many, ["pid"], "left_anti", spread_by=["vid"]) if some else asked
    # The fold costs time, not bytes: its partitions are not merged by their size.
    close = close.repartition(int(close.sparkSession.conf.get("spark.sql.shuffle.partitions")), "pid")
    groups = close.groupBy("pid").agg(F.collect_list("visit").alias("visits"), F.array_sort(F.flatten(F.collect_list("requests"))).alias("requests"))
    places = held.groupBy("pid").agg(F.collect_list(F.struct(*_SLOT)).alias("places"))
    groups = groups.join(places, "pid", "left").withColumn("places", F.coalesce("places", F.array().cast(PLACES)))
    done = _replayed(groups.withColumn("refused", F.array().cast(f"array<{req.schema[order].dataType.simpleString()}>")))
    if some:
        apart = written(lookup_join(asked, many, ["pid"], "left_semi", spread_by=["vid"]), "reschedule")
        own = apart.select("visit.pid", "visit.vtimestamp", "visit.vtype").where(F.col("vtimestamp").isNotNull())
        done = done.union(_replayed_apart(apart, own.union(held.select(*VISIT_KEY)), order))
    done = written(done, "reschedule")
    log = _log(done, order)
    lost = req.join(log.select(order), order, "left_anti").select(order, "vid", F.lit("unknown visit").alias("reason"))
    good = _numbered(log.where(F.col("reason").isNull()), order)
    notes = req.where(F.col("notes").isNotNull()).select(order, "notes").join(good.select(order, "pid", "vid", "ra"), order)
    moved = done.select(F.explode("visits").alias("v")).select("v.*").where(F.col("vstatus").isNotNull())
    ages = lookup_join(moved.drop("latest", "studies"), tables["person"].select("pid", "dob"), ["pid"], "left", spread_by=["vid"])
    studies = moved.select("vid", F.explode("studies").alias("s")).where("s.touched").dropDuplicates(["vid", "s"])
    return ChangeSet(
        add={
            "visit_action": good.select(
                _key(tables["visit_action"], "aid"), "vid", "action", "ra", F.col("vtimestamp").alias("vatimestamp")
            ),
            "note": _note_rows(notes, tables["note"], dates.moment(as_of), order),
        },
        update={
            "visit": (["vid"], ages.select(
                "vid", "vtype", "vscore", dates.age_years_whole_days("vtimestamp", "dob").alias("age"), "vtimestamp", "visitno",
                "googleuri", "dur_hr", "vstatus",
            )),
            "visit_study": (["vid", "_old_study"], studies.select("vid", F.col("s.was").alias("_old_study"), "s.study", "s.cohort")),
        },
        rejected=log.where(F.col("reason").isNotNull()).select(order, "vid", "reason").unionByName(lost),
    )


def cancel_visits(requests: DataFrame, tables: Tables) -> ChangeSet:
    """Remove visits that are only scheduled or assigned, with their actions, studies and notes.

    Any other action, an enrolment or a task blocks; the blocking rows are counted.
    """
    asked = requests.select("vid").distinct()
    of_requested = _of_requested(asked)
    held = asked.join(tables["visit"].select("vid").withColumn("_known", F.lit(True)), "vid", "left")
    blocking = [
        of_requested(tables["visit_action"].where(~F.col("action").isin(REMOVABLE)).select("vid")),
        of_requested(tables["visit_enroll"].select("vid")),
        of_requested(tables["visit_task"].select("vid")),
    ]
    counted = count_guards(held, blocking, "vid")
    reason = _first_reason([
        (F.col("_known").isNull(), "unknown visit"),
        (F.col("n_blocking") > 0, "has other actions, enrolments or tasks"),
    ])
    judged = written(counted.withColumn("reason", reason).drop("_known"), "cancel")
    gone = judged.where(F.col("reason").isNull()).select("vid")
    return ChangeSet(
        delete={name: ("vid", gone) for name in ("visit", "visit_action", "visit_study", "note")},
        rejected=judged.where(F.col("reason").isNotNull()).select("vid", "n_blocking", "reason"),
    )


ACTION = {"vid": "long", "action": "string", "ra": "string", "vatimestamp": "timestamp_ntz"}


def record_actions(actions: DataFrame, tables: Tables, order: str = "req_id", key: str | None = None) -> ChangeSet:
    """Log actions, and let each visit's status follow the one with the greatest key.

    Accepted actions are numbered after the largest key in ``order``, or bring their own in column ``key``: a late batch
    may hold keys below those that are there, which then change no status, and keys that are there already
    or come twice in the batch are rejected, so that a repeated batch is harmless. The visit must exist, the action be
    known and the staff be given. Rows of one visit are reduced to their greatest key where they lie.
    """
    wanted = {**ACTION, **({key: "long"} if key else {})}
    told = _with_columns(actions, wanted).select(order, *wanted)
    known = tables["visit"].select("vid").withColumn("_known", F.lit(True))
    found = lookup_join(told, known, ["vid"], "left", spread_by=[order])
    reasons = [
        (F.col("_known").isNull(), "unknown visit"),
        (F.col("action").isNull() | ~F.col("action").isin(S.STATUS), "unknown action"),
        (F.col("ra").isNull(), "missing staff"),
    ]
    if key:
        used = tables["visit_action"].select(F.col("aid").alias(key)).withColumn("_used", F.lit(True))
        asked = told.select(key).distinct()
        used = broadcast_join(used, asked, [key], "left_semi") if fits_broadcast([asked]) else used
        firsts = told.groupBy(key).agg(F.min(order).alias("_first"))
        state = firsts.join(used, key, "left")
        found = lookup_join(found, state, [key], "left", spread_by=[order], bound_by=[told])
        reasons += [(F.col(key).isNull(), "missing key"), (F.col("_used").isNotNull() | (F.col(order) != F.col("_first")), "repeated key")]
    judged = written(found.withColumn("reason", _first_reason(reasons)).select(*told.columns, "reason"), "actions")
    good = judged.where(F.col("reason").isNull()).drop("reason")
    if key:
        good = good.withColumn("aid", F.col(key))
    else:
        good = _numbered(good, order).withColumn("aid", _key(tables["visit_action"], "aid"))
    last = good.groupBy("vid").agg(F.max(F.struct("aid", "action")).alias("_last"))
    if key:
        before = _of_requested(last.select("vid"))(tables["visit_action"].select("vid", "aid")).groupBy("vid").agg(F.max("aid").alias("_before"))
        last = last.join(before, "vid", "left").where(F.col("_before").isNull() | (F.col("_last.aid") > F.col("_before")))
    return ChangeSet(
        add={"visit_action": good.select("aid", "vid", "action", "ra", "vatimestamp")},
        update={"visit": (["vid"], last.select("vid", F.col("_last.action").alias("vstatus")))},
        rejected=judged.where(F.col("reason").isNotNull()).select(order, "vid", "reason"),
    )


def _updated(current: DataFrame, keys: Sequence[str], new: DataFrame) -> DataFrame:
    """Replace columns of the rows named by ``keys``; ``_old_x`` is matched against column ``x``."""
    own = {k: k.removeprefix("_old_") for k in keys}
    cols = [c for c in new.columns if c not in keys]
    patch = new.select(
        *[F.col(k).alias(v) for k, v in own.items()],
        F.struct(*cols).alias("_new"),
    )
    found = current.join(patch, list(own.values()), "left")  # both sides are unique by these keys
    hit = F.col("_new").isNotNull()
    return found.select(
        *[F.when(hit, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
          for c in current.columns]
    )


def commit_changes(
    spark: SparkSession, base: str, changes: ChangeSet, ingest_ts: str | None = None, based_on: int | None = None
) -> str:
    """Publish the current snapshot with a change set applied, all tables at once.

    Tables that only gain rows get a further folder; only updated and deleted-from tables are
    rewritten. ``based_on`` is the ``sequence`` of the bundle that the change set was made from; a bundle
    published since is an error then, as is one published while this one is written.
    """
    based_on = sequence(spark, base) if based_on is None else based_on
    current = load_snapshot(spark, base)
    if ingest_ts is not None:
        changes = _stamped_changes(changes, current, ingest_ts)
    after = apply_changes(current, changes)
    rewritten = {n: after[n] for n in {*changes.update, *changes.delete}}
    grown = {n: df for n, df in changes.add.items() if n not in rewritten}
    snapshot = revise_snapshot(spark, base, append=grown, replace=rewritten, ingest_ts=ingest_ts, based_on=based_on)
    if ingest_ts is not None:
        save_freshness(spark, base)
    return snapshot


def _stamped_changes(changes: ChangeSet, current: Tables, ingest_ts: str) -> ChangeSet:
    """Changed and added rows of tables that keep it carry the time of the commit."""

    def when(name: str, df: DataFrame) -> DataFrame:
        return stamped(df, ingest_ts) if INGEST_TS in current[name].columns else df

    return ChangeSet(
        {n: when(n, df) for n, df in changes.add.items()},
        {n: (keys, when(n, df)) for n, (keys, df) in changes.update.items()},
        changes.delete, changes.rejected,
    )


def apply_changes(tables: Tables, changes: ChangeSet) -> dict[str, DataFrame]:
    """The tables after a change set; columns an added frame lacks are null."""
    out = dict(tables)
    for name, (key, gone) in changes.delete.items():
        table = S.TABLES[name]
        spread_by = table.pk or table.unique[0]
        out[name] = lookup_join(out[name], gone.withColumnRenamed("vid", key), [key], "left_anti", spread_by=spread_by)
    for name, (keys, new) in changes.update.items():
        out[name] = _updated(out[name], keys, new)
    for name, new in changes.add.items():
        out[name] = out[name].unionByName(aligned(new, out[name], name))
    return out
