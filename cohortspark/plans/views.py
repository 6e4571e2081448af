"""Reporting views over the target tables.

Children are grouped by their key before they are joined, so sibling children never multiply
and a key with many rows reaches the join as one row. An output cell holding a JSON array is
one value by definition: arrays hold distinct values or one entry per child row, unless
``fanout="reference"`` asks for the repeats. ``visit_items`` gives the entries as rows instead.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes, dates, text
from ..functions.jsons import json_text
from ..operators import aggs, identity
from ..operators.joins import key_counts, lookup_join, star_join
from ..operators.reshape import union_by_name
from ..schema import DROP_CODES, DROP_LEVELS

Tables = Mapping[str, DataFrame]
SEEN_STATUS = ["sched", "checkedin", "complete"]


def with_droplevel(tables: Tables, note: DataFrame) -> DataFrame:
    """Notes with the level of their drop code, null where the code is unknown.

    The seeded codes are a fixed list and become an expression; a ``dropcode`` table is joined.
    """
    if "dropcode" not in tables:
        return note.withColumn("droplevel", codes.map_code_labels("dropcode", dict(DROP_CODES)))
    known = tables["dropcode"].select("dropcode", "droplevel")
    return lookup_join(note, known, ["dropcode"], "left", spread_by=["nid"])


def coded_notes(tables: Tables) -> DataFrame:
    """Notes with a known drop code and its level; notes without one vanish."""
    return with_droplevel(tables, tables["note"]).where(F.col("droplevel").isNotNull())


def visit_notes(tables: Tables) -> DataFrame:
    """Per visit: last note, distinct notes, highest drop code by text."""
    note = tables["note"].where(F.col("vid").isNotNull())
    return note.groupBy("vid").agg(
        F.max("ndate").alias("lastnstamp"),
        aggs.json_set_of("note").alias("notes"),
        F.max("dropcode").alias("maxvdrop"),
    )


def _person_notes(notes: DataFrame, drop: str) -> DataFrame:
    return notes.groupBy("pid").agg(
        F.max("ndate").alias("lastnstamp"),
        aggs.json_set_of("note").alias("notes"),
        aggs.ordinal_max_of("droplevel", DROP_LEVELS).alias(drop),
    )


def person_only_notes(tables: Tables) -> DataFrame:
    """Per person, coded notes that belong to no visit."""
    return _person_notes(coded_notes(tables).where(F.col("vid").isNull()), "maxpdrop")


def person_all_notes(tables: Tables) -> DataFrame:
    """Per person, all coded notes."""
    return _person_notes(coded_notes(tables), "maxdrop")


def visit_summary(tables: Tables) -> DataFrame:
    """One row per visit: person, age, latest action, a study, notes, drops.

    Equal latest actions go to the higher action key; of several studies the first by name is shown.
    """
    visit = tables["visit"].select(
        "vid", "pid", "vtimestamp", "vtype", "vscore", "visitno", "googleuri", "dur_hr"
    )
    action = identity.latest_per_key(
        tables["visit_action"].select("vid", "aid", "action", "ra", "vatimestamp"), ["vid"], "vatimestamp",
        [F.col("aid").desc()],
    ).select("vid", "action", "ra")
    study = identity.first_per_group(
        tables["visit_study"].select("vid", "study", "cohort"), ["vid"], ["study", "cohort"]
    )
    notes = visit_notes(tables).select("vid", "notes", F.col("maxvdrop").alias("dvisit"))
    rows = star_join(visit, [action, study, notes], ["vid"])

    drops = person_all_notes(tables).select("pid", F.col("maxdrop").alias("dperson"))
    person = star_join(tables["person"].select("pid", "dob"), [drops], ["pid"])
    full = lookup_join(
        rows, person, ["pid"], "inner", spread_by=["vid"], counts=key_counts(visit, ["pid"]),
        bound_by=[tables["person"].select("pid", "dob")],
    )
    return full.select(
        "pid", "vid", "vtimestamp", "vtype", "vscore", "visitno", "googleuri",
        dates.age_years_whole_days("vtimestamp", "dob").alias("age"),
        "study", "cohort", "action", "ra", "dur_hr", "notes", "dvisit", "dperson",
    )


def _all_of(*cols: str) -> Column:
    """All rows of a group as a sorted array of structs."""
    return F.array_sort(F.collect_list(F.struct(*cols)))


def _or_blank(arr: Column, *fields: str) -> Column:
    """An empty child shows as one object whose fields are null."""
    blank = F.array(F.struct(*[F.lit(None).cast(t).alias(n) for n, t in (f.split(":") for f in fields)]))
    return F.coalesce(arr, blank)


def _repeated(arr: Column, times: Column) -> Column:
    return F.flatten(F.transform(arr, lambda x: F.array_repeat(x, times.cast("int"))))


def visits_view(tables: Tables, primary_type: str = "PrimaryID", fanout: str = "distinct", notes_key: str = "vid") -> DataFrame:
    """Per visit with a study: person, drops, and JSON arrays of studies, ids, actions, tasks.

    ``fanout="reference"`` repeats ids and actions once per combination with the other children,
    as an unaggregated join would. The subject's drop level is looked up by visit key, as the
    original does; ``notes_key="pid"`` looks it up by person.
    """
    v_cols = ["vid", "pid", "vtype", "vscore", "dur_hr", "age", "vtimestamp", "visitno", "googleuri", "vstatus"]
    visit = tables["visit"].select(*v_cols)
    study = tables["visit_study"].groupBy("vid").agg(
        F.array_sort(F.collect_set(F.struct("study", "cohort"))).alias("_studies"),
        F.count(F.lit(1)).alias("_n_study"),
    )
    task = tables["visit_task"].groupBy("vid").agg(
        aggs.sorted_set_of("task").alias("_tasks"), F.count(F.lit(1)).alias("_n_task")
    )
    action = tables["visit_action"].groupBy("vid").agg(
        _all_of("action", "ra", "vatimestamp").alias("_actions"), F.count(F.lit(1)).alias("_n_action")
    )
    notes = visit_notes(tables).select("vid", "notes", "maxvdrop")
    drops = person_all_notes(tables).select("pid", F.col("maxdrop").alias("subjmaxdrop"))

    # Visits without a study vanish: the first join is inner.
    rows = star_join(visit.join(study, "vid"), [task, action, notes], ["vid"])
    enroll = tables["enroll"].groupBy("pid").agg(
        F.max(F.when(F.col("etype") == primary_type, F.col("id"))).alias("primary_id"),
        _all_of("etype", "id").alias("_enrolls"),
        F.count(F.lit(1)).alias("_n_enroll"),
    )
    person = tables["person"].select("pid", "fname", "lname", "sex", "dob").join(enroll, "pid", "full")
    if notes_key == "pid":
        person = star_join(person, [drops], ["pid"])
    else:
        rows = star_join(rows, [drops.withColumnRenamed("pid", "vid")], ["vid"])
    full = lookup_join(
        rows, person, ["pid"], "left", spread_by=["vid"], counts=key_counts(visit, ["pid"]),
        bound_by=[
            tables["person"].select("pid", "fname", "lname", "sex", "dob"), tables["enroll"].select("pid", "etype", "id")
        ],
    )

    def count(c: str) -> Column:
        return F.greatest(F.coalesce(F.col(c), F.lit(1)), F.lit(1))

    enrolls = _or_blank(F.col("_enrolls"), "etype:string", "id:string")
    actions = _or_blank(F.col("_actions"), "action:string", "ra:string", "vatimestamp:timestamp_ntz")
    if fanout == "reference":
        enrolls = _repeated(enrolls, count("_n_study") * count("_n_task") * count("_n_action"))
        actions = _repeated(actions, count("_n_study") * count("_n_task") * count("_n_enroll"))
    actions = F.transform(
        actions,
        lambda a: F.struct(
            a["action"].alias("action"), a["ra"].alias("ra"), a["vatimestamp"].cast("string").alias("vatimestamp")
        ),
    )
    none = F.array(F.lit(None).cast("string"))
    return full.select(
        "primary_id",
        dates.format_day_stamp("vtimestamp").alias("ymd"),
        "subjmaxdrop", "fname", "lname", "sex", "dob", *v_cols,
        json_text(F.array("maxvdrop")).alias("visit_dropped"),
        json_text("_studies").alias("studies"),
        json_text(enrolls).alias("enrolls"),
        json_text(actions).alias("actions"),
        F.coalesce("notes", F.lit("null")).alias("notes"),
        json_text(F.coalesce("_tasks", none)).alias("tasks"),
    )


def visit_items(tables: Tables) -> DataFrame:
    """The array entries of ``visits_view`` as distinct rows: (vid, kind, item).

    For visits whose arrays outgrow one cell: no group is ever brought together, repeats are
    dropped before and after the exchange.
    """

    def items(df: DataFrame, kind: str, *cols: str) -> DataFrame:
        return df.select("vid", F.lit(kind).alias("kind"), json_text(F.struct(*cols)).alias("item"))

    action = tables["visit_action"].withColumn("vatimestamp", F.col("vatimestamp").cast("string"))
    stacked = union_by_name(
        items(tables["visit_study"], "study", "study", "cohort"),
        items(tables["visit_task"], "task", "task"),
        items(action, "action", "action", "ra", "vatimestamp"),
        items(tables["note"].where(F.col("vid").isNotNull()), "note", "note"),
    )
    return stacked.distinct()


def person_search_view(tables: Tables, as_of: str, primary_type: str = "PrimaryID") -> DataFrame:
    """Per person: ids, name, age, visit, study and drop summaries.

    Only scheduled, checked-in and complete visits count. Studies are reduced to a set per visit
    and meet the visits on the visit key; the rows then shrink to one per person before the
    person table is touched.
    """
    seen = tables["visit"].where(F.col("vstatus").isin(SEEN_STATUS)).select("pid", "vid", "vtimestamp", "vtype")
    study = tables["visit_study"].groupBy("vid").agg(F.collect_set(F.struct("study")).alias("_studies"))
    each = seen.join(study, "vid", "left").select("*", F.posexplode_outer("_studies").alias("_i", "_study")).select("*", "_study.study")
    visits = each.groupBy("pid").agg(
        F.max("vtimestamp").alias("lastvisit"),
        F.count_if(F.coalesce(F.col("_i"), F.lit(0)) == 0).alias("numvisits"),
        aggs.sorted_set_of("study").alias("_studies"),
        aggs.sorted_set_of("vtype").alias("_types"),
    )
    enroll = tables["enroll"].groupBy("pid").agg(
        F.min(F.when(F.col("etype") == primary_type, F.col("id"))).alias("_primary"),
        F.array_sort(F.collect_set(F.struct("id", "etype", "edate"))).alias("_ids"),
    )
    note = tables["note"].where(F.col("dropcode").isNotNull()).select("pid", "nid", "dropcode")
    dropped = with_droplevel(tables, note).groupBy("pid").agg(
        F.count(F.lit(1)).alias("ndrops"), aggs.ordinal_max_of("droplevel", DROP_LEVELS).alias("maxdrop")
    )
    rows = star_join(tables["person"], [visits, enroll, dropped], ["pid"])
    none = F.array(F.lit(None).cast("string"))
    ids = F.transform(
        _or_blank(F.col("_ids"), "id:string", "etype:string", "edate:date"),
        lambda e: F.struct(
            e["id"].alias("id"), e["etype"].alias("etype"), e["edate"].cast("string").alias("edate")
        ),
    )
    n_studies = F.size(F.filter(F.coalesce("_studies", none), lambda s: s.isNotNull()))
    return rows.select(
        "pid",
        F.nullif("_primary", F.lit("null")).try_cast("int").alias("primary_id"),
        text.full_name("fname", "lname").alias("fullname"),
        "fname", "lname", "dob", "sex", "hand", "adddate", "source",
        dates.current_age("dob", as_of).alias("curage"),
        dates.current_age_floor("dob", as_of).alias("curagefloor"),
        "lastvisit",
        F.coalesce("numvisits", F.lit(0)).cast("long").alias("numvisits"),
        n_studies.cast("long").alias("nstudies"),
        F.coalesce("ndrops", F.lit(0)).cast("long").alias("ndrops"),
        json_text(ids).alias("ids"),
        json_text(F.coalesce("_studies", none)).alias("studies"),
        json_text(F.coalesce("_types", none)).alias("visittypes"),
        "maxdrop",
    )
