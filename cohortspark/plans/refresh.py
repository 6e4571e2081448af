"""Keep stored reporting views current: recompute the rows that a change set touches, keep all others.

A change set names rows by visit or person. From these follow the keys of the view whose rows may differ: a changed
note, for one, touches its visit, its person, and every visit of that person, as these show the person's drop level.
The view is then built from the tables reduced to those keys, and replaces the stored rows of the same keys.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..operators.joins import lookup_join
from ..session import written
from . import views
from .changes import ChangeSet, Tables


@dataclass(frozen=True)
class View:
    """``by_visit`` and ``by_person`` are the tables whose rows touch the view through their visit or their person.

    ``of_person`` tables touch all visits of their person.
    """

    key: str
    build: Callable[..., DataFrame]
    by_visit: tuple[str, ...] = ()
    by_person: tuple[str, ...] = ()
    of_person: tuple[str, ...] = ()


VIEWS = {
    "visit_notes": View("vid", views.visit_notes, by_visit=("note",)),
    "person_only_notes": View("pid", views.person_only_notes, by_person=("note",)),
    "person_all_notes": View("pid", views.person_all_notes, by_person=("note",)),
    "visit_summary": View("vid", views.visit_summary, by_visit=("visit", "visit_action", "visit_study", "note"), of_person=("note", "person")),
    "visits_view": View("vid", views.visits_view, by_visit=("visit", "visit_action", "visit_study", "visit_task", "note"), of_person=("note", "person", "enroll")),
    "person_search_view": View("pid", views.person_search_view, by_visit=("visit", "visit_study"), by_person=("person", "enroll", "note")),
}


def _semi(df: DataFrame, name: str, keys: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """Rows of a table with (or without) these keys."""
    table = S.TABLES[name]
    return lookup_join(df, keys, [key], how, spread_by=table.pk or table.unique[0])


def _touched(changes: ChangeSet, name: str, key: str, before: Tables) -> list[DataFrame]:
    """Keys of a table's changed rows. A row that goes or changes shows in the table before, a new one in the change set."""
    out = []
    if name in changes.add and key in changes.add[name].columns:
        out.append(changes.add[name].select(key))
    for frames in (changes.update, changes.delete):
        if name not in frames:
            continue
        rows = frames[name][1]
        named = rows.select("vid").distinct()
        own = before[name]
        if key == "vid":
            out.append(named)
        elif key in own.columns:
            out.append(_semi(own, name, named, "vid").select(key))
    return out


def _all(frames: list[DataFrame], key: str, spark) -> DataFrame:
    if not frames:
        return spark.createDataFrame([], f"{key} long")
    stacked = reduce(DataFrame.union, (f.select(F.col(f.columns[0]).cast("long").alias(key)) for f in frames))
    return stacked.where(F.col(key).isNotNull()).distinct()


def affected_keys(view: str, changes: ChangeSet, before: Tables, after: Tables, notes_key: str = "vid") -> DataFrame:
    """Keys of the view whose rows a change set may have changed, added or removed."""
    v, spark = VIEWS[view], next(iter(after.values())).sparkSession
    vids = [k for n in v.by_visit for k in _touched(changes, n, "vid", before)]
    if v.key == "pid":
        pids = [k for n in v.by_person for k in _touched(changes, n, "pid", before)]
        if vids:  # a visit's person, from before and after
            named = _all(vids, "vid", spark)
            pids += [_semi(t["visit"], "visit", named, "vid").select("pid") for t in (before, after)]
        return _all(pids, "pid", spark)
    pids = [k for n in v.of_person for k in _touched(changes, n, "pid", before)]
    if pids:
        persons = _all(pids, "pid", spark)
        vids.append(_semi(after["visit"], "visit", persons, "pid").select("vid"))
        if view == "visits_view" and notes_key == "vid":  # there drop levels are looked up by visit key
            vids.append(persons.select(F.col("pid").alias("vid")))
    return _all(vids, "vid", spark)


def _reduced(v: View, keys: DataFrame, after: Tables) -> dict[str, DataFrame]:
    """The tables with all rows that the view's rows of these keys are made of."""
    out = dict(after)
    if v.key == "pid":
        for name in ("person", "enroll", "note", "visit"):
            if name in after:
                out[name] = _semi(after[name], name, keys, "pid")
        return out
    out["visit"] = _semi(after["visit"], "visit", keys, "vid")
    for name in ("visit_action", "visit_study", "visit_task"):
        if name in after:
            out[name] = _semi(after[name], name, keys, "vid")
    if v.of_person:
        # Persons of these visits; a drop level may also be looked up by the visit key.
        pids = written(out["visit"].select("pid").union(keys.select("vid")).distinct(), "refresh")
        for name in ("person", "enroll"):
            if name in after:
                out[name] = _semi(after[name], name, pids, "pid")
        own = _semi(after["note"], "note", keys, "vid")
        rest = _semi(_semi(after["note"].where(F.col("vid").isNotNull()), "note", keys, "vid", "left_anti"), "note", pids, "pid")
        plain = _semi(after["note"].where(F.col("vid").isNull()), "note", pids, "pid")
        out["note"] = own.unionByName(rest).unionByName(plain)
    else:
        out["note"] = _semi(after["note"], "note", keys, "vid")
    return out


def refresh_view(view: str, stored: DataFrame, changes: ChangeSet, before: Tables, after: Tables, **options) -> DataFrame:
    """The stored view brought up to date; equal to the view built from ``after``.

    ``options`` are those of the view, the same as the stored rows were made with. Tables are read in full only to
    find the rows of the affected keys; joins, groups and windows see those rows alone.
    """
    v = VIEWS[view]
    keys = written(affected_keys(view, changes, before, after, options.get("notes_key", "vid")), "refresh")
    fresh = v.build(_reduced(v, keys, after), **options)
    fresh = lookup_join(fresh, keys, [v.key], "left_semi", unique=True)
    kept = lookup_join(stored, keys, [v.key], "left_anti", unique=True)
    return kept.unionByName(fresh.select(*stored.columns))
