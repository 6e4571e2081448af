"""Checks of declared constraints. Each returns violations as a frame."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import TABLES, Table
from .joins import skew_join
from .reshape import union_by_name

_SUBJECT = ("table_name", "check_name", "subject")


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, n_null) for every column, from one aggregation."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], list(cols), "column_name", "n_null")


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n) held by several rows; a missing part never equals another."""
    known = df
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    return known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def check_foreign_key(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """(fk, n): referenced keys that the parent lacks, with the number of rows naming them.

    References are counted first and parent keys made distinct, so a hot key reaches the join as one row on either side.
    """
    named = child.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("n"))
    return named.join(parent.select(F.col(pk).alias("_pk")).distinct(), F.col(fk) == F.col("_pk"), "left_anti")


def orphan_rows(child: DataFrame, fk: str, parent: DataFrame, pk: str, spread_by: Sequence[str] | None = None) -> DataFrame:
    """The whole child rows whose reference is not in the parent."""
    keys = parent.select(F.col(pk).alias(fk)).distinct()
    return skew_join(child.where(F.col(fk).isNotNull()), keys, [fk], "left_anti", spread_by=spread_by)


def check_enum_domain(df: DataFrame, col: str, levels: Sequence[str]) -> DataFrame:
    """(value, n) outside the enum."""
    bad = df.where(~F.col(col).isin(list(levels)))
    return bad.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def check_length(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """(column_name, n_too_long, longest) for every limited column, from one aggregation."""
    found = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count_if(F.char_length(F.col(c)) > n).alias("n_too_long"),
                F.max(F.char_length(F.col(c))).alias("longest"),
            ).alias(c)
            for c, n in limits.items()
        ]
    )
    return found.select(F.explode(F.array(*limits)).alias("c")).select("c.*")


def check_numeric_range(df: DataFrame, col: str, precision: int, scale: int) -> DataFrame:
    """Rows whose value does not fit ``numeric(precision, scale)`` after rounding."""
    fitted = F.col(col).try_cast(f"decimal({precision},{scale})")
    return df.where(F.col(col).isNotNull() & fitted.isNull())


def _key_part(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """Text that two values share if and only if they are equal as ``want``; a value that is none of ``want`` keeps its own text."""
    if have != want:
        as_want = value.try_cast(want)
        same = as_want.isNotNull() & (as_want == value)
        return F.when(same, _key_part(as_want, want, want)).otherwise(F.concat(F.lit("other "), value.cast("string")))
    if isinstance(want, T.TimestampType):
        return F.unix_micros(value).cast("string")
    if isinstance(want, (T.FloatType, T.DoubleType)):
        return (value + F.lit(0.0).cast(want)).cast("string")  # -0.0 equals 0.0
    if isinstance(want, T.BinaryType):
        return F.hex(value)
    return value.cast("string")


def _entry(cols: Sequence[str], have: Sequence[T.DataType], want: Sequence[T.DataType]) -> tuple[Column, Column]:
    """A key as (whole number, text): two keys share both if and only if all parts are equal as ``want``.

    The first part that is a whole number by ``want`` stays one, all others become text. Only a key of one part may have
    other types than ``want``: a value that is none of ``want`` keeps its own text.
    """
    number, texts = F.lit(None).cast("long"), []
    at = next((i for i, t in enumerate(want) if isinstance(t, T.IntegralType)), None)
    for i, (c, h, w) in enumerate(zip(cols, have, want)):
        value = F.col(c)
        if i != at:
            texts.append(_key_part(value, h, w))
        elif isinstance(h, T.IntegralType):
            number = value.cast("long")
        else:
            as_want = value.try_cast(w)
            number = F.when(as_want == value, as_want.cast("long"))
            texts.append(F.when(number.isNull(), value.cast("string")))
    if len(texts) > 1:  # with its length before it each part but the last can be told from what follows
        texts = [F.concat(*[part for t in texts[:-1] for part in (F.char_length(t).cast("string"), F.lit(" "), t)], texts[-1])]
    return number, texts[0] if texts else F.lit(None).cast("string")


def check_keys(tables: Mapping[str, DataFrame], specs: Mapping[str, Table]) -> DataFrame | None:
    """Unique and foreign keys of all ``specs`` as (table_name, check_name, subject, n_bad), violations only; None without any.

    Every table is read once and stacks an entry for each key it holds and each reference it makes. Entries of one key meet in a
    single exchange for all constraints: a key held twice breaks ``unique`` (counted by keys), one named but not held breaks
    ``foreign_key`` (counted by rows that name it). Counts combine before the exchange, so a hot key arrives as a row per map task.
    A key or reference with a missing part takes no part. Whole numbers are compared as such, other parts as text.
    """
    types = {n: {f.name: f.dataType for f in df.schema.fields} for n, df in tables.items()}
    owners: dict[tuple, int] = {}
    slots: dict[int, int] = {}
    entries: dict[str, dict[tuple, Column]] = {}
    subjects: list[tuple[int, int, str, str, str]] = []

    def enter(name: str, owner: int, slot: int, cols: Sequence[str], want: Sequence[T.DataType]) -> None:
        number, told = _entry(cols, [types[name][c] for c in cols], want)
        known = functools.reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
        entry = F.when(known, F.struct(F.lit(owner).alias("owner"), F.lit(slot).alias("slot"), number.alias("number"), told.alias("text")))
        entries.setdefault(name, {})[owner, slot] = entry

    def held(name: str, keys: tuple[str, ...]) -> int:
        if (name, keys) not in owners:
            owners[name, keys] = len(owners)
            enter(name, owners[name, keys], 0, keys, [types[name][k] for k in keys])
        return owners[name, keys]

    for name, spec in specs.items():
        for keys in dict.fromkeys((spec.pk, *spec.unique)):
            if keys and set(keys) <= set(types[name]):
                subjects.append((held(name, tuple(keys)), 0, name, "unique", ",".join(keys)))
        for fk, (parent, pk) in spec.refs.items():
            if fk in types[name] and pk in types.get(parent, ()):
                owner = held(parent, (pk,))
                slots[owner] = slots.get(owner, 0) + 1
                enter(name, owner, slots[owner], [fk], [types[parent][pk]])
                subjects.append((owner, slots[owner], name, "foreign_key", f"{fk}->{parent}.{pk}"))
    if not subjects:
        return None
    stacked = [
        tables[name].select(F.explode(F.array(*found.values())).alias("e")).where(F.col("e").isNotNull()).select("e.*")
        for name, found in entries.items()
    ]
    named = [f"named_{s}" for s in range(1, max(slots.values(), default=0) + 1)]
    groups = union_by_name(*stacked).groupBy("owner", "number", "text").agg(
        F.count_if(F.col("slot") == 0).alias("held"), *[F.count_if(F.col("slot") == s).alias(c) for s, c in enumerate(named, 1)]
    )
    missing = [F.sum(F.when(F.col("held") == 0, F.col(c)).otherwise(0)).alias(c) for c in named]
    bad = groups.groupBy("owner").agg(F.count_if(F.col("held") > 1).alias("held"), *missing)
    bad = bad.select("owner", F.posexplode(F.array("held", *named)).alias("slot", "n_bad")).where(F.col("n_bad") > 0)
    told = F.create_map(*[
        part for o, s, *texts in subjects
        for part in (F.lit(f"{o}:{s}"), F.struct(*[F.lit(t).alias(c) for t, c in zip(texts, _SUBJECT)]))
    ])
    bad = bad.select(F.try_element_at(told, F.concat_ws(":", "owner", "slot")).alias("told"), F.col("n_bad").cast("long").alias("n_bad"))
    return bad.where(F.col("told").isNotNull()).select("told.*", "n_bad")


def _check_rows(name: str, df: DataFrame, spec: Table) -> DataFrame | None:
    """All checks that look at one row, from one aggregation; None where nothing is declared of the columns the frame has."""
    have = set(df.columns)
    needed = [c for c in dict.fromkeys((*spec.pk, *spec.not_null)) if c in have]
    counts = [F.count_if(F.col(c).isNull()).alias(f"not_null:{c}") for c in needed]
    counts += [
        F.count_if(~F.col(c).isin(levels)).alias(f"enum:{c}") for c, levels in spec.enums.items() if c in have
    ]
    counts += [
        F.count_if(F.char_length(F.col(c)) > n).alias(f"length:{c}") for c, n in spec.lengths.items() if c in have
    ]
    counts += [
        F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(f"decimal({p},{s})").isNull()).alias(f"range:{c}")
        for c, (p, s) in spec.numerics.items() if c in have
    ]
    if not counts:
        return None
    found = df.agg(*counts)
    long = found.unpivot([], found.columns, "what", "n_bad")
    part = F.split("what", ":", 2)
    return long.select(
        F.lit(name).alias("table_name"), part[0].alias("check_name"),
        part[1].alias("subject"), F.col("n_bad").cast("long").alias("n_bad"),
    ).where(F.col("n_bad") > 0)


def _check(tables: Mapping[str, DataFrame], specs: Mapping[str, Table]) -> DataFrame:
    found = [_check_rows(n, tables[n], spec) for n, spec in specs.items()] + [check_keys(tables, specs)]
    return union_by_name(*[f for f in found if f is not None])


def check_table(name: str, tables: Mapping[str, DataFrame], declared: Table | None = None) -> DataFrame:
    """All checks of one table as (table_name, check_name, subject, n_bad), violations only.

    Columns the frame lacks count as missing values only where declared not null.
    """
    return _check(tables, {name: declared or TABLES[name]})


def check_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``check_table`` over every given table that the target declares: each is read once for the checks of single rows and
    once for all its keys and references, whatever their number."""
    return _check(tables, {n: TABLES[n] for n in tables if n in TABLES})
