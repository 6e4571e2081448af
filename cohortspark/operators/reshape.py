"""Wide to long and back, and stacking of frames."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ungroup_column_families(df: DataFrame, family_regex: str, key_name: str, ids: Sequence[str]) -> DataFrame:
    """``Contact1Email, Contact2Email, ...`` to one row per family and input row.

    The matched name part becomes ``key_name``, what follows it the column; one scan whatever
    the number of families.
    """
    rx = re.compile(family_regex)
    families: dict[str, dict[str, str]] = {}
    fields: list[str] = []
    for c in df.columns:
        m = rx.match(c)
        if not m or c in ids:
            continue
        name = c[m.end():]
        families.setdefault(m.group(0), {})[name] = c
        if name not in fields:
            fields.append(name)
    rows = [
        F.struct(
            F.lit(fam).alias(key_name),
            *[(F.col(f"`{cols[f]}`") if f in cols else F.lit(None)).cast("string").alias(f) for f in fields],
        )
        for fam, cols in families.items()
    ]
    return df.select(*ids, F.explode(F.array(*rows)).alias("_fam")).select(*ids, "_fam.*")


def unpivot_values(
    df: DataFrame, ids: Sequence[str], key: str, value: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """All other columns, as text, to (key, value) rows."""
    cols = list(columns) if columns is not None else [c for c in df.columns if c not in ids]
    text = df.select(*ids, *[F.col(f"`{c}`").cast("string").alias(c) for c in cols])
    return text.unpivot(list(ids), [F.col(f"`{c}`") for c in cols], key, value)


def unpivot_flags(
    df: DataFrame,
    ids: Sequence[str],
    flags: Sequence[str],
    key: str = "flag",
    pred: Callable[[Column], Column] = lambda v: v == 1,
    order: str | None = None,
) -> DataFrame:
    """One row per set flag; unset and missing flags produce none. ``order`` adds the flag's position."""
    hits = F.array(
        *[
            F.when(pred(F.col(f"`{c}`")), F.struct(F.lit(i).alias("pos"), F.lit(c).alias("name")))
            for i, c in enumerate(flags)
        ]
    )
    out = df.select(*ids, F.explode(F.array_compact(hits)).alias("_hit"))
    extra = [F.col("_hit.pos").alias(order)] if order else []
    return out.select(*ids, F.col("_hit.name").alias(key), *extra)


def unpivot_dynamic_flags(df: DataFrame, ids: Sequence[str], drop: Sequence[str], key: str = "flag") -> DataFrame:
    """Like ``unpivot_flags`` over whatever columns remain after the ids and the dropped ones."""
    flags = [c for c in df.columns if c not in ids and c not in drop]
    return unpivot_flags(df, ids, flags, key)


def unpivot_actions(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], key: str = "action", value: str = "value",
    order: str = "_col_ord",
) -> DataFrame:
    """Action columns to rows, blanks removed; ``order`` is the position of the source column."""
    items = F.array(
        *[
            F.struct(F.lit(i).alias("pos"), F.lit(c).alias("name"), F.col(c).cast("string").alias("val"))
            for i, c in enumerate(columns)
        ]
    )
    filled = F.filter(items, lambda s: s["val"] != "")
    return df.select(*ids, F.explode(filled).alias("_a")).select(
        *ids, F.col("_a.name").alias(key), F.col("_a.val").alias(value), F.col("_a.pos").alias(order)
    )


def collapse_labels(df: DataFrame, keys: Sequence[str], label: str, order: str, out: str, sep: str = ",") -> DataFrame:
    """Join the labels of each key in ``order``; a key has at most one label per flag column."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(label).alias("v"))))
    return df.groupBy(*keys).agg(F.array_join(F.transform(pairs, lambda s: s["v"]), sep).alias(out))


def collapsed_flags(flags: Sequence[str], pred: Callable[[Column], Column] = lambda v: v > 0, sep: str = ",") -> Column:
    """The set flags of one row joined in column order, null when none is set.

    Equals ``unpivot_flags`` and ``collapse_labels`` by the row's key, without moving a row.
    """
    names = F.concat_ws(sep, *[F.when(pred(F.col(f"`{c}`")), F.lit(c)) for c in flags])
    return F.nullif(names, F.lit(""))


def _stack(dfs: Sequence[DataFrame], missing: bool) -> DataFrame:
    level = list(dfs)
    while len(level) > 1:  # pairwise, so each frame is analysed log(n) times rather than n
        pairs = [level[i:i + 2] for i in range(0, len(level), 2)]
        level = [p[0].unionByName(p[1], allowMissingColumns=missing) if len(p) == 2 else p[0] for p in pairs]
    return level[0]


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """Stack frames with the same columns in any order."""
    return _stack(dfs, missing=False)


def union_fill_missing(dfs: Sequence[DataFrame]) -> DataFrame:
    """Stack frames with differing columns; what a frame lacks is null."""
    return _stack(dfs, missing=True)
