"""Joins that hold up when one key owns a large share of the rows.

Three ways, chosen by the size of what is joined:

* a lookup whose size was measured and is small is broadcast, so the large side never moves;
* otherwise the keys owning the most rows are salted: their rows spread over several tasks and
  the matching rows of the other side are repeated once per salt, every other key joins as usual;
* child tables are first grouped by key (``star_join``), so no key repeats at all.

A key is heavy from ``HEAVY_ROWS`` rows on, or from ``1/HEAVY_PARTS`` of all rows where that is more. So there are at
most ``HEAVY_PARTS`` heavy keys, whatever the data: their list may be broadcast, and none is left out of it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
HEAVY_ROWS = 1_000_000
HEAVY_PARTS = 100_000


def measured_bytes(df: DataFrame) -> int:
    """Size of the values in ``df``: text by its length, nested values as JSON, others 16 bytes each."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    row = F.lit(0).cast("long")
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, nested):
            size = F.octet_length(F.to_json(c))
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = F.octet_length(c)
        else:
            size = F.lit(0)
        row = row + F.coalesce(size, F.lit(0)).cast("long") + 16
    return df.agg(F.sum(row)).first()[0] or 0


def fits_broadcast(frames: Sequence[DataFrame], limit: int | None = None) -> bool:
    """Whether the measured sizes of the frames add up to at most ``limit`` (``BROADCAST_BYTES``)."""
    limit = BROADCAST_BYTES if limit is None else limit
    total = 0
    for df in frames:
        total += measured_bytes(df)
        if total > limit:
            return False
    return True


def key_counts(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows per key as ``_n``, combined on the map side."""
    return df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))


def heavy_counts(counts: DataFrame, min_rows: int | None = None) -> DataFrame:
    """Of ``key_counts``, all keys with more than ``min_rows`` rows (``HEAVY_ROWS``), or more than
    ``1/HEAVY_PARTS`` of the rows where that is more."""
    share = counts.agg(F.sum("_n") / F.lit(HEAVY_PARTS)).scalar()
    return counts.where((F.col("_n") > (min_rows or HEAVY_ROWS)) & (F.col("_n") > share))


def heavy_keys(counts: DataFrame, on: Sequence[str], min_rows: int | None = None) -> DataFrame:
    """``heavy_counts`` with a number of salts such that each covers about ``min_rows`` rows."""
    min_rows = min_rows or HEAVY_ROWS
    return heavy_counts(counts, min_rows).select(
        *[F.col(k).alias(f"_heavy_{k}") for k in on],
        F.ceil(F.col("_n") / F.lit(min_rows)).cast("int").alias("_salts"),
    )


def _on(pairs: Sequence[tuple[str, str]], null_safe: bool) -> Column:
    cond = F.lit(True)
    for a, b in pairs:
        same = F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) == F.col(b)
        cond = cond & same
    return cond


def skew_join(
    many: DataFrame,
    one: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    null_safe: bool = False,
    spread_by: Sequence[str] | None = None,
    counts: DataFrame | None = None,
    min_rows: int | None = None,
) -> DataFrame:
    """Join ``many`` (keys may be hot) to ``one`` on equally named columns, salting the hot keys.

    ``how`` is inner, left, left_semi or left_anti. ``spread_by`` names columns that tell the rows
    of one key apart; the salt is their hash, so a recomputed task sends every row where it went
    before. Without it rows may be exact copies, which no hash tells apart: they are dealt out
    evenly first (Spark sorts before dealing, so this too repeats exactly) and salted by partition.
    ``counts`` gives known ``key_counts``, where counting ``many`` itself would repeat work. Keys
    of ``many`` are kept, those of ``one`` dropped.
    """
    on = list(on)
    heavy = heavy_keys(key_counts(many, on) if counts is None else counts, on, min_rows)
    to_heavy = _on([(k, f"_heavy_{k}") for k in on], null_safe=True)
    if spread_by:
        spread = F.xxhash64(*[F.col(f"`{c}`") for c in spread_by])
    else:
        many = many.repartition(int(many.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        spread = F.spark_partition_id()
    salted = (
        many.join(F.broadcast(heavy), to_heavy, "left")
        .withColumn("_salt", F.coalesce(F.pmod(spread, F.col("_salts")).cast("int"), F.lit(0)))
        .drop(*heavy.columns)
    )
    salts = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    repeated = (
        one.join(F.broadcast(heavy), to_heavy, "left")
        .withColumn("_other_salt", F.explode(salts))
        .drop(*heavy.columns)
        .withColumnsRenamed({k: f"_other_{k}" for k in on})
    )
    cond = _on([(k, f"_other_{k}") for k in on], null_safe) & (F.col("_salt") == F.col("_other_salt"))
    out = salted.join(repeated, cond, how)
    return out.drop("_salt", "_other_salt", *[f"_other_{k}" for k in on])


def _plain_join(facts: DataFrame, lookup: DataFrame, on: Sequence[str], how: str, null_safe: bool, hint: bool):
    renamed = lookup.withColumnsRenamed({k: f"_other_{k}" for k in on})
    cond = _on([(k, f"_other_{k}") for k in on], null_safe)
    right = F.broadcast(renamed) if hint else renamed
    return facts.join(right, cond, how).drop(*[f"_other_{k}" for k in on])


def broadcast_join(
    facts: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left", null_safe: bool = False
) -> DataFrame:
    """Join to a lookup whose size the caller has checked; keys of ``facts`` are kept."""
    return _plain_join(facts, lookup, on, how, null_safe, hint=True)


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    spread_by: Sequence[str] | None = None,
    counts: DataFrame | None = None,
    bound_by: Sequence[DataFrame] | None = None,
    unique: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Join facts to a lookup: broadcast it when its measured size allows, else salt hot keys.

    ``unique`` says that no key of the facts repeats, so that none can be hot.

    ``bound_by`` names frames that together are at least as large as the lookup and cheaper to
    measure, such as the tables it is grouped from.
    """
    fits = fits_broadcast(bound_by or [lookup], limit)
    if unique and not fits:
        return _plain_join(facts, lookup, on, how, null_safe, hint=False)
    if not fits:
        return skew_join(facts, lookup, on, how, null_safe, spread_by, counts)
    return broadcast_join(facts, lookup, on, how, null_safe)


def shared_columns(a: DataFrame, b: DataFrame) -> list[str]:
    return [c for c in a.columns if c in b.columns]


def join_common_columns(many: DataFrame, one: DataFrame, spread_by: Sequence[str] | None = None) -> DataFrame:
    """Inner join on all shared columns; missing values match each other."""
    return lookup_join(many, one, shared_columns(many, one), "inner", True, spread_by)


def join_renamed_key(
    many: DataFrame, one: DataFrame, many_key: str, one_key: str, spread_by: Sequence[str] | None = None
) -> DataFrame:
    """Inner join where the key has another name on the right; the left name stays."""
    return lookup_join(many, one.withColumnRenamed(one_key, many_key), [many_key], "inner", False, spread_by)


def left_join_lookup(
    facts: DataFrame, lookup: DataFrame, on: Sequence[str], null_safe: bool = True, spread_by=None
) -> DataFrame:
    return lookup_join(facts, lookup, on, "left", null_safe, spread_by)


def anti_join_missing(a: DataFrame, b: DataFrame, on: Sequence[str], spread_by=None) -> DataFrame:
    """Rows of ``a`` whose key does not occur in ``b``."""
    keys = b.select(*on)
    return lookup_join(a, keys.distinct(), on, "left_anti", True, spread_by, bound_by=[keys])


def natural_join(one: DataFrame, many: DataFrame, spread_by: Sequence[str] | None = None) -> DataFrame:
    """SQL natural join of a parent with its children, columns in SQL order."""
    on = shared_columns(one, many)
    order = on + [c for c in one.columns if c not in on] + [c for c in many.columns if c not in on]
    return skew_join(many, one, on, "inner", spread_by=spread_by).select(*order)


def natural_left_join(one: DataFrame, many: DataFrame, spread_by: Sequence[str] | None = None) -> DataFrame:
    """SQL natural left join keeping parents without children.

    The preserved side cannot be repeated per salt, so matches and parents without any are
    found separately and stacked.
    """
    on = shared_columns(one, many)
    matched = natural_join(one, many, spread_by)
    childless = one.join(many.select(*on).distinct(), on, "left_anti")
    return matched.unionByName(childless, allowMissingColumns=True)


def left_join_with_predicate(
    one: DataFrame, many: DataFrame, on: Sequence[str], predicate: Column, spread_by=None
) -> DataFrame:
    """Left join whose ON also tests the right row: filter the right side, then left join."""
    names = [c for c in one.columns if c in many.columns and c not in on]
    if names:
        raise ValueError(f"columns on both sides: {names}")
    return natural_left_join(one, many.where(predicate), spread_by)


def left_join_on_expression(facts: DataFrame, one: DataFrame, keys: Mapping[str, str], spread_by=None) -> DataFrame:
    """Left join of ``facts`` to a keyed view: ``{facts column: view column}``; plain SQL equality."""
    renamed = one.withColumnsRenamed({v: k for k, v in keys.items()})
    return lookup_join(facts, renamed, list(keys), "left", False, spread_by)


def scalar_lookup(df: DataFrame, dim: DataFrame, key: str, col: str, spread_by=None) -> DataFrame:
    """Add one column of ``dim`` by its unique key (a correlated scalar subquery)."""
    return lookup_join(df, dim.select(key, col), [key], "left", False, spread_by)


def star_join(root: DataFrame, children: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Left join a keyed root to children that were already grouped by the same key.

    All sides share one hash partitioning, so the joins add no exchange beyond one per input.
    """
    for child in children:
        root = root.join(child, list(on), "left")
    return root
