"""Duplicates, key remapping and surrogate keys.

Spark rows have no order, so "first" always means first by explicit ``order_by`` columns,
which must tell all rows apart (end them with the row's own key).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import _col
from ..session import written
from .joins import broadcast_join, fits_broadcast, heavy_counts, key_counts, lookup_join, skew_join


def first_per_group(df: DataFrame, keys: Sequence[Column | str], order_by: Sequence[Column | str]) -> DataFrame:
    """The first row of each group; missing keys equal each other.

    A row number kept at 1 is limited per map task before the exchange, so a hot key sends
    one row per task.
    """
    w = W.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str], faithful: bool = False) -> DataFrame:
    """First row per key set. ``faithful`` compares the keys pasted with spaces, so ``A B``+``C``
    equals ``A``+``B C``."""
    if faithful:
        keys = [F.concat_ws(" ", *[F.coalesce(_col(k).cast("string"), F.lit("NA")) for k in keys])]
    return first_per_group(df, keys, order_by)


def keep_first_all_columns(df: DataFrame) -> DataFrame:
    return df.distinct()


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str, tie_break: Sequence[Column] = ()) -> DataFrame:
    """The row with the latest timestamp per key; a missing timestamp counts as latest."""
    return first_per_group(df, keys, [F.col(ts).desc_nulls_first(), *tie_break])


def repeated_groups(df: DataFrame, keys: Sequence[str], id_col: str, order_by: Sequence[str]) -> DataFrame:
    """Keys held by several rows, with the id of the first row as ``_kept`` and their number ``_n``."""
    if len(order_by) == 1:  # over plain columns this aggregates by hash, a struct only by sorting
        first = F.min_by(id_col, order_by[0])
    else:
        first = F.min(F.struct(*[_col(c) for c in order_by], F.col(id_col).alias("_id")))["_id"]
    groups = df.groupBy(*keys).agg(first.alias("_kept"), F.count(F.lit(1)).alias("_n"))
    return groups.where(F.col("_n") > 1)


def alias_key_lookup(
    df: DataFrame,
    keys: Sequence[str],
    id_col: str,
    order_by: Sequence[str],
    dup: str = "dup_id",
    use: str = "use_id",
) -> DataFrame:
    """(id of a repeat, id of the first row of its group).

    Groups are reduced to their first id before anything is joined, and only groups with
    repeats take part in the join. The groups are written, since they are measured, serve to
    find hot keys, and are joined.
    """
    groups = written(repeated_groups(df, keys, id_col, order_by), "groups")
    rows = df.select(*keys, F.col(id_col).alias("_row"))
    counts = groups.select(*keys, "_n")
    return (
        lookup_join(rows, groups.drop("_n"), keys, "inner", null_safe=True, spread_by=["_row"], counts=counts)
        .where(F.col("_row") != F.col("_kept"))
        .select(F.col("_row").alias(dup), F.col("_kept").alias(use))
    )


def split_duplicates(
    df: DataFrame, keys: Sequence[str], id_col: str, order_by: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """(first rows, later repeats). The ids are unique, so splitting by id has no hot key."""
    lookup = written(alias_key_lookup(df, keys, id_col, order_by).select(F.col("dup_id").alias(id_col)), "repeats")
    return (
        lookup_join(df, lookup, [id_col], "left_anti", unique=True),
        lookup_join(df, lookup, [id_col], "left_semi", unique=True),
    )


def remap_keys(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    distinct: bool = False,
    dup: str = "dup_id",
    use: str = "use_id",
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Replace repeated keys by the kept ones; ``distinct`` then drops rows equal throughout.

    Where the lookup is too large to broadcast, equal rows of hot keys are also dropped before the
    join, so that many copies of one row do not meet in one task. Keys are counted in the rows as
    they come, of which only the key need be read; all other rows move once to the join.
    """
    cols = [F.coalesce(F.col(use), F.col(key)).alias(key) if c == key else F.col(f"`{c}`") for c in df.columns]
    lookup = lookup.withColumnRenamed(dup, key)
    if fits_broadcast([lookup]):
        found = broadcast_join(df, lookup, [key])
    elif distinct:
        counts = written(heavy_counts(key_counts(df, [key])), "hot-keys")
        hot = counts.select(key)
        some = not counts.isEmpty()
        rest = broadcast_join(df, hot, [key], "left_anti", null_safe=True) if some else df
        found = rest.join(lookup, [key], "left")
        if some:
            copies = broadcast_join(df, hot, [key], "left_semi", null_safe=True).distinct()
            found = found.unionByName(skew_join(copies, lookup, [key], "left", spread_by=df.columns, counts=counts))
    else:
        found = skew_join(df, lookup, [key], "left", spread_by=spread_by)
    out = found.select(*cols)
    return out.distinct() if distinct else out


def reattach_alias_rows(
    df: DataFrame, keys: Sequence[str], id_col: str, order_by: Sequence[str]
) -> DataFrame:
    """All rows, each repeat under the key of its first row, so old ids still resolve."""
    lookup = written(alias_key_lookup(df, keys, id_col, order_by), "aliases")
    return remap_keys(df, lookup, id_col, spread_by=[id_col])


def dense_surrogate_key(
    df: DataFrame,
    name: str,
    order_by: Sequence[Column | str],
    start: int | Column = 1,
    range_by: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Number rows ``start..start+n-1`` in ``order_by`` order without a single-task sort.

    ``range_by`` is a prefix of the order to cut ranges by, where its tail is wide: the driver
    samples range keys.

    Rows are range-partitioned and sorted, each takes its position in its partition, and the
    result is written before the partition sizes are summed: positions and sizes then come
    from the same written rows, whatever is recomputed later.
    """
    position = F.monotonically_increasing_id()  # partition in the upper bits, row in the lower 33
    placed = (
        df.repartitionByRange(*[_asc(c) for c in range_by or order_by])
        .sortWithinPartitions(*[_asc(c) for c in order_by])
        .withColumn("_pos", position)
        .withColumn("_part", F.shiftright("_pos", 33))
        .withColumn("_pos", F.col("_pos").bitwiseAND(F.lit((1 << 33) - 1)))
    )
    placed = written(placed, "numbered")
    # One row per range partition, so the running sum and the broadcast are bounded.
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    first = F.lit(start).cast("long") if isinstance(start, int) else start.cast("long")
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_pos") + first)
        .select(name, *[F.col(f"`{c}`") for c in df.columns if c != name])
    )


def _asc(c: Column | str) -> Column:
    return F.col(c).asc_nulls_first() if isinstance(c, str) else c


def next_key(existing: DataFrame, key: str) -> int:
    """One past the largest key in use (1 for an empty table)."""
    return (existing.agg(F.max(key)).first()[0] or 0) + 1


def offset_surrogate_key(
    df: DataFrame, name: str, order_by: Sequence[Column | str], existing: DataFrame, key: str | None = None
) -> DataFrame:
    """Dense keys that continue after the largest key of ``existing``."""
    return dense_surrogate_key(df, name, order_by, next_key(existing, key or name))
