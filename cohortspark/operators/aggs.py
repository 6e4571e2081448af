"""Aggregations. Functions ending in ``_of`` are columns to be combined in one ``groupBy``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import enum_label, enum_rank
from ..functions.dates import _col
from ..functions.jsons import json_text


def sorted_set_of(col: Column | str) -> Column:
    """Sorted distinct values as an array, null kept (last). Repeats combine on the map side."""
    kept = F.collect_set(F.struct(_col(col).alias("v")))
    return F.array_sort(F.transform(kept, lambda s: s["v"]))


def json_set_of(col: Column | str) -> Column:
    """Sorted JSON array of distinct values; null stays an element."""
    return json_text(sorted_set_of(col))


def ordinal_max_of(col: Column | str, levels: Sequence[str]) -> Column:
    """The highest label of an ordered enum: a maximum over integer ranks, mapped back."""
    return enum_label(F.max(enum_rank(col, levels)), levels)


def max_where_of(col: Column | str, predicate: Column) -> Column:
    return F.max(F.when(predicate, _col(col)))


def first_where_of(col: Column | str, predicate: Column) -> Column:
    """First of the sorted distinct values where the predicate holds (text order)."""
    return F.min(F.when(predicate, _col(col)))


def group_max(df: DataFrame, keys: Sequence[str], col: str, out: str | None = None) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(col).alias(out or col))


def max_text(df: DataFrame, keys: Sequence[str], col: str, out: str | None = None) -> DataFrame:
    """Highest text by binary order."""
    return df.groupBy(*keys).agg(F.max(_col(col).cast("string")).alias(out or col))


def max_ordinal(df: DataFrame, keys: Sequence[str], col: str, levels: Sequence[str], out: str | None = None) -> DataFrame:
    return df.groupBy(*keys).agg(ordinal_max_of(col, levels).alias(out or col))


def conditional_max(df: DataFrame, keys: Sequence[str], col: str, predicate: Column, out: str | None = None) -> DataFrame:
    return df.groupBy(*keys).agg(max_where_of(col, predicate).alias(out or col))


def filtered_first(df: DataFrame, keys: Sequence[str], col: str, predicate: Column, out: str | None = None) -> DataFrame:
    return df.groupBy(*keys).agg(first_where_of(col, predicate).alias(out or col))


def json_agg_distinct(df: DataFrame, keys: Sequence[str], expr: Column | str, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(json_set_of(expr).alias(out))


def json_agg_all(df: DataFrame, keys: Sequence[str], expr: Column | str, out: str) -> DataFrame:
    """Sorted JSON array of all values with repeats; null stays an element.

    Equal values are counted first and repeated at the end, so a hot key is split by its values
    and only its distinct ones are brought together.
    """
    counted = df.groupBy(*keys, _col(expr).alias("_v")).agg(F.count(F.lit(1)).cast("int").alias("_n"))
    pairs = F.array_sort(F.collect_list(F.struct(F.col("_v").isNull().alias("last"), "_v", "_n")))
    values = F.flatten(F.transform(pairs, lambda p: F.array_repeat(p["_v"], p["_n"])))
    return counted.groupBy(*keys).agg(json_text(values).alias(out))


def collect_json_array(df: DataFrame, keys: Sequence[str], col: str, order: str, out: str) -> DataFrame:
    """JSON array of ``col`` per key in ``order``."""
    pairs = F.array_sort(F.collect_list(F.struct(_col(order).alias("o"), _col(col).alias("v"))))
    return df.groupBy(*keys).agg(json_text(F.transform(pairs, lambda s: s["v"])).alias(out))


def count_distinct(df: DataFrame, keys: Sequence[str], cols: Mapping[str, str]) -> DataFrame:
    """Exact distinct counts ``{output: column}`` per key.

    Distinct (key, value) pairs are found first, so a hot key is split by its values.
    """
    return df.groupBy(*keys).agg(*[F.count_distinct(_col(c)).alias(name) for name, c in cols.items()])


def tally_groups(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def distinct_values(df: DataFrame, col: str, extra: Sequence[str] = ()) -> DataFrame:
    """Distinct values of a column together with fixed ones, each once."""
    values = df.select(col).distinct()
    if extra:
        fixed = df.sparkSession.createDataFrame([(v,) for v in extra], f"`{col}` string")
        values = values.union(fixed).distinct()
    return values


def count_guards(parents: DataFrame, children: Sequence[DataFrame], key: str, out: str = "n_blocking") -> DataFrame:
    """Per parent, the number of rows over all children.

    The children are stacked as bare keys and counted in one exchange.
    """
    stacked = children[0].select(key)
    for child in children[1:]:
        stacked = stacked.union(child.select(key))
    counts = stacked.groupBy(key).agg(F.count(F.lit(1)).alias(out))
    return parents.join(counts, key, "left").withColumn(out, F.coalesce(F.col(out), F.lit(0)))


def scalar_max(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    return df.agg(F.max(col).alias(out or col))
