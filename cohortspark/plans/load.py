"""The full rebuild: sources, tables, target schema, snapshot, checks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..operators import identity, quality
from ..sources import snapshot
from ..sources.layout import Layout
from ..sources.seeds import seed_dimensions
from .tables import build_all

# Keys the target numbers itself when rows arrive without one: the narrow columns and the wide ones
# that tell rows apart.
SERIAL = {
    "contact": ("cid", ["pid", "relation", "ctype"], ["who", "cvalue"]),
    "visit_task": ("vtid", ["vid", "task"], ["measures"]),
}


def conform(name: str, df: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """The frame with the target's columns and types; what it lacks is null, but a serial key
    is numbered on from ``existing``."""
    if name in SERIAL and SERIAL[name][0] not in df.columns:
        key, narrow, wide = SERIAL[name]
        start = identity.next_key(existing, key) if existing is not None else 1
        ranges = [*narrow, F.xxhash64(*wide)]
        df = identity.dense_surrogate_key(df, key, [*ranges, *wide], start, range_by=ranges)
    fields = T.StructType.fromDDL(S.TABLES[name].columns).fields
    extra = set(df.columns) - {f.name for f in fields}
    if extra:
        raise ValueError(f"{name} has no columns {sorted(extra)}")
    return df.select(
        *[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    )


def rebuild(
    spark: SparkSession, sources: Mapping[str, DataFrame], base: str, as_of: str, layout: Layout | None = None, **options
) -> DataFrame:
    """Build all tables, publish them with the seed dimensions as one snapshot, and return what
    breaks the declared constraints (empty when all hold)."""
    built = build_all(sources, as_of, layout=layout or Layout(), **options)
    seeds = seed_dimensions(spark)
    seeds["dropcode"] = seeds["dropcode"].select("dropcode", "droplevel")
    tables = {name: conform(name, df) for name, df in {**built, **seeds}.items()}
    snapshot.write_snapshot(tables, base, ingest_ts=as_of)
    snapshot.save_freshness(spark, base)
    return quality.check_tables(snapshot.load_snapshot(spark, base))
