"""Table bundles on shared storage, changed as a whole.

Every write goes to fresh folders. One row appended to ``published`` then names the folders that
make up each table, so a reader sees either the old bundle or all of the new one, and a change
writes only the tables it touches. Each row has a number one above that of the bundle it was made from, and a
number is given out once: of two writers that start from one bundle the second gets an error, never a lost change.
"""

from __future__ import annotations

from collections.abc import Mapping
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import create_new, exists

INGEST_TS = "ingest_ts"
ENTRY = "snapshot string, seq long, tables map<string, array<string>>"


class ConcurrentWrite(RuntimeError):
    """Another writer has published since, or is about to."""


def stamped(df: DataFrame, ingest_ts: str | None) -> DataFrame:
    return df if ingest_ts is None else df.withColumn(INGEST_TS, F.lit(ingest_ts).cast("timestamp_ntz"))


def current_snapshot(spark: SparkSession, base: str) -> tuple[str, int, dict[str, list[str]]] | None:
    """(id, sequence number, folders of each table) of the bundle published last."""
    if not exists(spark, f"{base}/published"):
        return None
    row = spark.read.schema(ENTRY).parquet(f"{base}/published").orderBy(F.desc("seq")).first()
    return (row["snapshot"], row["seq"], dict(row["tables"])) if row else None


def _write(tables: Mapping[str, DataFrame], base: str, snapshot: str) -> dict[str, list[str]]:
    folders = {}
    for name, df in tables.items():
        folders[name] = [f"data/{snapshot}/{name}"]
        df.write.parquet(f"{base}/{folders[name][0]}")
    return folders


def sequence(spark: SparkSession, base: str) -> int:
    """The number of the bundle published last, 0 before the first."""
    last = current_snapshot(spark, base)
    return last[1] if last else 0


def _publish(spark: SparkSession, base: str, snapshot: str, folders: Mapping[str, list[str]], based_on: int) -> str:
    """Publish the change that follows ``based_on``; readers skip the claim, a file with a leading underscore."""
    seq = based_on + 1
    claim = f"{base}/published/_claim-{seq:012d}"
    if sequence(spark, base) != based_on or not create_new(spark, claim):
        raise ConcurrentWrite(f"{base} has a change {seq} of another writer; if that writer failed before it published, remove {claim}")
    entry = spark.createDataFrame([(snapshot, seq, dict(folders))], ENTRY)
    entry.coalesce(1).write.mode("append").parquet(f"{base}/published")
    return snapshot


def write_snapshot(tables: Mapping[str, DataFrame], base: str, ingest_ts: str | None = None) -> str:
    """Write all tables as a new bundle and publish it; returns its id."""
    spark = next(iter(tables.values())).sparkSession
    snapshot, based_on = uuid4().hex, sequence(spark, base)
    frames = {n: stamped(df, ingest_ts) for n, df in tables.items()}
    return _publish(spark, base, snapshot, _write(frames, base, snapshot), based_on)


def load_snapshot(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The tables of the bundle published last."""
    return _tables(spark, base, current_snapshot(spark, base))


def _tables(spark: SparkSession, base: str, found: tuple[str, int, dict[str, list[str]]] | None) -> dict[str, DataFrame]:
    if found is None:
        raise FileNotFoundError(f"no published snapshot in {base}")
    return {n: spark.read.parquet(*[f"{base}/{f}" for f in folders]) for n, folders in found[2].items()}


def aligned(df: DataFrame, target: DataFrame, name: str) -> DataFrame:
    """The frame with the target's columns and types, matched by name.

    Columns the frame lacks become null; columns the target lacks are an error.
    """
    fields = target.schema.fields
    extra = set(df.columns) - {f.name for f in fields}
    if extra:
        raise ValueError(f"{name} has no columns {sorted(extra)}")
    return df.select(
        *[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    )


def revise_snapshot(
    spark: SparkSession,
    base: str,
    append: Mapping[str, DataFrame] | None = None,
    replace: Mapping[str, DataFrame] | None = None,
    ingest_ts: str | None = None,
    based_on: int | None = None,
) -> str:
    """Publish the current bundle with rows appended to some tables and others replaced.

    ``based_on`` is the number of the bundle that the frames were made from, if that was read before.
    """
    found = current_snapshot(spark, base)
    current = _tables(spark, base, found)
    if based_on is not None and based_on != found[1]:
        raise ConcurrentWrite(f"{base} is at change {found[1]}, not at {based_on}")
    folders, based_on = found[2], found[1]
    snapshot = uuid4().hex
    new = {n: aligned(stamped(df, ingest_ts), current[n], n) for n, df in (append or {}).items()}
    added = _write(new, base, f"{snapshot}/added")
    replaced = _write(replace or {}, base, snapshot)
    after = {**folders, **replaced}
    for name, extra in added.items():
        after[name] = [*after[name], *extra]
    return _publish(spark, base, snapshot, after, based_on)


def append_tables(tables: Mapping[str, DataFrame], base: str, ingest_ts: str | None = None) -> str:
    """Append each frame to the table of the same name, all at once; the first call creates them."""
    spark = next(iter(tables.values())).sparkSession
    if current_snapshot(spark, base) is None:
        snapshot = write_snapshot(tables, base, ingest_ts)
    else:
        snapshot = revise_snapshot(spark, base, append=tables, ingest_ts=ingest_ts)
    if ingest_ts is not None:
        save_freshness(spark, base)
    return snapshot


def replace_snapshot(spark: SparkSession, src: str, dst: str) -> str:
    """Copy the current bundle of ``src`` over ``dst``: written aside, then published."""
    return write_snapshot(load_snapshot(spark, src), dst)


def freshness_marker(df: DataFrame, ts_col: str = INGEST_TS, out: str = "last_update") -> DataFrame:
    return df.agg(F.max(ts_col).alias(out))


def save_freshness(spark: SparkSession, base: str, table: str = "visit") -> None:
    """Keep the latest ingest time of a published table beside the bundle, where it has one."""
    found = load_snapshot(spark, base).get(table)
    if found is None or INGEST_TS not in found.columns:
        return
    marker = freshness_marker(found)
    marker.coalesce(1).write.mode("append").parquet(f"{base}/last_update")
