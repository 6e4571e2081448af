"""Target tables kept in the session catalog, bucketed by the keys they are joined on."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from .snapshot import aligned

# The key each table is mostly joined or grouped by.
JOIN_KEY = {
    "person": "pid", "enroll": "pid", "visit": "vid", "visit_study": "vid", "visit_task": "vid",
    "visit_action": "vid", "visit_enroll": "vid", "note": "vid", "contact": "pid",
}


def save_bucketed(
    tables: Mapping[str, DataFrame], buckets: int, database: str = "default", keys: Mapping[str, str] = JOIN_KEY
) -> None:
    """Save tables bucketed and sorted by their key: views then group and join them by visit
    without moving rows. Use the same number of buckets for all."""
    for name, df in tables.items():
        writer = df.write.mode("overwrite").format("parquet")
        if name in keys:
            df = df.repartition(buckets, keys[name])  # one file per bucket
            writer = df.write.mode("overwrite").format("parquet").bucketBy(buckets, keys[name]).sortBy(keys[name])
        writer.saveAsTable(f"{database}.{name}")


def append_to_catalog(tables: Mapping[str, DataFrame], database: str = "default") -> None:
    """Append each frame to the catalog table of the same name, columns matched by name."""
    for name, df in tables.items():
        target = f"{database}.{name}"
        aligned(df, df.sparkSession.table(target), name).write.insertInto(target)


def load_catalog(spark: SparkSession, *names: str, database: str = "default") -> dict[str, DataFrame]:
    return {n: spark.table(f"{database}.{n}") for n in names}
