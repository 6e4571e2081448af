"""Latest visit status, kept up to date from a growing action log.

Spark's state store holds one row per visit: the highest action key seen and its action. Each
micro-batch writes the visits it changed to a folder named by the batch, overwriting it, so a
replayed batch leaves the same files. Reading keeps the highest key per visit; compaction folds batches into one table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import delete, exists, names_in

STATUS_ROW = "vid long, aid long, status string"


def read_action_log(spark: SparkSession, path: str, schema: T.StructType | str, **options: str) -> DataFrame:
    """A stream over Parquet files appended to a folder."""
    return spark.readStream.schema(schema).options(**options).parquet(path)


def latest_status_of(actions: DataFrame) -> DataFrame:
    """(vid, aid, status) of the action inserted last; works on batch and stream alike."""
    last = F.max(F.struct("aid", "action"))
    return actions.groupBy("vid").agg(last.alias("_last")).select("vid", "_last.aid", F.col("_last.action").alias("status"))


def stream_latest_status(
    actions: DataFrame, out: str, checkpoint: str, trigger: dict | None = None, compact_every: int | None = None
) -> StreamingQuery:
    """Start the job; by default it works off what is there and stops.

    With ``compact_every`` each so manieth batch folds what is there into one table.
    """

    def write_batch(changed: DataFrame, batch_id: int) -> None:
        changed.select("vid", "aid", "status").write.mode("overwrite").parquet(f"{out}/batch={batch_id:012d}")
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact_status(changed.sparkSession, out)

    return (
        latest_status_of(actions)
        .writeStream.outputMode("update")
        .foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _parts(spark: SparkSession, out: str) -> tuple[list[str], list[str]]:
    """Complete compacted tables, oldest first, and batches. A table is complete once Spark marked it so."""
    names = sorted(names_in(spark, out))
    tables = [n for n in names if n.startswith("compacted=") and exists(spark, f"{out}/{n}/_SUCCESS")]
    return tables, [n for n in names if n.startswith("batch=")]


def _read(spark: SparkSession, out: str, names: list[str]) -> DataFrame:
    if not names:
        return spark.createDataFrame([], STATUS_ROW)
    return spark.read.schema(STATUS_ROW).parquet(*[f"{out}/{n}" for n in names])


def _best(log: DataFrame) -> DataFrame:
    best = log.groupBy("vid").agg(F.max(F.struct("aid", "status")).alias("b"))
    return best.select("vid", "b.aid", "b.status")


def read_latest_status(spark: SparkSession, out: str) -> DataFrame:
    """(vid, status) from the last compacted table and all batches beside it."""
    tables, batches = _parts(spark, out)
    return _best(_read(spark, out, [*tables[-1:], *batches])).drop("aid")


def compact_status(spark: SparkSession, out: str) -> int:
    """Fold the last compacted table and the batches beside it into the next one; returns how many batches went.

    Folded batches and older tables are deleted once the new table is complete; whatever lies beside a table is read
    with it. Keeping the highest key gives the same result however often a row is read, so a compaction that ends
    half-way, a batch that is replayed after it was folded, and a stream that starts over with other batches
    are all harmless. A reader that listed the folders before a compaction must list them again.
    """
    tables, batches = _parts(spark, out)
    if not batches:
        return 0
    generation = 1 + max((int(n.split("=")[1]) for n in names_in(spark, out) if n.startswith("compacted=")), default=0)
    folded = _best(_read(spark, out, [*tables[-1:], *batches]))
    folded.write.parquet(f"{out}/compacted={generation:012d}")
    for name in [*tables, *batches]:
        delete(spark, f"{out}/{name}")
    return len(batches)
