"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from .sources.files import delete

_own_folder: str | None = None
_paths: list[str] = []

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def get_session(app: str = "cohortspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this library expects; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a session whose executors are threads of the driver (``local``, ``local[n]``) may fall back to a folder of its own.
    """
    global _own_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _own_folder is None:
        _own_folder = tempfile.mkdtemp(prefix="cohortspark-")
    return _own_folder


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_folder(spark)}/{label}-{uuid4().hex}"
    _paths.append(path)
    return path


def discard_written(spark: SparkSession) -> None:
    """Delete what this process wrote to the shared folder; frames read from it end with that."""
    while _paths:
        delete(spark, _paths.pop())


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage like a reliable checkpoint (a lost executor cannot change what was
    written), but stays columnar: later steps prune columns and see real file sizes.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
