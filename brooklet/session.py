"""Session settings and the shared folder for checkpoints."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str | None = None, app: str = "brooklet", **conf: str) -> SparkSession:
    """A session with the settings the operators expect. Partition counts are left to AQE."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``. Only a local session gets one of its own, which
    goes when the process ends; on a cluster every executor would write to its own disk."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="brooklet-checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_SAVED: list[str] = []
_ON_DISCARD: list[Callable[[], None]] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, known to ``discard_saved``."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _SAVED.append(path)
    return path


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new table in the shared folder and read back: it is computed once, however often
    the result is used, and a lost executor costs a read, not a recomputation."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def saved_paths() -> list[str]:
    """What has been written and not discarded, oldest first."""
    return list(_SAVED)


def on_discard(forget: Callable[[], None]) -> None:
    """Call ``forget`` before anything is discarded; for what keeps frames that read such tables."""
    _ON_DISCARD.append(forget)


def discard_saved(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Delete the tables written in this process, or only those at ``paths``; frames that read them end with that."""
    for forget in _ON_DISCARD:
        forget()
    hadoop = spark._jsc.hadoopConfiguration()
    for name in [*_SAVED] if paths is None else paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(hadoop).delete(path, True)
        if name in _SAVED:
            _SAVED.remove(name)
