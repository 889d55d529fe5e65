"""Sessions, table loading and shared-storage checkpoints."""

from __future__ import annotations

import gc
import os
import tempfile
from uuid import uuid4

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "rollweave", memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; on a cluster pass your own session instead."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", memory)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of ``folder``."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the cluster's shared checkpoint folder and read back, with its lineage cut.

    The folder is the session's ``spark.checkpoint.dir``. Only where that is unset (tests, local
    runs) a temporary folder of this machine is used, which local executors share.
    """
    _folder(df.sparkSession)
    return df.checkpoint(eager=True)


def _folder(spark: SparkSession) -> str:
    """The checkpoint folder, set where it is not yet."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(folder or os.path.join(tempfile.gettempdir(), "rollweave-checkpoints"))
    return context.getCheckpointDir()


class Scratch:
    """Tables of a computation of many steps, as compressed Parquet in the shared checkpoint folder.

    Unlike a checkpoint, a kept table has the size of its files as its estimate. A checkpoint takes over the estimate
    of its plan, where joins multiply, so that in a loop of joins the number doubles its digits each round until the driver has no
    room for it. Tables are dropped by hand; those that a result hangs on go when the driver ends.
    """

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self._places: dict[int, tuple[DataFrame, str]] = {}

    def _at(self, place: str) -> tuple[JavaObject, JavaObject]:
        path = self._spark._jvm.org.apache.hadoop.fs.Path(place)
        return path.getFileSystem(self._spark._jsc.hadoopConfiguration()), path

    def keep(self, df: DataFrame) -> DataFrame:
        """``df`` written and read back, with its lineage cut."""
        place = f"{_folder(self._spark)}/scratch-{uuid4().hex}"
        system, path = self._at(place)
        system.deleteOnExit(path)
        df.write.option("compression", "zstd").parquet(place)
        kept = self._spark.read.schema(df.schema).parquet(place)
        self._places[id(kept)] = (kept, place)
        return kept

    def drop(self, *tables: DataFrame) -> None:
        """Delete kept tables that nothing reads any more, and the shuffle files of ended steps, which Spark deletes once garbage is collected."""
        for t in tables:
            system, path = self._at(self._places.pop(id(t))[1])
            system.delete(path, True)
            system.cancelDeleteOnExit(path)
        gc.collect()
        self._spark._jvm.System.gc()
