"""The folder that driver and executors share, and tables cut off there."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

CLEAN = "spark.cleaner.referenceTracking.cleanCheckpoints"


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only where it is unset, one of our own.

    On a cluster that is a folder in the warehouse; in local mode a temporary one,
    which goes when Python ends.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        own = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if not own:
            if sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
                own = tempfile.mkdtemp(prefix="takepick-")
                atexit.register(shutil.rmtree, own, ignore_errors=True)
            else:
                own = spark.conf.get("spark.sql.warehouse.dir") + "/_scratch"
        sc.setCheckpointDir(own)
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written down in the shared folder; its files go with the last reference to it."""
    shared_dir(df.sparkSession)
    conf = df.sparkSession.sparkContext._jsc.sc().conf()
    before = conf.get(CLEAN, None)
    conf.set(CLEAN, "true")  # read when a checkpoint is made; those of others stay as they are set
    try:
        return df.checkpoint(eager=True)
    finally:
        conf.remove(CLEAN) if before is None else conf.set(CLEAN, before)


def _found(spark: SparkSession, path: str) -> tuple:
    """A path of any file system that Spark knows, and that file system."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(sc._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; none is no error."""
    p, files = _found(spark, path)
    files.delete(p, True)


def written(spark: SparkSession, path: str) -> bool:
    """Whether a table there was written to its end."""
    p, files = _found(spark, path + "/_SUCCESS")
    return files.exists(p)
