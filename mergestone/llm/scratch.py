"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OPEN: list["Scratch"] = []


#: Folders made for sessions of a single machine that name none, by application.
_MADE: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a temporary folder where it is unset on a single machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _MADE.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="mergestone-"))


#: Rows and bytes of a batch that a Python worker is sent at once, at most, or one row; a batch is held several times over.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def modest_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to ``BATCH_ROWS`` and ``BATCH_BYTES``; lower settings stay.

    Spark reads these settings when a frame is run, so they stay for the session.
    """
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        if not 0 < int(spark.conf.get(name).removesuffix("b")) <= most:
            spark.conf.set(name, most)


class Scratch:
    """Written tables that cut the lineage: a lost executor costs only the tasks it was running.

    ``save`` writes and rereads a frame, ``drop`` deletes a table that no later
    step reads. What the returned frame still reads stays until ``close`` or the
    end of the driver.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/mergestone-{label}-{uuid.uuid4().hex}"
        modest_batches(spark)
        _OPEN.append(self)

    def save(self, name: str, frame: DataFrame) -> DataFrame:
        path = f"{self.root}/{name}"
        frame.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            self._delete(f"{self.root}/{name}")

    def keep_only(self, *names: str) -> None:
        """Deletes all tables but these."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        for found in root.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(root):
            if found.getPath().getName() not in names:
                self.drop(found.getPath().getName())

    def close(self) -> None:
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _close_all() -> None:
    for one in _OPEN:
        try:
            one.close()
        except Exception:  # the JVM has already gone; the folder is the cluster's to clean
            return
