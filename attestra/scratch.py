"""Tables cut from their lineage, in the folder all executors share.

The folder is the session's ``spark.checkpoint.dir``, or the checkpoint folder set on its
context.  Where neither is set, a local master gets a temporary folder that is removed at
exit; on a cluster that would be lost with its node, so there it is an error.  What an
operator leaves behind goes when the application ends.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from .shipping import ship

_own: dict[str, str] = {}
#: Shuffle files of a query go when it ends, not when the driver next collects its garbage.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_TASKS = "spark.sql.shuffle.partitions"


def base_dir(spark: SparkSession) -> str:
    """The shared folder of this session."""
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if given:
        return given.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if "dir" not in _own:
        _own["dir"] = tempfile.mkdtemp(prefix="attestra-")
        atexit.register(shutil.rmtree, _own["dir"], True)
    return "file://" + _own["dir"]


class Scratch:
    """Written tables of one operator run; every one can be read again after an executor is lost."""

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        self.spark = spark
        self.root = f"{base_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._n = 0
        root = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        root.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(root)

    def table(self, df: DataFrame, tasks: int | None = None) -> DataFrame:
        """Write ``df``, its shuffles dealt into ``tasks`` if given, and return it as read back; its lineage ends there."""
        self._n += 1
        path = f"{self.root}/{self._n}"
        conf, before, own = self.spark.conf, self.spark.conf.get(_CLEAN, "false"), self.spark.conf.get(_TASKS)
        conf.set(_CLEAN, "true")
        conf.set(_TASKS, str(tasks or own))
        try:
            df.write.parquet(path)
        finally:
            conf.set(_CLEAN, before)
            conf.set(_TASKS, own)
        # given the schema, an empty table reads back as well
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def together(self, tables: list[DataFrame]) -> DataFrame:
        """Tables of one schema as one, in a single scan."""
        return self.spark.read.schema(tables[0].schema).parquet(*(t._scratch_path for t in tables))

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that nothing reads any more."""
        for t in tables:
            jpath = self.spark._jvm.org.apache.hadoop.fs.Path(t._scratch_path)
            jpath.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(jpath, True)
