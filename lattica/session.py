"""What operators need from the session: the package on the executors, and reliable checkpoints."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's modules to the executors, once per application, for functions that run in Python workers."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).parent
    path = Path(tempfile.mkdtemp(prefix="lattica-")) / "lattica_modules.zip"
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"lattica/{p.relative_to(root)}")
    sc.addPyFile(str(path))
    _shipped.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, which all executors share. Only in one JVM, as in tests, may it be unset, and
    then a folder of our own serves."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir")
        if named is None and sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="lattica-checkpoint-"))
    return sc.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with files in the shared folder, which outlive a lost executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def unbounded(df: DataFrame) -> DataFrame:
    """df as a side of a join that meets the other by sorted shuffles. Spark's estimates leave out the rows that explode and Python
    functions make, so it would broadcast such a side through the driver, whatever its true size."""
    return df.hint("merge")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch path that nothing reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
