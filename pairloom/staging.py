"""Where intermediate tables are written.

A staged table cuts lineage and survives lost executors, so it must be in a
folder that every executor and a restarted driver can see. The cluster names that
folder in ``spark.checkpoint.dir``. Only a local session, where the driver is the
one executor, gets a temporary folder instead.
"""

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_local_roots: dict[str, str] = {}


def staging_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="pairloom-")
    return _local_roots[app]


def new_stage(spark: SparkSession, name: str) -> str:
    """A fresh path for one staged table."""
    return f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back: later scans do not recompute it."""
    spark = df.sparkSession
    path = new_stage(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stage(spark: SparkSession, path: str) -> None:
    """Delete a staged table whose result is no longer needed."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
