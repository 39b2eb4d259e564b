"""Tables written to the cluster's shared folder to cut lineage.

``spark.checkpoint.dir`` names a folder that the driver and all executors see.
A written table outlives any executor, is computed once, and is columnar when
read back.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where it is unset and Spark runs in one process (tests), one made for this session."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return the table read back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._shared_path = path
    return out


def drop_shared(*tables: DataFrame) -> None:
    """Remove tables that ``materialize`` wrote, once nothing reads them any more."""
    for df in tables:
        path = getattr(df, "_shared_path", None)
        if path:
            jvm = df.sparkSession._jvm
            hadoop = jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(hadoop, True)
