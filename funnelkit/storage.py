"""Tables written to the folder that all executors share, to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.  Where it is unset a temporary
    folder takes its place, on one machine only: on a cluster the executors
    would not share it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder (master {master})")
        # a running session does not take the setting; its folder is kept here
        folder = _LOCAL.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="funnelkit-shared-"))
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/funnelkit-{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back: the
    result survives lost executors and is computed once."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``written``, after the last one that reads them
    has itself been written."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.written_path).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
