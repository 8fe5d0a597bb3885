"""K1 + K3 as one publication: a build is a new version, its manifest comes last.

Rows, header and reports of a build go to ``<root>/versions/<version>/<output>``,
where no reader looks yet.  The last write is the manifest, one small file in
``<root>/manifests/version=<version>``, put in place by the commit of one Spark
job.  Readers follow the newest manifest, so a build that dies between two
outputs leaves the previous publication as it was, and a reader that holds a
version keeps reading that build while a newer one appears.  Old versions are
only ever deleted by whoever runs the store.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = T.StructType([
    T.StructField("outputs", T.MapType(T.StringType(), T.StringType())),
    T.StructField("schemas", T.MapType(T.StringType(), T.StringType())),
    T.StructField("rows", T.MapType(T.StringType(), T.LongType())),
    T.StructField("as_of", T.StringType()),
    T.StructField("version", T.StringType()),
])


class Publication:
    """One build's folder; invisible to readers until ``commit``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        # ascending in time; the tail keeps two builds of one instant apart
        self.version = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S.%f") + "-" + uuid.uuid4().hex[:8]
        self.outputs: dict[str, str] = {}
        self.schemas: dict[str, str] = {}

    def path(self, name: str, schema: T.StructType | None = None) -> str:
        """Where output ``name`` of this build goes; ``schema`` for Parquet."""
        self.outputs[name] = f"versions/{self.version}/{name}"
        if schema is not None:
            self.schemas[name] = schema.json()
        return f"{self.root}/{self.outputs[name]}"

    def commit(self, rows: dict[str, int], as_of: str) -> str:
        """Write the manifest: from here on readers see this build."""
        def entries(values: dict, kind: str):
            pairs = [F.lit(x) for k, v in values.items() for x in (k, v)]
            return (F.create_map(*pairs) if pairs else F.create_map()).cast(f"map<string,{kind}>")

        path = f"{self.root}/manifests/version={self.version}"
        self.spark.range(1).select(
            entries(self.outputs, "string").alias("outputs"), entries(self.schemas, "string").alias("schemas"),
            entries(rows, "bigint").alias("rows"), F.lit(as_of).alias("as_of")).coalesce(1).write.json(path)
        return path


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """One row per committed build, with its version."""
    return spark.read.schema(MANIFEST).json(f"{root.rstrip('/')}/manifests").filter(F.col("outputs").isNotNull())


def latest(spark: SparkSession, root: str) -> dict | None:
    """The newest manifest, or None before the first publication."""
    try:
        row = manifests(spark, root).orderBy(F.col("version").desc()).first()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return None if row is None else row.asDict()


def read_published(spark: SparkSession, root: str, name: str, manifest: dict | None = None) -> DataFrame:
    """Output ``name`` of the newest build (or of ``manifest``): Parquet outputs
    as tables, documents as their JSON rows."""
    found = manifest or latest(spark, root)
    if found is None:
        raise FileNotFoundError(f"nothing is published under {root}")
    path = f"{root.rstrip('/')}/{found['outputs'][name]}"
    if name in found["schemas"]:
        return spark.read.schema(T.StructType.fromJson(json.loads(found["schemas"][name]))).parquet(path)
    return spark.read.json(path)
