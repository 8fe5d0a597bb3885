"""Spark session helpers.

On a cluster the session is given; these helpers only fill in what is unset,
so tests and the bench get sane local settings without overriding a cluster's.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Local runs see megabytes, not terabytes: let AQE keep several small
    # post-shuffle partitions so the reduce side still uses every core.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "8k",
}


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, app: str = "funnelkit") -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("FUNNELKIT_DRIVER_MEMORY", "8g")))
    for k, v in LOCAL_DEFAULTS.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
