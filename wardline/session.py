"""Session settings the plans rely on, and the shared folder for written intermediate tables."""

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # One statement may own a large part of the relation log. Split it even where the plan
    # reuses the partitioning on stmt_id afterwards: the extra exchange is paid only then.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the shared folder of `spark.checkpoint.dir`, else below the warehouse.

    Both are reached by the driver and all executors; no folder of one machine is ever used.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str, *parts: str) -> DataFrame:
    """`df` written to a new folder below the shared one and read again: cuts the lineage, and fixes what a rerun could change.

    A filter on the columns `parts` reads only the files of these parts.
    """
    folder = work_folder(df.sparkSession, purpose)
    df.write.partitionBy(*parts).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
