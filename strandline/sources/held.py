"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the folder that driver and executors share, under the application's id.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local master, whose one machine everything
    shares, may leave it out: a temporary one is made then. Elsewhere a missing setting is an error. Whoever runs the application
    deletes its folder when the results have been written.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="strandline-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/strandline-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def hold(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read again: the lineage ends there, and a lost executor costs nothing."""
    path = path or shared_folder(df.sparkSession, "held")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
