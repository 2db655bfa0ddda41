"""Intermediate results kept in the cluster's shared folder.

A frame read by several branches of one job is written once and read back, so that an expensive
join runs once and a lost executor costs a re-read, not a re-run of everything before it. The
files are columnar: each branch reads only its columns, and the planner knows their size.

All files of an application lie below one folder, named after the application; ``drop_staged``
removes it when the results built on it have been written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; without it, one below the session's warehouse."""
    folder = spark.conf.get(SETTING, None)
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/staged"


def run_folder(spark: SparkSession) -> str:
    """The folder of everything this application stages."""
    return f"{shared_folder(spark).rstrip('/')}/shelfflow-{spark.sparkContext.applicationId}"


def stage(df: DataFrame) -> DataFrame:
    """Write the frame to the shared folder and return it read back."""
    path = f"{run_folder(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> bool:
    """Remove everything this application has staged; frames built on it can't be read afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
