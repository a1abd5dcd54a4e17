"""Intermediate results written once to the cluster's shared folder.

Operators that need the same rows in more than one job (a count first, the answer second) write them here:
the rows stay the same whichever executors are lost in between, and later jobs start from a columnar file.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_DIR_KEY = "spark.checkpoint.dir"
_used: set[str] = set()  # applications that have staged something


def shared_dir(spark: SparkSession) -> str:
    """This application's part of the folder the session names, or else of its warehouse folder.

    On a cluster that has to be a folder all executors share: a path of a single machine is refused there.
    """
    context = spark.sparkContext
    folder = spark.conf.get(_DIR_KEY, None) or context.getCheckpointDir()
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"
    if not usable(context.master, folder):
        raise RuntimeError(f"{folder} is a folder of one machine: set spark.checkpoint.dir to one that all executors share")
    _used.add(context.applicationId)
    return f"{folder.rstrip('/')}/basketry-{context.applicationId}"


def usable(master: str, folder: str) -> bool:
    """Whether executors can share `folder`: any of a file system, and a local path that was named on purpose or with a local master."""
    return master.startswith("local") or not folder.startswith(("/", "file:")) or not folder.endswith("/_staged")


def stage(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write `df` to the shared folder and return it as a table with no lineage; whole tables are worth a denser `compression`."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> None:
    """Remove everything this application staged; nothing to do if it staged nothing."""
    if spark.sparkContext.applicationId not in _used:
        return
    folder = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
    _used.discard(spark.sparkContext.applicationId)
