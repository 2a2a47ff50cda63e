"""Session settings and intermediate tables on shared storage."""

import uuid
from tempfile import mkdtemp

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def session(app: str = "claimwright", master: str | None = None, **settings) -> SparkSession:
    """A session with adaptive execution and skewed-join splitting on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    wanted = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **settings,
    }
    for key, value in wanted.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: the one the cluster names.

    Only where spark.checkpoint.dir is unset, which is so in tests and in local
    mode, a folder on this machine is used. On a cluster that would lose data, so
    it is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    application = spark.sparkContext.applicationId
    if application in _local_folders:
        return _local_folders[application]
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder all executors share.")
    _local_folders[application] = mkdtemp(prefix="claimwright-")
    return _local_folders[application]


def checkpointing(spark: SparkSession) -> None:
    """Makes sure checkpoint() has a folder to write to."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def stage(df: DataFrame, label: str, spread_by: str | None = None,
          compression: str | None = None) -> DataFrame:
    """The rows written once as a Parquet table and read back.

    Used where later steps pass over the same rows several times: the written table
    survives the loss of executors, and each pass reads only the columns it needs.
    With `spread_by` the rows are dealt by that column first, so that all cores take
    part in the passes to come, however few files the rows came from. `compression`
    names the table's codec where the session's own is not wanted.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/claimwright/{label}-{uuid.uuid4().hex}"
    if spread_by:
        df = df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), spread_by)
    df.write.parquet(path, compression=compression)
    return spark.read.parquet(path)
