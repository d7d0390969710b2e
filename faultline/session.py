"""Session helpers: the settings the library relies on, and the checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches; on a cluster the submit command sets these."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("faultline")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


def _set_checkpoint_folder(spark: SparkSession) -> None:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="faultline-checkpoint-")
    spark.sparkContext.setCheckpointDir(folder)


def checkpoint(df: DataFrame) -> DataFrame:
    """Write a table once and cut its lineage, through the shared folder in ``spark.checkpoint.dir``.

    A temporary folder is set only where the session names none and runs in local mode.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        _set_checkpoint_folder(spark)
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession) -> str:
    """A fresh folder beside the checkpoints, for tables a job writes and reads back."""
    import uuid

    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        _set_checkpoint_folder(spark)
    return f"{sc.getCheckpointDir().rstrip('/')}/scratch-{uuid.uuid4().hex}"
