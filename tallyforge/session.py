"""Session set-up and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "tallyforge", master: str | None = None, **conf: str) -> SparkSession:
    """UTC session with adaptive execution. On a cluster leave ``master`` unset."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on: dates follow UTC, lineage is cut in shared storage."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session may fall back to a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if named or current:
        if current is None:
            spark.sparkContext.setCheckpointDir(named)
        return named or current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    own = tempfile.mkdtemp(prefix="tallyforge-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tallyforge/{uuid.uuid4().hex}/{name}"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once to shared storage and go on from the written table.

    Used where later steps read a frame more than once and must see the same
    physical split, and between rounds of an iteration. A lost executor re-reads
    files instead of replaying the plan, the planner starts from true sizes, and
    nothing of the earlier plan (such as its inferred constraints) piles up.
    A frame that comes from here is not written again.
    """
    if "_settled" in df.__dict__:
        return df
    spark = prepare(df.sparkSession)
    path = scratch_path(spark, "settled")
    df.write.parquet(path)
    read = spark.read.schema(df.schema).parquet(path)
    read._settled = True
    return read


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now.

    Its cleaner learns that nothing refers to a shuffle only from a garbage collection of the driver, else every half
    hour, and until then the files of all steps add up on the executors' disks.
    """
    spark.sparkContext._jvm.System.gc()
