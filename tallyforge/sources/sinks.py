"""Sinks: landing parquet, raw tables, bronze views, reports, topic records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LANDING_SETS = [
    "quarantine",
    "receipts",
    "receipt_items",
    "store_master",
    "scores",
    "slice_metrics",
    "explanations",
    "shap_global",
]


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    single_file: bool = False,
) -> None:
    """Parquet sink. ``single_file`` puts the write in one task; only for small aggregates."""
    writer = (df.coalesce(1) if single_file else df).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def land(frames: dict[str, DataFrame], root: str) -> None:
    """Write landing sets, each fully replaced; baskets stay out of the flat tables."""
    unknown = set(frames) - set(LANDING_SETS)
    if unknown:
        raise ValueError(f"not landing sets: {sorted(unknown)}")
    for name, df in frames.items():
        write_table(df.drop("items"), f"{root.rstrip('/')}/{name}.parquet")


def load_raw_tables(frames: dict[str, DataFrame], database: str | None = None) -> None:
    """Create or replace managed tables ``raw_<name>``."""
    prefix = f"{database}." if database else ""
    for name, df in frames.items():
        df.write.mode("overwrite").saveAsTable(f"{prefix}raw_{name}")


def bronze_views(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """``br_<name>`` views straight over the landing sets, no business logic."""
    views = {}
    for name in LANDING_SETS:
        df = spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
        df.createOrReplaceTempView(f"br_{name}")
        views[name] = df
    return views


def topic_records(receipts: DataFrame) -> DataFrame:
    """(key, value) records: keyed by receipt id, JSON value with ISO-8601 UTC timestamps."""
    stamped = receipts.withColumn(
        "submitted_at", F.date_format("submitted_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    )
    return stamped.select(
        F.col("receipt_id").alias("key"),
        F.to_json(F.struct(*receipts.columns), {"ignoreNullFields": "false"}).alias("value"),
    )


def publish(receipts: DataFrame, bootstrap_servers: str, topic: str) -> int:
    """Publish to a Kafka-protocol topic (needs the Spark Kafka connector on the classpath).

    Returns the number of records: the write fails if the topic does not acknowledge one.
    """
    sent = Observation()
    (
        topic_records(receipts)
        .observe(sent, F.count(F.lit(1)).alias("n"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .save()
    )
    return sent.get["n"]


def write_report(one_row: DataFrame, path: str) -> None:
    """A nested one-row document as JSON."""
    one_row.write.mode("overwrite").json(path)
