"""Silver: typed receipts and lines, dedupe, store versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FIRST_VALID = "1900-01-01 00:00:00"
OPEN_END = "9999-12-31 00:00:00"


def explode_items(receipts: DataFrame) -> DataFrame:
    """Nested items to one row per line, numbered from 1; empty baskets leave no row."""
    lines = receipts.select("receipt_id", F.posexplode("items").alias("pos", "item"))
    return lines.select(
        "receipt_id",
        (F.col("pos") + 1).cast("int").alias("line_no"),
        F.col("item.sku").alias("sku"),
        F.col("item.name").alias("item_name"),
        F.col("item.qty").cast("int").alias("qty"),
        F.col("item.unit_price").cast("double").alias("unit_price"),
    )


def type_receipts(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "receipt_id",
        "user_id",
        "store_id",
        F.col("submitted_at").cast("timestamp_ntz").alias("submitted_at"),
        F.col("submitted_at").cast("date").alias("submitted_date"),
        "currency",
        "payment_method",
        "scanner_version",
        F.col("image_quality").cast("double").alias("image_quality"),
        F.col("subtotal").cast("double").alias("reported_subtotal"),
        F.col("tax").cast("double").alias("reported_tax"),
        F.col("total").cast("double").alias("reported_total"),
        F.col("is_anomaly").cast("int").alias("is_anomaly_label"),
        "anomaly_type",
    )


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key by ``order``, ties settled by the remaining columns.

    ``min`` over a struct keeps one row per key on the map side, so an id that was
    redelivered any number of times shuffles once per task. A row-number window
    would carry every copy of a hot id into one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    nulls_last = [e for c in order for e in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c))]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*nulls_last, *rest)).alias("_first"))
    return picked.select(
        *[F.col(c) if c in keys else F.col("_first")[c].alias(c) for c in df.columns]
    )


def silver_receipts(bronze: DataFrame) -> DataFrame:
    """Typed receipts, one row per id: redelivered copies stop here."""
    return keep_first(type_receipts(bronze), ["receipt_id"], ["submitted_at"])


def silver_items(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "receipt_id",
        F.col("line_no").cast("int").alias("line_no"),
        "sku",
        "item_name",
        F.col("qty").cast("int").alias("qty"),
        F.col("unit_price").cast("double").alias("unit_price"),
        (F.col("qty").cast("double") * F.col("unit_price").cast("double")).alias("line_amount"),
    )


def store_versions(feed: DataFrame) -> DataFrame:
    """Close each attribute change with the next one: half-open ``[valid_from, valid_to)``.

    The first version opens at the start of time so early-stamped receipts still resolve.
    A store's change list is short by nature, so the window is over small groups.
    """
    by_store = Window.partitionBy("store_id").orderBy(
        "effective_from", "region", "store_format", "manager_id", "change_reason"
    )
    typed = feed.withColumn("effective_from", F.col("effective_from").cast("timestamp_ntz"))
    placed = typed.select(
        "*",
        F.lead("effective_from").over(by_store).alias("_next"),
        F.row_number().over(by_store).alias("version_number"),
    )
    return placed.select(
        "store_id",
        "version_number",
        F.when(F.col("version_number") == 1, F.lit(FIRST_VALID).cast("timestamp_ntz"))
        .otherwise(F.col("effective_from"))
        .alias("valid_from"),
        F.coalesce("_next", F.lit(OPEN_END).cast("timestamp_ntz")).alias("valid_to"),
        F.col("_next").isNull().alias("is_current"),
        "region",
        "store_format",
        "manager_id",
        "change_reason",
    )
