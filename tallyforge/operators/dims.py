"""Gold dimensions: dates, SKUs, stores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.ordering import exact_median


def date_bounds(receipts: DataFrame) -> DataFrame:
    return receipts.agg(F.min("submitted_date").alias("d0"), F.max("submitted_date").alias("d1"))


def dim_date(receipts: DataFrame) -> DataFrame:
    """Every day between the first and last receipt; only two values are aggregated."""
    days = date_bounds(receipts).select(
        F.explode(F.expr("sequence(d0, d1, interval 1 day)")).alias("calendar_date")
    )
    d = F.col("calendar_date")
    sunday_first = F.dayofweek(d) - 1
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        "calendar_date",
        F.year(d).alias("calendar_year"),
        F.month(d).alias("calendar_month"),
        F.day(d).alias("day_of_month"),
        sunday_first.alias("day_of_week"),
        sunday_first.isin(0, 6).alias("is_weekend"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
    )


def dim_sku(items: DataFrame) -> DataFrame:
    """One row per SKU with its exact median price, also when one SKU dominates the lines."""
    measures = items.groupBy("sku").agg(
        F.max("item_name").alias("item_name"),
        F.count(F.lit(1)).alias("times_sold"),
        F.min("unit_price").alias("min_unit_price"),
        F.max("unit_price").alias("max_unit_price"),
    )
    medians = exact_median(items, ["sku"], "unit_price", "median_unit_price").withColumnRenamed("sku", "_sku")
    return measures.join(medians, measures["sku"].eqNullSafe(medians["_sku"]), "left").select(
        F.md5("sku").alias("sku_key"),
        F.col("sku").alias("sku_natural_key"),
        "item_name",
        "times_sold",
        "median_unit_price",
        "min_unit_price",
        "max_unit_price",
    )


def dim_store(versions: DataFrame) -> DataFrame:
    """Type 2 dimension: the surrogate key pins a fact to one version of a store."""
    return versions.select(
        F.md5(F.concat_ws("|", "store_id", F.col("valid_from").cast("string"))).alias("store_key"),
        F.col("store_id").alias("store_natural_key"),
        "version_number",
        "valid_from",
        "valid_to",
        "is_current",
        "region",
        "store_format",
        "manager_id",
        "change_reason",
    )


def multi_version_stores(dim: DataFrame) -> DataFrame:
    """All versions of stores that changed at least once."""
    changed = dim.groupBy("store_natural_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return (
        dim.join(changed, "store_natural_key", "left_semi")
        .select(
            F.col("store_natural_key").alias("store_id"),
            F.col("version_number").alias("v"),
            "valid_from",
            "valid_to",
            "is_current",
            "region",
            "store_format",
            "change_reason",
        )
        .orderBy("store_id", "v")
    )
