"""Gold facts: receipt grain and line grain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import receipts as R
from tallyforge.functions.exact import exact_sum
from tallyforge.operators.ordering import carried


def line_rollup(items: DataFrame) -> DataFrame:
    """Lines folded to one row per receipt before any join."""
    return items.groupBy("receipt_id").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum("qty").alias("total_qty"),
        F.max("qty").alias("max_qty"),
        exact_sum(F.col("line_amount")).alias("computed_subtotal"),
        F.max("unit_price").alias("max_unit_price"),
    )


def point_in_time_join(rows: DataFrame, versions: DataFrame, stamped: DataFrame | None = None) -> DataFrame:
    """Left join to the version in force at ``submitted_at``.

    Versions are dealt to the days they are in force on, from the first to the last stamp, so a row meets only the
    versions of its own store and day, however many a store has; the interval is checked beside that. The side is not
    hinted: the planner broadcasts it while its size is under the threshold, and above it uses a sort-merge join.
    ``stamped`` is a frame with the stamps of ``rows`` that is cheaper to read.
    """
    day = F.col("submitted_at").cast("date")
    span = (rows if stamped is None else stamped).agg(F.struct(F.min(day).alias("first"), F.max(day).alias("last"))).scalar()
    start = F.greatest(F.col("valid_from").cast("date"), span["first"])
    end = F.least(F.col("valid_to").cast("date"), span["last"])
    days = F.when(span["first"].isNotNull() & (start <= end), F.sequence(start, end, F.expr("interval 1 day")))
    v = versions.where("valid_from < valid_to").select(
        F.col("store_key"), F.col("store_natural_key"), F.col("valid_from"), F.col("valid_to"), F.explode(days).alias("_day")
    )
    return rows.join(
        v,
        (rows["store_id"] == v["store_natural_key"])
        & (rows["submitted_at"].cast("date") == v["_day"])
        & (rows["submitted_at"] >= v["valid_from"])
        & (rows["submitted_at"] < v["valid_to"]),
        "left",
    ).drop("store_natural_key", "valid_from", "valid_to", "_day")


def point_in_time_merge(rows: DataFrame, versions: DataFrame) -> DataFrame:
    """The same join for a dimension too large to broadcast, by merging both sides in the order of time.

    Rows and versions go together into range slices of (store, time); each row takes the last version that opened
    before or at its stamp, carried over from earlier slices where its own has none, if it is still open. So neither
    a store's rows nor its versions meet in one task, and no row is compared with versions of other times. Versions
    of one store must not overlap (``checks.version_overlaps``); of overlapping ones the last opened wins.
    """
    packed = F.struct(*[F.col(c) for c in rows.columns])
    opened = versions.select(
        F.col("store_natural_key").alias("_store"), F.col("valid_from").alias("_at"), F.lit(0).alias("_kind"), F.col("store_key").alias("_tie"),
        F.struct("store_key", "valid_to").alias("_version"), F.lit(None).cast(rows.select(packed.alias("r")).schema["r"].dataType).alias("_row"),
    ).where("_store is not null and _at is not null")
    asked = rows.select(
        F.col("store_id").alias("_store"), F.col("submitted_at").alias("_at"), F.lit(1).alias("_kind"), F.sha2(F.to_json(packed), 256).alias("_tie"),
        F.lit(None).cast(opened.schema["_version"].dataType).alias("_version"), packed.alias("_row"),
    )
    merged = carried(opened.unionByName(asked), ["_store"], ["_at", "_kind", "_tie"], "_version", "_found", "last").where("_kind = 1")
    open_ = F.col("_store").isNotNull() & (F.col("_at") < F.col("_found.valid_to"))
    return merged.select(*[F.col("_row")[c].alias(c) for c in rows.columns], F.when(open_, F.col("_found.store_key")).alias("store_key"))


def fct_receipt(
    receipts: DataFrame,
    items: DataFrame,
    scores: DataFrame,
    explanations: DataFrame,
    dim_date: DataFrame,
    dim_store: DataFrame,
    large_dimension: bool = False,
) -> DataFrame:
    """Receipt fact; ``large_dimension`` merges store versions in the order of time. The three receipt-keyed joins share one hash layout on the id."""
    rollup = line_rollup(items)
    joined = (
        receipts.join(rollup, "receipt_id", "left")
        .join(scores.select("receipt_id", "anomaly_score", "is_flagged"), "receipt_id", "left")
        .join(
            explanations.select("receipt_id", "top_factors", "factor_1", "factor_1_value"), "receipt_id", "left"
        )
    )
    # one row per day between the first and last receipt; a single stamp in a far year makes that millions
    days = dim_date.select("date_key", "calendar_date")
    joined = joined.join(days, F.col("submitted_date") == F.col("calendar_date"), "left")
    joined = point_in_time_merge(joined, dim_store) if large_dimension else point_in_time_join(joined, dim_store, receipts)
    expected = R.computed_total(F.col("computed_subtotal"))
    reported = F.col("reported_total")
    return joined.select(
        "receipt_id",
        "store_key",
        "date_key",
        "user_id",
        "store_id",
        "submitted_at",
        "submitted_date",
        "payment_method",
        "scanner_version",
        "image_quality",
        "reported_subtotal",
        "reported_tax",
        "reported_total",
        F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
        F.coalesce("total_qty", F.lit(0).cast("bigint")).alias("total_qty"),
        F.coalesce("max_qty", F.lit(0)).alias("max_qty"),
        F.coalesce("max_unit_price", F.lit(0.0)).alias("max_unit_price"),
        "computed_subtotal",
        expected.alias("computed_total"),
        (reported - expected).alias("total_residual"),
        R.residual_pct(reported, expected).alias("total_residual_pct"),
        R.fails_reconciliation(reported, expected).alias("fails_reconciliation"),
        "anomaly_score",
        "is_flagged",
        "top_factors",
        "factor_1",
        "factor_1_value",
        "is_anomaly_label",
        "anomaly_type",
    )


def fct_receipt_line(items: DataFrame, receipts: DataFrame, dim_sku: DataFrame) -> DataFrame:
    """Line fact: inner to the receipt fact, left to the SKU dimension."""
    heads = receipts.select("receipt_id", "store_key", "date_key")
    skus = dim_sku.select("sku_key", "sku_natural_key", "median_unit_price")
    joined = items.join(heads, "receipt_id").join(skus, F.col("sku") == skus["sku_natural_key"], "left")
    return joined.select(
        "receipt_id",
        "line_no",
        "sku_key",
        "store_key",
        "date_key",
        "qty",
        "unit_price",
        "line_amount",
        (F.col("unit_price") / F.nullif("median_unit_price", F.lit(0.0))).alias("price_ratio_vs_median"),
    )
