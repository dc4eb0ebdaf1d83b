"""Receipt features for the anomaly model; behaviour looks backward only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge import schemas as S
from tallyforge.functions.receipts import items_subtotal, micros
from tallyforge.operators.ordering import category_codes, exact_median, split_at
from tallyforge.operators.windows import BUSY_ROWS, prior_window
from tallyforge.session import free_shuffles, settle

CODED = ["payment_method", "scanner_version"]


@dataclass
class Reference:
    """What the features take from a batch: SKU medians and category codes.

    Fitted on the batch itself by default; pass a stored one to score small batches.
    """

    sku_medians: DataFrame
    codes: DataFrame


def _prices(receipts: DataFrame, key: str = "receipt_id") -> DataFrame:
    return receipts.select(key, F.explode("items").alias("it")).select(
        key, F.col("it.sku").alias("sku"), F.col("it.unit_price").alias("unit_price")
    )


def sku_median_prices(receipts: DataFrame) -> DataFrame:
    return exact_median(_prices(receipts), ["sku"], "unit_price", "median_price")


def fit_reference(receipts: DataFrame) -> Reference:
    return Reference(sku_median_prices(receipts), category_codes(receipts, CODED))


def price_ratios(receipts: DataFrame, medians: DataFrame, key: str = "receipt_id") -> DataFrame:
    """Largest price over SKU median per ``key``; a SKU without a median compares with itself.

    Repeated (key, SKU) lines fold to their highest price before the join. The
    median side is broadcast only if it measures small; else hot SKUs are split at run time.
    """
    folded = _prices(receipts, key).groupBy(key, "sku").agg(F.max("unit_price").alias("price"))
    m = medians.select(F.col("sku").alias("_sku"), "median_price")
    own = F.when(F.col("price") == 0, F.lit(1.0)).otherwise(F.col("price"))
    ratio = F.try_divide(F.col("price"), F.coalesce("median_price", own))
    return (
        folded.join(m, F.col("sku") == F.col("_sku"), "left")
        .groupBy(key)
        .agg(F.max(ratio).alias("max_price_ratio_vs_sku_median"))
    )


def item_features(receipts: DataFrame) -> DataFrame:
    """Per-basket numbers straight from the array, no explode."""
    items = F.coalesce("items", F.array().cast("array<struct<sku:string,name:string,qty:int,unit_price:double>>"))
    n = F.size(items)
    qty = F.transform(items, lambda it: it["qty"].cast("bigint"))
    price = F.transform(items, lambda it: it["unit_price"])
    add = lambda acc, x: acc + F.coalesce(x, F.lit(0))
    return receipts.withColumns(
        {
            "n_items": n,
            "total_qty": F.aggregate(qty, F.lit(0).cast("bigint"), add),
            "max_qty": F.coalesce(F.array_max(qty), F.lit(0).cast("bigint")),
            "mean_unit_price": F.when(
                n > 0, F.aggregate(price, F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0))) / n
            ).otherwise(0.0),
            "max_unit_price": F.coalesce(F.array_max(price), F.lit(0.0)),
            "recomputed_subtotal": items_subtotal(items),
        }
    )


def build_features(
    receipts: DataFrame, reference: Reference | None = None, busy_rows: int = BUSY_ROWS
) -> DataFrame:
    """ids, the 22 model columns as doubles, and labels when present."""
    # Stored once with a number per row: an id may come more than once, and all of this reads the batch again.
    receipts = settle(receipts.withColumn("_row", F.monotonically_increasing_id()))
    free_shuffles(receipts.sparkSession)
    ref = reference or fit_reference(receipts)
    ts = micros(F.col("submitted_at"))
    total = F.coalesce("total", F.lit(0.0))
    base = item_features(receipts).withColumns({"_ts": ts, "total": total})
    newest = receipts.agg(F.max(ts).alias("m")).scalar()

    asked = receipts.select(F.struct("receipt_id", "_row").alias("_row"), "user_id", ts.alias("_ts"), total.alias("_total"))
    behaviour = prior_window(asked, "user_id", "_ts", "_total", "_row", busy_rows=busy_rows).withColumn("_row", F.col("_row._row"))
    joined = base.join(price_ratios(receipts, ref.sku_medians, "_row"), "_row", "left").join(behaviour, "_row", "left")
    for name in CODED:
        codes = ref.codes.where(F.col("name") == name).select(
            F.col("value").alias(name), F.col("code").alias(f"{name}_code")
        )
        joined = joined.join(codes, name, "left")

    expected = F.col("recomputed_subtotal") * F.lit(S.TAX_MULTIPLIER)
    off = F.abs(F.col("total") - expected)
    age = (newest - F.col("_ts")).cast("double") / F.lit(86400e6)
    zero, one = F.lit(0.0), F.lit(1.0)
    value = {
        "total": F.col("total"),
        "max_price_ratio_vs_sku_median": F.coalesce("max_price_ratio_vs_sku_median", one),
        "arithmetic_residual_abs": off,
        "arithmetic_residual_rel": off / F.greatest(expected, F.lit(0.01)),
        "implied_tax_rate": F.coalesce(
            F.col("tax") / F.when(F.col("subtotal").isNotNull(), F.greatest("subtotal", F.lit(0.01))), F.lit(-1.0)
        ),
        "image_quality": F.coalesce("image_quality", F.lit(0.5)),
        "hour_of_day": F.hour("submitted_at"),
        "day_of_week": F.weekday("submitted_at"),
        "ts_age_days": age,
        "is_future_ts": (F.col("_ts") > newest - 1_000_000).cast("int"),
        "user_receipts_prior_24h": F.coalesce("n_prior", F.lit(0)),
        "user_amount_ratio_vs_prior_median": F.when(
            F.col("median_prior") > 0, F.col("total") / F.col("median_prior")
        ).otherwise(one),
        "same_total_prior_24h": F.coalesce("n_same", F.lit(0)),
        "subtotal_is_null": F.col("subtotal").isNull().cast("int"),
        "tax_is_null": F.col("tax").isNull().cast("int"),
        "payment_method_code": F.coalesce("payment_method_code", F.lit(-1)),
        "scanner_version_code": F.coalesce("scanner_version_code", F.lit(-1)),
    }
    columns = [
        F.coalesce(value.get(c, F.col(c)).cast("double"), zero).alias(c) for c in S.FEATURE_COLUMNS
    ]
    labels = [
        F.col(c).cast("int").alias(c) if c == "is_anomaly" else F.col(c)
        for c in ("is_anomaly", "anomaly_type")
        if c in receipts.columns
    ]
    return joined.select("receipt_id", "submitted_at", *columns, *labels)


def time_split(features: DataFrame, test_fraction: float = S.HOLDOUT_FRACTION) -> tuple[DataFrame, DataFrame]:
    """Chronological (train, test): the first int(n * (1 - fraction)) rows by (time, id) train."""
    return split_at(
        features, "submitted_at", "receipt_id", lambda n: F.floor(n * F.lit(1 - test_fraction)).cast("bigint")
    )
