"""Gold marts and the console's read queries over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import receipts as R
from tallyforge.functions.exact import decimal_sum, exact_avg, exact_sum


def _failing(flag: str = "fails_reconciliation"):
    return F.sum(F.col(flag).cast("bigint"))


def review_queue(facts: DataFrame, dim_store: DataFrame) -> DataFrame:
    """Flagged receipts, highest score first, with rule evidence beside the model's reasons."""
    flagged = facts.where(F.col("is_flagged") == 1)
    attrs = dim_store.select("store_key", "region", "store_format")
    return (
        flagged.join(attrs, "store_key", "left")
        .select(
            "receipt_id",
            "submitted_at",
            "store_id",
            "region",
            "store_format",
            "user_id",
            "anomaly_score",
            F.col("top_factors").alias("model_reasoning"),
            "reported_total",
            "computed_total",
            "total_residual",
            "total_residual_pct",
            "n_items",
            "max_qty",
            "max_unit_price",
            "image_quality",
            "fails_reconciliation",
            R.review_hint(
                F.col("image_quality"), F.col("max_qty"), F.col("total_residual_pct"), F.col("max_unit_price")
            ).alias("rule_based_hint"),
        )
        .orderBy(F.desc("anomaly_score"), "receipt_id")
    )


def store_health(facts: DataFrame, dim_store: DataFrame) -> DataFrame:
    """Day x store with the attributes in force then.

    Facts are folded to (day, store, version) first: the version's attributes are
    looked up once per group rather than once per receipt.
    """
    folded = facts.groupBy("submitted_date", "store_id", "store_key").agg(
        F.count(F.lit(1)).alias("n_receipts"),
        decimal_sum(F.col("reported_total")).alias("_gross"),
        decimal_sum(F.col("image_quality")).alias("_quality"),
        F.count("image_quality").alias("_n_quality"),
        _failing().alias("_failing"),
        F.sum("is_flagged").alias("_flagged"),
        decimal_sum(F.col("anomaly_score")).alias("_score"),
        F.count("anomaly_score").alias("_n_score"),
    )
    attrs = dim_store.select("store_key", "region", "store_format", "manager_id")
    n = F.sum("n_receipts")
    return (
        folded.join(attrs, "store_key", "left")
        .groupBy("submitted_date", "store_id", "region", "store_format", "manager_id")
        .agg(
            n.alias("n_receipts"),
            exact_sum(F.col("_gross")).alias("gross_amount"),
            R.rate(exact_sum(F.col("_quality")), F.sum("_n_quality")).alias("avg_image_quality"),
            F.sum("_failing").alias("n_failing_reconciliation"),
            R.rate(F.sum("_failing"), n).alias("reconciliation_failure_rate"),
            F.sum("_flagged").alias("n_flagged"),
            R.rate(F.sum("_flagged"), n).alias("flag_rate"),
            R.rate(exact_sum(F.col("_score")), F.sum("_n_score")).alias("avg_anomaly_score"),
        )
    )


def daily_clean_vitals(facts: DataFrame) -> DataFrame:
    return facts.groupBy("submitted_date").agg(
        F.count(F.lit(1)).alias("n_clean"),
        _failing().alias("n_failing_reconciliation"),
        F.sum("is_flagged").alias("n_flagged"),
        exact_avg(F.col("image_quality")).alias("avg_image_quality"),
    )


def daily_quarantine(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy(F.col("submitted_at").cast("date").alias("submitted_date")).agg(
        F.count(F.lit(1)).alias("n_quarantined")
    )


def quality_metrics(facts: DataFrame, quarantine: DataFrame, keep_quarantine_only_days: bool = False) -> DataFrame:
    """Daily vitals. Days with only quarantined rows appear on request."""
    how = "full" if keep_quarantine_only_days else "left"
    both = daily_clean_vitals(facts).join(daily_quarantine(quarantine), "submitted_date", how)
    clean = F.coalesce("n_clean", F.lit(0).cast("bigint"))
    held = F.coalesce("n_quarantined", F.lit(0).cast("bigint"))
    return both.select(
        "submitted_date",
        clean.alias("n_clean"),
        held.alias("n_quarantined"),
        R.rate(held, clean + held).alias("quarantine_rate"),
        "n_failing_reconciliation",
        R.rate(F.col("n_failing_reconciliation"), clean).alias("reconciliation_failure_rate"),
        "n_flagged",
        R.rate(F.col("n_flagged"), clean).alias("flag_rate"),
        "avg_image_quality",
    )


def rates_long(daily: DataFrame) -> DataFrame:
    """Daily rates as (date, signal, rate)."""
    return daily.unpivot(
        "submitted_date",
        ["quarantine_rate", "reconciliation_failure_rate", "flag_rate"],
        "signal",
        "rate",
    )


def health_by_region_format(health: DataFrame) -> DataFrame:
    return (
        health.groupBy("region", "store_format")
        .agg(
            F.sum("n_receipts").alias("n_receipts"),
            R.rate(F.sum("n_flagged"), F.sum("n_receipts")).alias("flag_rate"),
            exact_avg(F.col("avg_image_quality")).alias("avg_image_quality"),
        )
        .orderBy(F.desc("n_receipts"), "region", "store_format")
    )


def feature_attribution(shap_global: DataFrame) -> DataFrame:
    return shap_global.select("feature", "mean_abs_shap").orderBy(F.desc("mean_abs_shap"), "feature")


def model_slices(slices: DataFrame) -> DataFrame:
    return slices.select(
        "slice", "value", "n", "n_positive", "recall", "flag_rate", "recall_gap_vs_overall", "reliable"
    ).orderBy(F.desc("reliable"), F.desc_nulls_last("recall_gap_vs_overall"), "slice", "value")


def queue_view(queue: DataFrame, rows: int = 60, hints: list[str] | None = None) -> DataFrame:
    """The console's queue: top ``rows`` by score (a top-k, never a global sort), then chosen hints."""
    top = queue.orderBy(F.desc("anomaly_score"), "receipt_id").limit(rows)
    return top.where(F.col("rule_based_hint").isin(hints)) if hints else top
