"""Bronze to gold as one graph of DataFrames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tallyforge.operators import dims, facts, marts, silver
from tallyforge.sources.sinks import write_table

MATERIALISED = ["sl_receipts", "sl_receipt_items", "dim_store", "dim_date", "dim_sku", "fct_receipt"]


def build(
    raw: dict[str, DataFrame],
    keep: Callable[[str, DataFrame], DataFrame] | None = None,
    lines: bool = True,
) -> dict[str, DataFrame]:
    """All warehouse tables from the eight landing sets.

    ``keep`` may store a table and hand back a frame that reads it; it is called for
    the tables several later ones use. ``lines=False`` leaves out the line fact and the
    SKU dimension, whose medians need a job of their own.
    """
    keep = keep or (lambda _, df: df)
    t: dict[str, DataFrame] = {f"br_{name}": df for name, df in raw.items()}

    def add(name: str, df: DataFrame) -> None:
        t[name] = keep(name, df) if name in MATERIALISED else df

    add("sl_receipts", silver.silver_receipts(t["br_receipts"]))
    add("sl_receipt_items", silver.silver_items(t["br_receipt_items"]))
    add("sl_store_versions", silver.store_versions(t["br_store_master"]))
    add("dim_store", dims.dim_store(t["sl_store_versions"]))
    add("dim_date", dims.dim_date(t["sl_receipts"]))
    if lines:
        add("dim_sku", dims.dim_sku(t["sl_receipt_items"]))
    add(
        "fct_receipt",
        facts.fct_receipt(
            t["sl_receipts"],
            t["sl_receipt_items"],
            t["br_scores"],
            t["br_explanations"],
            t["dim_date"],
            t["dim_store"],
        ),
    )
    if lines:
        add("fct_receipt_line", facts.fct_receipt_line(t["sl_receipt_items"], t["fct_receipt"], t["dim_sku"]))
    add("mart_review_queue", marts.review_queue(t["fct_receipt"], t["dim_store"]))
    add("mart_store_health", marts.store_health(t["fct_receipt"], t["dim_store"]))
    add("mart_quality_metrics", marts.quality_metrics(t["fct_receipt"], t["br_quarantine"]))
    if "br_shap_global" in t:
        add("mart_feature_attribution", marts.feature_attribution(t["br_shap_global"]))
    if "br_slice_metrics" in t:
        add("mart_model_slices", marts.model_slices(t["br_slice_metrics"]))
    return t


def keep_as_parquet(spark, root: str) -> Callable[[str, DataFrame], DataFrame]:
    def keep(name: str, df: DataFrame) -> DataFrame:
        path = f"{root.rstrip('/')}/{name}"
        write_table(df, path)
        return spark.read.parquet(path)

    return keep
