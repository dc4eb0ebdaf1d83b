"""Whole batch: gate, land, features, model, release gates, reasons, warehouse, summary."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge import schemas as S
from tallyforge.operators import attribution, contract, drift, features, model, silver
from tallyforge.plans import warehouse
from tallyforge.session import settle
from tallyforge.sources.sinks import land, load_raw_tables, write_report


class GateFailed(RuntimeError):
    """The batch broke a gate and ``strict`` was asked for."""


def latest_format(store_master: DataFrame) -> DataFrame:
    """Last known format per store; nulls never win."""
    return (
        store_master.where(F.col("store_format").isNotNull())
        .groupBy("store_id")
        .agg(F.max_by("store_format", "effective_from").alias("store_format"))
    )


def holdout_context(test: DataFrame, clean: DataFrame, store_master: DataFrame) -> DataFrame:
    """Hold-out rows with the categories their slices need."""
    heads = clean.select("receipt_id", "store_id", "scanner_version", "payment_method", F.col("image_quality"))
    return (
        test.select("receipt_id", "anomaly_score", "is_anomaly", "is_flagged")
        .join(heads, "receipt_id")
        .join(latest_format(store_master), "store_id", "left")
    )


def run(
    spark: SparkSession,
    receipts: DataFrame,
    store_master: DataFrame,
    out_dir: str,
    as_of=None,
    stores=None,
    retrain: bool = True,
    strict: bool = False,
    rounds: int = model.ROUNDS,
    seed: int = 42,
    raw_tables: bool = False,
) -> dict:
    """Build everything under ``out_dir`` and return the run summary."""
    root = out_dir.rstrip("/")
    tagged = settle(contract.tag_reasons(receipts, as_of, stores))
    gate = contract.evaluate_gates(tagged, as_of)
    if strict and not gate.passed:
        raise GateFailed("; ".join(gate.failures))
    clean = tagged.where(F.col(contract.REASON).isNull()).drop(contract.REASON)
    held = tagged.where(F.col(contract.REASON).isNotNull())

    feats = settle(features.build_features(clean))
    model_path = f"{root}/artifacts/model"
    trained = None
    if not retrain:
        try:
            trained = model.load(spark, model_path)
        except AnalysisException as error:  # nothing stored yet; anything else is a damaged model
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    if trained is None:
        trained = model.train(feats, seed=seed, rounds=rounds)
        model.save(trained, spark, model_path)
    scored = settle(model.probabilities(trained.booster, feats))
    flagged = scored.withColumn(
        "is_flagged", (F.col("anomaly_score") >= F.lit(trained.threshold)).cast("int")
    )
    earlier, later = features.time_split(flagged)

    report = drift.detect_drift(earlier, later, S.FEATURE_COLUMNS, score="anomaly_score")
    slices = settle(
        drift.rounded_slices(
            drift.slice_metrics(holdout_context(later, clean, store_master), "is_anomaly", "is_flagged")
        )
    )
    fair, violations = drift.fairness_gate(slices)
    values = settle(attribution.attributions(trained.booster, feats))
    later_ids = later.select("receipt_id")
    frames = {
        "quarantine": held,
        "receipts": clean,
        "receipt_items": silver.explode_items(clean),
        "store_master": store_master,
        "scores": flagged.select("receipt_id", "submitted_at", "anomaly_score", "is_flagged"),
        "slice_metrics": slices,
        "explanations": attribution.explain_values(values),
        "shap_global": attribution.mean_abs(values.join(later_ids, "receipt_id", "left_semi")),
    }
    land(frames, f"{root}/raw")
    raw = {name: spark.read.parquet(f"{root}/raw/{name}.parquet") for name in frames}
    if raw_tables:
        load_raw_tables(raw)
    tables = warehouse.build(raw, warehouse.keep_as_parquet(spark, f"{root}/warehouse"))
    for name, df in tables.items():
        if name.startswith(("mart_", "fct_receipt_line", "sl_store")):
            warehouse.keep_as_parquet(spark, f"{root}/warehouse")(name, df)

    write_report(drift.drift_document(spark, report, slices), f"{root}/artifacts/drift_report")
    summary = {
        "gate": gate.as_dict(),
        "metrics": trained.metrics,
        "drift": report.as_dict(),
        "fairness_passed": fair,
        "fairness_violations": violations,
        "n_receipts_clean": gate.n_rows - gate.n_quarantined,
        "n_receipts_quarantined": gate.n_quarantined,
        "n_line_items": raw["receipt_items"].count(),
    }
    doc = spark.createDataFrame([(json.dumps(summary),)], "summary string")
    doc.write.mode("overwrite").text(f"{root}/artifacts/run_summary")
    return summary
