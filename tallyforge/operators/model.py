"""Gradient-boosted anomaly scorer: train, evaluate, persist, score."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge import schemas as S
from tallyforge.operators import metrics as M
from tallyforge.operators import boosting
from tallyforge.operators.boosting import Booster, Settings
from tallyforge.operators.features import time_split
from tallyforge.session import settle

# Boosting parameters are those of Settings.
ROUNDS = Settings.rounds
QUEUE_FRACTIONS = [0.01, 0.05, 0.10]


@dataclass
class AnomalyModel:
    booster: Booster
    threshold: float
    metrics: dict


def probabilities(booster: Booster, features: DataFrame, name: str = "anomaly_score") -> DataFrame:
    """``features`` with the positive-class probability in ``name``."""
    return features.withColumn(name, 1 / (1 + F.exp(-booster.margin())))


def fit(train: DataFrame, seed: int = 42, rounds: int = ROUNDS) -> Booster:
    return boosting.fit(train, S.FEATURE_COLUMNS, "is_anomaly", "receipt_id", Settings(rounds=rounds, seed=seed))


def train(features: DataFrame, seed: int = 42, rounds: int = ROUNDS) -> AnomalyModel:
    """Fit on the earlier part, pick the threshold there, report on the later part."""
    features = settle(features)
    earlier, later = time_split(features)
    booster = fit(earlier, seed, rounds)
    scored_train = settle(probabilities(booster, earlier).select("receipt_id", "anomaly_score", "is_anomaly"))
    best = M.best_threshold(M.score_curve(scored_train, "anomaly_score", "is_anomaly")).first()
    raw_threshold = best["threshold"] if best["threshold"] is not None else 0.5
    keep = [c for c in ("anomaly_type",) if c in features.columns]
    scored = settle(
        probabilities(booster, later)
        .select("receipt_id", "anomaly_score", "is_anomaly", *keep)
        .withColumn("is_flagged", (F.col("anomaly_score") >= F.lit(raw_threshold)).cast("int"))
    )
    sizes = {r["split"]: r for r in M.split_statistics(earlier, later, "is_anomaly").collect()}
    curve = settle(M.score_curve(scored, "anomaly_score", "is_anomaly"))
    at = {
        r["fraction"]: r["precision"]
        for r in M.precision_at(scored, "anomaly_score", "is_anomaly", "receipt_id", QUEUE_FRACTIONS).collect()
    }
    hits = M.confusion(scored, "is_anomaly", "is_flagged").first()
    by_type = (
        {
            r["anomaly_type"]: {"n": r["n"], "recall_at_threshold": round(r["recall_at_threshold"], 4)}
            for r in M.recall_by_type(scored, "anomaly_type", "is_flagged").orderBy("anomaly_type").collect()
        }
        if keep
        else {}
    )
    rounded = lambda x: None if x is None else round(float(x), 4)
    report = {
        "n_train": sizes["train"]["n"] if "train" in sizes else 0,
        "n_test": sizes["test"]["n"] if "test" in sizes else 0,
        "positive_rate_train": rounded(sizes["train"]["positive_rate"]) if "train" in sizes else None,
        "positive_rate_test": rounded(sizes["test"]["positive_rate"]) if "test" in sizes else None,
        "roc_auc": rounded(M.roc_auc(curve).first()[0]),
        "pr_auc": rounded(M.average_precision(curve).first()[0]),
        **{f"precision_at_{int(f * 100)}pct": rounded(at.get(f)) for f in QUEUE_FRACTIONS},
        "threshold": round(float(raw_threshold), 4),
        "precision_at_threshold": rounded(hits["precision_at_threshold"]),
        "recall_at_threshold": rounded(hits["recall_at_threshold"]),
        "recall_by_anomaly_type": by_type,
        "feature_importance": {
            r["feature"]: round(r["importance"], 5) for r in gain_importance(features.sparkSession, booster).collect()
        },
    }
    return AnomalyModel(booster, report["threshold"], report)


def gain_importance(spark: SparkSession, booster: Booster) -> DataFrame:
    """(feature, importance), strongest first: one row per model column."""
    rows = spark.createDataFrame(booster.importance(), "feature string, importance double")
    return rows.orderBy(F.desc("importance"), "feature")


def save(model: AnomalyModel, spark: SparkSession, path: str) -> None:
    model.booster.save(spark, f"{path}/booster")
    report = spark.createDataFrame(
        [(model.threshold, json.dumps(model.metrics), S.FEATURE_COLUMNS)],
        "threshold double, metrics string, features array<string>",
    )
    report.write.mode("overwrite").json(f"{path}/report")


def load(spark: SparkSession, path: str) -> AnomalyModel:
    row = spark.read.schema("threshold double, metrics string").json(f"{path}/report").first()
    return AnomalyModel(Booster.load(spark, f"{path}/booster"), row["threshold"], json.loads(row["metrics"]))


def score(model: AnomalyModel, features: DataFrame) -> DataFrame:
    """receipt_id, submitted_at, anomaly_score, is_flagged at the stored four-decimal threshold."""
    return probabilities(model.booster, features).select(
        "receipt_id",
        "submitted_at",
        "anomaly_score",
        (F.col("anomaly_score") >= F.lit(model.threshold)).cast("int").alias("is_flagged"),
    )
