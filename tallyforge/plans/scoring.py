"""Score an outside batch on the same path as a full run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.operators import attribution, features, model
from tallyforge.operators.contract import split_quarantine
from tallyforge.session import settle


@dataclass
class ScoredBatch:
    clean: DataFrame
    held: DataFrame
    scored: DataFrame


def assemble(clean: DataFrame, scores: DataFrame, explanations: DataFrame) -> DataFrame:
    """Receipts with score and reasons, highest score first."""
    return (
        clean.select("receipt_id", "store_id", "submitted_at", "total")
        .join(scores.select("receipt_id", "anomaly_score", "is_flagged"), "receipt_id")
        .join(explanations.select("receipt_id", "top_factors"), "receipt_id")
        .orderBy(F.desc("anomaly_score"), "receipt_id")
    )


def score_batch(
    receipts: DataFrame, trained: model.AnomalyModel, reference: features.Reference | None = None, stores=None, as_of=None
) -> ScoredBatch:
    """Gate, then features, score, reasons; the business date is ``as_of`` or the batch's newest stamp."""
    as_of = as_of or receipts.agg(F.max("submitted_at").alias("m")).first()["m"]
    clean, held = split_quarantine(receipts, as_of, stores)
    # scores and reasons both read the features
    feats = settle(features.build_features(clean, reference))
    scores = model.score(trained, feats)
    reasons = attribution.explain(trained.booster, feats)
    return ScoredBatch(clean, held, assemble(clean, scores, reasons))
