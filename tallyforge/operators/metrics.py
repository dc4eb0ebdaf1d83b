"""Ranking metrics from scores and labels, tie-aware, without a global sort in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.receipts import rate
from tallyforge.operators.ordering import before_cut, order_cuts, running_totals
from tallyforge.session import settle


def score_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row per distinct score: precision and recall of flagging that score and above.

    Tied scores fold to one row before anything is ordered.
    """
    slim = df.select(F.col(score).alias("score"), F.col(label).cast("bigint").alias("y"))
    ranked = running_totals(slim, [], "score", {"n": F.lit(1), "pos": F.col("y")})
    tp = F.col("pos_all") - F.col("pos_before")
    flagged = F.col("n_all") - F.col("n_before")
    precision, recall = rate(tp, flagged), rate(tp, F.col("pos_all"))
    both = precision + recall
    return ranked.select(
        "score",
        "n",
        "pos",
        "n_before",
        "pos_before",
        "n_all",
        "pos_all",
        tp.alias("tp"),
        flagged.alias("n_flagged"),
        precision.alias("precision"),
        recall.alias("recall"),
        F.coalesce(2 * precision * recall / F.nullif(both, F.lit(0.0)), F.lit(0.0)).alias("f1"),
    )


def average_precision(curve: DataFrame) -> DataFrame:
    """Step-wise area: each score adds its recall gain times its precision."""
    gain = rate(F.col("pos"), F.col("pos_all")) * F.col("precision")
    return curve.agg(F.sum(gain).alias("average_precision"))


def roc_auc(curve: DataFrame) -> DataFrame:
    """Share of (positive, negative) pairs ranked right, ties counting half, in whole numbers."""
    wide = lambda c: c.cast("decimal(19,0)")
    neg = F.col("n") - F.col("pos")
    neg_before = F.col("n_before") - F.col("pos_before")
    twice = F.sum(wide(F.col("pos")) * wide(2 * neg_before + neg))
    p = F.max("pos_all").cast("double")
    q = F.max(F.col("n_all") - F.col("pos_all")).cast("double")
    return curve.agg((twice.cast("double") / F.nullif(2 * p * q, F.lit(0.0))).alias("roc_auc"))


def best_threshold(curve: DataFrame) -> DataFrame:
    """The score with the highest F1, the lowest such score on ties."""
    best = F.max(F.struct("f1", (-F.col("score")).alias("neg")))
    return curve.agg(best.alias("b")).select((-F.col("b.neg")).alias("threshold"), F.col("b.f1").alias("f1"))


def precision_at(df: DataFrame, score: str, label: str, row_id: str, fractions: list[float]) -> DataFrame:
    """(fraction, k, precision): mean label of the max(1, int(n * fraction)) best-scored rows.

    One ranking serves all fractions; the data is then read once with plain cut values.
    """
    ks = [lambda n, f=f: F.greatest(F.lit(1).cast("bigint"), F.floor(n * F.lit(float(f))).cast("bigint")) for f in fractions]
    df = settle(df.select(score, label, row_id))  # ranked, cut and counted: three reads of three columns
    cuts = order_cuts(df, score, row_id, ks, descending=True)
    inside = [
        F.when(
            before_cut(score, row_id, cut, descending=True),
            F.struct(F.lit(float(f)).alias("fraction"), F.lit(cut[2]).cast("bigint").alias("k")),
        )
        for f, cut in zip(fractions, cuts, strict=True)
    ]
    rows = df.select(F.col(label).alias("y"), F.explode(F.array_compact(F.array(*inside))).alias("c"))
    return rows.groupBy("c.fraction", "c.k").agg(rate(F.sum("y"), F.count(F.lit(1))).alias("precision"))


def confusion(df: DataFrame, label: str, flagged: str) -> DataFrame:
    y, f = F.col(label) == 1, F.col(flagged) == 1
    counts = df.agg(
        F.count_if(y & f).alias("tp"),
        F.count_if(~y & f).alias("fp"),
        F.count_if(y & ~f).alias("fn"),
        F.count_if(~y & ~f).alias("tn"),
    )
    return counts.select(
        "*",
        (F.col("tp") / F.greatest(F.lit(1), F.col("tp") + F.col("fp"))).alias("precision_at_threshold"),
        (F.col("tp") / F.greatest(F.lit(1), F.col("tp") + F.col("fn"))).alias("recall_at_threshold"),
    )


def recall_by_type(df: DataFrame, kind: str, flagged: str) -> DataFrame:
    return (
        df.where(F.col(kind).isNotNull())
        .groupBy(F.col(kind).alias("anomaly_type"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            rate(F.sum(flagged), F.count(flagged)).alias("recall_at_threshold"),
        )
    )


def split_statistics(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    tagged = train.select(F.lit("train").alias("split"), F.col(label).alias("y")).unionByName(
        test.select(F.lit("test").alias("split"), F.col(label).alias("y"))
    )
    return tagged.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), rate(F.sum("y"), F.count("y")).alias("positive_rate")
    )
