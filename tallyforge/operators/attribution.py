"""Exact signed per-row attributions of the boosted trees (path-dependent Shapley values).

A leaf of depth at most five tests at most five features, so a row meets a leaf
in at most 32 ways: which of its features satisfy the leaf's interval. The share
of each feature is tabled per leaf and way once, from the trees' own curvature sums,
and added up over the leaves of a subtree; tasks then look rows up batch by batch.
"""

from __future__ import annotations

from math import factorial

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge import schemas as S
from tallyforge.operators.boosting import Booster, Leaf, Subtree, Subtrees


def _shares(value: float, kept: list[float]) -> np.ndarray:
    """[pattern, feature slot]: Shapley share when the pattern's bits mark satisfied features."""
    d = len(kept)
    met = (np.arange(2**d)[:, None] >> np.arange(d) & 1).astype(float)
    weight = np.array([factorial(k) * factorial(d - k - 1) / factorial(d) for k in range(d)])
    table = np.zeros((2**d, d))
    for f in range(d):
        # by size of the known set: the sum over sets of the other features, one feature at a time
        sums = np.zeros((2**d, d))
        sums[:, 0] = 1.0
        for g in range(d):
            if g != f:
                grown = sums * kept[g]
                grown[:, 1:] += sums[:, :-1] * met[:, g : g + 1]
                sums = grown
        table[:, f] = value * (sums @ weight) * (met[:, f] - kept[f])
    return table


class LeafTable:
    """What every way of meeting a subtree's tests brings to each feature, over all trees; their mean is the base value."""

    def __init__(self, booster: Booster):
        self.base = 0.0
        self.subtrees = Subtrees(booster, self._table, len(S.FEATURE_COLUMNS))

    def _table(self, tree: Subtree, leaves: list[Leaf]) -> dict[int, np.ndarray]:
        out: dict[int, np.ndarray] = {}
        for leaf in leaves:
            kept: dict[int, float] = {}
            for _, _, feature, share in leaf.path:
                kept[feature] = kept.get(feature, 1.0) * share
            self.base += leaf.value * float(np.prod(list(kept.values())))
            way = sum((met.astype(np.int64) << j for j, met in enumerate(tree.met(leaf).values())), np.zeros(len(tree.ways), np.int64))
            shares = _shares(leaf.value, list(kept.values()))
            for j, feature in enumerate(kept):
                out[feature] = out.get(feature, 0.0) + shares[way, j]
        return out

    def values(self, x: np.ndarray) -> np.ndarray:
        """Attributions of a block of rows, [row, feature]."""
        return self.subtrees.sums(x)


def attributions(booster: Booster, features: DataFrame) -> DataFrame:
    """(receipt_id, base_value, values): values in model column order, log-odds units."""
    table = features.sparkSession.sparkContext.broadcast(LeafTable(booster))

    def per_batch(batches):
        leaves = table.value
        for pdf in batches:
            values = leaves.values(pdf[S.FEATURE_COLUMNS].to_numpy(dtype=float))
            yield pdf[["receipt_id"]].assign(base_value=leaves.base, values=list(values))

    return features.select("receipt_id", *S.FEATURE_COLUMNS).mapInPandas(
        per_batch, "receipt_id string, base_value double, values array<double>"
    )


def top_factors(values: Column, names: list[str], k: int) -> Column:
    """The k strongest entries as structs (rank key, position, name, value), sign kept."""
    labels = F.array(*[F.lit(n) for n in names])
    ranked = F.transform(
        values,
        lambda v, i: F.struct(
            (-F.abs(v)).alias("rank"), i.alias("at"), F.element_at(labels, i + 1).alias("name"), v.alias("value")
        ),
    )
    return F.slice(F.array_sort(ranked), 1, k)


def factors_text(factors: Column) -> Column:
    return F.concat_ws(
        "; ",
        F.transform(
            factors,
            lambda f: F.concat(
                F.when(f["value"] >= 0, "+").otherwise("-"),
                f["name"],
                F.format_string(" (%+.3f)", f["value"]),
            ),
        ),
    )


def explain_values(values: DataFrame, names: list[str] = S.FEATURE_COLUMNS, top_k: int = 3) -> DataFrame:
    """Attribution arrays to reviewer text and the top-k factor columns."""
    picked = values.withColumn("_top", top_factors(F.col("values"), names, top_k))
    ranked = [
        c
        for i in range(top_k)
        for c in (
            F.col("_top")[i]["name"].alias(f"factor_{i + 1}"),
            F.round(F.col("_top")[i]["value"], 5).alias(f"factor_{i + 1}_value"),
        )
    ]
    return picked.select(
        "receipt_id", factors_text(F.col("_top")).alias("top_factors"), F.col("base_value").alias("shap_base_value"), *ranked
    )


def explain(booster: Booster, features: DataFrame, top_k: int = 3) -> DataFrame:
    return explain_values(attributions(booster, features), top_k=top_k)


def mean_abs(values: DataFrame, names: list[str] = S.FEATURE_COLUMNS) -> DataFrame:
    """(feature, mean_abs_shap) from attribution arrays, one wide partial aggregate."""
    wide = values.agg(*[F.avg(F.abs(F.col("values")[i])).alias(n) for i, n in enumerate(names)])
    return (
        wide.unpivot([], names, "feature", "mean")
        .select("feature", F.round("mean", 5).alias("mean_abs_shap"))
        .orderBy(F.desc("mean_abs_shap"), "feature")
    )


def global_importance(booster: Booster, features: DataFrame) -> DataFrame:
    return mean_abs(attributions(booster, features))
