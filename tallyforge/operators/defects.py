"""Labelled defect injection on a real receipt frame.

Draws come from an md5 of the receipt id and a seed, so the same rows break the
same way on every replay and on any partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge import schemas as S
from tallyforge.functions.receipts import items_subtotal
from tallyforge.functions.staging import compute_once

# Rates and defect kinds.
ANOMALY_RATE = 0.06
MALFORMED_RATE = 0.015
RESUBMIT_SHARE = 0.35
KINDS = ["arithmetic_mismatch", "impossible_quantity", "price_outlier", "timestamp_skew", "ocr_dropout"]
BREAKS = ["unknown_store", "non_positive_total", "empty_items", "bad_currency"]
BAD_CURRENCIES = ["EU R", "", "usd"]
PRICE_FACTORS = [10.0, 100.0, 0.1]

_N = 12


def _with_draws(df: DataFrame, seed: int, salt: str, n: int = _N) -> DataFrame:
    """``_u``: the first ``n`` of twelve uniform draws in [0, 1) per receipt id, four from a digest."""
    hexes = F.concat(*[F.md5(F.concat(F.col("receipt_id"), F.lit(f":{salt}{seed}:{part}"))) for part in range(-(-n // 4))])
    draws = [
        F.conv(F.substring("_hex", 8 * i + 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0) for i in range(n)
    ]
    return compute_once(compute_once(df, {"_hex": hexes}), {"_u": F.array(*draws)}).drop("_hex")


def _u(i: int) -> Column:
    return F.col("_u")[i]


def _pick(values: list, draw: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.floor(draw * len(values)) + 1).cast("int"))


def _cents(x: Column) -> Column:
    return F.round(x, 2)


def _seconds(days: Column) -> Column:
    return F.make_dt_interval(secs=F.floor(days * 86400.0).cast("decimal(18,6)"))


def inject_defects(
    receipts: DataFrame, anomaly_rate: float = ANOMALY_RATE, malformed_rate: float = MALFORMED_RATE, seed: int = 42
) -> DataFrame:
    """At most one labelled defect per row; a narrow transform."""
    d = _with_draws(receipts, seed, "d")
    malformed = _u(0) < malformed_rate
    chosen = ~malformed & (_u(1) < anomaly_rate) & (F.size("items") > 0)
    d = compute_once(
        d, {"_break": F.when(malformed, _pick(BREAKS, _u(2))), "_kind": F.when(chosen, _pick(KINDS, _u(2)))}
    )
    brk, kind = F.col("_break"), F.col("_kind")
    victim = F.floor(_u(3) * F.size("items")).cast("int")
    halved = F.greatest(F.lit(1), F.floor(F.size("items") / 2).cast("int"))

    def hit_qty(it, i):
        return F.when(i == victim, it.withField("qty", (F.floor(_u(4) * 360) + 40).cast("int"))).otherwise(it)

    def hit_price(it, i):
        hurt = _cents(it["unit_price"] * _pick(PRICE_FACTORS, _u(4)))
        return F.when(i == victim, it.withField("unit_price", hurt)).otherwise(it)

    items = (
        F.when(brk == "empty_items", F.filter("items", lambda _: F.lit(False)))
        .when(kind == "impossible_quantity", F.transform("items", hit_qty))
        .when(kind == "price_outlier", F.transform("items", hit_price))
        .when((kind == "ocr_dropout") & (_u(7) < 0.3), F.slice("items", F.lit(1), halved))
        .otherwise(F.col("items"))
    )
    d = compute_once(d, {"items": items})
    recompute = F.coalesce(kind.isin("impossible_quantity", "price_outlier"), F.lit(False))
    d = compute_once(d, {"_sub": F.when(recompute, _cents(items_subtotal(F.col("items"))))})
    new_tax = _cents(F.col("_sub") * F.lit(S.TAX_RATE))
    drift = F.when(_u(3) < 0.5, -1.0).otherwise(1.0) * (_u(4) * 0.30 + 0.05)
    total = (
        F.when(kind == "arithmetic_mismatch", _cents(F.greatest(F.lit(0.01), F.col("total") * (drift + 1.0))))
        .when(recompute, _cents(F.col("_sub") + new_tax))
        .when(brk == "non_positive_total", F.when(_u(3) < 0.5, -F.abs("total")).otherwise(0.0))
        .otherwise(F.col("total"))
    )
    dropout = F.coalesce(kind == "ocr_dropout", F.lit(False))
    moved = (
        F.when(kind != "timestamp_skew", F.col("submitted_at"))
        .when(kind.isNull(), F.col("submitted_at"))
        .when(_u(4) < 0.5, F.col("submitted_at") + _seconds(_u(5) * 198 + 2))
        .otherwise(F.col("submitted_at") - _seconds(_u(5) * 800 + 400))
    )
    label = F.when(malformed, "malformed_payload").otherwise(kind)
    return d.withColumns(
        {
            "subtotal": F.when(dropout & (_u(5) < 0.6), None).otherwise(F.coalesce("_sub", "subtotal")),
            "tax": F.when(dropout & (_u(6) < 0.5), None).when(recompute, new_tax).otherwise(F.col("tax")),
            "total": total,
            "image_quality": F.when(dropout, _cents(_u(4) * 0.37 + 0.05)).otherwise(F.col("image_quality")),
            "submitted_at": moved,
            "store_id": F.when(
                brk == "unknown_store", F.concat(F.lit("ZZ"), (F.floor(_u(3) * 99) + 900).cast("string"))
            ).otherwise(F.col("store_id")),
            "currency": F.when(brk == "bad_currency", _pick(BAD_CURRENCIES, _u(3))).otherwise(F.col("currency")),
            "anomaly_type": label,
            "is_anomaly": label.isNotNull().cast("int"),
        }
    ).select(*receipts.columns)


def inject_resubmissions(receipts: DataFrame, rate: float = ANOMALY_RATE * RESUBMIT_SHARE, seed: int = 42) -> DataFrame:
    """Near-duplicates of clean rows beside them: new id, 1 to 90 minutes later; a narrow transform.

    A row is dealt once or twice where it stands, so what ``receipts`` is made by runs once.
    """
    d = _with_draws(receipts, seed, "r", 2)
    chosen = (F.col("is_anomaly") == 0) & (_u(0) < rate)
    d = d.withColumn("_again", F.explode(F.when(chosen, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    changed = {
        "receipt_id": F.concat(
            F.lit("R"), F.substring(F.md5(F.concat(F.col("receipt_id"), F.lit(f":again{seed}"))), 1, 12)
        ),
        "submitted_at": F.col("submitted_at") + _seconds((_u(1) * 89 + 1) / 1440.0),
        "anomaly_type": F.lit("duplicate_submission"),
        "is_anomaly": F.lit(1),
    }
    return d.withColumns({c: F.when(F.col("_again"), v).otherwise(F.col(c)) for c, v in changed.items()}).select(*receipts.columns)
