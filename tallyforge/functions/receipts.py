"""Column expressions over receipts and their item arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyforge import schemas as S


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def items_subtotal(items: Column) -> Column:
    return F.aggregate(
        F.coalesce(items, F.array().cast("array<struct<sku:string,name:string,qty:int,unit_price:double>>")),
        F.lit(0.0),
        lambda acc, it: acc + F.coalesce(it["qty"].cast("double") * it["unit_price"], F.lit(0.0)),
    )


def computed_total(subtotal: Column) -> Column:
    return subtotal * F.lit(S.TAX_MULTIPLIER)


def residual_pct(reported: Column, expected: Column) -> Column:
    """Relative residual as the facts define it: no value when nothing was expected."""
    return F.abs(reported - expected) / F.nullif(expected, F.lit(0.0))


def fails_reconciliation(reported: Column, expected: Column) -> Column:
    return F.coalesce(residual_pct(reported, expected) > F.lit(S.RECONCILE_TOLERANCE), F.lit(False))


def rate(part: Column, whole: Column) -> Column:
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def image_quality_band(quality: Column) -> Column:
    return F.when(quality < 0.5, "poor").when(quality < 0.75, "fair").otherwise("good")


def psi_status(psi: Column) -> Column:
    return (
        F.when(psi < S.PSI_STABLE_BELOW, "stable")
        .when(psi < S.PSI_SIGNIFICANT_FROM, "moderate")
        .otherwise("significant")
    )


def review_hint(quality: Column, max_qty: Column, residual: Column, max_price: Column) -> Column:
    return (
        F.when(quality < 0.45, "poor_image")
        .when(max_qty >= 40, "implausible_quantity")
        .when(residual > S.RECONCILE_TOLERANCE, "does_not_reconcile")
        .when(max_price > 100, "price_outlier")
        .otherwise("behavioural")
    )
