"""Deterministic contract gate: row reasons, quarantine split, batch verdict."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge import schemas as S
from tallyforge.functions.receipts import micros

REASON = "quarantine_reason"
_CHECKED_FOR_NULLS = ["receipt_id", "user_id", "store_id", "submitted_at", "total"]


@dataclass
class GateResult:
    passed: bool
    n_rows: int
    n_quarantined: int
    quarantine_rate: float
    null_rate: float
    max_age_days: float
    failures: list[str]

    def as_dict(self) -> dict:
        return asdict(self)


def _missing(df: DataFrame) -> Column:
    absent = F.lit(False)
    for name in ("receipt_id", "user_id"):
        absent = absent | F.coalesce(F.col(name), F.lit("")).eqNullSafe("")
    for name in ("store_id", "submitted_at", "currency"):
        absent = absent | F.col(name).isNull()
    return absent | F.col("total").isNull() | F.isnan("total")


def receipt_rules(
    df: DataFrame, as_of: Column, known_store: Column
) -> list[tuple[str, Column]]:
    """Rules in the order they are tried; the first that holds names the reason."""
    return [
        ("missing_required_field", _missing(df)),
        ("non_positive_total", F.col("total") <= 0),
        ("unknown_store", ~known_store),
        ("empty_items", F.coalesce(F.size("items"), F.lit(0)) <= 0),
        ("bad_currency", F.col("currency") != "USD"),
        ("future_timestamp", F.col("submitted_at") > as_of),
    ]


def first_reason(rules: list[tuple[str, Column]]) -> Column:
    reason = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, broken in rules:
        reason = reason.when(F.coalesce(broken, F.lit(False)), F.lit(name))
    return reason


def tag_reasons(
    df: DataFrame,
    as_of=None,
    stores: list[str] | DataFrame | None = None,
    extra_rules: list[tuple[str, Column]] | None = None,
) -> DataFrame:
    """Add ``quarantine_reason`` (null for clean rows) in one narrow pass.

    ``as_of`` is the batch's business date, so a replay gives the same verdict.
    ``stores`` is a list of codes, or a frame with a ``store_id`` column when the
    list is too long to ship inside the plan. ``extra_rules`` run after the built-in ones.
    """
    moment = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    if isinstance(stores, DataFrame):
        known = stores.select(F.col("store_id").alias("_known")).where("_known is not null").distinct()
        df = df.join(known, df["store_id"] == known["_known"], "left")
        known_store = F.col("_known").isNotNull()
    else:
        known_store = F.col("store_id").isin(S.STORES if stores is None else stores)
    rules = receipt_rules(df, moment, known_store) + (extra_rules or [])
    return df.withColumn(REASON, first_reason(rules)).drop("_known")


def split_quarantine(
    df: DataFrame, as_of=None, stores=None, extra_rules=None
) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined): two filters over the same tagged frame, so no row can vanish."""
    tagged = tag_reasons(df, as_of, stores, extra_rules)
    return tagged.where(F.col(REASON).isNull()).drop(REASON), tagged.where(F.col(REASON).isNotNull())


def gate_metrics(tagged: DataFrame, as_of=None) -> DataFrame:
    """One-row batch verdict from a tagged frame; a single partial-then-final aggregate.

    Freshness compares the newest clean row with ``as_of``; without ``as_of`` it cannot fail.
    """
    clean = F.col(REASON).isNull()
    n_clean = F.count_if(clean)
    nulls = sum(
        (F.count_if(clean & F.col(c).isNull()) for c in _CHECKED_FOR_NULLS[1:]),
        F.count_if(clean & F.col(_CHECKED_FOR_NULLS[0]).isNull()),
    )
    stamp = F.when(clean, micros(F.col("submitted_at")))
    day = F.lit(86400e6)
    newest = F.max(stamp)
    lag = (
        F.lit(0.0)
        if as_of is None
        else F.coalesce((micros(F.lit(as_of)) - newest).cast("double") / day, F.lit(0.0))
    )
    one = tagged.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~clean).alias("n_quarantined"),
        n_clean.alias("n_clean"),
        nulls.alias("n_nulls"),
        F.coalesce((newest - F.min(stamp)).cast("double") / day, F.lit(0.0)).alias("max_age_days"),
        lag.alias("lag_days"),
    )
    one = one.withColumn(
        "quarantine_rate",
        F.coalesce(F.col("n_quarantined") / F.nullif(F.col("n_rows"), F.lit(0)), F.lit(0.0)),
    ).withColumn(
        "null_rate",
        F.coalesce(
            F.col("n_nulls") / F.nullif(F.col("n_clean") * len(_CHECKED_FOR_NULLS), F.lit(0)), F.lit(0.0)
        ),
    )
    failures = F.array_compact(
        F.array(
            F.when(
                F.col("n_rows") < S.MIN_BATCH_ROWS,
                F.format_string(f"volume: %d rows < {S.MIN_BATCH_ROWS}", "n_rows"),
            ),
            F.when(
                F.col("quarantine_rate") > S.MAX_QUARANTINE_RATE,
                F.format_string(f"quarantine_rate: %.3f > {S.MAX_QUARANTINE_RATE}", "quarantine_rate"),
            ),
            F.when(
                F.col("null_rate") > S.MAX_NULL_RATE,
                F.format_string(f"null_rate: %.3f > {S.MAX_NULL_RATE}", "null_rate"),
            ),
            F.when(
                F.col("lag_days") > S.MAX_LAG_DAYS,
                F.format_string(f"freshness: %.2fd > {S.MAX_LAG_DAYS}d", "lag_days"),
            ),
        )
    )
    return one.withColumn("failures", failures).select(
        (F.size("failures") == 0).alias("passed"),
        "n_rows",
        "n_quarantined",
        "quarantine_rate",
        "null_rate",
        "max_age_days",
        "failures",
    )


def evaluate_gates(tagged: DataFrame, as_of=None) -> GateResult:
    """The verdict on the driver (one row), rounded for reporting."""
    row = gate_metrics(tagged, as_of).first()
    return GateResult(
        passed=row["passed"],
        n_rows=row["n_rows"],
        n_quarantined=row["n_quarantined"],
        quarantine_rate=round(row["quarantine_rate"], 4),
        null_rate=round(row["null_rate"], 4),
        max_age_days=round(row["max_age_days"], 2),
        failures=list(row["failures"]),
    )


def reason_histogram(quarantined: DataFrame) -> DataFrame:
    return (
        quarantined.groupBy(F.col(REASON).alias("reason"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "reason")
    )
