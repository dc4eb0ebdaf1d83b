"""Stand-alone store-day job over the landing zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge import schemas as S
from tallyforge.functions import receipts as R
from tallyforge.functions.exact import exact_avg, exact_sum
from tallyforge.sources.files import read_landing
from tallyforge.sources.sinks import write_table


def daily_store_health(receipts: DataFrame, items: DataFrame) -> DataFrame:
    """Reconcile reported against computed totals and roll up per store and day."""
    lines = items.groupBy("receipt_id").agg(
        exact_sum(F.col("qty").cast("double") * F.col("unit_price")).alias("_subtotal")
    )
    expected = R.computed_total(F.col("_subtotal"))
    off = F.abs(F.col("total") - expected) / F.greatest(expected, F.lit(0.01))
    failing = F.sum(F.when(off > S.RECONCILE_TOLERANCE, 1).otherwise(0))
    n = F.count(F.lit(1))
    return (
        receipts.select("receipt_id", "store_id", "submitted_at", "total", "image_quality")
        .join(lines, "receipt_id", "left")
        .groupBy(F.to_date("submitted_at").alias("submitted_date"), "store_id")
        .agg(
            n.alias("n_receipts"),
            exact_sum(F.col("total")).alias("gross_amount"),
            exact_avg(F.col("image_quality")).alias("avg_image_quality"),
            failing.alias("n_failing_reconciliation"),
            R.rate(failing, n).alias("reconciliation_failure_rate"),
        )
        .orderBy("submitted_date", "store_id")
    )


def run(spark: SparkSession, input_dir: str, output_dir: str | None = None, bronze_dir: str | None = None) -> int:
    """Read the landing zone, roll up, write where asked; returns the number of store-days."""
    out = daily_store_health(read_landing(spark, input_dir, "receipts"), read_landing(spark, input_dir, "receipt_items"))
    if output_dir is None and bronze_dir is None:
        return out.count()
    target = output_dir or bronze_dir
    write_table(out, target)
    written = spark.read.parquet(target)
    if output_dir and bronze_dir:
        write_table(written, bronze_dir)
    return written.count()
