"""Backward-only 24-hour behaviour of each user.

Rows of one user are ordered by (timestamp, id); a row sees only rows before it that are at most the
window older. Rows are dealt by user and window-long period; each row also stands in the next period, so a
period holds all that its own rows can see, however long the user's history is. Ordinary periods use a
range frame. A period with more than ``busy_rows`` rows (a default account may hold a third of them all)
goes through ``busy_windows``: up to ``task_rows`` of its rows as one matrix in a task, beyond that in slices, which
never puts one period's rows in one task. All follow one rule:

* ``n_prior`` counts the prior rows, with or without a value;
* ``median_prior`` is over those with a value, null if there is none;
* ``n_same`` counts prior values ``p`` with ``abs(p - v) <= CLOSE_ABS + CLOSE_REL * abs(v)``, 0 if the
  row itself has no value ``v``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.operators.busy_windows import TASK_ROWS, busy_period_window, busy_prior_window
from tallyforge.session import settle

BUSY_ROWS = 2000
# Absolute and relative closeness of two equal totals.
CLOSE_ABS = 0.01
CLOSE_REL = 1e-5


def _ordinary(rows: DataFrame, window_us: int) -> DataFrame:
    frame = Window.partitionBy("u", "period").orderBy("ts").rangeBetween(-window_us, 0)
    seen = rows.withColumn("_near", F.collect_list(F.struct("ts", "id", "v")).over(frame)).where("own")
    prior = F.filter(
        "_near", lambda x: (x["ts"] < F.col("ts")) | ((x["ts"] == F.col("ts")) & (x["id"] < F.col("id")))
    )
    seen = seen.withColumn("_prior", F.transform(prior, lambda x: x["v"])).drop("_near")
    valued = seen.withColumn("_sorted", F.array_sort(F.array_compact("_prior")))
    ranked = valued.withColumns({"n_prior": F.size("_prior"), "n_valued": F.size("_sorted")})
    lo = F.try_element_at("_sorted", F.floor((F.col("n_valued") + 1) / 2).cast("int"))
    hi = F.try_element_at("_sorted", (F.floor(F.col("n_valued") / 2) + 1).cast("int"))
    close = F.filter(
        "_sorted",
        lambda p: F.abs(p - F.col("v")) <= F.lit(CLOSE_ABS) + F.abs(F.col("v")) * F.lit(CLOSE_REL),
    )
    return ranked.select(
        "id",
        F.col("n_prior").cast("bigint").alias("n_prior"),
        F.when(F.col("n_valued") > 0, (lo + hi) / 2).alias("median_prior"),
        F.size(close).cast("bigint").alias("n_same"),
    )


def prior_window(
    df: DataFrame, user: str, ts: str, value: str, row_id: str, hours: int = 24, busy_rows: int | None = BUSY_ROWS, task_rows: int = TASK_ROWS
) -> DataFrame:
    """(row_id, n_prior, median_prior, n_same) for rows with a user and a time; ``ts`` in microseconds.

    ``row_id`` must be unique. ``busy_rows=None`` sends every period through the range frame.
    """
    rows = df.where(F.col(user).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(user).alias("u"), F.col(ts).alias("ts"), F.col(value).alias("v"), F.col(row_id).alias("id")
    )
    window_us = hours * 3600 * 1_000_000
    period = F.floor(F.col("ts") / F.lit(window_us)).cast("bigint")
    places = F.array(
        F.struct(period.alias("period"), F.lit(True).alias("own")),
        F.struct((period + 1).alias("period"), F.lit(False).alias("own")),
    )
    dealt = rows.select("*", F.inline(places))
    if busy_rows is None:
        return _ordinary(dealt, window_us).withColumnRenamed("id", row_id)
    dealt = settle(dealt)
    busy = settle(
        dealt.groupBy(F.col("u").alias("bu"), F.col("period").alias("bp"))
        .agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("some"))
        .where(F.col("n") > busy_rows)
    )
    if busy.isEmpty():
        return _ordinary(dealt, window_us).withColumnRenamed("id", row_id)
    same = (F.col("u") == F.col("bu")) & (F.col("period") == F.col("bp"))
    ordinary = _ordinary(dealt.join(busy, same, "left_anti"), window_us)
    # a period in which no row is its own has nothing to answer, and a range frame would hold all of it
    asked = busy.where("some")
    held = dealt.join(asked.where(F.col("n") <= task_rows), same, "left_semi")
    found = ordinary.unionByName(busy_period_window(held, window_us, CLOSE_ABS, CLOSE_REL))
    larger = asked.where(F.col("n") > task_rows)
    if not larger.isEmpty():
        heavy = dealt.join(larger, same, "left_semi").select(F.struct("u", "period").alias("u"), "ts", "v", "id", "own")
        found = found.unionByName(busy_prior_window(heavy, window_us, CLOSE_ABS, CLOSE_REL))
    return found.withColumnRenamed("id", row_id)
