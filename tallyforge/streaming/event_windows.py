"""Event-time windows on a stream: counts and totals per key and day, late rows kept apart.

The stream carries a watermark on its event time. State per key holds the windows that are still open; every batch
emits, in update mode, the new figures of the windows it touched, and the rows that came after their window had
closed (its end is not beyond the watermark). So each row is either counted or late, by one rule in one query, and
none is dropped; rows without an event time have no window and are late.

A key is dealt into ``salts`` parts by a hash of the row's id, each with figures of its own that are added on
reading, so one key may hold any share of the stream. State of a part is its open windows, at most the watermark's
delay and the window's length in days, however many rows they count. Each micro-batch replaces its own folder, so a
replay writes the same rows again, and a later batch's figures of a window replace those of an earlier one.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Amounts are summed in ten-thousandths, which makes sums independent of the order of rows.
UNIT = 10_000
_OUT = "late boolean, key string, salt int, window_start timestamp, n long, units long, id string, ts timestamp, amount double"
_STATE = "starts array<long>, n array<long>, units array<long>"


def _counter(length_us: int):
    """Rows of one key and salt to updates and late rows; times in microseconds."""
    columns = [f.split()[0] for f in _OUT.split(", ")]

    def work(group: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs() * 1000
        held = state.get if state.exists else ([], [], [])
        open_ = {int(s): [int(n), int(u)] for s, n, u in zip(*held) if s + length_us > watermark}
        touched, late = set(), []
        for rows in chunks:
            has = rows["us"].notna()
            start = (rows["us"].where(has, 0).astype("int64") // length_us) * length_us
            fits = has & (start + length_us > watermark)
            late.append(rows[~fits])
            on_time = rows[fits].assign(start=start[fits]).groupby("start")["units"].agg(["size", "sum"])
            for at, n, units in on_time.itertuples():
                sums = open_.setdefault(int(at), [0, 0])
                sums[0] += int(n)
                sums[1] += int(units)
                touched.add(int(at))
        state.update(([*open_], [v[0] for v in open_.values()], [v[1] for v in open_.values()]))
        key, salt = group[0], int(group[1])
        if touched:
            at = sorted(touched)
            yield pd.DataFrame(
                {"late": False, "key": key, "salt": salt, "window_start": pd.to_datetime(at, unit="us"), "n": [open_[s][0] for s in at], "units": [open_[s][1] for s in at], "id": None, "ts": pd.NaT, "amount": None}
            )[columns]
        for rows in late:
            if len(rows):
                yield pd.DataFrame(
                    {"late": True, "key": key, "salt": salt, "window_start": pd.NaT, "n": None, "units": None, "id": rows["id"], "ts": pd.to_datetime(rows["us"], unit="us"), "amount": rows["amount"]}
                )[columns]

    return work


def windowed(stream: DataFrame, key: Column, ts: Column, row_id: Column, amount: Column, hours: int = 24, late_after: str = "2 hours", salts: int = 16) -> DataFrame:
    """Updates of windows and late rows, told apart by ``late``. Null amounts count as rows and add nothing."""
    units = F.coalesce(F.round(amount * UNIT).cast("long"), F.lit(0))
    named = stream.select(
        key.cast("string").alias("key"), F.pmod(F.xxhash64(row_id), F.lit(salts)).cast("int").alias("salt"), row_id.cast("string").alias("id"),
        ts.alias("at"), F.unix_micros(ts).alias("us"), units.alias("units"), amount.cast("double").alias("amount"),
    )
    marked = named.withWatermark("at", late_after).groupBy("key", "salt")
    return marked.applyInPandasWithState(_counter(hours * 3_600_000_000), _OUT, _STATE, "update", GroupStateTimeout.NoTimeout)


def drain_windows(updates: DataFrame, out: str, checkpoint: str) -> None:
    """Process everything available now, then stop; restartable from ``checkpoint``, which keeps the open windows."""
    spark, run = updates.sparkSession, []

    def keep(batch: DataFrame, batch_id: int) -> None:
        if not run:
            run.append(json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").collect()[-1]["value"])["id"])
        batch.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite").partitionBy("late").parquet(f"{out}/run={run[0]}/part={batch_id}")

    query = updates.writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def _written(spark: SparkSession, out: str) -> DataFrame:
    kept = ", ".join(f for f in _OUT.split(", ") if not f.startswith("late "))
    return spark.read.schema(f"{kept}, batch long, late boolean, run string, part long").option("basePath", out).parquet(f"{out}/*/*")


def window_figures(spark: SparkSession, out: str) -> DataFrame:
    """(key, window_start, n, total): the last figures of every window, parts added up."""
    newest = Window.partitionBy("run", "key", "salt", "window_start").orderBy(F.desc("batch"))
    last = _written(spark, out).where("not late").withColumn("place", F.row_number().over(newest)).where("place = 1")
    sums = last.groupBy("key", "window_start").agg(F.sum("n").alias("n"), F.sum("units").alias("units"))
    return sums.select("key", "window_start", "n", (F.col("units") / F.lit(float(UNIT))).alias("total"))


def late_rows(spark: SparkSession, out: str) -> DataFrame:
    return _written(spark, out).where("late").select("key", "id", "ts", "amount")
