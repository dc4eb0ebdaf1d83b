"""Topic or file stream into the landing zone.

Each micro-batch replaces its own ``run=<query>/batch=<id>`` folder, so a replay after a failure writes the
same folder again: offsets advance only past written rows, and nothing lands twice. The query's id is kept
in its checkpoint; a new checkpoint counts its batches anew, in a run folder of its own.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge import schemas as S
from tallyforge.operators.contract import split_quarantine

_BAD = "_undecoded"
_MESSAGE = "_message"


@dataclass
class Drained:
    received: int
    landed: int
    dead: int


def topic_source(
    spark: SparkSession, bootstrap_servers: str, topic: str, max_messages: int | None = None
) -> DataFrame:
    """Kafka-protocol topic from its earliest offset (needs the Spark Kafka connector)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_messages:
        reader = reader.option("maxOffsetsPerTrigger", max_messages)
    return reader.load().select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def file_source(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """JSON-line files as a stream of ``value`` strings."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select(F.lit(None).cast("string").alias("key"), "value")


def decode(messages: DataFrame, schema: T.StructType = S.LABELLED_RECEIPT, key: str = "receipt_id") -> DataFrame:
    """Decoded columns plus ``_message`` and ``_undecoded``; batch and stream share the schema."""
    with_bad = T.StructType(schema.fields + [T.StructField(_BAD, T.StringType())])
    parsed = messages.withColumn(
        "_r", F.from_json("value", with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})
    )
    bad = F.col("_r").isNull() | F.col(f"_r.{_BAD}").isNotNull() | F.col(f"_r.{key}").isNull()
    return parsed.select(*[F.col(f"_r.{f.name}").alias(f.name) for f in schema.fields], F.col("value").alias(_MESSAGE), bad.alias(_BAD))


def good(decoded: DataFrame) -> DataFrame:
    return decoded.where(~F.col(_BAD)).drop(_MESSAGE, _BAD)


def dead_letters(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(_BAD)).select(F.col(_MESSAGE).alias("value"))


def without_redeliveries(stream: DataFrame, within: str = "1 day") -> DataFrame:
    """Drop repeats of an id that arrive within this time of each other.

    The watermark follows the time of arrival, not the receipt's own stamp: a skewed clock makes no row
    late, so none is lost. Repeats that come later are left to the silver dedupe.
    """
    arrived = stream.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", within)
    return arrived.dropDuplicatesWithinWatermark(["receipt_id"]).drop("_arrived")


def drain(
    messages: DataFrame,
    landing: str,
    dead_letter: str,
    checkpoint: str,
    schema: T.StructType = S.LABELLED_RECEIPT,
    key: str = "receipt_id",
    gate_as_of=None,
    quarantine: str | None = None,
    timeout_s: int | None = None,
    enough: int | None = None,
) -> Drained:
    """Land everything available now, then stop; restartable from ``checkpoint``.

    With ``quarantine`` the contract gate runs on each micro-batch and its rejects
    go there instead of the landing folder. With ``enough`` the drain stops after the
    batch that reaches so many messages; the source's limit sets the size of a batch,
    and the next drain takes up the rest.
    """
    spark = messages.sparkSession
    counts: dict[int, Drained] = {}
    run: list[str] = []

    def land(batch: DataFrame, batch_id: int) -> None:
        if enough is not None and sum(c.received for b, c in counts.items() if b != batch_id) >= enough:
            raise _Enough
        if not run:
            lines = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").collect()
            run.append(json.loads(lines[-1]["value"])["id"])
        folder = f"run={run[0]}/batch={batch_id}"
        decoded = decode(batch, schema, key).persist()
        try:
            rows = good(decoded)
            if quarantine:
                clean, held = split_quarantine(rows, gate_as_of)
                held.write.mode("overwrite").parquet(f"{quarantine}/{folder}")
                rows = clean
            rows.write.mode("overwrite").parquet(f"{landing}/{folder}")
            dead_letters(decoded).write.mode("overwrite").parquet(f"{dead_letter}/{folder}")
            landed = spark.read.schema(schema).parquet(f"{landing}/{folder}").count()
            seen = decoded.agg(F.count("*").alias("n"), F.count_if(F.col(_BAD)).alias("bad")).first()
            counts[batch_id] = Drained(seen["n"], landed, seen["bad"])
        finally:
            decoded.unpersist()

    query = (
        messages.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    until = None if timeout_s is None else time.monotonic() + timeout_s
    try:
        while query.isActive and (until is None or time.monotonic() < until):
            query.awaitTermination(1)
        query.stop()
        if query.exception() is not None:
            raise query.exception()
    except StreamingQueryException as error:
        if "_Enough" not in str(error):
            raise
    return Drained(*(sum(getattr(c, f) for c in counts.values()) for f in ("received", "landed", "dead")))


class _Enough(Exception):
    """The wanted number has landed; the batch that raises this is not committed."""


def read_landed(spark: SparkSession, landing: str, schema: T.StructType = S.LABELLED_RECEIPT) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(landing)
