"""Small helpers that the corpus operators share."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that separate words, as a character class body (blank, tab, line feeds, form feed, return).
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"


def workers_import_here(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver found it (a cluster may also ship it)."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *[p for p in paths if p]])


def remainder(column: str, divisor: int) -> Column:
    """crc32 of an id written as text, modulo ``divisor`` (null ids count as the empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % F.lit(divisor)


def sampled(df: DataFrame, rows: int, *by: str, seed: int = 0) -> DataFrame:
    """About ``rows`` rows (all, if there are fewer), chosen by a hash of ``by``: reruns choose the same."""
    total = df.count()
    if total <= rows:
        return df
    cut = int(rows / total * (1 << 30))
    return df.where(F.pmod(F.xxhash64(F.lit(seed), *by), F.lit(1 << 30)) < F.lit(cut))


def chunks(batches: Iterator[pa.RecordBatch], column: str, chars: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold about ``chars`` bytes of ``column`` each, so that memory stays even."""
    for batch in batches:
        sizes = batch.column(batch.schema.get_field_index(column))
        held = pc.fill_null(pc.binary_length(sizes), 0).to_pylist()
        start = total = 0
        for i, n in enumerate(held):
            total += n
            if total >= chars:
                yield batch.slice(start, i + 1 - start)
                start, total = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)
    pa.default_memory_pool().release_unused()


def plain(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, whatever else the table brings along."""
    return df.select(*columns)
