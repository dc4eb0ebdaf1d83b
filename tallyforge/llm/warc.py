"""Merkle fixity audit of WARC records.

A replica is a table of records: file, offset, length and the digest of the record's bytes. Its tree has
the records as leaves; above them fixed offset ranges of a file (``RANGE`` bytes, then ``FAN`` times as
many at each level, until one range spans the file), and above the files ranges of the file names' hashes,
up to one root. Every node's digest covers its children's digests in order. Ranges are fixed by offset, so
both replicas cut a file alike, and a damaged record touches one path.

The audit compares the two roots and, only where nodes differ, joins their children, level by level, down
to the records. Everything is a group or join on (level, node); a node has about ``FAN`` children, a first
range those records that start in ``RANGE`` bytes, so no group grows with the archive.

Defined cases: a null body counts as empty; a null file name is a file of its own; records without offset
are left out of both replicas, as they have no place to compare. Two records at one offset (a repeated
row) are one leaf whose digest covers both, so a repeat missing in one replica is found. Empty replicas are
alike; against an empty one every record is missing. Only the named columns take part.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import workers_import_here
from tallyforge.session import settle

RANGE = 1 << 16
FAN = 16
#: Column order of a tree: level 0 is the records.
NODE = ["level", "file", "place", "digest"]


def record_head(url: Column, body_bytes: Column) -> Column:
    """Head of a response record, up to the blank line before its block."""
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        body_bytes.cast("string"),
        F.lit("\r\n\r\n"),
    )


def record(url: Column, body: Column) -> Column:
    block = F.coalesce(body, F.lit(""))
    return F.concat(record_head(url, F.octet_length(block)), block, F.lit("\r\n\r\n"))


def placed(records: DataFrame, file: str, order: list[str], length: str = "length") -> DataFrame:
    """``records`` with ``offset``: where each starts, if a file holds its records in this order."""
    before = Window.partitionBy(file).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return records.withColumn("offset", F.coalesce(F.sum(length).over(before), F.lit(0)).cast("bigint"))


def leaves(replica: DataFrame) -> DataFrame:
    """Records of a replica as tree nodes; ``place`` is the offset."""
    one = F.concat_ws(":", F.coalesce(F.col("length").cast("string"), F.lit("0")), F.coalesce(F.col("digest"), F.lit("")))
    return (
        replica.where("offset is not null")
        .groupBy(F.coalesce(F.col("file").cast("string"), F.lit("")).alias("file"), F.col("offset").cast("bigint").alias("place"))
        .agg(F.sort_array(F.collect_list(one)).alias("_each"), F.sum("length").cast("string").alias("_bytes"))
        .select("file", "place", F.when(F.size("_each") == 1, F.col("_each")[0]).otherwise(F.concat_ws(":", "_bytes", F.sha2(F.array_join("_each", ","), 256))).alias("digest"))
    )


def _over(children: DataFrame, parent_file: Column, parent_place: Column) -> DataFrame:
    return (
        children.groupBy(parent_file.alias("file_"), parent_place.alias("place_"))
        .agg(F.sort_array(F.collect_list(F.struct("file", "place", "digest"))).alias("_below"))
        .select(
            F.col("file_").alias("file"),
            F.col("place_").alias("place"),
            F.sha2(F.array_join(F.transform("_below", lambda c: F.concat_ws("|", c["file"], c["place"].cast("string"), c["digest"])), "\n"), 256).alias("digest"),
        )
    )


class Shape:
    """Levels that both replicas share: of offset ranges in a file, then of file-name hashes."""

    def __init__(self, last_offset: int, files: int):
        self.ranges = [RANGE]
        while self.ranges[-1] <= last_offset:
            self.ranges.append(self.ranges[-1] * FAN)
        self.digits = 0
        while FAN**self.digits < files:
            self.digits += 1
        self.depth = len(self.ranges) + self.digits + 1

    def parent(self, level: int) -> tuple[Column, Column]:
        """Of a node one level below ``level``: the file (or hash prefix) and place of its parent."""
        if level <= len(self.ranges):
            return F.col("file"), F.floor(F.col("place") / F.lit(self.ranges[level - 1])).cast("bigint") if level == 1 else F.floor(F.col("place") / F.lit(FAN)).cast("bigint")
        kept = self.digits - (level - len(self.ranges) - 1)
        name = F.md5("file") if level == len(self.ranges) + 1 else F.col("file")
        return F.substring(name, 1, kept), F.lit(0).cast("bigint")


def shape_of(*all_leaves: DataFrame) -> Shape:
    """From the largest offset and the number of files of all replicas."""
    both = all_leaves[0].select("file", "place")
    for other in all_leaves[1:]:
        both = both.unionByName(other.select("file", "place"))
    files = both.groupBy("file").agg(F.max("place").alias("place"))
    found = files.agg(F.max("place").alias("last"), F.count("*").alias("files")).first()
    return Shape(found["last"] or 0, found["files"])


def tree(own_leaves: DataFrame, shape: Shape) -> DataFrame:
    """All nodes (level, file, place, digest), stored: level 0 the records, the last level the root."""
    level, levels = settle(own_leaves), []
    levels.append(level)
    for k in range(1, shape.depth + 1):
        level = settle(_over(level, *shape.parent(k)))
        levels.append(level)
    out = levels[0].withColumn("level", F.lit(0))
    for k, nodes in enumerate(levels[1:], 1):
        out = out.unionByName(nodes.withColumn("level", F.lit(k)))
    return out.select(*NODE)


def roots(tree_: DataFrame, shape: Shape) -> list[str]:
    return [r["digest"] for r in tree_.where(F.col("level") == shape.depth).collect()]


def differing(one: DataFrame, other: DataFrame, shape: Shape) -> DataFrame:
    """Record nodes that differ: (file, place, one, other), a digest being null where the record is absent."""
    pick = lambda t, k: t.where(F.col("level") == k).drop("level")
    if roots(one, shape) == roots(other, shape):
        return pick(one, 0).limit(0).select("file", "place", F.col("digest").alias("one"), F.col("digest").alias("other"))
    suspects = None
    for level in range(shape.depth, -1, -1):
        a, b = pick(one, level), pick(other, level)
        if suspects is not None:
            file, place = shape.parent(level + 1)
            known = suspects.select(F.col("file").alias("_pf"), F.col("place").alias("_pp"))
            a, b = (
                t.withColumns({"_f": file, "_p": place}).join(known, (F.col("_f") == F.col("_pf")) & (F.col("_p") == F.col("_pp")), "left_semi").drop("_f", "_p")
                for t in (a, b)
            )
        a, b = a.withColumnRenamed("digest", "one"), b.withColumnRenamed("digest", "other")
        # stored, because the next level reads it on both sides
        suspects = settle(a.join(b, ["file", "place"], "full_outer").where(~F.col("one").eqNullSafe(F.col("other"))))
    return suspects


def audit(replica: DataFrame, copy: DataFrame) -> DataFrame:
    """Records on which two replicas disagree: file, offset, status, and length and digest in each.

    Replicas have file, offset, length and digest. ``status``: ``missing`` from the copy, ``extra`` in it,
    ``resized`` or ``corrupt``.
    """
    one, other = leaves(replica), leaves(copy)
    one, other = settle(one), settle(other)
    shape = shape_of(one, other)
    found = differing(tree(one, shape), tree(other, shape), shape)
    size = lambda c: F.split(F.col(c), ":")[0].cast("bigint")
    digest = lambda c: F.element_at(F.split(F.col(c), ":"), -1)
    status = (
        F.when(F.col("other").isNull(), "missing").when(F.col("one").isNull(), "extra").when(size("one") != size("other"), "resized").otherwise("corrupt")
    )
    return found.select(
        "file",
        F.col("place").alias("offset"),
        status.alias("status"),
        size("one").alias("length"),
        size("other").alias("copy_length"),
        digest("one").alias("digest"),
        digest("other").alias("copy_digest"),
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, offset, length, digest, target_uri) of the records in WARC files, plain or gzip.

    Offsets are those of the uncompressed stream. A file is read in the task that opens it, so files
    should be of the usual size (about a gigabyte at most); a record cut short ends its file.
    """
    workers_import_here(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = list(split_records(gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content))
                yield pa.RecordBatch.from_pylist([{"file": name, **r} for r in rows], schema=kinds)

    kinds = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("digest", pa.string()), ("target_uri", pa.string())])
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(run, "file string, offset bigint, length bigint, digest string, target_uri string")


def split_records(data: bytes) -> Iterator[dict]:
    import hashlib

    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        head = dict(line.split(b":", 1) for line in data[at:end].split(b"\r\n")[1:] if b":" in line)
        head = {k.strip().lower(): v.strip() for k, v in head.items()}
        stop = end + 4 + int(head.get(b"content-length", b"0")) + 4
        if stop > len(data):
            return
        whole = data[at:stop]
        yield {
            "offset": at,
            "length": len(whole),
            "digest": hashlib.sha256(whole).hexdigest(),
            "target_uri": head.get(b"warc-target-uri", b"").decode("utf-8", "replace"),
        }
        at = stop
