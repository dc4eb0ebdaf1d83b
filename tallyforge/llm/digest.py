"""Document fingerprints: quartile bucket digests of hashed byte triplets.

In every window of five bytes the six triplets that hold its first byte are hashed into 128 buckets. The
three quartiles of the bucket counts turn each bucket into two bits, so the digest says which triplets are
frequent, not how many there are. A head of three bytes goes before them: a check byte, the length on a
logarithmic scale, and the ratios of the quartiles. Texts under five bytes are padded with zero bytes.

Two digests differ by the distance of their two-bit codes (a jump over two steps counts double), of their
lengths and of their quartile ratios, each bounded; ``likeness`` is one less that sum over its bound.

Defined cases: a null text counts as empty; every row has a fingerprint, equal texts equal ones. Documents
follow each other by id (null last), rows of one id by a hash of their text and then the text; the last is
followed by the first, a lone one by itself. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import chunks, workers_import_here
from tallyforge.session import settle

BUCKETS = 128
#: Places of the second and third byte of each triplet; the first is the window's first.
TRIPLETS = [(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4)]
_ONE, _TWO, _THREE, _LAST = (np.uint32(x) for x in (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F))
_SALTS = [np.uint32(0x165667B1 * (i + 1) & 0xFFFFFFFF) for i in range(6)]
#: Largest share of each part in the difference of two digests.
CODES_BOUND, LENGTH_BOUND, RATIO_BOUND, CHECK_BOUND = 6 * BUCKETS, 48, 48, 1


def _buckets(data: np.ndarray, first: int, end: int) -> np.ndarray:
    """Bucket counts of the windows that start at ``first`` up to before ``end``."""
    if end <= first:
        return np.zeros(BUCKETS, np.int64)
    byte = data[first : end + 4].astype(np.uint32)
    n = end - first
    one, two, three = byte[:n] * _ONE, byte * _TWO, byte * _THREE
    out = np.zeros(BUCKETS, np.int64)
    for salt, (j, k) in zip(_SALTS, TRIPLETS):
        mixed = one + two[j : j + n] + three[k : k + n] + salt
        mixed ^= mixed >> np.uint32(15)
        out += np.bincount((mixed * _LAST) >> np.uint32(25), minlength=BUCKETS)
    return out


def _padded(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw if len(raw) >= 5 else raw.ljust(5, b"\0"), np.uint8)


def digest(counts: np.ndarray, raw: bytes) -> np.ndarray:
    """35 bytes: check, length, ratios, then four buckets a byte."""
    order = np.sort(counts)
    q1, q2, q3 = (int(order[BUCKETS * i // 4 - 1]) for i in (1, 2, 3))
    code = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    body = code[0::4] << 6 | code[1::4] << 4 | code[2::4] << 2 | code[3::4]
    length = int(min(255, round(8 * np.log2(len(raw) + 1))))
    ratio = lambda q: int(q * 15 / q3) if q3 else 0
    head = [hashlib.blake2b(raw, digest_size=1).digest()[0], length, ratio(q1) << 4 | ratio(q2)]
    return np.concatenate([np.array(head, np.uint8), body.astype(np.uint8)])


def fingerprint(text: str | None) -> str:
    raw = (text or "").encode()
    data = _padded(raw)
    return digest(_buckets(data, 0, len(data) - 4), raw).tobytes().hex()


_CODES = np.array([[v >> 6 & 3, v >> 4 & 3, v >> 2 & 3, v & 3] for v in range(256)], np.int8)
_STEPS = np.array([0, 1, 2, 6])


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """1 for equal digests, 0 for the largest difference."""
    gap = np.abs(_CODES[one[3:]] - _CODES[other[3:]]).ravel()
    codes = int(_STEPS[gap].sum())
    length = min(LENGTH_BOUND, 2 * abs(int(one[1]) - int(other[1])))
    ratios = sum(min(RATIO_BOUND // 2, 3 * abs((int(one[2]) >> s & 15) - (int(other[2]) >> s & 15))) for s in (0, 4))
    check = int(one[0] != other[0])
    return 1.0 - (codes + length + ratios + check) / (CODES_BOUND + LENGTH_BOUND + RATIO_BOUND + CHECK_BOUND)


def compare(one: str, other: str) -> float:
    return likeness(np.frombuffer(bytes.fromhex(one), np.uint8), np.frombuffer(bytes.fromhex(other), np.uint8))


class _Doc:
    """A text with its bytes, bucket counts up to its last quarter, and digest."""

    def __init__(self, doc_id: int | None, text: str | None):
        self.doc_id, self.text = doc_id, text or ""
        self.raw = self.text.encode()
        self.kept = self.text[: len(self.text) - len(self.text) // 4].encode()
        data = _padded(self.raw)
        self.border = max(0, min(len(self.kept), len(self.raw)) - 4) if len(self.raw) >= 5 else 0
        self.start = _buckets(data, 0, self.border)
        self.print = digest(self.start + _buckets(data, self.border, len(data) - 4), self.raw)

    def row(self, after: "_Doc") -> dict:
        """Of this document, ``after`` being the next."""
        edited = self.kept + after.text[: len(self.text) // 4].encode()
        data = _padded(edited)
        shared = self.border if len(edited) >= 5 else 0
        counts = _buckets(data, shared, len(data) - 4) + (self.start if shared else 0)
        new = digest(counts, edited)
        return {
            "doc_id": self.doc_id, "n_chars": len(self.text), "edited_sha256": hashlib.sha256(edited).hexdigest(),
            "fingerprint": self.print.tobytes().hex(), "edited_fingerprint": new.tobytes().hex(),
            "near_edited": likeness(self.print, new), "near_next": likeness(self.print, after.print),
        }


_OUT = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
_OUT_DDL = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_SLICED = pa.schema([*_OUT, ("kind", pa.string()), ("slice", pa.int32()), ("text", pa.string())])
COLUMNS = [n for n, _ in _OUT]


def _slice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one slice in order; its first and last document leave with their texts."""
    last, number = None, None
    for batch in chunks(batches, "text"):
        rows = []
        for doc_id, text, number in zip(*[batch.column(i).to_pylist() for i in range(3)]):
            doc = _Doc(doc_id, text)
            if last is None:
                rows.append({"kind": "first", "slice": number, "doc_id": doc_id, "text": doc.text})
            else:
                rows.append(last.row(doc) | {"kind": "done"})
            last = doc
        yield pa.RecordBatch.from_pylist(rows, schema=_SLICED)
    if last is not None:
        yield pa.RecordBatch.from_pylist([{"kind": "last", "slice": number, "doc_id": last.doc_id, "text": last.text}], schema=_SLICED)


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [_Doc(i, t).row(_Doc(None, n)) for i, t, n in zip(*[batch.column(k).to_pylist() for k in range(3)])]
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(_OUT))


def against_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of each text and of its edited form: the last quarter replaced by the next document's start.

    Texts move once, into slices by id; a slice runs through its documents in order and keeps one. Only
    the last document of a slice waits for the first of the next one; these pairs are joined afterwards.
    """
    spark = docs.sparkSession
    workers_import_here(spark)
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("_h"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("_h")]
    sliced = own.repartitionByRange(slices, *order).sortWithinPartitions(*order, "text").select("doc_id", "text", F.spark_partition_id().alias("slice"))
    ran = settle(sliced.mapInArrow(_slice, f"{_OUT_DDL}, kind string, slice int, text string"))
    first = ran.where("kind = 'first'").select("slice", F.col("text").alias("next_text"))
    last = ran.where("kind = 'last'").select("slice", "doc_id", "text")
    # one number per slice meets here
    follows = first.select("slice").withColumn("_next", F.coalesce(F.lead("slice").over(Window.orderBy("slice")), F.min("slice").over(Window.partitionBy(F.lit(0)))))
    pairs = last.join(follows, "slice").select("doc_id", "text", "_next").join(first, F.col("_next") == F.col("slice")).select("doc_id", "text", "next_text")
    return ran.where("kind = 'done'").select(*COLUMNS).unionByName(pairs.mapInArrow(_edges, _OUT_DDL))
