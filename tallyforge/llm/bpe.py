"""Byte-level BPE: encode and decode whole texts with a given rank table.

Every match of the split pattern is a piece of its own. A piece's merges run on a segment tree over
its byte positions: leaf i holds the rank of the pair that starts at live position i (with i itself as
the tie-break), every inner node the smaller of its two children, so the root is the leftmost pair of
the lowest rank. A merge rewrites three leaves (the merged position, its live left neighbour, and the
position that vanishes) and their paths to the root, so a piece of n bytes takes O(n log n).

Short pieces are merged many at a time: one tree per row of a numpy matrix, the same step for all rows.
Long pieces (runs without a break may be as long as the text) go through the same tree one by one.
Encoded pieces are remembered during a task in a table of bounded size; it only saves work.

Defined cases: a null text counts as empty; an empty text has no ids and decodes to nothing; ids that
are null or out of range fail the decode with a clear error. Rows are independent, so ties, repeats,
extra columns and empty tables need no care: all columns of the input are kept, those named like an
output are replaced. There is no shuffle.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.llm.common import chunks, workers_import_here

NONE = np.int32(2**31 - 1)
#: Longest piece (bytes) that is merged together with others; longer ones go alone.
WIDEST = 64
ROWS_AT_ONCE = 8192
REMEMBERED = 400_000

_MODELS: dict[str, "Codec"] = {}


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank from a file of ``base64-token rank`` lines; ranks must run from 0 without a gap."""
    ranks: dict[int, bytes] = {}
    with open(path, "rb") as lines:
        for line in lines:
            if parts := line.split():
                ranks[int(parts[1])] = base64.b64decode(parts[0])
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"{path}: ranks are not 0..n-1")
    return [ranks[i] for i in range(len(ranks))]


class Codec:
    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = tokens
        self.find = regex.compile(pattern).findall
        self.rank = {t: i for i, t in enumerate(tokens)}
        self.byte_ids = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for i, t in enumerate(tokens):
            for cut in range(1, len(t)):
                left, right = self.rank.get(t[:cut]), self.rank.get(t[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = i
        self.pairs = pairs
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int32)
        self.known: dict[str, bytes] = {}

    # -- ranks of pairs ---------------------------------------------------
    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.pair_keys):
            return np.full(left.shape, NONE)
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE)

    # -- many short pieces at once ---------------------------------------
    def _merge_rows(self, pieces: list[bytes], width: int) -> list[bytes]:
        n, lens = len(pieces), np.fromiter(map(len, pieces), np.int32, len(pieces))
        place = np.arange(width, dtype=np.int32)
        inside = place < lens[:, None]
        token = np.zeros((n, width), np.int32)
        token[inside] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        follows = np.tile(place + 1, (n, 1))
        before = np.tile(place - 1, (n, 1))
        live = inside.copy()

        def keyed(rank: np.ndarray, at: np.ndarray) -> np.ndarray:
            return np.where(rank == NONE, NONE, rank * width + at).astype(np.int32)

        tree = np.full((n, 2 * width), NONE, np.int32)
        first = self._ranks(token[:, :-1], token[:, 1:])
        first[~inside[:, 1:]] = NONE
        # the key needs rank * width + place below 2**31, which the largest table and WIDEST keep
        tree[:, width : 2 * width - 1] = keyed(first, place[:-1])
        level = width
        while level > 1:
            half = level // 2
            tree[:, half:level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level = half
        rows = np.arange(n)
        while True:
            root = tree[rows, 1]
            open_ = root < NONE
            rows, root = rows[open_], root[open_]
            if not len(rows):
                break
            rank, at = np.divmod(root, np.int32(width))
            gone = follows[rows, at]
            after = follows[rows, gone]
            has_after = after < lens[rows]
            live[rows, gone] = False
            token[rows, at] = rank
            follows[rows, at] = after
            before[rows[has_after], after[has_after]] = at[has_after]
            ahead = np.where(has_after, after, at)
            left = before[rows, at]
            has_left = left >= 0
            behind = np.where(has_left, left, at)
            tree[rows, width + gone] = NONE
            new_left = keyed(self._ranks(token[rows, behind], rank), behind)
            tree[rows[has_left], width + behind[has_left]] = new_left[has_left]
            tree[rows, width + at] = np.where(has_after, keyed(self._ranks(rank, token[rows, ahead]), at), NONE)
            paths = [width + gone, width + at, width + behind]
            for _ in range(width.bit_length() - 1):
                paths = [p >> 1 for p in paths]
                for p in paths:
                    tree[rows, p] = np.minimum(tree[rows, 2 * p], tree[rows, 2 * p + 1])
        ids = token[live].astype("<u4").tobytes()
        ends = np.cumsum(live.sum(1)).tolist()
        return [ids[4 * a : 4 * b] for a, b in zip([0, *ends], ends)]

    # -- one long piece ---------------------------------------------------
    def _merge_one(self, piece: bytes) -> bytes:
        n, pairs = len(piece), self.pairs
        width = 1 << max(1, (n - 1).bit_length())
        token = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        follows, before = list(range(1, n + 1)), list(range(-1, n - 1))
        none = 1 << 60
        tree = [none] * (2 * width)
        for i in range(n - 1):
            rank = pairs.get(token[i] << 32 | token[i + 1])
            if rank is not None:
                tree[width + i] = rank * width + i
        for i in range(width - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b

        def put(at: int, value: int) -> None:
            i = at + width
            tree[i] = value
            i >>= 1
            while i:
                a, b = tree[2 * i], tree[2 * i + 1]
                least = a if a < b else b
                if tree[i] == least:
                    return
                tree[i] = least
                i >>= 1

        while tree[1] < none:
            rank, at = divmod(tree[1], width)
            gone = follows[at]
            after = follows[gone]
            token[at], token[gone], follows[at] = rank, -1, after
            put(gone, none)
            ahead = None
            if after < n:
                before[after] = at
                ahead = pairs.get(rank << 32 | token[after])
            put(at, none if ahead is None else ahead * width + at)
            left = before[at]
            if left >= 0:
                behind = pairs.get(token[left] << 32 | rank)
                put(left, none if behind is None else behind * width + left)
        return np.array([t for t in token if t >= 0], "<u4").tobytes()

    # -- texts ------------------------------------------------------------
    def learn(self, pieces: set[str]) -> None:
        """Encode the pieces that are not remembered yet."""
        groups: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces.difference(self.known):
            raw = piece.encode("utf-8")
            whole = self.rank.get(raw)
            if whole is not None:
                self.known[piece] = whole.to_bytes(4, "little")
            elif len(raw) > WIDEST:
                self.known[piece] = self._merge_one(raw)
            else:
                groups.setdefault(1 << (len(raw) - 1).bit_length(), []).append((piece, raw))
        for width, group in groups.items():
            for k in range(0, len(group), ROWS_AT_ONCE):
                part = group[k : k + ROWS_AT_ONCE]
                self.known.update(zip([p for p, _ in part], self._merge_rows([r for _, r in part], width)))

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.find(t) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        self.learn(set(chain.from_iterable(split)))
        look = self.known.__getitem__
        for pieces in split:
            yield b"".join(map(look, pieces))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _codec(model) -> Codec:
    """The codec of a broadcast table, built once per worker."""
    name, pattern, tokens = model.value
    if name not in _MODELS:
        _MODELS[name] = Codec(tokens, pattern)
    return _MODELS[name]


def forget() -> None:
    """Give back the remembered pieces: workers outlive tasks, and other work follows on the same ones."""
    for codec in _MODELS.values():
        codec.known.clear()


def _shared(spark: SparkSession, path: str, pattern: str):
    tokens = read_ranks(path)
    name = hashlib.sha256(b"\0".join(tokens) + pattern.encode()).hexdigest()
    return spark.sparkContext.broadcast((name, pattern, tokens))


def _mapped(df: DataFrame, text: str, columns: list[tuple[str, T.DataType, pa.DataType]], work: Callable) -> DataFrame:
    """``df`` with columns that ``work`` makes of each chunk of column ``text``."""
    new = [name for name, _, _ in columns]
    kept = [c for c in df.columns if c not in new]
    source = df.select(*kept) if text in kept else df.select(*kept, text)
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(n, kind) for n, kind, _ in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            made = work(batch.column(batch.schema.get_field_index(text)))
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            arrays += [pa.array(v, kind) for v, (_, _, kind) in zip(made, columns)]
            yield pa.RecordBatch.from_arrays(arrays, kept + new)
        forget()

    return source.mapInArrow(run, schema)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with ``out`` array<int>: the ids of column ``text``."""
    workers_import_here(df.sparkSession)
    model = _shared(df.sparkSession, path, pattern)

    def work(column: pa.Array) -> list:
        codec = _codec(model)
        return [[np.frombuffer(ids, "<u4").astype(np.int32) for ids in codec.encode(column.to_pylist())]]

    return _mapped(df, text, [(out, T.ArrayType(T.IntegerType()), pa.list_(pa.int32()))], work)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out`` binary: the bytes that the ids stand for; a null array decodes to no bytes."""
    workers_import_here(df.sparkSession)
    model = _shared(df.sparkSession, path, pattern)
    kept = [c for c in df.columns if c != out]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(out, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codec = _codec(model)
            made = []
            for row in batch.column(batch.schema.get_field_index(ids)).to_pylist():
                if any(i is None or not 0 <= i < len(codec.tokens) for i in row or []):
                    raise ValueError("an id is null or outside the rank table")
                made.append(codec.decode(np.array(row or [], "<u4").tobytes()))
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(made, pa.binary())], [*kept, out])

    return df.select(*dict.fromkeys([*kept, ids])).mapInArrow(run, schema)


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` (without the text) with n_tokens, ids_sha256, decoded_sha256 and text_sha256.

    Encodes and decodes in one pass, so that neither ids nor bytes leave the task; the last column,
    computed apart from the codec, lets a reader confirm the round trip.
    """
    workers_import_here(df.sparkSession)
    model = _shared(df.sparkSession, path, pattern)

    def work(column: pa.Array) -> list:
        codec = _codec(model)
        counts, ids_sha, back_sha = [], [], []
        for ids in codec.encode(column.to_pylist()):
            counts.append(len(ids) // 4)
            ids_sha.append(hashlib.sha256(ids).hexdigest())
            back_sha.append(hashlib.sha256(codec.decode(ids)).hexdigest())
        return [counts, ids_sha, back_sha]

    source = df.withColumn("text_sha256", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    columns = [
        ("n_tokens", T.LongType(), pa.int64()),
        ("ids_sha256", T.StringType(), pa.string()),
        ("decoded_sha256", T.StringType(), pa.string()),
    ]
    return _mapped(source, text, columns, work).drop(text)
