"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages (``PASSAGE`` words each, the last one shorter); only the document has a
label. Every passage becomes a vector: shares of character classes, word statistics, repetition, and hashed
pairs of neighbouring character classes and bytes. An encoder maps it to a hidden representation ``h``; a gated attention
``softmax(w . (tanh(V h) * sigmoid(U h)))`` weighs the document's passages, and the score is the logistic
value of the weighted sum of their representations. All parts are learned together from document labels.

Passages are encoded in Spark tasks for every document; the weights are fitted on a bounded sample of
labelled documents (``rows``, by a hash of the id), of which only the passage vectors come to the driver.
The same code computes vectors for fitting and scoring, many texts at a time in numpy.

Defined cases: a null or blank text is one empty passage and gets a score like any other; very long texts
are scored whole; labels that are null, or of documents that do not exist, do not count, of contradicting
labels the smallest; without labels of both kinds every score is the share of label 1 (0.5 without any).
Rows are scored one by one, so repeats and extra columns do not matter; outputs replace columns of their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.llm.common import chunks, sampled, workers_import_here
from tallyforge.llm.shingles import word_hashes

PASSAGE = 48
HASHED = 48
#: Character classes by byte: blank, line end, a-z, A-Z, digit, sentence mark, other sign, bytes of longer characters.
BLANK, LINE, LOWER, UPPER, DIGIT, MARK, SIGN, WIDE = range(8)


def _classes() -> np.ndarray:
    out = np.full(256, SIGN, np.uint8)
    out[[9, 11, 12, 32]] = BLANK
    out[[10, 13]] = LINE
    out[97:123], out[65:91], out[48:58], out[128:] = LOWER, UPPER, DIGIT, WIDE
    out[list(b".,;:'\"?!-()")] = MARK
    return out


_CLASS = _classes()
_BUCKET = (np.random.default_rng(5).integers(0, HASHED, (256, 256))).astype(np.int64)
NUMBERS = 8 + 64 + 9
WIDTH = NUMBERS + HASHED


def passages(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(vectors of all passages, number of passages of each text)."""
    raw = [(t or "").encode() for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    kind = _CLASS[data]
    space = kind <= LINE
    words, firsts = word_hashes(raw)
    edge = np.flatnonzero(np.diff(space, prepend=True))
    starts, ends = edge[0::2], edge[1::2]
    per_text = np.diff(firsts)
    counts = np.maximum(1, -(-per_text // PASSAGE))
    offset = np.concatenate([[0], np.cumsum(counts)])
    total = int(offset[-1])
    text_of_word = np.repeat(np.arange(len(raw)), per_text)
    place = np.arange(len(words)) - firsts[:-1][text_of_word]
    of_word = offset[text_of_word] + place // PASSAGE
    text_starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)])
    # a byte belongs to the passage of the last word that began, a text's leading bytes to its first passage
    of_byte = np.zeros(len(data), np.int64)
    mark = np.zeros(len(data) + 1, np.int64)
    np.add.at(mark, text_starts[:-1], 1)
    text_of_byte = np.cumsum(mark[:-1]) - 1
    begun = np.cumsum(np.bincount(starts, minlength=len(data)))
    has = begun > firsts[:-1][text_of_byte]
    of_byte = np.where(has, of_word[np.maximum(begun - 1, 0)] if len(words) else 0, offset[text_of_byte])
    size = np.bincount(of_byte, minlength=total).astype(np.float64)
    n_words = np.bincount(of_word, minlength=total).astype(np.float64)
    out = np.zeros((total, WIDTH), np.float32)
    share = np.bincount(of_byte * 8 + kind, minlength=total * 8).reshape(total, 8) / np.maximum(size, 1)[:, None]
    out[:, :8] = share
    inner = np.ones(len(data), bool)
    inner[text_starts[:-1]] = False  # no pair spans two texts
    at = np.flatnonzero(inner)
    passage, before = of_byte[at], at - 1
    pair = np.bincount(passage * 64 + kind[before].astype(np.int64) * 8 + kind[at], minlength=total * 64).reshape(total, 64)
    out[:, 8:72] = np.sqrt(pair / np.maximum(size, 1)[:, None])
    length = (ends - starts).astype(np.float64)
    mean = np.bincount(of_word, length, total) / np.maximum(n_words, 1)
    spread = np.bincount(of_word, length**2, total) / np.maximum(n_words, 1) - mean**2
    again = np.zeros(len(words), bool)
    if len(words) > 1:
        again[1:] = (words[1:] == words[:-1]) & (of_word[1:] == of_word[:-1])
    order = np.lexsort((words, of_word))
    w, p = words[order], of_word[order]
    fresh = np.concatenate([[True], (w[1:] != w[:-1]) | (p[1:] != p[:-1])]) if len(w) else np.zeros(0, bool)
    distinct = np.bincount(p[fresh], minlength=total) / np.maximum(n_words, 1)
    last = kind[np.maximum(ends - 1, 0)] if len(ends) else kind[:0]
    first = kind[starts] if len(starts) else kind[:0]
    rate = lambda flag: np.bincount(of_word, flag, total) / np.maximum(n_words, 1)
    numbers = [
        mean / 8, np.sqrt(np.maximum(spread, 0)) / 8, distinct, rate(again), rate(first == UPPER), rate(last == SIGN), rate(last == MARK), rate(length == 1), np.log1p(n_words) / 4,
    ]
    for i, v in enumerate(numbers):
        out[:, 72 + i] = v
    hashed = np.bincount(passage * HASHED + _BUCKET[data[before], data[at]], minlength=total * HASHED).reshape(total, HASHED)
    out[:, NUMBERS:] = np.sqrt(hashed / np.maximum(size, 1)[:, None])
    return out, counts


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class Attention:
    """Encoder, gated attention and classifier over bags of passage vectors."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, hidden: int = 24, gates: int = 12, seed: int = 3, base: float = 0.5):
        rng = np.random.default_rng(seed)
        self.mean, self.scale, self.base, self.fitted = mean, scale, base, False
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {"W": draw(len(mean), hidden), "b": np.zeros(hidden, np.float32), "V": draw(hidden, gates), "U": draw(hidden, gates), "w": draw(gates, 1)[:, 0], "c": draw(hidden, 1)[:, 0], "d": np.zeros(1, np.float32)}

    def forward(self, x: np.ndarray, counts: np.ndarray) -> dict:
        """``x``: passages of all bags one after the other, scaled."""
        p, starts = self.p, np.concatenate([[0], np.cumsum(counts)[:-1]])
        bag = np.repeat(np.arange(len(counts)), counts)
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * s) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        a = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return {"bag": bag, "starts": starts, "h": h, "t": t, "s": s, "a": a, "z": z, "y": _sigmoid(z @ p["c"] + p["d"])}

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8).astype(np.float32)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not self.fitted:
            return np.full(len(texts), self.base)
        x, counts = passages(texts)
        return self.forward(self.scaled(x), counts)["y"].astype(np.float64)

    def gradients(self, x: np.ndarray, counts: np.ndarray, label: np.ndarray, decay: float) -> dict[str, np.ndarray]:
        p, f = self.p, self.forward(x, counts)
        dy = ((f["y"] - label) / len(label)).astype(np.float32)
        g = {"c": f["z"].T @ dy, "d": dy.sum(keepdims=True)}
        dz = dy[:, None] * p["c"]
        dzb = dz[f["bag"]]
        da = (dzb * f["h"]).sum(1)
        de = f["a"] * (da - np.add.reduceat(f["a"] * da, f["starts"])[f["bag"]])
        g["w"] = (f["t"] * f["s"]).T @ de
        dt = de[:, None] * p["w"] * f["s"] * (1 - f["t"] ** 2)
        ds = de[:, None] * p["w"] * f["t"] * f["s"] * (1 - f["s"])
        g["V"], g["U"] = f["h"].T @ dt, f["h"].T @ ds
        dh = f["a"][:, None] * dzb + dt @ p["V"].T + ds @ p["U"].T
        du = dh * (1 - f["h"] ** 2)
        g["W"], g["b"] = x.T @ du, du.sum(0)
        for k in ("W", "V", "U", "c"):
            g[k] = g[k] + decay * p[k]
        return g

    def fit(self, bags: list[np.ndarray], label: np.ndarray, epochs: int = 25, batch: int = 128, rate: float = 4e-3, decay: float = 2e-4, seed: int = 11) -> None:
        """Adam over shuffled batches; the order follows from the seed."""
        rng = np.random.default_rng(seed)
        bags = [self.scaled(b) for b in bags]
        sizes = np.array([len(b) for b in bags])
        first, second, step = {k: 0.0 for k in self.p}, {k: 0.0 for k in self.p}, 0
        for epoch in range(epochs):
            order = rng.permutation(len(bags))
            for k in range(0, len(order), batch):
                pick = order[k : k + batch]
                g = self.gradients(np.concatenate([bags[i] for i in pick]), sizes[pick], label[pick], decay)
                step += 1
                pace = rate * min(1.0, 2 * (1 - epoch / epochs))
                for name in self.p:
                    first[name] = 0.9 * first[name] + 0.1 * g[name]
                    second[name] = 0.999 * second[name] + 0.001 * g[name] ** 2
                    move = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                    self.p[name] = (self.p[name] - pace * move).astype(np.float32)
        self.fitted = True


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text"):
        x, counts = passages(batch.column(2).to_pylist())
        ends = np.cumsum(counts)
        blobs = [x[b - n : b].astype(np.float16).tobytes() for n, b in zip(counts.tolist(), ends.tolist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(blobs, pa.binary())], ["doc_id", "label", "x"])


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", rows: int = 6000) -> Attention:
    """Fit on about ``rows`` labelled documents (all, if there are fewer)."""
    workers_import_here(docs.sparkSession)
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.min(label).cast("double").alias("label"))
    # at most about ``rows`` lines of two numbers, which bounds what is sent to every task
    known = F.broadcast(sampled(known, rows, "_id", seed=9))
    labelled = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).join(known, F.col("doc_id") == F.col("_id"))
    got = labelled.select("doc_id", "label", "text").mapInArrow(_encoded, "doc_id bigint, label double, x binary").toArrow()
    # one fixed order, so that reruns fit alike
    found = sorted(zip(got.column("doc_id").to_pylist(), got.column("label").to_pylist(), got.column("x").to_pylist()))
    y = np.array([r[1] for r in found], np.float32)
    if len(found) == 0 or y.min() == y.max():
        return Attention(np.zeros(WIDTH), np.ones(WIDTH), base=float(y.mean()) if len(found) else 0.5)
    bags = [np.frombuffer(r[2], np.float16).reshape(-1, WIDTH).astype(np.float32) for r in found]
    every = np.concatenate(bags)
    model = Attention(every.mean(0), every.std(0) + 1e-2)
    model.fit(bags, y)
    return model


def score(df: DataFrame, model: Attention, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``df`` with score (0 to 1) and predicted (1 from 0.5 on)."""
    spark = df.sparkSession
    workers_import_here(spark)
    shared = spark.sparkContext.broadcast(model)
    kept = [c for c in df.columns if c not in ("score", "predicted") and (keep_text or c != text)]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            y = shared.value.scores(batch.column(batch.schema.get_field_index(text)).to_pylist())
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(y), pa.array((y >= 0.5).astype(np.int32))], [*kept, "score", "predicted"])

    return df.select(*dict.fromkeys([*kept, text])).mapInArrow(run, schema)
