"""Language identification by character language models with interpolated Kneser-Ney smoothing.

One model per language, up to ``ORDER`` characters. A run of characters is its own hash: twelve bits per
character, five characters in one 64-bit number, so a suffix is a mask and a context a shift. Each order
keeps one sorted array of the runs that any language has seen and, beside it, the interpolated
log-probability under every language; a second sorted array keeps the contexts and their back-off weights.
A text's runs are sorted and looked up in the longest order; runs that no language has seen there go on to
the next shorter one, with the context's weight. The language of the least cross-entropy per character
wins (ties: the first in the alphabet).

Counts come from a bounded sample of labelled rows (``rows_per_language``, by a hash of the id), whole
texts, counted by Spark; one part of the sample is kept aside to calibrate. Per language and length class
it gives a cross-entropy between that of the language's own texts and that of foreign texts under its model: a
text above it is ``rejected``, although the best language is still named. The score is the winner's share under a softmax of the
cross-entropies whose sharpness is chosen on the same part.

Characters: letters are lower-cased, runs of anything else are one blank; code points above 4095 share
cells (modulo 4096), so letters of large scripts (Chinese, Japanese, Korean) share cells with each other.

Defined cases: null texts and texts without a letter are ``und`` with score 0, and rejected; empty and
very long texts are scored whole; without any training row every text is ``und``. Rows are predicted one
by one, so repeats and extra columns do not matter; columns named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.llm.common import chunks, workers_import_here

ORDER = 5
BITS = 12
UNDETERMINED = "und"
#: Upper ends of the length classes (characters) of the calibration.
LENGTHS = [8, 32, 128, 512, 2048]
#: How far above the calibrated cross-entropy (nats per character) a text under LONG characters may lie.
LONG, SLACK = 128, 0.9
#: Where a longer text's limit lies between own texts (0) and foreign ones (1), and how far above own texts at least.
SHARE, ROOM = 0.45, 0.5

_LETTER: np.ndarray | None = None


def _letters() -> np.ndarray:
    """For each code point its cell if it is a letter, else 0 (the blank)."""
    global _LETTER
    if _LETTER is None:
        points = np.arange(0x110000, dtype=np.uint32)
        points[0xD800:0xE000] = 32
        cell = np.where(np.char.isalpha(points.view("U1")), points % (1 << BITS), 0).astype(np.uint16)
        cell[(cell == 0) & np.char.isalpha(points.view("U1"))] = 1
        _LETTER = cell
    return _LETTER


def cells(text: str | None) -> np.ndarray:
    """Cells of the text between blanks; empty if it has no letter."""
    if not text:
        return np.zeros(0, np.uint64)
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    cell = _letters()[points]
    if not cell.any():
        return np.zeros(0, np.uint64)
    keep = (cell > 0) | np.concatenate([[True], cell[:-1] > 0])
    cell = cell[keep]
    start, end = int(cell[0] == 0), len(cell) - int(cell[-1] == 0)
    out = np.zeros(end - start + 2, np.uint64)
    out[1:-1] = cell[start:end]
    return out


def runs(cell: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The run of up to ``order`` cells that ends at each cell (the text's start is padded with blanks)."""
    padded = np.concatenate([np.zeros(order - 1, np.uint64), cell])
    out = np.zeros(len(cell), np.uint64)
    for i in range(order):
        out = out << np.uint64(BITS) | padded[i : i + len(cell)]
    return out


def _suffix(run: np.ndarray, order: int) -> np.ndarray:
    return run & np.uint64((1 << BITS * order) - 1)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of each wanted number in sorted ``keys``, whether it is there)."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _unique(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = np.sort(x)
    edge = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)
    return x[edge], np.diff(np.append(edge, len(x)))


class Models:
    """Interpolated Kneser-Ney models of several languages over shared sorted arrays."""

    def __init__(self, languages: list[str], grams: dict[str, tuple[np.ndarray, np.ndarray]]):
        """``grams``: per language the sorted runs of the longest order and their counts."""
        self.languages = languages
        self.keys: list[np.ndarray] = []
        self.logs: list[np.ndarray] = []
        self.contexts: list[np.ndarray] = []
        self.backoffs: list[np.ndarray] = []
        by_order = {lang: self._orders(*grams[lang]) for lang in languages}
        floor = 1.0 / (1 << 8)
        shorter = None
        for order in range(1, ORDER + 1):
            keys = np.unique(np.concatenate([by_order[lang][order - 1][0] for lang in languages])) if languages else np.zeros(0, np.uint64)
            contexts = np.unique(keys >> np.uint64(BITS))
            probs, weights = np.zeros((len(keys), len(languages))), np.ones((len(contexts), len(languages)))
            for i, lang in enumerate(languages):
                own, counts = by_order[lang][order - 1]
                once, twice = (counts == 1).sum(), (counts == 2).sum()
                discount = min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.1
                at = np.searchsorted(contexts, own >> np.uint64(BITS))
                total = np.bincount(at, counts, len(contexts))
                kinds = np.bincount(at, minlength=len(contexts))
                seen = total > 0
                weights[seen, i] = discount * kinds[seen] / total[seen]
                place, held = _find(own, keys)
                context = np.searchsorted(contexts, keys >> np.uint64(BITS))
                count = np.where(held, counts[place] if len(own) else 0, 0)
                with np.errstate(invalid="ignore", divide="ignore"):
                    direct = np.where(total[context] > 0, np.maximum(count - discount, 0) / total[context], 0.0)
                probs[:, i] = direct
            context = np.searchsorted(contexts, keys >> np.uint64(BITS))
            lower = np.full_like(probs, floor) if shorter is None else np.exp(shorter(_suffix(keys, order - 1)))
            self.keys.append(keys)
            self.logs.append(np.log(probs + weights[context] * lower).astype(np.float32))
            self.contexts.append(contexts)
            self.backoffs.append(np.log(weights).astype(np.float32))
            shorter = lambda k, o=order: self.log_probability(k, o)
        self.floor = np.float32(np.log(floor))
        self.sharpness = 20.0
        self.limits = np.full((len(LENGTHS) + 1, len(languages)), np.inf)

    @staticmethod
    def _orders(keys: np.ndarray, counts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Runs and counts of orders 1 to ORDER; below the longest, the number of distinct characters before."""
        out = [(keys, counts)]
        for order in range(ORDER - 1, 0, -1):
            out.append(_unique(_suffix(out[-1][0], order)))
        return out[::-1]

    def log_probability(self, run: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Per run and language, of its last character after the others."""
        if order == 0:
            return np.full((len(run), len(self.languages)), np.log(1.0 / (1 << 8)), np.float32)
        at, held = _find(self.keys[order - 1], run)
        if held.all():
            return self.logs[order - 1][at]
        out = np.empty((len(run), len(self.languages)), np.float32)
        out[held] = self.logs[order - 1][at[held]]
        rest = run[~held]
        place, known = _find(self.contexts[order - 1], rest >> np.uint64(BITS))
        lower = self.log_probability(_suffix(rest, order - 1), order - 1)
        if known.any():
            lower[known] += self.backoffs[order - 1][place[known]]
        out[~held] = lower
        return out

    def entropies(self, text: str | None) -> tuple[int, np.ndarray]:
        """(characters, cross-entropy per character of each language); 0 characters: no letter."""
        cell = cells(text)[1:]
        if not len(cell):
            return 0, np.zeros(len(self.languages))
        run, count = _unique(runs(cell))
        return len(cell), -(count @ self.log_probability(run).astype(np.float64)) / len(cell)

    def predict(self, text: str | None) -> tuple[str, float, bool, float | None]:
        """(language, score, rejected, cross-entropy)."""
        n, entropy = self.entropies(text)
        if not n or not self.languages:
            return UNDETERMINED, 0.0, True, None
        best = int(np.argmin(entropy))
        share = float(1.0 / np.exp(-self.sharpness * (entropy - entropy[best])).sum())
        limit = self.limits[int(np.searchsorted(LENGTHS, n)), best]
        return self.languages[best], share, bool(entropy[best] > limit), float(entropy[best])

    def calibrate(self, rows: list[tuple[str, int, list[float]]]) -> None:
        """From (language, characters, cross-entropies) of labelled texts that were not trained on.

        Own texts show how high a language's texts go; the same texts under the other languages' models show
        where texts of a language that is not learned begin. From ``LONG`` characters on the limit of a class
        lies ``SHARE`` of the way from the first (99 of 100 own texts are below) to the second (the middle of the
        foreign ones, in the language nearest to the others), and at least ``ROOM`` above the first: where labels
        are wrong or texts mixed, the models know something of each other's languages, and foreign texts seem
        nearer than those of an unknown language are. Shorter texts say less: there the largest own
        cross-entropy but for one in a thousand, and ``SLACK``. A class with under 20 own texts takes the next
        longer class's limit, and slack if it is short; a language without a class of 20 one limit from all its
        texts and, under 20, those of all languages. With one language nothing foreign is known and slack stands
        in; only without a single text is nothing rejected.
        """
        index = {lang: i for i, lang in enumerate(self.languages)}
        found: dict[tuple[int, int], list[float]] = {}
        strange: dict[tuple[int, int], list[float]] = {}
        for lang, n, entropy in rows:
            if n and lang in index:
                at = int(np.searchsorted(LENGTHS, n)), index[lang]
                found.setdefault(at, []).append(entropy[index[lang]])
                if len(self.languages) > 1:
                    strange.setdefault(at, []).append(float(np.delete(entropy, index[lang]).min()))
        first_long = int(np.searchsorted(LENGTHS, LONG, "right"))
        far = [np.median(e) for (k, _), e in strange.items() if k >= first_long and len(e) >= 20]
        begins = float(min(far)) if far else float(np.median(sum(strange.values(), []))) if strange else None

        def limit(own: list[float], k: int) -> float:
            if k < first_long:
                return float(np.quantile(own, 0.999)) + SLACK
            high = float(np.quantile(own, 0.99))
            return high + (SLACK if begins is None else max(ROOM, SHARE * (begins - high)))

        for lang in range(len(self.languages)):
            last = None
            for k in range(len(LENGTHS), -1, -1):
                own = found.get((k, lang), [])
                if len(own) >= 20:
                    last = limit(own, k)
                elif last is not None and k < first_long:
                    last += SLACK
                if last is not None:
                    self.limits[k, lang] = last
        pool = [e for own in found.values() for e in own]
        for lang in range(len(self.languages)):
            if np.isinf(self.limits[:, lang]).all() and pool:
                own = [e for (_, i), es in found.items() if i == lang for e in es]
                shared = own if len(own) >= 20 else [*pool, *own]
                for k in range(len(LENGTHS) + 1):
                    self.limits[k, lang] = max([limit(shared, first_long), *own]) + SLACK * max(0, first_long - k)
        for k in range(1, len(LENGTHS) + 1):
            self.limits[k] = np.where(np.isinf(self.limits[k]), self.limits[k - 1], self.limits[k])
        judged = [(index[lang], np.array(e)) for lang, n, e in rows if n and lang in index]
        if judged:
            entropy, truth = np.array([e for _, e in judged]), np.array([t for t, _ in judged])
            gap = entropy - entropy.min(1, keepdims=True)
            losses = []
            for sharp in (5.0, 10.0, 20.0, 40.0, 80.0):
                share = np.exp(-sharp * gap)
                share /= share.sum(1, keepdims=True)
                losses.append((-np.log(np.maximum(share[np.arange(len(truth)), truth], 1e-12)).mean(), sharp))
            self.sharpness = min(losses)[1]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = pa.schema([("lang", pa.string()), ("run", pa.int64()), ("n", pa.int64())])
    for batch in chunks(batches, "text", 4_000_000):
        by_lang: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if len(cell := cells(text)):
                by_lang.setdefault(lang, []).append(runs(cell[1:]))
        for lang, parts in by_lang.items():
            run, n = _unique(np.concatenate(parts))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(run), pa.string()), pa.array(run.view(np.int64)), pa.array(n.astype(np.int64))], schema=kinds)


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", rows_per_language: int = 1500) -> Models:
    """Models of every language in ``labelled``.

    At most about ``rows_per_language`` rows of each are used, chosen by a hash of id and text; one in
    five of them calibrates. Rows without language or text do not count.
    """
    spark = labelled.sparkSession
    workers_import_here(spark)
    own = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.pmod(F.xxhash64(doc_id, text), F.lit(1 << 40)).alias("_draw")
    )
    totals = {r["lang"]: r["n"] for r in own.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    chosen = F.lit(False)
    for name, n in totals.items():
        cut = int(min(1.0, rows_per_language / n) * (1 << 40))
        chosen = chosen | ((F.col("lang") == name) & (F.col("_draw") < cut))
    sample = own.where(chosen).withColumn("_aside", F.pmod(F.col("_draw"), F.lit(5)) == 0)
    runs_ = sample.where("not _aside").select("lang", "text").mapInArrow(_counted, "lang string, run bigint, n bigint")
    table = runs_.groupBy("lang", "run").agg(F.sum("n").alias("n")).toArrow()
    names, key, count = np.array(table.column("lang").to_pylist()), table.column("run").to_numpy().astype(np.int64).view(np.uint64), table.column("n").to_numpy()
    grams = {}
    for name in sorted(totals):
        mine = names == name if len(names) else np.zeros(0, bool)
        order = np.argsort(key[mine])
        grams[name] = (key[mine][order], count[mine][order])
    models = Models([n for n in sorted(totals) if len(grams[n][0])], grams)
    shared = spark.sparkContext.broadcast(models)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("lang", pa.string()), ("n", pa.int64()), ("entropy", pa.list_(pa.float64()))])
        for batch in chunks(batches, "text"):
            rows = [(lang, *shared.value.entropies(t)) for lang, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2].tolist() for r in rows], pa.list_(pa.float64()))], schema=kinds)

    aside = sample.where("_aside").select("lang", "text").mapInArrow(measured, "lang string, n bigint, entropy array<double>").collect()
    models.calibrate([(r["lang"], r["n"], r["entropy"]) for r in aside])
    return models


def predict(df: DataFrame, models: Models, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``df`` with lang_pred, score, rejected and cross_entropy."""
    spark = df.sparkSession
    workers_import_here(spark)
    shared = spark.sparkContext.broadcast(models)
    new = [("lang_pred", T.StringType(), pa.string()), ("score", T.DoubleType(), pa.float64()), ("rejected", T.BooleanType(), pa.bool_()), ("cross_entropy", T.DoubleType(), pa.float64())]
    names = [n for n, _, _ in new]
    kept = [c for c in df.columns if c not in names and (keep_text or c != text)]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(n, t) for n, t, _ in new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            made = zip(*[shared.value.predict(t) for t in batch.column(batch.schema.get_field_index(text)).to_pylist()])
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*arrays, *[pa.array(list(v), kind) for v, (_, _, kind) in zip(made, new)]], [*kept, *names])

    return df.select(*dict.fromkeys([*kept, text])).mapInArrow(run, schema)
