"""Alignment of two tokenizers' tokens over the corpus, each distinct text tokenised and aligned once.

Texts are shuffled whole and equal ones folded to one row with their number. Every distinct text is encoded by
both tokenizers; token ends as byte offsets cut it into groups where both end, and every stretch between two
neighbouring ends of either side is one link, the one A token and the one B token that cover it. An id pair's
count adds its links over all texts, each text weighed by how often it stands in the corpus. Measures of a text
go back to its rows by its key (md5 and length).

Scale: texts move once, folded before the shuffle; links never move with their texts. They lie packed, one
integer a link, beside the text's key, are counted with map-side partials, and meet the pair counts again as a
broadcast only if that table has at most ``BROADCAST`` rows (it is counted first), else by a shuffled join over
one row per (text, pair), which adaptive execution splits where a pair is in many texts. A text that a third of
the documents share is tokenised once, and joined by a slim table of measures.

Defined cases: null and empty texts, and texts whose joined token bytes of either side are not the expected
bytes (a blank and the text), have no tokens: zeros and an empty ``groups_sha256``. Strings of special tokens
are plain text. Repeated rows and ids keep a row each; very long texts are one call of each tokenizer. Other
columns of the table are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import chunks, workers_import_here
from tallyforge.session import settle

#: Most pairs that are sent to every executor.
BROADCAST = 2_000_000
_ALIGNED = "key string, n long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links array<long>"


def byte_of_char() -> dict[str, int]:
    """The printable stand-ins by which byte-level vocabularies spell bytes: printable bytes stand for themselves,
    the others follow from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


#: Up to this character both engines below know every letter, digit and space alike (a test goes through them all).
_ALIKE = re.compile("[^\x00-\u024f]")


@cache
def byte_level(path: str, pattern: str) -> tuple[Callable, list[bytes]]:
    """Encoder of a byte-level JSON vocabulary, and the bytes of each id. The text gets a blank in front.

    Where the file's merges come in the order of their ids, they are ranks, and texts of characters that both
    engines class alike go through the faster one; all others go through the file's own library.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import tiktoken
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(path)
    tool.encode_special_tokens = True
    spelt = byte_of_char()
    known = [bytes(spelt[c] for c in (tool.id_to_token(i) or "") if c in spelt) for i in range(tool.get_vocab_size())]
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    in_order = [model["vocab"][m] for m in merged] == list(range(256, 256 + len(merged)))
    quick = None
    if in_order and sorted(known[:256]) == [bytes([b]) for b in range(256)]:
        quick = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(known[: 256 + len(merged)])}, special_tokens={})

    def encode(texts: list[str]) -> list:
        out, rest = [None] * len(texts), []
        for i, text in enumerate(texts):
            if quick is not None and not _ALIKE.search(text):
                out[i] = quick.encode_to_numpy(" " + text, disallowed_special=())
            else:
                rest.append(i)
        for i, e in zip(rest, tool.encode_batch_fast([" " + texts[i] for i in rest], add_special_tokens=False)):
            out[i] = np.array(e.ids, np.uint32)
        return out

    return encode, known


@cache
def pieces(path: str) -> tuple[Callable, list[bytes]]:
    """Encoder of a piece model, which puts the blank in front itself, and the bytes of each id."""
    import sentencepiece

    tool = sentencepiece.SentencePieceProcessor(model_file=path)
    known = []
    for i in range(tool.get_piece_size()):
        name = tool.id_to_piece(i)
        known.append(bytes([int(name[3:5], 16)]) if tool.is_byte(i) else name.replace("▁", " ").encode())
    return lambda texts: tool.encode(texts, num_threads=1), known


class Pair:
    """Both tokenizers with their tables by id: lengths in bytes and the spellings that digests are made of."""

    def __init__(self, path_a: str, path_b: str, pattern: str):
        (self.encode_a, self.bytes_a), (self.encode_b, self.bytes_b) = byte_level(path_a, pattern), pieces(path_b)
        self.len_a, self.len_b = (np.array([len(t) for t in known], np.int64) for known in (self.bytes_a, self.bytes_b))
        self.base = len(self.bytes_b)
        #: Spelling of an id by what follows it: A inside a group, A at its end, B inside, B at its end.
        self.spell = np.array([f"{i}{end}" for known, ends in ((self.bytes_a, ",|"), (self.bytes_b, ",;")) for end in ends for i in range(len(known))], "S")

    def ids(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both sides, or None where the bytes do not come out."""
        out = []
        for text, a, b in zip(texts, self.encode_a(texts), self.encode_b(texts)):
            want = b" " + text.encode()
            ok = b"".join(map(self.bytes_a.__getitem__, a.tolist())) == want and b"".join(map(self.bytes_b.__getitem__, b)) == want
            out.append((a.astype(np.int64), np.array(b, np.int64)) if ok else None)
        return out

    def align(self, a: np.ndarray, b: np.ndarray):
        """Links as packed id pairs, number of groups, digest of the groups."""
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        # By byte offset: 1 where an A token ends, 2 where a B token does, 3 where a group does.
        mark = np.zeros(end_a[-1] + 1, np.uint8)
        mark[end_a] = 1
        mark[end_b] += 2
        kinds = mark[np.flatnonzero(mark)]
        is_a, is_b, both = kinds != 2, kinds != 1, kinds == 3
        # The token that covers the stretch before an end is the next of its side to end.
        links = a[np.cumsum(is_a) - is_a] * self.base + b[np.cumsum(is_b) - is_b]
        before = np.cumsum(both) - both
        group_a, group_b = before[is_a], before[is_b]
        groups = int(both.sum())
        # In the text of groups a token comes after its side's tokens so far and those of the other side's groups before.
        size_a, size_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + (np.cumsum(size_b) - size_b)[group_a]] = a + both[is_a] * len(self.bytes_a)
        codes[np.arange(len(b)) + np.cumsum(size_a)[group_b]] = 2 * len(self.bytes_a) + b + both[is_b] * len(self.bytes_b)
        shown = self.spell[codes].tobytes().translate(None, b"\0")
        return links, groups, hashlib.sha256(shown[:-1]).hexdigest()


@cache
def _pair(path_a: str, path_b: str, pattern: str) -> Pair:
    return Pair(path_a, path_b, pattern)


def text_key(text: Column) -> Column:
    return F.concat(F.md5(text), F.lit("-"), F.octet_length(text).cast("string"))


def aligned(docs: DataFrame, path_a: str, path_b: str, pattern: str) -> DataFrame:
    """One row per distinct text that has any: key, rows with it (n), measures, and its links as packed pairs."""
    workers_import_here(docs.sparkSession)
    distinct = docs.where("text is not null and text <> ''").groupBy("text").agg(F.count("*").alias("n"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _pair(path_a, path_b, pattern)
        for batch in chunks(batches, "text"):
            rows = []
            known = zip(batch.column("key").to_pylist(), batch.column("n").to_pylist(), both.ids(batch.column("text").to_pylist()))
            for key, n, ids in known:
                if ids is None:
                    rows.append((key, n, 0, 0, 0, 0, "", np.empty(0, np.int64)))
                    continue
                links, groups, digest = both.align(*ids)
                rows.append((key, n, len(ids[0]), len(ids[1]), groups, len(links), digest, links))
            if rows:
                *plain, links = zip(*rows)
                ends = np.concatenate([[0], np.cumsum([len(x) for x in links])]).astype(np.int32)
                packed = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(links)))
                kinds = [pa.string(), *[pa.int64()] * 5, pa.string()]
                columns = [pa.array(c, k) for c, k in zip(plain, kinds)]
                yield pa.RecordBatch.from_arrays([*columns, packed], ["key", "n", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"])

    return distinct.select(text_key(F.col("text")).alias("key"), "text", "n").mapInArrow(work, _ALIGNED)


def pair_counts(texts: DataFrame) -> DataFrame:
    """(pair, count, best): links that hold an id pair, corpus-wide; best if no pair of its B id has more."""
    counts = texts.select("n", F.explode("links").alias("pair")).groupBy("pair").agg(F.sum("n").alias("count"))
    return settle(counts)


def with_best(counts: DataFrame, base: int) -> DataFrame:
    highest = counts.groupBy((F.col("pair") % base).alias("b")).agg(F.max("count").alias("highest"))
    kept = counts.join(highest, F.col("pair") % base == F.col("b"))
    return settle(kept.select("pair", "count", (F.col("count") == F.col("highest")).cast("int").alias("best")))


def link_measures(texts: DataFrame, counts: DataFrame, limit: int = BROADCAST) -> DataFrame:
    """(key, n_best, count_sum) of each distinct text."""
    each = texts.select("key", F.explode("links").alias("pair"))
    if counts.count() <= limit:
        met = each.join(F.broadcast(counts), "pair").withColumn("times", F.lit(1).cast("long"))
    else:
        met = each.groupBy("key", "pair").agg(F.count("*").alias("times")).join(counts, "pair")
    return met.groupBy("key").agg(F.sum(F.col("best") * F.col("times")).alias("n_best"), F.sum(F.col("count") * F.col("times")).alias("count_sum"))


def measure(docs: DataFrame, path_a: str, path_b: str, pattern: str, limit: int = BROADCAST) -> DataFrame:
    """Per document: n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    texts = settle(aligned(docs, path_a, path_b, pattern))
    counts = with_best(pair_counts(texts), len(pieces(path_b)[1]))
    sums = link_measures(texts, counts, limit)
    measures = settle(texts.drop("links", "n").join(sums, "key", "left"))
    numbers = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("key"))
    return keyed.join(measures, "key", "left").select("doc_id", *numbers, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
