import hashlib
import random

import numpy as np
import pytest

from tallyforge.llm import digest
from tallyforge.llm.queries import QUERIES

COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def plain(text):
    """Window by window, in whole numbers."""
    raw = text.encode()
    data = raw if len(raw) >= 5 else raw.ljust(5, b"\0")
    counts, m = [0] * 128, 0xFFFFFFFF
    for i in range(len(data) - 4):
        for s, (j, k) in enumerate(digest.TRIPLETS):
            x = (data[i] * 0x9E3779B1 + data[i + j] * 0x85EBCA6B + data[i + k] * 0xC2B2AE35 + (0x165667B1 * (s + 1))) & m
            x ^= x >> 15
            counts[(x * 0x27D4EB2F & m) >> 25] += 1
    return digest.digest(np.array(counts), raw).tobytes().hex()


def brute(rows):
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        k = len(text) // 4
        edited = text[: len(text) - k] + after[:k]
        one, new = plain(text), plain(edited)
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), one, new, digest.compare(one, new), digest.compare(one, plain(after))))
    return out


def run(spark, rows, parts):
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, slice int").repartition(parts)
    return [tuple(r) for r in digest.against_next(df).select(*COLUMNS).collect()]


@pytest.mark.parametrize("parts", [1, 5])
def test_against_windows_one_by_one(spark, parts):
    rng = random.Random(parts)
    texts = ["", None, "a", "ab", "abcd", "abcde", "é" * 3, "日本" * 40, "x" * 3000]
    texts += ["".join(rng.choice("abcdeé \n") for _ in range(rng.randint(0, 200))) for _ in range(40)]
    ids = rng.sample(range(-50, 1000), len(texts) - 1)
    rows = sorted(zip(ids, texts)) + [(None, "the row without an id")]
    assert sorted(run(spark, rows, parts), key=str) == sorted(brute(rows), key=str)


def test_lone_empty_and_repeated(spark):
    assert run(spark, [], 1) == []
    assert run(spark, [(4, "just one document here")], 1) == brute([(4, "just one document here")])
    same = run(spark, [(1, "again and again")] * 7, 3)
    assert len(same) == 7 and len({r[3] for r in same}) == 1 and all(r[6] == 1.0 for r in same)


def test_likeness_is_bounded_and_orders():
    rng = random.Random(3)
    word = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    base = [rng.choice(word) for _ in range(400)]
    near = list(base)
    near[7] = "changed"
    other = "".join(chr(rng.randint(33, 500)) for _ in range(90))
    f = digest.fingerprint
    one = f(" ".join(base))
    assert digest.compare(one, one) == 1.0
    assert 1 > digest.compare(one, f(" ".join(near))) > 0.9 > digest.compare(one, f(other)) >= 0
    assert 0 <= digest.compare("00" * 35, "ff" * 35) <= 1


def test_query_on_the_whole_table(spark):
    at = "/root/testdata/sf0.001"
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{at}/documents.parquet").collect())
    got = sorted(tuple(r) for r in QUERIES["op5_quartile_digest"](spark, at).select(*COLUMNS).collect())
    assert got == brute(rows)
    assert np.mean([r[5] > r[6] for r in got]) > 0.95
