import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import topk
from tallyforge.llm.queries import QUERIES


def product(v, w, parts=2):
    cuts = [p * len(v) // parts for p in range(parts + 1)]
    return sum(max(-topk.HELD, min(topk.HELD, sum(x * y for x, y in zip(v[a:b], w[a:b])))) for a, b in zip(cuts, cuts[1:]))


def brute(rows, k=5, scale=256, step=50):
    """(query id, rank, id, score) with every row on its own."""
    ok = []
    for i, v in rows:
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            ok.append((i, [max(-topk.MOST, min(topk.MOST, math.floor(scale * float(np.float32(c))))) for c in v]))
    out = []
    for a, (i, v) in enumerate(ok):
        if i is None or i % step:
            continue
        near = [(-product(v, w), j is None, j or 0, j) for b, (j, w) in enumerate(ok) if a != b and len(w) == len(v)]
        near.sort(key=lambda n: n[:3])
        out += [(i, r, j, -s) for r, (s, _, _, j) in enumerate(near[:k], 1)]
    return sorted(out, key=str)


def run(spark, rows, **more):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, rank int, query long").repartition(3)
    return sorted((tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0, **more).collect()), key=str)


ODD = [(100, None), (150, []), (151, []), (200, [0.0, 0.0, 0.0]), (250, [1.0, None, 2.0]), (300, [float("nan"), 1.0, 1.0]), (350, [float("inf"), 0.0, 0.0])]
ODD += [(400, [1.0]), (401, [2.0]), (402, [-3.5]), (450, [1.0, 2.0])]


@pytest.mark.parametrize("options", [{}, {"size": 40, "first": 6}, {"size": 90, "parts": 3, "first": 1}, {"parts": 1}])
def test_ties_copies_lengths_and_odd_vectors(spark, options):
    rng = random.Random(5)
    spot = [1.0, 2.0, 0.5]
    rows = [(i, spot) for i in range(500, 700, 2)] + [(i, [float(rng.randint(-2, 2)) for _ in range(3)]) for i in range(501, 700, 2)]
    rows += [*ODD, (None, spot), (None, [9.0, 9.0, 9.0]), (550, spot), (550, [0.5, 0.25, 2.0]), (550, [0.5, 0.25, 2.0]), (13, [2.0, 2.0, 2.0]), (13, [2.0, 2.0, 2.0])]
    assert run(spark, rows, **options) == brute(rows)


def test_an_id_with_a_dozen_vectors(spark):
    rng = random.Random(6)
    rows = [(50, [1.0 + i / 64, 1.0]) for i in range(13)] + [(i, [rng.random(), rng.random()]) for i in range(1, 40)]
    got = run(spark, rows)
    assert got == brute(rows) and len(got) == 13 * 5


def test_negative_scores_and_very_large_components(spark):
    rows = [(i, [-1.0 - i, 0.5, 2.0]) for i in range(8)] + [(i, [3e38, -3e38, 1.0]) for i in (100, 101)] + [(150, [8e6, -8e6, 1e6])]
    assert run(spark, rows) == brute(rows)


def test_empty_and_few(spark):
    assert run(spark, []) == []
    assert run(spark, [(50, [1.0])]) == []
    assert run(spark, [(1, [1.0]), (2, [1.0])]) == []
    assert run(spark, [(50, [1.0, 1.0]), (3, [1.0, 2.0])]) == [(50, 1, 3, 65536 * 3)]


def test_cutoffs_send_few_entries_and_lose_none(spark):
    """Entries that pass the cutoff are a small share of all pairs, on vectors in random directions."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.standard_normal(16)]) for i in range(2000)]
    assert run(spark, rows, size=600) == brute(rows)


def test_query_reads_the_whole_table(spark):
    at = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{at}/embeddings.parquet").collect()]
    got = sorted((tuple(r) for r in QUERIES["op12_exact_topk"](spark, at).collect()), key=str)
    assert got == brute(rows)
