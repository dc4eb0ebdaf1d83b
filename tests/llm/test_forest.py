import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import forest
from tallyforge.llm.queries import QUERIES


def brute(rows, k=10):
    """(query, rank, id, distance) over every usable row."""
    ok = [(i, [float(np.float32(c)) for c in v]) for i, v in rows if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    out = []
    for a, (i, v) in enumerate(ok):
        if i % 100 == 0:
            near = sorted((math.sqrt(sum((x - y) ** 2 for x, y in zip(v, w))), j) for b, (j, w) in enumerate(ok) if a != b and len(w) == len(v))[:k]
            out += [(i, r, j, d) for r, (d, j) in enumerate(near, 1)]
    return sorted(out)


def run(spark, rows, **more):
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, rank int").repartition(3)
    return sorted(tuple(r) for r in forest.nearest(df, F.col("vec_id") % 100 == 0, **more).collect())


def same(got, want):
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want])


def test_odd_vectors_ties_and_copies(spark):
    rng = random.Random(2)
    spot = [1.0, 2.0, 0.5]
    rows = [(i, spot) for i in range(0, 900, 3)] + [(i, [rng.gauss(0, 1) for _ in range(3)]) for i in range(1, 900, 3)]
    rows += [(1000, None), (1100, []), (1200, [0.0, 0.0, 0.0]), (1300, [1.0, None, 2.0]), (1400, [float("nan"), 1.0, 1.0]), (1500, [float("inf"), 0.0, 0.0])]
    rows += [(None, spot), (1600, [1.0, 2.0]), (1601, [1.5, 2.0]), (1700, [3.0]), (300, spot), (2, [1.0, 2.0, 0.75]), (5, [1.0, 2.0, 0.25])]
    same(run(spark, rows, share=1.0), brute(rows))


def test_blocks_and_chunks_change_nothing_when_all_are_measured(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, [round(rng.gauss(0, 1), 1) for _ in range(4)]) for i in range(0, 4000, 5)]
    want = brute(rows)
    monkeypatch.setattr(forest, "CHUNK", 7)
    same(run(spark, rows, share=1.0, block=150, trees=4), want)


def test_candidates_grow_to_the_wanted_number():
    x = np.random.default_rng(0).standard_normal((500, 8))
    f = forest.Forest(x, trees=6, bits=16)
    for wanted in (1, 10, 100, 499, 500, 9999):
        for i, rows in enumerate(f.candidates(x[:20], wanted)):
            assert len(rows) >= min(wanted, 500) and i in rows


def test_an_id_with_a_dozen_vectors_and_repeated_rows(spark):
    rng = random.Random(7)
    rows = [(100, [1.0 + i / 64, 1.0]) for i in range(13)] + [(100, [1.0, 1.0])] * 3 + [(i, [rng.random(), rng.random()]) for i in range(1, 60)] + [(9, [1.0, 1.0])] * 2
    got = run(spark, rows, share=1.0)
    same(got, brute(rows))
    assert len(got) == 16 * 10


def test_empty_and_few(spark):
    assert run(spark, []) == []
    assert run(spark, [(7, [1.0])]) == []
    same(run(spark, [(100, [1.0, 1.0]), (3, [1.0, 2.0])]), [(100, 1, 3, 1.0)])


def test_recall_of_the_query(spark):
    at = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{at}/embeddings.parquet").collect()]
    want, got = {}, {}
    for q, r, v, d in brute(rows):
        want.setdefault(q, set()).add(v)
    out = QUERIES["op7_prefix_forest"](spark, at).collect()
    for r in out:
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len(want[q] & got[q]) for q in want)
    assert set(got) == set(want) and hits / sum(map(len, want.values())) > 0.93
