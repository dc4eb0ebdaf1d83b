import re
from collections import defaultdict
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from tallyforge.llm import mixing


def targets(sizes, weights, share, most):
    """Share out by weight, stop what is above, share the rest again."""
    names = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        got = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if got[s] > most * sizes[s]]
        if not over:
            return {**fixed, **got}
        fixed |= {s: most * sizes[s] for s in over}


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_and_cuts(spark, seed):
    rows = []
    for i in range(300):
        h = int(md5(f"{seed}-{i}".encode()).hexdigest(), 16)
        source = None if h % 11 == 0 else "a" if h % 3 == 0 else f"s{h % 7}"
        text = None if h % 29 == 0 else "\u00a0w " * (h % (5 if source == "s3" else 90))
        rows.append((i, text, source, "kept"))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, taken string")
    out = mixing.mix(df, [3, 1, 2]).collect()
    assert len(out) == len(rows)
    sums = defaultdict(int)
    for _, t, s, _ in rows:
        sums[s] += size(t)
    want = targets(sums, [3, 1, 2], 1.5, 2.0)
    took = defaultdict(int)
    for r in out:
        assert r.size == size(r.text) and r.source_size == sums[r.source] and 0 <= r.taken <= 2 * r.size
        assert r.target == pytest.approx(want[r.source])
        took[r.source] += r.taken
    for s, t in want.items():
        assert abs(took[s] - t) <= 0.5 + 1e-6
    assert sorted((r.doc_id, r.taken) for r in mixing.mix(df.repartition(7), [3, 1, 2]).collect()) == sorted((r.doc_id, r.taken) for r in out)


def test_equal_ratios(spark):
    rows = [(f"s{i}", n) for i, n in enumerate([30, 10, 20, 300, 100, 200, 3, 1, 2, 5, 5, 5])]
    df = spark.createDataFrame(rows, "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df, [3, 1, 2], 1.5, 2.0).collect()}
    want = targets({s: n for s, n in sorted(rows)}, [3, 1, 2], 1.5, 2.0)
    assert got == pytest.approx(want)


def test_repeated_rows_nulls_and_empty(spark):
    schema = "doc_id long, text string, source string"
    same = spark.createDataFrame([(1, "a b c d", "x")] * 9 + [(None, None, None)] * 2 + [(2, "", "y")], schema)
    out = mixing.mix(same, [1]).collect()
    assert len(out) == 12
    assert abs(sum(r.taken for r in out if r.source == "x") - 54) < 9
    assert all(r.taken == 0 and r.target == 0 for r in out if r.source != "x")
    assert mixing.mix(same.limit(0), [3, 1, 2]).count() == 0


def test_whole_rows(spark):
    df = spark.createDataFrame([(i, "w " * (1 + i % 9), "ab"[i % 5 == 0]) for i in range(400)], "doc_id long, text string, source string")
    mixed = mixing.mix(df, [3, 1])
    whole = mixing.repeated(mixed, df.columns)
    assert whole.columns == df.columns
    took = {r.source: r.n for r in whole.groupBy("source").agg(F.sum(mixing.words_of(F.col("text"))).alias("n")).collect()}
    for r in mixed.select("source", "target").distinct().collect():
        assert abs(took[r.source] - r.target) <= 10
