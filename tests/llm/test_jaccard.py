import random
import re

import pytest

from tallyforge.llm import graph, jaccard
from tallyforge.llm.queries import QUERIES


def shingles(text, width):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1)))


def brute(rows, width, percent):
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    by_token = {}
    for i, s in enumerate(sets):
        for x in s:
            by_token.setdefault(x, []).append(i)
    tried = set()
    for i, s in enumerate(sets):
        for j in {j for x in s for j in by_token[x] if j < i}:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        k = find(i)
        if d is not None:
            least[k] = min(least.get(k, d), d)
    return sorted(((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def run(spark, rows, width, percent):
    df = spark.createDataFrame([(*r, "n") for r in rows], "doc_id long, text string, node string")
    return sorted((tuple(r) for r in jaccard.join_components(df.repartition(3), width, percent).collect()), key=str)


def rows_of(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randint(0, 60))
    rows, passage = [], [word() for _ in range(40)]
    for _ in range(12):
        base = [word() for _ in range(rng.choice([5, 30, 60, 120]))]
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            if rng.random() < 0.3:
                copy += passage
            rows.append(" ".join(copy))
    rows += [" ".join(passage + [word() for _ in range(8)]) for _ in range(15)]
    chain = [word() for _ in range(80)]
    for i in range(15):
        chain[i * 3] = word()
        rows.append(" ".join(chain))
    rows += ["", None, " \n", "one", "ONE", "one two", "one\x0btwo", "One two", "a b c", "a b c d", None, rows[3], rows[3].upper(), "é " * 9]
    rng.shuffle(rows)
    return [(i * 7 % 1009 if i % 23 else None, t) for i, t in enumerate(rows)] + [(5, rows[0])] * 2


@pytest.mark.parametrize(("seed", "width", "percent"), [(1, 4, 85), (2, 5, 80), (3, 2, 60)])
def test_against_brute_force(spark, seed, width, percent):
    rows = rows_of(seed)
    assert run(spark, rows, width, percent) == brute(rows, width, percent)


@pytest.mark.parametrize(("seed", "percent"), [(1, 85), (2, 80), (3, 90)])
def test_many_near_copies_of_one_text(spark, seed, percent):
    """Copies with several edits each, about half of them too far from the text in the middle."""
    rng = random.Random(seed)
    base, texts = [f"b{i}" for i in range(60)], []
    for _ in range(160):
        copy = list(texts[rng.randrange(len(texts))].split()) if texts and rng.random() < 0.3 else list(base)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(copy))
            copy[at : at + rng.randint(0, 1)] = [rng.choice(["x", "y", f"u{rng.random()}"])] * rng.randint(0, 2)
        texts.append(" ".join(copy))
    rows = list(enumerate(texts))
    want = brute(rows, 4, percent)
    assert run(spark, rows, 4, percent) == want
    assert len({w[2] for w in want}) > 1


def test_border_of_the_threshold(spark):
    w = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(w)), (2, " ".join(w[:-6])), (3, " ".join(f"v{i}" for i in range(43))), (4, " ".join(f"v{i}" for i in range(37)))]
    assert run(spark, rows, 4, 85) == brute(rows, 4, 85)


def test_folding_in_small_parts_changes_nothing(spark, monkeypatch):
    sets = [jaccard.np.sort(jaccard.np.random.default_rng(i).integers(0, 1 << 63, 50, dtype=jaccard.np.uint64)) for i in range(3)]
    for values in (sets[0], sets[0][:1], jaccard.np.arange(5, dtype=jaccard.np.uint64) << jaccard.np.uint64(20)):
        high, owner = jaccard.unpack(jaccard.pack(values))
        assert (high == values >> jaccard.np.uint64(16)).all() and (owner == (values & jaccard.np.uint64(65535)).astype(int)).all()


def test_empty(spark):
    assert run(spark, [], 4, 85) == []
    assert run(spark, [(1, None), (2, "")], 4, 85) == [(1, 0, 1), (2, 0, 2)]


def test_components(spark):
    rng = random.Random(7)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 30)] + [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(60)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {x: x for p in links for x in p}

    def find(i):
        return i if root[i] == i else find(root[i])

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    want = {x: find(x) for a, b in links for x in (a, b) if a != b}
    assert got == want


def test_query_against_brute_force(spark):
    at = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{at}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in QUERIES["op4_ngram_jaccard"](spark, at).collect()), key=str)
    assert got == brute(docs, 4, 85)
