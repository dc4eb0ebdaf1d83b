import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from tallyforge.operators import boosting
from tallyforge.operators.boosting import Settings

NAMES = ["a", "b", "c"]


def rows(n, seed=0):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = rng.random(), float(rng.randint(0, 4)), rng.gauss(0, 1)
        out.append((f"R{i}", a, b if rng.random() > 0.05 else None, c if rng.random() > 0.05 else float("nan"), int(a + 0.2 * b + 0.1 * c + rng.random() > 1.6)))
    return out


def frame(spark, data, parts=3):
    return spark.createDataFrame(data, "id string, a double, b double, c double, y int").repartition(parts)


def plain(data, edges, settings):
    """Trees by recursion over lists of rows, all rows and columns in every round."""
    y = [r[4] for r in data]
    weight = [sum(1 - v for v in y) / max(1, sum(y)) if v else 1.0 for v in y]
    x = [[math.inf if v is None or v != v else v for v in r[1:4]] for r in data]
    margin, nodes = [0.0] * len(data), []
    for number in range(settings.rounds):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        g = [round((p[i] - y[i]) * weight[i] * boosting.UNIT) / boosting.UNIT for i in range(len(y))]
        h = [round(p[i] * (1 - p[i]) * weight[i] * boosting.UNIT) / boosting.UNIT for i in range(len(y))]

        def score(some):
            return sum(g[i] for i in some) ** 2 / (sum(h[i] for i in some) + settings.l2)

        def grow(node, some, depth):
            best = (0.0, None, None)
            if depth < settings.depth:
                for f in range(3):
                    for cut in edges[f]:
                        left = [i for i in some if x[i][f] <= cut]
                        right = [i for i in some if x[i][f] > cut]
                        if min(sum(h[i] for i in left), sum(h[i] for i in right)) >= settings.least_curvature:
                            gain = (score(left) + score(right) - score(some)) / 2
                            if gain > best[0] + 1e-12:
                                best = (gain, f, cut)
            gain, f, cut = best
            if f is None:
                value = -settings.rate * sum(g[i] for i in some) / (sum(h[i] for i in some) + settings.l2)
                nodes.append((number, node, -1, 0.0, value))
                for i in some:
                    moves[i] = value
            else:
                nodes.append((number, node, f, cut, 0.0))
                grow(2 * node, [i for i in some if x[i][f] <= cut], depth + 1)
                grow(2 * node + 1, [i for i in some if x[i][f] > cut], depth + 1)

        moves = [0.0] * len(data)
        grow(1, list(range(len(data))), 0)
        margin = [m + v for m, v in zip(margin, moves)]
    return sorted(nodes), margin


def test_trees_match_a_plain_version(spark):
    data, settings = rows(250), Settings(rounds=4, depth=3, rate=0.3, rows=1.0, columns=1.0)
    df = frame(spark, data)
    fitted = boosting.fit(df, NAMES, "y", "id", settings)
    want, margin = plain(data, boosting.cuts(df, NAMES), settings)
    got = [(r.tree, r.node, r.feature, r.cut, r.value) for r in fitted.nodes.itertuples()]
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert [g[4] for g in got] == pytest.approx([w[4] for w in want], abs=1e-12)
    scored = {r.id: r.m for r in df.select("id", fitted.margin().alias("m")).collect()}
    assert [scored[r[0]] for r in data] == pytest.approx(margin, abs=1e-12)


def test_both_ways_give_the_same_trees(spark):
    data, settings = rows(600, 1), Settings(rounds=5, depth=4, least_curvature=1.0)
    one = boosting.fit(frame(spark, data, 1), NAMES, "y", "id", settings)
    many = boosting.fit(frame(spark, data[::-1], 5), NAMES, "y", "id", settings, one_task=0, store_every=2)
    assert one.nodes.equals(many.nodes) and len(one.nodes) > 30
    assert one.nodes.groupby("tree").feature.apply(lambda f: set(f[f >= 0])).map(len).max() <= 2  # columns of a tree


def test_cuts_are_ranks(spark):
    df = spark.createDataFrame([(float(i), 1.0, None if i % 2 else 5.0) for i in range(1000)], "a double, b double, c double")
    a, b, c = boosting.cuts(df, NAMES, 4)
    assert a == [249.0, 499.0, 749.0] and b == [] and c == []


def test_odd_labels_and_constant_features(spark):
    for label in (0, 1):
        df = spark.createDataFrame([(f"R{i}", 1.0, 2.0, None, label) for i in range(30)], "id string, a double, b double, c double, y int")
        fitted = boosting.fit(df, NAMES, "y", "id", Settings(rounds=2))
        assert (fitted.nodes.feature == -1).all() and fitted.importance() == [(n, 0.0) for n in NAMES]
    with pytest.raises(ValueError):
        boosting.fit(df.limit(0), NAMES, "y", "id")


def test_save_and_load(spark, tmp_path):
    df = frame(spark, rows(300, 2))
    fitted = boosting.fit(df, NAMES, "y", "id", Settings(rounds=3))
    fitted.save(spark, str(tmp_path / "m"))
    again = boosting.Booster.load(spark, str(tmp_path / "m"))
    assert again.features == NAMES and again.nodes.equals(fitted.nodes)
    x = np.array([[0.1, np.nan, 0.2], [0.9, 4.0, 1.0]])
    assert (again.margins(x) == fitted.margins(x)).all()
    shares = dict(again.importance())
    assert sum(shares.values()) == pytest.approx(1) and shares["a"] > shares["c"]


def test_root_gains_are_those_of_the_fit(spark):
    df = frame(spark, rows(400, 3))
    settings = Settings(rounds=1, depth=1, rows=1.0, columns=1.0)
    edges = boosting.cuts(df, NAMES, 16)
    gains = boosting.root_gains(df, NAMES, "y", edges, settings)
    best = gains.orderBy(F.desc("gain")).first()
    full = boosting.root_gains(df, NAMES, "y", boosting.cuts(df, NAMES), settings).orderBy(F.desc("gain")).first()
    root = boosting.fit(df, NAMES, "y", "id", settings).nodes.iloc[0]
    assert (NAMES[int(root.feature)], root.cut) == (full.feature, full.cut) and root.gain == pytest.approx(full.gain)
    assert best.gain <= full.gain + 1e-9 and gains.count() == sum(map(len, edges))


def test_tasks_at_work_together_give_the_same_trees(spark):
    data, settings = rows(600, 1), Settings(rounds=5, depth=4, least_curvature=1.0)
    one = boosting.fit(frame(spark, data, 1), NAMES, "y", "id", settings)
    many = boosting.fit(frame(spark, data[::-1], 5), NAMES, "y", "id", settings, one_task=0, tasks=3)
    jobs = boosting.fit(frame(spark, data[::-1], 5), NAMES, "y", "id", settings, one_task=0, store_every=2, tasks=0)
    idle = boosting.fit(frame(spark, data[:2], 1), NAMES, "y", "id", settings, one_task=0, tasks=4)  # tasks without rows
    assert one.nodes.equals(many.nodes) and one.nodes.equals(jobs.nodes) and len(one.nodes) > 30
    assert set(idle.nodes.node) == {1}
    assert boosting.slots(spark) == 4


def test_no_fit_waits_for_a_barrier(spark, monkeypatch):
    """On a cluster every exchange of a barrier stage takes a second, so levels must not meet in one."""
    flags, plain_map = [], DataFrame.mapInArrow
    monkeypatch.setattr(DataFrame, "mapInArrow", lambda df, f, schema, barrier=False, **k: (flags.append(barrier), plain_map(df, f, schema, barrier, **k))[1])
    settings = Settings(rounds=5, depth=4, least_curvature=1.0)
    one = boosting.fit(frame(spark, rows(600, 1), 1), NAMES, "y", "id", settings)
    many = boosting.fit(frame(spark, rows(600, 1), 5), NAMES, "y", "id", settings, one_task=0, store_every=2)
    assert flags and not any(flags) and one.nodes.equals(many.nodes)


def test_only_the_smaller_child_is_counted():
    """Later levels ask for half of the open nodes, the last level's leaves for none."""
    settings = Settings(rounds=1, depth=3, rows=1.0, columns=1.0, least_curvature=0.0)
    rng = np.random.default_rng(0)
    bins, label = rng.integers(0, 8, (500, 3)).astype(np.uint8), rng.integers(0, 2, 500).astype(float)
    table = {"key": np.arange(500), "label": label, "weight": np.ones(500), "bins": [b.tobytes() for b in bins], "margin": np.zeros(500)}
    block, tree, asked = boosting.Block(pa.table(table), settings, 3), boosting.Tree(0, settings, 3), []
    block.begin(0, tree.columns)
    while tree.open:
        asked.append((len(tree.open), len(tree.wanted)))
        block.descend(tree.level(block.histogram(tree.wanted)))
    assert asked == [(1, 1), (2, 1), (4, 2)] and len(tree.leaves) == 7  # one node stays whole
    g, h = boosting.gradients(np.zeros(500), label, np.ones(500))
    for leaf, value in tree.leaves.items():
        here = block.node == leaf
        assert value == pytest.approx(-settings.rate * g[here].sum() / (h[here].sum() + settings.l2 * boosting.UNIT), abs=1e-12)


def test_rows_that_one_task_is_faster_with_need_no_job_a_level(spark, monkeypatch):
    """A quarter of a million rows, as many as orders of some hundredths of a GB give."""
    monkeypatch.setattr(boosting, "_by_levels", lambda *a: pytest.fail("a job for each level"))
    df = spark.range(250_000).select(F.concat(F.lit("R"), "id").alias("id"), *[(F.xxhash64("id", F.lit(n)) % 1000 / 7.0).alias(n) for n in NAMES], (F.col("id") % 9 == 0).cast("int").alias("y"))
    fitted = boosting.fit(df, NAMES, "y", "id", Settings(rounds=1, depth=2))
    assert set(fitted.nodes.tree) == {0}


@pytest.mark.parametrize("attempts", [5, 0])
def test_a_fit_outlives_lost_blocks(spark, monkeypatch, attempts):
    """Blocks lie in files of the executors; if they vanish, blocks are packed anew, or persisted by Spark."""
    import glob
    import shutil
    import tempfile

    pattern = f"{tempfile.gettempdir()}/tallyforge-fit-*"
    data, settings, others = rows(600, 1), Settings(rounds=5, depth=4, least_curvature=1.0), set(glob.glob(pattern))
    one = boosting.fit(frame(spark, data, 1), NAMES, "y", "id", settings)
    calls, plain_level, lost = [], boosting.Tree.level, {3, 9}

    def level(tree, hist):
        calls.append(tree.number)
        if len(calls) in lost:
            homes = set(glob.glob(pattern)) - others
            assert homes or attempts == 0
            for home in homes:
                shutil.rmtree(home)
        return plain_level(tree, hist)

    monkeypatch.setattr(boosting.Tree, "level", level)
    monkeypatch.setattr(boosting, "ATTEMPTS", attempts)
    many = boosting.fit(frame(spark, data[::-1], 5), NAMES, "y", "id", settings, one_task=0, tasks=3, store_every=2)
    assert one.nodes.equals(many.nodes) and set(glob.glob(pattern)) <= others
    assert len(calls) > len({(r.tree, int(r.node).bit_length()) for r in one.nodes.itertuples() if r.feature >= 0})


def test_a_level_moves_no_rows(spark, monkeypatch):
    """A level's tasks get folders' names from Spark; the blocks themselves stay where they are."""
    from pyspark import RDD

    kinds, plain_map = [], RDD.map
    monkeypatch.setattr(RDD, "map", lambda rdd, f, *a, **k: (kinds.append(f), plain_map(rdd, f, *a, **k))[1])
    boosting.fit(frame(spark, rows(300, 1), 5), NAMES, "y", "id", Settings(rounds=2, depth=2), one_task=0, tasks=2)
    assert len([f for f in kinds if isinstance(f, boosting._LevelOf)]) >= 2


def test_features_counted_together_give_each_ones_sums():
    sizes = [256, 11, 3, 2, 200, 24]
    assert sorted(f for group in boosting.bundles(sizes) for f in group) == list(range(6)) and len(boosting.bundles(sizes)) < 6
    rng = np.random.default_rng(5)
    bins = np.column_stack([rng.integers(0, n, 800) for n in sizes]).astype(np.uint8)
    table = pa.table({"key": np.arange(800), "label": rng.integers(0, 2, 800).astype(float), "weight": np.ones(800), "bins": [b.tobytes() for b in bins], "margin": rng.normal(size=800)})
    one, together = boosting.Block(table, Settings(), 6), boosting.Block(table, Settings(), 6, sizes)
    for block in (one, together):
        block.begin(0, np.array([1, 2, 4, 5]))
    assert (one.histogram([1]) == together.histogram([1])).all() and one.histogram([1]).any()
    for block in (one, together):
        block.descend({1: (4, 100), 2: (1, 5)})
    for nodes in ([3], [4, 3]):
        assert (one.histogram(nodes) == together.histogram(nodes)).all() and one.histogram(nodes).any()
