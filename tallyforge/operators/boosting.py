"""Boosted trees with second-order gains over binned features.

Every feature is cut at up to ``BINS - 1`` of its own values, equally many rows apart; rows become one stored
matrix of bytes with label and key. A round draws rows by a hash of key and round and columns by a hash of the
round, sums gradient and curvature of the logistic loss per (node, feature, bin), and splits each node of a level
where half of ``G_l**2 / (H_l + l2) + G_r**2 / (H_r + l2) - G**2 / (H + l2)`` is largest. A leaf is
``-rate * G / (H + l2)``.

Gradients are whole multiples of 2**-24, so their sums are exact and trees do not depend on how rows are dealt.
Of two children only the one with less curvature is counted, the other is its parent less that; the last level's
leaves take their sums from the level above. There are two ways to fit with one result. Up to ``ONE_TASK`` rows
one task holds the matrix and goes through all rounds. Beyond it the rows are packed into blocks, one a task; every
level is one job, whose tasks make histograms of their blocks (nodes x features x bins, whatever the number of rows) and
only their sum comes to the driver. A block lies in files in the temp folder of the executor that packed it, so a level
maps what it needs instead of moving the block between Spark and Python; persisted are only the folders' names, which
also draws tasks to the right executor. A task that does not find its block as the round needs it (an executor was
lost, or a task went elsewhere) says so, and the driver has all blocks packed anew from the stored matrix and taken
through the trees so far. If blocks are missing again and again, Spark persists them and each level moves them whole,
which is four times slower. A fit removes its files when it ends. (A barrier stage would need no jobs, but on a cluster each
of its exchanges waits for a whole second.)

Features of few bins are counted together, as one of the product of their bins, and added up for each feature after.

A value at a cut goes left. Missing values go to the last bin. Ties of gain go to the first feature, then bin.
"""

from __future__ import annotations

import contextlib
import json
import os
import pickle
import shutil
import tempfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.session import settle

BINS = 256
#: Up to so many rows (a matrix of 54 MB) one task is through all rounds before jobs for each level would be.
ONE_TASK = 1_000_000
STORE_EVERY = 20
BLOCK_ROWS = 1_000_000
#: Features are counted together up to so many combinations of their bins.
TOGETHER = 4096
#: So often blocks may be missing and are packed anew.
ATTEMPTS = 5
#: Gradients are held as multiples of 1 / UNIT.
UNIT = float(1 << 24)
_NODES = "tree int, node int, feature int, cut double, gain double, cover double, value double"
_MATRIX = "key long, label double, weight double, bins binary, margin double"


@dataclass(frozen=True)
class Settings:
    rounds: int = 400
    depth: int = 5
    rate: float = 0.06
    rows: float = 0.9
    columns: float = 0.8
    l2: float = 1.5
    least_curvature: float = 2.0
    seed: int = 42


class Booster:
    """Split nodes and leaves of all trees; node n has the children 2n and 2n + 1."""

    def __init__(self, features: list[str], nodes: pd.DataFrame):
        kinds = {"tree": "int32", "node": "int32", "feature": "int32"}
        self.features, self.nodes = list(features), nodes.astype(kinds).sort_values(["tree", "node"], ignore_index=True)
        self._margins = None

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of rows of features."""
        self._margins = self._margins or Subtrees(self, lambda tree, leaves: {0: tree.reached(leaves)}, 1)
        return self._margins.sums(x)[:, 0]

    def margin(self) -> Column:
        """The same as a column over the feature columns, one Arrow batch at a time."""
        self.margins(np.zeros((0, len(self.features))))  # the tables go to the tasks ready
        sums = self._margins.sums

        @F.pandas_udf("double")
        def of(*columns: pd.Series) -> pd.Series:
            return pd.Series(sums(np.column_stack([c.to_numpy(dtype=float) for c in columns]))[:, 0])

        return of(*[F.col(c).cast("double") for c in self.features])

    def importance(self) -> list[tuple[str, float]]:
        """Mean gain of each feature's splits, as shares."""
        splits = self.nodes[self.nodes["feature"] >= 0].groupby("feature")["gain"].mean()
        total = float(splits.sum()) or 1.0
        return [(name, float(splits.get(i, 0.0)) / total) for i, name in enumerate(self.features)]

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.nodes, _NODES).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame([(json.dumps(self.features),)], "features string").coalesce(1).write.mode("overwrite").text(f"{path}/features")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Booster:
        features = json.loads(spark.read.text(f"{path}/features").first()[0])
        return Booster(features, spark.read.schema(_NODES).parquet(f"{path}/nodes").toPandas())


# ------------------------------------------------------------- sums over all leaves of rows ---
#: A subtree has at most so many levels of tests below its root.
LEVELS = 3
_ROWS_AT_ONCE = 8192


@dataclass(frozen=True)
class Leaf:
    """A leaf's value and its path: (test, whether to the right, feature, share of curvature kept)."""

    value: float
    path: list[tuple[int, bool, int, float]]


class Subtree:
    """A subtree of few levels with the tests on the way to it; rows meet its tests in 2**tests ways."""

    def __init__(self, n_tests: int):
        self.ways = np.arange(1 << n_tests)

    def met(self, leaf: Leaf) -> dict[int, np.ndarray]:
        """For each feature on the leaf's path, in which ways it goes along with all its tests there."""
        out: dict[int, np.ndarray] = {}
        for test, right, feature, _ in leaf.path:
            out[feature] = out.get(feature, True) & ((self.ways >> test & 1) == right)
        return out

    def reached(self, leaves: list[Leaf]) -> np.ndarray:
        """The value that each way leads to, 0 if to a leaf elsewhere."""
        return sum(leaf.value * np.logical_and.reduce([np.ones(len(self.ways), bool), *self.met(leaf).values()]) for leaf in leaves)


class Subtrees:
    """Sums over all trees of what a row gets from each, for rows of features.

    Trees are taken apart into subtrees of ``LEVELS`` levels. ``table`` gives what the ways of meeting a subtree's tests
    bring to which of ``width`` outputs, so that a row is one comparison for each split and one look-up for each
    subtree and output. Missing values are above all cuts.
    """

    def __init__(self, booster: Booster, table: Callable[[Subtree, list[Leaf]], dict[int, np.ndarray]], width: int):
        splits = booster.nodes[booster.nodes["feature"] >= 0]
        self.cuts = [np.unique(splits.loc[splits["feature"] == i, "cut"]) for i in range(len(booster.features))]
        self.width, self.units = width, []
        for _, rows in booster.nodes.groupby("tree", sort=True):
            nodes = {r.node: r for r in rows.itertuples()}
            height: dict[int, int] = {}
            for n in sorted(nodes, reverse=True):
                height[n] = 1 + max(height[2 * n], height[2 * n + 1]) if nodes[n].feature >= 0 else 0
            todo = [(1, [], [])]
            while todo:
                at, tests, path = todo.pop()
                if height[at] <= LEVELS:
                    self.units.append(self._unit(nodes, at, tests, path, table))
                    continue
                todo += [(c, *self._below(nodes, at, c, tests, path)) for c in (2 * at + 1, 2 * at)]

    @staticmethod
    def _below(nodes: dict, at: int, child: int, tests: list[int], path: list[tuple]) -> tuple[list[int], list[tuple]]:
        kept = nodes[child].cover / nodes[at].cover if nodes[at].cover else 0.0
        tests = [*tests, at] if at not in tests else tests
        return tests, [*path, (tests.index(at), child > 2 * at, nodes[at].feature, kept)]

    def _unit(self, nodes: dict, root: int, tests: list[int], path: list[tuple], table: Callable) -> tuple:
        inner, below = [root], []
        for n in inner:
            if nodes[n].feature >= 0:
                below.append(n)
                inner += [2 * n, 2 * n + 1]
        tests = [*tests, *below]
        leaves, todo = [], [(root, path)]
        while todo:
            at, way = todo.pop()
            if nodes[at].feature < 0:
                leaves.append(Leaf(nodes[at].value, way))
            else:
                todo += [(c, self._below(nodes, at, c, tests, way)[1]) for c in (2 * at + 1, 2 * at)]
        asked = [(nodes[n].feature, int(np.searchsorted(self.cuts[nodes[n].feature], nodes[n].cut))) for n in tests]
        return asked, table(Subtree(len(tests)), leaves)

    def sums(self, x: np.ndarray) -> np.ndarray:
        """[row, output]"""
        out = np.zeros((self.width, len(x)))
        for start in range(0, len(x), _ROWS_AT_ONCE):
            part = x[start : start + _ROWS_AT_ONCE]
            part = np.where(np.isnan(part), np.inf, part)
            place = [np.searchsorted(c, part[:, i], "left").astype(np.uint16) for i, c in enumerate(self.cuts)]
            for asked, table in self.units:
                way = np.zeros(len(part), np.int64 if len(asked) > 16 else np.uint16)
                for bit, (feature, cut) in enumerate(asked):
                    way |= (place[feature] > cut).astype(way.dtype) << way.dtype.type(bit)
                way = way.astype(np.intp)
                for column, values in table.items():
                    out[column, start : start + len(part)] += values.take(way)
        return out.T


# ------------------------------------------------------------- bins ---
def cuts(df: DataFrame, features: list[str], bins: int = BINS) -> list[list[float]]:
    """Ascending cut values per feature: the values at equally spaced ranks, the largest left out.

    One aggregate of mergeable sketches, of each feature by itself so that different tasks merge them; exact up to
    100,000 rows, beyond that off by at most one rank in 100,000.
    """
    shares = [i / bins for i in range(1, bins)]
    entries = F.array(*[F.struct(F.lit(i).alias("f"), F.nanvl(F.col(f).cast("double"), F.lit(None)).alias("x")) for i, f in enumerate(features)])
    rows = df.select(F.explode(entries).alias("e")).groupBy("e.f").agg(F.percentile_approx("e.x", shares, 100_000).alias("v"), F.max("e.x").alias("most")).collect()
    found = {r["f"]: sorted({v for v in r["v"] or [] if v < r["most"]}) for r in rows}
    return [found.get(i, []) for i in range(len(features))]


def binned(df: DataFrame, features: list[str], edges: list[list[float]], label: str, weight: Column, key: Column) -> DataFrame:
    """The byte matrix: key, label, weight, one byte a feature, margin."""
    held = [np.array(e) for e in edges]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.empty((batch.num_rows, len(held)), np.uint8)
            for i, e in enumerate(held):
                x = batch.column(3 + i).to_numpy(zero_copy_only=False).astype(float)
                out[:, i] = np.searchsorted(e, np.where(np.isnan(x), np.inf, x), "left")
            width = len(held)
            packed = pa.Array.from_buffers(pa.binary(), len(out), [None, pa.py_buffer(np.arange(0, (len(out) + 1) * width, width, dtype=np.int32)), pa.py_buffer(out.tobytes())])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], packed, pa.array(np.zeros(len(out)))], ["key", "label", "weight", "bins", "margin"])

    named = df.select(key.alias("key"), F.col(label).cast("double").alias("label"), weight.cast("double").alias("weight"), *[F.col(f).cast("double") for f in features])
    return named.mapInArrow(work, _MATRIX)


# ------------------------------------------------------------- one block of rows ---
def _mixed(key: np.ndarray, salt: int) -> np.ndarray:
    """Even 64-bit hashes of keys and a salt."""
    x = key.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gradients(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the weighted logistic loss, in multiples of 1 / UNIT."""
    p = 1 / (1 + np.exp(-margin))
    return np.rint((p - label) * weight * UNIT), np.rint(np.maximum(p * (1 - p), 1e-16) * weight * UNIT)


def bundles(sizes: list[int]) -> list[list[int]]:
    """Features that are counted together: at most ``TOGETHER`` combinations, the larger features first."""
    out: list[list[int]] = []
    room: list[int] = []
    for f in sorted(range(len(sizes)), key=lambda f: (-sizes[f], f)):
        at = next((i for i, r in enumerate(room) if r >= sizes[f]), len(room))
        if at == len(room):
            out.append([])
            room.append(TOGETHER)
        out[at].append(f)
        room[at] //= sizes[f]
    return out


class Block:
    """Rows that one task holds: all of them, or a partition's, as arrays or as files mapped from a folder."""

    def __init__(self, table: pa.Table | pa.RecordBatch, settings: Settings, n_features: int, sizes: list[int] | None = None):
        get = lambda c: np.asarray(table.column(c))
        self.key, self.label, self.weight, self.margin = get("key"), get("label"), get("weight"), get("margin").copy()
        joined = b"".join(table.column("bins").to_pylist())
        self.bins = np.ascontiguousarray(np.frombuffer(joined, np.uint8).reshape(-1, n_features).T)  # one row a feature
        self.settings, self.sizes = settings, sizes or [BINS] * n_features
        self.codes = []
        for group in bundles(self.sizes):
            code = self.bins[group[0]]
            for f in group[1:]:
                code = code.astype(np.uint16) * np.uint16(self.sizes[f]) + self.bins[f]
            self.codes.append(code)
        self.node = self._roots()

    def _roots(self) -> np.ndarray:
        return np.ones(len(self.key), np.uint8 if self.settings.depth < 7 else np.int32)

    _STATIC = ("key", "label", "weight", "bins")

    def save(self, home: str, number: int) -> None:
        """All that lasts, with the margins that round ``number`` begins with."""
        for name in self._STATIC:
            _put(home, name, getattr(self, name))
        for i, code in enumerate(self.codes):
            if code.dtype != np.uint8:
                _put(home, f"code-{i}", code)
        _put(home, f"margin-{number}", self.margin)

    @classmethod
    def load(cls, home: str, settings: Settings, sizes: list[int], number: int) -> Block:
        """As ``save`` left it; no file is read before its rows are used."""
        block = cls.__new__(cls)
        block.settings, block.sizes = settings, sizes
        for name in cls._STATIC:
            setattr(block, name, _get(home, name))
        block.codes = [_get(home, f"code-{i}") if len(group) > 1 else block.bins[group[0]] for i, group in enumerate(bundles(sizes))]
        block.margin = _get(home, f"margin-{number}")
        block.node = block._roots()
        return block

    def begin(self, number: int, columns: np.ndarray) -> None:
        """Draw the rows of a round; all start at the root."""
        s = self.settings
        drawn = _mixed(self.key, s.seed * 1_000_003 + number) < np.uint64(min(int(s.rows * 2.0**64), (1 << 64) - 1))
        self.drawn, self.columns = np.flatnonzero(drawn), columns
        self.g, self.h = gradients(self.margin[self.drawn], self.label[self.drawn], self.weight[self.drawn])
        self.node = self._roots()

    def histogram(self, nodes: list[int]) -> np.ndarray:
        """[gradient or curvature, node, column, bin] sums of the drawn rows."""
        rows, place, g, h = self.drawn, None, self.g, self.h
        if nodes != [1]:  # else a round begins and all rows are there
            slot = np.full(max(nodes) + 2, -1, np.int64)
            slot[nodes] = np.arange(len(nodes))
            place = slot.take(np.minimum(self.node.take(rows), len(slot) - 1))
            some = np.flatnonzero(place >= 0)
            rows, place, g, h = rows.take(some), place.take(some), g.take(some), h.take(some)
        out = np.zeros((2, len(nodes), len(self.columns), BINS))
        drawn = {int(c): i for i, c in enumerate(self.columns)}
        for group, codes in zip(bundles(self.sizes), self.codes):
            if not any(f in drawn for f in group):
                continue
            shape = [self.sizes[f] for f in group]
            width = int(np.prod(shape))
            at = codes.take(rows).astype(np.intp)
            if place is not None:
                at += place * width
            for k, x in enumerate((g, h)):
                sums = np.bincount(at, x, len(nodes) * width).reshape(len(nodes), *shape)
                for axis, f in enumerate(group, 1):
                    if f in drawn:
                        out[k, :, drawn[f], : self.sizes[f]] = sums.sum(axis=tuple(a for a in range(1, len(shape) + 1) if a != axis))
        return out

    def descend(self, splits: dict[int, tuple[int, int]]) -> None:
        """Rows of split nodes go to a child; parents come before their children."""
        levels: dict[int, list[int]] = {}
        for node in splits:
            levels.setdefault(node.bit_length(), []).append(node)
        for _, nodes in sorted(levels.items()):
            feature, cut = np.full(max(nodes) + 2, -1, np.int64), np.zeros(max(nodes) + 2, np.uint8)
            feature[nodes], cut[nodes] = zip(*[splits[n] for n in nodes])
            at = np.minimum(self.node, len(feature) - 1)
            on = feature.take(at)
            if nodes == [1]:  # a round begins, all rows are there
                rows, value = slice(None), self.bins[splits[1][0]]
            else:
                rows = np.flatnonzero(on >= 0)
                value = self.bins.ravel().take(on.take(rows) * self.bins.shape[1] + rows)
            self.node[rows] = 2 * self.node[rows] + (value > cut[at[rows]])

    def finish(self, leaves: dict[int, float]) -> None:
        value = np.zeros(max(leaves) + 1)
        value[list(leaves)] = list(leaves.values())
        self.margin = self.margin + value[self.node]


def _put(home: str, name: str, array: np.ndarray) -> None:
    """Whole or not at all, so that a task may run again."""
    with tempfile.NamedTemporaryFile(dir=home, delete=False) as out:
        np.save(out, array)
    os.replace(out.name, f"{home}/{name}.npy")


def _get(home: str, name: str) -> np.ndarray:
    try:
        return np.load(f"{home}/{name}.npy", mmap_mode="r")
    except ValueError:  # no rows: nothing to map
        return np.load(f"{home}/{name}.npy")


# ------------------------------------------------------------- one tree ---
def best_splits(hist: np.ndarray, settings: Settings) -> list[tuple[float, int, int]]:
    """(gain, column, bin) of each node's best split; gain 0 where none is allowed."""
    g, h = hist / UNIT
    left_g, left_h = np.cumsum(g, axis=2), np.cumsum(h, axis=2)
    all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
    right_g, right_h = all_g - left_g, all_h - left_h
    score = lambda a, b: a * a / (b + settings.l2)
    gain = (score(left_g, left_h) + score(right_g, right_h) - score(all_g, all_h)) / 2
    gain[(left_h < settings.least_curvature) | (right_h < settings.least_curvature)] = 0
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(axis=1)
    return [(float(flat[i, b]), int(b) // BINS, int(b) % BINS) for i, b in enumerate(best)]


class Tree:
    """One tree as it grows level by level from histograms."""

    def __init__(self, number: int, settings: Settings, n_features: int):
        self.number, self.settings = number, settings
        order = np.argsort(_mixed(np.arange(n_features), settings.seed * 7_919 + number + 1), kind="stable")
        self.columns = np.sort(order[: max(1, int(settings.columns * n_features))])
        self.open, self.splits, self.leaves = [1], {}, {}
        self.gain, self.cover = {}, {}
        #: Nodes of which the next level needs the histogram; the others follow from their parents'.
        self.wanted, self.parents = [1], {}

    def _close(self, node: int, total_g: float, total_h: float) -> None:
        self.cover[node] = total_h / UNIT
        self.leaves[node] = -self.settings.rate * (total_g / UNIT) / (total_h / UNIT + self.settings.l2)

    def level(self, hist: np.ndarray) -> dict[int, tuple[int, int]]:
        """Split or close the open nodes, from the sums of the wanted ones; what was split."""
        s, new = self.settings, {}
        held = dict(zip(self.wanted, hist.swapaxes(0, 1)))
        for node in self.open:
            if node not in held:
                held[node] = self.parents[node >> 1] - held[node ^ 1]
        best = best_splits(np.stack([held[node] for node in self.open], axis=1), s)
        self.parents, self.wanted, opened = {}, [], []
        for node, (gain, column, cut) in zip(self.open, best):
            h = held[node]
            total_g, total_h = h[:, 0].sum(axis=1)
            if not (gain > 0 and node < 1 << s.depth):
                self._close(node, total_g, total_h)
                continue
            new[node], self.gain[node], self.cover[node] = (int(self.columns[column]), cut), gain, total_h / UNIT
            left_g, left_h = h[:, column, : cut + 1].sum(axis=1)
            if 2 * node >= 1 << s.depth:
                self._close(2 * node, left_g, left_h)
                self._close(2 * node + 1, total_g - left_g, total_h - left_h)
            else:
                self.parents[node] = h
                self.wanted.append(2 * node + int(total_h - left_h < left_h))
                opened += [2 * node, 2 * node + 1]
        self.splits |= new
        self.open = opened
        return new

    def rows(self, edges: list[list[float]]) -> list[tuple]:
        out = [(self.number, n, f, edges[f][c], self.gain[n], self.cover[n], 0.0) for n, (f, c) in self.splits.items()]
        return out + [(self.number, n, -1, 0.0, 0.0, self.cover[n], v) for n, v in self.leaves.items()]


def _all_rounds(block: Block, edges: list[list[float]], settings: Settings, together: Callable) -> Iterator[pa.RecordBatch]:
    """All trees from a block's rows; ``together`` adds up the histograms of all blocks."""
    kinds = [pa.int32(), pa.int32(), pa.int32(), *[pa.float64()] * 4]
    for number in range(settings.rounds):
        tree = Tree(number, settings, len(edges))
        block.begin(number, tree.columns)
        while tree.open:
            block.descend(tree.level(together(block.histogram(tree.wanted), tree.columns)))
        block.finish(tree.leaves)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*tree.rows(edges)), kinds)], [f.split()[0] for f in _NODES.split(", ")])


_HELD = pa.schema([("key", pa.int64()), ("label", pa.float64()), ("weight", pa.float64()), ("bins", pa.binary()), ("margin", pa.float64())])


def _in_one_task(matrix: DataFrame, edges: list[list[float]], settings: Settings) -> list[tuple]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(pa.Table.from_batches(list(batches)), settings, len(edges), [len(e) + 1 for e in edges])
        yield from _all_rounds(block, edges, settings, lambda hist, columns: hist)

    return [tuple(r) for r in matrix.coalesce(1).mapInArrow(work, _NODES).collect()]


def slots(spark: SparkSession) -> int:
    """Tasks that run at a time, as far as is known by now."""
    return max(1, spark.sparkContext.defaultParallelism // int(spark.sparkContext.getConf().get("spark.task.cpus", "1")))


class _LevelOf:
    """The wanted histograms of a block at a tree's level, None if its files are not there.

    ``last`` are the splits of the level above, ``before`` those of the last tree's lowest level, its leaves and that level.
    """

    def __init__(self, settings: Settings, sizes: list[int], tree: Tree, last: dict, before: tuple | None):
        self.settings, self.sizes, self.last, self.before = settings, sizes, last, before
        self.number, self.columns, self.wanted = tree.number, tree.columns, list(tree.wanted)

    def __call__(self, home: str) -> np.ndarray | None:
        try:
            return self._block(home).histogram(self.wanted)
        except FileNotFoundError:
            return None

    def _block(self, home: str) -> Block:
        number, level = self.number, self.wanted[0].bit_length() - 1
        load = lambda n: Block.load(home, self.settings, self.sizes, n)
        if level > 0:
            block = load(number)
            block.columns = self.columns
            block.drawn, block.g, block.h = (_get(home, f"{name}-{number}") for name in ("drawn", "g", "h"))
            if level > 1:
                block.node = np.array(_get(home, f"node-{number}-{level - 1}"))
            block.descend(self.last)
            _put(home, f"node-{number}-{level}", block.node)
            return block
        if self.before and not Path(home, f"margin-{number}.npy").exists():
            block = load(number - 1)
            splits, leaves, reached = self.before
            if reached:
                block.node = np.array(_get(home, f"node-{number - 1}-{reached}"))
            block.descend(splits)
            block.finish(leaves)
            _put(home, f"margin-{number}", block.margin)
        block = load(number)
        block.begin(number, self.columns)
        for name in ("drawn", "g", "h"):
            _put(home, f"{name}-{number}", getattr(block, name))
        for old in [Path(home, f"{name}-{number - 2}.npy") for name in ("margin", "drawn", "g", "h")] + [*Path(home).glob(f"node-{number - 2}-*.npy")]:
            old.unlink(missing_ok=True)
        return block


def _both(a: np.ndarray | None, b: np.ndarray | None) -> np.ndarray | None:
    return None if a is None or b is None else a + b


def _by_levels(matrix: DataFrame, edges: list[list[float]], settings: Settings, tasks: int, store_every: int = STORE_EVERY) -> list[tuple]:
    sizes = [len(e) + 1 for e in edges]
    used = np.arange(BINS) < np.array(sizes)[:, None]  # bins that a feature has
    grown: list[tuple[dict, dict]] = []

    def blocks(keep: Callable[[Block, int], str | bytes], kind: str):
        """Every block, taken through the trees so far, as what ``keep`` makes of it; persisted."""
        trees = list(grown)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = Block(pa.Table.from_batches(list(batches), _HELD), settings, len(edges), sizes)
            for splits, leaves in trees:
                block.node = block._roots()
                block.descend(splits)
                block.finish(leaves)
            yield pa.RecordBatch.from_arrays([pa.array([keep(block, len(trees))])], ["kept"])

        return matrix.repartition(tasks).mapInArrow(work, f"kept {kind}").rdd.map(lambda row: row.kept)

    def packed():
        """Blocks as files where their tasks run, persisted are the folders' names."""

        def keep(block: Block, number: int) -> str:
            home = tempfile.mkdtemp(prefix="tallyforge-fit-")
            block.save(home, number)
            return home

        homes = blocks(keep, "string").persist(StorageLevel.MEMORY_AND_DISK)
        homes.count()
        return homes

    def dropped(homes) -> None:
        with contextlib.suppress(Exception):
            homes.foreach(lambda home: shutil.rmtree(home, ignore_errors=True))
        homes.unpersist()

    def summed(parts, tree: Tree) -> np.ndarray | None:
        some = used[tree.columns]
        flat = parts.map(lambda hist: None if hist is None else hist[:, :, some].astype(np.int64))
        flat = flat.treeReduce(_both) if tasks > 64 else flat.reduce(_both)
        if flat is None:
            return None
        hist = np.zeros((2, len(tree.wanted), *some.shape))
        hist[:, :, some] = flat
        return hist

    def from_files() -> None:
        """Trees from the files' blocks, until all are grown or files were missing too often."""
        misses, before, homes = 0, None, packed()
        try:
            while len(grown) < settings.rounds and misses <= ATTEMPTS:
                tree = Tree(len(grown), settings, len(edges))
                last, reached = {}, 0
                while tree.open:
                    hist = summed(homes.map(_LevelOf(settings, sizes, tree, last, before)), tree)
                    if hist is None:
                        break
                    reached = tree.wanted[0].bit_length() - 1
                    last = tree.level(hist)
                if tree.open:  # some block is missing: this tree begins again
                    misses += 1
                    dropped(homes)
                    before, homes = None, packed()
                    continue
                rows.extend(tree.rows(edges))
                grown.append((tree.splits, tree.leaves))
                before = (last, tree.leaves, reached)
        finally:
            dropped(homes)

    def sums(number: int, columns: np.ndarray, splits: dict, wanted: list[int]) -> Callable[[Block], np.ndarray]:
        def work(block: Block) -> np.ndarray:
            block.begin(number, columns)
            block.descend(splits)
            return block.histogram(wanted)

        return work

    def moved(splits: dict, leaves: dict) -> Callable[[Block], Block]:
        def work(block: Block) -> Block:
            block.node = block._roots()
            block.descend(splits)
            block.finish(leaves)
            return block

        return work

    def from_persisted() -> None:
        """The trees that are still to grow, from blocks that Spark persists."""
        held, before = blocks(lambda block, _: pickle.dumps(block), "binary").map(pickle.loads).persist(StorageLevel.MEMORY_AND_DISK), None
        while len(grown) < settings.rounds:
            tree = Tree(len(grown), settings, len(edges))
            while tree.open:
                tree.level(summed(held.map(sums(tree.number, tree.columns, tree.splits, tree.wanted)), tree))
                if before is not None:
                    before = before.unpersist() and None
            rows.extend(tree.rows(edges))
            grown.append((tree.splits, tree.leaves))
            before, held = held, held.map(moved(tree.splits, tree.leaves)).persist(StorageLevel.MEMORY_AND_DISK)
            if len(grown) % store_every == 0:
                held.checkpoint()
        if before is not None:
            before.unpersist()

    rows: list[tuple] = []
    from_files()
    if len(grown) < settings.rounds:
        from_persisted()
    return rows


def fit(df: DataFrame, features: list[str], label: str, key: str, settings: Settings = Settings(), one_task: int = ONE_TASK, store_every: int = STORE_EVERY, tasks: int = 0) -> Booster:
    """Trees for a 0/1 label; positives are weighted so that both classes carry the same total.

    Beyond ``one_task`` rows every level is a job of ``tasks`` tasks; 0, the default, makes as many as run at a time, of
    ``BLOCK_ROWS`` rows at most. Blocks that Spark has to persist are checkpointed every ``store_every`` rounds.
    """
    counts = df.agg(F.count("*").alias("n"), F.greatest(F.sum(label), F.lit(1)).alias("pos"), F.greatest(F.sum(1 - F.col(label)), F.lit(1)).alias("neg")).first()
    if not counts.n:
        raise ValueError("no labelled rows to fit")
    edges = cuts(df, features)
    weight = F.when(F.col(label) == 1, float(counts.neg / counts.pos)).otherwise(1.0)
    matrix = settle(binned(df, features, edges, label, weight, F.xxhash64(key)))
    if counts.n <= one_task:
        rows = _in_one_task(matrix, edges, settings)
    else:
        rows = _by_levels(matrix, edges, settings, tasks or max(slots(df.sparkSession), -(-counts.n // BLOCK_ROWS)), store_every)
    return Booster(features, pd.DataFrame(rows, columns=[f.split()[0] for f in _NODES.split(", ")]))


# ------------------------------------------------------------- gains in SQL terms ---
def root_gains(df: DataFrame, features: list[str], label: str, edges: list[list[float]], settings: Settings = Settings()) -> DataFrame:
    """(feature, cut, left_rows, gain): what each cut of the root would bring in the first round, all rows drawn.

    The same sums as a fit's first level, as one grouped aggregate: a row counts once for each feature.
    """
    counts = df.agg(F.greatest(F.sum(label), F.lit(1)).alias("pos"), F.greatest(F.sum(1 - F.col(label)), F.lit(1)).alias("neg")).first()
    weight = F.when(F.col(label) == 1, float(counts.neg / counts.pos)).otherwise(1.0)
    g = F.rint((F.lit(0.5) - F.col(label)) * weight * UNIT).cast("long")
    h = F.rint(F.lit(0.25) * weight * UNIT).cast("long")
    entries = F.array(*[F.struct(F.lit(i).alias("f"), F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(None)), F.lit(float("inf"))).alias("x")) for i, f in enumerate(features)])
    long = df.select(g.alias("g"), h.alias("h"), F.explode(entries).alias("e"))
    held = F.array(*[F.array(*[F.lit(v) for v in e]).cast("array<double>") for e in edges])
    place = F.size(F.filter(F.element_at(held, F.col("e.f") + 1), lambda c: c < F.col("e.x")))
    bins = long.groupBy(F.col("e.f").alias("f"), place.alias("bin")).agg(F.count("*").alias("n"), F.sum("g").alias("g"), F.sum("h").alias("h"))
    # At most BINS rows a feature from here on.
    table = bins.join(F.broadcast(df.sparkSession.createDataFrame([(i, f, j, float(c)) for i, (f, e) in enumerate(zip(features, edges)) for j, c in enumerate(e)], "i int, feature string, cut_no int, cut double")), F.col("f") == F.col("i"))
    left = table.groupBy("i", "feature", "cut_no", "cut").agg(
        F.sum(F.when(F.col("bin") <= F.col("cut_no"), F.col("n")).otherwise(0)).alias("left_rows"),
        *[F.sum(F.when(F.col("bin") <= F.col("cut_no"), F.col(c)).otherwise(0)).alias(f"l{c}") for c in "gh"],
        *[F.sum(c).alias(f"a{c}") for c in "gh"],
    )
    value = lambda c: F.col(c) / F.lit(UNIT)
    score = lambda a, b: a * a / (b + F.lit(settings.l2))
    gain = (score(value("lg"), value("lh")) + score(value("ag") - value("lg"), value("ah") - value("lh")) - score(value("ag"), value("ah"))) / 2
    allowed = (value("lh") >= settings.least_curvature) & (value("ah") - value("lh") >= settings.least_curvature)
    return left.select("feature", "cut", "left_rows", F.when(allowed, gain).otherwise(0.0).alias("gain"))
