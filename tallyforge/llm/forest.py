"""Approximate nearest neighbours with a hash-prefix forest.

Each tree gives every vector a long hash string: the signs of its projections on random directions, the
cut of each being the block's median. The strings of a tree are one sorted array. A search descends in
every tree to the longest prefix that any string shares with the query's, then goes up in all trees at
once, a bit at a time, until the strings under the prefixes reached name enough different vectors. These
are measured exactly on the original vectors.

Vectors are dealt into blocks of bounded size by a hash, each with a forest of its own; each chunk of
queries meets every block, and only the nearest of each block are merged. Candidates are a share of the
block, so recall stays as it is whatever the number of rows. Random data of 64 dimensions has nearest
neighbours hardly nearer than the rest; the default share is set for those, and may be lower elsewhere.

Equal vectors are one entry with its rows of smallest id (as many as can be asked for), so a vector that a third
of the rows share is hashed once. Equal query vectors are one search.

Defined cases: vectors that are null, empty, zero, or hold a null or a non-finite component take no part,
nor do rows without id; vectors of different length are never compared; only the query's own row is no
candidate, other rows of its id and repeated rows are; each row of a query's id is a query of its own; fewer
candidates than ``k`` give fewer rows. Ties go to the smaller id. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import workers_import_here
from tallyforge.session import settle

TREES, BITS = 128, 24
BLOCK, CHUNK = 8192, 4096
#: Candidates of a search, as a share of the block and at least.
SHARE, LEAST = 0.5, 256

_FOUND = pa.schema([("q1", pa.int64()), ("q2", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64()), ("score", pa.float64())])


class Forest:
    def __init__(self, vectors: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = 1):
        self.x, self.bits = vectors, bits
        rng = np.random.default_rng(seed)
        weight = np.uint64(1) << np.arange(bits, dtype=np.uint64)[::-1]
        self.trees = []
        for _ in range(trees):
            plane = rng.standard_normal((vectors.shape[1], bits))
            side = vectors @ plane
            cut = np.median(side, axis=0)
            key = (side > cut) @ weight
            order = np.argsort(key, kind="stable")
            self.trees.append((plane, cut, weight, key[order], order))

    def _ranges(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of each query's prefix range: (length of the prefix, tree, query)."""
        shape = (self.bits + 1, len(self.trees), len(queries))
        begin, end = np.empty(shape, np.int32), np.empty(shape, np.int32)
        for t, (plane, cut, weight, keys, _) in enumerate(self.trees):
            own = (queries @ plane > cut) @ weight
            for length in range(self.bits + 1):
                shift = np.uint64(self.bits - length)
                low = own >> shift << shift
                begin[length, t] = np.searchsorted(keys, low)
                end[length, t] = np.searchsorted(keys, low + (np.uint64(1) << shift))
        return begin, end

    def candidates(self, queries: np.ndarray, wanted: int) -> Iterator[np.ndarray]:
        """Rows to measure for each query: at least ``wanted`` different ones, if there are as many."""
        begin, end = self._ranges(queries)
        sums = (end - begin).sum(1)
        everyone = min(wanted, len(self.x))
        for i in range(len(queries)):
            # sums count a row once for each tree, so no longer prefix than this can do
            length = int(np.flatnonzero(sums[:, i] >= everyone)[-1])
            while True:
                seen = np.zeros(len(self.x), bool)
                for t, (_, _, _, _, order) in enumerate(self.trees):
                    seen[order[begin[length, t, i] : end[length, t, i]]] = True
                if length == 0 or seen.sum() >= everyone:
                    break
                length -= 1
            yield np.flatnonzero(seen)


def usable(vector: Column) -> Column:
    """Neither null, empty nor zero, all components finite."""
    real = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & real & F.exists(vector, lambda v: v != 0), F.lit(False))


def _searched(key: tuple, entries: pa.Table, queries: pa.Table, k: int, share: float, trees: int, bits: int) -> pa.Table:
    if not len(entries) or not len(queries):
        return _FOUND.empty_table()
    dim = entries.column("dim")[0].as_py()
    matrix = lambda t, c: np.asarray(t.column(c).combine_chunks().flatten(), np.float64).reshape(-1, dim)
    # a fixed order: the forest must not depend on how rows arrive
    order = np.lexsort((entries.column("h2").to_numpy(), entries.column("h1").to_numpy()))
    x = matrix(entries, "vector")[order]
    members = [[(m["vec_id"], m["row"]) for m in entries.column("members")[i].as_py()] for i in order.tolist()]
    wanted = matrix(queries, "q_vector")
    q1, q2 = queries.column("q_h1").to_numpy(), queries.column("q_h2").to_numpy()
    forest = Forest(x, trees, bits)
    out: list[tuple] = []
    size = max(LEAST, int(share * len(x)))
    for start in range(0, len(wanted), 256):
        part = wanted[start : start + 256]
        for i, near in enumerate(forest.candidates(part, size), start):
            distance = np.sqrt(((x[near] - wanted[i]) ** 2).sum(1))
            if len(near) > k:
                close = distance <= np.partition(distance, k)[k]
                near, distance = near[close], distance[close]
            named = sorted((d, *m) for d, r in zip(distance.tolist(), near.tolist()) for m in members[r])[: k + 1]
            out += [(int(q1[i]), int(q2[i]), v, row, d) for d, v, row in named]
    columns = list(zip(*out))
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND)


def nearest(
    rows: DataFrame,
    is_query: Column,
    k: int = 10,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    share: float = SHARE,
    block: int = BLOCK,
    trees: int = TREES,
    bits: int = BITS,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found for each row for which ``is_query`` holds."""
    spark = rows.sparkSession
    workers_import_here(spark)
    flagged = rows.where(usable(F.col(vector)) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks")
    )
    # every row is a candidate and may be a query of its own, also one of several with one id; equal vectors are one entry
    numbered = flagged.select("*", F.size("vector").alias("dim"), F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(5), "vector").alias("h2"), F.monotonically_increasing_id().alias("row"))
    hashed = settle(numbered)
    lists = hashed.drop("vector")
    least = Window.partitionBy("h1", "h2", "dim").orderBy("vec_id", "row")
    few = lists.withColumn("_at", F.row_number().over(least)).where(F.col("_at") <= k + 1)
    entries = few.groupBy("h1", "h2", "dim").agg(F.sort_array(F.collect_list(F.struct("vec_id", "row"))).alias("members"))
    asked = lists.where("asks").select("h1", "h2", "dim").distinct()
    # the first of its rows lends each entry its vector
    lent = entries.select(F.col("members")[0]["row"].alias("_row"), "members")
    stored = settle(hashed.join(lent, F.col("row") == F.col("_row")).select("h1", "h2", "dim", "members", "vector"))
    sizes = {r["dim"]: r["n"] for r in stored.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    asks = {r["dim"]: r["n"] for r in asked.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    kinds = "dim int, blocks int, parts int"
    plan = F.broadcast(spark.createDataFrame([(d, -(-n // block), -(-asks[d] // CHUNK)) for d, n in sizes.items() if d in asks], kinds))
    dealt = lambda of: F.pmod(F.xxhash64(F.lit(of), "h1", "h2"), F.col("blocks" if of == 1 else "parts")).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    left = stored.join(plan, "dim").withColumn("block", dealt(1)).withColumn("part", every("parts")).drop("blocks", "parts")
    # columns of their own: both sides come from one stored table
    queries = stored.select(*[F.col(c).alias(c) for c in ("h1", "h2", "dim", "vector")]).join(asked, ["h1", "h2", "dim"]).join(plan, "dim")
    right = queries.withColumn("part", dealt(2)).withColumn("block", every("blocks")).drop("blocks", "parts")
    right = right.select(*[F.col(c).alias(f"q_{c}") for c in ("h1", "h2", "dim", "vector", "block", "part")])
    keys = ["dim", "block", "part"]

    def search(key: tuple, entries_: pa.Table, queries_: pa.Table) -> pa.Table:
        return _searched(key, entries_, queries_, k, share, trees, bits)

    found = left.groupBy(*keys).cogroup(right.groupBy(*[f"q_{c}" for c in keys])).applyInArrow(search, "q1 bigint, q2 bigint, vec_id bigint, row bigint, score double")
    nearest_ = Window.partitionBy("q1", "q2").orderBy("score", "vec_id", "row")
    best = found.withColumn("_at", F.row_number().over(nearest_)).where(F.col("_at") <= k + 1)
    ids = lists.where("asks").select(F.col("vec_id").alias("query_id"), F.col("row").alias("own"), F.col("h1").alias("q1"), F.col("h2").alias("q2"))
    others = ids.join(best, ["q1", "q2"]).where("row <> own")
    ranked = others.withColumn("rank", F.row_number().over(Window.partitionBy("own").orderBy("score", "vec_id", "row")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
