"""Exact top-k by inner product: a three-phase uniform threshold over lists of local scores.

Vectors are scaled to integers, ``floor(scale * x)`` with x as double, and cut into ``parts`` of neighbouring
components. A node holds one part of one slice of the vectors; its list is the local score, the inner product
over that part, of each of its vectors with a query. A vector's score is the sum over the parts, so no node
knows it alone.

1. Gather: each node names its ``first`` best local scores per query, the best of each part are kept, and the
   other parts of these vectors are asked for. The (k+1)-th best whole score among them is a proven floor.
2. Cutoff: a vector that reaches the floor has a local score of at least floor / parts somewhere. The cutoff
   goes out with the query rows, and every node returns all entries that reach it. Vectors that all lists
   returned are whole already and raise the floor; the rest is dropped where what is known, plus one less than
   the cutoff for each missing part, stays below the floor.
3. Resolve: the missing local scores of what remains are asked of their nodes, and the sums are ranked.

Equal vectors are folded to one before all this, so a vector that makes up a third of the rows is one entry and
one query; of its rows the k + 1 of smallest id can be answers, and only these are carried. Slices and blocks
of queries hold at most ``SLICE`` vectors, whatever the table's size: each query block meets each slice once a
phase, which is the stated work of all queries against all rows. Nothing is broadcast or collected; between
phases tables are written to the shared folder, from which lost executors recover.

Defined cases: null vectors and those with null or non-finite components take no part; an empty vector has
score 0 with other empty ones. Vectors meet only vectors of their own length. Every row is its own: rows with
one id are queries each, and candidates of each other, and repeated rows count as often as they are there. A
row without id is a candidate and comes last in a tie. Scaled components beyond 2**31 are held there, and so
are local scores beyond 2**59; with at most eight parts no sum leaves a long. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import workers_import_here
from tallyforge.session import settle

#: Most vectors of a slice, and most queries of a block.
SLICE = 8192
#: Scaled components and local scores are held within these sizes, so that no sum leaves a long.
MOST, HELD = 1 << 31, 1 << 59
_REPLY = "query long, vector long, part int, local long"


def scaled(vector: Column, scale: int) -> Column:
    """Components as integers; null where the vector is null or holds a null or non-finite component."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    whole = F.transform(vector, lambda x: F.floor(F.least(F.greatest(F.lit(float(scale)) * x.cast("double"), F.lit(float(-MOST))), F.lit(float(MOST)))).cast("long"))
    return F.when(~F.exists(vector, odd), whole)


def folded(rows: DataFrame, keep: int) -> DataFrame:
    """Distinct vectors: (vector, components, least, asked, members), the ``keep`` rows of smallest id each."""
    order = Window.partitionBy("components").orderBy(F.col("vec_id").asc_nulls_last(), "row")
    first = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)
    members = first.groupBy("components").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "row"))).alias("members"))
    asked = rows.where("is_query").select("components").distinct().withColumn("asked", F.lit(True))
    out = members.join(asked, "components", "left")
    return settle(out.select(F.monotonically_increasing_id().alias("vector"), "components", F.col("members")[0]["vec_id"].alias("least"), F.coalesce("asked", F.lit(False)).alias("asked"), "members"))


def _matrices(table: pa.Table, kinds: np.ndarray, kind: int):
    """(whole length, positions, matrix of this part) per length of the whole vectors, for the rows of one kind."""
    at = np.flatnonzero(kinds == kind)
    lists = table.column("components").combine_chunks().take(pa.array(at))
    sizes, widths = np.asarray(lists.value_lengths()), np.asarray(table.column("width"))[at]
    flat, starts = np.asarray(lists.flatten()), np.concatenate([[0], np.cumsum(sizes)])
    for n in np.unique(widths):
        own = np.flatnonzero(widths == n)
        yield int(n), at[own], flat[starts[own][:, None] + np.arange(sizes[own[0]])[None, :]]


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products; doubles do where no sum can pass 2**53."""
    peak = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if peak < 2.0**53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return np.clip(q.astype(object) @ x.astype(object).T, -HELD, HELD).astype(np.int64)


def _reply(queries, vectors, part, local) -> pa.Table:
    n = len(queries)
    return pa.table({"query": pa.array(queries, pa.int64()), "vector": pa.array(vectors, pa.int64()), "part": pa.array(np.full(n, part), pa.int32()), "local": pa.array(local, pa.int64())})


def _listing(first: int | None):
    """A node's task: the ``first`` best entries a query, or (None) all that reach the query's cutoff."""

    def work(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        kinds, ids = np.asarray(table.column("kind")), np.asarray(table.column("id"))
        cut = np.asarray(table.column("cutoff").fill_null(0))
        rows = {n: (at, x) for n, at, x in _matrices(table, kinds, 0)}
        out = [[], [], []]
        for n, asked, q in _matrices(table, kinds, 1):
            if n not in rows:
                continue
            at, x = rows[n]
            for a in range(0, len(asked), 512):
                got = _products(q[a : a + 512], x)
                some = asked[a : a + 512]
                if first is None:
                    i, j = np.nonzero(got >= cut[some][:, None])
                else:
                    m = min(first, len(at))
                    j = np.argpartition(got, len(at) - m, axis=1)[:, len(at) - m :].ravel()
                    i = np.repeat(np.arange(len(some)), m)
                for held, new in zip(out, (ids[some[i]], ids[at[j]], got[i, j])):
                    held.append(new)
        return _reply(*[np.concatenate(o) if o else np.empty(0, np.int64) for o in out[:2]], key[2].as_py(), np.concatenate(out[2]) if out[2] else np.empty(0, np.int64))

    return work


def _asking(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """A node's task: local scores of the (query, vector) pairs it is asked for."""
    kinds, ids, other = (np.asarray(table.column(c).fill_null(-1)) for c in ("kind", "id", "cutoff"))
    pairs = np.flatnonzero(kinds == 2)
    out = _reply([], [], 0, [])
    if len(pairs):
        rows = {n: (ids[at], x) for n, at, x in _matrices(table, kinds, 0)}
        found = []
        for n, at, q in _matrices(table, kinds, 1):
            if n not in rows:
                continue
            names, x = rows[n]
            qo, xo = np.argsort(ids[at]), np.argsort(names)
            qi, xi = ids[at][qo], names[xo]
            own = pairs[np.isin(ids[pairs], qi) & np.isin(other[pairs], xi)]
            a, b = qo[np.searchsorted(qi, ids[own])], xo[np.searchsorted(xi, other[own])]
            for s in range(0, len(own), 65536):
                u, v = q[a[s : s + 65536]], x[b[s : s + 65536]]
                peak = float(np.abs(u).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(1, n)
                sums = np.einsum("ij,ij->i", u, v) if peak < HELD else np.array([_products(u[i : i + 1], v[i : i + 1])[0, 0] for i in range(len(u))], np.int64)
                found.append(_reply(ids[own[s : s + 65536]], other[own[s : s + 65536]], key[2].as_py(), sums))
        out = pa.concat_tables(found) if found else out
    return out


class Nodes:
    """The slices and parts of the distinct vectors, and the blocks of the asked ones."""

    def __init__(self, vectors: DataFrame, parts: int, size: int):
        self.parts = parts
        total = vectors.agg(F.count("*").alias("n"), F.count_if("asked").alias("q")).first()
        self.slices, self.blocks = -(-total.n // size) or 1, -(-total.q // size) or 1
        cut = lambda p: F.floor(p * F.size("components") / F.lit(parts)).cast("int")
        spread = vectors.withColumn("part", F.explode(F.array(*[F.lit(p) for p in range(parts)])))
        piece = F.slice("components", cut(F.col("part")) + 1, cut(F.col("part") + 1) - cut(F.col("part")))
        self.lists = spread.select("vector", "asked", "part", F.size("components").alias("width"), piece.alias("components"))

    def place(self, column: str, number: int) -> Column:
        return F.pmod(F.xxhash64(F.col(column)), F.lit(number)).cast("int")

    def ask(self, work, cutoffs: DataFrame | None = None, pairs: DataFrame | None = None) -> DataFrame:
        """Run ``work`` in every (block, slice, part); ``pairs`` are (query, vector, part) to be scored."""
        empty = F.lit(None).cast("long").alias("cutoff")
        rows = self.lists.select(F.lit(0).alias("kind"), F.col("vector").alias("id"), "width", "components", "part", self.place("vector", self.slices).alias("slice"), F.explode(F.sequence(F.lit(0), F.lit(self.blocks - 1))).alias("block"), empty)
        asked = self.lists.where("asked")
        if cutoffs is None:
            asked = asked.withColumn("cutoff", F.lit(None).cast("long"))
        else:
            asked = asked.join(cutoffs, F.col("vector") == F.col("query"))
        asked = asked.select(F.lit(1).alias("kind"), F.col("vector").alias("id"), "width", "components", "part", F.explode(F.sequence(F.lit(0), F.lit(self.slices - 1))).alias("slice"), self.place("vector", self.blocks).alias("block"), "cutoff")
        frame = rows.unionByName(asked)
        if pairs is not None:
            frame = frame.unionByName(pairs.select(F.lit(2).alias("kind"), F.col("query").alias("id"), F.lit(-1).alias("width"), F.array().cast("array<long>").alias("components"), "part", self.place("vector", self.slices).alias("slice"), self.place("query", self.blocks).alias("block"), F.col("vector").alias("cutoff")))
        return frame.groupBy("block", "slice", "part").applyInArrow(work, _REPLY)


def _sums(entries: DataFrame) -> DataFrame:
    """What is known of each (query, vector): the parts' bits and the sum of their local scores."""
    once = entries.groupBy("query", "vector", "part").agg(F.max("local").alias("local"))
    return once.groupBy("query", "vector").agg(F.bit_or(F.expr("shiftleft(1, part)")).alias("known"), F.count("*").cast("int").alias("n_known"), F.sum("local").alias("score"))


def _missing(sums: DataFrame, parts: int) -> DataFrame:
    """One row for each part that a (query, vector) still lacks."""
    every = sums.withColumn("part", F.explode(F.array(*[F.lit(p) for p in range(parts)])))
    return every.where(F.expr("(shiftright(known, part) & 1) = 0")).select("query", "vector", "part")


def _floor(whole: DataFrame, wanted: int) -> DataFrame:
    """The ``wanted``-th best whole score of each query, null where there are fewer."""
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vector")
    return whole.withColumn("place", F.row_number().over(best)).where(F.col("place") <= wanted).groupBy("query").agg(F.when(F.count("*") == wanted, F.min("score")).alias("floor"))


def top_vectors(vectors: DataFrame, wanted: int, parts: int = 2, first: int = 32, size: int = SLICE) -> DataFrame:
    """(query, vector, score): every distinct vector that may be among the ``wanted`` best of an asked one."""
    nodes = Nodes(vectors, parts, size)
    best = Window.partitionBy("query", "part").orderBy(F.desc("local"), "vector")
    lists = nodes.ask(_listing(max(first, wanted)))
    gathered = settle(lists.withColumn("place", F.row_number().over(best)).where(F.col("place") <= max(first, wanted)).drop("place"))
    asked = nodes.ask(_asking, pairs=_missing(_sums(gathered), parts))
    seen = settle(_sums(gathered.unionByName(asked)).select("query", "vector", "score"))

    # With fewer whole scores than wanted there is no floor: the least cutoff returns every entry.
    cutoff = F.coalesce(F.expr(f"floor div {parts}") - 1, F.lit(-2 * HELD))
    floors = settle(_floor(seen, wanted).withColumn("cutoff", cutoff))
    sent = settle(nodes.ask(_listing(None), cutoffs=floors.select("query", "cutoff")))
    sums = _sums(sent)
    own = seen.withColumn("known", F.lit((1 << parts) - 1)).withColumn("n_known", F.lit(parts))
    whole = sums.where(F.col("n_known") == parts).unionByName(own).groupBy("query", "vector").agg(F.max("score").alias("score"))
    raised = settle(_floor(whole, wanted).join(floors.select("query", "cutoff"), "query"))
    most = F.col("score") + (parts - F.col("n_known")) * (F.col("cutoff") - 1)
    remaining = sums.where(F.col("n_known") < parts).join(raised, "query").where(F.col("floor").isNull() | (most >= F.col("floor")))
    remaining = settle(remaining.join(seen.select("query", "vector"), ["query", "vector"], "left_anti").select("query", "vector", "known", "score"))
    resolved = nodes.ask(_asking, pairs=_missing(remaining, parts)).groupBy("query", "vector").agg(F.sum("local").alias("more"))
    resolved = remaining.join(resolved, ["query", "vector"]).select("query", "vector", (F.col("score") + F.col("more")).alias("score"))
    every = whole.unionByName(resolved).join(raised.select("query", "floor"), "query")
    return every.where(F.col("floor").isNull() | (F.col("score") >= F.col("floor"))).select("query", "vector", "score")


def top_k(df: DataFrame, is_query: Column, k: int = 5, scale: int = 256, column: str = "embedding", **options: int) -> DataFrame:
    """The ``k`` best rows of each row of ``is_query``: query_id, rank, vec_id, score.

    ``options``: ``parts`` of the components, ``first`` entries gathered a list, ``size`` of a slice.
    """
    workers_import_here(df.sparkSession)
    rows = df.select("vec_id", F.coalesce(is_query, F.lit(False)).alias("is_query"), scaled(F.col(column), scale).alias("components")).where(F.col("components").isNotNull())
    rows = settle(rows.withColumn("row", F.monotonically_increasing_id()))
    vectors = folded(rows, k + 1)
    near = top_vectors(vectors.select("vector", "components", "asked"), k + 1, **options)
    names = vectors.select("vector", "least", "members")
    few = Window.partitionBy("query").orderBy(F.desc("score"), F.col("least").asc_nulls_last(), "vector")
    near = near.join(names, "vector").withColumn("place", F.row_number().over(few)).where(F.col("place") <= k + 1)
    near = near.select("query", "score", F.inline("members"))
    few = Window.partitionBy("query").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    near = near.withColumn("place", F.row_number().over(few)).where(F.col("place") <= k + 1)
    answers = near.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "row", "score"))).alias("answers"))
    asked = rows.where("is_query").join(vectors.where("asked").select("components", F.col("vector").alias("query")), "components")
    own = asked.select(F.col("vec_id").alias("query_id"), F.col("row").alias("own"), "query").join(answers, "query")
    kept = F.slice(F.filter("answers", lambda a: a["row"] != F.col("own")), 1, k)
    return own.select("query_id", F.posexplode(kept).alias("at", "a")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("a.vec_id").alias("vec_id"), F.col("a.score").alias("score"))
