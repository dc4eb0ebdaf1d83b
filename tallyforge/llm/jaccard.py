"""N-gram Jaccard join with adaptive multi-match prefixes, and the components of its links.

Two documents link when their sets of word shingles are alike enough. Copies of one set are one node. All
tokens have one global order, rare ones first. A link needs ``t`` shared tokens, ``t`` being the least share
of the smaller possible union; so of a set of ``n`` tokens the first ``n - t + l`` hold at least ``l`` tokens of
any partner's corresponding prefix. Each document chooses its own ``l`` by estimated cost: a longer prefix
reads more postings, but needs more matches before a pair is verified.

1. *Who can link at all.* A token that no other set has cannot be shared, so only sets with at least ``t``
   tokens found elsewhere stay. Tasks fold their own documents' tokens first (a token that is frequent in
   the task leaves it once), send sorted packed runs to the task of each hash range, and get back counts.
   Tokens are cut to 48 bits here, which can only keep a set that might have gone.
2. *Prefixes.* The sets that stay are read again, once per distinct set, and counted exactly.
3. *Stars.* In the postings of each prefix token every set is paired with one pivot, the set most like
   the others. Pairs with the smaller ``l`` of matches are verified; so a large group of near copies is
   joined in as many steps as it has members.
4. *The rest.* Two alike sets that are still in different groups met some pivot together, and at least one
   of them, a straggler, is not alike to it. ``differences`` shows that then both differ from the pivot in
   common tokens. Few sets differ from a pivot in a given token, so stragglers meet the others there, and
   such pairs are verified as before. Sets of one group need no further pair, and no link between groups
   is left out.

Defined cases: a null or wordless text has no token and links with nothing; repeated rows link with each
other; a null id never is a component's name: a component without any other id has null. Empty tables give
empty results; only id and text are read, so extra columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import chunks, workers_import_here
from tallyforge.llm.graph import components
from tallyforge.llm.shingles import shingle_sets
from tallyforge.session import settle

#: Tokens a task folds at a time, and tokens aimed at for one hash range.
FOLD, RANGE_TOKENS = 500_000, 1_000_000
LONGEST_MATCH = 8
#: Characters that are hashed at a time.
AT_ONCE = 300_000
#: Cost of one verification, in postings read.
VERIFY = 20.0

_PACKED = pa.schema(
    [("range", pa.int32()), ("kind", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int32()), ("node", pa.int64()), ("text_key", pa.int64()), ("digest", pa.binary()), ("known", pa.int32()), ("tokens", pa.binary()), ("owners", pa.binary())]
)
_PACKED_DDL = "range int, kind int, doc_id bigint, n int, node bigint, text_key bigint, digest binary, known int, tokens binary, owners binary"
_SEEN_DDL = "kind int, doc_id bigint, n int, node bigint, text_key bigint, digest binary, known int, nodes binary, counts binary"


def least_shared(n: Column, percent: int) -> Column:
    """Tokens that a set of ``n`` shares with any partner at least."""
    return F.ceil(F.lit(percent) * n / F.lit(100)).cast("int")


def _digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _node(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def pack(values: np.ndarray) -> bytes:
    """Sorted 48-bit numbers with a 16-bit owner below them: gaps in 32 bits, if they fit."""
    high = values >> np.uint64(16)
    gaps = np.diff(high)
    if len(gaps) and gaps.max() >= 1 << 32:
        return b"w" + values.tobytes()
    return b"g" + int(high[0]).to_bytes(8, "little") + gaps.astype("<u4").tobytes() + (values & np.uint64(0xFFFF)).astype("<u2").tobytes()


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(48-bit numbers, owners)."""
    if data[:1] == b"w":
        values = np.frombuffer(data, np.uint64, offset=1)
        return values >> np.uint64(16), (values & np.uint64(0xFFFF)).astype(np.int64)
    n = (len(data) - 9 - 2) // 6 + 1
    high = np.empty(n, np.uint64)
    high[0] = int.from_bytes(data[1:9], "little")
    high[1:] = np.frombuffer(data, "<u4", n - 1, 9)
    return np.cumsum(high, dtype=np.uint64), np.frombuffer(data, "<u2", n, 9 + 4 * (n - 1)).astype(np.int64)


def _folded(batches: Iterator[pa.RecordBatch], width: int, ranges: int) -> Iterator[pa.RecordBatch]:
    """Rows of the documents (kind 0) and packed tokens by hash range (kind 1)."""
    rows: list[dict] = []
    sets: dict[bytes, tuple[int, np.ndarray]] = {}
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal rows, sets, held
        keys = list(sets)
        known = np.zeros(len(keys) + 1, np.int64)
        if held:
            values = np.concatenate([(s >> np.uint64(16) << np.uint64(16)) | np.uint64(i + 1) for i, (_, s) in enumerate(sets.values())])
            values.sort()
            high = values >> np.uint64(16)
            first = np.concatenate([[True], high[1:] != high[:-1]])
            group = np.cumsum(first) - 1
            several = np.bincount(group)[group] > 1
            known = np.bincount((values[several] & np.uint64(0xFFFF)).astype(np.int64), minlength=len(keys) + 1)
            # one entry of owner 0 tells the others about a token that is frequent here
            values = np.where(several, high << np.uint64(16), values)[first]
            place = ((values >> np.uint64(40)) * np.uint64(ranges) >> np.uint64(24)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(place, prepend=-1, append=ranges))
            owner_nodes = np.array([0] + [_node(k) for k in keys], np.int64)
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                part = values[a:b]
                own, back = np.unique(part & np.uint64(0xFFFF), return_inverse=True)
                part = (part >> np.uint64(16) << np.uint64(16)) | back.astype(np.uint64)
                blob = {"range": int(place[a]), "kind": 1, "tokens": pack(part), "owners": owner_nodes[own.astype(np.int64)].tobytes()}
                yield pa.RecordBatch.from_pylist([blob], schema=_PACKED)
        number = {k: i + 1 for i, k in enumerate(keys)}
        for row in rows:
            row["known"] = int(known[number[row["digest"]]]) if row["n"] else 0
            row["range"] = row["node"] % ranges
        for k in range(0, len(rows), 5000):
            yield pa.RecordBatch.from_pylist(rows[k : k + 5000], schema=_PACKED)
        rows, sets, held = [], {}, 0

    for batch in chunks(batches, "text", AT_ONCE):
        ids, keys = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        for doc_id, text_key, tokens in zip(ids, keys, shingle_sets(batch.column(1).to_pylist(), width)):
            digest = _digest(tokens)
            rows.append({"kind": 0, "doc_id": doc_id, "n": len(tokens), "node": _node(digest), "text_key": text_key, "digest": digest})
            if len(tokens) and digest not in sets:
                sets[digest] = (len(tokens), tokens)
                held += len(tokens)
            if held >= FOLD or len(sets) >= 65000 or len(rows) >= 200_000:
                yield from flush()
    if rows:
        yield from flush()


def _met(table: pa.Table, groups: int) -> pa.Table:
    """In one hash range: how many tokens of each set others have too, packed by group of sets.

    Rows of documents pass. Kind 1 has the group as node.
    """
    kind = table.column("kind").to_numpy()
    docs = table.filter(pa.array(kind == 0)).select(["kind", "doc_id", "n", "node", "text_key", "digest", "known"])
    docs = docs.append_column("nodes", pa.nulls(len(docs), pa.binary())).append_column("counts", pa.nulls(len(docs), pa.binary()))
    packed = table.filter(pa.array(kind == 1))
    tokens, owners = [], []
    for data, nodes in zip(packed.column("tokens"), packed.column("owners")):
        value, place = unpack(data.as_py())
        tokens.append(value)
        owners.append(np.frombuffer(nodes.as_py(), np.int64)[place])
    if not tokens:
        return docs
    token, owner = np.concatenate(tokens), np.concatenate(owners)
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    same = token[1:] == token[:-1]
    shared = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    nodes, counts = np.unique(owner[shared & (owner != 0)], return_counts=True)
    group = nodes % groups
    order = np.argsort(group, kind="stable")
    group, nodes, counts = group[order], nodes[order], counts[order].astype(np.int32)
    cuts = np.flatnonzero(np.diff(group, prepend=-1, append=groups))
    spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
    n = len(spans)
    counted = pa.table(
        {
            "kind": pa.array(np.ones(n, np.int32)), "doc_id": pa.nulls(n, pa.int64()), "n": pa.nulls(n, pa.int32()),
            "node": pa.array([int(group[a]) for a, _ in spans], pa.int64()), "text_key": pa.nulls(n, pa.int64()),
            "digest": pa.nulls(n, pa.binary()), "known": pa.nulls(n, pa.int32()),
            "nodes": pa.array([nodes[a:b].tobytes() for a, b in spans], pa.binary()), "counts": pa.array([counts[a:b].tobytes() for a, b in spans], pa.binary()),
        }
    )
    return pa.concat_tables([docs, counted])


def _summed(table: pa.Table) -> pa.Table:
    """Of one group of sets: the counts of all hash ranges together."""
    nodes = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in table.column("nodes")])
    counts = np.concatenate([np.frombuffer(x.as_py(), np.int32) for x in table.column("counts")])
    own, back = np.unique(nodes, return_inverse=True)
    return pa.table({"_node": pa.array(own), "_elsewhere": pa.array(np.bincount(back, counts).astype(np.int64))})


def _tokens(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    kinds = pa.schema([("node", pa.int64()), ("n", pa.int32()), ("tokens", pa.list_(pa.int64()))])
    for batch in chunks(batches, "text", AT_ONCE):
        sets = list(shingle_sets(batch.column(0).to_pylist(), width))
        rows = [pa.array([_node(_digest(s)) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int32()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(rows, schema=kinds)


def document_sets(docs: DataFrame, width: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored: a row per document (kind 0: doc_id, n, node, text_key, digest, known) and packed counts (kind 1)."""
    spark = docs.sparkSession
    workers_import_here(spark)
    own = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_key"))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // (6 * RANGE_TOKENS) + 1)
    packed = own.mapInArrow(lambda batches: _folded(batches, width, ranges), _PACKED_DDL)
    groups = ranges // 8 + 1
    return settle(packed.groupBy("range").applyInArrow(lambda table: _met(table, groups), _SEEN_DDL))


def linkable(docs: DataFrame, seen: DataFrame, width: int, percent: int, doc_id: str, text: str) -> DataFrame:
    """Stored: (node, n, t, shared): each distinct set that may link, with its tokens that others have, rare first."""
    elsewhere = seen.where("kind = 1").groupBy("node").applyInArrow(_summed, "_node bigint, _elsewhere bigint")
    rows = seen.where("kind = 0 and n > 0").join(elsewhere, F.col("node") == F.col("_node"), "left")
    stay = rows.where(F.col("known") + F.coalesce("_elsewhere", F.lit(0)) >= least_shared(F.col("n"), percent))
    chosen = stay.groupBy("node").agg(F.min(F.struct("doc_id", "text_key")).alias("_one")).select("_one.doc_id", "_one.text_key")
    texts = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).withColumn("text_key", F.xxhash64("text"))
    wanted = chosen.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    read = texts.join(wanted, (F.col("text_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").select("text")
    sets = settle(read.mapInArrow(lambda batches: _tokens(batches, width), "node bigint, n int, tokens array<bigint>").dropDuplicates(["node"]))
    single = sets.select("node", "n", F.explode("tokens").alias("token"))
    counted = single.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    shared = (
        single.join(counted, "token")
        .groupBy("node", "n")
        .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("shared"))
        .withColumn("t", least_shared(F.col("n"), percent))
    )
    return settle(shared.where(F.size("shared") >= F.col("t")))


def prefixes(sets: DataFrame) -> DataFrame:
    """Stored: ``sets`` with l, the matches a set asks for, prefix, its prefix tokens, and central.

    ``shared`` leaves out the tokens only this set has; they come first in the order and match nothing,
    so of the prefix of ``n - t + l`` tokens the first ``size(shared) - t + l`` shared ones count.
    ``central`` is high for sets whose tokens most others have.
    """
    spare = F.size("shared") - F.col("t")

    def cost(match: Column) -> Column:
        read = F.aggregate(F.slice("shared", F.lit(1), spare + match), F.lit(0.0), lambda s, x: s + x["df"] - 1)
        return F.struct((read + F.lit(VERIFY) * read / match).alias("cost"), match.alias("l"))

    choices = F.transform(F.sequence(F.lit(1), F.least(F.lit(LONGEST_MATCH), F.col("t"))), cost)
    chosen = sets.withColumn("l", F.array_min(choices)["l"])
    prefix = F.transform(F.slice("shared", F.lit(1), spare + F.col("l")), lambda x: x["token"])
    central = F.aggregate("shared", F.lit(0.0), lambda s, x: s + x["df"]) / F.col("n")
    return settle(chosen.select("node", "n", "l", prefix.alias("prefix"), F.col("shared.token").alias("tokens"), central.alias("central")))


def close_in_size(a: Column, b: Column, percent: int) -> Column:
    return F.lit(100) * F.least(a, b) >= F.lit(percent) * F.greatest(a, b)


def alike(both: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    return F.lit(100) * both >= F.lit(percent) * (n_a + n_b - both)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are alike enough; only pairs with the matches both ask for are compared."""
    left, right = (sets.select(*[F.col(c).alias(f"{c}_{side}") for c in ("node", "n", "l", "prefix", "tokens")]) for side in "ab")
    both = pairs.join(left, F.col("a") == F.col("node_a")).join(right, F.col("b") == F.col("node_b"))
    matched = F.size(F.array_intersect("prefix_a", "prefix_b")) >= F.least("l_a", "l_b")
    held = both.where(close_in_size(F.col("n_a"), F.col("n_b"), percent) & matched)
    return held.where(alike(F.size(F.array_intersect("tokens_a", "tokens_b")), F.col("n_a"), F.col("n_b"), percent)).select("a", "b")


def differences(met: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(pivot, node, part, straggler, token) by which sets in different groups around a pivot can meet.

    Around a pivot ``p`` take a straggler ``x``, not alike to ``p``, and any ``y`` alike to ``x``. With
    ``Dx`` the tokens in which ``x`` and ``p`` differ, and f the share (100 - percent) / (100 + percent):
    ``|Dx| > f (nx + np)`` and ``|Dx| + |Dy| - 2 |Dx & Dy| <= f (nx + ny)``, so ``x`` and ``y`` share more
    than ``(|Dy| + f (np - ny)) / 2`` of these tokens: about half of those of ``y``. A token of any so
    many fewer ones of ``y``, rare first, is among them; for ``x`` all count. Tokens that ``y`` alone has
    match nothing and go first; those that ``p`` alone has are in every difference and are left out.
    If nothing is asked of ``y``, it meets every straggler of the pivot by the token null.
    """
    pivot, other = (sets.select(*[F.col(c).alias(f"{c}_{side}") for c in ("node", "n", "tokens")]) for side in "pq")
    both = met.join(pivot, F.col("pivot") == F.col("node_p")).join(other, F.col("node") == F.col("node_q"))
    own_p, own_q = F.col("n_p") - F.size("tokens_p"), F.col("n_q") - F.size("tokens_q")
    # gained tokens before lost ones: what few sets around the pivot have comes first
    parted = both.select(
        "pivot", "node", "part", "straggler", F.concat(F.array_except("tokens_q", "tokens_p"), F.array_except("tokens_p", "tokens_q")).alias("_d"),
        own_p.alias("_own_p"), own_q.alias("_own_q"), "n_p", "n_q",
    )
    size = F.size("_d") + F.col("_own_q")
    asked = F.floor((F.lit(100 + percent) * (size - F.col("_own_p")) + F.lit(100 - percent) * (F.col("n_p") - F.col("n_q"))) / F.lit(2 * (100 + percent))) + 1
    taken = (size - asked + 1 - F.col("_own_q")).cast("int")
    nothing = F.array(F.lit(None).cast("bigint"))
    some = F.when(asked <= 0, nothing).when(taken <= 0, F.array().cast("array<bigint>")).otherwise(F.slice("_d", F.lit(1), F.greatest(taken, F.lit(0))))
    sent = parted.select(
        "pivot", "node", F.col("n_q").alias("n"), "part",
        F.explode(F.concat(F.transform(some, lambda t: F.struct(F.lit(False).alias("asks"), t.alias("token"))), F.when(F.col("straggler"), F.transform(F.concat("_d", nothing), lambda t: F.struct(F.lit(True).alias("asks"), t.alias("token")))).otherwise(F.array().cast("array<struct<asks:boolean,token:bigint>>")))).alias("_x"),
    )
    return sent.select("pivot", "node", "n", "part", "_x.asks", "_x.token")


def links(sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect exactly the sets that the similarity connects."""
    sets = prefixes(sets)
    postings = sets.select(F.explode("prefix").alias("token"), "node", "central")
    pivots = postings.groupBy("token").agg(F.max(F.struct("central", "node")).alias("_p"), F.count("*").alias("_c")).where("_c > 1")
    stars = settle(
        postings.join(pivots, "token").where(F.col("node") != F.col("_p.node")).select(F.col("_p.node").alias("pivot"), "node").distinct()
    )
    first = settle(verified(stars.select(F.col("pivot").alias("a"), F.col("node").alias("b")), sets, percent))
    groups = settle(components(first))
    of = lambda c: groups.select(F.col("node").alias(f"_{c}"), F.col("component").alias(f"_{c}_part"))
    parted = (
        stars.join(of("pivot"), F.col("pivot") == F.col("_pivot"), "left")
        .join(of("node"), F.col("node") == F.col("_node"), "left")
        .select("pivot", "node", F.coalesce("_node_part", "node").alias("part"), F.coalesce("_pivot_part", "pivot").alias("_main"))
        .withColumn("straggler", F.col("part") != F.col("_main"))
    )
    several = parted.groupBy("pivot").agg(F.count("*").alias("_n"), F.max("straggler").alias("_any")).where("_n > 1 and _any").select(F.col("pivot").alias("_open"))
    met = settle(parted.join(several, F.col("pivot") == F.col("_open"), "left_semi").select("pivot", "node", "part", "straggler"))
    sent = settle(differences(met, sets, percent))
    x = sent.where("asks").select(*[F.col(c).alias(f"x_{c}") for c in ("pivot", "token", "node", "n", "part")])
    y = sent.where("not asks")
    together = (F.col("pivot") == F.col("x_pivot")) & F.col("token").eqNullSafe(F.col("x_token")) & (F.col("part") != F.col("x_part"))
    pairs = x.join(y, together & close_in_size(F.col("n"), F.col("x_n"), percent)).select(F.least("x_node", "node").alias("a"), F.greatest("x_node", "node").alias("b")).distinct()
    return first.unionByName(settle(verified(pairs, sets, percent)))


def grouped_rows(docs: DataFrame, width: int, percent: int, doc_id: str, text: str) -> DataFrame:
    """A row per row of ``docs``: doc_id, text_key, n, part (null without words) and least, the part's smallest id."""
    seen = document_sets(docs, width, doc_id, text)
    parts = components(links(linkable(docs, seen, width, percent, doc_id, text), percent)).select(F.col("node").alias("_node"), "component")
    own = seen.where("kind = 0").select("doc_id", "text_key", "n", "node")
    nodes = own.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("_first"))
    named = settle(nodes.join(parts, F.col("node") == F.col("_node"), "left").select("node", "_first", F.coalesce("component", "node").alias("part")))
    least = named.groupBy("part").agg(F.min("_first").alias("least"))
    labels = named.join(least, "part").select(F.col("node").alias("_node"), "part", "least")
    full = own.where("n > 0").join(labels, F.col("node") == F.col("_node")).select("doc_id", "text_key", "n", "part", "least")
    bare = own.where("n = 0").select("doc_id", "text_key", "n", F.lit(None).cast("bigint").alias("part"), F.col("doc_id").alias("least"))
    return full.unionByName(bare)


def join_components(docs: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    rows = grouped_rows(docs, width, percent, doc_id, text)
    return rows.select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), F.col("least").alias("component_id"))


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (null last), then of the least other columns.

    Rows without words are in no component and stay. The rows to drop are found on ids and hashes of the
    texts; the texts themselves are only looked through once more.
    """
    rows = settle(grouped_rows(docs, width, percent, doc_id, text).where("n > 0"))
    chosen = rows.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("_c")).select(F.col("part").alias("_part"), F.col("_c.doc_id").alias("_id"), F.col("_c.text_key").alias("_key"))
    placed = rows.join(chosen, F.col("part") == F.col("_part"))
    stays = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    lost = placed.where(~stays).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    again = placed.where(stays).groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    keyed = docs.withColumns({"_row_id": F.col(doc_id).cast("bigint"), "_text_key": F.xxhash64(text)})
    same = F.col("_text_key").eqNullSafe(F.col("_key")) & F.col("_row_id").eqNullSafe(F.col("_id"))
    kept = keyed.join(lost, same, "left_anti")
    first = Window.partitionBy("_row_id", "_text_key").orderBy(*[F.col(c) for c in docs.columns])
    once = kept.join(again, same, "left_semi").withColumn("_at", F.row_number().over(first)).where("_at = 1")
    return kept.join(again, same, "left_anti").unionByName(once.drop("_at")).select(*docs.columns)
