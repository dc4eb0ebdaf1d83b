"""Prior-window count, median and same-value count for users of any size.

A group is a user and a period. Every answer is a rank question over its rows in time order, and no window is ever
held. Rows with a value have a place in time and a place in value order; both orders are cut into slices of
``side`` rows, and ``before[i][j]`` counts the rows in time slices before i and value slices before j. What a window
(two places in time) holds below the start of a value slice is then known from the counts of its two end slices and
from the rows of these two slices alone; the rest of the answer lies inside one value slice.

So every question goes to two tasks and no more: first to the pair of time slices of its window's ends, where it
finds its value slice by a binary search, then to that value slice. Windows move forward with time, so at most two
pairs a slice occur. In a task, a slice is a wavelet matrix: its values bit by bit, each level's zeros first, with
running counts of zeros, in which counting below a bound and selecting by rank take one step a bit, for all
questions at once. A slice has at least ``SIDE`` rows and as many as the square root of the group's, so the counts
are never more than the rows.

A group of at most ``TASK_ROWS`` rows is one such matrix in one task: its rows move once, in the order of time, instead
of four questions a row twice.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.operators.ordering import running_totals
from tallyforge.session import settle

SIDE = 4096
TASK_ROWS = 1_000_000


class WaveletMatrix:
    """Ranks 0..n-1 in a given order, each once; all arguments and results are arrays over questions."""

    def __init__(self, ranks: np.ndarray):
        self.levels = max(1, int(len(ranks) - 1).bit_length())
        self.zeros, self.split = [], []
        for level in range(self.levels - 1, -1, -1):
            zero = (ranks >> level & 1) == 0
            self.zeros.append(np.concatenate([[0], np.cumsum(zero)]))
            self.split.append(int(zero.sum()))
            ranks = np.concatenate([ranks[zero], ranks[~zero]])

    def below(self, l: np.ndarray, r: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many of places [l, r) have a rank less than ``bound``."""
        n, count = len(self.zeros[0]) - 1, np.zeros(len(l), np.int64)
        whole = bound >= n
        code = np.where(whole, 0, bound)
        at, to = l, r
        for level, zeros, split in zip(range(self.levels - 1, -1, -1), self.zeros, self.split):
            one = (code >> level & 1) == 1
            a, b = zeros[at], zeros[to]
            count += np.where(one, b - a, 0)
            at, to = np.where(one, split + at - a, a), np.where(one, split + to - b, b)
        return np.where(whole, r - l, count)

    def select(self, l: np.ndarray, r: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The ``k``-th smallest rank (from 0) of places [l, r)."""
        found = np.zeros(len(l), np.int64)
        for level, zeros, split in zip(range(self.levels - 1, -1, -1), self.zeros, self.split):
            a, b = zeros[l], zeros[r]
            one = k >= b - a
            found |= one.astype(np.int64) << level
            k = np.where(one, k - (b - a), k)
            l, r = np.where(one, split + l - a, a), np.where(one, split + r - b, b)
        return found


# ------------------------------------------------------------- places ---
def _positions(rows: DataFrame, window_us: int) -> DataFrame:
    """Ranks by time of each row and of the first row inside its window: among all rows of the group
    (``pos``, ``start``) and among those with a value (``vpos``, ``vstart``)."""
    valued = F.col("v").isNotNull().cast("int")
    own = rows.select(
        "u", F.struct(F.col("ts").alias("k"), F.lit(1).alias("tag"), "id").alias("o"), F.lit(1).alias("w"), valued.alias("x")
    )
    opens = rows.where("own").select(
        "u", F.struct((F.col("ts") - window_us).alias("k"), F.lit(0).alias("tag"), "id").alias("o"), F.lit(0).alias("w"), F.lit(0).alias("x")
    )
    ranked = running_totals(own.unionByName(opens), ["u"], "o", {"n": F.col("w"), "m": F.col("x")})
    at = lambda tag, c: F.max(F.when(F.col("o.tag") == tag, F.col(c)))
    return ranked.groupBy("u", F.col("o.id").alias("id")).agg(
        at(1, "n_before").alias("pos"), at(0, "n_before").alias("start"), at(1, "m_before").alias("vpos"), at(0, "m_before").alias("vstart"), F.max("m_all").alias("valued")
    )


def _border(v: Column, slack: Column, up: bool) -> Column:
    """The outermost double ``p`` on one side of ``v`` for which ``abs(p - v) <= slack`` holds.

    ``v + slack`` rounds, so the border may lie some units in the last place beside it: steps of at most one
    such unit are tried, of that of the border and that of the larger of the two numbers.
    """
    near = v + slack if up else v - slack
    unit = F.lit(2.0**-53)
    tries = F.transform(
        F.sequence(F.lit(-8), F.lit(8)),
        lambda k: F.array(near + k * unit * F.abs(near), near + k * unit * F.greatest(F.abs(v), slack)),
    )
    held = F.filter(F.flatten(tries), lambda c: F.abs(c - v) <= slack)
    return F.array_max(held) if up else F.array_min(held)


def _codes(rows: DataFrame, close_abs: float, close_rel: float) -> DataFrame:
    """Per row with a value: its place in value order, and where values that are close to it begin and end."""
    slack = F.lit(close_abs) + F.abs("v") * F.lit(close_rel)
    mark = lambda k, tag: F.struct(k.alias("k"), F.lit(tag).alias("tag"), F.lit(int(tag == 1)).alias("w"))
    borders = F.array(mark(F.col("v"), 1), mark(_border(F.col("v"), slack, False), 0), mark(_border(F.col("v"), slack, True), 2))
    wanted = F.when(F.col("own"), borders).otherwise(F.array(mark(F.col("v"), 1)))
    marks = rows.where(F.col("v").isNotNull()).select("u", "id", F.explode(wanted).alias("m")).select("u", F.struct("m.k", "m.tag", "id").alias("o"), F.col("m.w").alias("w"))
    ranked = running_totals(marks, ["u"], "o", {"n": F.col("w")})
    at = lambda tag: F.max(F.when(F.col("o.tag") == tag, F.col("n_before")))
    return ranked.groupBy("u", F.col("o.id").alias("id")).agg(at(1).alias("code"), at(0).alias("code_from"), at(2).alias("code_to"), F.max(F.when(F.col("o.tag") == 1, F.col("o.k"))).alias("value"))


def _counts_before(placed: DataFrame) -> DataFrame:
    """(u, time_slice, before): for each start of a value slice, the rows below it in earlier time slices."""
    cells = placed.groupBy("u", "time_slice", "value_slice").agg(F.count("*").alias("n"), F.max("slices").alias("slices"))
    grid = cells.groupBy("u").agg(F.max("slices").alias("slices")).select("u", F.explode(F.sequence(F.lit(0), F.col("slices"))).alias("time_slice"), "slices")
    grid = grid.select("u", "time_slice", F.explode(F.sequence(F.lit(0), F.col("slices"))).alias("value_slice"))
    full = grid.join(cells.drop("slices"), ["u", "time_slice", "value_slice"], "left")
    earlier = Window.partitionBy("u", "value_slice").orderBy("time_slice").rowsBetween(Window.unboundedPreceding, -1)
    lower = Window.partitionBy("u", "time_slice").orderBy("value_slice").rowsBetween(Window.unboundedPreceding, -1)
    summed = full.withColumn("n", F.coalesce(F.sum("n").over(earlier), F.lit(0))).withColumn("n", F.coalesce(F.sum("n").over(lower), F.lit(0)))
    return summed.groupBy("u", "time_slice").agg(F.transform(F.array_sort(F.collect_list(F.struct("value_slice", "n"))), lambda s: s["n"]).alias("before"))


# ------------------------------------------------------------- the two tasks ---
def _column(table: pa.Table, name: str, rows: np.ndarray) -> np.ndarray:
    return np.asarray(table.column(name).fill_null(0))[rows]


def _local(places: np.ndarray, codes: np.ndarray) -> tuple[WaveletMatrix, np.ndarray, np.ndarray]:
    """(matrix over places in order, places, codes in order) of a slice's rows."""
    by_place = np.argsort(places)
    ordered = np.sort(codes)
    return WaveletMatrix(np.searchsorted(ordered, codes[by_place])), places[by_place], ordered


def _in_time_slices(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Value slice of each question, and what the window holds before it.

    Kinds: 0 rows of the slice of the window's end, 1 of its start, 2 and 3 the counts before them, 4 questions.
    """
    kind = np.asarray(table.column("kind"))
    ends = []
    for rows, counts in ((0, 2), (1, 3)):
        at = np.flatnonzero(kind == rows)
        matrix, places, codes = _local(_column(table, "l", at), _column(table, "want", at))
        before = np.asarray(table.column("before").combine_chunks().take(pa.array(np.flatnonzero(kind == counts))).flatten())
        ends.append((matrix, places, codes, before))
    at = np.flatnonzero(kind == 4)
    l, r, want, side, asked = (_column(table, c, at) for c in ("l", "r", "want", "side", "asked"))
    select = asked < 2

    def known(slices: np.ndarray) -> np.ndarray:
        """Rows of each window below the start of a value slice."""
        total = np.zeros(len(at), np.int64)
        for sign, place, (matrix, places, codes, before) in ((1, r, ends[0]), (-1, l, ends[1])):
            upto = np.searchsorted(places, place)
            total += sign * (before[slices] + matrix.below(np.zeros(len(at), np.int64), upto, np.searchsorted(codes, slices * side)))
        return total

    most = len(ends[0][3]) - 1
    low, high = np.zeros(len(at), np.int64), np.full(len(at), most)
    while (low < high).any():  # the last slice with at most ``want`` rows before it
        middle = (low + high + 1) // 2
        fits = known(middle) <= want
        low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
    slices = np.where(select, low, np.minimum(want // np.maximum(side, 1), most))
    below = known(slices)
    ids = table.column("id").take(pa.array(at))
    return pa.table(
        {
            "u": table.column("u").take(pa.array(at)), "id": ids, "kind": pa.array(asked.astype(np.int32)), "l": pa.array(l), "r": pa.array(r),
            "value_slice": pa.array(slices), "want": pa.array(np.where(select, want - below, want)), "known": pa.array(below),
        }
    )


def _in_value_slice(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Selected values and counts; kind -1 are the slice's rows."""
    kind = np.asarray(table.column("kind"))
    own, at = np.flatnonzero(kind == -1), np.flatnonzero(kind >= 0)
    places, codes, values = _column(table, "l", own), _column(table, "want", own), _column(table, "value", own)
    matrix, places, ordered = _local(places, codes)
    values = values[np.argsort(codes)]
    l, r = (np.searchsorted(places, _column(table, c, at)) for c in ("l", "r"))
    want, asked = _column(table, "want", at), kind[at]
    found = np.full(len(at), np.nan)
    count = np.zeros(len(at), np.int64)
    some = asked < 2
    if some.any():
        found[some] = values[matrix.select(l[some], r[some], want[some])]
    count[~some] = matrix.below(l[~some], r[~some], np.searchsorted(ordered, want[~some])) if len(own) else 0
    count += _column(table, "known", at)
    return pa.table({"id": table.column("id").take(pa.array(at)), "kind": pa.array(asked.astype(np.int32)), "found": pa.array(found), "count": pa.array(count)})


def busy_prior_window(rows: DataFrame, window_us: int, close_abs: float, close_rel: float, side: int = SIDE) -> DataFrame:
    """``rows`` (u, ts, v, id, own) to (id, n_prior, median_prior, n_same) of those that are ``own``.

    ``u`` is the group, whose other rows are only seen.
    """
    id_kind = rows.schema["id"].dataType.simpleString()
    groups = settle(rows.select("u").distinct().select(F.col("u").alias("_u"), F.monotonically_increasing_id().alias("_g")))
    rows = rows.join(groups, rows["u"] == groups["_u"]).select(F.col("_g").alias("u"), "ts", "v", "id", "own")
    placed = rows.select("u", "id", "own").join(_positions(rows, window_us), ["u", "id"]).join(_codes(rows, close_abs, close_rel), ["u", "id"], "left")
    width = F.greatest(F.lit(side), F.ceil(F.sqrt("valued"))).cast("long")
    cut = lambda c: F.floor(F.col(c) / F.col("side")).cast("long")
    placed = placed.withColumn("side", width).withColumn("slices", F.ceil(F.col("valued") / F.col("side")).cast("long"))
    placed = settle(placed.withColumns({"time_slice": cut("vpos"), "value_slice": cut("code")}))
    valued = placed.where(F.col("code").isNotNull())
    before = settle(_counts_before(valued))

    size = F.col("vpos") - F.col("vstart")
    ask = lambda kind, want: F.struct(F.lit(kind).alias("asked"), want.cast("long").alias("want"))
    near = F.array(ask(0, F.floor((size - 1) / 2)), ask(1, F.floor(size / 2)), ask(2, F.col("code_from")), ask(3, F.col("code_to")))
    asks = placed.where(F.col("own") & (size > 0)).select(
        "u", F.floor(F.col("vpos") / F.col("side")).cast("long").alias("r_slice"), F.floor(F.col("vstart") / F.col("side")).cast("long").alias("l_slice"),
        F.lit(4).alias("kind"), "id", F.col("vstart").alias("l"), F.col("vpos").alias("r"), "side", F.inline(near),
    ).where("want is not null")
    pairs = asks.select("u", "r_slice", "l_slice").distinct()
    shape = f"u long, r_slice long, l_slice long, kind int, id {id_kind}, l long, r long, side long, asked int, want long, before array<long>"
    names = [f.split()[0] for f in shape.split(", ")]
    empty = {f.split()[0]: F.lit(None).cast(f.split()[1]).alias(f.split()[0]) for f in shape.split(", ")}

    def to_pairs(frame: DataFrame, side_of: str, kind: int, **columns: Column) -> DataFrame:
        met = pairs.join(frame.withColumnRenamed("time_slice", side_of), ["u", side_of])
        given = {"u": F.col("u"), "r_slice": F.col("r_slice"), "l_slice": F.col("l_slice"), "kind": F.lit(kind), **columns}
        return met.select(*[given[n].alias(n) if n in given else empty[n] for n in names])

    elements = valued.select("u", "time_slice", "vpos", "code")
    frame = asks.select(*[F.col(n) if n in asks.columns else empty[n] for n in names])
    for kind, end in enumerate(("r_slice", "l_slice")):
        frame = frame.unionByName(to_pairs(elements, end, kind, l=F.col("vpos"), want=F.col("code")))
        frame = frame.unionByName(to_pairs(before, end, kind + 2, before=F.col("before")))
    first = frame.groupBy("u", "r_slice", "l_slice").applyInArrow(
        _in_time_slices, f"u long, id {id_kind}, kind int, l long, r long, value_slice long, want long, known long"
    )

    own = valued.select("u", F.lit(None).cast(id_kind).alias("id"), F.lit(-1).alias("kind"), F.col("vpos").alias("l"), F.lit(0).cast("long").alias("r"), "value_slice", F.col("code").alias("want"), F.lit(0).cast("long").alias("known"), "value")
    second = first.withColumn("value", F.lit(None).cast("double")).unionByName(own)
    answers = second.groupBy("u", "value_slice").applyInArrow(_in_value_slice, f"id {id_kind}, kind int, found double, count long")
    at = lambda kind, c: F.max(F.when(F.col("kind") == kind, F.col(c)))
    found = answers.groupBy("id").agg(at(0, "found").alias("lo"), at(1, "found").alias("hi"), at(2, "count").alias("below"), at(3, "count").alias("upto"))
    return placed.where("own").select("id", (F.col("pos") - F.col("start")).alias("n_prior")).join(found, "id", "left").select(
        "id",
        "n_prior",
        ((F.col("lo") + F.col("hi")) / 2).alias("median_prior"),
        F.coalesce(F.col("upto") - F.col("below"), F.lit(0)).alias("n_same"),
    )


# ------------------------------------------------------------- groups that one task holds ---
def _borders(v: np.ndarray, close_abs: float, close_rel: float, up: bool) -> np.ndarray:
    """``_border`` for an array; not a number if no tried value holds."""
    slack = close_abs + np.abs(v) * close_rel
    near = v + slack if up else v - slack
    out = np.full(len(v), np.nan)
    with np.errstate(invalid="ignore"):
        for k in range(-8, 9):
            for unit in (np.abs(near), np.maximum(np.abs(v), slack)):
                c = near + k * 2.0**-53 * unit
                out = np.where(np.abs(c - v) <= slack, (np.fmax if up else np.fmin)(out, c), out)
    return out


def busy_period_window(rows: DataFrame, window_us: int, close_abs: float, close_rel: float) -> DataFrame:
    """The same answers for ``rows`` (u, period, ts, v, id, own) whose groups (u, period) have ``TASK_ROWS`` rows at most."""
    id_kind = rows.schema["id"].dataType.simpleString()

    def answers(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.take(pa.array(np.argsort(np.asarray(table.column("pos")), kind="stable")))
        ts, pos, own = (np.asarray(table.column(c)) for c in ("ts", "pos", "own"))
        valued = np.asarray(table.column("v").is_valid())
        v = np.asarray(table.column("v").drop_null())
        upto = np.concatenate([[0], np.cumsum(valued)])  # rows with a value before each place
        by_value = np.argsort(v, kind="stable")
        ordered, ranks = v[by_value], np.empty(len(v), np.int64)
        ranks[by_value] = np.arange(len(v))
        at = np.flatnonzero(own)
        start = np.searchsorted(ts, ts[at] - window_us)
        l, r = upto[start], upto[pos[at]]
        low, high, count = np.full(len(at), np.nan), np.full(len(at), np.nan), np.zeros(len(at), np.int64)
        some = np.flatnonzero(r > l)
        if len(some):
            matrix, size = WaveletMatrix(ranks), r[some] - l[some]
            low[some] = ordered[matrix.select(l[some], r[some], (size - 1) // 2)]
            high[some] = ordered[matrix.select(l[some], r[some], size // 2)]
            some = some[valued[at[some]]]
            own_value = v[upto[at[some]]]
            some, own_value = (x[np.isfinite(own_value) | np.isnan(own_value)] for x in (some, own_value))
            for sign, up, end in ((1, True, "right"), (-1, False, "left")):
                bound = np.searchsorted(ordered, _borders(own_value, close_abs, close_rel, up), end)
                count[some] += sign * matrix.below(l[some], r[some], bound)
        median = pa.array((low + high) / 2, mask=r <= l)
        return pa.table({"id": table.column("id").take(pa.array(at)), "n_prior": pa.array(pos[at] - start), "median_prior": median, "n_same": pa.array(count)})

    place = F.rank().over(Window.partitionBy("u", "period").orderBy("ts", "id")).cast("long") - 1
    placed = rows.select("u", "period", "ts", "v", "id", "own", place.alias("pos"))
    return placed.groupBy("u", "period").applyInArrow(answers, f"id {id_kind}, n_prior long, median_prior double, n_same long")
