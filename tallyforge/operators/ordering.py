"""Global and per-key order at scale: running totals, quantiles and cuts.

A window without partition keys, or with one hot key, sends everything to one
task. Here rows are first folded to one row per distinct value (map-side
partials), the folded rows are range-partitioned on (keys, value), each slice
is summed on its own, and the slice totals (at most one row per key and slice)
give every slice its starting offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.session import settle

_SLICE = "_slice"


def running_totals(df: DataFrame, keys: list[str], order: str, measures: dict[str, Column]) -> DataFrame:
    """One row per (keys, order) with each measure's sum, the sum over smaller
    ``order`` values of the key (``<m>_before``) and the key's whole (``<m>_all``).
    """
    names = list(measures)
    folded = df.groupBy(*keys, order).agg(*[F.sum(c).alias(n) for n, c in measures.items()])
    spread = settle(
        folded.repartitionByRange(*keys, order).withColumn(_SLICE, F.spark_partition_id())
    )
    totals = spread.groupBy(*keys, _SLICE).agg(*[F.sum(n).alias(n) for n in names])
    by_key = Window.partitionBy(*(keys or [F.lit(0)]))
    earlier = by_key.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col(_SLICE).alias("_k_slice"),
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_{n}_start") for n in names],
        *[F.sum(n).over(by_key).alias(f"{n}_all") for n in names],
    )
    inside = Window.partitionBy(_SLICE, *keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = spread.select("*", *[F.coalesce(F.sum(n).over(inside), F.lit(0)).alias(f"_{n}_run") for n in names])
    same = local[_SLICE] == offsets["_k_slice"]
    for k in keys:
        same = same & local[k].eqNullSafe(offsets[f"_k_{k}"])
    return local.join(offsets, same).select(
        *keys,
        order,
        *names,
        *[(F.col(f"_{n}_start") + F.col(f"_{n}_run")).alias(f"{n}_before") for n in names],
        *[f"{n}_all" for n in names],
    )


def carried(df: DataFrame, keys: list[str], order: list[str], value: str, name: str, how: str) -> DataFrame:
    """``df`` with ``name``: over the rows of the key before this one by ``order``, the last non-null ``value``
    (``how="last"``) or the largest (``how="max"``).

    Rows are range-partitioned on (keys, order), each slice looks back within itself, and one row per key and
    slice carries what earlier slices end with, so a key's rows never meet in one task. ``order`` must be unique
    within a key for "last".
    """
    fold = (lambda c: F.last(c, ignorenulls=True)) if how == "last" else F.max
    spread = settle(df.repartitionByRange(*keys, *order).withColumn(_SLICE, F.spark_partition_id()))
    end = F.max_by(value, F.struct(*order)).alias("_end") if how == "last" else F.max(value).alias("_end")
    some = spread.where(F.col(value).isNotNull()).groupBy(*keys, _SLICE).agg(end)
    # slices without a value still need what came before them
    ends = spread.select(*keys, _SLICE).distinct().join(some.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(_SLICE).alias("_k_slice"), "_end"), [*[F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], F.col(_SLICE) == F.col("_k_slice")], "left")
    earlier = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(*[F.col(k).alias(f"_s_{k}") for k in keys], F.col(_SLICE).alias("_s_slice"), fold("_end").over(earlier).alias("_start"))
    inside = Window.partitionBy(_SLICE, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = spread.withColumn("_local", fold(value).over(inside))
    met = local.join(starts, [*[F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys], F.col(_SLICE) == F.col("_s_slice")])
    found = F.coalesce("_local", "_start") if how == "last" else F.greatest("_local", "_start")
    return met.select(*df.columns, found.alias(name))


#: Keys with at most so many values are sorted one by one; the rest is bracketed by a sketch of this accuracy.
SMALL, ACCURACY = 20_000, 10_000
#: A sketch's answer is at most 2 / ACCURACY of the rows off its rank; brackets reach twice as far to either side,
#: which for more than SMALL values also covers the few ranks by which definitions of a quantile differ.
MARGIN = 4 / ACCURACY
#: A key that the brackets leave at most so many entries of is sorted in one task; beyond, in range partitions.
ONE_SORT = 500_000


def _same_keys(keys: list[str], left: DataFrame, right: DataFrame) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & left[k].eqNullSafe(right[f"_k_{k}"])
    return same


def _named_apart(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in df.columns if c not in keys])


def _small_quantiles(rows: DataFrame, keys: list[str], points: list[float]) -> DataFrame:
    """Keys of at most SMALL values: each key's sorted values, looked up by place."""
    held = rows.groupBy(*keys).agg(F.array_sort(F.collect_list("_v")).alias("_s")).withColumn("n", F.size("_s").cast("bigint"))
    ends = {}
    for i, q in enumerate(points):
        spot = (F.col("n") - 1) * F.lit(float(q))
        for end, rank in (("lo", F.floor(spot)), ("hi", F.ceil(spot))):
            ends[f"_{end}{i}"] = F.element_at("_s", (rank + 1).cast("int"))
    return held.select(*keys, "n", *[c.alias(n) for n, c in ends.items()])


def _bracketed(rows: DataFrame, keys: list[str], points: list[float]) -> DataFrame:
    """Values within a bracket of some quantile stay as they are; all others become one entry per gap between brackets."""
    asked = [(max(q - MARGIN, 0.0), min(q + MARGIN, 1.0)) for q in points]
    sketch = rows.groupBy(*keys).agg(
        F.percentile_approx("_v", [p for pair in asked for p in pair], ACCURACY).alias("_p"), F.min("_v").alias("_least"), F.max("_v").alias("_most")
    )
    ends = {}
    for i, (lo, hi) in enumerate(asked):
        ends[f"_lo{i}"] = F.col("_least") if lo == 0.0 else F.col("_p")[2 * i]
        ends[f"_hi{i}"] = F.col("_most") if hi == 1.0 else F.col("_p")[2 * i + 1]
    brackets = settle(_named_apart(sketch.select(*keys, *[c.alias(n) for n, c in ends.items()]), keys))
    v = F.col("_v")
    met = rows.join(brackets, _same_keys(keys, rows, brackets))
    inside, lower = F.lit(False), F.lit(None)
    for i in range(len(points)):
        inside = inside | ((F.col(f"_lo{i}") <= v) & (v <= F.col(f"_hi{i}")))
        lower = F.greatest(lower, F.when(F.col(f"_hi{i}") < v, F.col(f"_hi{i}")))
    return met.select(*keys, F.struct(F.when(inside, v).otherwise(lower).alias("at"), (~inside).alias("gap")).alias("_o"))


def _large_quantiles(rows: DataFrame, keys: list[str], points: list[float]) -> DataFrame:
    """Keys with more values: running counts over what the brackets leave, a few thousandths of the values and the gaps."""
    left = settle(_bracketed(rows, keys, points).groupBy(*keys, "_o").agg(F.count("*").alias("n")))
    if left.groupBy(*keys).count().where(F.col("count") > ONE_SORT).isEmpty():
        by_key = Window.partitionBy(*keys)
        earlier = by_key.orderBy("_o").rowsBetween(Window.unboundedPreceding, -1)
        ranked = left.select("*", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"), F.sum("n").over(by_key).alias("n_all"))
    else:
        ranked = running_totals(left, keys, "_o", {"n": F.col("n")})
    upto = F.col("n_before") + F.col("n")
    aggs = [F.max("n_all").alias("n")]
    for i, q in enumerate(points):
        spot = (F.col("n_all") - 1) * F.lit(float(q))
        for end, rank in (("lo", F.floor(spot)), ("hi", F.ceil(spot))):
            holds = (F.col("n_before") <= rank) & (rank < upto)
            found = F.when(F.col("_o.gap"), F.raise_error(F.lit("a quantile lies outside its bracket"))).otherwise(F.col("_o.at"))
            aggs.append(F.max(F.when(holds, found)).alias(f"_{end}{i}"))
    return ranked.groupBy(*keys).agg(*aggs)


def exact_quantiles(df: DataFrame, keys: list[str], value: str, points: list[float], small: int = SMALL) -> DataFrame:
    """Exact linear-interpolated quantiles per key as ``(keys, n, quantiles)``; null values are left out.

    Keys are counted first. A key of at most ``small`` values is sorted in one row of its own. For the others one
    aggregate of mergeable sketches brackets every quantile with a proven error, one more counts what lies between
    the brackets, and only values inside a bracket are ranked, by running counts in range partitions; so no key's
    values meet in one task, and of most values only a count moves.
    """
    named = keys or ["_all"]
    present = df.where(F.col(value).isNotNull())
    rows = present.select(*keys, F.col(value).alias("_v")) if keys else present.select(F.lit(0).alias("_all"), F.col(value).alias("_v"))
    large = settle(_named_apart(rows.groupBy(*named).agg(F.count("*").alias("_n")).where(F.col("_n") > max(small, 2 / MARGIN)), named).drop("_n"))
    if large.isEmpty():
        picked = _small_quantiles(rows, named, points)
    else:
        same = _same_keys(named, rows, large)
        picked = _large_quantiles(rows.join(large, same, "left_semi"), named, points)
        picked = picked.unionByName(_small_quantiles(rows.join(large, same, "left_anti"), named, points))
    quantiles = []
    for i, q in enumerate(points):
        spot = (F.col("n") - 1) * F.lit(float(q))
        share = spot - F.floor(spot)
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        quantiles.append(lo + (hi - lo) * share)
    return picked.select(*keys, "n", F.array(*quantiles).alias("quantiles"))


def exact_median(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    found = exact_quantiles(df, keys, value, [0.5])
    return found.select(*keys, F.col("quantiles")[0].alias(name))


#: Cut value that stands for the rows without an order value; they come after all others.
NO_VALUE = object()


def _at_value(order: str, value) -> Column:
    return F.col(order).isNull() if value is NO_VALUE else F.coalesce(F.col(order) == F.lit(value), F.lit(False))


def order_cuts(df: DataFrame, order: str, tiebreak: str, ks: list, descending: bool = False) -> list[tuple]:
    """For each wanted count, the cut ``(value, tie, k)``: the first k rows by (order, tiebreak)
    are those beyond ``value`` plus those at ``value`` whose tiebreak is at most ``tie``.

    Rows without an order value are last, in either direction. ``ks`` are functions from the number of rows
    (a column) to k (a column); a k beyond the number of rows takes all of them. ``tie`` is None when all rows at ``value`` belong to the first k. Only
    these few values leave the cluster; rows tied at a cut are ranked among themselves by ``tiebreak``, so
    one value may hold any share of the rows.
    """
    has = F.col(order).isNotNull()
    placed = df.select(F.struct((has if descending else ~has).alias("end"), F.col(order).alias("value")).alias("_o"))
    ranked = running_totals(placed, [], "_o", {"n": F.lit(1)})
    first = F.col("n_all") - F.col("n_before") - F.col("n") if descending else F.col("n_before")
    asked = [F.least(k(F.col("n_all")), F.col("n_all")).cast("bigint") for k in ks]  # beyond the end: all rows
    hits = [F.when((first < k) & (k <= first + F.col("n")), F.struct(F.lit(i).alias("i"), k.alias("k"))) for i, k in enumerate(asked)]
    found = [
        {"value": NO_VALUE if r["missing"] else r["value"], "first": r["first"], "n": r["n"], "i": r["i"], "k": r["k"]}
        for r in ranked.select(
            F.col("_o.value").alias("value"), F.col("_o.value").isNull().alias("missing"), first.alias("first"), "n", F.explode(F.array_compact(F.array(*hits))).alias("h")
        )
        .select("value", "missing", "first", "n", "h.i", "h.k")
        .collect()
    ]
    cuts: list[tuple] = [(None, None, 0)] * len(ks)
    open_cuts = [r for r in found if r["k"] - r["first"] < r["n"]]
    ties = {}
    if open_cuts:
        tied_at, wanted = F.lit(False), F.lit(False)
        for r in open_cuts:
            need = r["k"] - r["first"]
            tied_at = tied_at | _at_value(order, r["value"])
            wanted = wanted | (_at_value(order, r["value"]) & (F.col("n_before") < need) & (F.lit(need) <= F.col("n_before") + F.col("n")))
        places = running_totals(df.where(tied_at), [order], tiebreak, {"n": F.lit(1)})
        for p in places.where(wanted).select(F.col(order).alias("value"), F.col(tiebreak).alias("tie"), "n_before", "n").collect():
            ties.setdefault(NO_VALUE if p["value"] is None else p["value"], []).append(p)
    for r in found:
        need = r["k"] - r["first"]
        tie = None
        if need < r["n"]:
            tie = next(p["tie"] for p in ties[r["value"]] if p["n_before"] < need <= p["n_before"] + p["n"])
        cuts[r["i"]] = (r["value"], tie, r["k"])
    return cuts


def before_cut(order: str, tiebreak: str, cut: tuple, descending: bool = False) -> Column:
    """Whether a row is among the first k of a cut; never null."""
    value, tie, _ = cut
    if value is None:
        return F.lit(False)
    if value is NO_VALUE:
        beyond = F.col(order).isNotNull()
    else:
        beyond = F.coalesce(F.col(order) > F.lit(value) if descending else F.col(order) < F.lit(value), F.lit(False))
    at = _at_value(order, value)
    return beyond | (at if tie is None else at & F.coalesce(F.col(tiebreak) <= F.lit(tie), F.lit(False)))


def split_at(df: DataFrame, order: str, tiebreak: str, k, descending: bool = False):
    """(first k rows, the rest) by (order, tiebreak), rows without an order value last; ids must be unique.

    ``k`` is a number or a function from the row count (a column) to a column.
    """
    wanted = k if callable(k) else (lambda _: F.lit(k))
    (cut,) = order_cuts(df, order, tiebreak, [wanted], descending)
    inside = before_cut(order, tiebreak, cut, descending)
    return df.where(inside), df.where(~inside)


def category_codes(df: DataFrame, columns: list[str]) -> DataFrame:
    """(name, value, code): position of each value among the sorted distinct values of its column."""
    stacked = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in columns])).alias("kv")
    ).select("kv.name", "kv.value")
    distinct = stacked.where(F.col("value").isNotNull()).distinct()
    ranked = running_totals(distinct, ["name"], "value", {"n": F.lit(1)})
    return ranked.select("name", "value", F.col("n_before").cast("int").alias("code"))
