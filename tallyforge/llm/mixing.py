"""Mix sources to target weights: hash-random order, prefix sums per source, exact cuts, epochs.

Each source gets a target number of words. Its rows get a hash-random key; the first row in key order
comes first. Whole epochs take every row, the rest of the budget is a cut in key order. To find the cut
without a global or hot-source window, rows are dealt by source and by the leading digits of the key: the
keys are hashes, so these ranges are even, whatever share of the rows a source holds. Range totals give
each range its starting sum; only the one range of each source that the budget ends in is summed row by
row. What comes out is one line per source (epochs, the key of the last row, what is left for it), and
every row decides by comparing its own key with that line; no text is shuffled.

Defined cases: a null text has size 0 and takes nothing; null is a source of its own, ordered last; a
source whose sizes are all 0 has target 0. Rows alike in id and text have the same key and share the rest
of the budget evenly (rounded down). Empty tables give empty results. Extra columns are kept; those named
size, source_size, target or taken are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import WORD
from tallyforge.session import settle

#: Leading hex digits of the key that name its range: 256 ranges a source.
RANGE_DIGITS = 2


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def row_key(doc_id: Column, text: Column) -> Column:
    """Hash-random, the same in every run."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(" "), F.md5(F.coalesce(text, F.lit("")))))


def targets(sizes: DataFrame, weights: list[int], share: float, most: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Sources in code point order, null last, weigh ``weights`` over and over. They share ``share`` times
    all sizes; where that is more than ``most`` times a source's size it gets that, and the rest is
    shared out again. In order of ``most * size / weight`` the sources that stop there come first, so
    running sums give the level at which all others are served. One row per source is all that meets here.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    cycle = F.array(*[F.lit(w) for w in weights])
    placed = sizes.withColumn("_w", F.element_at(cycle, F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1))
    placed = placed.withColumn("_cap", F.lit(most) * F.col("source_size")).withColumn("_ratio", F.col("_cap") / F.col("_w"))
    order = Window.orderBy("_ratio", F.col("source").isNull(), "source")
    every = Window.partitionBy(F.lit(0))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.lit(share) * F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(onward)
    # the first source whose stop lies above the level: it and all after it are served by weight
    leveled = placed.withColumn("_level", level).withColumn("_place", F.row_number().over(order))
    first = F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_place", "_level"))).over(every)
    found = leveled.withColumn("_served", first)
    stops = F.col("_served").isNull() | (F.col("_place") < F.col("_served._place"))
    target = F.when(stops, F.col("_cap")).otherwise(F.col("_w") * F.col("_served._level"))
    return found.select("source", "source_size", F.least(target, F.col("_cap")).alias("target"))


def cuts(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """One row per source: epochs, last_key, last_words (for each row of that key) and the targets.

    ``keyed``: (source, key, size), read several times; ``wanted``: from ``targets``.
    """
    budget = F.floor(F.col("target") + F.lit(0.5)).cast("bigint")
    plan = wanted.withColumn("_epochs", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("bigint"))
    plan = plan.withColumn("_rest", budget - F.col("_epochs") * F.col("source_size"))
    ranged = keyed.withColumn("_range", F.substring("key", 1, RANGE_DIGITS))
    totals = ranged.groupBy("source", "_range").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.withColumn("_start", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    plan_ = plan.select(F.col("source").alias("_source"), "_rest")
    ends = starts.join(plan_, F.col("source").eqNullSafe(F.col("_source"))).where("_rest > _start and _rest <= _start + _sum").select(
        F.col("_source"), F.col("_range").alias("_end"), "_start", "_rest"
    )
    near = ranged.join(ends, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_range") == F.col("_end")))
    by_key = near.groupBy("source", "key", "_start", "_rest").agg(F.sum("size").alias("_sum"), F.count("*").alias("_rows"))
    inside = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    running = by_key.withColumn("_before", F.col("_start") + F.coalesce(F.sum("_sum").over(inside), F.lit(0)))
    last = running.where("_rest > _before and _rest <= _before + _sum").select(
        F.col("source").alias("_source"), F.col("key").alias("last_key"), F.floor((F.col("_rest") - F.col("_before")) / F.col("_rows")).cast("bigint").alias("last_words")
    )
    return plan.join(last, F.col("source").eqNullSafe(F.col("_source")), "left").select(
        "source", "source_size", "target", F.col("_epochs").alias("epochs"), "last_key", "last_words"
    )


def mix(
    docs: DataFrame,
    weights: list[int],
    share: float = 1.5,
    most: float = 2.0,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``docs`` with size, source_size, target, taken (words, repeats counted) and copies.

    ``copies`` is how often the whole row belongs into a mix of whole rows: a cut row counts as taken if
    at least half of it is.
    """
    new = ("size", "source_size", "target", "taken", "copies")
    kept = [c for c in docs.columns if c not in new]
    measured = docs.select(*kept, words_of(F.col(text)).alias("size"), row_key(F.col(doc_id), F.col(text)).alias("_key"))
    keyed = settle(measured.select(F.col(source).alias("source"), F.col("_key").alias("key"), "size"))
    sizes = keyed.groupBy("source").agg(F.sum("size").alias("source_size"))
    line = settle(cuts(keyed, targets(sizes, weights, share, most)).withColumnRenamed("source", "_line"))
    joined = measured.join(line, F.col(source).eqNullSafe(F.col("_line")))
    partial = F.when(F.col("_key") < F.col("last_key"), F.col("size")).when(F.col("_key") == F.col("last_key"), F.col("last_words")).otherwise(0)
    whole = F.when((partial > 0) & (2 * partial >= F.col("size")), 1).otherwise(0)
    return joined.select(
        *kept,
        "size",
        "source_size",
        "target",
        (F.col("epochs") * F.col("size") + F.coalesce(partial, F.lit(0))).cast("bigint").alias("taken"),
        (F.col("epochs") + whole).cast("int").alias("copies"),
    )


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix as whole rows: each row as often as its ``copies``."""
    return mixed.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*columns)
