"""Sums of doubles that do not depend on the order partitions finish in.

A double sum changes in its last digits with task order, so a replay of the same batch would not give the
same bytes. Every value is taken as a decimal with ten places, whatever its size; decimals add up exactly,
on the JVM, with map-side partials. Totals up to 10**28 fit; a value or total beyond that, or one that is
not a number, is an error rather than a silent null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_KIND = "decimal(38,10)"


def decimal_sum(value: Column) -> Column:
    """The exact total as a decimal: for partial sums that are summed again."""
    return F.sum(value.cast(_KIND)).cast(_KIND)


def exact_sum(value: Column) -> Column:
    return decimal_sum(value).cast("double")


def exact_avg(value: Column) -> Column:
    return exact_sum(value) / F.nullif(F.count(value), F.lit(0)).cast("double")
