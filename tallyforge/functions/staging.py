"""Keep costly per-row expressions from being evaluated more than once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add (or replace) columns behind a generator of exactly one row.

    The optimizer moves filters below a projection by copying its expressions into
    them; over several costly steps those copies multiply. It does not move a filter
    below a generator it depends on. No shuffle, and row counts stay as they are.
    """
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(row)))
