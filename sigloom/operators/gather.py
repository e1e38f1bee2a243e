"""Rows by their place, as indexing an array by a list of numbers gives them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class GatherError(IndexError):
    """A place that no row has."""


def gather(df: DataFrame, places: DataFrame, at: str = "row_index", order: str = "order", place: str = "place") -> DataFrame:
    """The rows of ``df`` at the places of an index list (order, place): one row an entry, with its ``order``,
    so that repeats stay and a sort by it gives the list's order. Negative places count from the end. A place
    beyond the rows, or null, raises; ``at`` numbers the rows of ``df`` from 0, each once."""
    if order in df.columns:
        raise GatherError(f"{order!r} is a column of the rows")
    facts = df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(at).alias("places"), F.min(at).alias("least"), F.max(at).alias("most")).first()
    n = facts["n"]
    if n and (facts["places"] != n or facts["least"] != 0 or facts["most"] != n - 1):
        raise GatherError(f"{at} does not number {n} rows from 0")
    p = F.col(place).cast("long")
    bad = F.raise_error(F.concat(F.lit(f"no place among {n} rows: "), F.coalesce(p.cast("string"), F.lit("null")))).cast("long")
    wanted = places.select(F.col(order), F.when((p >= -n) & (p < n), F.when(p < 0, p + n).otherwise(p)).otherwise(bad).alias(at))
    return wanted.join(df, at).select(order, *df.columns)
