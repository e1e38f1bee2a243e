"""Quarantine: who is kept out, and why."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reasons(validation: DataFrame, exact: DataFrame, near: DataFrame, leakage: DataFrame | None = None) -> DataFrame:
    """(sample_id, error_code, duplicate_of), one row a reason.

    Validation codes count as they are. Of an exact cluster all but the least id go, all if labels conflict. Of a near
    pair both go. Other leakage codes, as (sample_id, error_code), count for every sample listed.
    """
    none = F.lit(None).cast("string").alias("duplicate_of")
    parts = [
        validation.select("sample_id", "error_code", none),
        exact.where("conflict").select("sample_id", F.lit("duplicate.label_conflict").alias("error_code"), none),
        exact.where("conflict or sample_id <> canonical").select("sample_id", F.lit("duplicate.exact").alias("error_code"), F.when(~F.col("conflict"), F.col("canonical")).alias("duplicate_of")),
        near.select(F.explode(F.array("left_id", "right_id")).alias("sample_id"), F.lit("duplicate.near").alias("error_code"), none),
    ]
    if leakage is not None:
        parts.append(leakage.select("sample_id", "error_code", none))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.distinct()


class UnknownSampleError(ValueError):
    """Issues name samples that are not in the table."""


def assert_known(found: DataFrame, universe: DataFrame) -> DataFrame:
    """The issues, if every id they name is one of the table's; else the least unknown id is told."""
    unknown = found.where("sample_id is null").select("sample_id").unionByName(found.select("sample_id").join(universe.select("sample_id"), "sample_id", "left_anti"))
    row = unknown.agg(F.count(F.lit(1)).alias("n"), F.min("sample_id").alias("least")).first()
    if row["n"]:
        raise UnknownSampleError(f"{row['n']} issues name unknown samples: {row['least']}")
    return found


def entries(found: DataFrame) -> DataFrame:
    """(sample_id, codes, duplicate_of), one row a quarantined sample."""
    return found.groupBy("sample_id").agg(F.array_join(F.sort_array(F.collect_set("error_code")), ",").alias("codes"), F.min("duplicate_of").alias("duplicate_of"))


def accepted(universe: DataFrame, found: DataFrame) -> DataFrame:
    """The rows that nothing keeps out."""
    return universe.join(found.select("sample_id").distinct(), "sample_id", "left_anti")


def partition_check(universe: DataFrame, kept: DataFrame, out: DataFrame) -> DataFrame:
    """One row: total, accepted, quarantined, overlap, missing."""
    marks = universe.select("sample_id", F.lit(1).alias("u"), F.lit(0).alias("a"), F.lit(0).alias("q"))
    marks = marks.union(kept.select("sample_id", F.lit(0), F.lit(1), F.lit(0))).union(out.select("sample_id", F.lit(0), F.lit(0), F.lit(1)))
    each = marks.groupBy("sample_id").agg(F.max("u").alias("u"), F.max("a").alias("a"), F.max("q").alias("q"))
    return each.agg(F.sum("u").alias("total"), F.sum("a").alias("accepted"), F.sum("q").alias("quarantined"), F.count_if(F.col("a") + F.col("q") > 1).alias("overlap"), F.count_if(F.col("a") + F.col("q") < F.col("u")).alias("missing"))
