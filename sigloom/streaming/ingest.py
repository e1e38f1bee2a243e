"""An extension: validation and exact deduplication of signals as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.functions.signal import content_key
from sigloom.operators import validation


def valid_stream(stream: DataFrame, policy: validation.ValidationPolicy) -> DataFrame:
    """Rows without an issue; stateless, as in batches."""
    return validation.valid_rows(stream, policy)


def issue_stream(stream: DataFrame, policy: validation.ValidationPolicy) -> DataFrame:
    return validation.issues(stream, policy)


def first_arrivals(stream: DataFrame, time: str = "arrived", delay: str = "1 hour") -> DataFrame:
    """The first row of equal content within the watermark; state older than that is dropped."""
    keyed = stream.withWatermark(time, delay).withColumn("content", content_key(F.col("i"), F.col("q")))
    return keyed.dropDuplicatesWithinWatermark(["content"]).drop("content")


def error_rates(stream: DataFrame, policy: validation.ValidationPolicy, time: str = "arrived", every: str = "5 minutes", delay: str = "1 hour") -> DataFrame:
    """(window, error_code, n) per tumbling window."""
    found = F.array_compact(F.array(*[F.when(c, F.lit(code)) for code, c in validation.rules(policy).items()]))
    issues = stream.withWatermark(time, delay).select(time, F.explode(found).alias("error_code"))
    return issues.groupBy(F.window(time, every), "error_code").agg(F.count(F.lit(1)).alias("n"))
