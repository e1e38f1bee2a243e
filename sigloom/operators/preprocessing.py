"""Train-fitted normalisation."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.functions.signal import affine, affine_inverse
from sigloom.schema import NORMALISATIONS, canonical_sha256


class PreprocessingError(ValueError):
    """A fit or transform is not possible."""


@dataclass(frozen=True)
class Preprocessor:
    mode: str
    dc_i: float
    dc_q: float
    scale: float

    def sha256(self) -> str:
        return canonical_sha256(asdict(self))

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({"i": affine(F.col("i"), self.dc_i, self.scale), "q": affine(F.col("q"), self.dc_q, self.scale)})

    def inverse(self, df: DataFrame) -> DataFrame:
        return df.withColumns({"i": affine_inverse(F.col("i"), self.dc_i, self.scale), "q": affine_inverse(F.col("q"), self.dc_q, self.scale)})


def values(df: DataFrame) -> DataFrame:
    """(row_index, x, y) one row a pair of values, in double."""
    return df.select("row_index", F.explode(F.arrays_zip(F.col("i"), F.col("q"))).alias("v")).select("row_index", F.col("v.i").cast("double").alias("x"), F.col("v.q").cast("double").alias("y"))


def fit_table(train: DataFrame, mode: str, remove_dc: bool = True) -> DataFrame:
    """One row (dc_i, dc_q, scale). Means first, then the scale of centred values: two
    aggregates, as the shortcut over raw moments loses digits."""
    if mode not in NORMALISATIONS:
        raise PreprocessingError(mode)
    pairs = values(train)
    zero = F.lit(0.0)
    means = pairs.agg((F.avg("x") if remove_dc else zero).alias("dc_i"), (F.avg("y") if remove_dc else zero).alias("dc_q"))
    a, b = F.col("x") - F.col("dc_i"), F.col("y") - F.col("dc_q")
    scale = {"none": F.lit(1.0), "train_rms_power": F.sqrt(F.avg(a * a + b * b)), "train_peak_amplitude": F.max(F.hypot(a, b))}[mode]
    return pairs.crossJoin(F.broadcast(means)).groupBy("dc_i", "dc_q").agg(scale.alias("scale"))  # means is one row


def fit(train: DataFrame, mode: str, remove_dc: bool = True, epsilon: float = 1e-12) -> Preprocessor:
    row = fit_table(train, mode, remove_dc).first()
    if row is None:
        raise PreprocessingError("no training rows")
    if not row["scale"] > epsilon:
        raise PreprocessingError(f"scale {row['scale']} is not above {epsilon}")
    return Preprocessor(mode, row["dc_i"], row["dc_q"], row["scale"])
