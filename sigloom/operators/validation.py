"""Validation rules: one issue a violated rule, all of a row in one scan."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigloom.functions.signal import amplitudes, mean_power_single, non_finite, spread


class PolicyError(ValueError):
    """A policy's settings are not valid."""


@dataclass(frozen=True)
class ValidationPolicy:
    signal_length: int
    allowed_labels: tuple[str, ...]
    max_amplitude: float
    min_power: float
    max_power: float
    snr_min: float
    snr_max: float
    constant_tolerance: float = 0.0
    dtype: str = "float32"

    def __post_init__(self) -> None:
        if self.signal_length <= 0 or not self.allowed_labels:
            raise PolicyError("signal_length and allowed_labels must not be empty")
        if not 0 <= self.min_power <= self.max_power or self.max_amplitude <= 0 or self.constant_tolerance < 0:
            raise PolicyError("limits of power, amplitude and tolerance must be ordered and non-negative")
        if not self.snr_min <= self.snr_max:
            raise PolicyError("snr_min must not exceed snr_max")

    @classmethod
    def from_mapping(cls, value: Mapping[str, Any]) -> ValidationPolicy:
        try:
            return cls(**{**value, "allowed_labels": tuple(value["allowed_labels"])})
        except (TypeError, KeyError) as error:
            raise PolicyError(str(error)) from error


#: Positions of an index list that are compared in one window.
BLOCK_POSITIONS = 65536

#: Order of a row's issues.
CODES: tuple[str, ...] = (
    "signal.not_ndarray", "signal.invalid_shape", "signal.invalid_length", "signal.empty", "signal.invalid_dtype", "signal.non_finite", "signal.constant", "signal.amplitude_out_of_range", "signal.power_out_of_range",
    "label.not_allowed", "snr.invalid_type", "snr.non_finite", "snr.out_of_range",
)


def rules(policy: ValidationPolicy, snr_text: Column | None = None) -> dict[str, Column]:
    """The condition of each code. Shape, emptiness, type and finiteness gate the rules that
    need them; a wrong length does not. ``snr_text`` is an SNR as read, before typing."""
    i, q = F.col("i"), F.col("q")
    present = i.isNotNull() & q.isNotNull()
    empty, shape = present & ((F.size(i) == 0) | (F.size(q) == 0)), present & (F.size(i) != F.size(q))
    wrong_type = present & ~F.col("dtype").eqNullSafe(F.lit(policy.dtype))
    fine = F.coalesce(present & ~empty & ~shape & ~wrong_type, F.lit(False))
    odd = fine & (non_finite(i) | non_finite(q))
    usable = fine & ~odd
    label, snr = F.col("label"), F.col("snr_db")
    untyped = F.lit(False) if snr_text is None else snr_text.isNotNull() & snr_text.try_cast("double").isNull()
    odd_snr = snr.isNotNull() & (F.isnan(snr) | (F.abs(snr) == float("inf")))
    power = mean_power_single(i, q)
    conditions = [
        ~present, shape, present & ~shape & (F.size(i) != policy.signal_length), empty, wrong_type, odd,
        usable & (spread(i) <= policy.constant_tolerance) & (spread(q) <= policy.constant_tolerance),
        usable & (F.array_max(amplitudes(i, q, single=True)) > policy.max_amplitude),
        usable & ((power < policy.min_power) | (power > policy.max_power)),
        label.isNull() | ~label.isin(*policy.allowed_labels), untyped, odd_snr,
        snr.isNotNull() & ~odd_snr & ~snr.between(policy.snr_min, policy.snr_max),
    ]
    return dict(zip(CODES, conditions, strict=True))


def issues(df: DataFrame, policy: ValidationPolicy, snr_text: Column | None = None) -> DataFrame:
    """(row_index, sample_id, error_code, field, place), one row a violation."""
    found = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(k).alias("place"), F.lit(code).alias("error_code"))) for k, (code, c) in enumerate(rules(policy, snr_text).items())]))
    return df.select("row_index", "sample_id", F.explode(found).alias("x")).select("row_index", "sample_id", "x.error_code", F.substring_index("x.error_code", ".", 1).alias("field"), "x.place")


def valid_rows(df: DataFrame, policy: ValidationPolicy, snr_text: Column | None = None) -> DataFrame:
    """The rows without an issue, in one narrow filter."""
    bad = F.lit(False)
    for condition in rules(policy, snr_text).values():
        bad = bad | F.coalesce(condition, F.lit(False))
    return df.where(~bad)


def error_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("error_code").agg(F.count(F.lit(1)).alias("n"))


def error_summary(found: DataFrame, k: int = 5) -> DataFrame:
    """(error_code, n, rank, sample_id): each code's first k ids. Distinct first, so that a
    frequent code is ranked over its ids by a window group limit, map-side."""
    ids = found.select("error_code", "sample_id").distinct()
    ranked = ids.withColumn("rank", F.row_number().over(Window.partitionBy("error_code").orderBy("sample_id"))).where(F.col("rank") <= k)
    return ranked.join(error_counts(found), "error_code").select("error_code", "n", "rank", "sample_id")


def index_problems(indices: DataFrame, n: int) -> DataFrame:
    """(pos, idx, problem) for a list of training indices that must ascend within 0..n-1. Neighbours
    are compared within blocks of positions; only the last index of each block is ordered globally."""
    blocked = indices.withColumn("_block", F.floor(F.col("pos") / BLOCK_POSITIONS))
    ends = blocked.groupBy("_block").agg(F.max_by("idx", "pos").alias("_last"))
    carried = ends.select("_block", F.lag("_last").over(Window.orderBy("_block")).alias("_carried"))  # one row a block
    before = F.lag("idx").over(Window.partitionBy("_block").orderBy("pos"))
    rows = blocked.withColumn("_before", before).join(carried, "_block")
    bad = F.when((F.col("idx") < 0) | (F.col("idx") >= n), "out_of_range").when(F.coalesce("_before", "_carried") >= F.col("idx"), "not_ascending")
    return rows.withColumn("problem", bad).where("problem is not null").drop("_block", "_before", "_carried")


def safety_problems(df: DataFrame, max_amplitude: float, epsilon: float, reject_zero_power: bool = True) -> dict[str, int]:
    """Counts that stop a fit: rows with non-finite values, too great amplitudes (in double), no power."""
    from sigloom.functions.signal import mean_power

    i, q = F.col("i"), F.col("q")
    row = df.agg(
        F.count_if(non_finite(i) | non_finite(q)).alias("non_finite"),
        F.count_if(F.array_max(amplitudes(i, q)) > max_amplitude).alias("amplitude"),
        F.count_if(mean_power(i, q) <= epsilon if reject_zero_power else F.lit(False)).alias("zero_power"),
    ).first()
    return row.asDict()
