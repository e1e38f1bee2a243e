"""Scalar functions on I/Q arrays, as Columns inside code generation where Spark has it."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def amplitudes(i: Column, q: Column, single: bool = False) -> Column:
    """hypot of each pair, in double; ``single`` rounds it to float32, as validation does."""
    return F.zip_with(i, q, lambda a, b: F.hypot(a, b).cast("float") if single else F.hypot(a, b))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v.cast("double"))


def mean_power(i: Column, q: Column) -> Column:
    squares = F.zip_with(i, q, lambda a, b: a.cast("double") * a.cast("double") + b.cast("double") * b.cast("double"))
    return F.try_divide(total(squares), F.size(i))


def mean_power_single(i: Column, q: Column) -> Column:
    """Mean square of the float32 amplitudes, summed in double."""
    squares = F.transform(amplitudes(i, q, single=True), lambda a: a.cast("double") * a.cast("double"))
    return F.try_divide(total(squares), F.size(i))


def phase(i: Column, q: Column) -> Column:
    """atan2 wrapped to [-pi, pi)."""
    return F.pmod(F.atan2(q, i) + math.pi, F.lit(2 * math.pi)) - math.pi


def non_finite(x: Column) -> Column:
    return F.exists(x, lambda v: F.isnan(v) | (F.abs(v) == float("inf")))


def spread(x: Column) -> Column:
    """The greatest distance of a value from the first."""
    return F.array_max(F.transform(x, lambda v: F.abs(v - F.get(x, 0))))


def affine(x: Column, dc: float | Column, scale: float | Column) -> Column:
    """(x - dc) / scale in double, as float32."""
    dc, scale = (v if isinstance(v, Column) else F.lit(float(v)) for v in (dc, scale))
    return F.transform(x, lambda v: ((v.cast("double") - dc) / scale).cast("float"))


def affine_inverse(x: Column, dc: float | Column, scale: float | Column) -> Column:
    dc, scale = (v if isinstance(v, Column) else F.lit(float(v)) for v in (dc, scale))
    return F.transform(x, lambda v: (v.cast("double") * scale + dc).cast("float"))


def crop(x: Column, length: int, mode: str) -> Column:
    """At most ``length`` values, from the start, the centre (rounded down) or the end."""
    excess = F.greatest(F.size(x) - length, F.lit(0))
    start = {"start": F.lit(0), "center": F.floor(excess / 2).cast("int"), "end": excess}[mode]
    return F.slice(x, start + 1, F.lit(length))


def pad(x: Column, length: int, mode: str, value: Column) -> Column:
    """Filled up to ``length`` on the left, both sides (the lesser half left) or the right."""
    missing = F.greatest(F.lit(length) - F.size(x), F.lit(0))
    left = {"left": missing, "center": F.floor(missing / 2).cast("int"), "right": F.lit(0)}[mode]
    return F.concat(F.array_repeat(value, left), x, F.array_repeat(value, missing - left))


def snr_bucket(snr: Column, edges: Sequence[float]) -> Column:
    """``bin-00:[lo,hi)`` labels for ascending edges, ``unknown`` for null; the ends are open."""
    names = ["-inf", *(f"{e:g}" for e in edges), "+inf"]
    label = F.lit(f"bin-{len(edges):02d}:[{names[-2]},{names[-1]})")
    for k in range(len(edges) - 1, -1, -1):
        label = F.when(snr < edges[k], f"bin-{k:02d}:[{names[k]},{names[k + 1]})").otherwise(label)
    return F.when(snr.isNull(), "unknown").otherwise(label)


def seeded_key(seed: int, value: Column) -> Column:
    return F.sha2(F.concat(F.lit(str(seed)), F.char(F.lit(0)), value), 256)


def group_key(source: Column, version: Column, sequence: Column) -> Column:
    """``group-`` and a hash of the three; null where any is blank."""
    parts = [F.nullif(F.trim(x), F.lit("")) for x in (source, version, sequence)]
    return F.concat(F.lit("group-"), F.sha2(F.concat(parts[0], F.char(F.lit(0)), parts[1], F.char(F.lit(0)), parts[2]), 256))


def sample_key(source: Column, version: Column, path: Column, digest: Column) -> Column:
    zero = F.char(F.lit(0))
    return F.concat(F.lit("sample-"), F.sha2(F.concat(source, zero, version, zero, path, zero, digest), 256))


def content_key(i: Column, q: Column) -> Column:
    """A key equal for bit-equal signals: negative zero differs from zero, as in their bytes."""
    return F.sha2(F.concat_ws("|", F.array_join(F.transform(i, lambda v: v.cast("string")), ","), F.array_join(F.transform(q, lambda v: v.cast("string")), ",")), 256)


def squared_distance(x: Column, y: Column) -> Column:
    return total(F.zip_with(x, y, lambda a, b: (a.cast("double") - b.cast("double")) * (a.cast("double") - b.cast("double"))))


def hann(n: int) -> list[float]:
    """The periodic Hann window."""
    return [0.5 - 0.5 * math.cos(2 * math.pi * k / n) for k in range(n)]


def frequency_axis(n: int, rate: float) -> list[float]:
    return [(k - n // 2) * rate / n for k in range(n)]
