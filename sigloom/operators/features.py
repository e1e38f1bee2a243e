"""Canonical tensors, amplitude and phase, spectra; and the pipeline of all three.

Spectra come as numpy FFTs of Arrow batches: Spark has no such function. All else is Columns."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.functions.ragged import by_length
from sigloom.functions.signal import crop, hann, pad, phase
from sigloom.operators.preprocessing import Preprocessor
from sigloom.schema import CROPS, FEATURE_OUTPUTS, PADDINGS, REPRESENTATIONS, SCALES, SPECTRAL_MODES, WINDOWS, canonical_sha256


#: Values of a batch of spectra.
VALUES = 1 << 20


class FeatureError(ValueError):
    """Feature settings are not valid."""


@dataclass(frozen=True)
class CanonicalConfig:
    length: int
    crop: str = "center"
    padding: str = "right"
    padding_value: float = 0.0

    def __post_init__(self) -> None:
        if self.length <= 0 or self.crop not in CROPS or self.padding not in PADDINGS:
            raise FeatureError(str(self))


@dataclass(frozen=True)
class SpectralConfig:
    mode: str = "fft"
    n_fft: int = 32
    overlap: int = 0
    window: str = "none"
    scale: str = "power"
    epsilon: float = 1e-12
    sample_rate: float = 1.0

    def __post_init__(self) -> None:
        if self.mode not in SPECTRAL_MODES or self.window not in WINDOWS or self.scale not in SCALES:
            raise FeatureError(str(self))
        if self.n_fft <= 0 or not 0 <= self.overlap < self.n_fft or self.epsilon <= 0 or self.sample_rate <= 0:
            raise FeatureError(str(self))


def canonical(df: DataFrame, config: CanonicalConfig) -> DataFrame:
    """i and q cropped and padded to one length, and ``valid_mask``."""
    n, value = config.length, F.lit(config.padding_value).cast("float")
    kept = crop(F.col("i"), n, config.crop)
    mask = pad(F.transform(kept, lambda v: F.lit(True)), n, config.padding, F.lit(False))
    return df.withColumns({"i": pad(kept, n, config.padding, value), "q": pad(crop(F.col("q"), n, config.crop), n, config.padding, value), "valid_mask": mask})


def masked(df: DataFrame) -> DataFrame:
    """i and q with zero where the mask is false, so that padding values reach no feature."""
    zero = lambda c: F.zip_with(F.col(c), F.col("valid_mask"), lambda v, m: F.when(m, v).otherwise(F.lit(0.0).cast("float")))
    return df.withColumns({"i": zero("i"), "q": zero("q")})


def amplitude_phase(df: DataFrame, epsilon: float = 1e-12, fill: float = 0.0) -> DataFrame:
    """amplitude, phase and phase_valid_mask: phases hold where amplitude is above epsilon."""
    points = F.transform(F.arrays_zip(F.col("i"), F.col("q"), F.col("valid_mask")), lambda v: F.struct(F.when(v["valid_mask"], F.hypot(v["i"], v["q"])).otherwise(0.0).alias("a"), phase(v["i"], v["q"]).alias("p"), v["valid_mask"].alias("m")))
    with_points = df.withColumn("_points", points)
    valid = lambda v: v["m"] & (v["a"] > epsilon)
    return with_points.withColumns(
        {
            "amplitude": F.transform("_points", lambda v: v["a"].cast("float")),
            "phase": F.transform("_points", lambda v: F.when(valid(v), v["p"]).otherwise(F.lit(fill)).cast("float")),
            "phase_valid_mask": F.transform("_points", valid),
        }
    ).drop("_points")


def scaled(spectrum: np.ndarray, scale: str, epsilon: float) -> np.ndarray:
    magnitude = np.abs(spectrum)
    if scale == "magnitude":
        return magnitude
    power = magnitude * magnitude
    return power if scale == "power" else 10 * np.log10(np.maximum(power, epsilon))


def spectra(df: DataFrame, config: SpectralConfig, keep: str = "sample_id", single: bool = True) -> DataFrame:
    """(keep, k, frame, value): one row a frequency bin, shifted so that frequencies ascend, and
    frame. ``fft`` has one frame, zero-padded to n_fft; ``spectrogram`` frames start every
    n_fft - overlap samples, and a short tail is left out."""
    n, hop = config.n_fft, config.n_fft - config.overlap
    fft = config.mode == "fft"
    complex_type, real_type = (np.complex64, np.float32) if single else (np.complex128, np.float64)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, (i, q) in by_length(batch.column(1), batch.column(2)):
                x, length = (i.astype(real_type) + 1j * q.astype(real_type)).astype(complex_type), i.shape[1]
                if fft and length > n or not fft and length < n:
                    raise FeatureError(f"{length} samples for n_fft {n}")
                size = length if fft else n
                w = np.asarray(hann(size) if config.window == "hann" else np.ones(size), real_type)
                frames = (x * w)[:, None, :] if fft else np.lib.stride_tricks.sliding_window_view(x, n, axis=1)[:, ::hop] * w
                step = max(1, VALUES // max(1, frames.shape[1] * n))
                for a in range(0, len(at), step):  # all rows of one length at once, up to VALUES values
                    values = scaled(np.fft.fftshift(np.fft.fft(frames[a : a + step], n, axis=2), axes=2), config.scale, config.epsilon).astype(real_type)
                    rows_, per = values.shape[0], values.shape[1]
                    ids = batch.column(0).take(pa.array(np.repeat(at[a : a + step], per * n)))
                    yield pa.RecordBatch.from_arrays([ids, pa.array(np.tile(np.arange(n, dtype=np.int32), rows_ * per)), pa.array(np.tile(np.repeat(np.arange(per, dtype=np.int32), n), rows_)), pa.array(values.reshape(-1).astype(np.float64))], names=["id", "k", "frame", "value"])

    source = df.select(F.col(keep).cast("string").alias("id"), "i", "q")
    return source.mapInArrow(rows, "id string, k int, frame int, value double").withColumnRenamed("id", keep)


def frequency_axes(df: DataFrame, rate: float) -> DataFrame:
    """(signal_length, k, frequency, hann): of each length that signals have, the frequencies of a transform of that length,
    ascending, and the periodic Hann window over it."""
    lengths = df.select(F.size("i").alias("signal_length")).where("signal_length > 0").distinct()
    k, n = F.col("k"), F.col("signal_length")
    rows = lengths.withColumn("k", F.explode(F.sequence(F.lit(0), n - 1)))
    return rows.select("signal_length", "k", ((k - F.floor(n / 2)) * rate / n).alias("frequency"), (0.5 - 0.5 * F.cos(2 * math.pi * k / n)).alias("hann"))


def frame_starts(df: DataFrame, config: SpectralConfig) -> DataFrame:
    """(signal_length, frame, start): where the frames of signals of each length begin, in seconds. ``fft`` has
    one frame at 0; lengths that ``spectra`` rejects have none."""
    lengths = df.select(F.size("i").alias("signal_length")).where("signal_length > 0").distinct()
    n, hop = F.col("signal_length"), config.n_fft - config.overlap
    if config.mode == "fft":
        return lengths.where(n <= config.n_fft).select("signal_length", F.lit(0).alias("frame"), F.lit(0.0).alias("start"))
    frames = F.sequence(F.lit(0), F.floor((n - config.n_fft) / hop).cast("int"))
    rows = lengths.where(n >= config.n_fft).withColumn("frame", F.explode(frames))
    return rows.select("signal_length", "frame", (F.col("frame") * hop / config.sample_rate).alias("start"))


def eda_spectra(df: DataFrame, limit: int) -> DataFrame:
    """(sample_id, k, power): |fft|^2 / length in double, without a window, of the first ``limit`` ids."""
    first = df.orderBy("sample_id").limit(limit)
    size = df.select(F.max(F.size("i"))).first()[0]
    return spectra(first, SpectralConfig(n_fft=size), single=False).select("sample_id", "k", (F.col("value") / size).alias("power"))


@dataclass(frozen=True)
class FeaturePipeline:
    """Preprocess, canonicalise, then the chosen output: the same call in training and inference."""

    preprocessor: Preprocessor
    canonical: CanonicalConfig
    output: str = "canonical_iq"
    spectral: SpectralConfig | None = None
    epsilon: float = 1e-12
    representation: str = "channels_first"
    single: bool = True  # spectra in single precision, as models take them

    def __post_init__(self) -> None:
        if self.representation not in REPRESENTATIONS:
            raise FeatureError(self.representation)
        if self.output not in FEATURE_OUTPUTS or (self.output == "spectral") != (self.spectral is not None):
            raise FeatureError(self.output)

    def sha256(self) -> str:
        return canonical_sha256(asdict(self))

    def transform(self, df: DataFrame) -> DataFrame:
        if "representation" in df.columns:  # a row of another one fails where it is read
            other = F.concat(F.lit("representation "), F.coalesce("representation", F.lit("null")), F.lit(f", not {self.representation}"))
            df = df.withColumn("i", F.when(F.col("representation").eqNullSafe(F.lit(self.representation)), F.col("i")).otherwise(F.raise_error(other)))
        out = canonical(self.preprocessor.transform(df), self.canonical)
        if self.output == "amplitude_phase":
            return amplitude_phase(out, self.epsilon)
        return spectra(masked(out), self.spectral, single=self.single) if self.output == "spectral" else out
