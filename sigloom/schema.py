"""Schemas of signal tables, closed sets of names, and schema fingerprints."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Names that tables and settings may use.
REPRESENTATIONS = ("channels_first", "complex")
SOURCES = ("http", "local_file", "archive")
NORMALISATIONS = ("none", "train_rms_power", "train_peak_amplitude")
CROPS = ("start", "center", "end")
PADDINGS = ("left", "center", "right")
SPECTRAL_MODES = ("fft", "spectrogram")
WINDOWS = ("none", "hann")
SCALES = ("magnitude", "power", "log_power")
FEATURE_OUTPUTS = ("canonical_iq", "amplitude_phase", "spectral")
SPLITS = ("train", "validation", "test")

LABEL = T.StructType([T.StructField("kind", T.StringType()), T.StructField("value", T.StringType())])
SIGNAL = T.StructType(
    [
        T.StructField("row_index", T.LongType(), False),
        T.StructField("sample_id", T.StringType(), False),
        T.StructField("i", T.ArrayType(T.FloatType())),
        T.StructField("q", T.ArrayType(T.FloatType())),
        T.StructField("dtype", T.StringType()),
        T.StructField("representation", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("snr_db", T.DoubleType()),
        T.StructField("group_id", T.StringType()),
    ]
)


class ContractError(ValueError):
    """A table breaks its contract; ``code`` names the rule."""

    def __init__(self, code: str, message: str) -> None:
        super().__init__(f"{code}: {message}")
        self.code = code


def canonical_json(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=True, allow_nan=False)


def canonical_sha256(value: object) -> str:
    return hashlib.sha256(canonical_json(value).encode()).hexdigest()


def fingerprint(schema: T.StructType) -> str:
    """SHA-256 of the schema's canonical JSON: a changed definition has another fingerprint."""
    return canonical_sha256(schema.jsonValue())


#: Versions that tables may name, with the fingerprint of their definition.
REGISTERED: dict[str, str] = {"1.0": fingerprint(SIGNAL)}


def assert_registered(schema: T.StructType, version: str, registered: Mapping[str, str] = REGISTERED) -> None:
    if version not in registered:
        raise ContractError("schema.unsupported_version", version)
    if registered[version] != fingerprint(schema):
        raise ContractError("schema.version_bump_required", version)


#: Element types by dtype, and the complex dtype of two such numbers.
ELEMENTS = {"float32": T.FloatType, "float64": T.DoubleType}
PAIRED = {"float32": "complex64", "float64": "complex128"}


def assert_counts(samples: DataFrame, metadata: DataFrame) -> None:
    """As many metadata records as samples, and the same ids."""
    a, b = samples.count(), metadata.count()
    if a != b or not samples.select("sample_id").exceptAll(metadata.select("sample_id")).isEmpty():
        raise ContractError("metadata.count_mismatch", f"{a} samples, {b} records, or other ids")


def assert_batch(df: DataFrame, representation: str = "channels_first", dtype: str = "float32") -> DataFrame:
    """Checks a signal table: its columns' types, and in one aggregate rows, equal lengths, dtypes, ids, labels,
    finite SNR. The first broken rule raises.

    I and Q must be arrays of the ``dtype`` named (float32: float), and a ``dtype`` column, where there is one, must
    say the same of every row (``complex64`` for complex). A missing id, label or SNR column, or one of a type that
    holds no metadata, is ``metadata.invalid_item``; an SNR that is no number is ``metadata.invalid_number``."""
    if representation not in REPRESENTATIONS:
        raise ContractError("iq.invalid_representation", representation)
    if dtype not in ELEMENTS:
        raise ContractError("iq.invalid_dtype", dtype)
    types = {f.name: f.dataType for f in df.schema}
    for c in ("i", "q"):
        if not isinstance(types.get(c), T.ArrayType):
            raise ContractError("iq.not_ndarray", c)
        if not isinstance(types[c].elementType, ELEMENTS[dtype]):
            raise ContractError("iq.invalid_dtype", f"{c} holds {types[c].elementType.simpleString()}, not {dtype}")
    for c in ("sample_id", "label", "snr_db"):
        if not isinstance(types.get(c), T.AtomicType | T.NullType):
            raise ContractError("metadata.invalid_item", c)
    if isinstance(types["label"], T.BooleanType | T.FractionalType):
        raise ContractError("metadata.invalid_label", types["label"].simpleString())
    if not isinstance(types["snr_db"], T.NumericType | T.NullType):
        raise ContractError("metadata.invalid_number", types["snr_db"].simpleString())
    named = F.coalesce(F.col("dtype"), F.lit("")) if "dtype" in types else F.lit(dtype)
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("i").isNull() | F.col("q").isNull()).alias("none"),
        F.count_if(F.size("i") != F.size("q")).alias("uneven"),
        F.count_if(~named.isin(dtype, PAIRED[dtype] if representation == "complex" else dtype)).alias("other_dtype"),
        F.min(F.size("i")).alias("least"),
        F.max(F.size("i")).alias("most"),
        F.countDistinct("sample_id").alias("ids"),
        F.count_if(F.coalesce(F.trim("sample_id"), F.lit("")) == "").alias("blank_ids"),
        F.count_if(F.coalesce(F.trim("label"), F.lit("")) == "").alias("blank_labels"),
        F.count_if(F.isnan("snr_db") | (F.abs("snr_db") == float("inf"))).alias("odd_snr"),
    ).first()
    for code, bad in (
        ("iq.not_ndarray", row["none"]), ("iq.empty_batch_or_signal", not row["n"] or not row["least"]), ("iq.invalid_shape", row["uneven"] or row["least"] != row["most"]), ("iq.invalid_dtype", row["other_dtype"]), ("metadata.invalid_string", row["blank_ids"]),
        ("metadata.duplicate_sample_id", row["ids"] != row["n"]), ("metadata.invalid_label", row["blank_labels"]), ("metadata.non_finite_number", row["odd_snr"]),
    ):
        if bad:
            raise ContractError(code, f"{bad}")
    return df
