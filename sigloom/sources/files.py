"""Signal files as DataFrames: Spark reads the bytes, one task a file, and rows come out.

A file must fit one task's memory, and Spark's limit of 2 GB a binary row; larger sets come
as many files, or as Parquet, which is this library's own form."""

from __future__ import annotations

import io
import json
import pickle
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS = "path string, pos long, sample_id string, i array<float>, q array<float>, dtype string, representation string, label string, snr_db double, group_id string"
NAMES = [x.strip().split()[0] for x in ROWS.split(",")]
REQUIRED = ("samples", "sample_ids", "labels", "snr_db", "group_ids")


class SourceError(ValueError):
    """A file is not of the form asked for."""


def _parts(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray, str]:
    """I, Q and the representation's name of [N, 2, L] floats or [N, L] complex numbers."""
    if np.iscomplexobj(samples) and samples.ndim == 2:
        return samples.real.astype(np.float32), samples.imag.astype(np.float32), "complex"
    if samples.ndim == 3 and samples.shape[1] == 2:
        return samples[:, 0].astype(np.float32), samples[:, 1].astype(np.float32), "channels_first"
    raise SourceError(f"samples of shape {samples.shape} and type {samples.dtype}")


def _batch(path: str, samples: np.ndarray, ids: Sequence[str], labels: Sequence[object], snr: Sequence[float | None], groups: Sequence[str | None]) -> pa.RecordBatch:
    i, q, kind = _parts(samples)
    n = len(i)
    if not all(len(x) == n for x in (ids, labels, snr, groups)):
        raise SourceError(f"{path}: {n} samples, but other counts of metadata")
    values = [None if s is None or s != s else float(s) for s in snr]
    columns = [[path] * n, range(n), [str(x) for x in ids], list(i), list(q), [str(samples.dtype)] * n, [kind] * n, [str(x) for x in labels], values, [None if g is None else str(g) for g in groups]]
    types = [pa.string(), pa.int64(), pa.string(), pa.list_(pa.float32()), pa.list_(pa.float32()), pa.string(), pa.string(), pa.string(), pa.float64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=NAMES)


def _npz(path: str, content: bytes) -> pa.RecordBatch:
    with np.load(io.BytesIO(content), allow_pickle=False) as bundle:
        if missing := [k for k in REQUIRED if k not in bundle]:
            raise SourceError(f"{path}: no {', '.join(missing)}")
        return _batch(path, *(bundle[k] for k in REQUIRED))


def _json(path: str, content: bytes) -> pa.RecordBatch:
    document = json.loads(content)
    meta = document["metadata"]
    samples = np.asarray(document["samples"], np.float32)
    return _batch(path, samples, *([m.get(k) for m in meta] for k in ("sample_id", "label", "snr_db", "group_id")))


def _hdf5(path: str, content: bytes) -> pa.RecordBatch:
    try:
        import h5py
    except ImportError as error:
        raise SourceError("HDF5 files need the h5py package") from error
    with h5py.File(io.BytesIO(content), "r") as store:
        x, labels, snr = store["X"][...], store["Y"][...].argmax(1), store["Z"][...].reshape(-1)
        return _batch(path, np.ascontiguousarray(x.transpose(0, 2, 1)), [f"{path}#{k}" for k in range(len(x))], labels, snr, [None] * len(x))


def _pickle(path: str, content: bytes) -> pa.RecordBatch:
    blocks = pickle.loads(content, encoding="latin1")  # noqa: S301  only after allow_unsafe_pickle
    keys = sorted(blocks, key=str)
    samples = np.concatenate([blocks[k] for k in keys])
    labels = [k[0] for k in keys for _ in blocks[k]]
    snr = [float(k[1]) for k in keys for _ in blocks[k]]
    return _batch(path, samples, [f"{path}#{k}" for k in range(len(samples))], labels, snr, [None] * len(samples))


def _npy(path: str, content: bytes) -> pa.RecordBatch:
    sample = np.load(io.BytesIO(content), allow_pickle=False)
    return _batch(path, sample[None], [path.rsplit("/", 1)[-1]], [""], [None], [None])


READERS: dict[str, Callable[[str, bytes], pa.RecordBatch]] = {"npz": _npz, "json": _json, "hdf5": _hdf5, "pickle": _pickle, "npy": _npy}


def read_signals(spark: SparkSession, path: str, form: str, allow_unsafe_pickle: bool = False, glob: str | None = None) -> DataFrame:
    """The signal rows of all files under a path, with their file and place in it. With ``glob``, of
    the files in all folders below whose names match."""
    if form not in READERS:
        raise SourceError(f"unknown form {form!r}")
    if form == "pickle" and not allow_unsafe_pickle:
        raise SourceError("pickle files run code; allow_unsafe_pickle must be set")
    reader = READERS[form]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                whole = reader(batch.column(0)[r].as_py(), batch.column(1)[r].as_py())
                for a in range(0, whole.num_rows, 1024):
                    yield whole.slice(a, 1024)

    source = spark.read.format("binaryFile")
    if glob is not None:
        source = source.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    return source.load(path).select("path", "content").mapInArrow(rows, ROWS)


def with_row_index(df: DataFrame) -> DataFrame:
    """``row_index`` in the order of files and places: counts by file give the offsets."""
    from sigloom.operators.eda import block_offsets

    counts = df.groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    first = block_offsets(counts, order="path").select("path", "first")
    return df.join(first, "path").withColumn("row_index", F.col("first") + F.col("pos")).drop("first", "pos", "path")


def npy_signals(spark: SparkSession, path: str) -> DataFrame:
    """Signals of the .npy files under a path, each with the label, SNR and group of the .json file
    of the same name beside it, where there is one. A sidecar that is no JSON object raises."""
    folder = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    arrays = read_signals(spark, path, "npy", glob="*.npy")
    texts = folder.option("pathGlobFilter", "*.json").load(path).select("path", F.col("content").cast("string").alias("text"))
    meta = F.from_json("text", "label string, snr_db double, group_id string")
    checked = F.when(F.startswith(F.ltrim("text"), F.lit("{")), meta).otherwise(F.raise_error(F.concat(F.lit("no JSON object: "), F.col("path"))))
    sidecars = texts.select(_stem("path").alias("stem"), checked.alias("m"))
    snr = F.col("m.snr_db")
    finite = F.when(~F.isnan(snr) & (F.abs(snr) < float("inf")), snr)
    joined = arrays.withColumn("stem", _stem("path")).join(sidecars, "stem", "left")
    return joined.withColumns({"label": F.coalesce("m.label", "label"), "snr_db": finite, "group_id": F.col("m.group_id")}).select(*NAMES)


def _stem(path: str) -> Column:
    return F.regexp_replace(path, r"\.[^./]*$", "")


def first_file(spark: SparkSession, path: str, patterns: Sequence[str]) -> str:
    """The least path of the first pattern that any file under ``path`` has."""
    for pattern in patterns:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
        if (found := files.agg(F.min("path")).first()[0]) is not None:
            return found
    raise SourceError(f"no file under {path} is named {' or '.join(patterns)}")


#: Names of detection labels 0 to 11.
DETECTION_LABELS = ("car", "large_vehicle", "truck", "bus", "train", "bicycle", "motorized_two_wheeler", "pedestrian", "pedestrian_group", "animal", "other", "static")

#: Fixed value: the id of what belongs to no track.
NO_TRACK = "00000000-0000-0000-0000-000000000000"


def detections(df: DataFrame) -> DataFrame:
    """Detection rows with ``label`` by ``label_id`` (null outside the map) and ``group_id``, the track
    (null where blank or NO_TRACK). Columns that the table lacks count as null."""
    held = lambda c: F.col(c) if c in df.columns else F.lit(None)
    names = F.array(*[F.lit(x) for x in DETECTION_LABELS])
    track = F.trim(held("track_id").cast("string"))
    return df.withColumns({"label": F.get(names, held("label_id").cast("int")), "group_id": F.when(~track.isin("", NO_TRACK), track)})
