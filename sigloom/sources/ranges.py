"""Arrays read by ranges of rows, and single samples by a stored index.

The first pass reads headers only: where an array's bytes begin, its type and shape. Ranges of at most
``range_bytes`` become rows, are cut to the rows asked for, dealt out to tasks, and read each by
one seek, so that no file is ever one row or one task. Files are listed by Spark, and read by Arrow's file
systems; an array that is compressed inside its NPZ has no ranges, and raises."""

from __future__ import annotations

import ast
import io
import math
import struct
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom.functions.ragged import lists_of
from sigloom.sources.files import SourceError

RANGE_BYTES = 16 << 20
RANGES = "path string, kind string, shape array<bigint>, at long, first long, rows long"
ROWS = "path string, pos long, i array<float>, q array<float>, dtype string, representation string"


class _Seekable(io.RawIOBase):
    """An Arrow file with Python's rules for seeking."""

    def __init__(self, file: pa.NativeFile) -> None:
        self.file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def readinto(self, into: memoryview) -> int:
        data = self.file.read(len(into))
        into[: len(data)] = data
        return len(data)

    def tell(self) -> int:
        return self.file.tell()

    def seek(self, offset: int, whence: int = 0) -> int:
        at = offset + {0: 0, 1: self.file.tell(), 2: self.file.size()}[whence]
        if at < 0:
            raise OSError(f"no place {at}")
        self.file.seek(at)
        return at

    def close(self) -> None:
        self.file.close()
        super().close()


def opened(path: str) -> io.BufferedReader:
    """A file that can seek, by the path that Spark lists it under."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    system, name = fs.FileSystem.from_uri(path)
    return io.BufferedReader(_Seekable(system.open_input_file(name)), 1 << 16)


def listed(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, length) of the files under a path; no content is read."""
    source = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return (source.option("pathGlobFilter", glob) if glob else source).load(path).select("path", "length")


def npy_header(stream: io.BufferedReader) -> tuple[np.dtype, tuple[int, ...], int]:
    """(type, shape, bytes of the header), of an array in C order without objects."""
    start = stream.tell()
    head = stream.read(8)
    if head[:6] != b"\x93NUMPY":
        raise SourceError("no array file")
    size, = struct.unpack("<H" if head[6] == 1 else "<I", stream.read(2 if head[6] == 1 else 4))
    held = ast.literal_eval(stream.read(size).decode("latin-1" if head[6] < 3 else "utf-8"))
    kind = np.dtype(held["descr"])
    if held["fortran_order"] or kind.hasobject or not held["shape"]:
        raise SourceError("arrays must be in C order, with rows, without objects")
    return kind, tuple(held["shape"]), stream.tell() - start


def stored_member(stream: io.BufferedReader, name: str) -> int:
    """Where the bytes of an uncompressed member of a ZIP begin."""
    with zipfile.ZipFile(stream) as archive:
        info = archive.getinfo(name)
    if info.compress_type != zipfile.ZIP_STORED or info.flag_bits & 1:
        raise SourceError(f"{name} is compressed or encrypted, and has no ranges")
    stream.seek(info.header_offset + 26)
    names, more = struct.unpack("<HH", stream.read(4))
    return info.header_offset + 30 + names + more


def array_ranges(spark: SparkSession, path: str, member: str | None = None, glob: str | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, kind, shape, at, first, rows): the ranges of the arrays under a path, from their headers.
    ``member`` names an array in NPZ files (``samples.npy``)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with opened(name) as stream:
                    begin = stored_member(stream, member) if member else 0
                    stream.seek(begin)
                    kind, shape, head = npy_header(stream)
                width = kind.itemsize * math.prod(shape[1:])
                step = max(1, range_bytes // max(1, width))
                for a in range(0, shape[0], step * 4096):
                    firsts = np.arange(a, min(shape[0], a + step * 4096), step, dtype=np.int64)
                    n = len(firsts)
                    columns = [pa.array([name] * n), pa.array([kind.str] * n), pa.array([list(shape)] * n, pa.list_(pa.int64())), pa.array(begin + head + firsts * width), pa.array(firsts), pa.array(np.minimum(step, shape[0] - firsts))]
                    yield pa.RecordBatch.from_arrays(columns, names=["path", "kind", "shape", "at", "first", "rows"])

    return listed(spark, path, glob).select("path").mapInArrow(rows, RANGES)


def read_array_rows(spark: SparkSession, path: str, first: int = 0, end: int | None = None, member: str | None = None, glob: str | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, pos, i, q, dtype, representation): rows first .. end of each array under a path, of
    [N, 2, L] floats or [N, L] complex numbers. Only the bytes of these rows are read."""
    if first < 0 or (end is not None and end < first):
        raise SourceError(f"no range: {first} .. {end}")
    ranges = array_ranges(spark, path, member, glob, range_bytes).where(F.col("first") + F.col("rows") > first)
    if end is not None:
        ranges = ranges.where(F.col("first") < end)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                kind, shape = np.dtype(r["kind"]), r["shape"]
                a, b = max(r["first"], first), r["first"] + r["rows"]
                b = b if end is None else min(b, end)
                width = kind.itemsize * math.prod(shape[1:])
                with opened(r["path"]) as stream:
                    stream.seek(r["at"] + (a - r["first"]) * width)
                    data = stream.read((b - a) * width)
                if len(data) != (b - a) * width:
                    raise SourceError(f"{r['path']} ends early")
                x = np.frombuffer(data, kind).reshape(b - a, *shape[1:])
                if np.iscomplexobj(x) and x.ndim == 2:
                    parts, name = (x.real, x.imag), "complex"
                elif x.ndim == 3 and x.shape[1] == 2 and not np.iscomplexobj(x):
                    parts, name = (x[:, 0], x[:, 1]), "channels_first"
                else:
                    raise SourceError(f"samples of shape {shape} and type {kind}")
                for k in range(0, b - a, 1024):
                    own = [p[k : k + 1024].astype(np.float32) for p in parts]
                    n = len(own[0])
                    every = [np.arange(n)]
                    columns = [pa.array([r["path"]] * n), pa.array(np.arange(a + k, a + k + n)), lists_of(every, own[:1], pa.float32()), lists_of(every, own[1:], pa.float32()), pa.array([str(kind)] * n), pa.array([name] * n)]
                    yield pa.RecordBatch.from_arrays(columns, names=["path", "pos", "i", "q", "dtype", "representation"])

    return ranges.repartition("path", "first").mapInArrow(rows, ROWS)


INDEX = "path string, first long, rows long"


def write_index(spark: SparkSession, path: str, out: str, member: str | None = None, glob: str | None = None) -> DataFrame:
    """Publishes (path, first, rows): the place of each file's rows among those of all files in
    order of their paths, from headers only."""
    from sigloom.operators.eda import block_offsets
    from sigloom.sources.publish import publish

    counts = array_ranges(spark, path, member, glob).groupBy("path").agg(F.sum("rows").alias("rows"))
    publish(block_offsets(counts, n="rows", order="path").select("path", "first", "rows"), out)
    return spark.read.parquet(out)


def read_sample(spark: SparkSession, index: str, n: int, member: str | None = None) -> dict | None:
    """Row n of all, or None: the index says which file has it, and of that file only the row is read."""
    held = spark.read.parquet(index).where((F.col("first") <= n) & (F.col("first") + F.col("rows") > n)).first()
    if held is None:
        return None
    at = n - held["first"]
    return read_array_rows(spark, held["path"], at, at + 1, member).first().asDict() | {"row_index": n}
