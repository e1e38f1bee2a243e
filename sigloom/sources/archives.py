"""Archives, staged file sets and manifests.

Spark lists archives; a first pass indexes their members, a second reads them by ranges."""

from __future__ import annotations

import hashlib
import struct
import tarfile
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from itertools import islice
from pathlib import PurePosixPath
from typing import BinaryIO, NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom.functions.signal import sample_key
from sigloom.sources.publish import content_hash, publish
from sigloom.sources.ranges import listed, opened

RESERVED = "manifest.json"


class IngestionError(ValueError):
    """An archive must not be ingested."""


def safe_path(name: str) -> str:
    path = PurePosixPath(name)
    if not name.strip() or path.is_absolute() or ".." in path.parts or "\\" in name or ":" in (path.parts or ("",))[0]:
        raise IngestionError(f"unsafe member {name!r}")
    if str(path).casefold() == RESERVED:
        raise IngestionError(f"reserved member {name!r}")
    return str(path)


class Member(NamedTuple):
    """Where a member's bytes lie: offset and length of what is stored, and how."""

    name: str
    at: int
    stored: int
    size: int
    method: str  # stored, deflated, or stream for members of a compressed TAR
    crc: int | None


def archive_members(stream: BinaryIO) -> Iterator[Member]:
    """The regular members, from a ZIP's central directory or a TAR's headers; contents are not read. Links,
    devices, encrypted members, unsafe names and unknown compression raise."""
    if zipfile.is_zipfile(stream):
        with zipfile.ZipFile(stream) as archive:
            infos = archive.infolist()
        for info in infos:
            if info.flag_bits & 1:
                raise IngestionError(f"encrypted member {info.filename!r}")
            if (info.external_attr >> 16) & 0o170000 == 0o120000:
                raise IngestionError(f"link {info.filename!r}")
            if info.is_dir():
                continue
            if info.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
                raise IngestionError(f"compression {info.compress_type} of {info.filename!r}")
            stream.seek(info.header_offset + 26)
            names, more = struct.unpack("<HH", stream.read(4))
            method = "stored" if info.compress_type == zipfile.ZIP_STORED else "deflated"
            yield Member(safe_path(info.filename), info.header_offset + 30 + names + more, info.compress_size, info.file_size, method, info.CRC)
        return
    stream.seek(0)
    plain = stream.read(2) != b"\x1f\x8b"
    stream.seek(0)
    try:
        archive = tarfile.open(fileobj=stream, mode="r:" if plain else "r:*")
    except tarfile.TarError:
        stream.seek(0)
        plain = False
        try:
            archive = tarfile.open(fileobj=stream)
        except tarfile.TarError as error:
            raise IngestionError("neither ZIP nor TAR") from error
    with archive:
        for member in archive:
            if member.isdir():
                continue
            if not member.isreg() or member.sparse is not None:
                raise IngestionError(f"no regular member {member.name!r}")
            yield Member(safe_path(member.name), member.offset_data, member.size, member.size, "stored" if plain else "stream", None)


def read_member(stream: BinaryIO, m: Member) -> bytes:
    """A member's bytes, by one seek."""
    stream.seek(m.at)
    data = stream.read(m.stored)
    if m.method == "deflated":
        data = zlib.decompress(data, -15)
    if len(data) != m.size or (m.crc is not None and zlib.crc32(data) != m.crc):
        raise IngestionError(f"{m.name!r} is damaged")
    return data


INDEX = "archive string, path string, at long, stored long, size long, method string, crc long"


def member_index(spark: SparkSession, path: str) -> DataFrame:
    """(archive, path, at, stored, size, method, crc): the members of the archives under a path, from
    directories and headers only."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with opened(name) as stream:
                    found = archive_members(stream)
                    while part := list(islice(found, 4096)):
                        columns = [[name] * len(part), *zip(*part, strict=True)]
                        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
                        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["archive", "path", "at", "stored", "size", "method", "crc"])

    return listed(spark, path).select("path").mapInArrow(rows, INDEX)


def read_archives(spark: SparkSession, path: str, source_id: str, version: str) -> DataFrame:
    """(archive, path, folded, size, sha256, content, sample_id): one row a member. Members are dealt out to
    tasks by their place, and read by ranges, so that an archive is never one row or one task; those of a
    compressed TAR, which has no ranges, stay together and are read in one pass."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                with opened(r["archive"]) as stream:
                    if r["method"] == "stream":
                        with tarfile.open(fileobj=stream) as archive:
                            for member in archive:
                                if member.isreg():
                                    yield row(r["archive"], safe_path(member.name), archive.extractfile(member).read())
                        continue
                    yield row(r["archive"], r["path"], read_member(stream, Member(r["path"], r["at"], r["stored"], r["size"], r["method"], r["crc"])))

    def row(archive: str, name: str, data: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([archive]), pa.array([name]), pa.array([name.casefold()]), pa.array([len(data)], pa.int64()), pa.array([hashlib.sha256(data).hexdigest()]), pa.array([data], pa.binary())], names=["archive", "path", "folded", "size", "sha256", "content"])

    index = member_index(spark, path)
    streams = index.where("method = 'stream'").select("archive", "method").distinct()
    dealt = index.where("method <> 'stream'").unionByName(streams, allowMissingColumns=True).repartition("archive", "at")
    members = dealt.mapInArrow(rows, "archive string, path string, folded string, size long, sha256 string, content binary")
    key = sample_key(F.lit(source_id), F.lit(version), F.col("path"), F.col("sha256"))
    return members.withColumn("sample_id", key)


def colliding_paths(members: DataFrame) -> DataFrame:
    """Paths of one archive that differ at most in case."""
    return members.groupBy("archive", "folded").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def stage_differences(expected: DataFrame, found: DataFrame, compare: Sequence[str], key: str = "path") -> DataFrame:
    """(path, problem): missing, unexpected or changed, by one full outer join."""
    e = expected.select(F.col(key).alias("e"), F.struct(*compare).alias("e_row"))
    f = found.select(F.col(key).alias("f"), F.struct(*compare).alias("f_row"))
    problem = F.when(F.col("e").isNull(), "unexpected").when(F.col("f").isNull(), "missing").when(~F.col("e_row").eqNullSafe(F.col("f_row")), "changed")
    return e.join(f, F.col("e") == F.col("f"), "full_outer").select(F.coalesce("e", "f").alias(key), problem.alias("problem")).where("problem is not null")


def ingest(spark: SparkSession, path: str, source_id: str, version: str, out: str) -> dict[str, object]:
    """Publishes the members of archives as an immutable table, and says what it holds. No member at
    all, and paths of one archive that differ at most in case, raise."""
    members = read_archives(spark, path, source_id, version)
    if (clash := colliding_paths(members).first()) is not None:
        raise IngestionError(f"members of {clash['archive']} collide at {clash['folded']!r}")
    if members.first() is None:
        raise IngestionError(f"{path} holds no file")
    status = publish(members, out)
    return {"schema_version": "1.0", "source_id": source_id, "source_version": version, "status": status, "members": content_hash(spark.read.parquet(out).drop("archive"))}


def verify_ingested(spark: SparkSession, path: str, source_id: str, version: str, out: str) -> DataFrame:
    """(path, problem) where an ingested table differs from what its archives hold now."""
    facts = ["path", "size", "sha256", "sample_id"]
    held = spark.read.parquet(out).select(*facts, F.sha2("content", 256).alias("content_sha256"))
    fresh = read_archives(spark, path, source_id, version).select(*facts, F.col("sha256").alias("content_sha256"))
    return stage_differences(fresh, held, ["size", "sha256", "sample_id", "content_sha256"])
