"""Immutable tables: written aside, committed by one rename, verified ever after.

A table is written to a hidden folder beside its place, with a manifest of its content, and renamed
when whole. So a folder in its place is either whole or was never published; what an aborted write left
behind is hidden, never read, and named by ``leftovers``."""

from __future__ import annotations

import json
import uuid

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "_manifest.json"


class MutationError(RuntimeError):
    """A published table would change, or what lies in its place was not published."""


def content_hash(df: DataFrame) -> dict[str, object]:
    """Row count and order-free digests of the rows' hashes: sums of two 64-bit halves. Parquet
    bytes may differ between writers; this does not."""
    code = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)
    half = lambda a: F.conv(F.substring(code, a, 15), 16, 10).cast("decimal(38,0)")
    row = df.select(half(1).alias("a"), half(16).alias("b")).agg(F.count(F.lit(1)).alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    return {"rows": row["n"], "digest": f"{int(row['a'] or 0):x}-{int(row['b'] or 0):x}"}


class Place:
    """A path of a file system that Spark knows."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, jvm = spark, spark.sparkContext._jvm
        self.path = jvm.org.apache.hadoop.fs.Path(path)
        self.files = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def sibling(self, name: str) -> str:
        parent = self.path.getParent()
        return f"{parent.toString()}/{name}" if parent is not None else name

    def exists(self, name: str | None = None) -> bool:
        return self.files.exists(self.path if name is None else self._child(name))

    def _child(self, name: str) -> JavaObject:
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path, name)

    def write(self, name: str, text: str) -> None:
        stream = self.files.create(self._child(name), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def read(self, name: str) -> str:
        stream = self.files.open(self._child(name))
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def rename(self, target: Place) -> bool:
        """One step; False where the target is there already, which a plain rename would move this into."""
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        rule = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        rules = gateway.new_array(rule, 1)
        rules[0] = rule.NONE
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.files.getUri(), conf).rename(self.files.makeQualified(self.path), self.files.makeQualified(target.path), rules)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def delete(self) -> None:
        self.files.delete(self.path, True)


def _pattern(place: Place) -> str:
    return f".{place.path.getName()}.writing-"


def leftovers(spark: SparkSession, path: str) -> list[str]:
    """Folders that aborted writes of this table left behind, and nobody reads."""
    place = Place(spark, path)
    parent = place.path.getParent()
    if parent is None or not place.files.exists(parent):
        return []
    return sorted(s.getPath().toString() for s in place.files.listStatus(parent) if s.getPath().getName().startswith(_pattern(place)))


def clear_leftovers(spark: SparkSession, path: str) -> int:
    """Deletes them. Call it only while nobody else writes the table."""
    found = leftovers(spark, path)
    for x in found:
        Place(spark, x).delete()
    return len(found)


def held_manifest(spark: SparkSession, path: str) -> dict[str, object]:
    """The manifest of a published table; one without it was not published, or not whole."""
    place = Place(spark, path)
    if not place.exists(MANIFEST):
        raise MutationError(f"{path} is no published table")
    return json.loads(place.read(MANIFEST))


def publish(df: DataFrame, path: str) -> str:
    """Writes the table where none is (``created``); an equal one is ``reused``, another raises. Of several
    writers at once the first to rename wins, and the others compare with it."""
    spark = df.sparkSession
    place = Place(spark, path)
    if place.exists():
        return _compare(spark, path, sorted(df.columns), content_hash(df))
    aside = Place(spark, place.sibling(f"{_pattern(place)}{uuid.uuid4().hex}"))
    df.write.parquet(aside.path.toString())
    written = content_hash(spark.read.schema(df.schema).parquet(aside.path.toString()))
    aside.write(MANIFEST, json.dumps({"columns": sorted(df.columns), "content": written}, sort_keys=True))
    if not place.exists() and aside.rename(place):
        return "created"
    aside.delete()
    return _compare(spark, path, sorted(df.columns), written)


def _compare(spark: SparkSession, path: str, columns: list[str], content: dict[str, object]) -> str:
    held = held_manifest(spark, path)
    if held["columns"] != columns or held["content"] != content:
        raise MutationError(path)
    return "reused"


def verify(spark: SparkSession, path: str) -> None:
    """Reads a published table whole, and raises where it is not what its manifest says."""
    held, table = held_manifest(spark, path), spark.read.parquet(path)
    if held["columns"] != sorted(table.columns) or held["content"] != content_hash(table):
        raise MutationError(f"{path} differs from its manifest")
