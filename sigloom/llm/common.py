"""What several operators share: the shared folder, prefix sums, word and hash rules."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The white space that parts words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"

BLANK_BYTES = b" \t\n\v\f\r"
BLANK = re.compile(rb"[\x20\x09-\x0D]")
#: Bytes of a long text that are worked on at once.
WINDOW = 1 << 20

#: Used only where the session names no checkpoint folder, as in tests on one machine.
LOCAL_CHECKPOINTS = "/tmp/checkpoints/sigloom"

#: Keys that may be broadcast for being hot, at most.
HOT_KEYS = 4096
#: Rows that a task holds as Python objects at once.
BATCH = 1024
#: Rows of keys (a few numbers each) that may be broadcast, at most: about 64 MB.
MAX_KEYS = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``; on one machine,
    where it is unset, a folder of our own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = LOCAL_CHECKPOINTS
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(root)
    return root


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Writes df as a Parquet table in the shared folder and reads it back: lineage ends
    here, so a lost executor costs no recomputation of what came before."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """A checkpoint in the shared folder, for small tables of iterative work."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def join_skewed(rows: DataFrame, table: DataFrame, on: Sequence[str], weight: str, total: int) -> DataFrame:
    """rows joined with a stored table of one row a key, whose column ``weight`` says how many of
    the ``total`` rows have the key. Keys of more than total / HOT_KEYS rows are broadcast, which are
    fewer than HOT_KEYS narrow rows at any size; the others are shuffled, and none fills a task."""
    names = list(on)
    if total <= HOT_KEYS or table.count() <= HOT_KEYS:
        return rows.join(F.broadcast(table), names)
    is_hot = F.col(weight) * HOT_KEYS > total
    hot = table.where(is_hot)
    if hot.isEmpty():
        return rows.join(table.hint("merge"), names)
    cold = rows.join(F.broadcast(hot.select(*names)), names, "left_anti").join(table.where(~is_hot).hint("merge"), names)
    return rows.join(F.broadcast(hot), names).unionByName(cold)


def keys(table: DataFrame) -> DataFrame:
    """A stored table of keys, to be joined with: broadcast up to MAX_KEYS rows, else sorted and merged."""
    return F.broadcast(table) if table.count() <= MAX_KEYS else table.hint("merge")


def id_text(key: Column) -> Column:
    """A document's id as text, for crc32 folds; a null id counts as the empty text."""
    return F.coalesce(key.cast("string"), F.lit(""))


def fold(key: Column, parts: int) -> Column:
    return F.crc32(id_text(key).cast("binary")) % F.lit(parts)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_hash(*columns: Column) -> Column:
    """A hash of the columns as a double in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") * F.lit(2.0**-53)


def running_total(df: DataFrame, key: str, value: str, radix: int = 1024, levels: int = 3) -> DataFrame:
    """Exclusive prefix sums of ``value`` over the distinct non-negative long ``key``.

    Returns (key, before). Sums are taken in ``levels`` digits of ``radix``: no window holds
    more than ``radix`` rows but the topmost, which has max(key) / radix**(levels-1) rows.
    """
    sums = df.groupBy(F.col(key).cast("long").alias(key)).agg(F.sum(value).cast("long").alias("v"))

    def level(t: DataFrame, depth: int) -> DataFrame:  # t: k, v -> k, before
        if depth <= 1:
            w = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
            return t.select("k", F.coalesce(F.sum("v").over(w), F.lit(0)).alias("before"))
        t = t.withColumn("p", F.expr(f"k div {radix}"))
        w = Window.partitionBy("p").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
        upper = level(t.groupBy(F.col("p").alias("k")).agg(F.sum("v").alias("v")), depth - 1)
        upper = upper.select(F.col("k").alias("p"), F.col("before").alias("above"))
        inner = t.select("k", "p", F.coalesce(F.sum("v").over(w), F.lit(0)).alias("inside"))
        return inner.join(upper, "p").select("k", (F.col("inside") + F.col("above")).alias("before"))

    out = level(sums.select(F.col(key).alias("k"), "v"), levels)
    return out.select(F.col("k").alias(key), "before")


def byte_list(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The UTF-8 bytes of a string column; null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def slices(weights: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Cuts 0..len(weights) into runs whose weights sum to about ``limit``, one item at least."""
    start = total = 0
    for i, n in enumerate(weights):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(weights):
        yield start, len(weights)


def windows(text: bytes, size: int | None = None) -> Iterator[tuple[int, int]]:
    """Cuts a text at blanks into stretches of whole words, of at most 2 * size bytes; a stretch that is
    longer is a single word. A text of up to 2 * size bytes is one stretch, an empty one has none."""
    size = size or WINDOW
    a = 0
    while len(text) - a > 2 * size:
        blank = BLANK.search(text, a + size)
        end = blank.start() if blank else len(text)
        if end - a > 2 * size:  # the word that ends there starts after the last blank before
            start = max(text.rfind(BLANK_BYTES[k : k + 1], a, a + size) for k in range(len(BLANK_BYTES))) + 1
            if start > a:
                yield a, start
                a = start
        yield a, end
        a = end
    if a < len(text):
        yield a, len(text)


def word_sum(word: bytes, values: np.ndarray, base: int, size: int | None = None) -> int:
    """The sum of values[byte] * base**place over a word's bytes, modulo 2^64, in windows."""
    size = size or WINDOW
    power = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(min(size, len(word)) - 1, base, np.uint64)]))
    total, shift = 0, 1
    for a in range(0, len(word), size):
        part = values[np.frombuffer(word, np.uint8, min(size, len(word) - a), a)]
        total += int((part * power[: len(part)]).sum(dtype=np.uint64)) * shift
        shift = shift * pow(base, size, 1 << 64) % (1 << 64)
    return total % (1 << 64)


def arrow_map(df: DataFrame, rows: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """mapInArrow for a function of one batch, of at most BATCH rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, BATCH):
                yield from rows(batch.slice(a, BATCH))

    return df.mapInArrow(run, schema)


def mixed64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (xor-shift and multiply rounds)."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x
