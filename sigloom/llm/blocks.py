"""Groups too large for a task, as pairs of bounded chunks; and groups from sorted batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.llm.common import join_skewed

CHUNK = 512


def block_pairs(rows: DataFrame, keys: Sequence[str], by: str, sizes: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Every row of a group goes to the blocks (lo, hi) of chunk pairs that hold its chunk: all
    pairs of a group meet in one block each, and no block holds more than about 2 * chunk rows.
    ``sizes``, stored, gives ``n`` for each group; rows of groups it lacks are left out. Adds lo, hi, own."""
    sized = join_skewed(rows, sizes, keys, "n", rows.count())
    parts = F.ceil(F.col("n") / chunk)
    sized = sized.withColumn("own", F.pmod(F.xxhash64(F.lit(3), F.col(by)), parts).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), (parts - 1).cast("int"))))
    return sized.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")).drop("n", "other")


def map_blocks(rows: DataFrame, keys: Sequence[str], function: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Deals rows out by the key columns, and calls the function with each group's rows."""
    names = list(keys)
    dealt = rows.repartition(*names).sortWithinPartitions(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the group that may go on in the next batch
        last: tuple | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in names]
            changes = np.zeros(batch.num_rows, bool)
            for c in columns:
                changes[1:] |= c[1:] != c[:-1]
            starts = [0, *np.flatnonzero(changes).tolist(), batch.num_rows]
            for a, b in zip(starts, starts[1:], strict=False):
                key = tuple(c[a] for c in columns)
                if held and key != last:
                    yield from function(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(a, b - a))
                last = key
        if held:
            yield from function(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, schema)
