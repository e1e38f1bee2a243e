"""Operator 2: mixture-controlled packing by deficit round-robin.

Every source is a queue of its documents' ids. A round is one window of ``window`` tokens: each
queue's credit grows by its share of the window, and a queue with credit for a grain of
``grain`` tokens sends it; what credit is left (the deficit) is carried to the next window. As
a queue's credit after round r is r * share, grain k of a source leaves in round
ceil((k + 1) * grain / share): the schedule has a closed form, so partitions need no state of
each other but prefix sums of grain counts, and deficits carry across them exactly.

A source's queue goes through all partitions: a partition's documents stand after those of all partitions
before it, by prefix sums of tokens, and grain k holds the queue's tokens k * grain to (k + 1) * grain,
wherever they come from. So a document is cut only where a grain ends. Grains of a round leave in the order in
which their credit falls due: at any point of the stream, each source is within its share by a grain, and by its share of a grain of
each source. What a queue has beyond its last whole grain, less than one grain a source, follows at the end.

Sequences are consecutive windows; only the last can be short, and is padded to a power of two.

Defined results: a null or empty text is the end id alone; a null source is a queue of its own;
repeated rows, and rows with a null id, are packed each; other columns are not read; an empty table gives no pieces; a source that runs dry leaves its
windows to the others, in proportion.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigloom.llm.common import running_total, slices, stored
from sigloom.llm.tokens import MEMO_UNITS, UnitEncoder, vocabulary_path

WINDOW, GRAIN = 2048, 256
TOKENS = "part int, source string, local long, doc_id long, doc_tokens long, ids binary"
#: Rounds whose grains are ordered in one window partition.
ROUNDS = 64


def queued(docs: DataFrame, text: str, doc_id: str, source: str, vocabulary: str | None, end_id: int, special_as_text: bool = False, memo_units: int = MEMO_UNITS) -> DataFrame:
    """Documents with their ids as little-endian uint32, and how many ids of their source the partition has before them."""
    path, end = vocabulary or vocabulary_path(), np.array([end_id], "<u4").tobytes()
    names = [f.strip().split()[0] for f in TOKENS.split(",")]
    kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = UnitEncoder.of(path, special_as_text, memo_units), TaskContext.get().partitionId()
        before: dict[str | None, int] = {}
        for batch in batches:
            keys, sources, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), [t or "" for t in batch.column(2).to_pylist()]
            for a, b in slices([len(t) for t in texts], 1 << 22):
                out = []
                for key, queue, ids in zip(keys[a:b], sources[a:b], encoder.encode(texts[a:b]), strict=True):
                    ids += end
                    n, at = len(ids) // 4, before.get(queue, 0)
                    before[queue] = at + n
                    out.append((part, queue, at, key, n, ids))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    table = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), F.col(text).cast("string").alias("text"))
    return table.mapInArrow(rows, TOKENS)


def shares(totals: DataFrame, amount: str, window: float, targets: Mapping[str | None, float] | None) -> DataFrame:
    """(queue, share): what a queue's credit grows by in a round of ``window``. The totals have one row a
    source; by default queues share in proportion to their amounts."""
    if targets:
        weight = F.lit(None).cast("double")
        for name, value in targets.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), float(value)).otherwise(weight)
        totals = totals.withColumn("weight", F.coalesce(weight, F.lit(float(min(targets.values())))))
    else:
        totals = totals.withColumn("weight", F.col(amount).cast("double"))
    every = totals.groupBy().agg(F.sum("weight").alias("every"))
    return totals.crossJoin(F.broadcast(every)).select(F.col("source").alias("queue"), (F.col("weight") / F.col("every") * window).alias("share"))  # every is one row


def placed(pieces: DataFrame, rounds: DataFrame, order: list[Column | str]) -> DataFrame:
    """Pieces with ``at``, their place when they leave by round, then by the order given;
    ``rounds`` has the (round, length) of all of them."""
    block = F.expr(f"round div {ROUNDS}")
    blocks = running_total(rounds.select(block.alias("block"), "length"), "block", "length")
    by = Window.partitionBy("block").orderBy("round", *order).rowsBetween(Window.unboundedPreceding, -1)
    inside = pieces.withColumn("block", block).withColumn("inside", F.coalesce(F.sum("length").over(by), F.lit(0)))
    return inside.join(blocks, "block").withColumn("at", F.col("before") + F.col("inside"))


def pack_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", targets: Mapping[str | None, float] | None = None, window: int = WINDOW, grain: int = GRAIN, vocabulary: str | None = None, end_id: int = 1, payload: Callable[[Column], Column] = lambda ids: ids, special_as_text: bool = False, memo_units: int = MEMO_UNITS) -> DataFrame:
    """(doc_id, source, start, length, doc_tokens, sequence_id, offset, payload): one row a piece.

    ``targets`` gives sources' token proportions (others share what is left over evenly with the
    least weight given); by default every window has the proportions of the corpus, so that
    all queues run dry together. ``payload`` is computed from a piece's ids (bytes of
    little-endian uint32); by default it is the ids. ``memo_units`` bounds what a worker process
    remembers of encoded units: about 220 bytes each in prose; fewer units take more time.
    """
    if window % grain:
        raise ValueError("window must be a multiple of grain")
    tokens = stored(queued(docs, text, doc_id, source, vocabulary, end_id, special_as_text, memo_units), "queues", compression="zstd")
    meta = ["doc_id", "source", "start", "length", "doc_tokens"]
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition

    # Where each partition's part of a queue begins, and how many whole grains the queue has.
    per = stored(tokens.groupBy("part", "source").agg(F.sum("doc_tokens").alias("n")), "queue-parts")
    queues = per.groupBy("source").agg(F.expr(f"sum(n) div {grain}").alias("grains"))
    share = shares(queues.where("grains > 0"), "grains", window // grain, targets)
    queues = queues.join(share, F.col("source").eqNullSafe(F.col("queue")), "left").select(F.col("source").alias("of"), "grains", "share")
    bases = per.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(queues, F.col("source").eqNullSafe(F.col("of")))
    bases = stored(bases.select(F.col("part").alias("in_part"), F.col("source").alias("queue"), "base", "n", "grains", "share"), "queue-bases")

    # A document's pieces: one a grain of its queue that it has ids in.
    placed_docs = tokens.join(bases, (F.col("part") == F.col("in_part")) & F.col("source").eqNullSafe(F.col("queue"))).withColumn("from", F.col("base") + F.col("local"))
    upto = F.col("from") + F.col("doc_tokens")
    pieces = placed_docs.withColumn("k", F.explode(F.sequence(F.expr(f"`from` div {grain}"), F.expr(f"(`from` + doc_tokens - 1) div {grain}"))))
    a, b = F.greatest(F.col("k") * grain, F.col("from")), F.least((F.col("k") + 1) * grain, upto)
    pieces = pieces.withColumns({"start": a - F.col("from"), "length": b - a}).withColumn("ids", F.substring("ids", (F.col("start") * 4 + 1).cast("int"), (F.col("length") * 4).cast("int")))
    due = (F.col("k") + 1) / F.col("share")

    # Whole grains: a round is a window, counted in grains.
    sent = pieces.where("k < grains").select(*meta, "queue", "k", due.alias("due"), F.ceil(due).cast("long").alias("round"), (F.col("from") + F.col("start")).alias("nth"), payload(F.col("ids")).alias("payload"))
    mine = bases.where("grains > 0").withColumn("k", F.explode(F.sequence(F.expr(f"base div {grain}"), F.expr(f"(base + n - 1) div {grain}")))).where("k < grains")
    held = F.least((F.col("k") + 1) * grain, F.col("base") + F.col("n")) - F.greatest(F.col("k") * grain, F.col("base"))
    sent = placed(sent, mine.select(F.ceil(due).cast("long").alias("round"), held.alias("length")), ["due", F.col("queue").asc_nulls_last(), "nth"])

    # What is beyond them: less than a grain a source, cut by windows.
    late = pieces.where("k >= grains").select(*meta, "queue", (F.col("from") + F.col("start")).alias("nth"), "ids")
    rest = Window.orderBy(F.col("of").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)  # one row a source
    tails = per.groupBy(F.col("source").alias("of")).agg(F.expr(f"sum(n) % {grain}").alias("tail"), F.expr(f"sum(n) div {grain} * {grain}").alias("whole"))
    whole = tails.groupBy().agg(F.coalesce(F.sum("whole"), F.lit(0)).alias("full"))
    tails = tails.withColumn("before", F.coalesce(F.sum("tail").over(rest), F.lit(0))).crossJoin(F.broadcast(whole))  # whole is one row
    tails = stored(tails.select("of", (F.col("full") + F.col("before") - F.col("whole")).alias("shift")), "queue-tails")
    late = late.join(tails, F.col("queue").eqNullSafe(F.col("of"))).withColumn("at", F.col("nth") + F.col("shift"))
    first = F.lit(window) - F.col("at") % window
    cuts = F.when(F.col("length") > first, F.array(F.struct(F.lit(0).cast("long").alias("skip"), first.alias("n")), F.struct(first.alias("skip"), (F.col("length") - first).alias("n")))).otherwise(F.array(F.struct(F.lit(0).cast("long").alias("skip"), F.col("length").alias("n"))))
    late = late.withColumn("cut", F.explode(cuts)).withColumn("ids", F.substring("ids", (F.col("cut.skip") * 4 + 1).cast("int"), (F.col("cut.n") * 4).cast("int")))
    late = late.select("doc_id", "source", (F.col("start") + F.col("cut.skip")).alias("start"), F.col("cut.n").alias("length"), "doc_tokens", payload(F.col("ids")).alias("payload"), (F.col("at") + F.col("cut.skip")).alias("at"))

    out = sent.select(*meta, "payload", "at").unionByName(late)
    return out.select(*meta, F.expr(f"at div {window}").alias("sequence_id"), (F.col("at") % window).alias("offset"), "payload")


def assemble_sequences(pieces: DataFrame, pad_id: int = 0) -> DataFrame:
    """(sequence_id, n_tokens, input_ids, doc_ids): pieces with ids -> padded sequences. The last
    is padded to the next power of two, all others are full. A group is one window."""
    runs = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", F.col("payload").alias("ids")))).alias("runs"), F.sum("length").alias("n_tokens"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for packed in batch.column(1).to_pylist():
                ids = np.frombuffer(b"".join(r["ids"] for r in packed), "<u4")
                out.append(np.concatenate([ids, np.full((1 << (len(ids) - 1).bit_length()) - len(ids), pad_id, "<u4")]).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out, pa.binary()), pa.array([[r["doc_id"] for r in p] for p in batch.column(1).to_pylist()], pa.list_(pa.int64()))], names=["sequence_id", "n_tokens", "input_ids", "doc_ids"])

    return runs.select("sequence_id", "runs", "n_tokens").mapInArrow(rows, "sequence_id long, n_tokens long, input_ids binary, doc_ids array<bigint>")
