"""Operator 8: near-duplicate embeddings by iterative quantisation.

A rotation is learned on a bounded sample (at most SAMPLE vectors) so that the signs of rotated,
centred vectors lose least: principal directions, then alternating sign codes and orthogonal
Procrustes steps. A code has several substrings; their width follows from the number of vectors
(``shape_of``), so that a list of equal substrings keeps its length as the table grows. Vectors
whose codes differ in at most one bit of some substring meet: each substring is posted once for
each of its bits, with that bit masked. With t substrings this finds every pair of up to
2 * t - 1 differing bits, and most beyond. Postings of one vector only are dropped, lists are dealt
out in bounded blocks, and in a block candidates are reranked by their cosine in double
precision. A pair is counted in one list only: that of the first substring (and bit) that finds
it. Blocks give link counts and a spanning forest of their links, whose components are joined
afterwards.

Vectors equal in label and components are collapsed before, and counted by their number. For
codes alone, vectors of more than FOLD components are folded to that many.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, or
have a null label, link with nothing, and so do vectors of different lengths; a null id is
allowed and keeps its row unlinked; rows that repeat an id are told apart in counting, each by its
own vector, but share a component; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.llm.blocks import block_pairs, map_blocks
from sigloom.llm.common import join_skewed, mixed64, stored
from sigloom.llm.graph import connected_components

SAMPLE, FOLD = 8192, 256


def shape_of(n: int) -> tuple[int, int]:
    """(substrings, bits of each) for n vectors: about log2(n) bits, and more substrings where these
    are wide, as a wide one differs in more than one bit more often."""
    width = min(max(math.ceil(math.log2(max(n, 2))), 12), 30)
    return (4 if width <= 22 else 6), width


def learn_rotation(x: np.ndarray, bits: int, rounds: int = 30, seed: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """(projection [d, bits], thresholds [bits]) from unit vectors [n, d]. With fewer dimensions than bits,
    further random rotations of the same directions fill the code; thresholds lie in the widest
    gap of the middle fifth, so each bit splits the sample in about halves, but no close group."""
    random = np.random.default_rng(seed)
    d = x.shape[1]
    mean = x.mean(0)
    columns: list[np.ndarray] = []
    centred = x - mean
    _, vectors = np.linalg.eigh(centred.T @ centred / max(1, len(x) - 1) + 1e-9 * np.eye(d))
    main = vectors[:, ::-1][:, : min(d, bits)]
    v = (x - mean) @ main
    while sum(c.shape[1] for c in columns) < bits:
        rotation = np.linalg.qr(random.normal(size=(v.shape[1], v.shape[1])))[0]
        for _ in range(rounds):
            codes = np.where(v @ rotation >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(codes.T @ v)
            rotation = (left @ right).T
        columns.append(main @ rotation)
    projection = np.hstack(columns)[:, :bits]
    values = np.sort(x @ projection, axis=0)
    low, high = math.floor(0.4 * (len(x) - 1)), math.ceil(0.6 * (len(x) - 1))
    middle = values[low : high + 1]
    if len(middle) < 2:
        return projection, middle[0]
    at = np.diff(middle, axis=0).argmax(0)
    return projection, (np.take_along_axis(middle, at[None], 0) + np.take_along_axis(middle, at[None] + 1, 0))[0] / 2


def codes_of(x: np.ndarray, model: tuple[np.ndarray, np.ndarray], tables: int, width: int) -> np.ndarray:
    """int64 [n, tables]: the substrings of each vector's code."""
    projection, thresholds = model
    bits = ((x @ projection) >= thresholds).reshape(len(x), tables, width)
    return (bits.astype(np.int64) << np.arange(width, dtype=np.int64)).sum(2)


def folded(column: pa.Array, width: int) -> np.ndarray:
    """float64 [n, width] unit vectors; components beyond the width are added to earlier ones, with
    signs that change from fold to fold."""
    out = np.zeros((len(column), width))
    for i, v in enumerate(column):
        v = np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64)
        v = v / np.abs(v).max()
        if len(v) > width:
            v = np.pad(v, (0, -len(v) % width)).reshape(-1, width)
            signs = 1 - 2 * (mixed64(np.arange(v.size, dtype=np.uint64).reshape(v.shape)) >> np.uint64(63)).astype(np.float64)
            signs[0] = 1
            v = (v * signs).sum(0)
        out[i, : len(v)] = v
    norm = np.sqrt((out * out).sum(1, keepdims=True))
    return out / np.where(norm > 0, norm, 1)


def unit_rows(column: pa.Array, width: int) -> np.ndarray:
    """float64 [n, width] unit vectors; shorter ones are padded with zeros."""
    out = np.zeros((len(column), width))
    for i, v in enumerate(column):
        v = np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64)
        out[i, : len(v)] = v
    big = np.abs(out).max(1, keepdims=True)
    out /= np.where(big > 0, big, 1)
    norm = np.sqrt((out * out).sum(1, keepdims=True))
    return out / np.where(norm > 0, norm, 1)


def forest(i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links, by union-find."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = parent.setdefault(p, p)
            x = p
        return x

    out = []
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        x, y = root(a), root(b)
        if x != y:
            parent[y] = x
            out.append((a, b))
    return out


def vector_links(table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", cosine: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row a vector."""
    spark = table.sparkSession
    raw = table.select(F.col(vec_id).cast("long").alias("vec"), F.col(embedding).cast("array<double>").alias("x"), F.col(label).cast("string").alias("label"))
    sound = F.coalesce((F.size("x") > 0) & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("x", lambda v: v != 0), F.lit(False)) & F.col("label").isNotNull()
    usable = raw.where(sound).withColumn("x", F.transform("x", lambda v: v + F.lit(0.0)))
    usable = usable.where("vec is not null")
    grouped = usable.groupBy("label", "x").agg(F.min("vec").alias("first"), F.count(F.lit(1)).alias("weight"))
    classes = stored(grouped.withColumn("width", F.size("x")).withColumn("rep", F.monotonically_increasing_id()), "vectors")
    widest, n = classes.agg(F.max("width"), F.count(F.lit(1))).first()
    if widest is None:
        return raw.select(F.col("vec").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("vec").alias("component_id"), F.lit(True).alias("kept"))

    wide, (tables, bits) = min(widest, FOLD), shape_of(n)
    share = min(1.0, 2.0 * SAMPLE / n)
    order = F.xxhash64(F.lit(8), F.col("first"), F.col("label"))
    sample = classes.where(F.pmod(order, F.lit(1 << 20)) < int(share * (1 << 20)) + 1).orderBy(order, "first", "x").limit(SAMPLE).select("x").toArrow()
    model = spark.sparkContext.broadcast(learn_rotation(folded(sample.column("x").combine_chunks(), wide), tables * bits))

    def code_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                codes = codes_of(folded(part.column(3), wide), model.value, tables, bits)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1) * tables, pa.int32()), pa.array(codes.ravel()))
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(3)), flat], names=["rep", "label", "width", "code"])

    coded = classes.select("rep", "label", "width", "x").mapInArrow(code_rows, "rep long, label string, width int, code array<bigint>")
    masked = F.expr(f"get(code, int(p div {bits}))").bitwiseAND(F.expr(f"~shiftleft(1L, int(p % {bits}))"))
    postings = coded.withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(tables * bits - 1)))).select("rep", "code", "p", F.xxhash64("label", "width", "p", masked).alias("key"))
    postings = stored(postings, "postings")
    sizes = stored(postings.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "posting-sizes")
    rows = block_pairs(postings, ["key"], "rep", sizes)
    rows = rows.join(classes.select("rep", "label", "width", "x", "weight"), "rep")

    def block(group: pa.Table) -> Iterator[pa.RecordBatch]:
        rep, p, own, lo, hi, weight = (group.column(c).to_numpy() for c in ("rep", "p", "own", "lo", "hi", "weight"))
        left = np.flatnonzero(own == lo[0])
        right = left if lo[0] == hi[0] else np.flatnonzero(own == hi[0])
        if not len(left) or not len(right):
            return
        code = group.column("code").combine_chunks().flatten().to_numpy().reshape(-1, tables)
        first = np.full((len(left), len(right)), -1, np.int64)  # the posting in which the pair counts
        for t in range(tables - 1, -1, -1):
            d = code[left, t][:, None] ^ code[right, t]
            near = (d & (d - (d > 0))) == 0
            first = np.where(near, t * bits + np.where(d > 0, np.bitwise_count(np.where(d > 0, d - 1, 0)), 0), first)
        fits = first == p[0]
        names, widths = np.array(group.column("label").to_pylist()), group.column("width").to_numpy()
        if len(set(names)) > 1 or widths.min() != widths.max():  # keys are hashes
            fits &= (names[left][:, None] == names[right]) & (widths[left][:, None] == widths[right])
        if lo[0] == hi[0]:
            fits &= rep[left][:, None] < rep[right]
        if not fits.any():
            return
        x = unit_rows(group.column("x").combine_chunks(), int(widths.max()))
        i, j = np.nonzero(fits & (x[left] @ x[right].T >= cosine))
        if not len(i):
            return
        i, j = left[i], right[j]
        counts = np.bincount(i, weight[j], len(rep)) + np.bincount(j, weight[i], len(rep))
        tree = forest(i, j)
        linked = np.flatnonzero(counts)
        a = [*rep[linked].tolist(), *(int(rep[u]) for u, _ in tree)]
        b = [*[None] * len(linked), *(int(rep[v]) for _, v in tree)]
        c = [*counts[linked].astype(np.int64).tolist(), *[0] * len(tree)]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int64())], names=["a", "b", "n"])

    found = stored(map_blocks(rows, ["key", "lo", "hi"], block, "a long, b long, n long"), "vector-links")
    counts = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    total = usable.count()
    of = classes.select("label", "x", "rep", "weight")
    times = stored(usable.groupBy("vec").agg(F.count(F.lit(1)).alias("times")).where("times > 1"), "repeated-ids")
    repeated = stored(join_skewed(join_skewed(usable.select("vec", "label", "x"), times, ["vec"], "times", total), of, ["label", "x"], "weight", total).select("vec", F.col("rep").alias("b")).distinct(), "repeated-vectors")
    of_id = stored(repeated.groupBy("vec").agg(F.min("b").alias("a"), F.count(F.lit(1)).alias("nodes")).where("nodes > 1"), "vectors-of-ids")
    same_id = join_skewed(repeated, of_id, ["vec"], "nodes", repeated.count()).where("a <> b").select("a", "b")
    components = connected_components(found.where("b is not null").select("a", "b").union(same_id))

    placed = classes.select("label", "x", "rep", "weight", "first").join(components.withColumnRenamed("node", "rep"), "rep", "left").join(counts, "rep", "left")
    placed = stored(placed.withColumn("component", F.coalesce("component", "rep")), "placed")
    least = stored(placed.groupBy("component").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("members")), "component-ids")
    summary = join_skewed(placed, least, ["component"], "members", placed.count())
    summary = stored(summary.select("label", "x", "weight", (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id"), "summary")
    linked = join_skewed(usable.select("vec", "label", "x"), summary, ["label", "x"], "weight", total).select("vec", "n_links", "component_id")
    lone = raw.where(~sound | F.col("vec").isNull()).select("vec", F.lit(0).cast("long").alias("n_links"), F.col("vec").alias("component_id"))
    return linked.union(lone).select(F.col("vec").alias("vec_id"), "n_links", "component_id", F.coalesce(F.col("vec") == F.col("component_id"), F.lit(True)).alias("kept"))
