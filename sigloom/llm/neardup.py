"""Operator 4: near-duplicate documents by an inverted join of MinHash coordinates.

1. A document's word shingles are hashed, and each of COORDINATES hash functions keeps its
   least value: its signature. Rows whose words are the same, by a 256-bit digest of all of them,
   form a class; one row of each class is its node and goes on.
2. Every (coordinate, value) is a posting. Nodes of similarity s agree in a coordinate with
   probability s; ``least_matches`` is the number of agreements that a pair at the threshold
   falls short of once in 10^9. Two signatures with that many common postings share one among
   the first COORDINATES - least_matches + 1 of either, in the order of rareness: only this
   prefix is listed, and a node with fewer shared postings than the threshold is skipped.
3. Collisions are counted in the lists, first between each list's most central node (whose
   postings are the most frequent) and the others: the lists that a pair shares give its first
   hits, and the coordinates beyond the prefix are looked up only for pairs that have any.
4. Nodes that these links join are skipped from then on: lists that still hold several
   components are dealt out in bounded blocks, in which only pairs of different components
   are counted, each in the first list that both have in their prefix. Blocks of a large
   component meet those of others, never each other.
5. Each link is confirmed on the full shingle sets, from the texts.

The result is that of all links, though not all pairs are made: members of a component differ
from no other in what they are linked with. Hot classes, lists and hubs are broadcast by their
number, or split into blocks.

Defined results: a null text, or one without words, is an empty set, linked with nothing; with
fewer words than a shingle takes, the whole sequence is one shingle; a null id is kept and linked
with nothing; rows that repeat an id are linked with each other, whatever their texts, and each
keeps its row; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.llm import common
from sigloom.llm.blocks import map_blocks
from sigloom.llm.common import BATCH, byte_list, join_skewed, keys, mixed64, slices, stored, windows, word_sum
from sigloom.llm.graph import connected_components

COORDINATES = 64
CHUNK_BYTES = 1 << 18
#: Rows of a list in one chunk; a block holds two chunks.
CHUNK = 512
#: Pairs of a hub that its text is sent to at once.
HUB_PART = 128
_random = np.random.default_rng(20240229)
BYTE_CODES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SEEDS = _random.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
FACTORS = _random.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15


@lru_cache(1)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse, modulo 2^64."""
    return tuple(np.multiply.accumulate(np.full(n, x, np.uint64)) for x in (BASE, pow(BASE, -1, 1 << 64)))


def word_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit codes of all words, lower-cased in ASCII, and the index of each text's first word
    (and, last, the number of words)."""
    joined = np.frombuffer(b"\n".join(texts).lower() + b"\n", np.uint8)
    blank = (joined == 32) | ((joined >= 9) & (joined <= 13))
    change = np.flatnonzero(np.diff(np.concatenate([[True], blank]).astype(np.int8)))
    begin, end = change[0::2], change[1::2]
    n = 1 << max(16, (len(joined) - 1).bit_length())
    power, inverse = (x[: len(joined)] for x in powers(n))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_CODES[joined] * power, dtype=np.uint64)])
    codes = mixed64((total[end] - total[begin]) * inverse[begin] + (end - begin).astype(np.uint64))
    starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    return codes, np.searchsorted(begin, starts)


def is_long(text: bytes) -> bool:
    return len(text) > 2 * common.WINDOW


def long_word_codes(text: bytes) -> np.ndarray:
    """``word_codes`` of one long text, in windows."""

    def parts() -> Iterator[np.ndarray]:
        for a, b in windows(text):
            if b - a > 2 * common.WINDOW:
                word = text[a:b].lower()
                yield mixed64(np.array([(word_sum(word, BYTE_CODES, BASE) + len(word)) % (1 << 64)], np.uint64))
            else:
                yield word_codes([text[a:b]])[0]

    return np.concatenate([np.zeros(0, np.uint64), *parts()])


def shingle_codes(codes: np.ndarray, words: int) -> np.ndarray:
    """The code of each stretch of ``words`` words."""
    one = np.uint64(0x2545F4914F6CDD1D)
    out = np.zeros(max(0, len(codes) - words + 1), np.uint64)
    for a in range(0, len(out), common.WINDOW):
        part = out[a : a + common.WINDOW]
        for j in range(words):
            part[:] = mixed64(part * one + codes[a + j : a + j + len(part)])
    return out


def shingle_sets(texts: list[bytes], words: int) -> Iterator[np.ndarray]:
    """The distinct shingle codes of each text, ascending."""
    if any(map(is_long, texts)) and len(texts) > 1:
        for text in texts:
            yield from shingle_sets([text], words)
        return
    if texts and is_long(texts[0]):
        codes = long_word_codes(texts[0])
        first = np.array([0, len(codes)])
    else:
        codes, first = word_codes(texts)
    joined = shingle_codes(codes, words)
    for a, b in zip(first.tolist(), first[1:].tolist(), strict=False):
        if b - a >= words:
            yield np.unique(joined[a : b - words + 1])
        elif b > a:
            yield np.frombuffer(hashlib.blake2b(codes[a:b].tobytes(), digest_size=8).digest(), np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def numbered(text: bytes, number: dict[bytes, int]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """The lower-cased words of a text, window by window, and their numbers by first appearance."""
    for a, b in windows(text):
        sequence = text[a:b].lower().split()
        yield sequence, np.fromiter((number.setdefault(w, len(number)) for w in sequence), np.int64, len(sequence))


def shingle_numbers(ids: np.ndarray, top: int, words: int) -> np.ndarray:
    """For each stretch of ``words`` numbers below ``top`` one number; equal ones for equal stretches only."""
    codes, below = ids[: max(0, len(ids) - words + 1)], top
    for j in range(1, words):
        if below * top >= 1 << 62:
            values, codes = np.unique(codes, return_inverse=True)
            below = len(values)
        codes, below = codes * top + ids[j : j + len(codes)], below * top
    return codes


def described(text: bytes, words: int) -> tuple[int, bytes | None]:
    """Number of distinct shingles of a text, and the digest of its words (null without any)."""
    number: dict[bytes, int] = {}
    digest, parts, total = hashlib.blake2b(digest_size=32), [], 0
    for sequence, ids in numbered(text, number):
        if sequence:
            digest.update((b" " if total else b"") + b" ".join(sequence))
            parts.append(ids)
            total += len(sequence)
    if total < words:
        return min(total, 1), digest.digest() if total else None
    return len(np.unique(shingle_numbers(np.concatenate(parts), len(number), words))), digest.digest()


def overlap(a: bytes, b: bytes, words: int) -> tuple[int, int, int]:
    """Numbers of distinct shingles of two texts and of both together in common, by numbering words and
    then shingles: for long texts, of which sets of words would take too much room."""
    number: dict[bytes, int] = {}
    first, second = (np.concatenate([np.zeros(0, np.int64), *(ids for _, ids in numbered(t, number))]) for t in (a, b))
    if min(len(first), len(second)) < words:
        n, m = (min(len(x), 1) if len(x) < words else len(np.unique(shingle_numbers(x, len(number), words))) for x in (first, second))
        return n, m, int(n == m == 1 and np.array_equal(first, second))
    joined = shingle_numbers(np.concatenate([first, second]), len(number), words)
    x, y = np.unique(joined[: len(first) - words + 1]), np.unique(joined[len(first) :])
    return len(x), len(y), len(np.intersect1d(x, y, assume_unique=True))


def signature(codes: np.ndarray) -> np.ndarray:
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(codes), 4096):
        values = (codes[a : a + 4096, None] ^ SEEDS) * FACTORS
        np.minimum(least, values.min(0), out=least)
    return least


def least_matches(percent: int, miss: float = 1e-9) -> int:
    """The most agreements of COORDINATES that a pair at the threshold misses with at most ``miss``."""
    p, below = percent / 100, 0.0
    for t in range(COORDINATES):
        below += math.comb(COORDINATES, t) * p**t * (1 - p) ** (COORDINATES - t)
        if below > miss:
            return max(t, 1)
    return COORDINATES


def signatures(docs: DataFrame, text: str, doc_id: str, words: int) -> DataFrame:
    """(row, doc, code, n, print, sig): a number for the row, its id, a hash of its text, size of its set,
    digest of its words, least values; the last two are null where the set is empty. To be
    stored, as the numbers are those of partitions."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 33
        for batch in (b.slice(k, BATCH) for b in batches for k in range(0, b.num_rows, BATCH)):
            texts = byte_list(batch.column(2))
            for a, b in slices([len(t) for t in texts], CHUNK_BYTES):
                sizes, prints, sigs = [], [], []
                for raw, codes in zip(texts[a:b], shingle_sets(texts[a:b], words), strict=True):
                    size, print_ = described(raw, words)
                    sizes.append(size)
                    prints.append(print_)
                    sigs.append(signature(codes).view(np.int64) if size else None)
                number = pa.array(np.arange(at, at + b - a))
                at += b - a
                yield pa.RecordBatch.from_arrays([number, batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(sigs, pa.list_(pa.int64()))], names=["row", "doc", "code", "n", "print", "sig"])

    return keyed(docs, text, doc_id).mapInArrow(rows, "row long, doc long, code long, n long, print binary, sig array<bigint>")


def keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(doc, code, text); code tells the texts of one id apart."""
    whole = F.col(text).cast("string")
    return docs.select(F.col(doc_id).cast("long").alias("doc"), F.xxhash64(whole).alias("code"), whole.alias("text"))


def prefixes(reps: DataFrame, least: int) -> DataFrame:
    """(node, key, central, mask): the prefix postings that others have too; central sums the
    frequencies of the node's postings, mask has a bit for each coordinate of its prefix."""
    postings = reps.select("node", F.posexplode("sig").alias("at", "value")).select("node", "at", F.xxhash64("at", "value").alias("key"))
    counts = stored(postings.groupBy("key").agg(F.count(F.lit(1)).alias("often")).where("often > 1"), "posting-counts")
    known = join_skewed(postings, counts, ["key"], "often", reps.count() * COORDINATES)
    common = known.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("often", "key", "at"))).alias("p"))
    take = F.greatest(F.lit(0), F.size("p") - F.lit(least - 1))  # the postings that nobody shares come first
    central = F.aggregate("p", F.lit(0).cast("long"), lambda s, x: s + x["often"])
    mask = F.aggregate("q", F.lit(0).cast("long"), lambda s, x: s.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), x["at"])))
    lists = common.select("node", F.slice("p", F.lit(1), take).alias("q"), central.alias("central")).where(F.size("q") > 0)
    return lists.select("node", "central", mask.alias("mask"), F.explode("q").alias("x")).select("node", "x.key", "x.at", "central", "mask")


def split_hubs(pairs: DataFrame) -> DataFrame:
    """(node, hub, n) -> with ``part``: pairs of one hub in parts of about HUB_PART."""
    parts = F.ceil(F.col("n") / HUB_PART)
    return pairs.withColumn("part", F.pmod(F.xxhash64("node"), parts))


def agreeing(pairs: DataFrame, signed: DataFrame, least: int, percent: int) -> DataFrame:
    """Of the pairs (node, hub, n, part, hits), those of fitting sizes whose signatures agree in
    ``least`` coordinates: hits are in the lists, the rest is looked up."""
    heads = pairs.select("hub", "n", "part").distinct().join(signed.select(F.col("node").alias("hub"), F.col("size").alias("hub_size"), F.col("sig").alias("hub_sig")), "hub")
    both = pairs.join(signed, "node").join(heads, ["hub", "n", "part"])
    both = both.where(100 * F.least("size", "hub_size") >= percent * F.greatest("size", "hub_size"))
    equal = F.aggregate(F.zip_with("sig", "hub_sig", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return both.where((F.col("hits") >= least) | (equal >= least)).select("node", "hub", "n", "part")


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): of the pairs (node, hub, n, part), those whose full shingle sets are similar enough. A
    hub's text goes once to each of its parts."""

    def shingles(text: bytes) -> set:
        w = text.lower().split()
        return set(zip(*(w[j:] for j in range(words)), strict=False)) if len(w) >= words else {tuple(w)} if w else set()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own, head = None, set(), b""
        for batch in batches:
            a, b = [], []
            heads, nodes = batch.column(0).to_pylist(), batch.column(3).to_pylist()
            for i, (h, node) in enumerate(zip(heads, nodes, strict=True)):
                raw = batch.column(4)[i].as_buffer().to_pybytes()
                if node is None:  # the first row of a part
                    if h != hub:
                        hub, own, head = h, set() if is_long(raw) else shingles(raw), raw
                    continue
                if is_long(head) or is_long(raw):
                    n, m, both = overlap(head, raw, words)
                else:
                    other = shingles(raw)
                    n, m = len(own), len(other)
                    both = len(own & other) if 100 * min(n, m) >= percent * max(n, m) else 0
                if both and 100 * both >= percent * (n + m - both):
                    a.append(min(h, node))
                    b.append(max(h, node))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    heads = pairs.select("hub", "n", "part").distinct().join(texts.withColumnRenamed("node", "hub"), "hub")
    heads = heads.select("hub", "n", "part", F.lit(None).cast("long").alias("node"), "text")
    members = pairs.join(texts, "node").select("hub", "n", "part", "node", "text")
    dealt = heads.union(members).repartition("hub", "n", "part").sortWithinPartitions("hub", "n", "part", F.col("node").asc_nulls_first())
    return dealt.mapInArrow(rows, "a long, b long").distinct()


def hub_pairs(lists: DataFrame) -> DataFrame:
    """(node, hub, n, part, hits): each list's most central node with the others; hits counts the
    lists in which the pair collides, n is the size of the largest."""
    best = F.max(F.struct("central", (-F.col("node")).alias("minus")))
    centres = lists.groupBy("key").agg(best.alias("c"), F.count(F.lit(1)).alias("n")).where("n > 1")
    centres = stored(centres.select("key", (-F.col("c.minus")).alias("hub"), "n"), "centres")
    met = join_skewed(lists.select("node", "key"), centres, ["key"], "n", lists.count()).where("node <> hub")
    return split_hubs(met.groupBy("node", "hub").agg(F.count(F.lit(1)).alias("hits"), F.max("n").alias("n")))


def component_blocks(lists: DataFrame, components: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(key, at, node, component, mask, own, lo, hi): rows of lists that hold several components, in
    the blocks in which chunks of different components meet. Chunks hold one large component's
    rows or those of small ones; chunks of one large component do not meet."""
    own = lists.select("node", "key", "at", "mask").join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    own = stored(own, "lists")
    total = own.count()
    per = own.groupBy("key", "component").agg(F.count(F.lit(1)).alias("m"))
    large = F.col("m") > chunk // 2
    sizes = per.groupBy("key").agg(F.count(F.lit(1)).alias("k"), F.sum("m").alias("n"), F.coalesce(F.sum(F.when(~large, F.col("m"))), F.lit(0)).alias("small")).where("k > 1")
    sizes = stored(sizes.select("key", "n", "small"), "list-sizes")
    mixed = join_skewed(own, sizes, ["key"], "n", total)
    one = F.lit("0")
    low = mixed.where(F.col("n") <= 2 * chunk).select("key", "at", "node", "component", "mask", one.alias("own"), one.alias("lo"), one.alias("hi"))

    wide = stored(per.join(sizes.where(F.col("n") > 2 * chunk), "key").withColumn("lead", F.when(large, F.col("component")).otherwise(F.lit(-1))).withColumn("parts", F.ceil(F.when(large, F.col("m")).otherwise(F.col("small")) / chunk)), "wide-lists")
    leads = wide.groupBy("key", "lead").agg(F.max("parts").alias("parts"))
    every = leads.groupBy("key").agg(F.collect_list(F.struct("lead", "parts")).alias("leads"))
    placed = stored(wide.select("key", "component", "m", "lead", "parts").join(every, "key"), "placed-lists")
    rows = join_skewed(mixed.where(F.col("n") > 2 * chunk).drop("n", "small"), placed, ["key", "component"], "m", total)
    name = lambda lead, part: F.concat_ws(":", lead.cast("string"), part.cast("string"))
    rows = rows.withColumn("own", name(F.col("lead"), F.pmod(F.when(F.col("lead") == -1, F.xxhash64("component")).otherwise(F.xxhash64("node")), F.col("parts"))))
    others = F.filter("leads", lambda x: (x["lead"] != F.col("lead")) | (x["lead"] == -1))
    rows = rows.withColumn("other", F.explode(F.flatten(F.transform(others, lambda x: F.transform(F.sequence(F.lit(0).cast("long"), x["parts"].cast("long") - 1), lambda p: name(x["lead"], p))))))
    return low.union(rows.select("key", "at", "node", "component", "mask", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")))


def fitting(group: pa.Table, least: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (i, j) of a block's rows that lie in different components, fit in size, agree in ``least``
    coordinates and have this list as the first that is in both prefixes; and their agreements."""
    node, component, n, mask, at = (group.column(c).to_numpy() for c in ("node", "component", "size", "mask", "at"))
    own, lo, hi = group.column("own").to_pylist(), group.column("lo")[0].as_py(), group.column("hi")[0].as_py()
    mine = np.array([x == lo for x in own])
    sig = group.column("sig").combine_chunks().flatten().to_numpy().reshape(-1, COORDINATES)
    left = np.flatnonzero(mine)
    right = left if lo == hi else np.flatnonzero(~mine)
    bit = np.uint64(1) << np.uint64(at[0])
    out = [np.zeros((3, 0), np.int64)]
    for a in range(0, len(left), 256):
        rows = left[a : a + 256]
        fits = component[rows][:, None] != component[right]
        fits &= 100 * np.minimum(n[rows][:, None], n[right]) >= percent * np.maximum(n[rows][:, None], n[right])
        if lo == hi:
            fits &= node[rows][:, None] < node[right]
        x, y = np.nonzero(fits)
        x, y = rows[x], right[y]
        for b in range(0, len(x), 1 << 15):
            i, j = x[b : b + (1 << 15)], y[b : b + (1 << 15)]
            equal = sig[i] == sig[j]
            often = equal.sum(1)
            good = np.flatnonzero(often >= least)
            listed = np.packbits(equal[good], axis=1, bitorder="little").view(np.uint64).ravel() & mask[i[good]].view(np.uint64) & mask[j[good]].view(np.uint64)
            good = good[(listed & (~listed + np.uint64(1))) == bit]
            out.append(np.stack([i[good], j[good], often[good]]))
    return tuple(np.concatenate(out, 1))


def residual_links(lists: DataFrame, components: DataFrame, signed: DataFrame, texts: DataFrame, words: int, percent: int, least: int, chunk: int = CHUNK) -> DataFrame:
    """(node, hub) links between different components, enough of them to join all that are linked.

    Blocks of signatures first name the nodes with a partner; only these come again with their
    texts, and there pairs are compared on their full sets, those that agree most first, and a
    pair whose nodes are joined meanwhile is skipped. No pairs leave a block but links that join
    something."""
    rows = component_blocks(lists, components, chunk)
    names = ["key", "lo", "hi", "own", "at", "node", "component", "mask"]
    kinds = "key long, lo string, hi string, own string, at int, node long, component long, mask long"

    def named(group: pa.Table) -> Iterator[pa.RecordBatch]:
        x, y, _ = fitting(group, least, percent)
        if len(x):
            yield from group.select(names).take(pa.array(np.union1d(x, y))).combine_chunks().to_batches()

    def linked(group: pa.Table) -> Iterator[pa.RecordBatch]:
        x, y, often = fitting(group, least, percent)
        if not len(x):
            return
        node, component = group.column("node").to_numpy(), group.column("component").to_numpy()
        sets: dict[int, np.ndarray] = {}
        used = np.union1d(x, y).tolist()
        texts = byte_list(group.column("text"))
        for a, b in slices([len(texts[u]) for u in used], CHUNK_BYTES):
            sets.update(zip(used[a:b], shingle_sets([texts[u] for u in used[a:b]], words), strict=True))
        label = np.unique(component, return_inverse=True)[1]
        found: list[tuple[int, int]] = []
        both, other = np.concatenate([x, y]), np.concatenate([y, x])
        order = np.lexsort((-np.concatenate([often, often]), both))
        both, other = both[order], other[order]
        for a, b in zip(*(np.flatnonzero(np.diff(np.concatenate([[-1], both, [-1]])) != 0)[k:][: len(used)] for k in (0, 1)), strict=True):
            u, rest = int(both[a]), other[a:b]
            mine = sets[u]
            while len(rest):
                now, rest = rest[:16], rest[16:]
                theirs = [sets[v] for v in now.tolist()]
                sizes = np.array([len(t) for t in theirs])
                flat = np.concatenate(theirs)
                place = np.minimum(np.searchsorted(mine, flat), len(mine) - 1)
                common = np.add.reduceat((mine[place] == flat).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
                for v in now[100 * common >= percent * (len(mine) + sizes - common)].tolist():
                    if label[u] != label[v]:
                        found.append((u, v))
                        label[label == label[v]] = label[u]
                rest = rest[label[rest] != label[u]]
        if found:
            u, v = (node[np.array(z)] for z in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["node", "hub"])

    few = stored(map_blocks(rows.join(signed, "node"), ["key", "lo", "hi"], named, kinds), "residual")
    return map_blocks(few.join(signed, "node").join(texts, "node"), ["key", "lo", "hi"], linked, "node long, hub long").distinct()


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 5, percent: int = 80, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row a document."""
    least = least_matches(percent)
    sigs = stored(signatures(docs, text, doc_id, words), "signatures")
    full = sigs.where("doc is not null and print is not null")
    total = full.count()

    # Rows of the same words are one node: the least of their numbers.
    classes = full.groupBy("print").agg(F.min("row").alias("node"), F.min("doc").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    classes = stored(classes, "classes")
    copies = stored(join_skewed(full.select("row", "doc", "print"), classes, ["print"], "copies", total).select("row", "doc", "node"), "copies")
    others = stored(copies.where("row <> node").select(F.col("row").alias("node")), "other-rows")
    reps = full.select(F.col("row").alias("node"), "doc", "code", F.col("n").alias("size"), "sig").join(keys(others), "node", "left_anti")
    again = stored(sigs.where("doc is not null").groupBy("doc").agg(F.count(F.lit(1)).alias("times")).where("times > 1"), "repeated-ids")
    some_again = not again.isEmpty()

    lists = stored(prefixes(reps.select("node", "sig"), least), "prefixes")
    listed = stored(lists.select("node").distinct(), "listed")
    wanted = stored(reps.select("node", "doc", "code").join(keys(listed), "node", "left_semi"), "wanted")
    signed = stored(reps.select("node", "size", "sig").join(keys(listed), "node", "left_semi"), "candidate-signatures")
    texts = keyed(docs, text, doc_id).join(keys(wanted), ["doc", "code"]).select("node", "text")
    texts = stored(texts.dropDuplicates(["node"]) if some_again else texts, "candidate-texts", compression="zstd")

    pairs = stored(agreeing(stored(hub_pairs(lists), "hub-pairs"), signed, least, percent), "agreeing")
    links = confirmed(pairs, texts, words, percent)
    if some_again:  # nodes of one id are linked
        repeated = stored(join_skewed(full.select("row", "doc"), again, ["doc"], "times", sigs.count()).join(copies.select("row", "node"), "row", "left").select("doc", F.coalesce("node", "row").alias("b")).distinct(), "repeated-nodes")
        of_id = stored(repeated.groupBy("doc").agg(F.min("b").alias("a"), F.count(F.lit(1)).alias("nodes")).where("nodes > 1"), "nodes-of-ids")
        links = links.union(join_skewed(repeated, of_id, ["doc"], "nodes", repeated.count()).where("a <> b").select("a", "b"))
    links = stored(links, "links")
    components = connected_components(links)
    more = stored(residual_links(lists, components, signed, texts, words, percent, least, chunk), "residual-links")
    if not more.isEmpty():
        hubs = stored(more.groupBy("hub").agg(F.count(F.lit(1)).alias("n")), "hubs")
        more = confirmed(split_hubs(join_skewed(more, hubs, ["hub"], "n", more.count())), texts, words, percent)
        stars = components.select(F.col("node").alias("a"), F.col("component").alias("b"))
        components = connected_components(stars.union(stored(more, "links")))

    # A component's id is its least document id.
    members = components.join(full.select(F.col("row").alias("node"), "doc"), "node").join(classes.select("node", "first"), "node", "left")
    members = stored(members.select("node", "component", F.coalesce("first", "doc").alias("first")), "members")
    leasts = stored(members.groupBy("component").agg(F.min("first").alias("least"), F.count(F.lit(1)).alias("nodes")), "components")
    named = stored(join_skewed(members, leasts, ["component"], "nodes", members.count()).select("node", "least"), "component-ids")
    groups = stored(classes.join(named, "node", "left").select("node", F.coalesce("least", "first").alias("of_class"), "copies"), "groups")
    copied = join_skewed(copies.select("row", "node"), groups, ["node"], "copies", total).select("row", "of_class")
    out = sigs.select("row", "doc", "n").join(copied, "row", "left").join(named.withColumnRenamed("node", "row"), "row", "left")
    out = out.withColumn("component", F.coalesce("of_class", "least", "doc"))
    return out.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.coalesce(F.col("doc") == F.col("component"), F.lit(True)).alias("kept"))
