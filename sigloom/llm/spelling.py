"""Operator 13: spelling variants of words, by distance-one Levenshtein automata over trie shards.

The vocabulary (distinct words with counts) is sorted, cut into shards of ``shard_words`` neighbours,
and each shard becomes a compact trie: nodes in level order with a letter, the first child, a bitmap
of the children's letters and the word that ends there. Shards are broadcast in groups of at most ``group_bytes``, one group at a
time, so that neither driver nor executor ever holds more of them. Every word's automaton is
intersected with every shard of the group, depth first: a stack of blocks holds (word, node,
automaton state) rows of one depth each, and the deepest block is expanded first. The state at
a node has four bits, one for each position of the word that can be reached there with at most
one edit; a (word, shard) pair ends where no bit is left, mostly one or two letters deep. Accepting nodes
are the neighbours: each is met once, counted, and the best kept, so that one row a word leaves a
group.

Words have letters ``A-Za-z`` and U+00C0 to U+00FF, one byte each.

Defined results: null and empty texts have no words; a null id counts as the empty text in
``planted_words``; repeated rows count each; other columns are not read; an empty table gives no
rows.
"""

from __future__ import annotations

import math
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.llm.common import id_text, keys, shared_dir, stored

LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = (bytes(range(a, a + 26)).decode() for a in (65, 97))
#: Words of a shard; bytes of the shards broadcast at once; words of a block of work, and rows of a block of the stack.
SHARD_WORDS, GROUP_BYTES, BLOCK_WORDS, BLOCK_ROWS = 1 << 18, 32 << 20, 1 << 15, 1 << 14
#: Bits of a state at depth d: all d letters match; one was replaced; the trie has one more; the word has one more.
SAME, REPLACED, INSERTED, DELETED = 1, 2, 4, 8
NONE = 0xFFFFFFFF
#: Places of letters in a node's bitmap of 128 bits: a-z, then U+00C0 to U+00FF; others share the places before.
PLACE = (np.arange(256) % 32 + np.where(np.arange(256) < 192, 0, np.where(np.arange(256) < 224, 32, 64))).astype(np.uint64)


class Trie:
    """A compact trie over sorted distinct words: arrays only."""

    def __init__(self, label: np.ndarray, child: np.ndarray, word: np.ndarray, counts: np.ndarray, ends: np.ndarray, letters: np.ndarray) -> None:
        self.label, self.child, self.word = label, child, word  # of nodes; child has one more, so that children of v are child[v] .. child[v + 1]
        self.counts, self.ends, self.letters = counts, ends, letters  # of words
        parent = np.repeat(np.arange(len(label)), np.diff(child.astype(np.int64)))
        place = PLACE[label[1:]]
        self.maps = np.zeros(2 * len(label), np.uint64)
        np.bitwise_or.at(self.maps, 2 * parent + (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))

    def step(self, node: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether node has a child by letter, that child)."""
        place = PLACE[letter]
        high = place > 63
        low_map = self.maps[2 * node]
        own = np.where(high, self.maps[2 * node + 1], low_map)
        bit = np.uint64(1) << (place & np.uint64(63))
        rank = np.bitwise_count(own & (bit - np.uint64(1))) + np.where(high, np.bitwise_count(low_map), 0)
        return (own & bit) > 0, self.child[node] + rank.astype(np.int64)

    @classmethod
    def of(cls, words: list[bytes], counts: list[int]) -> Trie:
        sizes = np.array([len(w) for w in words], np.int64)
        letters, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes)
        begins = ends - sizes
        labels, parents, word = [np.zeros(1, np.uint8)], [np.zeros(1, np.int64)], [np.full(1, NONE, np.uint32)]
        node, live, nodes = np.zeros(len(words), np.int64), np.arange(len(words)), 1
        for depth in range(int(sizes.max(initial=0))):
            live = live[sizes[live] > depth]
            letter, parent = letters[begins[live] + depth], node[live]
            fresh = np.ones(len(live), bool)
            fresh[1:] = (letter[1:] != letter[:-1]) | (parent[1:] != parent[:-1])
            own = np.cumsum(fresh) - 1
            node[live] = nodes + own
            labels.append(letter[fresh])
            parents.append(parent[fresh])
            ended, ends_here = np.full(int(fresh.sum()), NONE, np.uint32), sizes[live] == depth + 1
            ended[own[ends_here]] = live[ends_here]
            word.append(ended)
            nodes += len(ended)
        kids = np.bincount(np.concatenate(parents)[1:], minlength=nodes)
        child = np.concatenate([[1], 1 + np.cumsum(kids)]).astype(np.uint32)
        return cls(np.concatenate(labels), child, np.concatenate(word), np.array(counts, np.int64), ends.astype(np.uint32), letters)

    def tobytes(self) -> bytes:
        return struct.pack("<QQQ", len(self.label), len(self.counts), len(self.letters)) + b"".join(a.tobytes() for a in (self.counts, self.child, self.word, self.ends, self.label, self.letters))

    @classmethod
    def frombytes(cls, blob: bytes) -> Trie:
        nodes, n, size = struct.unpack_from("<QQQ", blob)
        at, out = 24, []
        for kind, k in (("<i8", n), ("<u4", nodes + 1), ("<u4", nodes), ("<u4", n), ("u1", nodes), ("u1", size)):
            out.append(np.frombuffer(blob, kind, k, at))
            at += out[-1].nbytes
        counts, child, word, ends, label, letters = out
        return cls(label, child, word, counts, ends, letters)

    def text(self, k: int) -> str:
        return self.letters[int(self.ends[k - 1]) if k else 0 : int(self.ends[k])].tobytes().decode("latin-1")

    def near(self, letters: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place of a word, number of a trie word) of all pairs at distance one. ``letters`` ends in two zeros."""

        def at(w: np.ndarray, i: int) -> np.ndarray:  # 0 is no letter
            return np.where(i < sizes[w], letters[np.minimum(begins[w] + i, len(letters) - 1)], 0) if i >= 0 else np.zeros(len(w), np.uint8)

        stack = [(0, np.arange(len(sizes)), np.zeros(len(sizes), np.int64), np.full(len(sizes), SAME, np.uint8))]
        while stack:
            d, w, node, state = stack.pop()
            if len(w) > BLOCK_ROWS:
                stack.append((d, w[BLOCK_ROWS:], node[BLOCK_ROWS:], state[BLOCK_ROWS:]))
                w, node, state = w[:BLOCK_ROWS], node[:BLOCK_ROWS], state[:BLOCK_ROWS]
            here, last, next_ = at(w, d), at(w, d - 1), at(w, d + 1)
            # Where all letters match, every child goes on; elsewhere only those by the letters that the bits wait for.
            all_ = np.flatnonzero(state & SAME)
            first = self.child[node[all_]].astype(np.int64)
            kids = self.child[node[all_] + 1] - first
            rows, kid = [np.repeat(all_, kids)], [np.arange(int(kids.sum())) + np.repeat(first - (np.cumsum(kids) - kids), kids)]
            asked: list[np.ndarray] = []
            for bit, letter in ((REPLACED, here), (INSERTED, last), (DELETED, next_)):
                some = ((state & bit) > 0) & ((state & SAME) == 0) & (letter > 0)
                for other in asked:
                    some &= other != letter
                asked.append(np.where(some, letter, 0))
                some = np.flatnonzero(some)
                has, to = self.step(node[some], letter[some])
                rows.append(some[has])
                kid.append(to[has])
            row, kid = np.concatenate(rows), np.concatenate(kid)
            if not len(row):
                continue
            c, s = self.label[kid], state[row]
            now, before, after = here[row] == c, last[row] == c, next_[row] == c
            same = (s & SAME) > 0
            replaced = np.where(same, ~now & (sizes[w] > d)[row], now & ((s & REPLACED) > 0))
            inserted = same | (before & ((s & INSERTED) > 0))
            deleted = after & ((s & (SAME | DELETED)) > 0)
            same &= now
            to = (same * SAME | replaced * REPLACED | inserted * INSERTED | deleted * DELETED).astype(np.uint8)
            live = np.flatnonzero(to)
            to, kid, w = to[live], kid[live], w[row[live]]
            d += 1
            more = sizes[w] - d
            ends = self.word[kid]
            hit = (ends != NONE) & (((more == 0) & ((to & REPLACED) > 0)) | ((more == -1) & ((to & INSERTED) > 0)) | ((more == 1) & ((to & (SAME | DELETED)) > 0)))
            if hit.any():
                yield w[hit], ends[hit].astype(np.int64)
            stack.append((d, w, kid, to))


def planted_words(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least: int = 7, every: int = 31) -> DataFrame:
    """(word), one row an occurrence: maximal runs of letters, A-Z lowered, of at least ``least`` code points.
    With h = crc32 of "<id>:<run>", a run whose h ``every`` divides loses its code point h mod length."""
    runs = docs.select(id_text(F.col(doc_id)).alias("of"), F.explode(F.regexp_extract_all(F.col(text).cast("string"), F.lit(LETTERS), F.lit(0))).alias("run")).where(F.length("run") >= least)
    runs = runs.select("of", F.translate("run", UPPER, LOWER).alias("run"))
    h, n = F.col("h"), F.length("run")
    at = (h % n).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, n))
    out = runs.withColumn("h", F.crc32(F.concat("of", F.lit(":"), "run").cast("binary"))).select(F.when(h % every == 0, cut).otherwise(F.col("run")).alias("word"))
    return out.where(F.length("word") >= least)


def vocabulary(words: DataFrame, at_least: int = 2) -> DataFrame:
    """(word, n) of the words that occur often enough, counted before the shuffle too."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= at_least)


def trie_shards(words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(first, size, trie): the sorted vocabulary, stored, as tries of at most ``shard_words`` words."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        counts: list[int] = []

        def shard() -> pa.RecordBatch:
            blob = Trie.of(held, counts).tobytes()
            return pa.RecordBatch.from_arrays([pa.array([held[0].decode("latin-1")]), pa.array([len(blob)], pa.int64()), pa.array([blob], pa.binary())], names=["first", "size", "trie"])

        for batch in batches:
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.append(word.encode("latin-1"))
                counts.append(n)
                if len(held) == shard_words:
                    yield shard()
                    held, counts = [], []
        if held:
            yield shard()

    parts = max(1, -(-words.count() // shard_words))
    return words.repartitionByRange(parts, "word").sortWithinPartitions("word").select("word", "n").mapInArrow(rows, "first string, size long, trie binary")


def near_words(words: DataFrame, shard_words: int = SHARD_WORDS, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(word, n_near, near, near_n) of the words that have words at distance one: their number, and
    the one of the largest count (ties: the smallest). ``words`` is stored, with distinct (word, n)."""
    spark = words.sparkSession
    shards = stored(trie_shards(words, shard_words), "tries")
    sizes = [(r["first"], r["size"]) for r in shards.select("first", "size").orderBy("first").collect()]  # one row a shard
    groups: list[list[str]] = []
    room = 0
    for first, size in sizes:
        if size > room or not groups:
            groups.append([])
            room = group_bytes
        groups[-1].append(first)
        room -= size
    dealt = words.select("word").repartition(max(1, -(-words.count() // BLOCK_WORDS)), "word")  # a block of work a task
    path = f"{shared_dir(spark)}/near-words-{uuid.uuid4().hex}"
    schema = "word string, n_near long, near string, near_n long"
    spark.createDataFrame([], schema).write.parquet(path)
    for group in groups:
        blobs = [r["trie"] for r in shards.where(F.col("first").between(group[0], group[-1])).orderBy("first").collect()]  # group_bytes at most, or one shard
        shared = spark.sparkContext.broadcast(blobs)

        def rows(batches: Iterator[pa.RecordBatch], shared: object = shared) -> Iterator[pa.RecordBatch]:
            tries = [Trie.frombytes(b) for b in shared.value]

            def neighbours(texts: list[str]) -> pa.RecordBatch:
                sizes = np.array([len(t) for t in texts], np.int64)
                letters = np.frombuffer("".join(texts).encode("latin-1") + b"\0\0", np.uint8)
                begins = np.cumsum(sizes) - sizes
                number, most, best = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), [""] * len(texts)
                for trie in tries:  # in order of words, so that of equal counts the first stays
                    found = list(trie.near(letters, begins, sizes))
                    if not found:
                        continue
                    w, k = (np.concatenate(x) for x in zip(*found, strict=True))
                    number += np.bincount(w, minlength=len(texts))
                    n = trie.counts[k]
                    order = np.lexsort((k, -n, w))
                    w, k, n = w[order], k[order], n[order]
                    top = np.ones(len(w), bool)
                    top[1:] = w[1:] != w[:-1]
                    top &= n > most[w]
                    most[w[top]] = n[top]
                    for a, b in zip(w[top].tolist(), k[top].tolist(), strict=True):
                        best[a] = trie.text(b)
                held = np.flatnonzero(number)
                return pa.RecordBatch.from_arrays([pa.array([texts[i] for i in held], pa.string()), pa.array(number[held]), pa.array([best[i] for i in held], pa.string()), pa.array(most[held])], names=["word", "n_near", "near", "near_n"])

            texts: list[str] = []
            for batch in batches:
                texts += batch.column(0).to_pylist()
                while len(texts) >= BLOCK_WORDS:
                    yield neighbours(texts[:BLOCK_WORDS])
                    texts = texts[BLOCK_WORDS:]
            if texts:
                yield neighbours(texts)

        dealt.mapInArrow(rows, schema).write.mode("append").parquet(path)
        shared.destroy()
    parts = spark.read.schema(schema).parquet(path)
    best = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("best"))
    return best.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.minus")).alias("near_n"))


def follow(links: DataFrame, steps: int) -> DataFrame:
    """(word, form) links without circles -> (word, root), by doubling; chains have at most ``steps`` links."""
    roots = stored(links.select("word", F.col("form").alias("root")), "roots")
    for _ in range(math.ceil(math.log2(max(steps, 1)))):
        on = keys(roots.select(F.col("word").alias("root"), F.col("root").alias("further")))
        roots = stored(roots.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return roots


def group_variants(words: DataFrame, factor: int = 10, shard_words: int = SHARD_WORDS, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a vocabulary of (word, n). A word's form is its near
    word of the largest n, if that is at least ``factor`` (2 at least) times its own; its root is the
    end of the chain of forms, or itself."""
    if factor < 2:
        raise ValueError("forms must be more frequent than their words")
    words = stored(words.select("word", "n"), "vocabulary")
    is_form = F.col("near_n") >= F.col("n") * factor
    near: Column = F.coalesce("n_near", F.lit(0))
    formed = words.join(near_words(words, shard_words, group_bytes), "word", "left").select("word", F.when(is_form, F.col("near")).alias("form"), "n", near.alias("n_near"), F.when(is_form, F.col("near_n")).alias("form_n"))
    formed = stored(formed, "forms")
    most = words.agg(F.max("n")).first()[0] or 1
    roots = follow(formed.where("form is not null"), int(math.log(most, factor)) + 1)
    return formed.join(roots.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
