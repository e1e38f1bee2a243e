"""Operator 11: periodic runs of words, after Kolpakov and Kucherov.

A run is a stretch of words with a smallest period, at least ``power`` periods and ``least`` words
long, that no neighbouring word extends. Of a word sequence:

1. its suffix automaton gives the Lempel-Ziv factors, each the longest beginning of what is left
   that occurs before, else one new word;
2. Main's algorithm finds the runs that touch a border of factors: longest common extensions to
   both sides of the border, for all periods at once by two Z functions. A run ends less than a
   period past the factor before its border's, so that the windows around all borders are together
   as long as the text;
3. every other run lies strictly inside a factor, and is copied from the factor's earlier occurrence,
   in order of starts, so that copies are copied on.

Before that, a sieve over many texts at once drops what no run can hold: every triple of words in a
run occurs ``power - 1`` times in it, so that a triple that is rarer among its text's parts ends the
stretches on both sides. Counts are of hashes, which can only keep more. Stretches that are left are
sieved again, and go through the three steps each; a run and its neighbours never leave a stretch.

The automaton of a stretch takes about 400 bytes a word at most, and prefix states keep their
own next word implicitly.

Defined results: a null or empty text has no words and no run, and an empty collapsed text; repeated
rows are handled each; a null id stays null; other columns are not read; an empty table gives no
rows.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.llm.common import WORD, arrow_map, byte_list, id_text, mixed64, slices

#: Bytes of text whose words are held at once; a longer text is held whole.
HELD = 4 << 20
RUNS = "doc_id long, n_words long, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
Run = tuple[int, int, int]  # start, end, period


class SuffixAutomaton:
    """States 0..n are the beginnings of the word sequence, in order; those after n are clones. A
    beginning's step by its own next word goes to the next beginning and is not stored."""

    def __init__(self, words: list[int]) -> None:
        n = len(words)
        self.words, self.n = words, n
        self.link = link = array("i", bytes(4 * (n + 1)))
        self.length, self.end = array("i"), array("i")  # of clones: longest word sequence, first occurrence's last place
        self.steps: dict[int, dict[int, int]] = {}
        link[0] = -1
        for i, c in enumerate(words):
            self._append(i, c)

    def _append(self, i: int, c: int) -> None:
        words, link, steps, n = self.words, self.link, self.steps, self.n
        new, p, q = i + 1, link[i], -1
        while p >= 0:
            if p < i and words[p] == c:
                q = p + 1
                break
            own = steps.get(p)
            if own is None:
                steps[p] = {c: new}
            elif (q := own.get(c, -1)) >= 0:
                break
            else:
                own[c] = new
            p = link[p]
        if p < 0:
            link[new] = 0
            return
        reach = (p if p <= n else self.length[p - n - 1]) + 1
        if reach == (q if q <= n else self.length[q - n - 1]):
            link[new] = q
            return
        clone = len(link)
        own = dict(steps.get(q, ()))
        if q <= n:
            own[words[q]] = q + 1
        steps[clone] = own
        self.length.append(reach)
        self.end.append(self.last(q))
        link.append(link[q])
        link[q] = link[new] = clone
        while p >= 0 and (own := steps.get(p)) is not None and own.get(c) == q:
            own[c] = clone
            p = link[p]

    def last(self, state: int) -> int:
        return state - 1 if state <= self.n else self.end[state - self.n - 1]

    def factors(self) -> Iterator[tuple[int, int, int]]:
        """(start, length, start of an earlier occurrence or -1): the Lempel-Ziv factors in order."""
        words, n, steps, at = self.words, self.n, self.steps, 0
        while at < n:
            state, j = 0, at
            while j < n:
                c = words[j]
                to = state + 1 if state < n and words[state] == c else steps[state][c]
                if self.last(to) >= j:
                    break
                state, j = to, j + 1
            if j == at:
                yield at, 1, -1
                at += 1
            else:
                yield at, j - at, self.last(state) - (j - at) + 1
                at = j


def z_function(s: list[int]) -> list[int]:
    """Of each place, how far the sequence from there on equals its beginning; 0 for the first place."""
    n = len(s)
    z, left, right = [0] * n, 0, 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def border_runs(words: list[int], factors: list[tuple[int, int, int]], power: int, least: int) -> dict[tuple[int, int], int]:
    """{(start, end): smallest period} of the runs that touch a border of factors."""
    n, found = len(words), {}
    borders = [(start, factors[k - 1][1], length) for k, (start, length, _) in enumerate(factors) if k]
    for b, before, after in [*borders, (n, factors[-1][1], 0)]:
        most = (before + after - 1) // (power - 1)
        if most < 1:
            continue
        low, high = max(0, b - before - most), b + after
        left, right = words[low:b], words[b:high]
        ahead, behind = min(most, len(right)), min(most, len(left))
        # Against the words left of the border, read backwards: they themselves, and what ends up to ``ahead`` right of it.
        back = z_function(left[::-1] + [-1] + words[low : b + ahead][::-1])
        # Against the words right of the border: they themselves, and what begins up to ``behind`` left of it.
        fore = z_function(right + [-1] + words[b - behind : high])
        spans = [(b - back[len(left) + 1 + ahead - p], b + p + (fore[p] if p < len(right) else 0), p) for p in range(1, ahead + 1)]
        spans += [(b - p - (back[p] if p < len(left) else 0), b + fore[len(right) + 1 + behind - p], p) for p in range(1, behind + 1)]
        for s, e, p in spans:
            if e - s < power * p or e - s < least:
                continue
            if (s and words[s - 1] == words[s - 1 + p]) or (e < n and words[e] == words[e - p]):
                continue  # goes on beyond the window; another border has it
            if p < found.get((s, e), p + 1):
                found[s, e] = p
    return found


def word_runs(words: list[int], power: int = 4, least: int = 6) -> list[Run]:
    """All runs of a sequence of non-negative numbers, by start, then period."""
    if len(words) < least:
        return []
    factors = list(SuffixAutomaton(words).factors())
    found = border_runs(words, factors, power, least)
    runs = sorted((s, e, p) for (s, e), p in found.items())
    for start, length, earlier in factors:
        if earlier < 0 or length < least:
            continue
        k, shift = bisect_right(runs, (earlier, len(words), len(words))), start - earlier
        while k < len(runs) and runs[k][0] < earlier + length:
            s, e, p = runs[k]
            if e < earlier + length:
                copy = (s + shift, e + shift, p)
                at = bisect_left(runs, copy)
                if at == len(runs) or runs[at] != copy:
                    insort(runs, copy)
            k += 1
    return sorted(runs, key=lambda r: (r[0], r[2]))


def sieve(words: np.ndarray, counts: np.ndarray, power: int = 4, least: int = 6, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of the stretches that may hold runs, of texts of ``counts`` words each that
    follow each other. ``least`` must be 6 at least and ``power`` 4 at least, or nothing is sieved."""
    sizes = np.asarray(counts, np.int64)
    firsts = np.cumsum(sizes) - sizes
    if power < 4 or least < 6:
        return firsts, firsts + sizes
    words = words.astype(np.uint64)
    for _ in range(rounds):
        ok = sizes >= least
        firsts, sizes = firsts[ok], sizes[ok]
        total = int(sizes.sum())
        if not total:
            break
        begins = np.cumsum(sizes) - sizes
        place = np.arange(total) + np.repeat(firsts - begins, sizes)
        group = np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes)
        own = words[place]
        inner = np.ones(total, bool)
        inner[begins + sizes - 1] = inner[begins + sizes - 2] = False  # no triple begins there
        key = mixed64(mixed64(own + (group << np.uint64(32)))[:-2] * np.uint64(3) + mixed64(own[1:-1]) * np.uint64(5) + own[2:])
        bits = max(10, (8 * total - 1).bit_length())
        slot = (key >> np.uint64(64 - bits)).astype(np.int64)
        often = np.zeros(total, bool)
        often[:-2] = np.bincount(slot[inner[:-2]], minlength=1 << bits)[slot] >= power - 1
        often &= inner
        edges = np.flatnonzero(np.diff(np.concatenate([[False], often, [False]]).astype(np.int8)))
        a, b = edges[::2], edges[1::2] + 2  # the triples' last words
        before = int(sizes.sum())
        firsts, sizes = place[a], b - a
        if int(sizes.sum()) == before and len(a) == len(begins):
            break
    return firsts, firsts + sizes


def find_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", power: int = 4, least: int = 6) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): the runs of every whole text by start, then period, and
    the text without what repeats: of each run only the first period stays, words joined by one space."""
    if power < 2 or least < 2:
        raise ValueError("a run has two periods and two words at least")

    def handle(ids: pa.Array, texts: list[bytes]) -> pa.RecordBatch:
        split = [t.split() for t in texts]  # at the six white space bytes that part words
        counts = np.array([len(w) for w in split], np.int64)
        codes = pa.array([w for words in split for w in words], pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        starts = np.cumsum(counts) - counts
        runs: list[list[dict]] = [[] for _ in texts]
        first, end = sieve(codes, counts, power, least)
        of = np.searchsorted(starts + counts, first, side="right")
        for d, a, b in zip(of.tolist(), first.tolist(), end.tolist(), strict=True):
            _, own = np.unique(codes[a:b], return_inverse=True)
            base = a - int(starts[d])
            runs[d] += [{"start": base + s, "length": e - s, "period": p} for s, e, p in word_runs(own.tolist(), power, least)]
        out = []
        for words, of_doc in zip(split, runs, strict=True):
            if of_doc:
                edge = np.zeros(len(words) + 1, np.int32)
                for r in of_doc:
                    edge[r["start"] + r["period"]] += 1
                    edge[r["start"] + r["length"]] -= 1
                words = [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
            out.append(b" ".join(words))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        return pa.RecordBatch.from_arrays([ids, pa.array(counts), pa.array(runs, kind), pa.array(out, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = byte_list(batch.column(1))
        for a, b in slices([len(t) for t in texts], HELD):
            yield handle(batch.column(0).slice(a, b - a), texts[a:b])

    table = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return arrow_map(table, rows, RUNS)


def with_planted_tails(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, text): texts of which one in ten ends in repeats: with h = crc32 of the id, g = h div 10 and n words, if 10
    divides h, word i from a = g mod n on is word a + (i - a) mod p, where p = 1 + (n - a) div
    (3 + g mod 8). Null ids count as the empty text, whose crc32 is 0."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    h = F.crc32(id_text(F.col("doc_id")).cast("binary"))
    words = F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD), F.lit(0))
    planted = docs.withColumns({"_h": h, "_w": F.when(h % 10 == 0, words)})
    g, n = F.expr("_h div 10"), F.size("_w")
    planted = planted.withColumns({"_a": F.when(n > 0, g % n).cast("int"), "_n": n, "_g": g})
    period = (F.lit(1) + F.expr("(_n - _a) div (3 + _g % 8)")).cast("int")
    left = F.col("_n") - F.col("_a")
    head, block = F.slice("_w", F.lit(1), F.col("_a")), F.slice("_w", F.col("_a") + 1, period)
    tail = F.slice(F.flatten(F.array_repeat(block, F.ceil(left / period).cast("int"))), F.lit(1), left)
    out: Column = F.when(F.col("_n") > 0, F.array_join(F.concat(head, tail), " ")).otherwise(F.col("text"))
    return planted.select("doc_id", out.alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """Per document the count of its runs, the longest one (ties: smallest start, then period), and
    digests of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), F.concat(r["period"].cast("string"), F.lit("\n")))), "")
    table = found.withColumns({"best": best, "n_runs": F.size("runs").cast("long")})
    return table.select(
        "doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"), F.expr("1000 * best.length div -best.period").cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words",
    )
