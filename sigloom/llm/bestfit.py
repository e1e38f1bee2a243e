"""Operator 12: packing into few sequences by linear grouping, then best fit.

Every document is its ids and an end id; only what is longer than a sequence is cut, into whole
sequences and a rest. How many pieces have which length (``window`` numbers at most) is all that the
plan needs, whatever the corpus:

1. Large pieces, sorted by length, fall into groups of equal cardinality, and each is rounded up to
   the greatest length of its group.
2. For these few sizes, configurations of one sequence are optimised: a linear program over all of them,
   solved by columns that a knapsack over the prices finds.
3. Each configuration's whole multiples become sequences. Their places are taken by actual pieces of
   the group, in order, so that sequences with the same lengths are ranges; what room rounding left is theirs.
4. The pieces that whole multiples left over, then the small ones, from long to short, go where they fit
   best: sequences with the same room are kept as ranges, so that a length is placed in few steps.

Several bounds between large and small, and numbers of groups, are tried; the plan of fewest sequences is taken.
It is a table of ranges: piece number x of a length (counted over partitions by prefix sums) goes to
sequence ``first + (x - low) // each``. It has some thousands of rows at any size of corpus.

Defined results: a null or empty text is the end id alone; repeated rows, and rows with a null id,
are packed each; other columns are not read; an empty table gives no pieces.
"""

from __future__ import annotations

import re
from array import array
from collections import deque
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigloom.llm.common import join_skewed, slices, stored
from sigloom.llm.tokens import BYTE_LETTERS, MEMO_LETTERS, MEMO_UNITS, WHITE, Memo, UnitEncoder, vocabulary_path

VOCABULARY = "word_bpe_49k.json"
WINDOW = 4096
#: (parts, groups): pieces longer than a window's part are large, and fall into so many groups. All are tried, and
#: the plan of fewest sequences is taken.
SCHEMES = ((3, 16), (3, 64), (3, 256), (4, 64), (6, 64), (8, 16))
#: Letters whose lower case is one letter.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: How far from the optimum the program may end.
GAP = 5e-4
PIECES = "part int, nth long, doc_id long, piece int, start long, length long, ids binary"


class WordMemo(Memo):
    """Ids of units of a tokenizer of lower-cased words."""

    def __init__(self, tokenizer: object) -> None:
        super().__init__(tokenizer)
        self.single = re.compile(f"[{LETTERS}]+").fullmatch

    def __missing__(self, unit: str) -> bytes:
        if self.single(unit):
            ids = [t.id for t in self.pieces(unit.lower().encode().decode("latin-1").translate(BYTE_LETTERS))]
        else:
            ids = self.encode(unit, add_special_tokens=False).ids
        own = array("I", ids).tobytes()
        if len(unit) <= MEMO_LETTERS:
            self[unit] = own
        return own


class WordEncoder(UnitEncoder):
    """As UnitEncoder, for tokenizers that drop white space and lower-case: units have none, so that there are fewer.
    Words of a text are letters only, or begin after letters at an ASCII character that is none."""

    unit, memo_type = re.compile(f"[{LETTERS}]++(?=[\\x00-\\x7f]|\\Z)|[^{WHITE}]+"), WordMemo


class Configurations:
    """The linear program: fewest sequences that hold ``demands[k]`` pieces of ``sizes[k]``."""

    def __init__(self, sizes: list[int], demands: list[int], window: int) -> None:
        self.sizes, self.demands, self.window = np.array(sizes), np.array(demands, float), window

    def best(self, prices: np.ndarray) -> np.ndarray:
        """The configuration of the greatest price: a knapsack by number of pieces."""
        rows = [np.zeros(self.window + 1)]
        worth = [k for k in range(len(self.sizes)) if prices[k] > 1e-12]
        for _ in range(self.window // int(self.sizes.min())):
            last, row = rows[-1], rows[-1].copy()
            for k in worth:
                s = self.sizes[k]
                np.maximum(row[s:], last[: len(last) - s] + prices[k], out=row[s:])
            if (row == last).all():
                break
            rows.append(row)
        out, room = np.zeros(len(self.sizes)), self.window
        for row, last in zip(rows[:0:-1], rows[-2::-1], strict=True):
            if row[room] == last[room]:
                continue
            k = next(k for k in worth if self.sizes[k] <= room and last[room - self.sizes[k]] + prices[k] == row[room])
            out[k] += 1
            room -= self.sizes[k]
        return out

    def solve(self) -> list[tuple[list[int], int]]:
        """(pieces of each size, times): whole parts of a basic solution. Stopping early is only less good."""
        k = len(self.sizes)
        columns, costs = np.diag((self.window // self.sizes).astype(float)), np.ones(k)
        for turn in range(20 * k):
            if turn % 64 == 0:
                inverse = np.linalg.inv(columns)
            amounts, prices = inverse @ self.demands, costs @ inverse
            if prices.min() < -1e-9:  # more than asked for is allowed
                enter, cost = -np.eye(k)[int(prices.argmin())], 0.0
            else:
                enter, cost = self.best(prices), 1.0
                if prices @ enter <= 1 + GAP:  # no solution is better by more than this part
                    break
            moved = inverse @ enter
            rows = np.flatnonzero(moved > 1e-9)
            if not len(rows):
                break
            leave = rows[(amounts[rows] / moved[rows]).argmin()]
            columns[:, leave], costs[leave] = enter, cost
            inverse[leave] /= moved[leave]
            others = np.arange(k) != leave
            inverse[others] -= np.outer(moved[others], inverse[leave])
        found = zip(columns.T, costs, np.linalg.inv(columns) @ self.demands, strict=True)
        return [(c.astype(int).tolist(), int(x + 1e-6)) for c, cost, x in found if cost and x >= 1 - 1e-6]


class Plan:
    """Where pieces go, from the number of pieces of each length. Pieces are numbered from long to short."""

    def __init__(self, counts: dict[int, int], window: int, parts: int, groups: int) -> None:
        self.window, self.sequences = window, 0
        self.ranges: list[tuple[int, int, int, int, int]] = []  # first piece, pieces, pieces a sequence, first sequence, offset
        self.rooms: list[list[tuple[int, int]]] = [[] for _ in range(window + 1)]  # by room: (first sequence, sequences)
        self.open = 0  # bits: rooms that are there
        self.left: list[list[int]] = []  # of a length: length, first piece, pieces
        first = 0
        for length in sorted((c for c in counts if counts[c]), reverse=True):
            self.left.append([length, first, counts[length]])
            first += counts[length]
        self.total = first
        shortest = self.left[-1][0] if self.left else 0
        for part in self.left:  # what nothing fits beside
            if part[0] + shortest > window:
                self._emit(part, part[2], 1, self._new(part[2]), 0)
        large = [part for part in self.left if part[2] and part[0] > window // parts]
        if large:
            self._grouped(large, groups)
        for part in self.left:
            self._fit(part)

    def _new(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def _emit(self, part: list[int], n: int, each: int, sequence: int, offset: int) -> None:
        self.ranges.append((part[1], n, each, sequence, offset))
        part[1] += n
        part[2] -= n

    def _add(self, room: int, sequence: int, n: int) -> None:
        if n and room:
            self.rooms[room].append((sequence, n))
            self.open |= 1 << room

    def _grouped(self, large: list[list[int]], groups: int) -> None:
        """Sequences of the optimised configurations of rounded lengths, filled with actual pieces."""
        cardinality = -(-sum(part[2] for part in large) // groups)
        stocks: dict[int, deque[list]] = {}  # of a rounded length: [part, pieces of it], in order
        room = size = 0
        for part in large:
            rest = part[2]
            while rest:
                if not room or len(large) <= groups:
                    room, size = cardinality, part[0]
                n = rest if len(large) <= groups else min(rest, room)
                stocks.setdefault(size, deque()).append([part, n])
                rest, room = rest - n, max(0, room - n)
        sizes = list(stocks)
        held = {s: sum(n for _, n in stocks[s]) for s in sizes}
        for config, times in Configurations(sizes, [held[s] for s in sizes], self.window).solve():
            places = {s: n for s, n in zip(sizes, config, strict=True) if n}
            times = min([times, *(held[s] // n for s, n in places.items())])  # there may be more places than pieces
            while times:
                # As many sequences as have the same actual lengths in all places, or one.
                step = min([times, *(max(1, stocks[s][0][1] // n) for s, n in places.items())])
                sequence, offset = self._new(step), 0
                for s, n in places.items():
                    need = n * step
                    held[s] -= need
                    while need:
                        stock = stocks[s][0]
                        taken = min(need, stock[1])
                        self._emit(stock[0], taken, taken // step, sequence, offset)
                        offset += taken // step * stock[0][0]
                        stock[1] -= taken
                        need -= taken
                        if not stock[1]:
                            stocks[s].popleft()
                times -= step
                self._add(self.window - offset, sequence, step)

    def _fit(self, part: list[int]) -> None:
        """Best fit of what is left of a length: tightest rooms first, and again while it fits there."""
        length = part[0]
        while part[2]:
            fits = self.open >> length
            if not fits:
                each = self.window // length
                n = -(-part[2] // each)
                self._add(self.window, self._new(n), n)
                continue
            room = length + (fits & -fits).bit_length() - 1
            sequence, n = self.rooms[room].pop()
            if not self.rooms[room]:
                self.open &= ~(1 << room)
            each, offset = room // length, self.window - room
            full = min(n, part[2] // each)
            if full:
                self._emit(part, full * each, each, sequence, offset)
                self._add(room - each * length, sequence, full)
            if full < n:
                rest = part[2] if part[2] < each else 0
                if rest:
                    self._emit(part, rest, rest, sequence + full, offset)
                    self._add(room - rest * length, sequence + full, 1)
                self._add(room, sequence + full + bool(rest), n - full - bool(rest))

    def arrays(self) -> tuple[np.ndarray, ...]:
        """The ranges by first piece."""
        table = np.array(sorted(self.ranges), np.int64).reshape(-1, 5)
        return tuple(np.ascontiguousarray(c) for c in table.T)


def best_plan(counts: dict[int, int], window: int = WINDOW, schemes: Sequence[tuple[int, int]] = SCHEMES) -> Plan:
    return min((Plan(counts, window, *s) for s in schemes), key=lambda p: p.sequences)


def cut_pieces(docs: DataFrame, text: str, doc_id: str, vocabulary: str | None, end_id: int, window: int, special_as_text: bool, memo_units: int) -> DataFrame:
    """Pieces of at most ``window`` ids (little-endian uint32), numbered by partition and length."""
    path, end = vocabulary or vocabulary_path(VOCABULARY), np.array([end_id], "<u4").tobytes()
    names = [f.strip().split()[0] for f in PIECES.split(",")]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = WordEncoder.of(path, special_as_text, memo_units), TaskContext.get().partitionId()
        seen: dict[int, int] = {}  # pieces of a length so far
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in slices([len(t) for t in texts], 1 << 22):
                out = []
                for key, own in zip(ids[a:b], encoder.encode(texts[a:b]), strict=True):
                    own += end
                    for piece, start in enumerate(range(0, len(own) // 4, window)):
                        held = own[4 * start : 4 * (start + window)]
                        length = len(held) // 4
                        nth = seen.get(length, 0)
                        seen[length] = nth + 1
                        out.append((part, nth, key, piece, start, length, held))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(rows, PIECES)


def pack_best_fit(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, schemes: Sequence[tuple[int, int]] = SCHEMES, vocabulary: str | None = None, end_id: int = 1, payload: Callable[[Column], Column] = lambda ids: ids, special_as_text: bool = False, memo_units: int = MEMO_UNITS) -> DataFrame:
    """(doc_id, piece, start, length, sequence_id, offset, payload): one row a piece. ``payload`` is
    computed from a piece's ids, and stored; by default it is the ids."""
    cut = cut_pieces(docs, text, doc_id, vocabulary, end_id, window, special_as_text, memo_units)
    pieces = stored(cut.select("part", "nth", "doc_id", "piece", "start", "length", payload(F.col("ids")).alias("payload")), "pieces", compression="zstd")
    per = stored(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "length-counts")
    counts = {r["length"]: r["n"] for r in per.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # window rows at most
    plan = best_plan(counts, window, schemes)
    before, firsts = 0, {}
    for length in sorted(counts, reverse=True):
        firsts[length] = before
        before += counts[length]
    base = docs.sparkSession.createDataFrame(list(firsts.items()), "length long, first long")  # window rows at most
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    bases = per.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(F.broadcast(base), "length")
    bases = stored(bases.select("part", "length", "n", (F.col("base") + F.col("first")).alias("base")), "length-bases")
    numbered = join_skewed(pieces, bases, ["part", "length"], "n", plan.total)
    ranges = docs.sparkSession.sparkContext.broadcast(plan.arrays())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, _, each, first, offset = ranges.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x, length = batch.column("x").to_numpy(), batch.column("length").to_numpy()
            at = np.searchsorted(low, x, side="right") - 1
            sequence, place = np.divmod(x - low[at], each[at])
            own = [c for c in batch.schema.names if c != "x"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in own], pa.array(first[at] + sequence), pa.array(offset[at] + place * length)], names=[*own, "sequence_id", "offset"])

    table = numbered.select("doc_id", "piece", "start", "length", "payload", (F.col("base") + F.col("nth")).alias("x"))
    kind = table.schema["payload"].dataType.simpleString()
    out = table.mapInArrow(rows, f"doc_id long, piece int, start long, length long, payload {kind}, sequence_id long, offset long")
    return out.select("doc_id", "piece", "start", "length", "sequence_id", "offset", "payload")
