"""Operator 5: a quality classifier learned from positives and unlabelled text.

Trusted positives and unlabelled web text are described by features of form (shares of
character kinds, word and line lengths, repeated words) and of content (hashed words). A small network
minimises the non-negative unbiased risk: prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)), with the
logistic loss. Where the difference turns negative, the step ascends its gradient instead, as the
method asks. The class prior is first the share of positive labels among the training rows, then,
as the unlabelled text may have another, estimated from the scores of a first fit.

Every unlabelled training document takes part in every round of the fit: a round starts all
segments of SEGMENT rows, dealt by hash, from the same weights, each takes some passes of
mini-batch steps, and the mean of their weights starts the next round. Only sums reach the driver.
Of trusted positives, which all segments share, at most MAX_POSITIVE are taken, by hash.

Defined results: a null text is scored as an empty one; without positives every score is 0.5;
an empty table gives an empty table; labels with a null id or quality are not learned from, nor are
documents with a null id; rows that repeat an id are each unlabelled text, and one of them is the
positive; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.llm import common
from sigloom.llm.common import arrow_map, byte_list, mixed64, slices, stored, windows, word_sum

MAX_POSITIVE = 8_000
SEGMENT = 1 << 14
CHUNK_BYTES = 1 << 18
#: Bytes that get a share of their own.
MARKS = b".,!?;:|#$%&*@=+-_/\\\"'()[]{}<>~^`"


def _kinds() -> np.ndarray:
    """For each byte its kind: 0 others, 1 lower, 2 upper, 3 digits, 4 blanks, 5 line feeds, 6 non-ASCII lead, 7 non-ASCII tail, 8.. marks."""
    kind = np.zeros(256, np.int64)
    kind[ord("a") : ord("z") + 1], kind[ord("A") : ord("Z") + 1], kind[ord("0") : ord("9") + 1] = 1, 2, 3
    kind[[9, 11, 12, 13, 32]], kind[10] = 4, 5
    kind[0xC0:], kind[0x80:0xC0] = 6, 7
    for i, mark in enumerate(MARKS):
        kind[mark] = 8 + i
    return kind


KINDS = _kinds()
N_KINDS = 8 + len(MARKS)
N_HASHED = 32
N_FEATURES = N_KINDS + 9 + N_HASHED


#: Sums over a text's words: their number, lengths, squares of lengths, words alike to the last, to the last
#: two, those that begin in upper case, end in a mark of CLOSING, end as in capitals; then hashed words.
N_WORD_SUMS = 8
BASE = 0x9E3779B97F4A7C15
CLOSING = np.frombuffer(b"!#$%&*|", np.uint8)
BYTE_VALUES = np.arange(1, 257, dtype=np.uint64)


def features(texts: list[bytes]) -> np.ndarray:
    """float32 [n, N_FEATURES] of form and content, from whole texts, of which long ones are read in windows."""
    counts = np.zeros((len(texts), N_KINDS + N_WORD_SUMS + N_HASHED))
    short = [i for i, t in enumerate(texts) if len(t) <= 2 * common.WINDOW]
    if short:
        counts[short] = tallies([texts[i] for i in short])[0]
    for i in set(range(len(texts))) - set(short):
        counts[i] = long_tally(texts[i])
    kinds, sums, hashed = np.split(counts, [N_KINDS, N_KINDS + N_WORD_SUMS], axis=1)
    out = np.zeros((len(texts), N_FEATURES), np.float32)
    out[:, :N_KINDS] = np.sqrt(np.maximum(kinds, 0) / np.maximum([len(t) for t in texts], 1)[:, None]) if texts else 0
    words = np.maximum(sums[:, 0], 1)
    mean = sums[:, 1] / words
    out[:, N_KINDS] = mean / 10
    out[:, N_KINDS + 1] = np.sqrt(np.maximum(sums[:, 2] / words - mean * mean, 0)) / 10
    out[:, N_KINDS + 2] = np.sqrt(sums[:, 3] / words)
    out[:, N_KINDS + 3] = np.sqrt(sums[:, 4] / words)
    for k in (5, 6, 7):
        out[:, N_KINDS + k - 1] = sums[:, k] / words
    out[:, N_KINDS + 7] = np.log1p(words) / 10
    out[:, N_KINDS + 8] = np.log1p(kinds[:, 5]) / 5
    out[:, N_KINDS + 9 :] = np.sqrt(hashed / words[:, None])
    return out


def tallies(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of byte kinds, sums over words and counts of hashed words, a row a text; and the codes of all words."""
    joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes + 1)
    kind = KINDS[joined]
    counts = np.bincount(owner * N_KINDS + kind, minlength=len(texts) * N_KINDS).reshape(-1, N_KINDS).astype(np.float64)
    counts[:, 5] -= 1  # the joint
    blank = (kind == 4) | (kind == 5)
    begin = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    end = np.flatnonzero(~blank & np.concatenate([blank[1:], [True]])) + 1
    word_of = owner[begin]
    power = np.multiply.accumulate(np.full(len(joined), BASE, np.uint64))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_VALUES[joined] * power, dtype=np.uint64)])
    inverse = np.multiply.accumulate(np.full(len(joined), pow(BASE, -1, 1 << 64), np.uint64))
    code = (total[end] - total[begin]) * inverse[begin]
    again, twice = (np.zeros(len(code), bool) for _ in range(2))
    again[1:] = (code[1:] == code[:-1]) & (word_of[1:] == word_of[:-1])
    twice[2:] = (code[2:] == code[:-2]) & (word_of[2:] == word_of[:-2])
    wide = (end - begin).astype(np.float64)
    upper = KINDS[joined[begin]] == 2
    closed = np.isin(joined[end - 1], CLOSING)
    shout = (KINDS[joined[np.maximum(end - 3, begin)]] == 2) & (wide >= 3)
    columns = (np.ones(len(code)), wide, wide * wide, again, again & twice, upper, closed, shout)
    sums = np.stack([np.bincount(word_of, c, len(texts)) for c in columns], 1)
    hashed = np.bincount(word_of * N_HASHED + bucket_of(code), minlength=len(texts) * N_HASHED).reshape(-1, N_HASHED)
    return np.hstack([counts, sums, hashed]), code


def bucket_of(code: np.ndarray) -> np.ndarray:
    return (mixed64(code) >> np.uint64(40)).astype(np.int64) % N_HASHED


def long_tally(text: bytes) -> np.ndarray:
    """The row of ``tallies`` for one long text, window by window."""
    out, last = np.zeros(N_KINDS + N_WORD_SUMS + N_HASHED), []
    for a, b in windows(text):
        if b - a > 2 * common.WINDOW:  # one word
            code = np.array([word_sum(text[a:b], BYTE_VALUES, BASE)], np.uint64)
            for k in range(a, b, common.WINDOW):
                out[:N_KINDS] += np.bincount(KINDS[np.frombuffer(text, np.uint8, min(common.WINDOW, b - k), k)], minlength=N_KINDS)
            wide = float(b - a)
            out[N_KINDS : N_KINDS + N_WORD_SUMS] += [1, wide, wide * wide, 0, 0, KINDS[text[a]] == 2, text[b - 1] in CLOSING, KINDS[text[b - 3]] == 2]
            out[N_KINDS + N_WORD_SUMS + bucket_of(code)[0]] += 1
        else:
            rows, code = tallies([text[a:b]])
            out += rows[0]
        first = code[:2].tolist()  # words alike across the border
        for k, c in enumerate(first):
            before = [*last, *first[:k]]
            if k == 0 and before:
                out[N_KINDS + 3] += before[-1] == c
            if len(before) > 1:
                out[N_KINDS + 4] += before[-1] == before[-2] == c
        last = [*last, *code[-2:].tolist()][-2:]
    return out


class Network:
    """Standardised features, one hidden layer, one logit."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: list[np.ndarray]) -> None:
        self.mean, self.scale, self.weights = mean, scale, weights

    def hidden(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return z, np.tanh(z @ self.weights[0] + self.weights[1])

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.hidden(x)[1] @ self.weights[2] + self.weights[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def fresh(mean: np.ndarray, scale: np.ndarray, hidden: int = 24, seed: int = 5) -> Network:
    random = np.random.default_rng(seed)
    return Network(mean, scale, [random.normal(0, 0.2, (len(mean), hidden)), np.zeros(hidden), random.normal(0, 0.2, hidden), np.array(0.0)])


def nnpu_gradient(net: Network, p: np.ndarray, u: np.ndarray, prior: float, decay: float) -> list[np.ndarray]:
    """Gradient of the non-negative risk of one mini-batch, or the ascent where its negative part is below 0."""
    k, x = len(p), np.vstack([p, u]).astype(np.float64)
    z, h = net.hidden(x)
    g = np.clip(h @ net.weights[2] + net.weights[3], -30, 30)
    s = 1 / (1 + np.exp(-g))  # d loss(-)/dg = s, d loss(+)/dg = s - 1
    soft = np.logaddexp(0, g)
    rest = soft[k:].mean() - prior * soft[:k].mean()
    d = np.zeros(len(x))
    if rest >= 0:
        d[:k] = prior * (s[:k] - 1) / k - prior * s[:k] / k
        d[k:] = s[k:] / len(u)
    else:
        d[:k] = prior * s[:k] / k
        d[k:] = -s[k:] / len(u)
    dh = np.outer(d, net.weights[2]) * (1 - h * h)
    return [z.T @ dh + decay * net.weights[0], dh.sum(0), h.T @ d + decay * net.weights[2], np.array(d.sum())]


def fit_segment(net: Network, positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int, passes: int = 8, batch: int = 2048, rate: float = 1e-2, decay: float = 1e-4) -> Network:
    """Adam on mini-batches of one segment, from the weights given."""
    random = np.random.default_rng(seed)
    net = Network(net.mean, net.scale, [w.copy() for w in net.weights])
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in net.weights]
    step = 0
    for _ in range(passes):
        order = random.permutation(len(unlabelled))
        for a in range(0, len(order), batch):
            p = positive[random.integers(0, len(positive), min(1024, max(64, len(positive))))]
            step += 1
            for i, grad in enumerate(nnpu_gradient(net, p, unlabelled[order[a : a + batch]], prior, decay)):
                m, v = moments[i]
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                net.weights[i] = net.weights[i] - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """float32 [n, N_FEATURES] of SEGMENT rows, the last of a task of fewer."""
    held: list[np.ndarray] = []
    for batch in batches:
        held.append(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.float32).reshape(-1, N_FEATURES))
        while sum(map(len, held)) >= SEGMENT:
            x = np.vstack(held)
            yield x[:SEGMENT]
            held = [x[SEGMENT:]]
    if sum(map(len, held)):
        yield np.vstack(held)


def summed(rows: DataFrame, vectors: Callable[[Iterator[np.ndarray]], np.ndarray | None], partial: int = 8) -> np.ndarray | None:
    """The sum over tasks of a vector that a task makes of its segments, by ``partial`` sums."""
    schema = "task int, v binary"

    def row(task: int, v: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([task], pa.int32()), pa.array([v.tobytes()], pa.binary())], names=["task", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vectors(segments(batches))
        if v is not None:
            yield row(TaskContext.get().partitionId(), v)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for v in batch.column(1).to_pylist():
                own = np.frombuffer(v)
                total = own if total is None else total + own
        if total is not None:
            yield row(TaskContext.get().partitionId(), total)

    by_task = rows.select("x").mapInArrow(run, schema).repartition(partial, "task").sortWithinPartitions("task")
    got = by_task.mapInArrow(add, schema).toArrow().sort_by("task").column("v").to_pylist()
    return np.sum([np.frombuffer(v) for v in got], axis=0) if got else None


def fit_rounds(rows: DataFrame, net: Network, positive: np.ndarray, prior: float, rounds: int) -> Network:
    """Rounds over all unlabelled rows; each averages the weights of all segments, by their rows."""
    shapes = [w.shape for w in net.weights]
    cuts = np.cumsum([int(np.prod(s)) for s in shapes])[:-1]
    for r in range(rounds):
        shared = rows.sparkSession.sparkContext.broadcast((net, positive))

        def vectors(parts: Iterator[np.ndarray], shared: object = shared, r: int = r) -> np.ndarray | None:
            total = None
            for x in parts:
                start, p = shared.value
                own = fit_segment(start, p, x, prior, zlib.crc32(x[0].tobytes()) + r)
                flat = np.concatenate([*(w.ravel() for w in own.weights), [1.0]]) * len(x)
                total = flat if total is None else total + flat
            return total

        got = summed(rows, vectors)
        shared.destroy()
        net = Network(net.mean, net.scale, [w.reshape(s) for w, s in zip(np.split(got[:-1] / got[-1], cuts), shapes, strict=True)])
    return net


def estimated_prior(net: Network, positive: np.ndarray, rows: DataFrame, confidence: float = 0.1) -> float:
    """The share of positives among the unlabelled, from the scores of both (best bin): above a
    threshold that only positives pass, the unlabelled share divided by the positive share. The threshold
    is the one whose upper confidence bound of this ratio is least. All unlabelled scores are
    counted, by the positive scores they lie between."""
    p = np.sort(net.score(positive))
    cuts = np.unique(p)
    shared = rows.sparkSession.sparkContext.broadcast((net, cuts))

    def vectors(parts: Iterator[np.ndarray]) -> np.ndarray | None:
        net, cuts = shared.value
        return sum((np.bincount(np.searchsorted(cuts, net.score(x), "right"), minlength=len(cuts) + 1).astype(float) for x in parts), np.zeros(len(cuts) + 1))

    between = summed(rows, vectors)
    n = between.sum()
    above_u = np.cumsum(between[::-1])[::-1][1:] / n
    above_p = 1 - np.searchsorted(p, cuts) / len(p)
    slack = np.sqrt(np.log(4 / confidence) / 2 / len(p)) + np.sqrt(np.log(4 / confidence) / 2 / n)
    best = int(np.argmin((above_u + slack) / above_p))
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


def bounded(ids: DataFrame, most: int, seed: int) -> DataFrame:
    """At most ``most`` ids, by hash. A threshold first leaves about twice as many, so that no
    task sorts more."""
    n = ids.count()
    share = min(1.0, 2.0 * most / max(n, 1))
    order = F.xxhash64(F.lit(seed), F.col("key"))
    near = F.pmod(order, F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1)
    return ids.where(near).orderBy(order, "key").limit(most)


def feature_table(docs: DataFrame, keep: list[Column], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The ``keep`` columns, key (the id as a long) and x (features as bytes), stored."""
    schema = docs.select(*keep, F.col(doc_id).cast("long").alias("key")).schema
    columns = schema.names

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = byte_list(batch.column(1))
        for a, b in slices([len(t) for t in texts], CHUNK_BYTES):
            x = pa.array([r.tobytes() for r in features(texts[a:b])], pa.binary())
            yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.column(0).flatten()), x], names=[*columns, "x"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    source = docs.select(F.struct(*keep, F.col(doc_id).cast("long").alias("key")).alias("row"), F.col(text).cast("string").alias("text"))
    return stored(arrow_map(source, rows, f"{fields}, x binary"), "features", compression="zstd")


def train(table: DataFrame, labels: DataFrame, train_fold: Column | None = None, label_id: str = "doc_id", quality: str = "quality", max_positive: int = MAX_POSITIVE, rounds: int = 8) -> Network | None:
    """From a feature table; ``train_fold`` is a condition on ``key``. None if nothing can be learned."""
    fold = F.lit(True) if train_fold is None else train_fold
    own = labels.select(F.col(label_id).cast("long").alias("key"), F.col(quality).cast("int").alias("q")).where("key is not null and q is not null").where(fold).distinct()
    ones, zeros = own.agg(F.count_if(F.col("q") == 1), F.count_if(F.col("q") != 1)).first()
    known = table.select("key", "x").where("key is not null").where(fold)
    keys = bounded(own.where("q = 1").select("key"), max_positive, 11)
    got = known.join(F.broadcast(keys), "key", "left_semi").groupBy("key").agg(F.min("x").alias("x")).toArrow().sort_by("key")  # keys are bounded
    positive = np.frombuffer(b"".join(got.column("x").to_pylist()), np.float32).reshape(-1, N_FEATURES)
    n = known.count()
    if not len(positive) or not n:
        return None
    order = F.xxhash64(F.lit(12), F.col("key"))
    rows = stored(known.repartition(-(-n // SEGMENT), order).sortWithinPartitions(order, "key", "x").select("x"), "unlabelled", compression="zstd")

    def moments(parts: Iterator[np.ndarray]) -> np.ndarray:
        return sum((np.concatenate([x.sum(0, dtype=np.float64), (x.astype(np.float64) ** 2).sum(0)]) for x in parts), np.zeros(2 * N_FEATURES))

    mean, square = np.split(summed(rows, moments) / n, 2)
    start = fresh(mean, np.sqrt(np.maximum(square - mean * mean, 0)) + 1e-3)
    first = fit_rounds(rows, start, positive, (ones + 1) / (ones + zeros + 2), rounds)
    return fit_rounds(rows, first, positive, estimated_prior(first, positive, rows), rounds)


def score(table: DataFrame, net: Network | None, keep: list[str]) -> DataFrame:
    """Of a feature table the ``keep`` columns, then score. The broadcast network has a few thousand weights."""
    shared = table.sparkSession.sparkContext.broadcast(net)
    schema = table.select(*keep).schema

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        net, x = shared.value, batch.column(batch.num_columns - 1).to_pylist()
        got = np.full(len(x), 0.5) if net is None else net.score(np.frombuffer(b"".join(x), np.float32).reshape(-1, N_FEATURES))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(got, pa.float64())], names=[*keep, "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return arrow_map(table.select(*keep, "x"), rows, f"{fields}, score double")


def accept(docs: DataFrame, net: Network | None, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows whose text scores at least ``threshold``; all of them where nothing was learned."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    schema = docs.schema
    columns = schema.names

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        net, texts = shared.value, byte_list(batch.column(1))
        good = np.ones(len(texts), bool)
        if net is not None:
            for a, b in slices([len(t) for t in texts], CHUNK_BYTES):
                good[a:b] = net.score(features(texts[a:b])) >= threshold
        yield pa.RecordBatch.from_arrays([c.filter(pa.array(good)) for c in batch.column(0).flatten()], names=columns)

    return arrow_map(docs.select(F.struct(*columns).alias("row"), F.col(text).cast("string").alias("text")), rows, schema)
