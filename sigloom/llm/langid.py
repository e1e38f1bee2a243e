"""Operator 3: language identification by multinomial naive Bayes over hashed character n-grams.

Training counts the 1- to 3-grams of all training texts per language: a task adds into dense
vectors of at most HELD languages, and emits their non-zero cells when there are more, and at the end; Spark sums
them. One task a language makes its column of log probabilities (float32) of the sums, and only finished columns reach the
driver, which broadcasts the matrix in groups of GROUP languages: a matrix holds 64 MB at most, and texts pass
once for each group. Scoring hashes the n-grams of a batch of whole texts at
once, gathers their matrix rows and sums them per document; the best language and the
sum of likelihoods go on from group to group.

Defined results: a null text, or one without letters, is ``und`` with score 0; rows with a null
language are not learned from; without any training text every prediction is ``und`` with score
0; equal scores go to the first language by code point; a null id keeps its row, repeated rows
give repeated results, and other columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.llm.common import slices, stored

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
GROUP, HELD = 512, 64
CHUNK_CHARS = 1 << 20


def hashed_ngrams(texts: list[str], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: the bucket of the n-gram that starts at each character of the joined
    texts, and where each text starts. N-grams across a text's end get the bucket ``buckets``."""
    joined = "\x00".join(t.replace("\x00", " ").lower() for t in texts) + "\x00"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.flatnonzero(points == 0)
    starts = np.concatenate([[0], ends[:-1] + 1])
    code = np.zeros(len(points), np.uint32)
    crosses = np.zeros(len(points), bool)
    for order in range(1, max(ORDERS) + 1):
        ahead = points[order - 1 :]
        code[: len(ahead)] = code[: len(ahead)] * np.uint32(0x01000193) + ahead * np.uint32(0x9E3779B1)
        crosses[: len(ahead)] |= ahead == 0
        crosses[len(ahead) :] = True
        if order in ORDERS:
            mixed = code ^ (code >> np.uint32(15))
            bucket = ((mixed * np.uint32(0x85EBCA6B + 2 * order)) >> np.uint32(17)).astype(np.int64) % buckets
            bucket[crosses] = buckets
            yield bucket, starts


def count_ngrams(docs: DataFrame, text: str = "text", lang: str = "lang", buckets: int = BUCKETS) -> DataFrame:
    """(lang, bucket, n): n-gram counts of all rows; bucket -1 counts documents."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}

        def emptied() -> Iterator[pa.RecordBatch]:
            for name, own in counts.items():
                own[buckets] = 0
                at = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(np.where(at == buckets + 1, -1, at), pa.int32()), pa.array(own[at], pa.int64())], names=["lang", "bucket", "n"])
            counts.clear()

        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices([len(t) for t in texts], CHUNK_CHARS):
                every = sorted(set(langs[a:b]))
                for names in (every[x : x + HELD] for x in range(0, len(every), HELD)):
                    index = {x: i for i, x in enumerate(names)}
                    own = [i for i in range(a, b) if langs[i] in index]
                    which = np.array([index[langs[i]] for i in own])
                    if len(counts.keys() | index.keys()) > HELD:
                        yield from emptied()
                    for name, n in zip(names, np.bincount(which, minlength=len(names)).tolist(), strict=True):
                        counts.setdefault(name, np.zeros(buckets + 2, np.int64))[-1] += n
                    for bucket, starts in hashed_ngrams([texts[i] for i in own], buckets):
                        row = np.repeat(which, np.diff(np.append(starts, len(bucket))))
                        seen = np.bincount(row * (buckets + 1) + bucket, minlength=len(names) * (buckets + 1)).reshape(len(names), -1)
                        for name, cells in zip(names, seen, strict=True):
                            counts[name][:-1] += cells
        yield from emptied()

    known = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")).where("lang is not null and text is not null")
    return known.mapInArrow(rows, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


Model = list[tuple[list[str], np.ndarray, np.ndarray]]


def train(docs: DataFrame, text: str = "text", lang: str = "lang", buckets: int = BUCKETS, smoothing: float = 0.1, group: int = GROUP) -> Model:
    """For each group: (languages by code point, log priors, log probabilities [buckets + 1, languages]);
    the last row, for n-grams that count for nothing, is 0. Columns are finished in tasks, and those of one group at a
    time reach the driver, and the names of all languages."""
    schema = pa.schema([("lang", pa.string()), ("documents", pa.int64()), ("logs", pa.binary())])

    def column(cells: pa.Table) -> pa.Table:  # of one language: a row a bucket at most
        bucket, n = cells.column("bucket").to_numpy(), cells.column("n").to_numpy()
        dense = np.zeros(buckets)
        dense[bucket[bucket >= 0]] = n[bucket >= 0]
        logs = np.log(dense + smoothing) - np.log(dense.sum() + smoothing * buckets)
        return pa.table({"lang": [cells.column("lang")[0].as_py()], "documents": [int(n[bucket < 0].sum())], "logs": [logs.astype(np.float32).tobytes()]}, schema=schema)

    columns = stored(count_ngrams(docs, text, lang, buckets).groupBy("lang").applyInArrow(column, "lang string, documents long, logs binary"), "languages", compression="zstd")
    known = sorted(r["lang"] for r in columns.select("lang").collect())  # names of languages
    documents = columns.agg(F.sum("documents")).first()[0]
    model = []
    for a in range(0, len(known), group):
        names = known[a : a + group]
        got = {r["lang"]: r for r in columns.where(F.col("lang").between(names[0], names[-1])).toLocalIterator()}
        logs = np.zeros((buckets + 1, len(names)), np.float32)
        for k, x in enumerate(names):
            logs[:buckets, k] = np.frombuffer(got[x]["logs"], np.float32)
        model.append((names, np.log([got[x]["documents"] for x in names]) - np.log(documents), logs))
    return model


def predict(docs: DataFrame, model: Model, keep: list[Column], text: str = "text") -> DataFrame:
    """The ``keep`` columns, then lang_pred and score (the posterior of the prediction)."""
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.struct(*keep).alias("row"), F.when(letters, F.col(text)).alias("text"), F.lit("und").alias("best"), F.lit(float("-inf")).alias("top"), F.lit(0.0).alias("mass"))
    for k, part in enumerate(model):
        rows = scored_by(rows if k == 0 else stored(rows, "languages", compression="zstd"), part, k + 1 < len(model))
    score = F.when(F.col("mass") > 0, 1 / F.col("mass")).otherwise(0.0)
    return rows.select("row.*", F.col("best").alias("lang_pred"), score.alias("score"))


def scored_by(table: DataFrame, part: tuple[list[str], np.ndarray, np.ndarray], more: bool) -> DataFrame:
    """(row, text, best, top, mass) after one more group of languages: the best so far, its log likelihood, and
    the likelihoods of all so far as multiples of it. Texts are kept if there are more groups."""
    shared = table.sparkSession.sparkContext.broadcast(part)
    buckets = part[2].shape[0] - 1

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, prior, logs = shared.value
        step = max(1, (8 * CHUNK_CHARS) // max(8, len(names)))
        for batch in batches:
            texts, pred = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            top, mass = (batch.column(c).to_numpy().copy() for c in (3, 4))
            at = [i for i, t in enumerate(texts) if t is not None]
            for a, b in slices([len(texts[i]) for i in at], CHUNK_CHARS):
                own = at[a:b]
                total = np.tile(prior, (len(own), 1))
                for bucket, starts in hashed_ngrams([texts[i] for i in own], buckets):
                    for x in range(0, len(bucket), step):  # gathered rows stay few, however long a text or many the languages
                        y = min(x + step, len(bucket))
                        first, last = np.searchsorted(starts, x, "right") - 1, np.searchsorted(starts, y, "left")
                        total[first:last] += np.add.reduceat(logs[bucket[x:y]], np.maximum(starts[first:last] - x, 0), axis=0, dtype=np.float64)
                best, high = total.argmax(1), total.max(1)
                peak = np.maximum(high, top[own])
                mass[own] = mass[own] * np.exp(top[own] - peak) + np.exp(total - peak[:, None]).sum(1)
                for i, k, h in zip(own, best.tolist(), high.tolist(), strict=True):
                    if h > top[i]:
                        pred[i] = names[k]
                top[own] = peak
            kept = batch.column(1) if more else pa.nulls(batch.num_rows, pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), kept, pa.array(pred, pa.string()), pa.array(top), pa.array(mass)], names=["row", "text", "best", "top", "mass"])

    return table.mapInArrow(rows, table.schema)
