"""Exact clusters, near pairs, groups, and leakage across splits."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigloom.functions.ragged import by_length, lists_of
from sigloom.functions.signal import content_key, group_key
from sigloom.schema import SPLITS, canonical_json
from sigloom.storage import stored


class PolicyError(ValueError):
    """A policy's settings are not valid."""


#: Contents of one signature that meet in a task, at most twice as many.
CHUNK = 256


@dataclass(frozen=True)
class DuplicatePolicy:
    similarity: float = 0.999
    decimals: int = 3
    remove_dc: bool = False

    def __post_init__(self) -> None:
        if isinstance(self.decimals, bool) or not isinstance(self.decimals, int) or not 0 <= self.decimals <= 12 or not 0 < self.similarity <= 1:
            raise PolicyError(f"similarity must lie above 0, up to 1, and decimals between 0 and 12: {self}")


GroupAdapter = Callable[[], Column]


def explicit_group() -> Column:
    return F.nullif(F.trim("group_id"), F.lit(""))


def source_sequence_group() -> Column:
    return group_key(F.col("source_id"), F.col("source_version"), F.col("sequence_id"))


def exact_members(df: DataFrame, key: Column | None = None) -> DataFrame:
    """(sample_id, label, key, members, labels, canonical) of rows whose content others have too.
    Cluster facts come from a partial aggregate, and join back on the key."""
    keyed = df.select("sample_id", "label", (content_key(F.col("i"), F.col("q")) if key is None else key).alias("key"))
    facts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("label").alias("least"), F.max("label").alias("most"), F.min("sample_id").alias("canonical")).where("members > 1")
    joined = keyed.join(facts, "key")
    return joined.select("sample_id", "label", "key", "members", (F.col("least") != F.col("most")).alias("conflict"), "canonical")


def fingerprints(df: DataFrame) -> DataFrame:
    """(sample_id, fingerprint): SHA-256 of a header (dtype, representation, shape) as canonical JSON, a NUL,
    and the signal's bytes in C order, so that another dtype, shape or sign of zero is another content. Integer
    and wider types than the columns' are hashed as the bytes of the ``dtype`` column's type."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            kinds, forms, out = batch.column(3).to_pylist(), batch.column(4).to_pylist(), [""] * batch.num_rows
            for at, (i, q) in by_length(batch.column(1), batch.column(2)):
                for k, r in enumerate(at.tolist()):
                    kind = np.dtype(kinds[r])
                    x = (i[k] + 1j * q[k]).astype(kind) if forms[r] == "complex" else np.stack([i[k], q[k]]).astype(kind)
                    if forms[r] == "complex":  # the sum may lose the sign of a zero
                        x.real, x.imag = i[k], q[k]
                    header = canonical_json({"representation": forms[r], "shape": list(x.shape), "dtype": x.dtype.str})
                    out[r] = hashlib.sha256(header.encode() + b"\0" + x.tobytes()).hexdigest()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], names=["sample_id", "fingerprint"])

    return df.select("sample_id", "i", "q", "dtype", "representation").mapInArrow(rows, "sample_id string, fingerprint string")


def unit_vectors(df: DataFrame, policy: DuplicatePolicy) -> DataFrame:
    """(key, re, im, signatures): unit complex vectors with the phase of their largest sample removed,
    one a content, and hashes of the vectors quantised in three ways. Zero or non-finite signals raise."""
    decimals, remove_dc = policy.decimals, policy.remove_dc

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            places, real, imag = [], [], []
            signed: list[list[int]] = [[]] * batch.num_rows
            for at, (i, q) in by_length(batch.column(1), batch.column(2)):
                v = i.astype(np.float64) + 1j * q.astype(np.float64)
                if remove_dc:
                    v = v - v.mean(axis=1, keepdims=True)
                norm = np.linalg.norm(v, axis=1, keepdims=True)
                if not v.shape[1] or not np.isfinite(norm).all() or (norm == 0).any():
                    raise ValueError("near-duplicate analysis needs finite signals with power")
                v = v / norm
                line, top = np.arange(len(v)), np.abs(v).argmax(axis=1)
                v = v * np.exp(-1j * np.angle(v[line, top]))[:, None]
                v[line, top] = np.abs(v[line, top])
                values = np.concatenate([v.real, v.imag], axis=1) * 10.0**decimals
                codes = [np.floor(values + o).astype("<i8") for o in (-0.5, 0.0, 0.5)]
                for k, r in enumerate(at.tolist()):
                    signed[r] = [int.from_bytes(hashlib.blake2b(c[k].tobytes(), digest_size=8).digest(), "little", signed=True) for c in codes]
                places.append(at)
                real.append(v.real)
                imag.append(v.imag)
            kind = pa.float64()
            yield pa.RecordBatch.from_arrays([batch.column(0), lists_of(places, real, kind), lists_of(places, imag, kind), pa.array(signed, pa.list_(pa.int64()))], names=["key", "re", "im", "signatures"])

    contents = df.select(content_key(F.col("i"), F.col("q")).alias("key"), "i", "q").dropDuplicates(["key"])
    return contents.mapInArrow(rows, "key string, re array<double>, im array<double>, signatures array<bigint>")


def signature_sizes(vectors: DataFrame) -> DataFrame:
    """(s, n): signatures that several contents have."""
    return vectors.select("key", F.explode(F.array_distinct("signatures")).alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _block(policy: DuplicatePolicy) -> Callable[[pa.Table], pa.Table]:
    """The pairs of one block: what its two chunks, or one chunk with itself, have in common by this
    signature and none before it."""
    schema = pa.schema([("left_key", pa.string()), ("right_key", pa.string()), ("similarity", pa.float64())])

    def pairs(block: pa.Table) -> pa.Table:
        own, lo, hi, s = (block.column(c).to_numpy() for c in ("own", "lo", "hi", "s"))
        keys = np.array(block.column("key").to_pylist(), object)
        left = np.flatnonzero(own == lo[0])
        right = left if lo[0] == hi[0] else np.flatnonzero(own == hi[0])
        out: list[tuple[str, str, float]] = []
        signs = block.column("signatures").combine_chunks().flatten().to_numpy().reshape(len(keys), -1)
        x: list[np.ndarray | None] = [None] * len(keys)
        size = np.zeros(len(keys), np.int64)
        for at, (re, im) in by_length(block.column("re").combine_chunks(), block.column("im").combine_chunks()):
            size[at] = re.shape[1]
            for k, r in enumerate(at.tolist()):
                x[r] = re[k] + 1j * im[k]
        for length in np.unique(size):  # signatures are hashes, so that lengths may differ
            a, b = left[size[left] == length], right[size[right] == length]
            if not len(a) or not len(b):
                continue
            near = np.minimum(1.0, np.round(np.abs(np.stack([x[k] for k in a]).conj() @ np.stack([x[k] for k in b]).T), 12))
            fits = near >= policy.similarity
            i, j = np.nonzero(fits & (keys[a][:, None] < keys[b][None, :] if lo[0] == hi[0] else keys[a][:, None] != keys[b][None, :]))
            for u, v in zip(i.tolist(), j.tolist(), strict=True):
                if min(set(signs[a[u]].tolist()) & set(signs[b[v]].tolist())) == s[0]:
                    p, r = sorted((keys[a[u]], keys[b[v]]))
                    out.append((p, r, float(near[u, v])))
        return pa.table(dict(zip(schema.names, ([list(c) for c in zip(*out, strict=True)] or [[], [], []]), strict=True)), schema=schema)

    return pairs


def near_contents(df: DataFrame, policy: DuplicatePolicy, chunk: int = CHUNK) -> DataFrame:
    """(left_key, right_key, similarity): contents that share a signature and correlate enough, each pair once.

    A signature's contents are dealt to chunks of about ``chunk``, and every pair of chunks is a block, so that
    no task holds more than two chunks whatever a signature's size; vectors are computed once, and stored."""
    vectors = stored(unit_vectors(df, policy), "unit-vectors")
    sizes = stored(signature_sizes(vectors), "signature-sizes")
    parts = F.ceil(F.col("n") / chunk).cast("int")
    postings = vectors.select("key", F.explode(F.array_distinct("signatures")).alias("s")).join(sizes.hint("merge"), "s")
    own = postings.select("key", "s", F.pmod(F.xxhash64("key"), parts).cast("int").alias("own"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
    dealt = own.select("key", "s", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")).join(vectors.hint("merge"), "key")
    return dealt.groupBy("s", "lo", "hi").applyInArrow(_block(policy), "left_key string, right_key string, similarity double")


def near_pairs(df: DataFrame, policy: DuplicatePolicy, chunk: int = CHUNK) -> DataFrame:
    """(left_id, right_id, similarity): the rows of near contents, left_id the lesser. Contents are compared once,
    however many rows have them; rows of one content are no pairs."""
    near = near_contents(df, policy, chunk)
    ids = df.select("sample_id", content_key(F.col("i"), F.col("q")).alias("key"))
    left, right = (ids.select(F.col("key").alias(f"{s}_key"), F.col("sample_id").alias(s)) for s in ("left", "right"))
    rows = near.join(left, "left_key").join(right, "right_key")
    return rows.select(F.least("left", "right").alias("left_id"), F.greatest("left", "right").alias("right_id"), "similarity")


def assignment_issues(rows: DataFrame, assignments: DataFrame) -> DataFrame:
    """(sample_id, error_code) for samples without a split, or with a name that is none.
    Assigned ids that are not in the table raise ``split.unknown_sample`` rows."""
    both = rows.select("sample_id").join(assignments.select(F.col("sample_id").alias("of"), "split"), F.col("sample_id") == F.col("of"), "full_outer")
    code = F.when(F.col("sample_id").isNull(), "split.unknown_sample").when(F.col("split").isNull(), "split.assignment_missing").when(~F.col("split").isin(*SPLITS), "split.assignment_invalid")
    return both.select(F.coalesce("sample_id", "of").alias("sample_id"), code.alias("error_code")).where("error_code is not null")


def cross_split(members: DataFrame, by: str, assignments: DataFrame, code: str) -> DataFrame:
    """(error_code, key, splits, n) of keys whose members lie in several valid splits."""
    joined = members.join(assignments.where(F.col("split").isin(*SPLITS)), "sample_id").where(F.col(by).isNotNull())
    found = joined.groupBy(F.col(by).alias("key")).agg(F.array_join(F.sort_array(F.collect_set("split")), ",").alias("splits"), F.count(F.lit(1)).alias("n"))
    return found.where(F.contains("splits", F.lit(","))).select(F.lit(code).alias("error_code"), "key", "splits", "n")


def cross_split_pairs(pairs: DataFrame, assignments: DataFrame) -> DataFrame:
    valid = assignments.where(F.col("split").isin(*SPLITS))
    left, right = (valid.select(F.col("sample_id").alias(f"{s}_id"), F.col("split").alias(f"{s}_split")) for s in ("left", "right"))
    return pairs.join(left, "left_id").join(right, "right_id").where("left_split <> right_split").select(F.lit("leakage.near_cross_split").alias("error_code"), "left_id", "right_id", "left_split", "right_split", "similarity")


def first_members(df: DataFrame, by: Column) -> DataFrame:
    """Each row with the least id of its key."""
    return df.withColumn("canonical", F.min("sample_id").over(Window.partitionBy(by)))


class LeakageError(ValueError):
    """A table cannot be analysed for leakage."""


#: Beginnings of the codes that keep a table from being split.
BLOCKING = ("duplicate.", "group.", "split.", "leakage.")


def leakage_issues(df: DataFrame, policy: DuplicatePolicy, assignments: DataFrame | None = None, group: GroupAdapter = explicit_group) -> DataFrame:
    """(error_code, key, sample_id, splits, similarity): all that is wrong with the samples as a whole.

    One row a member of an issue, so that no issue grows into one row; members of one issue share
    ``key``: the least id of a cluster, a group, both ids of a pair, or the sample itself. Null or
    repeated ids raise. Assigned ids that are not in the table are issues.
    """
    ids = df.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("repeated"), F.count_if(F.col("sample_id").isNull()).alias("blank")).first()
    if ids["repeated"] or ids["blank"]:
        raise LeakageError(f"{ids['repeated']} sample ids repeat, {ids['blank']} are null")
    none = F.lit(None).cast("string")

    def issue(rows: DataFrame, code: str | Column, key: str, splits: Column = none, similarity: Column | None = None) -> DataFrame:
        score = F.lit(None).cast("double") if similarity is None else similarity
        return rows.select((F.lit(code) if isinstance(code, str) else code).alias("error_code"), F.col(key).alias("key"), "sample_id", splits.alias("splits"), score.alias("similarity"))

    def both(pairs: DataFrame) -> DataFrame:
        keyed = pairs.withColumn("key", F.concat_ws("|", "left_id", "right_id"))
        return keyed.withColumn("sample_id", F.explode(F.array("left_id", "right_id")))

    grouped = df.select("sample_id", group().alias("of"))
    exact, near = stored(exact_members(df), "exact-members"), stored(near_pairs(df, policy), "near-pairs")
    parts = [
        issue(grouped.where("of is null"), "group.unresolved", "sample_id"),
        issue(exact, "duplicate.exact", "canonical"),
        issue(exact.where("conflict"), "duplicate.label_conflict", "canonical"),
        issue(both(near), "duplicate.near", "key", similarity=F.col("similarity")),
    ]
    if assignments is not None:
        valid = assignments.where(F.col("split").isin(*SPLITS))
        parts.append(issue(assignment_issues(df, assignments), F.col("error_code"), "sample_id"))
        for members, by, code in ((grouped, "of", "leakage.group_cross_split"), (exact, "canonical", "leakage.exact_cross_split")):
            crossing = cross_split(members, by, assignments, code).select(F.col("key").alias(by), "splits")
            parts.append(issue(members.select("sample_id", by).join(valid.select("sample_id"), "sample_id").join(crossing, by), code, by, F.col("splits")))
        pairs = both(cross_split_pairs(near, assignments))
        parts.append(issue(pairs, "leakage.near_cross_split", "key", F.array_join(F.array_sort(F.array("left_split", "right_split")), ","), F.col("similarity")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def ordered_issues(issues: DataFrame) -> DataFrame:
    """Issues in their stable order: code, key, member, splits, similarity, by a range sort."""
    return issues.orderBy("error_code", F.asc_nulls_first("key"), "sample_id", F.asc_nulls_first("splits"), F.asc_nulls_first("similarity"))


def leakage_summary(issues: DataFrame) -> DataFrame:
    """One row: issues, the samples they name, and ``split_ready``, whether none blocks a split."""
    blocks = F.lit(False)
    for start in BLOCKING:
        blocks = blocks | F.startswith("error_code", F.lit(start))
    return issues.agg(F.countDistinct("error_code", "key").alias("issues"), F.countDistinct("sample_id").alias("samples"), (F.count_if(blocks) == 0).alias("split_ready"))
