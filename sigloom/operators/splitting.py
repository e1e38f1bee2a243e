"""Group-aware stratified splits."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.functions.signal import snr_bucket
from sigloom.schema import SPLITS
from sigloom.storage import shared_dir, stored

Stratum = tuple[str, str]
#: Groups whose splits are held before they are written.
CHUNK = 1 << 18


class SplitError(ValueError):
    """Splits cannot be made."""


def strata(df: DataFrame, edges: Sequence[float]) -> DataFrame:
    return df.withColumn("bucket", snr_bucket(F.col("snr_db"), edges))


def group_strata(df: DataFrame, edges: Sequence[float]) -> DataFrame:
    """(group_id, label, bucket, n, first): counts, and the first row of each stratum in a group."""
    return strata(df, edges).groupBy("group_id", "label", "bucket").agg(F.count(F.lit(1)).alias("n"), F.min("row_index").alias("first"))


def distribution(df: DataFrame, by: Sequence[str], split: str | None = None) -> DataFrame:
    """(by..., n, fraction), of each split if one is named; totals join back, no global window."""
    keys = [split] if split else []
    counts = df.groupBy(*keys, *by).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("all"))
    joined = counts.join(totals, keys) if keys else counts.crossJoin(F.broadcast(totals))  # one row
    return joined.withColumn("fraction", F.col("n") / F.col("all")).drop("all")


def balance(df: DataFrame, by: str, split: str = "split") -> DataFrame:
    """(split, deviation): the greatest difference of a value's share in a split from its share
    in all; a value that a split lacks has share 0 there."""
    whole = distribution(df, [by]).select(by, F.col("fraction").alias("expected"))
    shares = distribution(df, [by], split).select(split, by, "fraction")
    grid = whole.withColumn(split, F.explode(F.array(*[F.lit(x) for x in SPLITS])))
    return grid.join(shares, [split, by], "left").groupBy(split).agg(F.max(F.abs(F.coalesce("fraction", F.lit(0.0)) - F.col("expected"))).alias("deviation"))


def _counts(df: DataFrame, by: str) -> dict[str, dict[str, float]]:
    """{value: {count, fraction}}, a row a value."""
    return {str(r[by]): {"count": r["n"], "fraction": r["fraction"]} for r in distribution(df, [by]).orderBy(by).collect()}


def split_manifest(df: DataFrame, edges: Sequence[float], fractions: Mapping[str, float], seed: int) -> dict[str, object]:
    """What a split holds: of each split its share asked for and got, rows, groups, and its distributions of labels, SNR
    buckets and both, the digest of its row numbers, and the greatest deviations of any from the whole."""
    rows = strata(df, edges).withColumn("joint", F.concat_ws("|", F.col("label").cast("string"), "bucket"))
    digest = F.sum(F.conv(F.substring(F.sha2(F.col("row_index").cast("string"), 256), 1, 15), 16, 10).cast("decimal(38,0)"))
    facts = {r["split"]: r for r in rows.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("group_id").alias("groups"), digest.alias("digest")).collect()}
    n = sum(r["n"] for r in facts.values())
    splits, worst = {}, {}
    for name in SPLITS:
        own = rows.where(F.col("split") == name)
        held = facts.get(name)
        splits[name] = {"target_fraction": fractions[name], "actual_fraction": held["n"] / n if held else 0.0, "rows": held["n"] if held else 0, "groups": held["groups"] if held else 0, "rows_digest": f"{int(held['digest']):x}" if held else "0"}
        splits[name] |= {f"{by}_distribution": _counts(own, c) for by, c in (("class", "label"), ("snr", "bucket"), ("joint", "joint"))}
    for by, c in (("class", "label"), ("snr", "bucket")):
        worst[f"maximum_{by}_fraction_deviation"] = balance(rows, c).agg(F.max("deviation")).first()[0]
    whole = {"class": _counts(rows, "label"), "snr": _counts(rows, "bucket")}
    return {"schema_version": "1.0", "seed": seed, "edges": list(edges), "rows": n, "groups": sum(r["groups"] for r in facts.values()), "global_distribution": whole, "balance": worst, "test_locked": True, "splits": splits}


def _key(seed: int, value: str) -> str:
    return hashlib.sha256(f"{seed}\0{value}".encode()).hexdigest()


class Greedy:
    """The sequential choice, which sees a group's stratum counts and size only.

    Each group goes where the squared relative errors of sizes, plus twice those of strata, end least.
    While as many groups are left as splits are empty, only empty splits count. Sums follow the order of strata.
    """

    def __init__(self, whole: Mapping[Stratum, int], fractions: Mapping[str, float], seed: int, groups: int) -> None:
        self.index = {t: k for k, t in enumerate(whole)}
        self.aims = {s: [n * fractions[s] for n in whole.values()] for s in SPLITS}
        self.fractions, self.seed, self.left, self.total = fractions, seed, groups, sum(whole.values())
        self.sizes = {s: 0 for s in SPLITS}
        self.held = {s: [0] * len(whole) for s in SPLITS}
        self.errors = np.array([[self._error(s, k, 0) for k in range(len(whole))] for s in SPLITS])

    def _error(self, split: str, k: int, extra: int) -> float:
        aim = self.aims[split][k]
        return ((self.held[split][k] + extra - aim) / max(aim, 1.0)) ** 2

    def _with(self, split: str, cells: Sequence[tuple[int, int]]) -> np.ndarray:
        """The errors of all splits' strata, were the counts in ``split``."""
        errors = self.errors.copy()
        for k, n in cells:
            errors[SPLITS.index(split), k] = self._error(split, k, n)
        return errors

    def place(self, group: str, profile: Mapping[Stratum, int]) -> str:
        size, cells = sum(profile.values()), [(self.index[t], n) for t, n in profile.items()]
        empty = [s for s in SPLITS if not self.sizes[s]]
        options = empty if empty and self.left <= len(empty) else list(SPLITS)
        errors, losses = {s: self._with(s, cells) for s in options}, {}
        for target in options:
            by_size = 0.0
            for s in SPLITS:
                aim = self.total * self.fractions[s]
                by_size += ((self.sizes[s] + (size if s == target else 0) - aim) / aim) ** 2
            losses[target] = by_size + 2.0 * float(np.cumsum(errors[target])[-1])  # one by one, in order
        least = min(losses.values())
        tied = [s for s in options if losses[s] == least]
        best = tied[0] if len(tied) == 1 else min(tied, key=lambda s: (_key(self.seed, f"{group}\0{s}"), s))
        self.left -= 1
        self.sizes[best] += size
        for k, n in cells:
            self.held[best][k] += n
        self.errors = errors[best]
        return best


def group_profiles(counts: DataFrame, seed: int) -> DataFrame:
    """(group_id, profile, size, most, key): a group's stratum counts as one sorted array, and what orders it."""
    held = F.sort_array(F.collect_list(F.struct("label", "bucket", "n")))  # an entry a stratum at most
    key = F.sha2(F.concat(F.lit(str(seed)), F.char(F.lit(0)), F.col("group_id")), 256)
    return counts.groupBy("group_id").agg(held.alias("profile"), F.sum("n").alias("size"), F.max("n").alias("most")).withColumn("key", key)


def greedy_assignments(counts: DataFrame, fractions: Mapping[str, float], seed: int, chunk: int = CHUNK) -> DataFrame:
    """(group_id, split) from (group_id, label, bucket, n, first).

    Largest groups come first, then the greatest stratum, then a seeded key: Spark sorts them. The choice depends on all
    choices before it, so one process makes it, but holds no group: it knows the distinct profiles and the sums by
    split, sees groups pass as (id, number of the profile), and writes where they went every ``chunk`` groups."""
    spark = counts.sparkSession
    profiles = stored(group_profiles(counts, seed), "group-profiles")
    n = profiles.count()
    if n < len(SPLITS):
        raise SplitError(f"{n} groups for {len(SPLITS)} splits")
    kinds = stored(profiles.select("profile").distinct().withColumn("kind", F.monotonically_increasing_id()), "profiles")
    known = {r["kind"]: {(x["label"], x["bucket"]): x["n"] for x in r["profile"]} for r in kinds.toLocalIterator()}
    strata_rows = counts.groupBy("label", "bucket").agg(F.sum("n").alias("n"), F.min("first").alias("first")).collect()
    whole = {(r["label"], r["bucket"]): r["n"] for r in sorted(strata_rows, key=lambda r: r["first"])}
    greedy = Greedy(whole, fractions, seed, n)
    queue = profiles.join(kinds, "profile").orderBy(F.desc("size"), F.desc("most"), "key", "group_id").select("group_id", "kind")
    path, held = f"{shared_dir(spark)}/group-splits-{uuid.uuid4().hex}", []

    def write() -> None:
        spark.createDataFrame(held, "group_id string, split string").write.mode("append").parquet(path)
        held.clear()

    for r in queue.toLocalIterator(prefetchPartitions=True):
        held.append((r["group_id"], greedy.place(r["group_id"], known[r["kind"]])))
        if len(held) == chunk:
            write()
    write()
    return spark.read.schema("group_id string, split string").parquet(path)


def group_splits(df: DataFrame, edges: Sequence[float], fractions: Mapping[str, float], seed: int) -> DataFrame:
    """The rows with their split, all rows of a group in one."""
    if abs(sum(fractions.values()) - 1) > 1e-9 or any(f <= 0 for f in fractions.values()):
        raise SplitError("fractions must be positive and sum to 1")
    counts = stored(group_strata(df, edges), "group-strata")
    if not counts.where("group_id is null").isEmpty():
        raise SplitError("a row has no group")
    return df.join(greedy_assignments(counts, fractions, seed), "group_id")


def seeded_rows(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """The rows with ``held_out``: a permutation by seeded hash, its first max(1, round(n * fraction))
    rows held out. Rows that repeat a row_index share its side."""
    n = df.count()
    k = max(1, round(n * fraction))
    keyed = df.withColumn("_key", F.sha2(F.concat(F.lit(str(seed)), F.char(F.lit(0)), F.coalesce(F.col("row_index").cast("string"), F.lit(""))), 256))
    return keyed.withColumn("held_out", F.col("_key") <= F.lit(_kth_key(keyed.select("_key"), k))).drop("_key")


def _kth_key(keys: DataFrame, k: int) -> str:
    """The k-th least of hexadecimal keys. Counts by leading digits, at most 4096 a pass, narrow the
    range until the keys in it are few, or one."""
    prefix = ""
    while len(prefix) < 63:
        within = keys.where(F.startswith("_key", F.lit(prefix)))
        counts = within.groupBy(F.substring("_key", 1, len(prefix) + 3).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
        for p, n in sorted(tuple(r) for r in counts):
            if k <= n:
                prefix = p
                break
            k -= n
        else:
            return "g"  # fewer keys than k: all lie below
        if n <= 4096:
            return keys.where(F.startswith("_key", F.lit(prefix))).orderBy("_key").limit(k).agg(F.max("_key")).first()[0]
    return prefix + "g"
