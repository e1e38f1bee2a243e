"""Operator 10: mixing sources to target weights.

Sizes are summed per source, targets follow from weights by filling up to a cap, and the
repetition rate of a source is target / size. A document is emitted floor(rate) times, and
once more by a Bernoulli draw whose probability is the fraction: where a hash of seed, id and text,
as a number in [0, 1), is below it. Draws need no neighbours, no order and no shuffle.

A source's seed is one of ``seeds`` candidates: sums of all of them are taken in one pass over
sizes, and the one whose sum comes nearest to the target is used. So even small sources come
near their targets, which a single seed would miss by the spread of independent draws.

Defined results: a null text has size 0; a null source is a source of its own, weighed last;
documents of size 0 are emitted like others; a null id is drawn by its text; rows equal in id
and text draw alike, rows that share only an id draw apart; an empty table gives an empty table;
the mix keeps all input columns, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigloom.llm.common import join_skewed, stored, unit_hash, word_count

CAP, SEED, SEEDS = 3.0, 17, 64


def source_key(source: Column) -> Column:
    """A source as a text that is never null."""
    return F.when(source.isNull(), "").otherwise(F.concat(F.lit("="), source.cast("string")))


def ranked(table: DataFrame, order: Column) -> DataFrame:
    """With ``rank``, from 0: ranges are sorted apart, and only one number a range meets in a window."""
    placed = stored(table.repartitionByRange(order).sortWithinPartitions(order).withColumn("at", F.monotonically_increasing_id()), "ranked")
    placed = placed.withColumn("range", F.shiftright("at", 33)).withColumn("place", F.col("at").bitwiseAND((1 << 33) - 1))
    before = F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = placed.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select("range", before.alias("before"))
    return placed.join(ranges, "range").withColumn("rank", F.col("before") + F.col("place")).drop("at", "range", "place", "before")


def source_targets(sizes: DataFrame, cap: float = CAP, cycle: int = 3) -> DataFrame:
    """(source, size) rows -> (source, source_size, n_docs, weight, target).

    Weights are 1..cycle repeating over sources by code point, null last. Targets share the
    total by weight; what exceeds cap * source_size is shared again among the others. Only
    sums reach the driver; a round caps at least one more source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    per = stored(ranked(per, F.col("source").asc_nulls_last()).withColumn("weight", (F.col("rank") % cycle + 1).cast("double")).drop("rank"), "weights")
    most = F.lit(cap) * F.col("source_size")
    total = per.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while total:
        full = most <= F.lit(level) * F.col("weight")
        now, filled, weight = per.agg(F.count_if(full), F.sum(F.when(full, most)), F.sum(F.when(~full, F.col("weight")))).first()
        if now == capped or not weight:
            break
        capped, level = now, (total - (filled or 0.0)) / weight
    return per.withColumn("target", F.least(most, F.lit(level) * F.col("weight")))


def drawn(seed: Column | int, fraction: Column) -> Column:
    """Whether the document of this id and code gets one copy more."""
    return unit_hash(F.lit(seed).cast("long") if isinstance(seed, int) else seed, F.col("id"), F.col("code")) < fraction


def measured(docs: DataFrame, text: str, doc_id: str, source: str, size: Column | None = None) -> DataFrame:
    """(id, source, of, code, size), stored: what the mix needs to know of each document."""
    table = docs.select(F.col(doc_id).alias("id"), F.col(source).alias("source"), source_key(F.col(source)).alias("of"), F.xxhash64(F.col(text)).alias("code"), (word_count(F.col(text)) if size is None else size).alias("size"))
    return stored(table, "sizes", compression="zstd")


def plan_mix(sizes: DataFrame, cap: float = CAP, seed: int = SEED, seeds: int = SEEDS) -> DataFrame:
    """(of, n_docs, source_size, target, rate, seed), stored, one row a source."""
    targets = source_targets(sizes.select("source", "size"), cap)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = stored(targets.select(source_key(F.col("source")).alias("of"), "source_size", "n_docs", "target", rate.alias("rate")), "targets")
    fraction = F.col("rate") - F.floor("rate")
    rows = join_skewed(sizes, targets, ["of"], "n_docs", sizes.count())
    sums = rows.groupBy("of").agg(*[F.sum(F.when(drawn(seed + k, fraction), F.col("size")).otherwise(0)).alias(f"s{k}") for k in range(seeds)])
    missing = F.col("target") - F.floor("rate") * F.col("source_size")
    nearest = F.array_min(F.array(*[F.struct(F.abs(F.col(f"s{k}") - missing).alias("miss"), F.lit(seed + k).cast("long").alias("seed")) for k in range(seeds)]))
    return stored(targets.join(sums, "of").select("of", "n_docs", "source_size", "target", "rate", nearest["seed"].alias("seed")), "mix")


def copies() -> Column:
    return (F.floor("rate") + drawn(F.col("seed"), F.col("rate") - F.floor("rate")).cast("long")).cast("long")


def mix_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", size: Column | None = None, **options: float) -> DataFrame:
    """One row per document: id and source, then size, source_size, target, rate, seed, copies (how
    often the mix takes the document) and taken = copies * size."""
    sizes = measured(docs, text, doc_id, source, size)
    rows = join_skewed(sizes, plan_mix(sizes, **options), ["of"], "n_docs", sizes.count()).withColumn("copies", copies())
    return rows.select(F.col("id").alias(doc_id), F.col("source").alias(source), "size", "source_size", "target", "rate", "seed", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def emit_mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", size: Column | None = None, **options: float) -> DataFrame:
    """The mix itself: each document's row, with all its columns, as often as the mix takes it."""
    sizes = measured(docs, text, doc_id, source, size)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(doc_id).alias("id"), source_key(F.col(source)).alias("of"), F.xxhash64(F.col(text)).alias("code"))
    rows = join_skewed(rows, plan_mix(sizes, **options), ["of"], "n_docs", sizes.count())
    return rows.select("row", F.explode(F.array_repeat(F.lit(1), copies().cast("int"))).alias("copy")).select("row.*")
