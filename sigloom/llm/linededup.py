"""Operator 6: repeated passages, by content-defined chunks and runs of lines. DataFrame functions only.

Lines are hashed, and at each line a rolling hash over the last WINDOW line hashes decides
whether a chunk ends there; so boundaries move with the text and an insertion shifts none beyond
it. A line of SOLO_WORDS words or more stands as a chunk of its own, since passages often come as
one long line. Chunks of two lines or more, and solo lines, are candidates; those whose hash
occurs twice are compared byte by byte with the first occurrence (the least by document id,
then text hash, then place), and equal ones are removed with their line ends.

``dedup_lines`` removes chunks alone, so it misses passages that no boundary encloses.
``dedup_passages``, which the query and the pipeline run, finds every repeated run of whole lines
of SOLO_WORDS words or more: beside the chunks it hashes, from each line on and up to each line,
the shortest run of that many words. Any repeated passage is covered by such runs that lie inside
it, wherever chunk boundaries fall. Runs that repeat are laid side by side, joined where they
continue in the same source, and compared byte by byte with it; a run that overlaps its own first
occurrence (a text that repeats itself line by line) is no repeat. Hashes and places find the
repeats; texts travel only of documents that have or hold a repeat. A passage that many
documents share goes to parts of them, of about the root of their number.

Defined results: a null text stays null; an empty text stays empty; a document all of whose
chunks occur before keeps its row with an empty text; rows equal in id and text count as one
document, and all keep what that document keeps; null ids come first; documents without a
repeated chunk keep their text to the byte.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigloom.llm import common
from sigloom.llm.common import join_skewed, keys, stored, word_count

WINDOW, DIVISOR, SOLO_WORDS = 3, 4, 50


def is_wide(text: Column, solo_words: int) -> Column:
    return F.when(F.length(text) < 2 * solo_words - 1, False).otherwise(word_count(text) >= solo_words)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def starts_chunk(lines: Column, x: Column, i: Column, window: int, divisor: int) -> Column:
    """Whether line x at place i starts a chunk; lines are structs with h and solo."""
    rolling = F.xxhash64(*[F.when(i > k, F.get(lines, F.greatest(i - k - 1, F.lit(0)))["h"]) for k in range(window)])
    return (i == 0) | x["solo"] | F.get(lines, F.greatest(i - 1, F.lit(0)))["solo"] | (F.pmod(rolling, F.lit(divisor)) == 0)


def line_chunks(text: Column, window: int = WINDOW, divisor: int = DIVISOR, solo_words: int = SOLO_WORDS) -> Column:
    """array<string>: the text's chunks, which joined by line feeds give it back.

    Chunks are parted by text: lines are joined again with a mark that says whether a chunk
    starts, and no line holds the line feed that the mark begins with."""
    described = F.transform(F.split(text, "\n", -1), lambda x: F.struct(x.alias("line"), F.xxhash64(x).alias("h"), is_wide(x, solo_words).alias("solo")))

    def joined(lines: Column) -> Column:
        def marked(x: Column, i: Column) -> Column:
            return F.concat(F.when(starts_chunk(lines, x, i, window, divisor), "\nB").otherwise("\nC"), x["line"])

        return F.array_join(F.transform(lines, marked), "")

    parts = F.split(bound(described, joined), "\nB", -1)
    return bound(parts, lambda p: F.transform(F.slice(p, F.lit(2), F.size(p)), lambda x: F.replace(x, F.lit("\nC"), F.lit("\n"))))


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, divisor: int = DIVISOR, solo_words: int = SOLO_WORDS) -> DataFrame:
    """The documents, each text without the chunks that occur before; columns as they were."""
    names = docs.columns
    key = [F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("code")]
    split = docs.where(F.col(text).isNotNull()).select(*key, F.posexplode(line_chunks(F.col(text), window, divisor, solo_words)).alias("place", "chunk"))
    chunks = split.where(F.contains("chunk", F.lit("\n")) | is_wide(F.col("chunk"), solo_words)).withColumn("h", F.xxhash64("chunk", F.length("chunk")))
    seen = chunks.select("h", F.struct("id", "code", "place").alias("at"))
    repeated = seen.groupBy("h").agg(F.min("at").alias("first"), F.max("at").alias("last")).where("first <> last").select("h", "first")
    again = stored(chunks.join(repeated, "h").select("h", "first", F.struct("id", "code", "place").alias("at"), "chunk"), "chunks", compression="zstd")
    firsts = again.where(F.col("at").eqNullSafe(F.col("first"))).select("h", F.col("chunk").alias("kept")).dropDuplicates(["h"])
    removed = again.where(~F.col("at").eqNullSafe(F.col("first"))).join(firsts, "h").where("chunk = kept")
    removed = removed.groupBy(F.col("at.id").alias("of_id"), F.col("at.code").alias("of_code")).agg(F.collect_set("at.place").alias("places"))

    held = docs.select(F.struct(*names).alias("row"), *key, F.col(text).alias("text"))
    joined = held.join(removed, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("code") == F.col("of_code")), "left")
    left = F.filter(line_chunks(F.col("text"), window, divisor, solo_words), lambda c, i: ~F.array_contains(F.col("places"), i))
    cleaned = F.when(F.col("places").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return joined.select(*[cleaned.alias(n) if n == text else F.col("row")[n].alias(n) for n in names])


def line_runs(text: Column, words: int = SOLO_WORDS, window: int = WINDOW, divisor: int = DIVISOR) -> Column:
    """array<struct<from, to, h>>: the runs of lines that are looked up, with their hashes: from
    and up to each line that has words the shortest run of ``words`` words, chunks of two lines or
    more, and a whole text with blank lines at its ends."""
    described = F.transform(F.split(text, "\n", -1), lambda x: F.struct(F.xxhash64(x).alias("h"), word_count(x).cast("int").alias("n")))

    def reach(part: Column) -> Column:
        """The place at which the lines of part have come to the words, or null."""
        step = lambda s, x: F.when(s["n"] >= words, s).otherwise(F.struct((s["n"] + x["n"]).alias("n"), x["place"].alias("place")))
        return F.aggregate(part, F.struct(F.lit(0).alias("n"), F.lit(-1).alias("place")), step, lambda s: F.when(s["n"] >= words, s["place"]))

    def runs(counted: Column) -> Column:
        return bound(F.transform(counted, lambda x: F.struct(x["h"].alias("h"), x["n"].alias("n"), (x["n"] >= words).alias("solo"))), runs_of)

    def runs_of(lines: Column) -> Column:
        last = (F.size(lines) - 1).cast("int")
        placed = F.transform(lines, lambda x, i: F.struct(x["n"].alias("n"), i.alias("place")))

        def windows(full: Column) -> Column:  # every line of full has a word, so ``words`` of them suffice
            range_of = lambda a, b: F.struct(a.alias("from"), b.alias("to"))
            ahead = F.transform(full, lambda x, k: range_of(x["place"], F.when(x["n"] >= words, x["place"]).otherwise(reach(F.slice(full, k + 1, F.lit(words))))))
            behind = F.transform(full, lambda x, k: range_of(F.when(x["n"] < words, reach(F.reverse(F.slice(full, F.greatest(k - words + 2, F.lit(1)), F.least(k + 1, F.lit(words)))))), x["place"]))
            whole = F.when((F.size(full) > 0) & ((F.element_at(lines, 1)["n"] == 0) | (F.element_at(lines, -1)["n"] == 0)) & F.get(ahead, 0)["to"].isNotNull(), F.array(range_of(F.lit(0), last))).otherwise(F.array().cast("array<struct<from:int,to:int>>"))
            return F.concat(ahead, behind, whole)

        starts = F.filter(F.transform(lines, lambda x, i: F.when(starts_chunk(lines, x, i, window, divisor), i)), lambda i: i.isNotNull())
        chunks = bound(starts, lambda p: F.transform(p, lambda a, k: F.struct(a.alias("from"), (F.coalesce(F.get(p, k + 1), last + 1) - 1).cast("int").alias("to"))))
        found = F.array_distinct(F.concat(bound(F.filter(placed, lambda x: x["n"] > 0), windows), F.filter(chunks, lambda c: c["to"] > c["from"])))
        hashes = F.transform(lines, lambda x: x["h"])
        hashed = lambda hs: F.transform(F.filter(found, lambda r: r["from"].isNotNull() & r["to"].isNotNull()), lambda r: F.struct(r["from"].alias("from"), r["to"].alias("to"), F.xxhash64(F.slice(hs, r["from"] + 1, r["to"] - r["from"] + 1)).alias("h")))
        return bound(hashes, hashed)

    return bound(described, runs)


def key_of(doc_id: Column) -> Column:
    """A document id as a text that is never null."""
    return F.when(doc_id.isNull(), "").otherwise(F.concat(F.lit("="), doc_id.cast("string")))


def repeats(docs: DataFrame, text: str, doc_id: str, words: int) -> DataFrame:
    """(doc, code, from, to, of_doc, of_code, of_from, of_to), stored: spans of lines and the span before
    whose hash they have, in the document that has it first."""
    runs = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("code"), F.explode(line_runs(F.col(text), words)).alias("run"))
    runs = stored(runs.select(F.col("run.h").alias("h"), F.struct("id", "code", "run.from", "run.to").alias("at")), "runs", compression="zstd")
    repeated = runs.groupBy("h").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count(F.lit(1)).alias("n")).where("first <> last").select("h", "first", "n")
    repeated = stored(repeated, "repeated-runs", compression="zstd")
    own = F.col("at.id").eqNullSafe(F.col("first.id")) & (F.col("at.code") == F.col("first.code")) & (F.col("at.from") <= F.col("first.to"))
    again = join_skewed(runs, repeated, ["h"], "n", runs.count()).where(~own)
    again = again.select(key_of(F.col("at.id")).alias("doc"), "at.code", "at.from", "at.to", key_of(F.col("first.id")).alias("of_doc"), F.col("first.code").alias("of_code"), (F.col("first.from") - F.col("at.from")).alias("shift")).distinct()

    # Each line to the first run that has it; neighbours of one source and shift become one span.
    source = F.struct("of_doc", "of_code", "shift")
    of = Window.partitionBy("doc", "code").orderBy("from", F.desc("to"), source)
    parts = again.withColumn("before", F.max("to").over(of.rowsBetween(Window.unboundedPreceding, -1)))
    parts = parts.withColumn("from", F.greatest("from", F.coalesce(F.col("before") + 1, F.lit(0)))).where("from <= to")
    by = Window.partitionBy("doc", "code").orderBy("from")
    goes_on = (F.lag("to").over(by) + 1 == F.col("from")) & (F.lag(source).over(by) == source)
    parts = parts.withColumn("new", F.when(goes_on, 0).otherwise(1)).withColumn("span", F.sum("new").over(by))
    spans = parts.groupBy("doc", "code", "span", "of_doc", "of_code", "shift").agg(F.min("from").alias("from"), F.max("to").alias("to"))
    return stored(spans.select("doc", "code", "from", "to", "of_doc", "of_code", (F.col("from") + F.col("shift")).alias("of_from"), (F.col("to") + F.col("shift")).alias("of_to")), "spans", compression="zstd")


def lines_of(text: Column, first: Column, last: Column) -> Column:
    return F.array_join(F.slice(F.split(text, "\n", -1), first + 1, last - first + 1), "\n")


def dedup_passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = SOLO_WORDS) -> DataFrame:
    """The documents, each text without the runs of lines that occur before; columns as they were."""
    names, passage = docs.columns, ["of_doc", "of_code", "of_from", "of_to"]
    spans = repeats(docs, text, doc_id, words)
    held = docs.select(F.struct(*names).alias("row"), key_of(F.col(doc_id)).alias("doc"), F.xxhash64(F.col(text)).alias("code"), F.col(text).alias("text"))

    # What the spans repeat, from the texts of their sources, to each part of those that repeat it.
    counts = stored(spans.groupBy(*passage).agg(F.count(F.lit(1)).alias("n")), "passages")
    parts = F.ceil(F.sqrt("n"))
    dealt = join_skewed(spans, counts, passage, "n", spans.count()).withColumn("part", F.pmod(F.xxhash64("doc", "code", "from"), parts)).drop("n")
    sources = stored(spans.select(F.col("of_doc").alias("doc"), F.col("of_code").alias("code")).distinct(), "sources")
    whole = held.where("text is not null").select("doc", "code", "text").join(keys(sources), ["doc", "code"], "left_semi").dropDuplicates(["doc", "code"])
    whole = whole.select(F.col("doc").alias("of_doc"), F.col("code").alias("of_code"), F.col("text").alias("whole"))
    heads = dealt.select(*passage, "part").distinct().join(whole, ["of_doc", "of_code"]).select(*passage, "part", lines_of(F.col("whole"), F.col("of_from"), F.col("of_to")).alias("kept"))
    removed = dealt.join(heads, [*passage, "part"]).groupBy("doc", "code").agg(F.collect_set(F.struct("from", "to", "kept")).alias("spans"))

    affected = stored(spans.select("doc", "code").distinct(), "affected")
    if affected.count() <= common.MAX_KEYS:
        rest = held.join(F.broadcast(affected), ["doc", "code"], "left_anti").select("row.*")
        joined = held.join(F.broadcast(affected), ["doc", "code"], "left_semi").join(removed, ["doc", "code"])
    else:  # one shuffle of all documents
        rest, joined = None, held.join(removed.hint("merge"), ["doc", "code"], "left")

    def left(lines: Column) -> Column:
        same = F.filter(F.col("spans"), lambda s: F.array_join(F.slice(lines, s["from"] + 1, s["to"] - s["from"] + 1), "\n") == s["kept"])
        ends = F.array_sort(F.transform(same, lambda s: F.struct(s["from"].alias("from"), s["to"].alias("to"))))

        def between(e: Column) -> Column:
            stops = F.concat(e, F.array(F.struct(F.size(lines).cast("int").alias("from"), F.lit(0).alias("to"))))

            def gap(s: Column, i: Column) -> Column:
                begin = F.when(i == 0, 0).otherwise(F.get(e, F.greatest(i - 1, F.lit(0)))["to"] + 1)
                return F.slice(lines, begin + 1, s["from"] - begin)

            return F.flatten(F.transform(stops, gap))

        return F.array_join(bound(ends, between), "\n")

    cleaned = F.when(F.col("spans").isNull(), F.col("text")).otherwise(bound(F.split(F.col("text"), "\n", -1), left))
    done = joined.select(*[cleaned.alias(n) if n == text else F.col("row")[n].alias(n) for n in names])
    return done if rest is None else rest.union(done)
