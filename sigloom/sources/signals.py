"""The signal table over ``embeddings``, and a dirty view of it with planted faults.

Vectors of 64 floats stand for 32 I and 32 Q values. SNR and group are made up from the id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LENGTH = 32


def signal_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("vec_id")
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        v.alias("row_index"),
        F.concat(F.lit("sample-"), F.lpad(v.cast("string"), 6, "0")).alias("sample_id"),
        F.slice("embedding", 1, LENGTH).alias("i"),
        F.slice("embedding", LENGTH + 1, LENGTH).alias("q"),
        F.lit("float32").alias("dtype"),
        F.lit("channels_first").alias("representation"),
        F.concat(F.lit("class-"), F.col("label").cast("string")).alias("label"),
        F.when(v % 23 != 0, (v % 20 * 2 - 20).cast("double")).alias("snr_db"),
        F.concat(F.lit("group-"), (v % 37).cast("string")).alias("group_id"),
    )


def dirty_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals with faults by id: NaN, constant, too strong, unknown label, odd SNR; exact copies
    (some with another label) and copies of another gain."""
    clean = signal_view(spark, sf_dir)
    r = F.col("row_index")
    hit = lambda k: r % k == 0

    def changed(x: Column, nan: bool) -> Column:
        first = F.when(hit(17), F.concat(F.array(F.lit(float("nan")).cast("float")), F.slice(x, 2, LENGTH - 1))) if nan else F.when(hit(17), x)
        return first.when(hit(19), F.array_repeat(F.lit(0.1).cast("float"), LENGTH)).when(hit(29), F.transform(x, lambda v: v * F.lit(50.0).cast("float"))).otherwise(x)

    dirty = clean.withColumns(
        {
            "i": changed(F.col("i"), True),
            "q": changed(F.col("q"), False),
            "label": F.when(hit(31), "UNKNOWN").otherwise(F.col("label")),
            "snr_db": F.when(hit(41), float("inf")).when(hit(43), 99.0).otherwise(F.col("snr_db")),
        }
    )
    plain = ~(hit(17) | hit(19) | hit(29))
    copies = clean.where(hit(13) & plain).withColumns({"sample_id": F.concat(F.lit("dup-"), F.lpad(r.cast("string"), 6, "0")), "label": F.when(hit(26), "class-x").otherwise(F.col("label")), "row_index": r + 1_000_000})
    gain = lambda c: F.transform(c, lambda v: v * F.lit(1.01).cast("float"))
    near = clean.where(hit(11) & plain).withColumns({"sample_id": F.concat(F.lit("near-"), F.lpad(r.cast("string"), 6, "0")), "i": gain(F.col("i")), "q": gain(F.col("q")), "row_index": r + 2_000_000})
    return dirty.unionByName(copies).unionByName(near)


#: The same views for DuckDB, as the head of a WITH clause.
SIGNAL_SQL = """
sig AS (
  SELECT vec_id AS row_index, 'sample-' || lpad(CAST(vec_id AS VARCHAR), 6, '0') AS sample_id,
         embedding[1:32] AS i, embedding[33:64] AS q, 'class-' || CAST(label AS VARCHAR) AS label,
         CASE WHEN vec_id % 23 <> 0 THEN CAST(vec_id % 20 * 2 - 20 AS DOUBLE) END AS snr_db,
         'group-' || CAST(vec_id % 37 AS VARCHAR) AS group_id
  FROM embeddings)"""
DIRTY_SQL = (
    SIGNAL_SQL
    + """,
dirty AS (
  SELECT row_index, sample_id,
         CASE WHEN row_index % 17 = 0 THEN list_concat([CAST('nan' AS FLOAT)], i[2:32])
              WHEN row_index % 19 = 0 THEN list_transform(i, lambda v: CAST(0.1 AS FLOAT))
              WHEN row_index % 29 = 0 THEN list_transform(i, lambda v: CAST(v * CAST(50 AS FLOAT) AS FLOAT)) ELSE i END AS i,
         CASE WHEN row_index % 17 = 0 THEN q
              WHEN row_index % 19 = 0 THEN list_transform(q, lambda v: CAST(0.1 AS FLOAT))
              WHEN row_index % 29 = 0 THEN list_transform(q, lambda v: CAST(v * CAST(50 AS FLOAT) AS FLOAT)) ELSE q END AS q,
         CASE WHEN row_index % 31 = 0 THEN 'UNKNOWN' ELSE label END AS label,
         CASE WHEN row_index % 41 = 0 THEN CAST('inf' AS DOUBLE) WHEN row_index % 43 = 0 THEN 99.0 ELSE snr_db END AS snr_db,
         group_id
  FROM sig
  UNION ALL
  SELECT row_index + 1000000, 'dup-' || lpad(CAST(row_index AS VARCHAR), 6, '0'), i, q,
         CASE WHEN row_index % 26 = 0 THEN 'class-x' ELSE label END, snr_db, group_id
  FROM sig WHERE row_index % 13 = 0 AND row_index % 17 <> 0 AND row_index % 19 <> 0 AND row_index % 29 <> 0
  UNION ALL
  SELECT row_index + 2000000, 'near-' || lpad(CAST(row_index AS VARCHAR), 6, '0'),
         list_transform(i, lambda v: CAST(v * CAST(1.01 AS FLOAT) AS FLOAT)), list_transform(q, lambda v: CAST(v * CAST(1.01 AS FLOAT) AS FLOAT)), label, snr_db, group_id
  FROM sig WHERE row_index % 11 = 0 AND row_index % 17 <> 0 AND row_index % 19 <> 0 AND row_index % 29 <> 0)"""
)
