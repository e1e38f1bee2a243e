"""All queries over the reference tables, each with its SQL for DuckDB where SQL can say it.

Floats are rounded to six places on both sides, counts are long."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sigloom.functions import signal as S
from sigloom.operators import duplicates, eda, features, gather, models, preprocessing, quarantine, splitting, validation
from sigloom.sources.signals import DIRTY_SQL, LENGTH, SIGNAL_SQL, dirty_view, signal_view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, view: str = "") -> Callable[[Query], Query]:
    """Registers a query; ``view`` is the head of a WITH clause put before its SQL."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = f"WITH {view.strip()}{',' if sql.lstrip().startswith('WITH ') else ''} {sql.strip().removeprefix('WITH ')}" if view else sql.strip()
        return function

    return register


def r6(c: Column | str) -> Column:
    return F.round(c, 6) + F.lit(0.0)


CLASSES = tuple(f"class-{k}" for k in range(10))
POLICY = validation.ValidationPolicy(LENGTH, CLASSES, 1.0, 1e-8, 8.0, -20.0, 18.0)
DUPLICATES = duplicates.DuplicatePolicy()
EDGES = (-10.0, 0.0, 10.0)
FRACTIONS = {"train": 0.6, "validation": 0.2, "test": 0.2}

PAIRS = "pairs AS (SELECT row_index, sample_id, label, CAST(unnest(i) AS DOUBLE) AS x, CAST(unnest(q) AS DOUBLE) AS y, unnest(range(len(i))) AS k FROM {0})"
POWER = "powers AS (SELECT row_index, sample_id, label, avg(x*x + y*y) AS p FROM pairs GROUP BY ALL)"


def over(table: str, *more: str) -> str:
    """WITH head: the views, exploded pairs of ``table``, and more."""
    return ",\n".join([(DIRTY_SQL if table == "dirty" else SIGNAL_SQL).strip(), PAIRS.format(table), *more])


# Exploration


@query("SELECT channel, round(min(v),6)+0.0 AS minimum, round(max(v),6)+0.0 AS maximum, round(avg(v),6)+0.0 AS mean, round(stddev_pop(v),6)+0.0 AS std FROM (SELECT 'i' AS channel, x AS v FROM pairs UNION ALL SELECT 'q', y FROM pairs UNION ALL SELECT 'power', p FROM powers) GROUP BY channel", over("sig", POWER))
def eda_numeric_summary(spark: SparkSession, d: str) -> DataFrame:
    return eda.numeric_summary(signal_view(spark, d)).select("channel", *[r6(c).alias(c) for c in ("minimum", "maximum", "mean", "std")])


@query("SELECT label, count(*) AS n FROM dirty GROUP BY label", DIRTY_SQL)
def eda_class_distribution(spark: SparkSession, d: str) -> DataFrame:
    return eda.class_distribution(dirty_view(spark, d))


@query("SELECT CASE WHEN row_index % 3 = 0 THEN 'int' ELSE 'str' END AS kind, CASE WHEN row_index % 3 = 0 THEN substr(label, 7) ELSE label END AS label, count(*) AS n FROM sig GROUP BY 1, 2", SIGNAL_SQL)
def eda_typed_classes(spark: SparkSession, d: str) -> DataFrame:
    whole = F.col("row_index") % 3 == 0
    mixed = signal_view(spark, d).withColumn("label", F.when(whole, F.substring("label", 7, 9)).otherwise(F.col("label")))
    return eda.typed_distribution(mixed, kind=F.when(whole, "int").otherwise("str"))


@query("SELECT CASE WHEN isfinite(snr_db) THEN snr_db END AS snr_db, count(*) AS n FROM dirty GROUP BY 1", DIRTY_SQL)
def eda_snr_distribution(spark: SparkSession, d: str) -> DataFrame:
    return eda.snr_distribution(dirty_view(spark, d))


@query("SELECT CAST(len(i) AS INTEGER) AS signal_length, count(*) AS n FROM sig GROUP BY 1", SIGNAL_SQL)
def eda_length_distribution(spark: SparkSession, d: str) -> DataFrame:
    return eda.length_distribution(signal_view(spark, d))


@query("SELECT sample_id, round(p,6)+0.0 AS power FROM powers", over("sig", POWER))
def eda_power_per_sample(spark: SparkSession, d: str) -> DataFrame:
    return signal_view(spark, d).select("sample_id", r6(S.mean_power(F.col("i"), F.col("q"))).alias("power"))


@query("SELECT sample_id, label FROM sig ORDER BY sample_id LIMIT 8", SIGNAL_SQL)
def eda_first_samples(spark: SparkSession, d: str) -> DataFrame:
    """The report's feature: the first eight samples by id."""
    return signal_view(spark, d).select("sample_id", "label").orderBy("sample_id").limit(8)


DFT = """dft AS (SELECT sample_id, f.k, sum(x*cos(2*pi()*((f.k+16)%32)*pairs.k/32) + y*sin(2*pi()*((f.k+16)%32)*pairs.k/32)) AS re,
 sum(y*cos(2*pi()*((f.k+16)%32)*pairs.k/32) - x*sin(2*pi()*((f.k+16)%32)*pairs.k/32)) AS im FROM pairs, (SELECT unnest(range(32)) AS k) f GROUP BY ALL)"""


@query("SELECT sample_id, CAST(k AS INTEGER) AS k, round((re*re+im*im)/32, 6)+0.0 AS power FROM dft WHERE sample_id IN (SELECT sample_id FROM sig ORDER BY sample_id LIMIT 3)", over("sig", DFT))
def eda_spectrum(spark: SparkSession, d: str) -> DataFrame:
    """The report's feature: spectra of the first three samples by id."""
    return features.eda_spectra(signal_view(spark, d), 3).select("sample_id", "k", r6("power").alias("power"))


@query("SELECT sample_id, count(*) AS n, count(*) FILTER (WHERE isfinite(x)) AS finite, round(min(x) FILTER (WHERE isfinite(x)),6)+0.0 AS minimum, round(max(x) FILTER (WHERE isfinite(x)),6)+0.0 AS maximum, round(avg(x) FILTER (WHERE isfinite(x)),6)+0.0 AS mean, round(stddev_pop(x) FILTER (WHERE isfinite(x)),6)+0.0 AS std FROM pairs GROUP BY sample_id", over("dirty"))
def inspect_statistics(spark: SparkSession, d: str) -> DataFrame:
    out = eda.finite_statistics(dirty_view(spark, d), F.col("i"))
    return out.select("sample_id", "n", "finite", *[r6(c).alias(c) for c in ("minimum", "maximum", "mean", "std")])


WALKED = "parts AS (SELECT sample_id, unnest(['both.i', 'both.q', 'points', 'facts.snr.db', 'facts.row_index']) AS field, unnest([list_transform(i, lambda v: CAST(v AS DOUBLE)), list_transform(q, lambda v: CAST(v AS DOUBLE)), list_transform(list_zip(i, q), lambda z: sqrt(z[1]::DOUBLE * z[1]::DOUBLE + z[2]::DOUBLE * z[2]::DOUBLE)), [snr_db], [CAST(row_index AS DOUBLE)]]) AS v FROM dirty), flat AS (SELECT sample_id, field, unnest(v) AS v FROM parts)"


@query(
    "SELECT p.sample_id, p.field, count(v) AS n, count(v) FILTER (WHERE isfinite(v)) AS finite, round(min(v) FILTER (WHERE isfinite(v)),6)+0.0 AS minimum, round(max(v) FILTER (WHERE isfinite(v)),6)+0.0 AS maximum, round(avg(v) FILTER (WHERE isfinite(v)),6)+0.0 AS mean, round(stddev_pop(v) FILTER (WHERE isfinite(v)),6)+0.0 AS std FROM (SELECT sample_id, field FROM parts) p LEFT JOIN flat USING (sample_id, field) GROUP BY ALL",
    f"{DIRTY_SQL.strip()}, {WALKED}",
)
def inspect_fields(spark: SparkSession, d: str) -> DataFrame:
    """Statistics of every number below nested columns; complex points count by magnitude."""
    points = F.transform(F.arrays_zip("i", "q"), lambda v: F.struct(v["i"].alias("re"), v["q"].alias("im")))
    snr = F.struct(F.col("snr_db").alias("db"), F.col("label").alias("of"))
    nested = dirty_view(spark, d).select("sample_id", F.struct("i", F.col("q"), F.lit("x").alias("kind")).alias("both"), points.alias("points"), F.struct(snr.alias("snr"), "row_index").alias("facts"))
    out = eda.walked_statistics(nested, ["both", "points", "facts"])
    return out.select("sample_id", "field", "n", "finite", *[r6(c).alias(c) for c in ("minimum", "maximum", "mean", "std")])


@query("SELECT p.k AS \"order\", row_index, sample_id FROM (SELECT row_index AS k, (row_index * 7919 + 13) % (SELECT count(*) FROM sig) AS place FROM sig UNION ALL SELECT row_index + (SELECT count(*) FROM sig), (SELECT count(*) FROM sig) - 1 - row_index // 3 FROM sig) p JOIN sig ON row_index = place", SIGNAL_SQL)
def gather_rows(spark: SparkSession, d: str) -> DataFrame:
    """An index list with repeats and places from the end, twice as long as the table."""
    rows = signal_view(spark, d).select("row_index", "sample_id")
    n = rows.count()
    r = F.col("row_index")
    places = rows.select(r.alias("order"), ((r * 7919 + 13) % n).alias("place")).union(rows.select((r + n).alias("order"), (-1 - F.floor(r / 3)).alias("place")))
    return gather.gather(rows, places)


@query("SELECT label AS block, n, CAST(coalesce(sum(n) OVER (ORDER BY label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),0) AS BIGINT) AS first, CAST(sum(n) OVER (ORDER BY label) - 1 AS BIGINT) AS last FROM (SELECT label, count(*) AS n FROM sig GROUP BY label)", SIGNAL_SQL)
def block_offsets(spark: SparkSession, d: str) -> DataFrame:
    blocks = signal_view(spark, d).groupBy(F.col("label").alias("block")).agg(F.count(F.lit(1)).alias("n"))
    return eda.block_offsets(blocks)


# Validation

ISSUES = """stats AS (SELECT row_index, sample_id, bool_or(NOT isfinite(x) OR NOT isfinite(y)) AS odd, max(CAST(sqrt(x*x+y*y) AS FLOAT)) AS amp,
  sum(CAST(CAST(sqrt(x*x+y*y) AS FLOAT) AS DOUBLE)*CAST(CAST(sqrt(x*x+y*y) AS FLOAT) AS DOUBLE))/count(*) AS pw, max(x)-min(x) AS sx, max(y)-min(y) AS sy FROM pairs GROUP BY row_index, sample_id),
base AS (SELECT d.row_index, d.sample_id, d.label, d.snr_db, s.odd, s.amp, s.pw, s.sx, s.sy FROM dirty d JOIN stats s USING (row_index)),
issues AS (
 SELECT row_index, sample_id, 'signal.non_finite' AS error_code FROM base WHERE odd
 UNION ALL SELECT row_index, sample_id, 'signal.constant' FROM base WHERE NOT odd AND sx = 0 AND sy = 0
 UNION ALL SELECT row_index, sample_id, 'signal.amplitude_out_of_range' FROM base WHERE NOT odd AND amp > 1.0
 UNION ALL SELECT row_index, sample_id, 'signal.power_out_of_range' FROM base WHERE NOT odd AND (pw < 1e-8 OR pw > 8.0)
 UNION ALL SELECT row_index, sample_id, 'label.not_allowed' FROM base WHERE NOT regexp_full_match(label, 'class-[0-9]')
 UNION ALL SELECT row_index, sample_id, 'snr.non_finite' FROM base WHERE snr_db IS NOT NULL AND NOT isfinite(snr_db)
 UNION ALL SELECT row_index, sample_id, 'snr.out_of_range' FROM base WHERE snr_db IS NOT NULL AND isfinite(snr_db) AND NOT (snr_db BETWEEN -20 AND 18))"""
VALIDATED = over("dirty", ISSUES)


def dirty_issues(spark: SparkSession, d: str) -> DataFrame:
    return validation.issues(dirty_view(spark, d), POLICY)


@query("SELECT row_index, sample_id, error_code, split_part(error_code, '.', 1) AS field FROM issues", VALIDATED)
def validate_issues(spark: SparkSession, d: str) -> DataFrame:
    return dirty_issues(spark, d).drop("place")


#: Faults of form by id, and SNR as text.
FORMS = """forms AS (SELECT row_index, sample_id, label,
  CASE WHEN row_index % 17 = 0 THEN NULL WHEN row_index % 29 = 0 THEN [] WHEN row_index % 23 = 0 THEN i[1:31] ELSE i END AS i,
  CASE WHEN row_index % 29 = 0 THEN [] WHEN row_index % 19 = 0 THEN q[1:30] WHEN row_index % 23 = 0 THEN q[1:31] ELSE q END AS q,
  CASE WHEN row_index % 31 = 0 THEN 'float64' WHEN row_index % 37 <> 0 THEN 'float32' END AS dtype,
  CASE WHEN row_index % 13 = 0 THEN 'high' WHEN row_index % 11 = 0 THEN 'true' WHEN row_index % 7 <> 0 THEN '3.5' END AS snr FROM sig),
shaped AS (SELECT *, i IS NOT NULL AND q IS NOT NULL AS present FROM forms)"""


def formed(spark: SparkSession, d: str) -> DataFrame:
    r, short = F.col("row_index"), lambda c, n: F.slice(c, 1, n)
    none = F.array().cast("array<float>")
    i = F.when(r % 17 == 0, F.lit(None)).when(r % 29 == 0, none).when(r % 23 == 0, short("i", 31)).otherwise(F.col("i"))
    q = F.when(r % 29 == 0, none).when(r % 19 == 0, short("q", 30)).when(r % 23 == 0, short("q", 31)).otherwise(F.col("q"))
    text = F.when(r % 13 == 0, "high").when(r % 11 == 0, "true").when(r % 7 != 0, "3.5")
    rows = signal_view(spark, d).withColumns({"i": i, "q": q, "dtype": F.when(r % 31 == 0, "float64").when(r % 37 != 0, "float32"), "snr_text": text})
    return rows.withColumn("snr_db", F.col("snr_text").try_cast("double"))


@query(
    "SELECT row_index, sample_id, error_code FROM (SELECT row_index, sample_id, unnest([CASE WHEN NOT present THEN 'signal.not_ndarray' END, CASE WHEN present AND len(i) <> len(q) THEN 'signal.invalid_shape' END, CASE WHEN present AND len(i) = len(q) AND len(i) <> 32 THEN 'signal.invalid_length' END, CASE WHEN present AND (len(i) = 0 OR len(q) = 0) THEN 'signal.empty' END, CASE WHEN present AND dtype IS DISTINCT FROM 'float32' THEN 'signal.invalid_dtype' END, CASE WHEN snr IS NOT NULL AND TRY_CAST(snr AS DOUBLE) IS NULL OR snr = 'true' THEN 'snr.invalid_type' END]) AS error_code FROM shaped) WHERE error_code IS NOT NULL",
    f"{SIGNAL_SQL.strip()}, {FORMS}",
)
def structural_issues(spark: SparkSession, d: str) -> DataFrame:
    """Wrong containers, shapes, lengths and types, and SNRs that are no numbers."""
    found = validation.issues(formed(spark, d), POLICY, F.col("snr_text"))
    structural = ("signal.not_ndarray", "signal.invalid_shape", "signal.invalid_length", "signal.empty", "signal.invalid_dtype", "snr.invalid_type")
    return found.where(F.col("error_code").isin(*structural)).select("row_index", "sample_id", "error_code")


@query("SELECT error_code, count(*) AS n FROM issues GROUP BY error_code", VALIDATED)
def validate_error_counts(spark: SparkSession, d: str) -> DataFrame:
    return validation.error_counts(dirty_issues(spark, d))


@query("SELECT sample_id FROM dirty WHERE sample_id NOT IN (SELECT sample_id FROM issues)", VALIDATED)
def validate_valid_ids(spark: SparkSession, d: str) -> DataFrame:
    return validation.valid_rows(dirty_view(spark, d), POLICY).select("sample_id")


@query("SELECT error_code, n, CAST(rank AS INTEGER) AS rank, sample_id FROM (SELECT error_code, sample_id, count(*) OVER (PARTITION BY error_code) AS n, row_number() OVER (PARTITION BY error_code ORDER BY sample_id) AS rank FROM issues) WHERE rank <= 5", VALIDATED)
def validate_error_summary(spark: SparkSession, d: str) -> DataFrame:
    """The summary's feature: each code's first five ids."""
    return validation.error_summary(dirty_issues(spark, d), 5)


@query("SELECT count(*) AS total, count(*) FILTER (WHERE i.sample_id IS NULL) AS valid, count(i.sample_id) AS invalid FROM dirty LEFT JOIN (SELECT DISTINCT sample_id FROM issues) i USING (sample_id)", VALIDATED)
def validate_report(spark: SparkSession, d: str) -> DataFrame:
    bad = F.lit(False)
    for condition in validation.rules(POLICY).values():
        bad = bad | F.coalesce(condition, F.lit(False))
    return dirty_view(spark, d).agg(F.count(F.lit(1)).alias("total"), F.count_if(~bad).alias("valid"), F.count_if(bad).alias("invalid"))


@query("SELECT count(*) FILTER (WHERE odd) AS non_finite, count(*) FILTER (WHERE a > 1.0) AS amplitude, count(*) FILTER (WHERE p <= 1e-12) AS zero_power FROM (SELECT bool_or(NOT isfinite(x) OR NOT isfinite(y)) AS odd, max(sqrt(x*x+y*y)) AS a, avg(x*x+y*y) AS p FROM pairs GROUP BY row_index)", over("dirty"))
def safety_gate(spark: SparkSession, d: str) -> DataFrame:
    """NaN is above every limit, so its rows count as too strong too."""
    return spark.createDataFrame([validation.safety_problems(dirty_view(spark, d), 1.0, 1e-12)], "non_finite long, amplitude long, zero_power long")


@query("SELECT pos, idx, CASE WHEN idx < 0 OR idx >= 400 THEN 'out_of_range' ELSE 'not_ascending' END AS problem FROM (SELECT pos, idx, lag(idx) OVER (ORDER BY pos) AS before FROM (SELECT vec_id AS pos, CASE WHEN vec_id % 50 = 7 THEN vec_id - 3 ELSE vec_id END AS idx FROM embeddings)) WHERE idx < 0 OR idx >= 400 OR before >= idx")
def index_order_check(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("vec_id")
    indices = spark.read.parquet(f"{d}/embeddings.parquet").select(v.alias("pos"), F.when(v % 50 == 7, v - 3).otherwise(v).alias("idx"))
    return validation.index_problems(indices, 400)


# Duplicates and leakage

KEYS = "keyed AS (SELECT sample_id, label, group_id, array_to_string(i, ',') || '|' || array_to_string(q, ',') AS key FROM dirty)"
CLUSTERS = "clusters AS (SELECT key, count(*) AS members, min(sample_id) AS canonical, min(label) <> max(label) AS conflict FROM keyed GROUP BY key HAVING count(*) > 1), members AS (SELECT sample_id, label, key, members, conflict, canonical FROM keyed JOIN clusters USING (key))"
CLUSTERED = ",\n".join([DIRTY_SQL.strip(), KEYS, CLUSTERS])


@query("SELECT sample_id, members, conflict, canonical FROM members", CLUSTERED)
def exact_duplicate_members(spark: SparkSession, d: str) -> DataFrame:
    return duplicates.exact_members(dirty_view(spark, d)).select("sample_id", "members", "conflict", "canonical")


@query("SELECT canonical, members, count(DISTINCT label) AS labels FROM members WHERE conflict GROUP BY key, canonical, members", CLUSTERED)
def label_conflicts(spark: SparkSession, d: str) -> DataFrame:
    found = duplicates.exact_members(dirty_view(spark, d)).where("conflict")
    return found.groupBy("key", "canonical", "members").agg(F.countDistinct("label").alias("labels")).drop("key")


@query("SELECT d.doc_id, c.members, c.canonical FROM documents d JOIN (SELECT text, count(*) AS members, min(doc_id) AS canonical FROM documents GROUP BY text HAVING count(*) > 1) c ON d.text = c.text")
def document_duplicates(spark: SparkSession, d: str) -> DataFrame:
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.sha2("text", 256).alias("key"))
    facts = docs.where("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("doc_id").alias("canonical")).where("members > 1")
    return docs.join(facts, "key").select("doc_id", "members", "canonical")


@query("SELECT min(doc_id) AS canonical, count(*) AS members FROM documents JOIN labels USING (doc_id) GROUP BY text HAVING count(DISTINCT quality) > 1")
def document_label_conflicts(spark: SparkSession, d: str) -> DataFrame:
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.sha2("text", 256).alias("key"))
    both = docs.join(spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "quality"), "doc_id")
    return both.groupBy("key").agg(F.min("doc_id").alias("canonical"), F.count(F.lit(1)).alias("members"), F.min("quality").alias("a"), F.max("quality").alias("b")).where("a <> b").select("canonical", "members")


def usable(spark: SparkSession, d: str) -> DataFrame:
    return validation.valid_rows(dirty_view(spark, d), POLICY)


#: The same by brute force: unit vectors turned so that the largest value is real, their values floored and rounded
#: at three decimals, and the correlation of all pairs that are equal in one of the two.
NEAR = """npairs AS (SELECT sample_id, unnest(i)::DOUBLE AS x, unnest(q)::DOUBLE AS y, unnest(range(len(i))) AS k FROM dirty WHERE sample_id NOT IN (SELECT sample_id FROM issues)),
tops AS (SELECT sample_id, sqrt(sum(x*x + y*y)) AS norm, arg_max(x, x*x + y*y) AS tx, arg_max(y, x*x + y*y) AS ty, arg_max(k, x*x + y*y) AS tk, list(x ORDER BY k) AS raw_x, list(y ORDER BY k) AS raw_y FROM npairs GROUP BY sample_id),
turned AS (SELECT sample_id, k, (x*tx + y*ty) / (norm * sqrt(tx*tx + ty*ty)) AS x, CASE WHEN k = tk THEN 0.0 ELSE (y*tx - x*ty) / (norm * sqrt(tx*tx + ty*ty)) END AS y FROM npairs JOIN tops USING (sample_id)),
units AS (SELECT sample_id, list(x ORDER BY k) AS re, list(y ORDER BY k) AS im, string_agg(floor(x*1000) || ',' || floor(y*1000), ';' ORDER BY k) AS floored, string_agg(floor(x*1000 + 0.5) || ',' || floor(y*1000 + 0.5), ';' ORDER BY k) AS rounded FROM turned GROUP BY sample_id),
near AS (
  SELECT a.sample_id AS left_id, b.sample_id AS right_id, round(sqrt(pow(list_dot_product(a.re, b.re) + list_dot_product(a.im, b.im), 2) + pow(list_dot_product(a.re, b.im) - list_dot_product(a.im, b.re), 2)), 6) AS similarity
  FROM units a JOIN units b ON a.sample_id < b.sample_id AND (a.floored = b.floored OR a.rounded = b.rounded) JOIN tops p ON p.sample_id = a.sample_id JOIN tops q ON q.sample_id = b.sample_id
  WHERE (p.raw_x <> q.raw_x OR p.raw_y <> q.raw_y) AND similarity >= 0.999)"""


@query("SELECT left_id, right_id, similarity FROM near", ",\n".join([VALIDATED, NEAR]))
def near_duplicate_pairs(spark: SparkSession, d: str) -> DataFrame:
    return duplicates.near_pairs(usable(spark, d), DUPLICATES).select("left_id", "right_id", r6("similarity").alias("similarity"))


@query(
    "SELECT contents, count(*) AS signatures FROM (SELECT kind, sign, count(DISTINCT raw) AS contents FROM (SELECT raw_x::VARCHAR || raw_y::VARCHAR AS raw, unnest(['floored', 'rounded', 'lowered']) AS kind, unnest([floored, rounded, rounded]) AS sign FROM units JOIN tops USING (sample_id)) GROUP BY kind, sign HAVING count(DISTINCT raw) > 1) GROUP BY contents",
    ",\n".join([VALIDATED, NEAR]),
)
def near_signature_buckets(spark: SparkSession, d: str) -> DataFrame:
    """How many signatures so many contents have in common."""
    vectors = duplicates.unit_vectors(usable(spark, d), DUPLICATES)
    return duplicates.signature_sizes(vectors).groupBy(F.col("n").alias("contents")).agg(F.count(F.lit(1)).alias("signatures"))


ASSIGNED = "assigned AS (SELECT sample_id, CASE WHEN row_index % 97 = 0 THEN 'holdout' WHEN row_index % 5 < 3 THEN 'train' WHEN row_index % 5 = 3 THEN 'validation' ELSE 'test' END AS split FROM dirty WHERE row_index % 89 <> 0 UNION ALL SELECT 'ghost', 'train')"
SPLIT = "valid_splits AS (SELECT * FROM assigned WHERE split IN ('train','validation','test'))"
ASSIGNED_HEAD = ",\n".join([CLUSTERED, ASSIGNED, SPLIT])


def assignments(spark: SparkSession, d: str) -> DataFrame:
    r = F.col("row_index")
    split = F.when(r % 97 == 0, "holdout").when(r % 5 < 3, "train").when(r % 5 == 3, "validation").otherwise("test")
    rows = dirty_view(spark, d).where(r % 89 != 0).select("sample_id", split.alias("split"))
    return rows.union(spark.createDataFrame([("ghost", "train")], "sample_id string, split string"))


@query("SELECT coalesce(d.sample_id, a.sample_id) AS sample_id, CASE WHEN d.sample_id IS NULL THEN 'split.unknown_sample' WHEN split IS NULL THEN 'split.assignment_missing' ELSE 'split.assignment_invalid' END AS error_code FROM dirty d FULL JOIN assigned a ON d.sample_id = a.sample_id WHERE d.sample_id IS NULL OR split IS NULL OR split NOT IN ('train','validation','test')", ASSIGNED_HEAD)
def split_assignment_issues(spark: SparkSession, d: str) -> DataFrame:
    return duplicates.assignment_issues(dirty_view(spark, d), assignments(spark, d))


@query("SELECT 'leakage.group_cross_split' AS error_code, group_id AS key, string_agg(DISTINCT split, ',' ORDER BY split) AS splits, count(*) AS n FROM dirty JOIN valid_splits USING (sample_id) GROUP BY group_id HAVING count(DISTINCT split) > 1", ASSIGNED_HEAD)
def cross_split_groups(spark: SparkSession, d: str) -> DataFrame:
    return duplicates.cross_split(dirty_view(spark, d), "group_id", assignments(spark, d), "leakage.group_cross_split")


@query("SELECT 'leakage.exact_cross_split' AS error_code, canonical AS key, string_agg(DISTINCT split, ',' ORDER BY split) AS splits, count(*) AS n FROM members JOIN valid_splits USING (sample_id) GROUP BY canonical HAVING count(DISTINCT split) > 1", ASSIGNED_HEAD)
def cross_split_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return duplicates.cross_split(duplicates.exact_members(dirty_view(spark, d)), "canonical", assignments(spark, d), "leakage.exact_cross_split")


@query(
    "SELECT 'leakage.near_cross_split' AS error_code, left_id, right_id, a.split AS left_split, b.split AS right_split, similarity FROM near JOIN spread a ON a.sample_id = left_id JOIN spread b ON b.sample_id = right_id WHERE a.split <> b.split",
    ",\n".join([VALIDATED, NEAR, "spread AS (SELECT sample_id, ['train', 'validation', 'test'][1 + (row_index + row_index // 1000000) % 4] AS split FROM dirty WHERE (row_index + row_index // 1000000) % 4 < 3)"]),
)
def cross_split_near_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Copies lie in other splits than what they are copies of."""
    turn = (F.col("row_index") + F.expr("row_index div 1000000")) % 4
    spread = dirty_view(spark, d).select("sample_id", F.get(F.array(*[F.lit(x) for x in ("train", "validation", "test", "holdout")]), turn.cast("int")).alias("split"))
    return duplicates.cross_split_pairs(duplicates.near_pairs(usable(spark, d), DUPLICATES), spread).withColumn("similarity", r6("similarity"))


LEAKAGE = """pop AS (SELECT sample_id, label, CASE WHEN row_index % 15 <> 0 THEN group_id END AS g FROM dirty WHERE sample_id NOT IN (SELECT sample_id FROM issues)),
passigned AS (SELECT sample_id, split FROM assigned JOIN pop USING (sample_id)), pvalid AS (SELECT * FROM passigned WHERE split IN ('train','validation','test')),
pgroups AS (SELECT g, string_agg(DISTINCT split, ',' ORDER BY split) AS splits FROM pop JOIN pvalid USING (sample_id) WHERE g IS NOT NULL GROUP BY g HAVING count(DISTINCT split) > 1),
pexact AS (SELECT canonical, string_agg(DISTINCT split, ',' ORDER BY split) AS splits FROM vmembers JOIN pvalid USING (sample_id) GROUP BY canonical HAVING count(DISTINCT split) > 1),
pnear AS (SELECT left_id, right_id, similarity, least(a.split, b.split) || ',' || greatest(a.split, b.split) AS splits FROM near JOIN pvalid a ON a.sample_id = left_id JOIN pvalid b ON b.sample_id = right_id WHERE a.split <> b.split),
found AS (
 SELECT 'group.unresolved' AS error_code, sample_id AS key, sample_id, NULL AS splits, CAST(NULL AS DOUBLE) AS similarity FROM pop WHERE g IS NULL
 UNION ALL SELECT 'duplicate.exact', canonical, sample_id, NULL, NULL FROM vmembers
 UNION ALL SELECT 'duplicate.label_conflict', canonical, sample_id, NULL, NULL FROM vmembers WHERE conflict
 UNION ALL SELECT 'duplicate.near', left_id || '|' || right_id, unnest([left_id, right_id]), NULL, similarity FROM near
 UNION ALL SELECT CASE WHEN split IS NULL THEN 'split.assignment_missing' ELSE 'split.assignment_invalid' END, sample_id, sample_id, NULL, NULL FROM pop LEFT JOIN passigned USING (sample_id) WHERE split IS NULL OR split NOT IN ('train','validation','test')
 UNION ALL SELECT 'leakage.group_cross_split', g, sample_id, splits, NULL FROM pop JOIN pvalid USING (sample_id) JOIN pgroups USING (g)
 UNION ALL SELECT 'leakage.exact_cross_split', canonical, sample_id, splits, NULL FROM vmembers JOIN pvalid USING (sample_id) JOIN pexact USING (canonical)
 UNION ALL SELECT 'leakage.near_cross_split', left_id || '|' || right_id, unnest([left_id, right_id]), splits, similarity FROM pnear)"""


def _leakage(spark: SparkSession, d: str) -> DataFrame:
    valid = usable(spark, d).withColumn("group_id", F.when(F.col("row_index") % 15 != 0, F.col("group_id")))
    assigned = assignments(spark, d).join(valid.select("sample_id"), "sample_id", "left_semi")
    return duplicates.leakage_issues(valid, DUPLICATES, assigned)


@query()
def leakage_result(spark: SparkSession, d: str) -> DataFrame:
    """Duplicates, groups and splits in one result, a row a member of an issue."""
    return _leakage(spark, d).withColumn("similarity", r6("similarity"))


@query()
def leakage_split_ready(spark: SparkSession, d: str) -> DataFrame:
    return duplicates.leakage_summary(_leakage(spark, d))


@query("SELECT sample_id FROM (SELECT sample_id, CASE WHEN row_index % 10 = 0 THEN '  ' WHEN row_index % 15 = 0 THEN NULL ELSE group_id END AS g FROM sig) WHERE g IS NULL OR trim(g) = ''", SIGNAL_SQL)
def unresolved_groups(spark: SparkSession, d: str) -> DataFrame:
    r = F.col("row_index")
    blank = signal_view(spark, d).withColumn("group_id", F.when(r % 10 == 0, "  ").when(r % 15 != 0, F.col("group_id")))
    return blank.where(duplicates.explicit_group().isNull()).select("sample_id")


@query("SELECT sample_id, CASE WHEN row_index % 10 <> 0 THEN 'group-' || sha256('source' || chr(0) || '1.0' || chr(0) || group_id) END AS group_key FROM sig", SIGNAL_SQL)
def group_ids_source_sequence(spark: SparkSession, d: str) -> DataFrame:
    sequence = F.when(F.col("row_index") % 10 == 0, " ").otherwise(F.col("group_id"))
    return signal_view(spark, d).select("sample_id", S.group_key(F.lit("source"), F.lit("1.0"), sequence).alias("group_key"))


@query("SELECT DISTINCT group_id, sha256('20260811' || chr(0) || group_id) AS key FROM sig", SIGNAL_SQL)
def seeded_group_keys(spark: SparkSession, d: str) -> DataFrame:
    return signal_view(spark, d).select("group_id").distinct().select("group_id", S.seeded_key(20260811, F.col("group_id")).alias("key"))


@query("SELECT sample_id, 'sample-' || sha256('src' || chr(0) || 'v1' || chr(0) || sample_id || chr(0) || sha256(label)) AS key FROM sig", SIGNAL_SQL)
def sample_ids_hash(spark: SparkSession, d: str) -> DataFrame:
    return signal_view(spark, d).select("sample_id", S.sample_key(F.lit("src"), F.lit("v1"), F.col("sample_id"), F.sha2("label", 256)).alias("key"))


# Quarantine

REASONS = """reasons AS (SELECT sample_id, error_code, NULL AS duplicate_of FROM issues
 UNION SELECT sample_id, 'duplicate.label_conflict', NULL FROM vmembers WHERE conflict
 UNION SELECT sample_id, 'duplicate.exact', CASE WHEN NOT conflict THEN canonical END FROM vmembers WHERE conflict OR sample_id <> canonical
 UNION SELECT unnest([left_id, right_id]), 'duplicate.near', NULL FROM near)"""
VMEMBERS = """vkeyed AS (SELECT sample_id, label, array_to_string(i, ',') || '|' || array_to_string(q, ',') AS key FROM dirty WHERE sample_id NOT IN (SELECT sample_id FROM issues)),
vmembers AS (SELECT sample_id, conflict, canonical FROM vkeyed JOIN (SELECT key, min(sample_id) AS canonical, min(label) <> max(label) AS conflict FROM vkeyed GROUP BY key HAVING count(*) > 1) USING (key))"""
QUARANTINED = ",\n".join([VALIDATED, NEAR, VMEMBERS, REASONS])


LEAKED = ",\n".join([QUARANTINED, ASSIGNED, LEAKAGE])
ORACLE["leakage_result"] = f"WITH {LEAKED} SELECT error_code, key, sample_id, splits, similarity FROM found"
ORACLE["leakage_split_ready"] = f"WITH {LEAKED} SELECT count(DISTINCT error_code || ' ' || key) AS issues, count(DISTINCT sample_id) AS samples, NOT bool_or(regexp_matches(error_code, '^(duplicate|group|split|leakage)[.]')) AS split_ready FROM found"


def dirty_reasons(spark: SparkSession, d: str) -> DataFrame:
    valid = usable(spark, d)
    return quarantine.reasons(dirty_issues(spark, d), duplicates.exact_members(valid), duplicates.near_pairs(valid, DUPLICATES))


@query("SELECT sample_id, string_agg(DISTINCT error_code, ',' ORDER BY error_code) AS codes, min(duplicate_of) AS duplicate_of FROM reasons GROUP BY sample_id", QUARANTINED)
def quarantine_entries(spark: SparkSession, d: str) -> DataFrame:
    return quarantine.entries(dirty_reasons(spark, d))


@query("SELECT sample_id FROM dirty WHERE sample_id NOT IN (SELECT sample_id FROM reasons)", QUARANTINED)
def accepted_ids(spark: SparkSession, d: str) -> DataFrame:
    return quarantine.accepted(dirty_view(spark, d).select("sample_id"), dirty_reasons(spark, d))


@query("SELECT error_code, count(DISTINCT sample_id) AS n FROM reasons GROUP BY error_code", QUARANTINED)
def quarantine_error_counts(spark: SparkSession, d: str) -> DataFrame:
    return dirty_reasons(spark, d).groupBy("error_code").agg(F.countDistinct("sample_id").alias("n"))


@query("SELECT count(*) AS total, count(*) FILTER (WHERE sample_id NOT IN (SELECT sample_id FROM reasons)) AS accepted, count(*) FILTER (WHERE sample_id IN (SELECT sample_id FROM reasons)) AS quarantined, (SELECT count(*) FROM kept_rows JOIN (SELECT DISTINCT sample_id FROM reasons) USING (sample_id)) AS overlap, (SELECT count(*) FROM dirty WHERE sample_id NOT IN (SELECT sample_id FROM kept_rows UNION SELECT sample_id FROM reasons)) AS missing FROM dirty", f"{QUARANTINED}, kept_rows AS (SELECT sample_id FROM dirty ANTI JOIN reasons USING (sample_id))")
def partition_invariant(spark: SparkSession, d: str) -> DataFrame:
    universe, out = dirty_view(spark, d).select("sample_id"), dirty_reasons(spark, d).select("sample_id").distinct()
    return quarantine.partition_check(universe, quarantine.accepted(universe, out), out).select(*[F.col(c).cast("long").alias(c) for c in ("total", "accepted", "quarantined", "overlap", "missing")])


# Splits

BUCKET = "CASE WHEN snr_db IS NULL THEN 'unknown' WHEN snr_db < -10 THEN 'bin-00:[-inf,-10)' WHEN snr_db < 0 THEN 'bin-01:[-10,0)' WHEN snr_db < 10 THEN 'bin-02:[0,10)' ELSE 'bin-03:[10,+inf)' END"
STRATA = f"{SIGNAL_SQL.strip()},\nstrata AS (SELECT *, {BUCKET} AS bucket, CASE WHEN row_index % 5 < 3 THEN 'train' WHEN row_index % 5 = 3 THEN 'validation' ELSE 'test' END AS split FROM sig)"


def stratified(spark: SparkSession, d: str) -> DataFrame:
    r = F.col("row_index")
    return splitting.strata(signal_view(spark, d), EDGES).withColumn("split", F.when(r % 5 < 3, "train").when(r % 5 == 3, "validation").otherwise("test"))


@query("SELECT sample_id, bucket FROM strata", STRATA)
def snr_buckets(spark: SparkSession, d: str) -> DataFrame:
    return stratified(spark, d).select("sample_id", "bucket")


@query("SELECT label, bucket, count(*) AS n FROM strata GROUP BY ALL", STRATA)
def strata_counts(spark: SparkSession, d: str) -> DataFrame:
    return stratified(spark, d).groupBy("label", "bucket").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT group_id, label, bucket, count(*) AS n, min(row_index) AS first FROM strata GROUP BY group_id, label, bucket", STRATA)
def group_strata(spark: SparkSession, d: str) -> DataFrame:
    return splitting.group_strata(signal_view(spark, d), EDGES)


@query("SELECT label, bucket, count(*) AS n, round(count(*) / (SELECT count(*) FROM strata), 6) AS fraction FROM strata GROUP BY label, bucket", STRATA)
def joint_distribution(spark: SparkSession, d: str) -> DataFrame:
    return splitting.distribution(stratified(spark, d), ["label", "bucket"]).withColumn("fraction", r6("fraction"))


@query("SELECT split, label, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY split), 6) AS fraction FROM strata GROUP BY split, label", STRATA)
def split_distribution(spark: SparkSession, d: str) -> DataFrame:
    return splitting.distribution(stratified(spark, d), ["label"], "split").withColumn("fraction", r6("fraction"))


@query("SELECT split, round(max(abs(coalesce(f, 0) - g)), 6) AS deviation FROM (SELECT DISTINCT split FROM strata) s CROSS JOIN (SELECT label, count(*) / (SELECT count(*) FROM strata) AS g FROM strata GROUP BY label) w LEFT JOIN (SELECT split, label, count(*) / sum(count(*)) OVER (PARTITION BY split) AS f FROM strata GROUP BY split, label) x USING (split, label) GROUP BY split", STRATA)
def split_balance(spark: SparkSession, d: str) -> DataFrame:
    return splitting.balance(stratified(spark, d), "label").withColumn("deviation", r6("deviation"))


@query("SELECT split, count(DISTINCT group_id) AS groups, count(*) AS n FROM strata GROUP BY split", STRATA)
def split_group_counts(spark: SparkSession, d: str) -> DataFrame:
    return stratified(spark, d).groupBy("split").agg(F.countDistinct("group_id").alias("groups"), F.count(F.lit(1)).alias("n"))


def greedy_sql(fractions: tuple[float, ...], seed: int) -> str:
    """The sequential rule as a recursion over the queue of groups, with sums in the order of splits, then strata."""
    names = ("train", "validation", "test")

    def errors(target: int) -> str:
        sizes = [f"pow((n{s} + {'size' if s == target else '0'} - total * {fractions[s]}) / (total * {fractions[s]}), 2)" for s in range(3)]
        lists = [f"list_transform(list_zip(h{s}, v, w), lambda z: pow((z[1] + {'z[2]' if s == target else '0'} - z[3] * {fractions[s]}) / greatest(z[3] * {fractions[s]}, 1.0), 2))" for s in range(3)]
        return f"(({sizes[0]} + {sizes[1]}) + {sizes[2]}) + 2.0 * list_reduce(list_concat([0.0], {', '.join(lists)}), lambda a, x: a + x)"

    choices = ", ".join(f"struct_pack(barred := (n0 = 0 OR n1 = 0 OR n2 = 0) AND groups - place <= (n0 = 0)::INT + (n1 = 0)::INT + (n2 = 0)::INT AND n{s} > 0, loss := {errors(s)}, key := sha256('{seed}' || chr(0) || group_id || chr(0) || '{name}'), split := {s})" for s, name in enumerate(names))
    held = ", ".join(f"CASE WHEN best = {s} THEN list_transform(list_zip(h{s}, v), lambda z: z[1] + z[2]) ELSE h{s} END AS h{s}, n{s} + CASE WHEN best = {s} THEN size ELSE 0 END AS n{s}" for s in range(3))
    return f"""wholes AS (SELECT label, bucket, count(*) AS n, row_number() OVER (ORDER BY min(row_index)) AS j FROM strata GROUP BY label, bucket),
cells AS (SELECT g.group_id, w.j, CAST(coalesce(c.n, 0) AS DOUBLE) AS n FROM (SELECT DISTINCT group_id FROM strata) g CROSS JOIN wholes w LEFT JOIN (SELECT group_id, label, bucket, count(*) AS n FROM strata GROUP BY ALL) c ON c.group_id = g.group_id AND c.label = w.label AND c.bucket = w.bucket),
queue AS (SELECT group_id, list(n ORDER BY j) AS v, sum(n) AS size, row_number() OVER (ORDER BY sum(n) DESC, max(n) DESC, sha256('{seed}' || chr(0) || group_id)) - 1 AS place FROM cells GROUP BY group_id),
facts AS (SELECT (SELECT list(CAST(n AS DOUBLE) ORDER BY j) FROM wholes) AS w, (SELECT CAST(sum(n) AS DOUBLE) FROM wholes) AS total, (SELECT count(*) FROM queue) AS groups),
steps AS (
  SELECT CAST(0 AS BIGINT) AS place, CAST(NULL AS VARCHAR) AS group_id, -1 AS best, {", ".join(f"list_transform(w, lambda x: 0.0::DOUBLE) AS h{s}, 0.0::DOUBLE AS n{s}" for s in range(3))} FROM facts
  UNION ALL
  SELECT place + 1, group_id, best, {held}
  FROM (SELECT *, list_sort(list_filter([{choices}], lambda c: NOT c.barred))[1].split AS best FROM (SELECT s.place, {", ".join(f"h{s}, n{s}" for s in range(3))}, q.group_id, q.v, q.size, f.w, f.total, f.groups FROM steps s JOIN queue q ON q.place = s.place CROSS JOIN facts f)))"""


@query("SELECT row_index, sample_id, group_id, ['train', 'validation', 'test'][best + 1] AS split FROM sig JOIN steps USING (group_id)", f"RECURSIVE {STRATA},\n{greedy_sql(tuple(FRACTIONS.values()), 20260811)}")
def greedy_split(spark: SparkSession, d: str) -> DataFrame:
    return splitting.group_splits(signal_view(spark, d), EDGES, FRACTIONS, 20260811).select("row_index", "sample_id", "group_id", "split")


@query("SELECT count(*) AS n, count(DISTINCT row_index) AS distinct_rows, count(DISTINCT best) AS splits, (SELECT count(*) FROM (SELECT group_id FROM steps WHERE group_id IS NOT NULL GROUP BY group_id HAVING count(DISTINCT best) > 1)) AS shared_groups FROM sig JOIN steps USING (group_id)", f"RECURSIVE {STRATA},\n{greedy_sql(tuple(FRACTIONS.values()), 20260811)}")
def split_invariants(spark: SparkSession, d: str) -> DataFrame:
    """Every row once, no split empty, no group in two splits."""
    split = splitting.group_splits(signal_view(spark, d), EDGES, FRACTIONS, 20260811)
    rows = split.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("row_index").alias("distinct_rows"), F.countDistinct("split").alias("splits"))
    shared = split.groupBy("group_id").agg(F.countDistinct("split").alias("s")).agg(F.count_if(F.col("s") > 1).alias("shared_groups"))
    return rows.crossJoin(F.broadcast(shared))  # one row each


@query("SELECT row_index, row_number() OVER (ORDER BY sha256('7' || chr(0) || CAST(row_index AS VARCHAR))) <= greatest(1, CAST(round_even(count(*) OVER () * 0.25, 0) AS BIGINT)) AS held_out FROM sig", SIGNAL_SQL)
def permutation_split(spark: SparkSession, d: str) -> DataFrame:
    return splitting.seeded_rows(signal_view(spark, d), 0.25, 7).select("row_index", "held_out")


# Preprocessing

FIT = "means AS (SELECT avg(x) AS dc_i, avg(y) AS dc_q FROM pairs WHERE row_index % 5 < 3), fitted AS (SELECT dc_i, dc_q, sqrt(avg((x-dc_i)*(x-dc_i) + (y-dc_q)*(y-dc_q))) AS scale, max(sqrt((x-dc_i)*(x-dc_i) + (y-dc_q)*(y-dc_q))) AS peak FROM pairs, means WHERE row_index % 5 < 3 GROUP BY dc_i, dc_q)"


def train_rows(spark: SparkSession, d: str) -> DataFrame:
    return stratified(spark, d).where("split = 'train'")


def _fit(spark: SparkSession, d: str, mode: str) -> DataFrame:
    return preprocessing.fit_table(train_rows(spark, d), mode).select(*[r6(c).alias(c) for c in ("dc_i", "dc_q", "scale")])


@query("SELECT round(dc_i,6)+0.0 AS dc_i, round(dc_q,6)+0.0 AS dc_q, round(scale,6)+0.0 AS scale FROM fitted", over("sig", FIT))
def preprocess_fit_rms(spark: SparkSession, d: str) -> DataFrame:
    return _fit(spark, d, "train_rms_power")


@query("SELECT round(dc_i,6)+0.0 AS dc_i, round(dc_q,6)+0.0 AS dc_q, round(peak,6)+0.0 AS scale FROM fitted", over("sig", FIT))
def preprocess_fit_peak(spark: SparkSession, d: str) -> DataFrame:
    return _fit(spark, d, "train_peak_amplitude")


def values(df: DataFrame, *columns: str) -> DataFrame:
    """(sample_id, k, one column each), rounded to five places as they are float32."""
    return df.select("sample_id", F.posexplode(F.arrays_zip(*columns)).alias("k", "v")).select("sample_id", "k", *[(F.round(F.col(f"v.{c}").cast("double"), 5) + F.lit(0.0)).alias(c) for c in columns])


@query("SELECT sample_id, CAST(k AS INTEGER) AS k, round(CAST(CAST((x-dc_i)/scale AS FLOAT) AS DOUBLE),5)+0.0 AS i, round(CAST(CAST((y-dc_q)/scale AS FLOAT) AS DOUBLE),5)+0.0 AS q FROM pairs, fitted", over("sig", FIT))
def preprocess_transform(spark: SparkSession, d: str) -> DataFrame:
    fitted = preprocessing.fit(train_rows(spark, d), "train_rms_power")
    return values(fitted.transform(signal_view(spark, d)), "i", "q")


@query("SELECT sample_id, CAST(k AS INTEGER) AS k, round(CAST(CAST(CAST(CAST((x-dc_i)/scale AS FLOAT) AS DOUBLE)*scale+dc_i AS FLOAT) AS DOUBLE),5)+0.0 AS i, round(CAST(CAST(CAST(CAST((y-dc_q)/scale AS FLOAT) AS DOUBLE)*scale+dc_q AS FLOAT) AS DOUBLE),5)+0.0 AS q FROM pairs, fitted", over("sig", FIT))
def preprocess_inverse(spark: SparkSession, d: str) -> DataFrame:
    fitted = preprocessing.fit(train_rows(spark, d), "train_rms_power")
    return values(fitted.inverse(fitted.transform(signal_view(spark, d))), "i", "q")


# Features


def _canonical(mode: str, padding: str, length: int) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        out = features.canonical(signal_view(spark, d), features.CanonicalConfig(length, mode, padding, 0.5))
        flags = out.select("sample_id", F.posexplode(F.arrays_zip("i", "q", "valid_mask")).alias("k", "v"))
        return flags.select("sample_id", "k", r6(F.col("v.i").cast("double")).alias("i"), r6(F.col("v.q").cast("double")).alias("q"), F.col("v.valid_mask").alias("valid"))

    return run


for _mode, _start in (("start", 0), ("center", 6), ("end", 13)):
    QUERIES[f"canonical_crop_{_mode}"] = _canonical(_mode, "right", 19)
    QUERIES[f"canonical_crop_{_mode}"].__name__ = f"canonical_crop_{_mode}"
    ORACLE[f"canonical_crop_{_mode}"] = f"WITH {over('sig')} SELECT sample_id, CAST(k - {_start} AS INTEGER) AS k, round(x,6)+0.0 AS i, round(y,6)+0.0 AS q, TRUE AS valid FROM pairs WHERE k >= {_start} AND k < {_start} + 19"
for _mode, _left in (("left", 7), ("center", 3), ("right", 0)):
    QUERIES[f"canonical_pad_{_mode}"] = _canonical("start", _mode, 39)
    QUERIES[f"canonical_pad_{_mode}"].__name__ = f"canonical_pad_{_mode}"
    ORACLE[f"canonical_pad_{_mode}"] = f"WITH {over('sig')}, grid AS (SELECT sample_id, unnest(range(39)) AS k FROM sig) SELECT g.sample_id, CAST(g.k AS INTEGER) AS k, round(coalesce(x, 0.5),6)+0.0 AS i, round(coalesce(y, 0.5),6)+0.0 AS q, x IS NOT NULL AS valid FROM grid g LEFT JOIN pairs p ON p.sample_id = g.sample_id AND p.k = g.k - {_left}"


@query("SELECT valid, count(*) AS n FROM (SELECT least(len(i), 39) AS valid FROM sig) GROUP BY valid", SIGNAL_SQL)
def valid_mask_counts(spark: SparkSession, d: str) -> DataFrame:
    """Signals by the number of places of the canonical form that hold values."""
    out = features.canonical(signal_view(spark, d), features.CanonicalConfig(39))
    return out.groupBy(F.size(F.filter("valid_mask", lambda m: m)).cast("long").alias("valid")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT sample_id, CAST(k AS INTEGER) AS k, round(CAST(CAST(sqrt(x*x+y*y) AS FLOAT) AS DOUBLE),4)+0.0 AS amplitude, round(cos(CAST(CAST(atan2(y,x) AS FLOAT) AS DOUBLE)),4)+0.0 AS cosine, round(sin(CAST(CAST(atan2(y,x) AS FLOAT) AS DOUBLE)),4)+0.0 AS sine FROM pairs", over("sig"))
def amplitude_phase(spark: SparkSession, d: str) -> DataFrame:
    """Phases are compared by cosine and sine, which do not jump where they wrap."""
    full = features.canonical(signal_view(spark, d), features.CanonicalConfig(LENGTH))
    out = features.amplitude_phase(full)
    each = out.select("sample_id", F.posexplode(F.arrays_zip("amplitude", "phase")).alias("k", "v"))
    r4 = lambda c: F.round(c.cast("double"), 4) + F.lit(0.0)
    return each.select("sample_id", "k", r4(F.col("v.amplitude")).alias("amplitude"), r4(F.cos(F.col("v.phase").cast("double"))).alias("cosine"), r4(F.sin(F.col("v.phase").cast("double"))).alias("sine"))


def _fft(config: features.SpectralConfig, places: int) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        out = features.spectra(signal_view(spark, d), config, single=False)
        return out.select("sample_id", "k", "frame", (F.round("value", places) + F.lit(0.0)).alias("value"))

    return run


HANN = "(0.5 - 0.5*cos(2*pi()*pairs.k/32))"
QUERIES["fft_power"] = _fft(features.SpectralConfig(), 6)
ORACLE["fft_power"] = f"WITH {over('sig', DFT)} SELECT sample_id, CAST(k AS INTEGER) AS k, CAST(0 AS INTEGER) AS frame, round(re*re+im*im,6)+0.0 AS value FROM dft"
QUERIES["fft_log_power_hann"] = _fft(features.SpectralConfig(window="hann", scale="log_power", epsilon=1e-3), 4)
ORACLE["fft_log_power_hann"] = f"WITH {over('sig', DFT.replace('sum(x*', f'sum({HANN}*(x*').replace('sum(y*', f'sum({HANN}*(y*').replace(') AS re', ')) AS re').replace(') AS im', ')) AS im'))} SELECT sample_id, CAST(k AS INTEGER) AS k, CAST(0 AS INTEGER) AS frame, round(10*log10(greatest(re*re+im*im, 1e-3)),4)+0.0 AS value FROM dft"
STFT = """stft AS (SELECT sample_id, f.k, w.frame, sum(x*cos(2*pi()*((f.k+4)%8)*(pairs.k-4*w.frame)/8) + y*sin(2*pi()*((f.k+4)%8)*(pairs.k-4*w.frame)/8)) AS re,
 sum(y*cos(2*pi()*((f.k+4)%8)*(pairs.k-4*w.frame)/8) - x*sin(2*pi()*((f.k+4)%8)*(pairs.k-4*w.frame)/8)) AS im FROM pairs, (SELECT unnest(range(8)) AS k) f, (SELECT unnest(range(7)) AS frame) w WHERE pairs.k >= 4*w.frame AND pairs.k < 4*w.frame + 8 GROUP BY ALL)"""
QUERIES["stft_power"] = _fft(features.SpectralConfig("spectrogram", 8, 4), 6)
ORACLE["stft_power"] = f"WITH {over('sig', STFT)} SELECT sample_id, CAST(k AS INTEGER) AS k, CAST(frame AS INTEGER) AS frame, round(re*re+im*im,6)+0.0 AS value FROM stft"


LENGTHS = "lengths AS (SELECT DISTINCT len(i) - row_index % 5 AS l FROM sig)"


def clipped(spark: SparkSession, d: str) -> DataFrame:
    """Signals of five lengths."""
    cut = lambda c: F.slice(c, F.lit(1), (F.size(c) - F.col("row_index") % 5).cast("int"))
    return signal_view(spark, d).withColumns({"i": cut("i"), "q": cut("q")})


@query("SELECT CAST(l AS INTEGER) AS signal_length, CAST(k AS INTEGER) AS k, round((k - l // 2) * 1000.0 / l, 6)+0.0 AS frequency, round(0.5 - 0.5*cos(2*pi()*k/l), 6)+0.0 AS hann FROM (SELECT l, unnest(range(l)) AS k FROM lengths)", f"{SIGNAL_SQL.strip()}, {LENGTHS}")
def frequency_axis(spark: SparkSession, d: str) -> DataFrame:
    return features.frequency_axes(clipped(spark, d), 1000.0).select("signal_length", "k", r6("frequency").alias("frequency"), r6("hann").alias("hann"))


@query("SELECT CAST(l AS INTEGER) AS signal_length, CAST(f AS INTEGER) AS frame, round(f * 4 / 1000.0, 6)+0.0 AS start FROM (SELECT l, unnest(range(1 + (l - 8) // 4)) AS f FROM lengths)", f"{SIGNAL_SQL.strip()}, {LENGTHS}")
def frame_start_axis(spark: SparkSession, d: str) -> DataFrame:
    return features.frame_starts(clipped(spark, d), features.SpectralConfig("spectrogram", 8, 4, sample_rate=1000.0)).withColumn("start", r6("start"))


CANON = "canon AS (SELECT sample_id, k - 4 AS k, CAST(CAST((x-dc_i)/scale AS FLOAT) AS DOUBLE) AS x, CAST(CAST((y-dc_q)/scale AS FLOAT) AS DOUBLE) AS y FROM pairs, fitted WHERE k BETWEEN 4 AND 27)"


@query("SELECT sample_id, CAST(k AS INTEGER) AS k, CAST(0 AS INTEGER) AS frame, round(10*log10(greatest(re*re+im*im, 1e-12)),3)+0.0 AS value FROM dft", over("sig", FIT, CANON, DFT.replace("pairs", "canon")))
def feature_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """Preprocessing, canonical form and a log spectrum in one chain."""
    fitted = preprocessing.fit(train_rows(spark, d), "train_rms_power")
    chain = features.FeaturePipeline(fitted, features.CanonicalConfig(24), "spectral", features.SpectralConfig(n_fft=32, scale="log_power"), single=False)
    return chain.transform(signal_view(spark, d)).withColumn("value", F.round("value", 3) + F.lit(0.0))


# Models

CENTROIDS = "centres AS (SELECT label, avg(x) AS cx, avg(y) AS cy, k FROM pairs WHERE row_index % 5 < 3 GROUP BY label, k), dist AS (SELECT p.row_index, p.sample_id, p.label, c.label AS class, sum((x-cx)*(x-cx) + (y-cy)*(y-cy)) AS d FROM pairs p JOIN centres c USING (k) WHERE row_index % 5 >= 3 GROUP BY ALL), predicted AS (SELECT sample_id, label, arg_min(class, d) AS predicted FROM dist GROUP BY ALL)"
PREDICTED = over("sig", CENTROIDS)
MATRIX = "matrix AS (SELECT label, predicted, count(*) AS n FROM predicted GROUP BY ALL), classes AS (SELECT DISTINCT label AS c FROM sig), sums AS (SELECT c AS label, coalesce(sum(n) FILTER (WHERE label = c AND predicted = c), 0) AS tp, coalesce(sum(n) FILTER (WHERE label = c), 0) AS support, coalesce(sum(n) FILTER (WHERE predicted = c), 0) AS named FROM classes LEFT JOIN matrix ON label = c OR predicted = c GROUP BY c), rates AS (SELECT label, CASE WHEN named > 0 THEN tp / named ELSE 0 END AS precision, CASE WHEN support > 0 THEN tp / support END AS recall, support FROM sums), scored AS (SELECT *, CASE WHEN precision + coalesce(recall, 0) > 0 THEN 2 * precision * coalesce(recall, 0) / (precision + coalesce(recall, 0)) ELSE 0 END AS f1 FROM rates)"
MEASURED = ",\n".join([PREDICTED, MATRIX])


def featured(spark: SparkSession, d: str) -> DataFrame:
    return stratified(spark, d).select("row_index", "sample_id", "label", "split", F.concat("i", "q").alias("features"))


def predicted(spark: SparkSession, d: str) -> DataFrame:
    rows = featured(spark, d)
    return models.nearest(rows.where("split <> 'train'"), models.centroids(rows.where("split = 'train'")))


@query("SELECT label, CAST(dim AS INTEGER) AS dim, round(m, 6)+0.0 AS mean FROM (SELECT label, k AS dim, avg(x) AS m FROM pairs WHERE row_index % 5 < 3 GROUP BY label, k UNION ALL SELECT label, k + 32, avg(y) FROM pairs WHERE row_index % 5 < 3 GROUP BY label, k)", over("sig"))
def centroids(spark: SparkSession, d: str) -> DataFrame:
    means = models.centroids(featured(spark, d).where("split = 'train'"))
    return means.select("label", F.posexplode("centroid").alias("dim", "m")).select("label", "dim", r6("m").alias("mean"))


@query("SELECT sample_id, label, predicted FROM predicted", PREDICTED)
def centroid_predict(spark: SparkSession, d: str) -> DataFrame:
    return predicted(spark, d).select("sample_id", "label", "predicted")


@query("SELECT label, predicted, n FROM matrix", MEASURED)
def confusion_matrix(spark: SparkSession, d: str) -> DataFrame:
    return models.confusion(predicted(spark, d))


def _metrics(spark: SparkSession, d: str, zero: float | None) -> DataFrame:
    return models.class_metrics(models.confusion(predicted(spark, d)), featured(spark, d), zero)


@query("SELECT label, round(precision,6) AS precision, round(recall,6) AS recall, round(f1,6) AS f1, CAST(support AS BIGINT) AS support FROM scored", MEASURED)
def class_metrics_eval(spark: SparkSession, d: str) -> DataFrame:
    return _metrics(spark, d, None).select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("SELECT label, round(precision,6) AS precision, round(coalesce(recall,0),6) AS recall, round(f1,6) AS f1, CAST(support AS BIGINT) AS support FROM scored", MEASURED)
def class_metrics_baseline(spark: SparkSession, d: str) -> DataFrame:
    return _metrics(spark, d, 0.0).select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("SELECT round(avg(f1),6) AS macro_f1, round(avg(recall),6) AS macro_recall, CAST(sum(support) AS BIGINT) AS support FROM scored WHERE recall IS NOT NULL", MEASURED)
def macro_metrics(spark: SparkSession, d: str) -> DataFrame:
    return models.macro_metrics(_metrics(spark, d, None)).select(F.round("macro_f1", 6).alias("macro_f1"), F.round("macro_recall", 6).alias("macro_recall"), "support")


@query("SELECT round(sum(CASE WHEN label = predicted THEN n ELSE 0 END) / sum(n), 6) AS accuracy, CAST(sum(n) AS BIGINT) AS support FROM matrix", MEASURED)
def accuracy(spark: SparkSession, d: str) -> DataFrame:
    return models.accuracy(models.confusion(predicted(spark, d))).select(F.round("accuracy", 6).alias("accuracy"), "support")


SLICED = "slices AS (SELECT p.*, snr_db, CASE WHEN snr_db <= -8 THEN 'low' WHEN snr_db BETWEEN -6 AND 4 THEN 'mid' WHEN snr_db >= 6 THEN 'high' END AS snr_slice FROM predicted p JOIN sig USING (sample_id))"
#: Figures by class within the groups of a column of ``slices``.
BY_SLICE = "ends AS (SELECT {0} AS s, label AS c, CAST(label = predicted AS INTEGER) AS tp, 1 AS support, 0 AS named FROM slices WHERE {0} IS NOT NULL UNION ALL SELECT {0}, predicted, 0, 0, 1 FROM slices WHERE {0} IS NOT NULL), sums AS (SELECT s, c, sum(tp) AS tp, sum(support) AS support, sum(named) AS named FROM ends GROUP BY s, c), scored AS (SELECT s, c, CASE WHEN support > 0 THEN tp / support END AS recall, 2 * tp / (support + named) AS f1, support FROM sums)"
PROBABILITIES = "odds AS (SELECT *, exp(-d) / sum(exp(-d)) OVER (PARTITION BY row_index) AS p FROM dist), scores AS (SELECT sample_id, label, arg_max(class, p) = label AS correct, max(p) AS confidence, -ln(greatest(sum(CASE WHEN class = label THEN p ELSE 0 END), 1e-15)) AS nll, sum((p - CAST(class = label AS INTEGER)) ** 2) AS brier FROM odds GROUP BY sample_id, label), bins AS (SELECT least(CAST(floor(confidence * 15) AS BIGINT), 14) AS bin, {0} AS s, count(*) AS n, avg(confidence) AS confidence, avg(CAST(correct AS INTEGER)) AS accuracy, sum(nll) AS nll, sum(brier) AS brier FROM scores JOIN slices USING (sample_id) GROUP BY 1, 2)"


def sliced(spark: SparkSession, d: str) -> DataFrame:
    ranges = signal_view(spark, d).select("sample_id", "snr_db", models.snr_slice(F.col("snr_db")).alias("snr_slice"))
    return predicted(spark, d).join(ranges, "sample_id")


def probabilities(spark: SparkSession, d: str) -> DataFrame:
    rows = featured(spark, d)
    ranges = signal_view(spark, d).select("sample_id", models.snr_slice(F.col("snr_db")).alias("snr_slice"))
    given = models.class_probabilities(rows.where("split <> 'train'"), models.centroids(rows.where("split = 'train'")))
    return models.scored(given).join(ranges, "sample_id")


def sliced_metrics(rows: DataFrame, by: str) -> DataFrame:
    return models.sliced_class_metrics(models.confusion(rows.where(F.col(by).isNotNull()), slices=[by]), [by])


@query("SELECT s AS snr_slice, round(avg(f1),6) AS macro_f1, round(avg(recall),6) AS macro_recall, CAST(sum(support) AS BIGINT) AS support, any_value(lowest) AS lowest_snr, any_value(highest) AS highest_snr FROM scored JOIN (SELECT snr_slice AS s, min(snr_db) AS lowest, max(snr_db) AS highest FROM slices GROUP BY 1) USING (s) WHERE recall IS NOT NULL GROUP BY s", ",\n".join([PREDICTED, SLICED, BY_SLICE.format("snr_slice")]))
def snr_slice_metrics(spark: SparkSession, d: str) -> DataFrame:
    rows = sliced(spark, d)
    ends = rows.groupBy("snr_slice").agg(F.min("snr_db").alias("lowest_snr"), F.max("snr_db").alias("highest_snr"))
    macro = models.macro_metrics(sliced_metrics(rows, "snr_slice"), ["snr_slice"])
    return macro.join(ends, "snr_slice").select("snr_slice", *[F.round(c, 6).alias(c) for c in ("macro_f1", "macro_recall")], "support", "lowest_snr", "highest_snr")


@query("SELECT s AS snr_slice, c AS label, round(recall,6) AS recall, CAST(support AS BIGINT) AS support FROM scored", ",\n".join([PREDICTED, SLICED, BY_SLICE.format("snr_slice")]))
def snr_slice_recall(spark: SparkSession, d: str) -> DataFrame:
    return sliced_metrics(sliced(spark, d), "snr_slice").select("snr_slice", "label", F.round("recall", 6).alias("recall"), "support")


@query("SELECT s AS snr_db, round(avg(f1),6) AS macro_f1, CAST(sum(support) AS BIGINT) AS support FROM scored WHERE recall IS NOT NULL GROUP BY s", ",\n".join([PREDICTED, SLICED, BY_SLICE.format("snr_db")]))
def snr_curve(spark: SparkSession, d: str) -> DataFrame:
    return models.macro_metrics(sliced_metrics(sliced(spark, d), "snr_db"), ["snr_db"]).select("snr_db", F.round("macro_f1", 6).alias("macro_f1"), "support")


@query("SELECT bin, n, round(confidence,6) AS confidence, round(accuracy,6) AS accuracy FROM bins", ",\n".join([PREDICTED, SLICED, PROBABILITIES.format("'all'")]))
def reliability_bins(spark: SparkSession, d: str) -> DataFrame:
    return models.reliability(probabilities(spark, d)).select("bin", "n", *[F.round(c, 6).alias(c) for c in ("confidence", "accuracy")])


@query("SELECT s AS snr_slice, round(sum(abs(accuracy - confidence) * n) / sum(n),6) AS ece, round(sum(nll) / sum(n),6) AS nll, round(sum(brier) / sum(n),6) AS brier, CAST(sum(n) AS BIGINT) AS n FROM bins GROUP BY s", ",\n".join([PREDICTED, SLICED, PROBABILITIES.format("snr_slice")]))
def calibration_by_snr(spark: SparkSession, d: str) -> DataFrame:
    found = models.calibration(probabilities(spark, d), ["snr_slice"])
    return found.select("snr_slice", *[F.round(c, 6).alias(c) for c in ("ece", "nll", "brier")], "n")


@query("SELECT CAST(dim AS INTEGER) AS dim, round(m,6)+0.0 AS mean, round(CASE WHEN s = 0 THEN 1 ELSE s END,6)+0.0 AS std FROM (SELECT k AS dim, avg(x) AS m, stddev_pop(x) AS s FROM pairs GROUP BY k UNION ALL SELECT k + 32, avg(y), stddev_pop(y) FROM pairs GROUP BY k)", over("sig"))
def feature_standardise(spark: SparkSession, d: str) -> DataFrame:
    return models.standardised(featured(spark, d)).select("dim", r6("mean").alias("mean"), r6("std").alias("std"))


def softmax_sql(epochs: int, rate: float, l2: float) -> str:
    """Gradient descent with its epochs written out; the bias is the weight of a feature that is always 1."""
    parts = [
        "raw AS (SELECT row_index, sample_id, label, k AS dim, x AS v FROM pairs UNION ALL SELECT row_index, sample_id, label, k + 32, y FROM pairs)",
        "scales AS (SELECT dim, avg(v) AS m, CASE WHEN stddev_pop(v) = 0 THEN 1 ELSE stddev_pop(v) END AS s FROM raw WHERE row_index % 5 < 3 GROUP BY dim)",
        "xs AS MATERIALIZED (SELECT row_index, sample_id, label, dim, (v - m) / s AS v FROM raw JOIN scales USING (dim) UNION ALL SELECT DISTINCT row_index, sample_id, label, -1, 1.0 FROM raw)",
        "names AS (SELECT DISTINCT label AS class FROM xs WHERE row_index % 5 < 3)",
        "w0 AS MATERIALIZED (SELECT dim, class, CAST(0 AS DOUBLE) AS w FROM (SELECT DISTINCT dim FROM xs) CROSS JOIN names)",
    ]
    for e in range(epochs):
        parts += [
            f"z{e} AS (SELECT row_index, label, class, exp(sum(v * w)) AS z FROM xs JOIN w{e} USING (dim) WHERE row_index % 5 < 3 GROUP BY ALL)",
            f"e{e} AS MATERIALIZED (SELECT row_index, class, z / sum(z) OVER (PARTITION BY row_index) - (label = class)::INT AS err FROM z{e})",
            f"g{e} AS (SELECT dim, class, sum(v * err) / (SELECT count(DISTINCT row_index) FROM e{e}) AS g FROM xs JOIN e{e} USING (row_index) GROUP BY dim, class)",
            f"w{e + 1} AS MATERIALIZED (SELECT dim, class, w - {rate} * (g + CASE WHEN dim >= 0 THEN {l2} * w ELSE 0 END) AS w FROM w{e} JOIN g{e} USING (dim, class))",
        ]
    logits = f"logits AS (SELECT sample_id, label, class, sum(v * w) AS z FROM xs JOIN w{epochs} USING (dim) GROUP BY ALL)"
    return ",\n".join([*parts, logits])


@query("SELECT sample_id, label, arg_max(class, z) AS predicted FROM logits GROUP BY sample_id, label", f"{over('sig')}, {softmax_sql(5, 0.2, 1e-3)}")
def softmax_gd(spark: SparkSession, d: str) -> DataFrame:
    rows = featured(spark, d)
    fitted = models.softmax_fit(rows.where("split = 'train'"), epochs=5, rate=0.2, l2=1e-3)
    return models.softmax_predict(rows, fitted).select("sample_id", "label", "predicted")


# Manifests and relations over other tables

EXPECTED = "expected AS (SELECT doc_id AS path, n_chars AS size FROM documents WHERE doc_id % 100 <> 3), actual AS (SELECT doc_id AS path, CASE WHEN doc_id % 100 = 5 THEN n_chars + 1 ELSE n_chars END AS size FROM documents WHERE doc_id % 100 <> 7)"


@query("SELECT coalesce(e.path, a.path) AS path, CASE WHEN e.path IS NULL THEN 'unexpected' WHEN a.path IS NULL THEN 'missing' ELSE 'changed' END AS problem FROM expected e FULL JOIN actual a ON e.path = a.path WHERE e.path IS NULL OR a.path IS NULL OR e.size <> a.size", EXPECTED)
def stage_verify_diff(spark: SparkSession, d: str) -> DataFrame:
    """What a staged file set lacks, has besides, or has changed, on a planted example."""
    from sigloom.sources.archives import stage_differences

    docs = spark.read.parquet(f"{d}/documents.parquet").select(F.col("doc_id").alias("path"), F.col("n_chars").alias("size"))
    found = docs.where("path % 100 <> 7").withColumn("size", F.when(F.col("path") % 100 == 5, F.col("size") + 1).otherwise(F.col("size")))
    return stage_differences(docs.where("path % 100 <> 3"), found, ["size"])


@query("SELECT event_type, count(*) AS n, round(min(value),6) AS minimum, round(max(value),6) AS maximum, round(avg(value),6) AS mean FROM events GROUP BY event_type")
def event_distribution(spark: SparkSession, d: str) -> DataFrame:
    events = spark.read.parquet(f"{d}/events.parquet")
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.min("value"), 6).alias("minimum"), F.round(F.max("value"), 6).alias("maximum"), F.round(F.avg("value"), 6).alias("mean"))


@query("SELECT event_type, user_id, CAST(rank AS INTEGER) AS rank, n FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, user_id) AS rank FROM (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY event_type, user_id)) WHERE rank <= 3")
def event_top_users(spark: SparkSession, d: str) -> DataFrame:
    """A top-k report: three users an event type."""
    counts = spark.read.parquet(f"{d}/events.parquet").groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"))
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy("event_type").orderBy(F.desc("n"), "user_id")))
    return ranked.where("rank <= 3").select("event_type", "user_id", "rank", "n")
