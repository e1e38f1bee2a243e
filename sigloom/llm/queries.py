"""One query an operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom.llm import bestfit, langid, linededup, media, mixing, neardup, packing, periods, pii, quality, spelling, tokens, vectors
from sigloom.llm.common import fold


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.read_documents(tokens.token_file(table(spark, sf_dir, "documents")))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), payload=F.crc32)
    return pieces.select("doc_id", "start", "length", F.col("payload").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    remainder = fold(F.col("doc_id"), 5)
    model = langid.train(docs.where(remainder != 0))
    return langid.predict(docs, model, [F.col("doc_id"), (remainder == 0).alias("held_out")])


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    features = quality.feature_table(docs, [F.col("doc_id"), (fold(F.col("doc_id"), 3) == 1).alias("held_out")])
    net = quality.train(features, labels, fold(F.col("key"), 3) != 1)
    scored = quality.score(features, net, ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_passages(table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find_spans(table(spark, sf_dir, "documents")))


def op8_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.vector_links(table(spark, sf_dir, "embeddings"))


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.describe_media(media.sound_table(media.media_table(table(spark, sf_dir, "documents"))))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies", "seed")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.digests(periods.find_runs(periods.with_planted_tails(table(spark, sf_dir, "documents"))))


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.pack_best_fit(table(spark, sf_dir, "documents"), payload=F.crc32).withColumnRenamed("payload", "ids_crc32")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelling.vocabulary(spelling.planted_words(table(spark, sf_dir, "documents"))))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_ids": op1_token_ids,
    "op2_packing": op2_packing,
    "op3_language": op3_language,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_quality": op5_quality,
    "op6_line_dedup": op6_line_dedup,
    "op7_personal_data": op7_personal_data,
    "op8_vectors": op8_vectors,
    "op9_media": op9_media,
    "op10_mixing": op10_mixing,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_best_fit": op12_best_fit,
    "op13_spelling": op13_spelling,
    "pipeline": pipeline,
}

#: crc32 in SQL: the table by its rule, and the fold over bytes.
CRC_TABLE = "crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c FROM range(256) AS r(i)))"
ID_BYTES = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(unicode(c) AS BIGINT))"


def crc_sql(data: str) -> str:
    return f"xor(list_reduce({data}, lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8), 4294967295), 4294967295)"


#: The others need tokenizers, learned models, Spark's hashes or codecs, which SQL lacks; tests
#: hold them against brute-force versions.
ORACLE: dict[str, str] = {
    "op4_near_duplicates": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2]) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
both_have AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM both_have x JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * x.n >= 85 * (p.n + q.n - x.n)),
reach AS (SELECT doc_id AS d, doc_id AS r FROM words UNION SELECT links.a, reach.r FROM reach JOIN links ON links.b = reach.d)
SELECT w.doc_id, coalesce(any_value(z.n), 0) AS n_shingles, min(r) AS component_id, min(r) = w.doc_id AS kept
FROM words w LEFT JOIN sizes z USING (doc_id) JOIN reach ON reach.d = w.doc_id GROUP BY w.doc_id""",
    "op8_vectors": """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS d, vec_id AS r FROM v UNION SELECT links.a, reach.r FROM reach JOIN links ON links.b = reach.d)
SELECT v.vec_id, (SELECT count(*) FROM links WHERE links.a = v.vec_id) AS n_links, min(r) AS component_id, min(r) = v.vec_id AS kept
FROM v JOIN reach ON reach.d = v.vec_id GROUP BY v.vec_id""",
    "op11_periodic_runs": f"""
WITH {CRC_TABLE},
split AS (SELECT doc_id, {crc_sql(ID_BYTES)} AS h, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents, crc),
begun AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM split),
planted AS (
  SELECT doc_id, CASE WHEN h % 10 = 0 AND n > 0 THEN list_concat(w[1:a], list_transform(range(0, n - a), lambda i: w[a + i % (1 + (n - a) // (3 + g % 8)) + 1])) ELSE w END AS w FROM begun),
words AS (SELECT doc_id, unnest(range(len(w))) AS i, unnest(w) AS x FROM planted),
triples AS (SELECT doc_id, i, x || ' ' || lead(x) OVER later || ' ' || lead(x, 2) OVER later AS x FROM words WINDOW later AS (PARTITION BY doc_id ORDER BY i)),
equal_ones AS (SELECT a.doc_id, a.i, b.i - a.i AS q FROM triples a JOIN triples b ON a.doc_id = b.doc_id AND a.x = b.x AND a.i < b.i),
stretches AS (
  SELECT doc_id, q, min(i) AS s, max(i) + 3 + q AS e FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal_ones) GROUP BY doc_id, q, island),
runs AS (SELECT doc_id, s, e - s AS length, min(q) AS q FROM stretches WHERE e - s >= greatest(6, 4 * q) GROUP BY doc_id, s, e),
repeats AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + length)) AS i FROM runs),
collapsed AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS text FROM words ANTI JOIN repeats USING (doc_id, i) GROUP BY doc_id),
facts AS (
  SELECT doc_id, count(*) AS n_runs, first(struct_pack(s := s, length := length, q := q) ORDER BY length DESC, s, q) AS best, string_agg(s || ',' || length || ',' || q || chr(10), '' ORDER BY s, q) AS lines
  FROM runs GROUP BY doc_id)
SELECT p.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.length AS length, best.q AS period, 1000 * best.length // best.q AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(c.text, '')) AS collapsed_sha256, len(p.w) AS n_words
FROM planted p LEFT JOIN facts USING (doc_id) LEFT JOIN collapsed c USING (doc_id)""",
    "op13_spelling": f"""
WITH RECURSIVE {CRC_TABLE},
found AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
hashed AS (
  SELECT run, {crc_sql(f"list_concat({ID_BYTES}, [58], flatten(list_transform(string_split(run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [192 | (unicode(c) >> 6), 128 | (unicode(c) & 63)] END)))")} AS h
  FROM found, crc WHERE length(run) >= 7),
cut AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
words AS (SELECT word, count(*) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
less AS (SELECT word, n, i, length(word) AS l, substr(word, 1, i) || substr(word, i + 2) AS v FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM less a JOIN less b ON a.l = b.l AND a.i = b.i AND a.v = b.v AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.v = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.v = b.word),
best AS (SELECT word, count(*) AS n_near, first(struct_pack(other := other, n := n) ORDER BY n DESC, other) AS b FROM near GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN b.n >= 10 * w.n THEN b.other END AS form, CASE WHEN b.n >= 10 * w.n THEN b.n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
chain AS (SELECT word, form AS root, 1 AS depth FROM formed WHERE form IS NOT NULL
  UNION ALL SELECT chain.word, f.form, depth + 1 FROM chain JOIN formed f ON f.word = root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, coalesce(r.root, f.word) AS root, f.n, f.n_near, f.form_n
FROM formed f LEFT JOIN (SELECT word, arg_max(root, depth) AS root FROM chain GROUP BY word) r USING (word)""",
}
