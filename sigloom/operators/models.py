"""Small reference classifiers, predictions and metrics."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F

from sigloom.functions.signal import squared_distance
from sigloom.sources.publish import publish, verify
from sigloom.storage import stored


def centroids(df: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
    """(label, centroid): means of each dimension in each class, by (class, dimension) partial sums."""
    long = df.select(F.col(label).alias("label"), F.posexplode(features).alias("dim", "v"))
    means = long.groupBy("label", "dim").agg(F.avg(F.col("v").cast("double")).alias("m"))
    ordered = F.array_sort(F.collect_list(F.struct("dim", "m")))
    return means.groupBy("label").agg(F.transform(ordered, lambda x: x["m"]).alias("centroid"))


def nearest(df: DataFrame, classes: DataFrame, features: str = "features", block: int = 4096) -> DataFrame:
    """The rows with ``predicted``, the class of the nearest centroid; of equals the first class.

    Centroids come in blocks of about ``block``, dealt by hash; each block is broadcast as one row, and
    rows keep the best so far. So any number of classes is met without a shuffle of rows."""
    blocks = max(1, -(-classes.count() // block))
    dealt = classes.select(F.col("label").alias("class"), "centroid", F.pmod(F.xxhash64("label"), F.lit(blocks)).alias("block"))
    best = None
    for k in range(blocks):
        table = dealt.where(F.col("block") == k).agg(F.array_sort(F.collect_list(F.struct("class", "centroid"))).alias("_classes"))
        distances = F.transform("_classes", lambda c: F.struct(squared_distance(F.col(features), c["centroid"]).alias("d"), c["class"].alias("class")))
        least = F.array_min(distances)
        best = least if best is None else F.array_min(F.array(F.col("_best"), least))
        df = df.crossJoin(F.broadcast(table)).withColumn("_best", best).drop("_classes")  # one row of one block
    return df.withColumn("predicted", F.col("_best")["class"]).drop("_best")


def class_probabilities(df: DataFrame, classes: DataFrame, features: str = "features") -> DataFrame:
    """The rows with ``probabilities``: (class, p) of every class, in their order, p in proportion to
    exp(-squared distance) from its centroid. A row of the result holds every class, so the model is broadcast whole."""
    table = classes.agg(F.array_sort(F.collect_list(F.struct(F.col("label").alias("class"), "centroid"))).alias("_classes"))
    joined = df.crossJoin(F.broadcast(table))  # one row
    far = F.transform("_classes", lambda c: F.struct(c["class"].alias("class"), squared_distance(F.col(features), c["centroid"]).alias("d")))
    joined = joined.withColumn("_far", far).withColumn("_least", F.array_min(F.transform("_far", lambda c: c["d"])))
    joined = joined.withColumn("_w", F.transform("_far", lambda c: F.struct(c["class"].alias("class"), F.exp(F.col("_least") - c["d"]).alias("w"))))
    joined = joined.withColumn("_sum", F.aggregate("_w", F.lit(0.0), lambda s, c: s + c["w"]))
    shared = F.transform("_w", lambda c: F.struct(c["class"].alias("class"), (c["w"] / F.col("_sum")).alias("p")))
    return joined.withColumn("probabilities", shared).drop("_classes", "_far", "_least", "_w", "_sum")


def confusion(df: DataFrame, label: str = "label", predicted: str = "predicted", slices: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*slices, F.col(label).alias("label"), F.col(predicted).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def class_metrics(matrix: DataFrame, classes: DataFrame, zero_recall: float | None = None) -> DataFrame:
    """(label, precision, recall, f1, support) from a confusion table, for every class. A class without support has the
    recall ``zero_recall``: null (evaluation reports) or 0 (baseline reports)."""
    sums = classes.select(F.col("label").alias("c")).distinct().join(_ends(matrix, ()), "c", "left").groupBy("c")
    return _rates(sums, (), zero_recall)


def sliced_class_metrics(matrix: DataFrame, slices: Sequence[str]) -> DataFrame:
    """(slices..., label, precision, recall, f1, support) from a confusion table by slice, for the classes that
    a slice has or that were predicted there; the latter have a null recall."""
    return _rates(_ends(matrix, slices).groupBy(*slices, "c"), slices, None)


def _ends(matrix: DataFrame, slices: Sequence[str]) -> DataFrame:
    none = F.lit(0).cast("long")
    ends = matrix.select(*slices, F.col("label").alias("c"), F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0).alias("tp"), F.col("n").alias("support"), none.alias("named"))
    return ends.unionByName(matrix.select(*slices, F.col("predicted").alias("c"), none.alias("tp"), none.alias("support"), F.col("n").alias("named")))


def _rates(ends: GroupedData, slices: Sequence[str], zero_recall: float | None) -> DataFrame:
    sums = ends.agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in ("tp", "support", "named")])
    rates = sums.select(*slices, F.col("c").alias("label"), F.coalesce(F.try_divide("tp", "named"), F.lit(0.0)).alias("precision"), F.coalesce(F.try_divide("tp", "support"), F.lit(zero_recall).cast("double")).alias("recall"), "support")
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    return rates.withColumn("f1", f1)


def macro_metrics(per_class: DataFrame, slices: Sequence[str] = ()) -> DataFrame:
    """(slices..., macro_f1, macro_recall, support) over the classes whose recall is not null."""
    present = per_class.where("recall is not null")
    return present.groupBy(*slices).agg(F.avg("f1").alias("macro_f1"), F.avg("recall").alias("macro_recall"), F.sum("support").alias("support"))


def accuracy(matrix: DataFrame) -> DataFrame:
    """(accuracy, support) of a confusion table: one row; null where nothing was predicted."""
    right = F.sum(F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0))
    return matrix.agg(F.try_divide(right, F.sum("n")).alias("accuracy"), F.coalesce(F.sum("n"), F.lit(0)).alias("support"))


def standardised(df: DataFrame, features: str = "features") -> DataFrame:
    """(dim, mean, std): population std, 1 where it is 0."""
    stats = df.select(F.posexplode(features).alias("dim", "v")).groupBy("dim").agg(F.avg(F.col("v").cast("double")).alias("mean"), F.stddev_pop(F.col("v").cast("double")).alias("std"))
    return stats.withColumn("std", F.when(F.col("std") == 0, 1.0).otherwise(F.col("std")))


class ModelError(ValueError):
    """A model cannot be fitted to these rows, or with these settings."""


#: Partial gradients that one task adds up.
FAN = 32


def checked_features(df: DataFrame, features: str = "features", label: str = "label") -> tuple[int, int]:
    """(rows, dimensions) of a labelled table. Null labels, and features that are null, hold null or numbers that are not
    finite, or differ in length, raise."""
    x = F.col(features).cast("array<double>")
    odd = x.isNull() | F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(odd).alias("odd"), F.count_if(F.col(label).isNull()).alias("blank"), F.min(F.size(x)).alias("least"), F.max(F.size(x)).alias("most")).first()
    if row["odd"] or row["blank"] or row["least"] != row["most"]:
        raise ModelError(f"{row['odd']} rows without finite features, {row['blank']} without a label, lengths {row['least']} to {row['most']}")
    return row["n"], row["most"] or 0


def added_up(parts: DataFrame, n: int, shape: tuple[int, int]) -> np.ndarray:
    """The sum of ``n`` matrices (part, g): tasks add up FAN each, level by level, so that the driver gets FAN at most,
    and always in the same order."""
    schema = pa.schema([("part", pa.int64()), ("g", pa.binary())])

    def add(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("part").to_pylist(), table.column("g").to_pylist(), strict=True))
        total = np.zeros(shape)
        for _, g in rows:
            total += np.frombuffer(g).reshape(shape)
        return pa.table({"part": [rows[0][0] // FAN], "g": [total.tobytes()]}, schema=schema)

    while n > FAN:
        parts, n = parts.groupBy(F.expr(f"part div {FAN}")).applyInArrow(add, "part long, g binary"), -(-n // FAN)
    rows = sorted((r["part"], r["g"]) for r in parts.collect())
    return np.sum([np.frombuffer(g).reshape(shape) for _, g in rows], axis=0)


def softmax_fit(df: DataFrame, epochs: int, rate: float, l2: float = 0.0, features: str = "features", label: str = "label", parts: int | None = None) -> dict[str, object]:
    """Full-batch gradient descent from zero. Every epoch is one pass over a stored table, of partial gradients by
    partition that the cluster adds up: the driver gets some (classes x dims) matrices, whatever rows and partitions
    there are. ``parts`` deals the rows out anew."""
    if rate <= 0 or epochs < 1 or l2 < 0:
        raise ModelError(f"rate {rate}, epochs {epochs}, l2 {l2}")
    n, d = checked_features(df, features, label)
    classes = [r[0] for r in df.select(label).distinct().orderBy(label).collect()]
    if n < 2 or len(classes) < 2 or not d:
        raise ModelError(f"{n} rows of {len(classes)} classes with {d} features")
    stats = standardised(df, features).orderBy("dim").collect()
    mean, std = np.array([r["mean"] for r in stats]), np.array([r["std"] for r in stats])
    index, k = {c: j for j, c in enumerate(classes)}, len(classes)
    rows = df.select(F.col(features).cast("array<double>").alias("x"), F.col(label).alias("y"))
    source = stored(rows if parts is None else rows.repartition(parts), "softmax-rows")
    size = source.select(F.spark_partition_id().alias("part")).agg(F.max("part")).first()[0] + 1
    w, b = np.zeros((d, k)), np.zeros(k)
    for _ in range(epochs):

        def gradient(batches: Iterator[pa.RecordBatch], w: np.ndarray = w, b: np.ndarray = b) -> Iterator[pa.RecordBatch]:
            total = np.zeros((d + 1, k))
            for batch in batches:
                if batch.num_rows:
                    x = (batch.column(0).flatten().to_numpy().reshape(-1, d) - mean) / std
                    logits = x @ w + b
                    p = np.exp(logits - logits.max(1, keepdims=True))
                    p /= p.sum(1, keepdims=True)
                    p[np.arange(len(p)), [index[y] for y in batch.column(1).to_pylist()]] -= 1
                    total[:d] += x.T @ p
                    total[d] += p.sum(0)
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["part", "g"])

        g = added_up(source.mapInArrow(gradient, "part long, g binary"), size, (d + 1, k)) / n
        w = w - rate * (g[:d] + l2 * w)
        b = b - rate * g[d]
    return {"classes": classes, "weights": w.astype(np.float32), "bias": b.astype(np.float32), "mean": mean.astype(np.float32), "scale": std.astype(np.float32)}


def save_centroids(centres: DataFrame, path: str) -> str:
    """Publishes (label, centroid): one row a class, of one length, without null."""
    checked_features(centres, "centroid")
    if centres.count() != centres.select("label").distinct().count():
        raise ModelError("a label has several centroids")
    return publish(centres.select(F.col("label").cast("string").alias("label"), F.col("centroid").cast("array<double>").alias("centroid")), path)


def load_centroids(spark: SparkSession, path: str) -> DataFrame:
    """A published centroid model, once its content is what its manifest says."""
    verify(spark, path)
    table = spark.read.parquet(path)
    if sorted(table.columns) != ["centroid", "label"] or table.isEmpty():
        raise ModelError(f"{path} holds no centroids")
    return table


def softmax_predict(df: DataFrame, model: dict[str, object], features: str = "features") -> DataFrame:
    """The rows with ``predicted``: the first class of the greatest logit, as array expressions."""
    w, mean, scale = (np.asarray(model[x], np.float64) for x in ("weights", "mean", "scale"))
    x = F.transform(F.col(features), lambda v, i: (v.cast("double") - F.get(F.array(*map(F.lit, mean.tolist())), i)) / F.get(F.array(*map(F.lit, scale.tolist())), i))

    def logit(column: Sequence[float], bias: float) -> Column:
        return F.aggregate(F.zip_with(F.col("_x"), F.array(*map(F.lit, map(float, column))), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v) + F.lit(float(bias))

    logits = F.array(*[logit(w[:, k], bias) for k, bias in enumerate(np.asarray(model["bias"]).tolist())])
    named = F.array(*[F.lit(c) for c in model["classes"]])
    return df.withColumn("_x", x).withColumn("_l", logits).withColumn("predicted", F.get(named, (F.array_position("_l", F.array_max("_l")) - 1).cast("int"))).drop("_x", "_l")


#: The named ranges of SNR in dB, ends included.
SNR_SLICES = {"low": (float("-inf"), -8.0), "mid": (-6.0, 4.0), "high": (6.0, float("inf"))}


def snr_slice(snr: Column, slices: Mapping[str, tuple[float, float]] = SNR_SLICES) -> Column:
    """The name of the range that holds an SNR; null where it is missing, no number, or in no range."""
    named = F.lit(None).cast("string")
    for name, (low, high) in slices.items():
        named = F.when(snr.between(low, high) & ~F.isnan(snr), name).otherwise(named)
    return named


def scored(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows with ``probabilities`` get ``predicted`` (the first class of the greatest), ``confidence`` (its
    probability), ``correct``, ``nll`` (probabilities below 1e-15 count as that, and so do classes that the
    model lacks) and ``brier``, the sum over classes of squared differences from the label."""
    best = F.array_max(F.transform("probabilities", lambda c: c["p"]))
    first = F.element_at(F.filter("probabilities", lambda c: c["p"] == F.col("confidence")), 1)["class"]
    own = F.aggregate("probabilities", F.lit(0.0), lambda s, c: s + F.when(c["class"] == F.col(label), c["p"]).otherwise(0.0))
    missed = F.aggregate("probabilities", F.lit(0.0), lambda s, c: s + F.pow(c["p"] - (c["class"] == F.col(label)).cast("double"), 2))
    rows = df.withColumn("confidence", best).withColumn("predicted", first)
    return rows.withColumns({"correct": F.col("predicted") == F.col(label), "nll": -F.log(F.greatest(own, F.lit(1e-15))), "brier": missed})


def reliability(scores: DataFrame, slices: Sequence[str] = (), bins: int = 15) -> DataFrame:
    """(slices..., bin, n, confidence, accuracy, nll, brier) of equal bins of confidence: the last two are sums."""
    binned = scores.withColumn("bin", F.least(F.floor(F.col("confidence") * bins), F.lit(bins - 1)))
    return binned.groupBy(*slices, "bin").agg(F.count(F.lit(1)).alias("n"), F.avg("confidence").alias("confidence"), F.avg(F.col("correct").cast("double")).alias("accuracy"), F.sum("nll").alias("nll"), F.sum("brier").alias("brier"))


def calibration(scores: DataFrame, slices: Sequence[str] = (), bins: int = 15) -> DataFrame:
    """(slices..., ece, nll, brier, n): expected calibration error over equal bins, means of the others."""
    gaps = F.sum(F.abs(F.col("accuracy") - F.col("confidence")) * F.col("n")) / F.sum("n")
    return reliability(scores, slices, bins).groupBy(*slices).agg(gaps.alias("ece"), (F.sum("nll") / F.sum("n")).alias("nll"), (F.sum("brier") / F.sum("n")).alias("brier"), F.sum("n").alias("n"))


def model_table(spark: SparkSession, model: dict[str, object]) -> DataFrame:
    """A softmax model as (k, label, weights, bias, mean, scale), one row a class."""
    w, bias, mean, scale = (np.asarray(model[x]).tolist() for x in ("weights", "bias", "mean", "scale"))
    rows = [(k, str(c), [row[k] for row in w], bias[k], mean, scale) for k, c in enumerate(model["classes"])]
    return spark.createDataFrame(rows, "k int, label string, weights array<float>, bias float, mean array<float>, scale array<float>")


def model_from_table(table: DataFrame) -> dict[str, object]:
    rows = table.orderBy("k").collect()  # one row a class
    if not rows:
        raise ValueError("a model needs classes")
    single = lambda v: np.asarray(v, np.float32)
    return {"classes": [r["label"] for r in rows], "weights": single([r["weights"] for r in rows]).T, "bias": single([r["bias"] for r in rows]), "mean": single(rows[0]["mean"]), "scale": single(rows[0]["scale"])}


def evaluation(scored: DataFrame, classes: DataFrame, zero_recall: float | None = None) -> dict[str, object]:
    """Accuracy, macro figures, and figures and counts by class, from one confusion table of at most
    classes x classes rows."""
    spark = scored.sparkSession
    counts = [tuple(r) for r in confusion(scored).collect()]
    matrix = spark.createDataFrame(counts, "label string, predicted string, n long")
    per_class = class_metrics(matrix, classes.select("label").distinct(), zero_recall)
    by_class = {r["label"]: {c: r[c] for c in ("precision", "recall", "f1", "support")} for r in per_class.collect()}
    whole = macro_metrics(per_class).first()
    return {"accuracy": accuracy(matrix).first()["accuracy"], "macro_f1": whole["macro_f1"], "macro_recall": whole["macro_recall"], "class_metrics": by_class, "confusion": sorted(counts)}
