"""Stages from signals to prepared splits, each a published table with a content hash, and a
report that chains the hashes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.operators import duplicates, eda, models, preprocessing, quarantine, splitting, validation
from sigloom.schema import canonical_sha256
from sigloom.sources.publish import content_hash, publish
from sigloom.storage import stored


class StageError(RuntimeError):
    """A stage's input is not what its predecessor published."""


def validate_stage(signals: DataFrame, out: str, policy: validation.ValidationPolicy, copies: duplicates.DuplicatePolicy) -> dict[str, Any]:
    """Publishes accepted rows and quarantine entries. A null group is unresolved, and kept out."""
    spark = signals.sparkSession
    issues = validation.issues(signals, policy)
    valid = validation.valid_rows(signals, policy)
    unresolved = valid.where(duplicates.explicit_group().isNull()).select("sample_id", F.lit("group.unresolved").alias("error_code"))
    found = quarantine.reasons(issues, duplicates.exact_members(valid), duplicates.near_pairs(valid, copies), unresolved)
    found = quarantine.assert_known(stored(found, "reasons"), signals)
    if quarantine.accepted(signals, found).isEmpty():
        raise StageError("no row is accepted")
    status = publish(quarantine.entries(found), f"{out}/quarantine")
    entries = spark.read.parquet(f"{out}/quarantine")
    publish(quarantine.accepted(signals, entries), f"{out}/accepted")
    accepted = spark.read.parquet(f"{out}/accepted")
    check = quarantine.partition_check(signals, accepted, entries).first()
    if check["overlap"] or check["missing"]:
        raise StageError(f"rows are kept twice or not at all: {check}")
    return {"stage": "validate", "status": status, "accepted": check["accepted"], "quarantined": check["quarantined"], "accepted_hash": content_hash(accepted)}


def split_stage(out: str, spark: Any, edges: Sequence[float], fractions: Mapping[str, float], seed: int, before: Mapping[str, Any]) -> dict[str, Any]:
    accepted = spark.read.parquet(f"{out}/accepted")
    if content_hash(accepted) != before["accepted_hash"]:
        raise StageError("accepted rows changed since validation")
    split = splitting.group_splits(accepted, edges, fractions, seed)
    names = {}
    for name in ("development", "test"):  # the test rows lie apart, so that development never reads them
        rows = split.where((F.col("split") == "test") == F.lit(name == "test")).select("row_index", "sample_id", "group_id", "split")
        publish(rows, f"{out}/{name}")
        names[name] = content_hash(spark.read.parquet(f"{out}/{name}"))
    held = splitting.split_manifest(split, edges, fractions, seed)
    return {"stage": "split", "manifest": held, "development_hash": names["development"], "test_lock": canonical_sha256(names["test"]), "input_hash": before["accepted_hash"]}


def locked_test(out: str, spark: Any, lock: str) -> DataFrame:
    """The test rows, for who knows their lock."""
    rows = spark.read.parquet(f"{out}/test")
    if canonical_sha256(content_hash(rows)) != lock:
        raise StageError("the lock does not open the test rows")
    return rows


def preprocess_stage(out: str, spark: Any, mode: str, before: Mapping[str, Any]) -> dict[str, Any]:
    """Fits on training rows, and publishes all accepted rows transformed."""
    accepted, development = spark.read.parquet(f"{out}/accepted"), spark.read.parquet(f"{out}/development")
    if content_hash(development) != before["development_hash"]:
        raise StageError("splits changed")
    train = accepted.join(development.where("split = 'train'").select("row_index"), "row_index", "left_semi")
    fitted = preprocessing.fit(train, mode)
    publish(fitted.transform(accepted), f"{out}/prepared")
    return {"stage": "preprocess", "fitted": fitted.sha256(), "prepared_hash": content_hash(spark.read.parquet(f"{out}/prepared")), "input_hash": before["development_hash"]}


def report(stages: Sequence[Mapping[str, Any]]) -> dict[str, Any]:
    """The export manifest: the stages' facts, and its own hash. Problems are collected by ``manifest_errors``."""
    body = {"schema_version": "1.0", "stages": [dict(s) for s in stages]}
    return body | {"sha256": canonical_sha256(body)}


def manifest_errors(manifest: Mapping[str, Any]) -> list[str]:
    """All that is wrong with an export manifest."""
    found = []
    body = {k: v for k, v in manifest.items() if k != "sha256"}
    if manifest.get("schema_version") != "1.0":
        found.append("schema_version")
    if canonical_sha256(body) != manifest.get("sha256"):
        found.append("sha256")
    stages = {s.get("stage"): s for s in manifest.get("stages", [])}
    found += [f"no stage {x}" for x in ("validate", "split", "preprocess") if x not in stages]
    if not found and (stages["split"]["input_hash"] != stages["validate"]["accepted_hash"] or stages["preprocess"]["input_hash"] != stages["split"]["development_hash"]):
        found.append("hash chain")
    return found


def eda_stage(signals: DataFrame, out: str, source_id: str, revision: str) -> dict[str, Any]:
    """Publishes the exploratory tables; the run's id follows from the input's content and source."""
    tables = {"numeric_summary": eda.numeric_summary(signals), "class_distribution": eda.class_distribution(signals), "snr_distribution": eda.snr_distribution(signals), "length_distribution": eda.length_distribution(signals)}
    origin = {"source_id": source_id, "source_revision": revision, "input": content_hash(signals)}
    run_id = canonical_sha256(origin)[:16]
    hashes = {}
    for name, table in tables.items():
        rounded = [(F.round(c, 9) + F.lit(0.0)).alias(c) if t == "double" else F.col(c) for c, t in table.dtypes]  # sums of floats follow the order of rows
        publish(table.select(*rounded), f"{out}/{run_id}/{name}")
        hashes[name] = content_hash(signals.sparkSession.read.parquet(f"{out}/{run_id}/{name}"))
    return {"schema_version": "1.0", "run_id": run_id, "source": origin, "tables": hashes}


def train_stage(rows: DataFrame, out: str, fraction: float, seed: int, epochs: int, rate: float, l2: float = 0.0) -> dict[str, Any]:
    """Fits the softmax baseline to the rows not held out, publishes model and split, and evaluates on
    the rest. Rows have row_index, label and features."""
    if not 0 < fraction < 1:
        raise StageError("fraction must lie between 0 and 1")
    split = splitting.seeded_rows(rows, fraction, seed)
    sizes = split.agg(F.count_if("held_out").alias("test"), F.count_if(~F.col("held_out")).alias("train")).first()
    if not sizes["train"]:
        raise StageError("no row is left to train on")
    model = models.softmax_fit(split.where(~F.col("held_out")), epochs, rate, l2)
    spark = rows.sparkSession
    publish(models.model_table(spark, model), f"{out}/model")
    publish(split.select("row_index", "held_out"), f"{out}/split")
    metrics = evaluate_stage(split.where("held_out"), f"{out}/model", 0.0)
    return {"schema_version": "1.0", "model_type": "softmax", "seed": seed, "train_samples": sizes["train"], "test_samples": sizes["test"], "metrics": metrics, "model_hash": content_hash(spark.read.parquet(f"{out}/model"))}


def evaluate_stage(rows: DataFrame, model: str, zero_recall: float | None = None) -> dict[str, Any]:
    """Figures of a published softmax model on labelled rows."""
    fitted = models.model_from_table(rows.sparkSession.read.parquet(model))
    scored = models.softmax_predict(rows, fitted)
    known = rows.sparkSession.createDataFrame([(c,) for c in fitted["classes"]], "label string")
    return models.evaluation(scored, known.union(rows.select("label")), zero_recall)
