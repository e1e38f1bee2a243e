"""Command line: runs a query or a stage, or fetches, registers and lists sources. Errors are JSON on stderr, exit 2."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path
from typing import TYPE_CHECKING

if TYPE_CHECKING:
    from pyspark.sql import SparkSession


STAGES = ("ingest", "eda", "preprocess", "split", "train", "evaluate")


def load_config(path: str) -> dict:
    """A JSON object; JSON is YAML, so either suffix may hold it."""
    value = json.loads(Path(path).read_text())
    if not isinstance(value, dict):
        raise ValueError(f"{path} must hold an object")
    return value


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="sigloom", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("query", help="run a query over a folder of tables")
    run.add_argument("name")
    run.add_argument("tables")
    run.add_argument("--out", help="Parquet folder; without it rows are shown")
    for name in ("acquire", "register", *STAGES):
        commands.add_parser(name).add_argument("config")
    index = commands.add_parser("index", help="publish where the rows of array files lie")
    index.add_argument("path")
    index.add_argument("out")
    inspect = commands.add_parser("inspect", help="one sample of signal files, or of those that an index knows (form: index), of which one is read")
    inspect.add_argument("path")
    inspect.add_argument("form")
    inspect.add_argument("--index", type=int, default=0)
    for parser_ in (index, inspect):
        parser_.add_argument("--member", help="the array in NPZ files")
    args = parser.parse_args(argv)
    try:
        return _run(args)
    except Exception as error:  # the contract of a command line: a message, not a trace
        print(json.dumps({"error": type(error).__name__, "message": str(error)[:2000]}), file=sys.stderr)
        return 2


def _run(args: argparse.Namespace) -> int:
    from sigloom.sources import acquire

    if args.command == "acquire":
        print(json.dumps(acquire.acquire(acquire.Acquisition(**load_config(args.config)))))
        return 0
    if args.command == "register":
        config = load_config(args.config)
        print(json.dumps(acquire.register(acquire.Acquisition(**config["acquisition"]), config["source"], config["license"], config["manifest"])))
        return 0
    from pyspark.sql import SparkSession

    from sigloom.plans import catalogue
    from sigloom.session import ship

    spark = ship(SparkSession.builder.getOrCreate())
    if args.command in STAGES:
        print(json.dumps(run_stage(spark, args.command, load_config(args.config))))
        return 0
    if args.command == "index":
        from sigloom.sources.ranges import write_index

        print(json.dumps({"files": write_index(spark, args.path, args.out, args.member).count()}))
        return 0
    if args.command == "inspect":
        from sigloom.sources.files import read_signals, with_row_index
        from sigloom.sources.ranges import read_sample

        if args.form == "index":
            print(json.dumps(read_sample(spark, args.path, args.index, args.member)))
            return 0
        row = with_row_index(read_signals(spark, args.path, args.form)).where(f"row_index = {args.index}").first()
        print(json.dumps(row.asDict() if row else None))
        return 0
    out = catalogue.QUERIES[args.name](spark, args.tables)
    out.write.parquet(args.out) if args.out else out.show(50, False)
    return 0


def run_stage(spark: SparkSession, name: str, config: dict) -> dict:
    """Runs one stage by its settings; tables are Parquet, or files of ``form``.

    ingest: archives, source_id, version, out. eda: input, out, source_id, revision. split: input, out, policy, duplicates, edges, fractions,
    seed (validates first). preprocess: as split, and mode. train: input, out, fraction, seed, epochs, rate, l2. evaluate: input, model."""
    from sigloom.operators.duplicates import DuplicatePolicy
    from sigloom.operators.validation import ValidationPolicy
    from sigloom.plans import stages
    from sigloom.sources import archives, files

    if name == "ingest":
        return archives.ingest(spark, config["archives"], config["source_id"], config["version"], config["out"])
    table = files.with_row_index(files.read_signals(spark, config["input"], config["form"])) if "form" in config else spark.read.parquet(config["input"])
    if name == "eda":
        return stages.eda_stage(table, config["out"], config["source_id"], config["revision"])
    if name == "train":
        return stages.train_stage(table, config["out"], config["fraction"], config["seed"], config["epochs"], config["rate"], config.get("l2", 0.0))
    if name == "evaluate":
        return stages.evaluate_stage(table, config["model"])
    out = config["out"]
    chain = [stages.validate_stage(table, out, ValidationPolicy.from_mapping(config["policy"]), DuplicatePolicy(**config.get("duplicates", {})))]
    chain.append(stages.split_stage(out, spark, config["edges"], config["fractions"], config["seed"], chain[-1]))
    if name == "preprocess":
        chain.append(stages.preprocess_stage(out, spark, config["mode"], chain[-1]))
    return stages.report(chain)


if __name__ == "__main__":
    sys.exit(main())
