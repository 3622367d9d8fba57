"""Training and inference from files to files: ``python -m weftlink.plans.run --mode train|infer``."""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import text as X
from ..operators import candidates, ml, outputs
from ..sources import entities as io
from ..sources.scratch import written
from ..sources.shipping import ship
from .cycles import reject_all, run_cycles
from .match import features, match, retrieve

#: Tables of a split in its folder: the queries, then the targets.
SOURCES = {"train": ("train_s1.tsv", "train_s2.tsv", "train_s3.tsv"), "test": ("test_s1.tsv", "test_s2.tsv", "test_s3.tsv")}


def load(spark: SparkSession, folder: str, names: tuple[str, str, str], settings: Settings, keep: str) -> tuple[DataFrame, DataFrame]:
    """Clean queries and targets of a split, written by role and country; RowCountError if rows are lost, MissingTargetError if a country lacks targets."""
    clean = []
    for k, name in enumerate(names):
        raw = io.read_entities(spark, f"{folder}/{name}", settings)
        clean.append(io.clean(raw, f"S{k + 1}", settings))
        io.check_rows(raw, clean[-1], name)
    queries, targets = clean[0], io.union_targets(*clean[1:])
    io.write_partitions(queries, targets, keep, settings)
    kept = io.read_partitions(spark, keep, "Query"), io.read_partitions(spark, keep, "Target")
    for role, before, after in zip(("queries", "targets"), (queries, targets), kept, strict=True):
        io.check_rows(before, after, role)
    io.check_targets(*kept)
    return kept


def train(spark: SparkSession, settings: Settings, kind: str = "monotone", trials: int = 0, names: tuple[str, str, str] = SOURCES["train"]) -> dict:
    """Fits a model on all candidates of all cycles, saves it under ``model_output_path`` and returns its facts.

    ``trials`` seeded trials search the parameters first. Every candidate becomes a labelled pair:
    nothing is accepted, so the cycles go on until they stop by themselves.
    """
    ship(spark)
    queries, targets = load(spark, settings.data_dir_train, names, settings, f"{settings.processed_data_dir}/train")
    truth = io.read_truth(spark, settings.ground_truth_path)
    streams, selfs = retrieve(queries, targets, settings)
    made = run_cycles(queries, streams, reject_all, settings)
    pairs = features(made.drop("cycle", "seq", "accepted"), queries, targets, selfs, settings)
    labelled = written(candidates.label(pairs.select("entity_id", "cand_id", *ml.FEATURE_COLS), truth))
    params = ml.search_parameters(labelled, kind, trials, settings.search_seed, settings)[0] if trials else None
    model, meta = ml.train(labelled, kind, params, settings)
    io.save_artifact(model, settings.model_output_path, meta)
    return meta


def infer(spark: SparkSession, settings: Settings, names: tuple[str, str, str] = SOURCES["test"]) -> DataFrame:
    """Matches the test split with the saved model, writes the three files to ``output_dir`` and returns the decisions."""
    ship(spark)
    queries, targets = load(spark, settings.data_dir_test, names, settings, f"{settings.processed_data_dir}/test")
    model, meta = io.load_artifact(spark, settings.model_output_path, ml.FEATURE_COLS)
    decisions = written(match(queries, targets, model, meta["threshold"], settings).select("entity_id", "cand_id", "cycle", "seq", "accepted"))
    outputs.write_all(queries, decisions, settings.output_dir.rstrip("/"), files=True)
    return decisions


def main(arguments: list[str] | None = None) -> None:
    settings = Settings.load()
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--mode", choices=("train", "infer"), default=settings.pipeline_mode)
    parser.add_argument("--data", help="the folder of the split's tables")
    parser.add_argument("--trials", type=int, default=0, help="trials of the parameter search")
    parser.add_argument("--kind", choices=("monotone", "trees"), default="monotone")
    given = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("weftlink").getOrCreate()
    settings = replace(Settings.load(spark=spark), pipeline_mode=given.mode)
    if given.data:
        settings = replace(settings, **{"data_dir_train" if given.mode == "train" else "data_dir_test": given.data})
    if given.mode == "train":
        print(train(spark, settings, given.kind, given.trials))
    else:
        infer(spark, settings)


if __name__ == "__main__":
    main()
