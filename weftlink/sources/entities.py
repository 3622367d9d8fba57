"""Readers and writers of entity tables, ground truth and model artifacts."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Settings
from ..functions import text as X

DEFAULTS = Settings()
RAW = T.StructType([T.StructField(c, T.StringType()) for c in ("entity_id", "business_name", "business_address", "country")])
TRUTH = T.StructType([T.StructField(c, T.StringType()) for c in ("source1_entity_id", "matched_entity_ids")])


class InvalidFileFormatError(ValueError):
    """The file is missing or not a table of the expected columns."""


class PartitioningError(ValueError):
    """Rows without a country cannot be placed."""


def _tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        header = spark.read.csv(path, sep="\t", header=True, quote="", inferSchema=False).columns
    except Exception as e:
        raise InvalidFileFormatError(f"cannot read {path}") from e
    if header != schema.names:
        raise InvalidFileFormatError(f"{path} has columns {header}, not {schema.names}")
    return spark.read.schema(schema).csv(path, sep="\t", header=True, quote="", mode="FAILFAST")


def read_entities(spark: SparkSession, path: str, settings: Settings = DEFAULTS) -> DataFrame:
    """Tab-separated raw entities; nulls and words that mean null are empty."""
    raw = _tsv(spark, path, RAW)
    return raw.select("entity_id", *[X.repair_null(F.col(c), settings.null_literals).alias(c) for c in RAW.names[1:]])


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """entity_id, cand_id: one row for each true match."""
    return explode_truth(_tsv(spark, path, TRUTH).withColumnsRenamed({"source1_entity_id": "entity_id"}))


def explode_truth(truth: DataFrame, ids: str = "matched_entity_ids") -> DataFrame:
    each = truth.select("entity_id", F.explode(F.split(F.coalesce(F.col(ids), F.lit("")), ",")).alias("cand_id"))
    return each.withColumn("cand_id", F.trim("cand_id")).where("cand_id <> ''").distinct()


def clean(raw: DataFrame, source: str, settings: Settings = DEFAULTS) -> DataFrame:
    """The clean entity table of one source: nine columns, no nulls, sentinels for empty texts."""
    name, addr = F.col("business_name"), F.col("business_address")
    full = raw.select(
        "entity_id",
        X.normalise_country(F.col("country")).alias("country"),
        F.lit(source).alias("source"),
        F.coalesce(name, F.lit("")).alias("name_original"),
        F.coalesce(addr, F.lit("")).alias("addr_original"),
        X.name_for_vectors(name).alias("name_for_vectors"),
        X.clean_name(name, settings).alias("name_for_bm25"),
        X.clean_address(addr, settings).alias("addr_for_bm25"),
        X.is_cross_script(name).alias("is_cross_script"),
    )
    id = F.col("entity_id")
    return full.withColumns(
        {
            "name_for_vectors": X.with_sentinel(F.col("name_for_vectors"), id, settings.nullname_prefix),
            "name_for_bm25": X.with_sentinel(F.col("name_for_bm25"), id, settings.nullname_prefix),
            "addr_for_bm25": X.with_sentinel(F.col("addr_for_bm25"), id, settings.nulladdr_prefix),
        }
    )


def union_targets(*targets: DataFrame) -> DataFrame:
    """All target sources, one below the other."""
    return reduce(DataFrame.unionByName, targets)


def write_partitions(queries: DataFrame, targets: DataFrame, path: str, settings: Settings = DEFAULTS) -> None:
    """Clean rows by role and country. PartitioningError if a country is null or blank; no row is lost."""
    both = queries.withColumn("role", F.lit("Query")).unionByName(targets.withColumn("role", F.lit("Target")))
    if both.where(F.trim(F.coalesce("country", F.lit(""))) == "").limit(1).count():
        raise PartitioningError("rows without a country")
    both.repartition("role", "country").write.mode("overwrite").partitionBy("role", "country").option("compression", settings.parquet_compression).parquet(path)


def read_partitions(spark: SparkSession, path: str, role: str) -> DataFrame:
    """One role, all countries; filters on country prune partitions."""
    return spark.read.option("basePath", path).parquet(path).where(F.col("role") == role).drop("role")


def discover_countries(queries: DataFrame) -> DataFrame:
    return queries.select("country").distinct().orderBy("country")


def missing_targets(queries: DataFrame, targets: DataFrame) -> DataFrame:
    """Countries of queries without any target: legal, their entities stay single."""
    return discover_countries(queries).join(targets.select("country").distinct(), "country", "left_anti")


class MissingTargetError(FileNotFoundError):
    """A country of queries has no targets."""


class RowCountError(RuntimeError):
    """Cleaning or writing lost or made rows."""


def check_targets(queries: DataFrame, targets: DataFrame) -> None:
    """MissingTargetError if a country has queries but no target."""
    if gone := [r["country"] for r in missing_targets(queries, targets).limit(20).collect()]:
        raise MissingTargetError(f"no targets for {', '.join(gone)}")


def check_rows(before: DataFrame, after: DataFrame, what: str) -> None:
    """RowCountError unless both have as many rows."""
    if (a := before.count()) != (b := after.count()):
        raise RowCountError(f"{what}: {a} rows became {b}")


def save_artifact(model, path: str, meta: dict) -> None:
    """A fitted pipeline and its threshold, parameters and feature names."""
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(meta, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def load_artifact(spark: SparkSession, path: str, features: list[str]):
    """The pipeline and its facts; RuntimeError if it was fitted on other columns."""
    from pyspark.ml import PipelineModel

    meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
    if meta["feature_names"] != features:
        odd = [(a, b) for a, b in zip(meta["feature_names"], features, strict=False) if a != b]
        raise RuntimeError(f"feature columns differ: {odd or (len(meta['feature_names']), len(features))}")
    return PipelineModel.load(f"{path}/model"), meta
