"""Entities, pairs and decisions derived from the supplied tables, whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.entities import clean
from ..sources.scratch import written
from ..sources.shipping import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_entities(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """S1: suppliers; S2: customers; S3: parts. Each with key, entity_id, business_name, business_address, country."""
    t = lambda name: table(spark, sf_dir, name)
    nations = F.broadcast(t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name"))  # 25 rows
    country = F.concat(F.lit(" "), F.upper("n_name")).alias("country")
    id = lambda s, k: F.concat(F.lit(f"{s}-"), F.col(k).cast("string")).alias("entity_id")
    whole = lambda c: F.floor(c).cast("long").cast("string")
    s1 = t("supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("key"), id("S1", "s_suppkey"), F.col("s_name").alias("business_name"), F.concat_ws(" ", F.concat("r_name", F.lit(",")), "n_name", whole("s_acctbal")).alias("business_address"), country)
    s2 = t("customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("key"), id("S2", "c_custkey"), F.col("c_name").alias("business_name"), F.concat_ws(" ", "c_mktsegment", F.concat("r_name", F.lit(",")), "n_name", whole("c_acctbal")).alias("business_address"), country)
    s3 = t("part").join(nations, F.col("p_size") % 25 == F.col("n_nationkey")).select(F.col("p_partkey").alias("key"), id("S3", "p_partkey"), F.col("p_name").alias("business_name"), F.concat_ws(" ", F.concat("p_brand", F.lit(" &")), "p_type", F.col("p_size").cast("string")).alias("business_address"), country)
    return {"S1": s1, "S2": s2, "S3": s3}


def entities(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Clean queries (S1) and targets (S2 and S3) with ``pos``, written once: cleaning is not repeated by what reads them.

    Rows are dealt out to all cores first, however few files and row groups they come from.
    """
    made, cores = {}, spark.sparkContext.defaultParallelism
    for k, (source, raw) in enumerate(raw_entities(spark, sf_dir).items()):
        made[source] = clean(raw.repartition(cores, "entity_id"), source).withColumn("pos", F.substring_index("entity_id", "-", -1).cast("long") * 2 + k % 2)  # the key is in the id
    return written(made["S1"]), written(made["S2"].unionByName(made["S3"]))


def blocked_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, cand_id of all suppliers with the customers and parts of their country whose numbers end like theirs or like the next."""
    queries, targets = entities(spark, sf_dir)
    end = F.pmod(F.regexp_extract("entity_id", r"\d+$", 0).cast("long"), F.lit(100))
    a = queries.select("country", "entity_id", F.explode(F.array(end, (end + 1) % 100)).alias("end"))
    return a.join(targets.select("country", F.col("entity_id").alias("cand_id"), end.alias("end")), ["country", "end"]).select("entity_id", "cand_id")


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as decisions: user, key in props, month day, purchase or not, in order of event."""
    events = table(spark, sf_dir, "events")
    return events.select(F.col("user_id").cast("string").alias("entity_id"), F.get_json_object("props", "$.k").alias("cand_id"), F.dayofmonth("ts").alias("cycle"), F.col("event_id").alias("seq"), (F.col("event_type") == "purchase").alias("accepted"))


def scored_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as scored pairs: source, id, quality and a probability made from the length."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return labels.join(docs, "doc_id").select(F.col("source").alias("entity_id"), F.col("doc_id").cast("string").alias("cand_id"), F.col("quality").alias("label"), ((F.col("n_chars") % 100) / 100.0).alias("prob"), F.col("lang").alias("country"), (F.col("doc_id") % 5).cast("int").alias("fold"))


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, matched_entity_ids: customers and parts of a supplier's country whose numbers end alike."""
    raw = raw_entities(spark, sf_dir)
    a = raw["S1"].select("country", "entity_id", (F.col("key") % 100).alias("end"))
    b = raw["S2"].unionByName(raw["S3"]).select("country", F.col("entity_id").alias("cand"), (F.col("key") % 100).alias("end"))
    found = a.join(b, ["country", "end"]).groupBy("entity_id").agg(F.array_join(F.array_sort(F.collect_list("cand")), ",").alias("matched_entity_ids"))
    return a.select("entity_id").join(found, "entity_id", "left").select("entity_id", F.coalesce("matched_entity_ids", F.lit("")).alias("matched_entity_ids"))
