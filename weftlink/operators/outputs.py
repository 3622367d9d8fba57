"""The three outputs: every entity has a row in each, whatever was found."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .state import FileWriteError, first_decisions, per_cycle


def _joined(ids: F.Column) -> F.Column:
    return F.array_join(F.array_sort(ids), ",")


def matching_results(entities: DataFrame, decisions: DataFrame) -> DataFrame:
    """entity_id, ids: accepted candidates, sorted and joined by commas."""
    kept = first_decisions(decisions).where("accepted").groupBy("entity_id").agg(_joined(F.collect_set("cand_id")).alias("ids"))
    return entities.select("entity_id").join(kept, "entity_id", "left").select("entity_id", F.coalesce("ids", F.lit("")).alias("ids"))


def candidate_pairs(entities: DataFrame, decisions: DataFrame) -> DataFrame:
    """entity_id, ids: all candidates, accepted or not."""
    kept = decisions.groupBy("entity_id").agg(_joined(F.collect_set("cand_id")).alias("ids"))
    return entities.select("entity_id").join(kept, "entity_id", "left").select("entity_id", F.coalesce("ids", F.lit("")).alias("ids"))


def candidate_pairs_per_cycle(entities: DataFrame, decisions: DataFrame) -> DataFrame:
    """entity_id, cycle, ids: a row for each cycle; one without cycle for entities that have none."""
    rows = per_cycle(decisions).select("entity_id", F.col("cycle").cast("string").alias("cycle"), _joined(F.col("cand_ids")).alias("ids"))
    return entities.select("entity_id").join(rows, "entity_id", "left").select("entity_id", F.coalesce("cycle", F.lit("")).alias("cycle"), F.coalesce("ids", F.lit("")).alias("ids"))


def write_tsv(df: DataFrame, path: str, order: list[F.Column], header: bool = False) -> None:
    """Tab-separated text without quotes, in order; one folder of part files that follow one another."""
    line = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])
    try:
        lines = df.orderBy(*order).select(line.alias("value"))
        if header:
            top = df.sparkSession.createDataFrame([("\t".join(df.columns),)], "value string")
            top.write.mode("overwrite").text(f"{path}/part=0")
            lines.write.mode("overwrite").text(f"{path}/part=1")
        else:
            lines.write.mode("overwrite").text(path)
    except Exception as e:
        raise FileWriteError(path) from e


def merge_parts(spark: SparkSession, folder: str) -> None:
    """The folder of ``write_tsv`` becomes one file of its name; the bytes stream through the driver."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source, target = jvm.org.apache.hadoop.fs.Path(folder), jvm.org.apache.hadoop.fs.Path(f"{folder}.merging")
    fs = source.getFileSystem(conf)
    out = fs.create(target, True)
    try:
        listed, parts = fs.listFiles(source, True), []
        while listed.hasNext():
            if (part := listed.next().getPath()).getName().startswith("part-"):
                parts.append(part)
        for part in sorted(parts, key=lambda p: p.toString()):
            read = fs.open(part)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(read, out, conf, False)
            finally:
                read.close()
    finally:
        out.close()
    fs.delete(source, True)
    fs.rename(target, source)


def write_all(entities: DataFrame, decisions: DataFrame, path: str, header: bool = False, files: bool = False) -> None:
    """The three outputs as folders of parts or, with ``files``, as the files of these names."""
    id, cycle = F.col("entity_id"), F.col("cycle").try_cast("int")
    write_tsv(matching_results(entities, decisions), f"{path}/matching_results.tsv", [id], header)
    write_tsv(candidate_pairs(entities, decisions), f"{path}/candidate_pairs.tsv", [id], header)
    write_tsv(candidate_pairs_per_cycle(entities, decisions), f"{path}/candidate_pairs_per_cycle.tsv", [id, cycle], header)
    for name in ("matching_results", "candidate_pairs", "candidate_pairs_per_cycle") if files else ():
        merge_parts(entities.sparkSession, f"{path}/{name}.tsv")
