"""Decisions as a stream: files of entities in, state batches out, each batch exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.state import append_state, completed_but, nested, pending


def process_entities(spark: SparkSession, source: str, schema: str, decide: Callable[[DataFrame], DataFrame], state: str, checkpoint: str) -> StreamingQuery:
    """Reads entity files (Parquet) as they come, decides on new entities and appends their state.

    ``decide`` maps entities to decisions (entity_id, cand_id, cycle, seq, accepted). A batch
    writes under its own number, so a repeated batch replaces itself with the same entities; those
    completed in other batches are left out. Of other batches only the ids are read.
    """

    def batch(entities: DataFrame, number: int) -> None:
        new = pending(entities.select("entity_id").distinct(), completed_but(entities.sparkSession, state, number))
        append_state(nested(new, decide(new)), state, number)

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
