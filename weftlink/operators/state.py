"""What each entity has seen: decisions as rows, and their nested form in JSON lines."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.scratch import exists, written

_IDS = ".ids"
STATE = "map<string,struct<accepted:array<string>,rejected:array<string>,per_cycle:map<string,array<string>>>>"


def first_decisions(decisions: DataFrame) -> DataFrame:
    """Of repeated (entity_id, cand_id) the row of the smallest seq."""
    order = Window.partitionBy("entity_id", "cand_id").orderBy("seq")
    return decisions.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def seen_sets(decisions: DataFrame) -> DataFrame:
    """entity_id, accepted, rejected: sorted ids of the first decisions."""
    sets = {"accepted": F.col("accepted"), "rejected": ~F.col("accepted")}
    return first_decisions(decisions).groupBy("entity_id").agg(*[F.array_sort(F.collect_set(F.when(c, F.col("cand_id")))).alias(n) for n, c in sets.items()])


def per_cycle(decisions: DataFrame) -> DataFrame:
    """entity_id, cycle, cand_ids in order of decision."""
    listed = F.array_sort(F.collect_list(F.struct("seq", "cand_id")))
    return first_decisions(decisions).groupBy("entity_id", "cycle").agg(F.transform(listed, lambda x: x["cand_id"]).alias("cand_ids"))


def nested(entities: DataFrame, decisions: DataFrame) -> DataFrame:
    """entity_id, accepted, rejected, per_cycle (map of the cycle's number) of every entity, empty where nothing was decided."""
    cycles = per_cycle(decisions).groupBy("entity_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("cycle").cast("string").alias("cycle"), "cand_ids")))).alias("per_cycle"))
    joined = entities.select("entity_id").distinct().join(seen_sets(decisions), "entity_id", "left").join(cycles, "entity_id", "left")
    none = F.array().cast("array<string>")
    return joined.select("entity_id", F.coalesce("accepted", none).alias("accepted"), F.coalesce("rejected", none).alias("rejected"), F.coalesce("per_cycle", F.map_from_arrays(none, F.array().cast("array<array<string>>"))).alias("per_cycle"))


def append_state(state: DataFrame, path: str, batch: int | str) -> None:
    """Writes a batch of ``nested`` rows as JSON lines, and their ids beside; a batch that is written again replaces itself.

    The lines come last: ids alone do not complete an entity, as the batch is then written again.
    """
    rows = written(state)
    rows.select("entity_id").write.mode("overwrite").parquet(f"{path}{_IDS}/batch={batch}")
    line = F.to_json(F.create_map("entity_id", F.struct("accepted", "rejected", "per_cycle")))
    rows.select(line.alias("value")).write.mode("overwrite").text(f"{path}/batch={batch}")


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """``nested`` rows of all batches; blank and malformed lines are skipped."""
    lines = spark.read.text(path, recursiveFileLookup=True).where("trim(value) <> ''")
    parsed = lines.select(F.from_json("value", STATE).alias("m")).where("m is not null and size(m) > 0")
    return parsed.select(F.explode("m").alias("entity_id", "s")).where("s is not null").select("entity_id", "s.*")


def completed(spark: SparkSession, path: str) -> DataFrame:
    return read_state(spark, path).select("entity_id").distinct()


def completed_but(spark: SparkSession, path: str, batch: int | str) -> DataFrame:
    """entity_id of all batches but this one. A state without ids beside it is read once, to write them."""
    if not exists(spark, f"{path}{_IDS}"):
        if not exists(spark, path):
            return spark.createDataFrame([], "entity_id string")
        mine = F.col("_metadata.file_path").contains(f"/batch={batch}/")
        lines = spark.read.text(path, recursiveFileLookup=True).where(~mine).where("trim(value) <> ''")
        found = lines.select(F.explode(F.from_json("value", STATE)).alias("entity_id", "s")).where("s is not null")
        found.select("entity_id").distinct().write.parquet(f"{path}{_IDS}/batch=before")
    ids = spark.read.schema("entity_id string, batch string").parquet(f"{path}{_IDS}")
    return ids.where(F.col("batch") != str(batch)).select("entity_id").distinct()


def pending(entities: DataFrame, done: DataFrame) -> DataFrame:
    """Entities that are not completed yet."""
    return entities.join(done.select("entity_id"), "entity_id", "left_anti")


def from_nested(state: DataFrame) -> DataFrame:
    """Decision rows (entity_id, cand_id, cycle, seq, accepted) of ``nested`` rows."""
    each = state.select("entity_id", "accepted", F.explode("per_cycle").alias("cycle", "ids")).select("entity_id", "accepted", F.col("cycle").cast("int").alias("cycle"), F.posexplode("ids").alias("seq", "cand_id"))
    return each.select("entity_id", "cand_id", "cycle", (F.col("cycle") * 1_000_000 + F.col("seq")).cast("long").alias("seq"), F.array_contains("accepted", F.col("cand_id")).alias("accepted"))


class AlreadyActiveError(RuntimeError):
    """The entity has begun."""


class AlreadyFinalizedError(RuntimeError):
    """The entity has ended."""


class FileWriteError(OSError):
    """State or outputs cannot be written."""


class SeenState:
    """The same state machine on plain values, for one process: what a small or interactive run needs.

    Ended entities are held until ``batch_size`` of them are written together.
    """

    def __init__(self, run_dir: str | None = None, batch_size: int = 10_000):
        if run_dir is not None and not isinstance(run_dir, str):
            raise TypeError("run_dir is no string")
        self.path = Path(run_dir or ".") / "seen_state.jsonl"
        self.batch_size = batch_size
        self.active: dict[str, list[tuple[str, int, bool]]] = {}
        self.waiting: list[str] = []
        self.done: set[str] = {key for one in self._lines() for key in one}

    def _lines(self) -> list[dict]:
        found = []
        for line in self.path.read_text().splitlines() if self.path.exists() else ():
            try:
                found.append(json.loads(line))
            except ValueError:
                continue
        return [x for x in found if isinstance(x, dict)]

    @staticmethod
    def _typed(**values: tuple) -> None:
        for name, (value, kind) in values.items():
            if not isinstance(value, kind):
                raise TypeError(f"{name} is no {kind.__name__}")

    def _open(self, entity_id: str) -> list:
        self._typed(entity_id=(entity_id, str))
        if entity_id in self.done:
            raise AlreadyFinalizedError(entity_id)
        return self.active.setdefault(entity_id, [])

    def init_entity(self, entity_id: str) -> None:
        if entity_id in self.active:
            raise AlreadyActiveError(entity_id)
        self._open(entity_id)

    def update_seen(self, entity_id: str, cand_id: str, cycle: int, accepted: bool) -> None:
        self._typed(entity_id=(entity_id, str), cand_id=(cand_id, str), cycle=(cycle, int), accepted=(accepted, bool))
        own = self._open(entity_id)
        if all(c != cand_id for c, _, _ in own):
            own.append((cand_id, cycle, accepted))

    def has_been_seen(self, entity_id: str, cand_id: str) -> bool:
        self._typed(entity_id=(entity_id, str), cand_id=(cand_id, str))
        return any(c == cand_id for c, _, _ in self.active.get(entity_id, ()))

    def finalize_entity(self, entity_id: str) -> None:
        own = self._open(entity_id)
        del self.active[entity_id]
        self.done.add(entity_id)
        cycles: dict[str, list[str]] = {}
        for cand, cycle, _ in own:
            cycles.setdefault(str(cycle), []).append(cand)
        split = {name: sorted(c for c, _, a in own if a is flag) for name, flag in (("accepted", True), ("rejected", False))}
        self.waiting.append(json.dumps({entity_id: split | {"per_cycle": cycles}}))
        if len(self.waiting) >= self.batch_size:
            self.flush()

    def flush(self) -> None:
        if not self.waiting:
            return
        try:
            self.path.parent.mkdir(parents=True, exist_ok=True)
            with self.path.open("a") as f:
                f.write("".join(f"{line}\n" for line in self.waiting))
        except OSError as e:
            raise FileWriteError(str(self.path)) from e
        self.waiting = []

    def write_all_outputs(self, out_dir: str) -> None:
        """The three outputs of all ended entities; empty files if there are none."""
        self.flush()
        rows: dict[str, list[str]] = {"matching_results": [], "candidate_pairs": [], "candidate_pairs_per_cycle": []}
        for one in self._lines():
            for key, s in one.items():
                rows["matching_results"].append(f"{key}\t{','.join(sorted(s['accepted']))}")
                rows["candidate_pairs"].append(f"{key}\t{','.join(sorted({*s['accepted'], *s['rejected']}))}")
                cycles = sorted(s["per_cycle"], key=int)
                rows["candidate_pairs_per_cycle"] += [f"{key}\t{c}\t{','.join(sorted(s['per_cycle'][c]))}" for c in cycles] or [f"{key}\t\t"]
        try:
            Path(out_dir).mkdir(parents=True, exist_ok=True)
            for name, lines in rows.items():
                (Path(out_dir) / f"{name}.tsv").write_text("".join(f"{x}\n" for x in lines))
        except OSError as e:
            raise FileWriteError(out_dir) from e
