"""Best-fit packing of tokenized documents into sequences of a fixed capacity.

Packing goes in bulk-synchronous rounds over written tables. A round takes the longest documents
left, down to a share of the longest, and range-sorts them together with the gaps of all open
sequences. Every range is swept from large to small: a document takes its successor, the smallest
gap seen that is still free, so documents that want the same gap are told apart by their rank.
What a range leaves over meets the leftovers of the ranges above it, again in order of rank; the
driver only holds how many each range left. Then gaps shrink, and the next round begins.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, table, tidy
from .tokens import Encoder

CAPACITY = 2048
END_ID = 0
#: A round takes documents longer than this share of the longest one left.
SHARE = 0.5
#: Documents of one round that a gap can take at most.
SLOTS = 64


def tokenize_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, text: str = "text", id: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Per piece: row (a number of its own), id, piece, start, length, ids_crc32."""
    kind = dict(docs.dtypes)[id]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, row = Encoder.of(tokenizer), TaskContext.get().partitionId() << 40
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for a in range(0, len(batch), 500):
                part = batch.iloc[a : a + 500]
                rows = []
                for key, ids in zip(part[id], encoder.encode(part[text].fillna("").tolist()), strict=True):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        piece = ids[at : at + 4 * capacity]
                        rows.append((row, None if key is pd.NA or key != key else key, k, at // 4, len(piece) // 4, zlib.crc32(piece)) + ((piece,) if with_ids else ()))
                        row += 1
                yield pd.DataFrame(rows, columns=names)
        encoder.forget()

    names = ["row", id, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    schema = f"row long, `{id}` string, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    # Nullable integers would turn into floats in pandas: null ids go through as decimal strings.
    cast = docs.select(F.col(id).cast("string").alias(id), F.col(text).alias(text))
    out = cast.mapInPandas(tidy(run), schema)
    return out.withColumn(id, F.col(id).cast(kind))


_DOC, _GAP, _MATCH = 0, 1, 2
_SWEPT = "kind byte, part int, rank long, row long, length long, sequence_id long, free long"


def _sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of a range in order, gaps before documents of their size: matches, then documents and gaps left, by rank."""
    part = TaskContext.get().partitionId()
    stack: list[tuple[int, int]] = []  # gaps seen and still free, the smallest on top
    left: list[tuple[int, int]] = []
    for batch in batches:
        met = []
        for key, size, free in zip(batch["id"].tolist(), batch["size"].tolist(), batch["free"].tolist(), strict=True):
            if free:
                stack.append((key, free))
            elif stack:
                met.append((key, size, *stack.pop()))
            else:
                left.append((key, size))
        yield _swept(_MATCH, part, met)
    yield _swept(_DOC, part, [(*x, 0, 0) for x in left])
    yield _swept(_GAP, part, [(0, 0, *x) for x in stack])


def _swept(kind: int, part: int, rows: list[tuple[int, int, int, int]]) -> pd.DataFrame:
    x = np.array(rows, np.int64).reshape(-1, 4)
    return pd.DataFrame({"kind": np.int8(kind), "part": np.int32(part), "rank": np.arange(len(x)), "row": x[:, 0], "length": x[:, 1], "sequence_id": x[:, 2], "free": x[:, 3]})


def match_leftovers(counts: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Which leftover documents take which leftover gaps, from (range, documents, gaps) in order of the ranges.

    Rows (range, first rank, how many, range of the gaps, rank of the first of them): the documents
    with these ranks take gaps one by one, from that rank downwards. Each takes the smallest gap
    that a range above has left; at most two rows arise from a range.
    """
    stack: list[list[int]] = []  # range, gaps left
    runs = []
    for part, docs, gaps in counts:
        rank = 0
        while rank < docs and stack:
            above, have = stack[-1]
            many = min(docs - rank, have)
            runs.append((part, rank, many, above, have - 1))
            rank += many
            if many == have:
                stack.pop()
            else:
                stack[-1][1] -= many
        if gaps:
            stack.append([part, gaps])
    return runs


def place(pieces: DataFrame, capacity: int, scratch: Scratch, share: float = SHARE, slots: int = SLOTS) -> DataFrame:
    """row, sequence_id and offset of every one of ``pieces`` (row, length)."""
    spark = pieces.sparkSession
    whole = pieces.where(F.col("length") == capacity).select("row", (F.col("row") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    docs = pieces.where(F.col("length") < capacity).select("row", "length")
    placed: list[DataFrame] = [whole]
    longest, total = docs.agg(F.max("length"), F.sum("length")).first()
    gaps, opened, largest, k = None, 0, 0, 0

    def open_(many: int) -> DataFrame:
        return spark.range(opened, opened + many).select((F.col("id") * 2).alias("sequence_id"), F.lit(capacity).cast("long").alias("free"))

    while longest:
        k += 1
        least = int(longest * share) + 1
        if gaps is None:  # no packing can do with fewer
            many = -(-total // capacity)
            gaps, opened, largest = open_(many), many, capacity
        elif longest > largest:
            many = -(-docs.where(F.col("length") > max(largest, least - 1)).count() // (capacity // longest))
            gaps, opened = gaps.unionByName(open_(many)), opened + many
        # A gap takes several documents of a round: each slot of it is what the longest ones before would leave.
        size = F.greatest(F.lit(1), F.least(F.lit(slots), F.floor(F.col("free") / longest))).cast("int")
        slotted = gaps.where(F.col("free") >= least).select("sequence_id", "free", F.posexplode(F.array_repeat(F.lit(longest), size)).alias("slot", "step"))
        rows = slotted.select(F.col("sequence_id").alias("id"), (F.col("free") - F.col("slot") * F.col("step")).alias("size"), "free")
        rows = rows.unionByName(docs.where(F.col("length") >= least).select(F.col("row").alias("id"), F.col("length").alias("size"), F.lit(0).cast("long").alias("free")))
        order = [F.desc("size"), F.col("free") == 0, F.xxhash64("id"), F.col("free"), F.col("id")]
        swept = scratch.keep(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(tidy(_sweep), _SWEPT), f"swept{k}")

        counts = swept.groupBy("part").agg(F.count_if(F.col("kind") == _DOC).alias("docs"), F.count_if(F.col("kind") == _GAP).alias("gaps")).collect()  # a row for each range
        runs = spark.createDataFrame(match_leftovers(sorted(tuple(r) for r in counts)), "part int, first long, many long, above int, top long")
        mine = (F.col("part") == F.col("__part")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("many"))
        asked = swept.where(F.col("kind") == _DOC).select("row", "length", "part", "rank").join(F.broadcast(runs.withColumnRenamed("part", "__part")), mine, "left")
        asked = asked.select("row", "length", "above", (F.col("top") - F.col("rank") + F.col("first")).alias("at"))
        free = swept.where(F.col("kind") == _GAP).select(F.col("part").alias("above"), F.col("rank").alias("at"), "sequence_id", "free")
        across = asked.where("above is not null").join(free, ["above", "at"])
        met = swept.where(F.col("kind") == _MATCH).unionByName(across, allowMissingColumns=True)
        before = F.coalesce(F.sum("length").over(Window.partitionBy("sequence_id").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        done = scratch.keep(met.select("row", "length", "sequence_id", (F.lit(capacity) - F.col("free") + before).alias("offset")), f"placed{k}")
        placed.append(done.select("row", "sequence_id", "offset"))

        used = done.groupBy("sequence_id").agg(F.sum("length").alias("used"))
        most, rest = Observation(), Observation()  # seen while the tables are written
        gaps = gaps.join(used, "sequence_id", "left").select("sequence_id", (F.col("free") - F.coalesce("used", F.lit(0))).alias("free")).where("free > 0")
        gaps = scratch.keep(gaps.observe(most, F.max("free").alias("free")), f"gaps{k}")
        docs = docs.where(F.col("length") < least).unionByName(asked.where("above is null").select("row", "length"))
        docs = scratch.keep(docs.observe(rest, F.max("length").alias("length")), f"docs{k}")
        largest, longest = most.get["free"] or 0, rest.get["length"]
        scratch.drop(f"swept{k}", *[f"{name}{k - 1}" for name in ("gaps", "docs") if k > 1])

    out = placed[0]
    for one in placed[1:]:
        out = out.unionByName(one)
    return out


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, text: str = "text", id: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """One row per piece of every document: id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and ``end_id``; a null text is empty, so its one piece is the end id.
    Documents longer than ``capacity`` are cut into pieces of it, the last may be shorter; no
    other is cut. Repeated rows are packed one by one. Sequences are filled from 0 without gaps
    and never beyond ``capacity``. An empty table gives no rows. ``with_ids`` adds the ids of
    each piece as little-endian unsigned 32-bit integers.
    """
    scratch = Scratch(docs.sparkSession)
    pieces = scratch.keep(tokenize_pieces(docs, tokenizer, capacity, end_id, text, id, with_ids), "pieces")
    placed = scratch.keep(place(pieces, capacity, scratch), "placed")
    scratch.only("pieces", "placed")
    return pieces.join(placed, "row").drop("row")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places; see ``pack`` for null, empty and repeated rows and empty tables."""
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
