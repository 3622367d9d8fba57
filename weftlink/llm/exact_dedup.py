"""Exact deduplication with counting quotient filters.

Every partition builds a filter of its 64-bit fingerprints for each range of quotients. Filters
merge without loss by their sorted remainders; fingerprints whose count exceeds one send their
documents to a comparison of the bytes.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, attach, keep_rows, small, table, tidy

#: Fingerprints held by the merged filter of one range, on average.
RANGE_FINGERPRINTS = 250_000
#: Fingerprints a task gathers before it writes out its filters.
FLUSH = 2_000_000
#: Repeated fingerprints up to this many (16 bytes each) are broadcast, more are shuffled.
BROADCAST_FINGERPRINTS = 1_000_000


class CountingQuotientFilter:
    """A multiset of ``bits``-bit fingerprints: quotient, sorted remainder and count.

    The first ``qbits`` of a fingerprint name its run; a run holds its remainders in ascending
    order, each with its count. Runs lie in quotient order, their lengths in unary, so the
    filter is as small as its remainders and nothing is lost, in building or merging.
    """

    def __init__(self, bits: int, qbits: int, runs: np.ndarray, remainders: np.ndarray, counts: np.ndarray):
        self.bits, self.qbits, self.runs, self.remainders, self.counts = bits, qbits, runs, remainders, counts

    @classmethod
    def build(cls, fingerprints: np.ndarray, bits: int, counts: np.ndarray | None = None) -> CountingQuotientFilter:
        """Of unsorted fingerprints below ``2 ** bits``; ``counts`` if they have some already."""
        order = np.argsort(fingerprints, kind="stable")
        ordered = fingerprints[order].astype(np.uint64)
        each = np.ones(len(ordered), np.int64) if counts is None else counts[order].astype(np.int64)
        first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.empty(0, np.int64)
        each = np.add.reduceat(each, first) if len(first) else each
        ordered = ordered[first]
        qbits = min(bits - 1, max(1, int(len(ordered)).bit_length()))
        rbits = bits - qbits
        runs = np.bincount((ordered >> np.uint64(rbits)).astype(np.int64), minlength=1 << qbits)
        return cls(bits, qbits, runs, ordered & np.uint64((1 << rbits) - 1), each)

    def fingerprints(self) -> np.ndarray:
        quotients = np.repeat(np.arange(len(self.runs), dtype=np.uint64), self.runs)
        return (quotients << np.uint64(self.bits - self.qbits)) | self.remainders

    def merge(self, *others: CountingQuotientFilter) -> CountingQuotientFilter:
        """All filters in one: their remainders are sorted, so a merge sort joins equal ones."""
        every = (self, *others)
        return self.build(np.concatenate([x.fingerprints() for x in every]), self.bits, np.concatenate([x.counts for x in every]))

    def repeated(self) -> tuple[np.ndarray, np.ndarray]:
        many = self.counts > 1
        return self.fingerprints()[many], self.counts[many]

    def to_bytes(self) -> bytes:
        ends = np.ones(len(self.remainders) + len(self.runs), np.uint8)  # a run in unary: ones, then a zero
        ends[np.cumsum(self.runs + 1) - 1] = 0
        wide = -(-(self.bits - self.qbits) // 8)
        body = self.remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide].tobytes()
        many = np.flatnonzero(self.counts > 1).astype("<u4")
        head = struct.pack("<BBII", self.bits, self.qbits, len(self.remainders), len(many))
        return head + np.packbits(ends).tobytes() + body + many.tobytes() + self.counts[many].astype("<u8").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CountingQuotientFilter:
        bits, qbits, n, m = struct.unpack_from("<BBII", data)
        at = struct.calcsize("<BBII")
        size = (n + (1 << qbits) + 7) // 8
        ends = np.unpackbits(np.frombuffer(data, np.uint8, size, at))[: n + (1 << qbits)]
        runs = np.diff(np.r_[-1, np.flatnonzero(ends == 0)]) - 1
        wide = -(-(bits - qbits) // 8)
        full = np.zeros((n, 8), np.uint8)
        full[:, :wide] = np.frombuffer(data, np.uint8, n * wide, at + size).reshape(n, wide)
        at += size + n * wide
        counts = np.ones(n, np.int64)
        counts[np.frombuffer(data, "<u4", m, at)] = np.frombuffer(data, "<u8", m, at + 4 * m)
        return cls(bits, qbits, runs, full.view("<u8").ravel(), counts)


def repeated_fingerprints(rows: DataFrame, column: str, n_rows: int) -> DataFrame:
    """fp, n of every value of the long column that occurs more than once in ``rows``."""
    top = max(6, math.ceil(math.log2(max(1, n_rows / RANGE_FINGERPRINTS))))  # 2 ** top ranges of quotients
    bits = 64 - top

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def filters(parts: list[np.ndarray]) -> pd.DataFrame:
            fps = np.concatenate(parts)
            at = (fps >> np.uint64(bits)).astype(np.int64)
            order = np.argsort(at, kind="stable")
            cuts = np.searchsorted(at[order], np.arange((1 << top) + 1))
            own = [(k, CountingQuotientFilter.build(fps[order[a:b]] & np.uint64((1 << bits) - 1), bits).to_bytes()) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
            return pd.DataFrame(own, columns=["range", "filter"])

        held: list[np.ndarray] = []
        for batch in batches:
            held.append(batch[column].to_numpy(np.int64).view(np.uint64))
            if sum(map(len, held)) >= FLUSH:
                yield filters(held)
                held = []
        if sum(map(len, held)):
            yield filters(held)

    def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        one, *more = map(CountingQuotientFilter.from_bytes, group["filter"])
        fps, counts = one.merge(*more).repeated()
        return pd.DataFrame({"fp": (fps | np.uint64(int(key[0]) << bits)).view(np.int64), "n": counts})

    filters = rows.select(column).mapInPandas(tidy(build), "range int, filter binary")
    return filters.groupBy("range").applyInPandas(merge, "fp long, n long")


def group_copies(docs: DataFrame, text: str = "text", id: str = "doc_id", scratch: Scratch | None = None) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256, and a row number ``row``.

    Texts are equal if their bytes are; null counts as empty. The row with the largest id stays
    (a null id is below all others); of rows that agree in id and text, the last read stays, so
    that each group keeps exactly one row. An empty table gives no rows.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = scratch.keep(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id).alias(id), F.xxhash64(whole).alias("fp"), F.sha2(whole, 256).alias("text_sha256")), "rows")
    n_rows = rows.count()
    repeated = scratch.keep(repeated_fingerprints(rows, "fp", n_rows), "repeated")
    listed = small(repeated.select("fp"), BROADCAST_FINGERPRINTS)

    # The bytes decide: grouping by the text compares it whole, and copies in one task meet before the shuffle.
    same = docs.select(F.xxhash64(whole).alias("fp"), whole.alias("__text")).join(listed, "fp", "left_semi").groupBy("fp", "__text").agg(F.count("*").alias("group_size"))
    same = same.where("group_size > 1").select(F.sha2("__text", 256).alias("text_sha256"), "group_size")
    stays = rows.join(listed, "fp", "left_semi").groupBy("text_sha256").agg(F.max(F.struct(id, "row")).alias("__stays"))
    groups = scratch.keep(same.join(stays, "text_sha256"), "groups")

    scratch.only("rows", "groups")
    every = attach(rows, groups, "text_sha256", "group_size", n_rows, "row")
    alone = F.col("group_size").isNull()
    return every.select(
        "row", F.col(id),
        F.when(alone, F.col(id)).otherwise(F.col(f"__stays.{id}")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("__stays.row"))).alias("kept"),
        "text_sha256",
    )


def deduplicate(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``docs`` without the rows that an equal text with a larger id makes redundant; all columns stay."""
    scratch = Scratch(docs.sparkSession)
    judged = scratch.keep(group_copies(docs, text, id, scratch).where("group_size > 1").select(F.col(id).alias("__id"), F.col("text_sha256").alias("__sha"), "kept"), "judged")
    scratch.only("judged")
    return keep_rows(docs, judged, text, id)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of equal texts; see ``group_copies`` for odd rows."""
    return group_copies(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
