"""K-d tree sharding: leaves of near equal bytes over document metadata.

The space of documents is split again and again, along its widest metadata dimension, at the
weighted median found by distributed histograms, until a leaf holds the bytes of one shard.
Equal texts are one point, so they share a shard unless they alone exceed it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, attach, small, table

SHARDS = 8
#: A group of equal texts beyond this share of a shard is placed first, by size: at most shards / share of them.
HEAVY_SHARE = 1 / 64
#: A split may miss its share by this part of a shard.
TOLERANCE = 1 / 2000
#: Bins of a node's histogram: each pass narrows a split by this factor.
BINS = 4096
#: Rows numbered by one task at a time.
NUMBERED = 20_000
_DIMENSIONS = ("d_lang", "d_source", "d_size")


@dataclass
class Node:
    """Leaves ``first`` to ``last - 1`` below it; inner nodes send keys up to ``cut`` of ``dimension`` left."""

    first: int
    last: int
    weight: int = 0
    dimension: int = -1
    cut: int = 0
    left: int = -1
    right: int = -1


def _keys(columns: list[pd.Series]) -> np.ndarray:
    """Per dimension the value, then the group's hash: a total order, so any share can be cut off."""
    *dims, tie = (c.to_numpy(np.int64) for c in columns)
    return np.stack([(d << 32) | tie for d in dims])


def _descend(tree: list[Node], keys: np.ndarray) -> np.ndarray:
    at = np.zeros(keys.shape[1], np.int64)
    dimension, cut, left, right = (np.array([getattr(n, k) for n in tree], np.int64) for k in ("dimension", "cut", "left", "right"))
    while (inner := dimension[at] >= 0).any():
        rows = np.flatnonzero(inner)
        own = at[rows]
        at[rows] = np.where(keys[dimension[own], rows] <= cut[own], left[own], right[own])
    return at


def _leaf_of(tree: list[Node]):
    """A UDF of the dimensions and the tie: the node they fall to."""

    def find(*c: pd.Series) -> pd.Series:
        return pd.Series(_descend(tree, _keys(list(c))))

    return F.pandas_udf(find, "long")


def _bin_of(ask: dict[int, tuple[int, int, int]]):
    """A UDF of the node, the dimensions and the tie: the bin of a node's window (dimension, lo, hi], or -1."""

    def find(node: pd.Series, *c: pd.Series) -> pd.Series:
        keys, at, out = _keys(list(c)), node.to_numpy(np.int64), np.full(len(node), -1, np.int64)
        for k, (d, lo, hi) in ask.items():
            rows = np.flatnonzero((at == k) & (keys[d] > lo) & (keys[d] <= hi))
            out[rows] = (keys[d][rows] - lo - 1) // -(-(hi - lo) // BINS)
        return pd.Series(out)

    return F.pandas_udf(find, "long")


def grow_tree(points: DataFrame, capacity: list[float], tolerance: float) -> list[Node]:
    """The tree over ``points`` (d_lang, d_source, d_size, tie, bytes), a leaf for each capacity.

    A split cuts off the share of its node that the capacities of the leaves on its left have.
    The driver holds a histogram of BINS sums for each node of a level, never points.
    """
    columns = [*_DIMENSIONS, "tie"]
    tree = [Node(0, len(capacity))]
    level = [0]
    while level := [k for k in level if tree[k].last - tree[k].first > 1]:
        node = _leaf_of([Node(**vars(n)) for n in tree])(*columns)
        placed = points.withColumn("node", node)
        key = lambda d: F.shiftleft(F.col(_DIMENSIONS[d]), 32).bitwiseOR(F.col("tie"))
        ranges = {r["node"]: r for r in placed.groupBy("node").agg(F.sum("bytes").alias("w"), *[f(key(d)).alias(f"{n}{d}") for d in range(len(_DIMENSIONS)) for n, f in (("lo", F.min), ("hi", F.max))]).collect()}
        goal: dict[int, float] = {}
        window: dict[int, tuple[int, int]] = {}
        below: dict[int, float] = {}
        for k in level:
            n = tree[k]
            half = n.first + (n.last - n.first) // 2
            r = ranges.get(k)
            spans = [(r[f"hi{d}"] >> 32) - (r[f"lo{d}"] >> 32) if r else 0 for d in range(len(_DIMENSIONS))]
            n.dimension = int(np.argmax(spans))  # the widest
            n.left, n.right = len(tree), len(tree) + 1
            tree += [Node(n.first, half), Node(half, n.last)]
            total = sum(capacity[n.first : n.last])
            goal[k] = (r["w"] if r else 0) * (sum(capacity[n.first : half]) / total if total > 0 else 0.5)
            if r:
                window[k], below[k] = (r[f"lo{n.dimension}"] - 1, r[f"hi{n.dimension}"]), 0.0  # the cut lies in (lo, hi]
            n.cut = r[f"hi{n.dimension}"] if r else 0
        while window:
            ask = {k: (tree[k].dimension, *window[k]) for k in window}
            counted = placed.withColumn("bin", _bin_of(ask)("node", *columns)).where("bin >= 0").groupBy("node", "bin").agg(F.sum("bytes").alias("w")).collect()
            sums: dict[int, dict[int, int]] = {k: {} for k in ask}
            for r in counted:
                sums[r["node"]][r["bin"]] = r["w"]
            for k, (_, lo, hi) in ask.items():
                width, total = -(-(hi - lo) // BINS), below[k]
                for b in sorted(sums[k]):
                    if total + sums[k][b] >= goal[k]:
                        break
                    total += sums[k][b]
                else:
                    b = max(sums[k])
                    total -= sums[k][b]
                start, weight = lo + b * width, sums[k][b]
                if width == 1 or weight <= tolerance:
                    tree[k].cut = start if goal[k] - total < total + weight - goal[k] else min(start + width, hi)
                    del window[k]
                else:
                    window[k], below[k] = (start, min(start + width, hi)), total
        level = [c for k in level for c in (tree[k].left, tree[k].right)]
    return tree


def place_heavy(groups: list[tuple[int, int]], shards: int, target: float) -> tuple[dict[int, list[tuple[float, int]]], list[float]]:
    """Large groups (key, bytes), largest first, each to the shard with most room.

    Per group its parts (share up to which, shard): one, unless no shard has the room for all of
    it. Also the room left in each shard.
    """
    room = [target] * shards
    parts: dict[int, list[tuple[float, int]]] = {}
    for key, size in sorted(groups, key=lambda g: (-g[1], g[0])):
        left, own = float(size), []
        while left > 1e-9 * size:
            s = max(range(shards), key=lambda k: (room[k], -k))
            take = min(left, room[s]) if room[s] > 0 and left > room[s] + target * HEAVY_SHARE else left
            room[s] -= take
            left -= take
            own.append((1 - left / size if left > 1e-9 * size else 1.0, s))
        parts[key] = own
    return parts, [max(r, 0.0) for r in room]


def shard(docs: DataFrame, shards: int = SHARDS, text: str = "text", id: str = "doc_id", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot, grown_shard.

    Size is the UTF-8 bytes of the text (null: none) plus one; the law is ``bytes``, sizes of
    shards near equal, so ``grown_shard`` is null. Equal texts, null and empty ones too, share a
    shard unless their group has no room in any; then its rows are dealt by a hash over as few
    shards as hold them. Slots count from 0 without gaps, in no particular order. Repeated rows
    are rows of their own; null metadata is a value like others; an empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = scratch.keep(
        docs.select(
            F.monotonically_increasing_id().alias("row"), F.col(id).alias(id), (F.octet_length(whole) + 1).cast("long").alias("size"), F.crc32(whole.cast("binary")).alias("text_crc32"), F.xxhash64(whole).alias("group"),
            *[F.shiftrightunsigned(F.crc32(F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary")), 2).alias(f"d_{n}") for n, c in (("lang", lang), ("source", source))],
        ),
        "rows",
    )
    n_rows = rows.count()
    scale = F.round(F.log2(F.col("size").cast("double")) / 40 * ((1 << 30) - 1)).cast("long")
    points = rows.groupBy("group").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), F.min("d_lang").alias("d_lang"), F.min("d_source").alias("d_source"), F.min("size").alias("size"))
    points = scratch.keep(points.withColumn("d_size", F.least(scale, F.lit((1 << 30) - 1))).withColumn("tie", F.shiftrightunsigned(F.xxhash64("group"), 32)).drop("size"), "points")
    total = points.agg(F.sum("bytes")).first()[0] or 0
    target = total / shards
    heavy = [(r["group"], r["bytes"]) for r in points.where(F.col("bytes") > target * HEAVY_SHARE).select("group", "bytes").collect()]  # at most shards / HEAVY_SHARE
    parts, room = place_heavy(heavy, shards, target)
    light = points.where(F.col("bytes") <= target * HEAVY_SHARE)
    tree = grow_tree(light, room, target * TOLERANCE)

    columns = [*_DIMENSIONS, "tie"]
    first = F.array(*[F.lit(n.first) for n in tree])
    placed = light.select("group", "n", F.get(first, _leaf_of(tree)(*columns).cast("int")).alias("leaf"), F.lit(None).cast("array<struct<upto:double,shard:int>>").alias("parts"))
    if parts:
        dealt = spark.createDataFrame([(k, [(float(u), s) for u, s in own]) for k, own in parts.items()], "`group` long, parts array<struct<upto:double,shard:int>>")
        placed = placed.unionByName(points.select("group", "n").join(F.broadcast(dealt), "group").select("group", "n", F.lit(None).cast("int").alias("leaf"), "parts"))

    found = attach(rows.select("row", id, "size", "text_crc32", "group"), placed, "group", "n", n_rows, "row")
    share = F.pmod(F.xxhash64("row"), F.lit(1 << 20)) / float(1 << 20)
    own = F.filter("parts", lambda p: share < p["upto"])
    buckets = max(64, n_rows // (shards * NUMBERED) + 1)
    sharded = scratch.keep(found.select("row", id, "size", "text_crc32", F.coalesce(F.get(own, F.lit(0))["shard"], F.col("leaf")).alias("shard"), F.pmod(F.xxhash64("row", F.lit(7)), F.lit(buckets)).cast("int").alias("bucket")), "sharded")

    counts = sharded.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = small(counts.select("shard", "bucket", before.alias("before")))
    within = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("row"))
    numbered = sharded.withColumn("within", within).join(starts, ["shard", "bucket"])
    return numbered.select(F.col(id), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + F.col("within") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op2_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))
