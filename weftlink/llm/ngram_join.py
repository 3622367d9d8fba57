"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of word n-grams. Sets are equal or share one of the rarest n-grams of each
(prefix and length filters, exact) if their similarity reaches the threshold; such pairs are candidates.
MinHash values of a pair are compared a few at a time, and the pair is dropped as soon as the
posterior probability that it reaches the threshold falls below a tolerance; what is left is
verified exactly.

A group of copies makes no pairs: equal sets are one representative, every n-gram's list is
compared with one of its members first, and only members that these links leave in different
components are compared with one another. Members of a long list are so compared in one worker, a
block of them with a block: a forest of the pairs that pass the pruning leaves it, not the pairs. So
no link is lost between components, and the rows follow the number of documents, whatever the lists.

Every link lies within a component of what passed. Links are found and counted there, all sets with
all: blocks of sets are multiplied as matrices of n-grams, and only counts and a forest of the links
leave the worker. The arithmetic of both, not the rows, grows with the square of a group.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, attach, keep_rows, small, table, tidy

WORDS, THRESHOLD = 5, 0.8
#: MinHash values of a document, and how many are compared at a time.
HASHES, STEP = 128, 16
#: A pair goes if it reaches the threshold with less than this probability.
TOLERANCE = 1e-6
#: N-grams in more than this share of the documents, or LEAST_COMMON of them, are ordered last.
COMMON_SHARE, LEAST_COMMON = 1 / 500, 50
#: Counters in which common n-grams are found.
_COUNTERS = 22
#: Members of lists longer than this whose components differ are compared in blocks, without rows for pairs.
SPLIT_MEMBERS = 8
#: Characters handled at a time.
SPAN = 1 << 18
#: About so many sets, or n-grams, of a component are in one block when its links are counted; so many members of a list, too.
BLOCK_SETS, BLOCK_GRAMS = 4096, 1 << 20
#: Sets and n-grams multiplied at a time, and members from which on an n-gram is a column.
TILE, PANEL, FREQUENT = 1024, 4096, 16
_B = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """Per text the sorted 64-bit hashes of its word n-grams, each once.

    Words are parted by white space and lower-cased. A text of fewer words is one n-gram; a text
    without words has none.
    """
    out: list[np.ndarray] = []
    held: list[str] = []
    size = 0
    for text in texts:
        plain = " ".join((text or "").lower().split())
        held.append(plain)
        size += len(plain) + 1
        if size >= SPAN:
            out += _sets(held, words)
            held, size = [], 0
    return out + (_sets(held, words) if held else [])


@cache
def _short_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(2 * SPAN)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base of the words' hashes, and of its inverse."""
    return tuple(np.r_[np.uint64(1), np.cumprod(np.full(n, b, np.uint64))] for b in (_B, pow(_B, -1, 1 << 64)))


def _sets(plain: list[str], words: int) -> list[np.ndarray]:
    points = np.frombuffer((" ".join(plain) + " ").encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    power, inverse = _short_powers() if len(points) <= 2 * SPAN else _powers(len(points))  # of a longer text they go with it
    sums = np.r_[np.uint64(0), np.cumsum((points + np.uint64(1)) * power[: len(points)])]
    ends = np.flatnonzero(points == 32)
    starts = np.r_[0, ends[:-1] + 1]
    full = ends > starts  # an empty text leaves an empty word
    owner = np.searchsorted(np.cumsum([len(t) + 1 for t in plain]), starts, "right")[full]
    starts, ends = starts[full], ends[full]
    word = _mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    counts = np.bincount(owner, minlength=len(plain))
    out, at = [], 0
    for n in counts.tolist():
        own, at = word[at : at + n], at + n
        if not n:
            out.append(np.empty(0, np.uint64))
            continue
        width = min(words, n)
        grams = own[: n - width + 1].copy()
        for k in range(1, width):
            grams = grams * np.uint64(_B) + own[k : n - width + 1 + k]
        out.append(np.unique(_mix(grams)))
    return out


_rng = np.random.default_rng(20240229)
_A = (_rng.integers(0, 1 << 32, HASHES, np.uint64) | np.uint64(1)).astype(np.uint32)
_C = _rng.integers(0, 1 << 32, HASHES, np.uint64).astype(np.uint32)


def min_hashes(grams: np.ndarray) -> np.ndarray:
    """The smallest value of every hash function over a set that is not empty."""
    x = (grams >> np.uint64(32)).astype(np.uint32) ^ grams.astype(np.uint32)
    best = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for a in range(0, len(x), 1024):
        y = (x[a : a + 1024, None] ^ _C) * _A
        y ^= y >> np.uint32(15)
        np.minimum(best, (y * np.uint32(0x2C1B3C6D)).min(axis=0), out=best)
    return best


def least_matches(threshold: float, tolerance: float) -> list[tuple[int, int]]:
    """(values compared, matches needed to go on), from a uniform prior of the similarity.

    With m of n values alike the similarity is Beta(m + 1, n - m + 1); it reaches the threshold
    with the probability that n + 1 trials at the threshold succeed at most m times.
    """
    steps = []
    for n in range(STEP, HASHES + 1, STEP):
        total, m = 0.0, 0
        while m <= n:
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= tolerance:
                break
            m += 1
        steps.append((n, m))
    return steps


def common_grams(docs: DataFrame, text: str, words: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of common n-grams, sorted, and how many documents have one of them.

    Counts only order the n-grams of the prefix filter; they need to be the same for all
    documents, not exact. With ``least`` a share of the documents, the number of slots is bounded
    by the n-grams of a document over that share, however many documents there are.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slots = np.zeros(1 << _COUNTERS, np.int32)
        for batch in batches:
            for a in range(0, len(batch), 500):
                sets = shingle_sets(batch["text"].iloc[a : a + 500].tolist(), words)
                at, n = np.unique((np.concatenate(sets) >> np.uint64(64 - _COUNTERS)).astype(np.int64), return_counts=True)
                slots[at] += n.astype(np.int32)
        at = np.flatnonzero(slots >= 4)
        yield pd.DataFrame({"slot": at, "n": slots[at].astype(np.int64)})

    counted = docs.select(F.col(text).alias("text")).mapInPandas(tidy(count), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    found = counted.orderBy("slot").toPandas()
    return found["slot"].to_numpy(np.int64), found["n"].to_numpy(np.int64)


def prefix(grams: np.ndarray, common: tuple[np.ndarray, np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The rarest n-grams of a set, rarest first, as many as sets of the threshold cannot all miss, and if they are common.

    Sets x and y of that similarity share at least threshold * |x| n-grams, so the
    |x| - ceil(threshold * |x|) + 1 first of each in any common order share one.
    """
    n = len(grams)
    size = n - math.ceil(threshold * n - 1e-9) + 1
    slots, counts = common
    own = (grams >> np.uint64(64 - _COUNTERS)).astype(np.int64)
    at = np.minimum(np.searchsorted(slots, own), max(len(slots) - 1, 0))
    often = slots[at] == own if len(slots) else np.zeros(n, bool)
    turned = _mix(grams + np.uint64(1))  # not the slots' order
    order = turned >> np.uint64(1)
    if often.any():
        order = np.where(often, np.uint64(1 << 63) + (counts[at].astype(np.uint64) << np.uint64(24)) + (turned >> np.uint64(40)), order)
    first = np.argpartition(order, size - 1)[:size] if size < n else np.arange(n)
    first = first[np.lexsort((grams[first], order[first]))]
    return grams[first], often[first]


def low_bits(hashes: np.ndarray) -> np.ndarray:
    """The lowest bit of every MinHash value, as two 64-bit numbers: values that differ share it one time in two."""
    return np.packbits((hashes & np.uint32(1)).astype(np.uint8)).view(np.int64)


def _sketch(docs: DataFrame, common, words: int, threshold: float) -> DataFrame:
    """sha, sig, n, hashes (the first STEP, then the others), their lowest bits, grams and common of every text with words."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), 500):
                part = batch.iloc[a : a + 500]
                sets = shingle_sets(part["text"].tolist(), words)
                keep = [k for k, x in enumerate(sets) if len(x)]
                firsts = [prefix(sets[k], shared.value, threshold) for k in keep]
                hashes = [min_hashes(sets[k]) for k in keep]
                bits = np.stack([low_bits(x) for x in hashes]) if keep else np.empty((0, 2), np.int64)
                yield pd.DataFrame(
                    {
                        "sha": part["sha"].to_numpy()[keep],
                        "sig": [_signature(sets[k]) for k in keep],
                        "n": [len(sets[k]) for k in keep],
                        "first": [x[:STEP].tobytes() for x in hashes],
                        "others": [x[STEP:].tobytes() for x in hashes],
                        "low": bits[:, 0],
                        "high": bits[:, 1],
                        "grams": [g.view(np.int64) for g, _ in firsts],
                        "common": [c for _, c in firsts],
                    }
                )

    return docs.mapInPandas(tidy(run), "sha string, sig binary, n int, first binary, others binary, low long, high long, grams array<long>, common array<boolean>")


def _signature(grams: np.ndarray) -> bytes:
    """128 bits of the whole set."""
    return hashlib.md5(grams.tobytes()).digest()


_MEMBER = ("key", "row", "n", "pos")


def _lists(sets: DataFrame) -> DataFrame:
    """key, row, n, pos, anchor, anchor_n, anchor_pos: members of every prefix n-gram of two or more sets, and one of them.

    ``pos`` is the n-gram's place in its set's order. The anchor has the smallest: the fewest
    n-grams of its own. Common n-grams are few and their lists long: their anchors are found by
    partial aggregation and broadcast. Others have short lists, which are swept in order of the key.
    """
    postings = sets.select("row", "n", F.posexplode(F.arrays_zip("grams", "common")).alias("pos", "g")).select(F.col("g.grams").alias("key"), "row", "n", "pos", F.col("g.common").alias("common"))
    often = postings.where("common").select(*_MEMBER)
    heads = often.groupBy("key").agg(F.min(F.struct("pos", "row", "n")).alias("head"), F.count("*").alias("members")).where("members > 1")
    heads = heads.select("key", F.col("head.row").alias("anchor"), F.col("head.n").alias("anchor_n"), F.col("head.pos").alias("anchor_pos"))
    long = often.join(small(heads, 1_000_000), "key")

    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = np.empty((4, 0), np.int64)  # rows of a key that may go on in the next batch
        for batch in batches:
            all_ = np.concatenate([last, np.stack([batch[c].to_numpy(np.int64) for c in _MEMBER])], axis=1)
            end = np.searchsorted(all_[0], all_[0][-1]) if all_.shape[1] else 0
            yield runs(all_[:, :end])
            last = all_[:, end:]
        yield runs(last)

    def runs(all_: np.ndarray) -> pd.DataFrame:
        key = all_[0]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
        sizes = np.diff(np.r_[first, len(key)])
        heads = np.repeat(all_[1:, first], sizes, axis=1)
        return pd.DataFrame(dict(zip((*_MEMBER, "anchor", "anchor_n", "anchor_pos"), (*all_, *heads), strict=True)))[np.repeat(sizes > 1, sizes)]

    rare = postings.where("not common").select(*_MEMBER).repartition("key").sortWithinPartitions("key", "pos", "row")
    return rare.mapInPandas(tidy(sweep), "key long, row long, n int, pos int, anchor long, anchor_n int, anchor_pos int").unionByName(long)


def _may_reach(n: tuple[str, str], pos: tuple[str, str], threshold: float) -> F.Column:
    """If sets of these sizes can reach the threshold when this n-gram is the first they share, at these places.

    They must share threshold / (1 + threshold) of both sizes, and have no more left than from
    these places on. A pair that reaches the threshold passes at its first shared n-gram.
    """
    x, y = n
    need = F.lit(threshold / (1 + threshold)) * (F.col(x) + F.col(y)) - 1e-6
    sizes = F.least(x, y) >= F.lit(threshold) * F.greatest(x, y) - 1e-6
    return sizes & (F.least(F.col(x) - F.col(pos[0]), F.col(y) - F.col(pos[1])) >= need)


def _whole(rows: DataFrame, sets: DataFrame, docs: DataFrame, scratch: Scratch, name: str, words: int) -> DataFrame:
    """row, grams: the whole sets of these rows, made from their texts again."""
    wanted = scratch.keep(rows.join(sets.select("row", "sha"), "row"), f"{name}_wanted")
    texts = docs.join(small(wanted.select("sha")), "sha", "left_semi").groupBy("sha").agg(F.any_value("text").alias("text"))

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), 500):
                part = batch.iloc[a : a + 500]
                yield pd.DataFrame({"sha": part["sha"].to_numpy(), "grams": [x.tobytes() for x in shingle_sets(part["text"].tolist(), words)]})

    return scratch.keep(texts.select("sha", "text").mapInPandas(tidy(whole), "sha string, grams binary").join(wanted, "sha").select("row", "grams"), f"{name}_grams")


def _verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, scratch: Scratch, name: str, words: int, threshold: float, tolerance: float) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of rows that reach the threshold, pruned by MinHash, then verified on the whole sets; and those sets (row, grams)."""
    steps = least_matches(threshold, tolerance)

    def compare(own: list[tuple[int, int]]):
        """Goes on through these steps of values x and y; ``same`` counts matches so far."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if not len(batch):
                    continue
                x, y = (np.frombuffer(b"".join(batch[c]), np.uint32).reshape(len(batch), -1) for c in ("x", "y"))
                left, same, at = np.arange(len(batch)), batch["same"].to_numpy(np.int64).copy(), 0
                for n, need in own:
                    to = at + STEP
                    same[left] += (x[left, at:to] == y[left, at:to]).sum(axis=1)
                    left, at = left[same[left] >= need], to
                yield batch[["a", "b"]].assign(same=same).iloc[left]

        return run

    # Few values travel with all pairs, the others only with pairs that the first leave in.
    left = pairs.select("a", "b", F.lit(0).alias("same"))
    for part, own in (("first", steps[:1]), ("others", steps[1:])):
        one, two = (sets.select(F.col("row").alias(r), F.col(part).alias(h)) for r, h in (("a", "x"), ("b", "y")))
        left = left.join(one, "a").join(two, "b").select("a", "b", "same", "x", "y").mapInPandas(tidy(compare(own)), "a long, b long, same int")
        left = scratch.keep(left, f"{name}_{part}")
    likely = left.select("a", "b")

    grams = _whole(likely.select(F.col("a").alias("row")).union(likely.select("b")).distinct(), sets, docs, scratch, name, words)

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both / (len(x) + len(y) - both))
            yield batch[["a", "b"]].assign(similarity=keep)[np.array(keep, float) >= threshold - 1e-12]

    met = likely.join(grams.select(F.col("row").alias("a"), F.col("grams").alias("x")), "a").join(grams.select(F.col("row").alias("b"), F.col("grams").alias("y")), "b")
    return scratch.keep(met.select("a", "b", "x", "y").mapInPandas(tidy(exact), "a long, b long, similarity double"), name), grams


def merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Gives places i and j of every pair one label, and all places that had theirs; a label is the first place that has it."""
    while True:
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            return
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        home = np.arange(len(label))
        np.minimum.at(home, np.maximum(a, b), np.minimum(a, b))
        while (home[home] != home).any():
            home = home[home]
        label[:] = home[label]


def count_links(sets: list[np.ndarray], weights: np.ndarray, split: int, threshold: float, tile: int = TILE, panel: int = PANEL, frequent: int = FREQUENT, label: np.ndarray | None = None) -> np.ndarray:
    """Per set the weight of the sets that reach the threshold with it.

    With ``split`` the sets before it are compared with those from it on; with 0 all are compared
    with all, themselves included. Labels, if given, are merged along the links.
    """
    n = np.array([len(x) for x in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), n)
    _, column, members = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    many = members > (frequent if len(sets) > 64 else 1)
    place = np.cumsum(many) - 1
    width = int(many.sum())
    # An n-gram of many sets is a column of a matrix; the pairs of one of few sets are listed.
    dense, sparse = many[column], (members[column] > 1) & ~many[column]
    if width:
        row, col = owner[dense], place[column[dense]]
    else:
        row = col = np.empty(0, np.int64)
    few_row, few_col = owner[sparse], column[sparse]

    def part(own: np.ndarray, columns: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = np.searchsorted(own, (low, high))
        order = np.argsort(columns[a:b], kind="stable")
        return own[a:b][order] - low, columns[a:b][order]

    def matrix(own: tuple[np.ndarray, np.ndarray], height: int, first: int) -> np.ndarray:
        a, b = np.searchsorted(own[1], (first, first + panel))
        out = np.zeros((height, min(panel, width - first)), np.float32)
        out[own[0][a:b], own[1][a:b] - first] = 1
        return out

    def listed(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray], shared: np.ndarray) -> None:
        for k in range(0, len(x[1]), 1 << 16):
            r, c = x[0][k : k + (1 << 16)], x[1][k : k + (1 << 16)]
            start, end = np.searchsorted(y[1], c, "left"), np.searchsorted(y[1], c, "right")
            size = end - start
            at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)
            cells, hits = np.unique(np.repeat(r, size) * shared.shape[1] + y[0][at], return_counts=True)
            shared.reshape(-1)[cells] += hits.astype(np.float32)

    out = np.zeros(len(sets), np.int64)
    lows = [(a, min(a + tile, split)) for a in range(0, split, tile)]
    highs = [(a, min(a + tile, len(sets))) for a in range(split, len(sets), tile)]
    for x in lows or highs:
        x_dense, x_few = part(row, col, *x), part(few_row, few_col, *x)
        for y in highs:
            if not split and y < x:
                continue
            y_dense, y_few = part(row, col, *y), part(few_row, few_col, *y)
            shared = np.zeros((x[1] - x[0], y[1] - y[0]), np.float32)  # exact: far below 2 ** 24
            for first in range(0, width, panel):
                shared += matrix(x_dense, x[1] - x[0], first) @ matrix(y_dense, y[1] - y[0], first).T
            listed(x_few, y_few, shared)
            both = n[x[0] : x[1], None] + n[None, y[0] : y[1]] - shared.astype(np.float64)
            if x == y:
                np.fill_diagonal(shared, n[x[0] : x[1]])  # n-grams of one set alone are in no column
                np.fill_diagonal(both, n[x[0] : x[1]])
            hit = shared / both >= threshold - 1e-12
            if label is not None:
                i, j = np.nonzero(hit & (label[x[0] : x[1], None] != label[None, y[0] : y[1]]))
                merge(label, i + x[0], j + y[0])
            hit = hit.astype(np.float64)
            out[x[0] : x[1]] += (hit @ weights[y[0] : y[1]]).astype(np.int64)
            if x != y:
                out[y[0] : y[1]] += (weights[x[0] : x[1]] @ hit).astype(np.int64)
    return out


def _blocks(rows: DataFrame, key: str, blocks: DataFrame) -> DataFrame:
    """``rows`` with own, x, y: groups of a key cut into ``blocks`` (key, blocks) by a hash of the row, every two of which meet.

    What is shipped grows with the blocks of a group, not with its pairs.
    """
    n = F.coalesce("blocks", F.lit(1))
    cut = rows.join(small(blocks), key, "left").select(*rows.columns, F.pmod(F.xxhash64("row"), n).cast("int").alias("own"), n.alias("__n"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    return cut.select(*rows.columns, "own", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))


def _dealt(met: DataFrame, key: str) -> DataFrame:
    """Groups of a key and two blocks, each whole in one partition, rows of block x first."""
    return met.repartition(key, "x", "y").sortWithinPartitions(key, "x", "y", "own")


def _degrees(parts: DataFrame, sets: DataFrame, grams: DataFrame, weights: DataFrame, scratch: Scratch, threshold: float) -> DataFrame:
    """row, linked, root: the weight (documents) of sets that reach the threshold with it, its own included, block by block.

    ``root`` is a row that links lead to, the same for all rows of a block that they connect.
    """
    placed = scratch.keep(parts.join(sets.select("row", "n"), "row").select("row", "component", "n"), "placed")
    sizes = placed.groupBy("component").agg(F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_GRAMS)).cast("int").alias("blocks")).where("blocks > 1")
    met = _blocks(placed.select("row", "component"), "component", sizes)
    met = met.join(weights.select(F.col("head").alias("row"), "weight"), "row").join(grams, "row")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # rows of a group that may go on in the next batch
        for batch in batches:
            if not len(batch):
                continue
            keys = batch[["component", "x", "y"]].to_numpy(np.int64)
            first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
            if held and (held[-1][["component", "x", "y"]].iloc[-1].to_numpy(np.int64) != keys[0]).any():
                yield group(held)
                held = []
            for a, b in zip(first, np.r_[first[1:], len(batch)], strict=True):
                held.append(batch.iloc[a:b])
                if b < len(batch):
                    yield group(held)
                    held = []
        if held:
            yield group(held)

    def group(held: list[pd.DataFrame]) -> pd.DataFrame:
        all_ = held[0] if len(held) == 1 else pd.concat(held)
        rows, apart = all_["row"].to_numpy(), all_["x"].iat[0] != all_["y"].iat[0]
        split = int((all_["own"] == all_["x"]).sum()) if apart else 0
        if apart and split in (0, len(all_)):  # the other block is empty
            return pd.DataFrame({"row": rows, "linked": 0, "root": rows})
        label = np.arange(len(rows))
        found = count_links([np.frombuffer(x, np.uint64) for x in all_["grams"]], all_["weight"].to_numpy(np.float64), split, threshold, label=label)
        return pd.DataFrame({"row": rows, "linked": found, "root": rows[label]})

    dealt = _dealt(met.select("component", "x", "y", "own", "row", "weight", "grams"), "component")
    return scratch.keep(dealt.mapInPandas(tidy(run), "row long, linked long, root long"), "degree")


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """row, component (its smallest row) of every row of ``links`` (a, b).

    Each round every row takes the smallest label among its neighbours and itself, then the label
    of its label, until nothing changes; links and labels stay distributed and every round is written.
    """
    edges = scratch.keep(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), f"{name}_edges")
    labels = scratch.keep(edges.groupBy(F.col("a").alias("row")).agg(F.least(F.min("b"), F.first("a")).alias("component")), f"{name}_0")
    k = 0
    while True:
        near = edges.join(labels.withColumnRenamed("row", "b"), "b").groupBy(F.col("a").alias("row")).agg(F.min("component").alias("near"))
        least = labels.join(near, "row").select("row", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        up = labels.select(F.col("row").alias("component"), F.col("component").alias("top"))
        k += 1
        grown = scratch.keep(least.join(up, "component").select("row", "old", F.least("component", "top").alias("component")), f"{name}_{k}")
        changed = grown.where("component <> old").limit(1).count()
        labels = grown.select("row", "component")
        scratch.drop(f"{name}_{k - 1}")
        if not changed:
            return labels


def _across(open_: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of members of a list (key, row, n, pos, part) in different parts: those outside its main part with all others."""
    main = open_.groupBy("key", "part").agg(F.count("*").alias("n")).groupBy("key").agg(F.max(F.struct("n", "part")).alias("main")).select("key", F.col("main.part").alias("main"))
    light = open_.join(main, "key").where("part <> main").select("key", F.col("row").alias("r1"), F.col("n").alias("n1"), F.col("pos").alias("pos1"), F.col("part").alias("p1"), "main")
    met = light.join(open_, "key").where((F.col("part") != F.col("p1")) & ((F.col("part") == F.col("main")) | (F.col("row") < F.col("r1"))) & _may_reach(("n", "n1"), ("pos", "pos1"), threshold))
    return met.select(F.least("row", "r1").alias("a"), F.greatest("row", "r1").alias("b")).distinct()


def likely_labels(n: np.ndarray, pos: np.ndarray, part: np.ndarray, bits: np.ndarray, split: int, threshold: float, least: int, tile: int = TILE) -> np.ndarray:
    """Labels of members of a list: those of one part have the same, and so have those of a pair with ``least`` bits alike.

    With ``split`` the members before it are compared with those from it on, else all with all. Pairs
    whose labels are the same already need no comparison; those within the largest part never do.
    """
    _, first, own = np.unique(part, return_index=True, return_inverse=True)
    label = first[own].copy()
    main = own == np.bincount(own).argmax()
    light, all_ = np.flatnonzero(~main), np.arange(len(n))
    need, left = threshold / (1 + threshold), n - pos

    def meet(x: np.ndarray, y: np.ndarray) -> None:
        for a in range(0, len(x), tile // 4):
            r = x[a : a + tile // 4, None]
            for b in range(0, len(y), tile):
                c = y[None, b : b + tile]
                may = (label[r] != label[c]) & (np.minimum(n[r], n[c]) >= threshold * np.maximum(n[r], n[c]) - 1e-6)
                i, j = np.nonzero(may & (np.minimum(left[r], left[c]) >= need * (n[r] + n[c]) - 1e-6))
                p, q = r[i, 0], c[0, j]
                go = HASHES - np.bitwise_count(bits[p] ^ bits[q]).sum(axis=1, dtype=np.int64) >= least
                merge(label, p[go], q[go])

    if split:
        meet(light[light < split], all_[split:])
        meet(all_[:split][main[:split]], light[light >= split])
    else:
        meet(light, all_)
    return label


def _suspects(long: DataFrame, sets: DataFrame, scratch: Scratch, threshold: float, tolerance: float) -> DataFrame:
    """Pairs (a, b) of rows that connect the members of a long list (key, row, n, pos, part, members) that MinHash does not tell apart.

    At most one pair a member and two blocks, however many pass; what is in one component of them
    and of the links so far may be linked, and nothing else of a long list is. A member is in many
    lists and travels with one bit of each value, alike for (1 + similarity) / 2 of them.
    """
    least = least_matches((1 + threshold) / 2, tolerance)[-1][1]
    blocks = long.select("key", F.ceil(F.col("members") / BLOCK_SETS).cast("int").alias("blocks")).where("blocks > 1").distinct()
    met = _blocks(long.select("key", *_MEMBER[1:], "part"), "key", blocks)
    met = met.join(sets.select("row", "low", "high"), "row")

    names = ["key", "x", "y", "own", "n", "pos", "part", "low", "high"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = [np.empty((len(names), 0), np.int64)]  # rows of a group that may go on in the next batch
        for batch in batches:
            if not len(batch):
                continue
            now = np.stack([batch[c].to_numpy(np.int64) for c in names])
            start = np.flatnonzero((now[:3] != now[:3, -1:]).any(axis=0))
            end = start[-1] + 1 if len(start) else 0  # from here on all rows are of the last group
            if end or last[-1].shape[1] and (last[-1][:3, -1] != now[:3, 0]).any():
                yield groups(np.concatenate([*last, now[:, :end]], axis=1))
                last = []
            last.append(now[:, end:])
        yield groups(np.concatenate(last, axis=1))

    def groups(all_: np.ndarray) -> pd.DataFrame:
        first = np.flatnonzero(np.r_[True, (all_[:3, 1:] != all_[:3, :-1]).any(axis=0)]) if all_.shape[1] else np.empty(0, np.int64)
        pairs = [np.empty((2, 0), np.int64)]
        for a, b in zip(first, np.r_[first[1:], all_.shape[1]], strict=True):
            x, y = all_[1:3, a]
            split = int((all_[3, a:b] == x).sum()) if x != y else 0
            if x != y and split in (0, b - a):  # the other block is empty
                continue
            n, pos, part = all_[4:7, a:b]
            label = likely_labels(n, pos, part, all_[7:, a:b].T.copy().view(np.uint64), split, threshold, least)
            to = part[label]
            moved = to != part
            pairs.append(np.stack([to[moved], part[moved]]))
        a, b = np.unique(np.concatenate(pairs, axis=1), axis=1)
        return pd.DataFrame({"a": a, "b": b})

    found = _dealt(met.select("row", *names), "key").drop("row").mapInPandas(tidy(run), "a long, b long")
    return scratch.keep(found.distinct(), "suspects")


def similar(docs: DataFrame, text: str = "text", id: str = "doc_id", words: int = WORDS, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, count: bool = True, scratch: Scratch | None = None) -> DataFrame:
    """One row per document: row, id, sha, copy_id, class_id, n_links, representative.

    Two documents are linked if the Jaccard similarity of their sets of word n-grams is at least
    ``threshold``; a class is a component of links. ``class_id`` is its smallest id and the row
    with it (the first read, if several) is the class's ``representative``. ``copy_id`` is the
    same for documents with equal sets (their smallest id). ``n_links`` is the number of other
    documents linked to the document, those with equal sets included; with ``count`` false it is
    null. A null or empty text, or one without words, is alone in its class and has no links; a
    text shorter than ``words`` words is one n-gram. Null ids are below all others. An empty table
    gives no rows.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    whole = F.coalesce(F.col(text), F.lit(""))
    every = scratch.keep(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id).alias(id), F.sha2(whole, 256).alias("sha")), "every")
    n_docs = every.count()
    base = docs.select(F.sha2(whole, 256).alias("sha"), whole.alias("text"))
    common = common_grams(docs, text, words, max(LEAST_COMMON, math.ceil(n_docs * COMMON_SHARE)))
    # Sets are numbered as they are written; one set stands for equal texts, then for equal sets.
    sketched = scratch.keep(_sketch(base, common, words, threshold).withColumn("row", F.monotonically_increasing_id()), "sketched")
    own = scratch.keep(sketched.groupBy("sha", "sig").agg(F.min("row").alias("row")), "own")
    heads = scratch.keep(own.groupBy("sig").agg(F.min("row").alias("head")), "heads")
    copies = every.groupBy("sha").agg(F.count("*").alias("copies"))
    member = own.join(heads, "sig").select("sha", "head").join(copies, "sha")
    gone = sketched.select("row").join(heads.select(F.col("head").alias("row")), "row", "left_anti")
    sets = sketched.join(small(scratch.keep(gone, "gone"), 1_000_000), "row", "left_anti")

    lists = scratch.keep(_lists(sets), "lists")
    pairs = lists.where((F.col("row") != F.col("anchor")) & _may_reach(("n", "anchor_n"), ("pos", "anchor_pos"), threshold))
    pairs = scratch.keep(pairs.select(F.least("row", "anchor").alias("a"), F.greatest("row", "anchor").alias("b")).distinct(), "pairs")
    links, grams = _verified(pairs, sets, base, scratch, "links", words, threshold, tolerance)
    parts = components(links, scratch, "parts")

    # Members of a list that are still in different components are compared with one another.
    placed = lists.select(*_MEMBER).join(small(parts), "row", "left").select(*_MEMBER, F.coalesce("component", "row").alias("part"))
    mixed = placed.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("members")).where("low < high").select("key", "members")
    open_ = scratch.keep(placed.join(mixed, "key"), "open")
    left = _across(open_.where(F.col("members") <= SPLIT_MEMBERS), threshold)
    left = scratch.keep(left.join(pairs, ["a", "b"], "left_anti"), "left")
    more, others = _verified(left, sets, base, scratch, "more", words, threshold, tolerance)
    links = links.select("a", "b").unionByName(more.select("a", "b"))
    grams = grams.unionByName(others.join(grams.select("row"), "row", "left_anti"))
    suspects = _suspects(open_.where(F.col("members") > SPLIT_MEMBERS), sets, scratch, threshold, tolerance)
    open_groups = bool(suspects.take(1))
    parts = components(links.unionByName(suspects) if open_groups else links, scratch, "groups")

    weights = scratch.keep(member.groupBy("head").agg(F.sum("copies").alias("weight")), "weights")
    degree = None
    if count or open_groups:
        whole_parts = parts
        if not count:  # only groups that suspects connect may fall apart
            touched = suspects.select(F.col("a").alias("row")).join(parts, "row").select("component").distinct()
            whole_parts = scratch.keep(parts.join(small(touched), "component", "left_semi").select("row", "component"), "touched")
        if open_groups:
            lacking = whole_parts.select("row").join(grams.select("row"), "row", "left_anti")
            grams = grams.unionByName(_whole(lacking, sets, base, scratch, "lacking", words))
        degree = _degrees(whole_parts, sets, grams, weights, scratch, threshold)
    if open_groups:
        found = degree.where("root <> row").select(F.col("root").alias("a"), F.col("row").alias("b"))
        parts = components(links.unionByName(found), scratch, "classes")
    if count:
        # A set without a link to another one has those of its own documents.
        degree = degree.groupBy("row").agg(F.sum("linked").alias("linked"))
        degree = weights.join(degree, weights["head"] == degree["row"], "left").select(F.col("head").alias("row"), (F.coalesce("linked", "weight") - 1).alias("n_links"))
    facts = member.join(parts, member["head"] == parts["row"], "left").drop("row")
    facts = facts.join(degree, facts["head"] == degree["row"], "left") if count else facts.withColumn("n_links", F.lit(None).cast("long"))
    facts = facts.select("sha", "copies", "head", F.coalesce("component", "head").alias("component"), "n_links")
    told = scratch.keep(attach(every, scratch.keep(facts, "facts"), "sha", "copies", n_docs, "row"), "told")
    # A text without words has no set: it is a class of its own, told apart by a number below zero.
    told = told.withColumn("component", F.coalesce("component", -1 - F.col("row")))
    best = scratch.keep(told.groupBy("component").agg(F.min(F.struct(id, "row")).alias("best"), F.count("*").alias("members")).where("members > 1"), "best")
    shared = scratch.keep(told.where("head is not null").groupBy("head").agg(F.min(id).alias("copy_id"), F.count("*").alias("n")).where("n > 1"), "shared")
    scratch.only("told", "best", "shared")
    out = attach(told, best, "component", "members", n_docs, "row")
    out = attach(out.withColumn("head", F.coalesce("head", -1 - F.col("row"))), shared, "head", "n", n_docs, "row")
    alone = F.col("best").isNull()
    return out.select(
        "row", F.col(id), "sha",
        F.coalesce("copy_id", F.col(id)).alias("copy_id"),
        F.when(alone, F.col(id)).otherwise(F.col(f"best.{id}")).alias("class_id"),
        (F.coalesce("n_links", F.lit(0)) if count else F.lit(None).cast("long")).alias("n_links"),
        (alone | (F.col("row") == F.col("best.row"))).alias("representative"),
    )


def one_of_each(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each class of similar ones, the representative; all columns stay."""
    scratch = Scratch(docs.sparkSession)
    judged = similar(docs, text, id, count=False, scratch=scratch).select(F.col(id).alias("__id"), F.col("sha").alias("__sha"), F.col("representative").alias("kept"))
    judged = scratch.keep(judged, "judged")
    scratch.only("judged")
    return keep_rows(docs, judged, text, id)


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class, copy group and number of links; see ``similar`` for odd rows."""
    return similar(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "copy_id", "n_links", "representative")
