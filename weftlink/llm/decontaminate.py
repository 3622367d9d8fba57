"""Benchmark decontamination by the q-gram lemma.

If a benchmark item of m characters occurs in a text with at most k edits, at least
m - Q + 1 - k * Q of its q-grams occur there unchanged, on diagonals (place in the text less
place in the item) that lie within k of each other. Shared q-grams are counted in overlapping
bands of diagonals; bands that meet the bound go to a banded alignment, which decides. Items too
short for a q-gram are found as they are, at word bounds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shipping import ship
from .common import Scratch, small, table, tidy

Q = 10
#: Edits allowed for each character of an item.
RATE = 0.08
_WORD = re.compile(r"\w+")
#: Characters of benchmark items in one index, about 100 bytes each; a larger benchmark is taken block by block.
INDEX_CHARS = 2_000_000
#: Characters of texts scanned at a time.
SPAN = 1 << 18
_BITS, _SLOT_BITS = 22, 20
_GAP = "\uffff"  # between texts; in no item


def normalise(text: str) -> str:
    """Lower case, white space as one space; texts and items are compared so."""
    return " ".join(text.replace(_GAP, " ").lower().split())


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), "<u4").astype(np.uint64)


def _grams(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every q-gram."""
    base = 0x9E3779B97F4A7C15
    power = lambda n: np.uint64(pow(base, n, 1 << 64))
    out, have = None, 0
    part, size, left = x + np.uint64(1), 1, Q
    while left:  # q-grams from grams of 1, 2, 4 ... characters
        if left & 1:
            if out is None:
                out, have = part, size
            else:
                n = len(x) - have - size + 1
                if n <= 0:
                    return np.empty(0, np.uint64)
                out, have = out[:n] * power(size) + part[have : have + n], have + size
        left >>= 1
        if left:
            n = len(part) - size
            if n <= 0:
                return np.empty(0, np.uint64)
            part, size = part[:n] * power(size) + part[size : size + n], 2 * size
    out = out ^ (out >> np.uint64(29))
    return out * np.uint64(0xBF58476D1CE4E5B9)


class Index:
    """The q-grams of benchmark items and where they lie."""

    def __init__(self, items: list[tuple[int, str]]):
        texts = [(key, normalise(text)) for key, text in items]
        self.short: dict[str, list[tuple[int, str, int]]] = {}  # by their first word: id, text, place of that word
        for key, text in texts:
            if len(text) < Q and (word := _WORD.search(text)):
                self.short.setdefault(word[0], []).append((key, text, word.start()))
        texts = sorted((key, text) for key, text in texts if len(text) >= Q)
        self.ids = np.array([key for key, _ in texts], np.int64)
        self.texts = [text for _, text in texts]
        sizes = np.array([len(t) for t in self.texts], np.int64)
        self.budget = np.minimum((sizes * RATE).astype(np.int64), (sizes - Q) // Q)  # below 2 * Q characters: no edits
        self.bound = np.maximum(sizes - Q + 1 - self.budget * Q, 1)
        each = [_grams(_points(t)) for t in self.texts]
        grams = np.concatenate(each) if each else np.empty(0, np.uint64)
        order = np.argsort(grams, kind="stable")
        self.grams, first = np.unique(grams, return_index=False, return_counts=True)
        self.starts = np.r_[0, np.cumsum(first)]
        self.item = np.repeat(np.arange(len(each)), [len(g) for g in each])[order] if each else np.empty(0, np.int64)
        self.place = np.concatenate([np.arange(len(g)) for g in each])[order] if each else np.empty(0, np.int64)
        self.known = np.zeros(1 << _BITS, bool)
        self.known[self.grams >> np.uint64(64 - _BITS)] = True

    def search_long(self, text: str) -> list[tuple[int, int, int, int]]:
        """search() of one long text, in windows that overlap by more than any place of an item."""
        overlap = 2 * max(map(len, self.texts), default=0) + 2 * int(self.budget.max(initial=0)) + Q
        best: dict[int, tuple[int, int, int, int]] = {}
        for a in range(0, max(1, len(text) - overlap), 2 * SPAN):
            for key, start, end, edits in self._search([text[a : a + 2 * SPAN + overlap]])[0]:
                one = (edits, a + start, a + end, key)
                best[key] = min(best.get(key, one), one)
        return self._with_short(text, [(key, start, end, edits) for edits, start, end, key in sorted(best.values(), key=lambda m: m[3])])

    def search(self, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
        """Per normalised text (item id, start, end, edits) of each item in it: its best place, then the first."""
        return [self._with_short(text, own) for text, own in zip(texts, self._search(texts), strict=True)]

    def _with_short(self, text: str, own: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
        """``own`` and the first place of every short item, by item id."""
        if not self.short:
            return own
        found: dict[tuple[int, str], tuple[int, int, int, int]] = {}
        for word in _WORD.finditer(text):
            for key, item, place in self.short.get(word[0], ()):
                start = word.start() - place
                end = start + len(item)
                if (key, item) in found or start < 0 or not text.startswith(item, start):
                    continue
                if not (_WORD.match(item[-1]) and _WORD.match(text[end : end + 1])):
                    found[key, item] = (key, start, end, 0)
        return sorted([*own, *found.values()], key=lambda m: m[0]) if found else own

    def _search(self, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
        """search() of the items of at least Q characters."""
        found: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
        whole = _GAP.join(texts)
        starts = np.r_[0, np.cumsum([len(t) + 1 for t in texts])][:-1].astype(np.int64)
        grams = _grams(_points(whole))
        at = np.flatnonzero(self.known[grams >> np.uint64(64 - _BITS)])
        which = np.searchsorted(self.grams, grams[at])
        which[which == len(self.grams)] = 0
        right = self.grams[which] == grams[at] if len(self.grams) else np.zeros(len(at), bool)
        at, which = at[right], which[right]
        many = self.starts[which + 1] - self.starts[which]
        if not len(at):
            return [[] for _ in texts]
        at = np.repeat(at, many)
        post = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(self.starts[which], many)
        item, place = self.item[post], self.place[post]
        width = self.budget[item] + 1
        band = (at - place + (1 << 20)) // width  # a band is two strides wide, so any k + 1 diagonals lie in one
        keys = np.concatenate([(item << 44) | band, (item << 44) | (band - 1)])
        # Too few grams under a hash of the key are too few under the key: most keys leave before the sort.
        slot = (((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOT_BITS))).astype(np.int64)
        bound = np.concatenate([self.bound[item]] * 2)
        rows = np.flatnonzero(np.bincount(slot, minlength=1 << _SLOT_BITS)[slot] >= bound)
        if not len(rows):
            return [[] for _ in texts]
        own, first, back, counts = np.unique(keys[rows], return_index=True, return_inverse=True, return_counts=True)
        enough = np.flatnonzero(counts >= self.bound[own >> 44])
        keep = np.flatnonzero(np.isin(back, enough))
        hit_at = np.concatenate([at, at])[rows[keep]]
        hit_text = np.searchsorted(starts, hit_at, "right") - 1
        pairs = np.unique(np.stack([own[back[keep]], hit_text]), axis=1) if len(keep) else np.empty((2, 0), np.int64)
        for key, t in pairs.T.tolist():
            i, j = key >> 44, key & ((1 << 44) - 1)
            k, text, item_text = int(self.budget[i]), texts[t], self.texts[i]
            low = j * (k + 1) - (1 << 20) - int(starts[t])  # diagonals low to low + 2k + 1 of this text
            best = found[t].get(i)
            a, b = max(0, low - k), min(len(text), low + 2 * (k + 1) + len(item_text) + k)
            if b <= a or best and best[2] == 0 and best[0] <= a:
                continue
            exact = text.find(item_text, a, b)
            match = (exact, exact + len(item_text), 0) if exact >= 0 else None if best and best[2] == 0 else align(item_text, text, low - k, low + 2 * k + 1 + k, k)
            if match and (best is None or (match[2], match[0]) < (best[2], best[0])):
                found[t][i] = match
        return [[(int(self.ids[i]), *m) for i, m in sorted(own.items())] for own in found]


def align(item: str, text: str, low: int, high: int, k: int) -> tuple[int, int, int] | None:
    """(start, end, edits) of the best place of ``item`` on diagonals low to high of ``text``; None beyond k edits.

    The path may start and end anywhere on these diagonals. Of equally good ends the first counts.
    """
    width = high - low + 1
    far = 1 << 20
    x = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    y = np.frombuffer(item.encode("utf-32-le", "replace"), "<u4")
    diagonal = np.arange(width)
    place = low + diagonal  # the text's characters before a cell, in row 0
    cost = np.where((place >= 0) & (place <= len(x)), 0, far)
    begin = place.copy()
    for r, c in enumerate(y):
        place = low + diagonal + r
        inside = (place >= 0) & (place < len(x))
        same = np.zeros(width, bool)
        same[inside] = x[place[inside]] == c
        step = np.where(inside, cost + ~same, far)  # character for character
        skip = np.r_[cost[1:] + 1, far]  # the item's character is missing in the text
        down = skip < step
        now = np.where(down, skip, step)
        origin = np.where(down, np.r_[begin[1:], 0], begin)
        now[(place + 1 < 0) | (place + 1 > len(x))] = far
        slope = now - diagonal  # characters of the text that the item lacks
        lowest = np.minimum.accumulate(slope)
        source = np.maximum.accumulate(np.where(slope == lowest, diagonal, 0))
        cost, begin = np.minimum(lowest + diagonal, far), origin[source]
        if cost.min() > k:
            return None
    end = int(cost.argmin())
    return int(begin[end]), low + end + len(y), int(cost[end])


def _finder(shared):
    schema = "array<struct<item_id:long,start:int,end:int,edits:int>>"

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out: list[list] = []
            held: list[str] = []
            size = 0
            for text in batch:
                plain = normalise(text) if isinstance(text, str) else ""
                if len(plain) > 4 * SPAN:
                    out += shared.value.search(held) if held else []
                    held, size = [], 0
                    out.append(shared.value.search_long(plain))
                    continue
                held.append(plain)
                size += len(plain)
                if size >= SPAN:
                    out += shared.value.search(held)
                    held, size = [], 0
            out += shared.value.search(held) if held else []
            yield pd.Series([[dict(zip(("item_id", "start", "end", "edits"), m, strict=True)) for m in own] for own in out], dtype=object)

    return F.pandas_udf(tidy(run), schema)


def find_items(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", out: str = "leaks") -> DataFrame:
    """``docs`` with ``out``: the items found in the text, by item id: item_id, start, end, edits.

    Places count characters of the normalised text (lower case, white space as one space). A
    null or empty text holds nothing; null items and items without a word are left out. Items under
    Q characters count where they are whole words, those under 2 * Q where they stand without
    edits, longer ones within the edits; a part of an item does not count. Of items that repeat an
    id each counts. Every text is searched whole; an empty table gives no rows, repeated rows are
    searched one by one. A column called ``out`` is replaced.

    The index of about INDEX_CHARS characters is broadcast. A larger benchmark goes block by block,
    a job and a broadcast for each, and no worker holds more than one index; what a block finds is
    written by the text's digest and joined back.
    """
    spark = docs.sparkSession
    ship(spark)
    items = benchmark.where(F.col(item_text).isNotNull() & F.col(item_id).isNotNull()).select(F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text"))
    blocks = max(1, -(-int(items.agg(F.sum(F.length("text"))).first()[0] or 0) // INDEX_CHARS))
    own = [c for c in docs.columns if c != out]

    def index(k: int):
        block = items.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == k).collect()  # about INDEX_CHARS characters
        return spark.sparkContext.broadcast(Index([(r["id"], r["text"]) for r in block]))

    if blocks == 1:
        return docs.select(*own, _finder(index(0))(F.col(text)).alias(out))
    scratch, found = Scratch(spark), None
    sha = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    for k in range(blocks):
        shared = index(k)
        hits = docs.select(sha.alias("__sha"), _finder(shared)(F.col(text)).alias("hits")).where(F.size("hits") > 0)
        hits = scratch.keep(hits.groupBy("__sha").agg(F.any_value("hits").alias("hits")), f"hits{k}")
        shared.destroy()
        found = hits if found is None else found.unionByName(hits)
    found = scratch.keep(found.groupBy("__sha").agg(F.array_sort(F.flatten(F.collect_list("hits"))).alias("__hits")), "found")
    scratch.only("found")
    none = F.array().cast(found.schema["__hits"].dataType)
    return docs.withColumn("__sha", sha).join(small(found, 50_000), "__sha", "left").select(*own, F.coalesce("__hits", none).alias(out))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: whether it holds an item, and the items' ids, places and edits."""
    found = find_items(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("leaks") > 0).alias("contaminated"), F.col("leaks.item_id").alias("item_ids"), F.col("leaks.start").alias("starts"), F.col("leaks.end").alias("ends"), F.col("leaks.edits").alias("edits"))
