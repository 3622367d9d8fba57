"""Token ids in compressed binary blocks: an adaptive context-mixing range coder.

A block holds whole documents and decodes alone: its model starts afresh and its content is
checksummed. Its ids are dealt over lanes, each a contiguous stretch of the stream with a range
coder of its own; a step codes one id of every lane, so the arithmetic runs in numpy. The model
is shared by the lanes of a block and adapts after each step, on both sides alike:

* order 0: adaptive frequencies of all ids;
* order 1 and order 2: the id last seen after the one or two ids before, with a confidence.

The two predictions get probability mass by how often predictions of their confidence came
true, the rest is spread by the order-0 frequencies; the mixture drives the coder. Several blocks
go through a step together, each with its own model; what a block holds does not depend on it.

File: blocks, one after another, each ended by a newline. Block: magic ``WFT2``, crc32 of all
that follows, length of the body, then the body: its place (task and number), counts, the
documents (a null flag, id and number of ids each), the words of each lane, and the lanes'
16-bit words. All numbers are little-endian. The order of blocks is that of their places.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, running_total, small, small_batches, table, tidy
from .tokens import Encoder

END_ID = 2
#: Ids after which a block ends with the document at hand, and blocks coded together and written to one file.
BLOCK_IDS, TOGETHER = 1 << 20, 8
#: Words that a worker remembers, over its tasks: about 250 MB. Every task meets some 300,000 words in 17 million characters.
WORDS_KEPT = 1_200_000
LANES = 1024
MAGIC = b"WFT2"

_TOTAL = 28  # bits of the coder's probabilities
_BASE = 22  # bits of the order-0 frequencies; the order-0 share never falls below 2 ** (_BASE - _TOTAL)
_LOW, _WORD = 48, 16  # bits of a lane's low end, and of what it puts out at a time
_MASK, _TOP = (1 << _LOW) - 1, 1 << (_LOW - _WORD)
_TABLE = 20  # bits of the order-2 table's index
_LEVELS = 8  # confidences, in the low three bits of a table's entry
_STATES = 2 * _LEVELS * _LEVELS
_EVERY = 32  # steps between two counts of frequencies and hits
_HEAD, _BODY = struct.Struct("<4sIQ"), struct.Struct("<IIIQI")


class Mixture:
    """The models of some blocks; encoder and decoder put them through the same steps.

    ``block`` tells the block of each lane. Lanes that are still active are the first ones.
    """

    def __init__(self, vocabulary: int, block: np.ndarray):
        self.size, self.blocks = vocabulary, int(block.max()) + 1
        self.seen = np.zeros(self.blocks * vocabulary, np.int64)
        self.table1, self.table2 = np.zeros(self.blocks << 16, np.int32), np.zeros(self.blocks << _TABLE, np.int32)
        n = _STATES * self.blocks
        self.tries, self.hits1, self.hits2 = np.full(n, 2.0), np.full(n, 0.1), np.full(n, 0.1)
        # Where each lane's block begins in the tables of all blocks.
        self.in1, self.in2, self.in_states = block << 16, block << _TABLE, block * _STATES
        self.in_ids, self.in_ends, self.in_line = block * vocabulary, block * (vocabulary + 1), block << _BASE
        self.narrow = np.int32 if self.blocks << _BASE < 1 << 31 else np.int64  # sorts and searches faster
        self.coded: list[np.ndarray] = []
        self.outcomes: list[np.ndarray] = []
        self.steps = 0
        self._count()

    def _count(self) -> None:
        """Frequencies and masses from what was coded so far."""
        if self.coded:
            self.seen += np.bincount(np.concatenate(self.coded), minlength=len(self.seen))
            n = np.bincount(np.concatenate(self.outcomes), minlength=3 * len(self.tries)).reshape(-1, 3)
            self.tries += n.sum(axis=1)
            self.hits1 += n[:, 1]
            self.hits2 += n[:, 2]
            self.coded, self.outcomes = [], []
        seen = self.seen.reshape(self.blocks, self.size)
        total, spare = seen.sum(axis=1), (1 << _BASE) - self.size
        own = np.where(total[:, None] > 0, 1 + (seen * (spare / np.maximum(total, 1))[:, None]).astype(np.int64), (1 << _BASE) // self.size)
        ends = np.zeros((self.blocks, self.size + 1), np.int64)
        np.cumsum(own, axis=1, out=ends[:, 1:])
        self.ends = ends.ravel()
        self.line = (ends + (np.arange(self.blocks) << _BASE)[:, None]).ravel().astype(self.narrow)  # ascending over all blocks
        most = (1 << _TOTAL) - (1 << _BASE)
        self.mass1 = (self.hits1 / self.tries * most).astype(np.int64)
        self.mass2 = (self.hits2 / self.tries * most).astype(np.int64)

    def predict(self, before1: np.ndarray, before2: np.ndarray) -> None:
        """Sets, per lane, both predictions and their masses."""
        m = self.m = len(before1)
        self.at1 = self.in1[:m] + (before1 & 0xFFFF)
        self.at2 = self.in2[:m] + (((before2 * 0x9E3779B1 + before1 * 0x85EBCA77) >> 9) & ((1 << _TABLE) - 1))
        self.v1, self.v2 = self.table1.take(self.at1), self.table2.take(self.at2)
        self.p1, self.p2 = self.v1 >> 3, self.v2 >> 3
        self.c1, self.c2 = self.v1 & 7, self.v2 & 7
        self.same = self.p1 == self.p2
        self.state = self.in_states[:m] + (self.c2 * (2 * _LEVELS) + self.c1 * 2 + self.same)
        self.m1, self.m2 = self.mass1.take(self.state), self.mass2.take(self.state)
        self.rest = (1 << _TOTAL) - self.m1 - self.m2

    def interval(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of these ids, of 2 ** _TOTAL."""
        a, b = self._base(x)
        return a + self.m1 * (x > self.p1) + self.m2 * (x > self.p2), b - a + self.m1 * (x == self.p1) + self.m2 * (x == self.p2)

    def _base(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of these ids in the order-0 share."""
        e = self.in_ends[: self.m] + x
        a, b = self.ends.take(e), self.ends.take(e + 1)
        a *= self.rest
        b *= self.rest
        a >>= _BASE
        b >>= _BASE
        return a, b

    def find(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids whose intervals hold these points (beyond the last id's, the last), and the intervals."""
        (s1, w1), (s2, w2) = self._base(self.p1), self._base(self.p2)
        w1 += self.m1 + self.m2 * self.same - s1  # as interval() has them
        w2 += self.m2 + self.m1 * self.same - s2
        s1 += self.m2 * (self.p1 > self.p2)
        s2 += self.m1 * (self.p2 > self.p1)
        d1, d2 = v - s1, v - s2
        hit1, hit2 = d1.view(np.uint64) < w1.view(np.uint64), d2.view(np.uint64) < w2.view(np.uint64)  # below zero is beyond any width
        out = np.where(hit1, self.p1, self.p2).astype(np.int64)
        start, width = np.where(hit1, s1, s2), np.where(hit1, w1, w2)
        k = np.flatnonzero(~(hit1 | hit2))
        rest, first = self.rest.take(k), self.in_ends.take(k)
        m1, m2 = self.m1.take(k) * (d1.take(k) > 0), self.m2.take(k) * (d2.take(k) > 0)  # of the predictions before the point
        u = v.take(k) - m1 - m2
        # The id whose scaled start is the last not beyond u: the first estimate is at most one off.
        key = (_quotient(u << _BASE, rest) + self.in_line.take(k)).astype(self.narrow)
        order = np.argsort(key)  # sorted keys find their places much faster
        x = np.empty(len(k), np.int64)
        x[order] = np.searchsorted(self.line, key.take(order), "right")
        x = np.minimum(x - 1 - first, self.size - 1)
        x += (x < self.size - 1) & (((self.ends.take(first + np.minimum(x + 1, self.size)) * rest) >> _BASE) <= u)
        first += x
        a, b = (self.ends.take(first) * rest) >> _BASE, (self.ends.take(first + 1) * rest) >> _BASE
        out[k], start[k], width[k] = x, a + self.m1.take(k) * (x > self.p1.take(k)) + self.m2.take(k) * (x > self.p2.take(k)), b - a
        return out, start, width

    def learn(self, x: np.ndarray) -> None:
        """After a step. Where lanes share a context, the last lane's word counts."""
        right1, right2 = x == self.p1, x == self.p2
        fresh = (x * _LEVELS + 1).astype(np.int32)
        for entries, at, v, c, right in ((self.table1, self.at1, self.v1, self.c1, right1), (self.table2, self.at2, self.v2, self.c2, right2)):
            entries[at] = np.where(right, v + (c < _LEVELS - 1), np.where(c > 1, v - np.int32(1), fresh))
        self.coded.append(x + self.in_ids[: self.m])
        self.outcomes.append(self.state * 3 + np.where(right2, 2, right1))
        self.steps += 1
        if self.steps < 8 or self.steps % _EVERY == 0:
            self._count()


def _quotient(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a // b of numbers from 0 on, b > 0 and a below 2 ** 52: there a quotient of doubles never rounds up to a whole number."""
    return (a / b).astype(np.int64)


def _shape(n: int) -> tuple[int, int]:
    """Lanes and steps for n ids: short blocks get fewer lanes."""
    lanes = max(1, min(LANES, n // 64))
    return lanes, -(-n // lanes)


class _Lanes:
    """The lanes of some blocks, the longest first: those active at a step come before all others."""

    def __init__(self, sizes: list[int]):
        self.sizes, self.shapes = sizes, [_shape(n) for n in sizes]
        block = np.repeat(np.arange(len(sizes)), [lanes for lanes, _ in self.shapes])
        lane = np.concatenate([np.arange(lanes) for lanes, _ in self.shapes])
        steps = np.array([s for _, s in self.shapes])[block]
        length = np.clip(np.array(sizes)[block] - lane * steps, 0, steps)
        self.order = np.argsort(-length, kind="stable")
        self.block, length = block[self.order], length[self.order]
        self.n, self.steps = len(block), int(length[0])
        self.active = np.searchsorted(-length, -np.arange(self.steps), "left").tolist()
        place = np.empty(self.n, np.int64)
        place[self.order] = np.arange(self.n)
        self.places = np.split(place, np.cumsum([lanes for lanes, _ in self.shapes])[:-1])  # of each block's lanes


def encode_blocks(blocks: list[np.ndarray], vocabulary: int) -> list[bytes]:
    """Per block the lanes of its ids: words of each lane, then all words."""
    full = [k for k, ids in enumerate(blocks) if len(ids)]
    out = [b""] * len(blocks)
    if not full:
        return out
    lanes = _Lanes([len(blocks[k]) for k in full])
    grid = np.zeros((lanes.steps, lanes.n), np.int32)
    for k, (own, steps), places in zip(full, lanes.shapes, lanes.places, strict=True):
        padded = np.zeros(own * steps, np.int32)
        padded[: len(blocks[k])] = blocks[k]
        grid[:steps, places] = padded.reshape(own, steps).T
    model = Mixture(vocabulary, lanes.block)
    low, span = np.zeros(lanes.n, np.int64), np.full(lanes.n, 1 << _LOW, np.int64)
    words, at = np.zeros((lanes.n, lanes.steps // 2 + 4 * _EVERY), np.uint16), np.zeros(lanes.n, np.int64)
    before1 = before2 = np.zeros(lanes.n, np.int64)

    def put(lane: np.ndarray, word: np.ndarray) -> None:
        words[lane, at[lane]] = word
        at[lane] += 1

    for t, m in enumerate(lanes.active):
        if t % _EVERY == 0 and at.max() + 4 * _EVERY > words.shape[1]:  # a step puts out three words at most
            words = np.concatenate([words, np.zeros_like(words)], axis=1)
        x = grid[t, :m].astype(np.int64)
        model.predict(before1[:m], before2[:m])
        start, width = model.interval(x)
        _narrow(low[:m], span[:m], span[:m] >> _TOTAL, start, width, put)
        model.learn(x)
        before2, before1 = before1, x
    if at.max() + 4 > words.shape[1]:
        words = np.concatenate([words, np.zeros((lanes.n, 4), np.uint16)], axis=1)
    for k in range(_LOW // _WORD):
        put(np.arange(lanes.n), (low >> (_LOW - _WORD * (k + 1))) & 0xFFFF)
    for k, places in zip(full, lanes.places, strict=True):
        n = at[places]
        out[k] = n.astype("<u4").tobytes() + words[places][np.arange(words.shape[1]) < n[:, None]].astype("<u2").tobytes()
    return out


def _narrow(low: np.ndarray, span: np.ndarray, unit: np.ndarray, start: np.ndarray, width: np.ndarray, shift) -> None:
    """Ranges become those of the ids; while a lane's top word is settled, or its range too narrow, the word leaves. In place."""
    low += unit * start
    span[:] = unit * width
    lane, part, wide = np.arange(len(low)), low, span
    while True:
        settled = (part ^ (part + wide)) < _TOP
        k = np.flatnonzero(settled | (wide < _TOP))
        if not len(k):
            return
        lane, settled, part, wide = lane[k], settled[k], part[k], wide[k]
        wide = np.where(settled, wide, -part & (_TOP - 1)) << _WORD
        shift(lane, part >> (_LOW - _WORD))
        part = (part << _WORD) & _MASK
        low[lane], span[lane] = part, wide


def decode_blocks(data: list[bytes], sizes: list[int], vocabulary: int) -> list[np.ndarray]:
    """What encode_blocks() was given, from what it gave and the numbers of ids."""
    full = [k for k, n in enumerate(sizes) if n]
    out = [np.empty(0, np.int32)] * len(sizes)
    if not full:
        return out
    lanes = _Lanes([sizes[k] for k in full])
    counts = np.concatenate([np.frombuffer(data[k], "<u4", own) for k, (own, _) in zip(full, lanes.shapes, strict=True)]).astype(np.int64)
    words = np.concatenate([np.frombuffer(data[k], "<u2", offset=4 * own) for k, (own, _) in zip(full, lanes.shapes, strict=True)] + [np.zeros(4, np.uint16)])
    at = (np.cumsum(counts) - counts)[lanes.order]
    code = np.zeros(lanes.n, np.int64)
    for _ in range(_LOW // _WORD):
        code = (code << _WORD) | words[at]
        at += 1
    low, span = np.zeros(lanes.n, np.int64), np.full(lanes.n, 1 << _LOW, np.int64)
    grid = np.zeros((lanes.steps, lanes.n), np.int32)
    model = Mixture(vocabulary, lanes.block)
    before1 = before2 = np.zeros(lanes.n, np.int64)

    def shift(lane: np.ndarray, _: np.ndarray) -> None:
        code[lane] = ((code[lane] << _WORD) & _MASK) | words[at[lane]]
        at[lane] += 1

    for t, m in enumerate(lanes.active):
        model.predict(before1[:m], before2[:m])
        unit = span[:m] >> _TOTAL
        x, start, width = model.find(np.minimum(_quotient(code[:m] - low[:m], unit), (1 << _TOTAL) - 1))
        grid[t, :m] = x
        _narrow(low[:m], span[:m], unit, start, width, shift)
        model.learn(x)
        before2, before1 = before1, x
    for k, (_, steps), places in zip(full, lanes.shapes, lanes.places, strict=True):
        out[k] = np.ascontiguousarray(grid[:steps, places].T).ravel()[: sizes[k]]
    return out


Document = tuple[int | None, bytes]


def write_blocks(task: int, first: int, blocks: list[list[Document]], vocabulary: int) -> list[bytes]:
    """Blocks of documents (id, ids as little-endian unsigned 32-bit), numbered from ``first``."""
    ids = [np.frombuffer(b"".join(x for _, x in own), "<u4") for own in blocks]
    out = []
    for k, (own, mine, coded) in enumerate(zip(blocks, ids, encode_blocks(ids, vocabulary), strict=True)):
        nulls = np.array([key is None for key, _ in own], np.uint8)
        body = _BODY.pack(task, first + k, len(own), len(mine), vocabulary) + nulls.tobytes() + np.array([key or 0 for key, _ in own], "<i8").tobytes() + np.array([len(x) // 4 for _, x in own], "<u8").tobytes() + coded
        out.append(_HEAD.pack(MAGIC, zlib.crc32(struct.pack("<Q", len(body)) + body), len(body)) + body)
    return out


def read_blocks(data: bytes, together: int = TOGETHER) -> Iterator[tuple[int, int, list[int | None], np.ndarray, np.ndarray]]:
    """Of a file's blocks: task, number, document ids, their numbers of ids, and all ids. ValueError if one is damaged."""
    held, at = [], 0
    while at < len(data):
        if at + _HEAD.size > len(data):
            raise ValueError("damaged block")
        magic, check, size = _HEAD.unpack_from(data, at)
        body = data[at + _HEAD.size : at + _HEAD.size + size]
        if magic != MAGIC or len(body) != size or check != zlib.crc32(struct.pack("<Q", size) + body):
            raise ValueError("damaged block")
        held.append(body)
        at += _HEAD.size + size + 1
        if len(held) == together or at >= len(data):
            heads = [_BODY.unpack_from(b) for b in held]
            coded = [b[_BODY.size + 17 * h[2] :] for b, h in zip(held, heads, strict=True)]
            for body, (task, number, docs, _, _), ids in zip(held, heads, decode_blocks(coded, [h[3] for h in heads], heads[0][4]), strict=True):
                nulls = np.frombuffer(body, np.uint8, docs, _BODY.size)
                keys = np.frombuffer(body, "<i8", docs, _BODY.size + docs).tolist()
                counts = np.frombuffer(body, "<u8", docs, _BODY.size + 9 * docs).astype(np.int64)
                yield task, number, [None if null else key for null, key in zip(nulls, keys, strict=True)], counts, ids
            held = []


def write_corpus(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, text: str = "text", id: str = "doc_id", block_ids: int = BLOCK_IDS) -> None:
    """Files of all documents in ascending order of id, in a new folder.

    A document is its ids and ``end_id``; a null text is empty. Rows with a null id come first;
    rows that share an id keep the order they were read in. Documents are never cut: a block
    ends with the document that fills it, so a document longer than ``block_ids`` makes a longer
    block. An empty table gives no blocks. A task that is run again writes its files again.
    """
    row = docs.select(F.col(id).cast("long").alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("__text"), F.monotonically_increasing_id().alias("__row"))
    ordered = row.repartitionByRange("__id", "__row").sortWithinPartitions("__id", "__row").select(F.col("__id").cast("string").alias("__id"), "__text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, task = Encoder.of(tokenizer, WORDS_KEPT), TaskContext.get().partitionId()
        vocabulary = max(encoder.tokenizer.get_vocab_size(), end_id + 1)
        end = struct.pack("<I", end_id)
        full: list[list[Document]] = []
        own: list[Document] = []
        size = number = 0
        for batch in batches:
            for a in range(0, len(batch), 200):
                part = batch.iloc[a : a + 200]
                for key, ids in zip(part["__id"], encoder.encode(part["__text"].tolist()), strict=True):
                    own.append((None if key is None or key != key else int(key), ids + end))
                    size += len(ids) // 4 + 1
                    if size >= block_ids:
                        full.append(own)
                        own, size = [], 0
                        if len(full) == TOGETHER:
                            yield pd.DataFrame({"data": write_blocks(task, number, full, vocabulary)})
                            full, number = [], number + TOGETHER
        full += [own] if own else []
        if full:
            yield pd.DataFrame({"data": write_blocks(task, number, full, vocabulary)})

    blocks = ordered.mapInPandas(tidy(run), "data binary").select(F.col("data").cast("string").alias("value"))  # bytes as they are
    with small_batches(docs.sparkSession):
        blocks.write.option("maxRecordsPerFile", TOGETHER).text(path)


def read_corpus(spark: SparkSession, path: str, scratch: Scratch, with_ids: bool = False) -> DataFrame:
    """Per document of written files: doc_id, start, n_tokens, ids_crc32, and with ``with_ids`` ids (little-endian unsigned 32-bit).

    ``start`` counts the ids of all documents before it. A damaged file raises an error.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                for task, number, keys, counts, ids in read_blocks(data):
                    raw, ends = ids.astype("<u4").tobytes(), np.cumsum(counts)
                    pieces = [raw[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                    rows = {"task": task, "block": number, "doc_id": [None if k is None else str(k) for k in keys], "within": ends - counts, "n_tokens": counts, "ids_crc32": [zlib.crc32(x) for x in pieces]}
                    yield pd.DataFrame(rows | ({"ids": pieces} if with_ids else {}))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    schema = "task long, block long, doc_id string, within long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    read = scratch.keep(files.mapInPandas(tidy(run), schema), "documents")
    sizes = read.groupBy("task", "block").agg(F.sum("n_tokens").alias("n"))
    starts = running_total(sizes, ["task", "block"], "n", "before", scratch, "blocks").drop("n")
    found = read.join(small(starts), ["task", "block"])
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def op8_token_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document through the files: a null text is its end id alone; repeated and null ids are rows of their own; an empty table gives none."""
    scratch = Scratch(spark)
    files = scratch.path("files")
    write_corpus(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), files)
    found = read_corpus(spark, files, scratch)
    scratch.only("documents", "blocks")
    return found
