"""Line deduplication by a deletion-neighbourhood join.

Lines that differ by at most one edit become equal once at most one character of each is deleted.
Every candidate line emits its variants as hashed keys, equal variants meet, and each line learns
the earliest line it meets; the edit distance is then verified on the two texts. A variant keeps
the place of its deletion: lines that lose a character at the same place and agree otherwise are
all within one substitution of each other, and a line that equals another's variant is one
insertion away. So a group needs its earliest line only, never its pairs.

Two lines within one edit agree outside a short segment that holds the edit. Counting keys of
lines without one segment, first halves, then sixteenths, shows without loss which lines have a
partner at all, and where the edit must be; only those deletions are emitted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, attach, small, table, tidy

# The characters that Unicode calls white space.
WHITE_SPACE = "".join(map(chr, [*range(9, 14), 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]))
#: Segments of the second, finer count.
SEGMENTS = 16
#: Candidate lines up to this many are broadcast to the scan that fetches their texts.
BROADCAST_LINES = 400_000
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_M = (1 << 64) - 1


def normalised(line: F.Column) -> F.Column:
    """Lower case without white space around it; what counts as equal."""
    return F.lower(F.trim(line, F.lit(WHITE_SPACE)))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    return x * np.uint64(0x94D049BB133111EB)


class LineHash:
    """Two 64-bit polynomial hashes of a line, of its parts and of its variants, from prefix sums."""

    _powers = [np.ones(1, np.uint64) for _ in _BASES]

    def __init__(self, line: str):
        points = np.frombuffer(line.encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
        self.n = len(points)
        x = _mix(points + np.uint64(1))
        self.sums, self.powers = [], []
        for k, base in enumerate(_BASES):
            if len(self._powers[k]) <= self.n:
                self._powers[k] = np.r_[np.uint64(1), np.cumprod(np.full(2 * self.n, base | 1, np.uint64))]
            self.sums.append(np.r_[np.uint64(0), np.cumsum(x * self._powers[k][: self.n])])
            self.powers.append(np.uint64(pow(base | 1, -1, 1 << 64)))

    def whole(self) -> list[np.uint64]:
        return [s[-1] for s in self.sums]

    def deleted(self, a: int, b: int) -> list[np.ndarray]:
        """Of the line without character p, for p from a to b - 1."""
        return [s[a:b] + (s[-1] - s[a + 1 : b + 1]) * inverse for s, inverse in zip(self.sums, self.powers, strict=True)]

    def without(self, a: int, b: int) -> int:
        """A key of the line's start up to a and its end from b, told apart by where the segment starts."""
        s = self.sums[0]
        end = (int(s[-1]) - int(s[b])) * pow(_BASES[0] | 1, -b, 1 << 64) & _M if b else int(s[-1])
        return int(_mix(np.array([(int(s[a]) * 3 + end * 0x9E3779B97F4A7C15 + a) & _M], np.uint64))[0])


def _segments(n: int, parts: int) -> list[tuple[int, int]]:
    cuts = [n * k // parts for k in range(parts + 1)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def segment_keys(line: str, parts: int) -> list[tuple[int, int, int]]:
    """(key, from, to) of the line without each segment.

    A pair within one edit has lengths n and n or n + 1. Both cut by the shorter length n: they
    start alike up to the segment that holds the edit and end alike after it.
    """
    h, out = LineHash(line), []
    for n in (h.n, h.n - 1):  # as the shorter, or equally long, line of a pair; as the longer
        more = h.n - n
        for j, (a, b) in enumerate(_segments(n, parts)):
            key = (h.without(a, b + more) ^ (n * 0x9E3779B97F4A7C15) ^ (j << 48)) & _M
            out.append((key - (1 << 64) if key >> 63 else key, a, b + more))
    return out


def variants(line: str, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashed keys and a role for the deletions in these spans, and for the line itself.

    Roles: 0, the variant and the place of its deletion; 1, the variant; 2, the whole line.
    """
    h = LineHash(line)
    places = np.unique(np.concatenate([np.arange(a, min(b, h.n)) for a, b in spans]))
    each = [x[places] for x in h.deleted(0, h.n)]
    keys = []
    for x, own in zip(each, h.whole(), strict=True):
        at = _mix(x + _mix(places.astype(np.uint64) + np.uint64(h.n << 32)))
        keys.append(np.r_[at, _mix(x), _mix(np.array([own], np.uint64))].view(np.int64))
    role = np.r_[np.zeros(len(places), np.int8), np.ones(len(places), np.int8), np.int8(2)]
    return keys[0], keys[1], role


def _half_keys(line: F.Column) -> F.Column:
    """The native form of two segments: 4 keys, of the first and the second half, for both roles of length."""
    n = F.length(line)

    def keys(m: F.Column) -> list[F.Column]:
        half = F.floor(m / 2).cast("int")
        return [F.xxhash64(m, F.lit(0), F.substring(line, F.lit(1), half)), F.xxhash64(m, F.lit(1), F.right(line, m - half))]

    return F.array(*keys(n), *keys(n - 1))


def _shared(keyed: DataFrame, n: int) -> DataFrame:
    """Rows of ``keyed`` (key, line, and more; one for each line and key) whose key has two lines or more."""
    many = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met = attach(keyed, many, "key", "n", n, "line")
    return met.where(F.col("n").isNotNull()).drop("n")


def partners(docs: DataFrame, scratch: Scratch, text: str = "text", id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """All lines (row, id, line_no, line) and distinct lines with the earliest line within one edit.

    ``line`` is the MD5 of the normalised line. The second table has line, n, first (id, row,
    line_no) and best, which is first or the first of an earlier partner.
    """
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id).alias("id"), F.col(text).alias("__whole"))
    numbered = rows.select("row", "id", F.posexplode(F.split(F.coalesce("__whole", F.lit("")), "\n")).alias("line_no", "__raw")).withColumn("__text", normalised(F.col("__raw"))).where("__text <> ''")
    first = F.struct("id", "row", "line_no")
    lines = scratch.keep(numbered.select("row", "id", "line_no", F.unhex(F.md5("__text")).alias("line"), _half_keys(F.col("__text")).alias("halves")), "lines")
    distinct = scratch.keep(lines.groupBy("line").agg(F.count("*").alias("n"), F.min(first).alias("first"), F.any_value("halves").alias("halves")), "distinct")

    keyed = distinct.select("line", F.explode(F.array_distinct("halves")).alias("key"))
    likely = scratch.keep(_shared(keyed, 4 * distinct.count()).select("line").distinct(), "likely")
    wanted = likely.join(distinct.select("line", "first"), "line")
    texts = numbered.select(F.unhex(F.md5("__text")).alias("line"), "__text").join(small(likely, BROADCAST_LINES), "line", "left_semi").groupBy("line").agg(F.any_value("__text").alias("text"))
    candidates = scratch.keep(texts.join(wanted, "line"), "candidates")

    def finer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(line, *k) for line, text in zip(batch["line"], batch["text"], strict=True) for k in {k[0]: k for k in segment_keys(text, SEGMENTS)}.values()]
            yield pd.DataFrame(rows, columns=["line", "key", "a", "b"])

    keyed = candidates.select("line", "text").mapInPandas(tidy(finer), "line binary, key long, a int, b int")
    spans = _shared(keyed, 2 * SEGMENTS * candidates.count()).groupBy("line").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    near = scratch.keep(candidates.join(spans, "line"), "near")

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), 500):
                part = batch.iloc[a : a + 500]
                made = [variants(text, [(s["a"], s["b"]) for s in spans]) for text, spans in zip(part["text"], part["spans"], strict=True)]
                sizes = [len(m[0]) for m in made]
                yield pd.DataFrame({"line": np.repeat(part["line"].to_numpy(object), sizes), "k1": np.concatenate([m[0] for m in made]), "k2": np.concatenate([m[1] for m in made]), "role": np.concatenate([m[2] for m in made])})

    # Both hashes make one key of 128 bits; equal variants of one line in a run of letters are one.
    made = near.select("line", "text", "spans").mapInPandas(tidy(emit), "line binary, k1 long, k2 long, role byte")
    made = made.select("line", F.unhex(F.concat(F.lpad(F.hex("k1"), 16, "0"), F.lpad(F.hex("k2"), 16, "0"))).alias("key"), "role").distinct()
    made = scratch.keep(made.join(small(near.select("line", "first")), "line"), "variants")
    found = [F.min(F.when(F.col("role") == r, F.struct(F.col("first"), F.col("line")))).alias(f"m{r}") for r in range(3)]
    groups = made.groupBy("key").agg(F.count("*").alias("n"), *found).where("n > 1")
    met = attach(made.withColumn("spread", F.xxhash64("line")), groups, "key", "n", made.count(), "spread").where(F.col("n").isNotNull())
    other = F.when(F.col("role") == 0, F.col("m0")).when(F.col("role") == 1, F.col("m2")).otherwise(F.col("m1"))
    best = met.select("line", "first", other.alias("other")).where("other.first < first").groupBy("line").agg(F.min("other").alias("other"))

    # Verify the edit distance on the texts themselves.
    own, theirs = near.select("line", "text"), near.select(F.col("line").alias("__line"), F.col("text").alias("__other"))
    pairs = best.join(own, "line").join(theirs, F.col("other.line") == F.col("__line"))
    verified = pairs.where(F.levenshtein("text", "__other", 1).between(0, 1)).select(F.col("line").alias("__near"), F.col("other.first").alias("__best"))
    judged = distinct.select("line", "n", "first").join(small(verified), F.col("line") == F.col("__near"), "left").select("line", "n", "first", F.coalesce("__best", "first").alias("best"))
    return lines.select("row", "id", "line_no", "line"), judged


def find_duplicate_lines(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Per document: id, n_lines, n_kept, dropped (line numbers from 0, ascending).

    Lines are parted by ``\\n`` and compared in lower case without white space around them. A
    line goes if an earlier line, by id, then order of reading, then number, is equal or within
    one inserted, deleted or replaced character, however short both are. Blank lines always stay
    and are not counted. A null or empty text has no lines. Null ids come first; rows that repeat
    an id are rows of their own; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    lines, judged = partners(docs, scratch, text, id)
    special = scratch.keep(judged.where("n > 1 or best < first"), "special")  # all others stay as they are
    scratch.only("lines", "special")
    met = attach(lines, special.select("line", "n", "best"), "line", "n", lines.count(), "row")
    goes = F.col("best").isNotNull() & (F.col("best") < F.struct("id", "row", "line_no"))
    per = met.groupBy("row", "id").agg(F.count("*").alias("n_lines"), F.array_sort(F.collect_list(F.when(goes, F.col("line_no")))).alias("dropped"))
    empty = docs.where(~F.coalesce(F.col(text), F.lit("")).rlike(r"(?U)\S")).select(F.col(id).alias("id"), F.lit(0).cast("long").alias("n_lines"), F.array().cast("array<int>").alias("dropped"))
    return per.select("id", "n_lines", "dropped").unionByName(empty).select(F.col("id").alias(id), "n_lines", (F.col("n_lines") - F.size("dropped")).alias("n_kept"), "dropped")


def remove_lines(docs: DataFrame, found: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``docs`` without the lines that ``find_duplicate_lines`` dropped. ValueError if ids repeat: lines would be told apart by nothing."""
    if docs.groupBy(id).count().where("count > 1").take(1):
        raise ValueError(f"{id} repeats")
    drops = found.where(F.size("dropped") > 0).select(F.col(id).alias("__id"), F.col("dropped").alias("__dropped"))
    kept = F.array_join(F.filter(F.split(F.col(text), "\n"), lambda x, k: ~F.array_contains("__dropped", k)), "\n")
    return docs.join(drops, F.col(id).eqNullSafe(F.col("__id")), "left").select(*[F.when(F.col("__dropped").isNull(), F.col(text)).otherwise(kept).alias(c) if c == text else F.col(c) for c in docs.columns])


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's duplicate lines; see ``find_duplicate_lines`` for odd rows."""
    return find_duplicate_lines(table(spark, sf_dir, "documents"))
