"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language where the texts lie and adds the counts up; the matrix of
log probabilities is broadcast, and a batch of texts is scored as one sparse matrix in numpy: rows
of columns, one entry for each n-gram, times the matrix.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shipping import ship
from .common import table, tidy

#: Hashed n-grams of 1 to ORDERS characters fall into 2 ** BITS columns.
BITS, ORDERS = 16, 3
#: The bound of the training sample: whole texts of each language, chosen by a hash of their id.
TRAIN_PER_LANGUAGE = 5_000
ALPHA = 0.5
#: Languages that can be learnt: 256 KB of the broadcast matrix each.
MOST_LANGUAGES = 1_000
#: Characters scored at a time.
SPAN = 1 << 18
_LETTER = re.compile(r"[^\W\d_]")


def features(text: str) -> np.ndarray:
    """Column of every n-gram of the lower-cased text, digits as one; of n characters at most ORDERS * n."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4").astype(np.uint32)
    points = np.where((points >= 48) & (points <= 57), np.uint32(48), points)
    return _columns(points)


def _by_order(points: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For n from 1 to ORDERS the column of the n-gram at every place."""
    mixed = np.zeros(len(points), np.uint32)
    for n in range(1, ORDERS + 1):
        if len(points) < n:
            return
        mixed = (mixed[: len(points) - n + 1] * np.uint32(0x01000193) + points[n - 1 :] * np.uint32(0x9E3779B1)) & np.uint32(0xFFFFFFFF)
        yield n, ((mixed + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS)


def _columns(points: np.ndarray) -> np.ndarray:
    out = [columns for _, columns in _by_order(points)]
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", id: str = "doc_id", per_language: int = TRAIN_PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Languages and their log probabilities (columns x languages, then a row of priors and one of usual means).

    ``labelled``: rows with a null text or language are left out. At most about ``per_language``
    texts of each language are counted, whole: those with the lowest hash of their id, at the rate
    that the number of its texts gives, so the choice depends on nothing else. The usual mean is
    the expected log probability of an n-gram of the language. Without any labelled row there are
    no languages; more than MOST_LANGUAGES are a ValueError.
    """
    ship(labelled.sparkSession)
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.pmod(F.xxhash64(F.col(id).cast("string")), F.lit(1 << 30)).alias("h"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row for each language
    if not sizes:
        return [], np.zeros(((1 << BITS) + 2, 0), np.float32)
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"{len(sizes)} languages; at most {MOST_LANGUAGES} can be learnt")
    below = rows.sparkSession.createDataFrame([(k, int((1 << 30) * min(1.0, per_language / n))) for k, n in sizes.items()], "lang string, below long")
    sample = rows.join(F.broadcast(below), "lang").where("h < below").select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, text in zip(batch["lang"], batch["text"], strict=True):
                own = held.setdefault(name, np.zeros(1 << BITS, np.int64))
                own += np.bincount(features(text), minlength=1 << BITS)
        if held:
            yield pd.DataFrame({"lang": list(held), "counts": [x.tobytes() for x in held.values()]})

    def add(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(1 << BITS, np.int64)
        for x in group["counts"]:
            total += np.frombuffer(x, np.int64)
        return pd.DataFrame({"lang": [key[0]], "counts": [total.tobytes()]})

    counted = sample.repartition(16).mapInPandas(tidy(count), "lang string, counts binary").groupBy("lang").applyInPandas(add, "lang string, counts binary")
    found = sorted((r["lang"], np.frombuffer(bytes(r["counts"]), np.int64)) for r in counted.collect())  # languages x 512 KB
    names = [name for name, _ in found]
    matrix = np.stack([x for _, x in found], axis=1).astype(np.float64) + ALPHA
    share = matrix / matrix.sum(axis=0)
    prior = np.log([sizes[name] / sum(sizes.values()) for name in names])
    return names, np.vstack([np.log(share), prior, (share * np.log(share)).sum(axis=0)]).astype(np.float32)


def score_texts(texts: list[str | None], matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log posterior (not normalised) of each language, NaN where a text is null or has no letter; and n-grams of each text.

    The texts' characters follow one another; n-grams that would cross from one text into the
    next are left out. Rows of the sparse matrix are summed span by span.
    """
    logs = matrix[: 1 << BITS].astype(np.float64)
    out, grams = np.full((len(texts), matrix.shape[1]), np.nan), np.zeros(len(texts), np.int64)
    held = [k for k, text in enumerate(texts) if text is not None and _LETTER.search(text)]
    while held:
        some, size = [], 0
        while held and (not some or size < SPAN):
            some.append(held.pop(0))
            size += len(texts[some[-1]])
        parts = [np.frombuffer(texts[k].lower().encode("utf-32-le", "replace"), "<u4") for k in some]
        ends = np.cumsum([len(x) for x in parts])
        points = np.concatenate(parts)
        points = np.where((points >= 48) & (points <= 57), np.uint32(48), points).astype(np.uint32)
        starts = np.r_[0, ends[:-1]]
        total = np.zeros((len(some), matrix.shape[1]))
        count = np.zeros(len(some), np.int64)
        for a in range(0, len(points), SPAN):  # very long texts go in overlapping spans: no n-gram is lost or counted twice
            at = a
            for n, columns in _by_order(points[a : a + SPAN + ORDERS - 1]):
                columns = columns[:SPAN]
                place = np.arange(at, at + len(columns))
                row = np.searchsorted(ends, place, "right")
                inside = place + n <= ends[row]
                row, columns = row[inside], columns[inside]
                first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.empty(0, np.int64)
                if len(first):
                    total[row[first]] += np.add.reduceat(logs[columns], first, axis=0)
                    count[row[first]] += np.diff(np.r_[first, len(row)])
        out[some], grams[some] = total + matrix[1 << BITS], count
    return out, grams


def predict(docs: DataFrame, names: list[str], matrix: np.ndarray, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (the posterior probability of that language) and fit.

    ``fit`` is the text's mean log probability of an n-gram under the language, on a scale from
    that of n-grams never seen (0) to the usual one of the language (1): texts in a language that
    was not learnt have a sure posterior and a low fit. A text that is null, empty or without a
    letter gets ``und``, 0.0 and 0.0, as does every text if no language was learnt. Ties go to
    the language first in order. Repeated rows are scored one by one, whole; an empty table gives
    no rows. Columns of these names are replaced.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((names, matrix))

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known, logs = shared.value
        for batch in texts:
            values = [None if x is None or x is pd.NA else x for x in batch]
            if not known:
                yield pd.DataFrame({"lang_pred": ["und"] * len(values), "score": 0.0, "fit": 0.0})
                continue
            total, grams = score_texts(values, logs)
            blank = np.isnan(total[:, 0])
            total[blank] = 0
            best = total.argmax(axis=1)
            share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            never, usual = logs[: 1 << BITS].min(axis=0)[best], logs[-1][best]
            mean = (total.max(axis=1) - logs[-2][best]) / np.maximum(grams, 1)
            fit = np.clip((mean - never) / (usual - never), 0, None)
            yield pd.DataFrame({"lang_pred": ["und" if b else known[k] for b, k in zip(blank, best, strict=True)], "score": np.where(blank, 0.0, share), "fit": np.where(blank, 0.0, fit)})

    found = F.pandas_udf(tidy(run), "lang_pred string, score double, fit double")(F.col(text))
    own = [c for c in docs.columns if c not in ("lang_pred", "score", "fit")]
    return docs.select(*own, found.alias("__found")).select(*own, "__found.lang_pred", "__found.score", "__found.fit")


def held_out(id: str = "doc_id") -> F.Column:
    return F.crc32(F.col(id).cast("string").cast("binary")) % 4 == 2


def op1_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learnt from rows that are not held out; a null id is not held out."""
    docs = table(spark, sf_dir, "documents")
    names, matrix = fit(docs.where(~F.coalesce(held_out(), F.lit(False))))
    found = predict(docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text"), names, matrix)
    return found.select("doc_id", "held_out", "lang_pred", "score")
