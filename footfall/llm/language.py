"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts the n-grams of all labelled texts, one vector of buckets per language and
task, summed by Spark. The matrix of log probabilities has a fixed size (buckets times
languages) and is broadcast; texts are scored in numpy, a batch of n-grams at a time.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import PIECE_BYTES, fold, frugal, pieces, record

NGRAMS = (1, 2, 3)
LOG_BUCKETS = 16
SMOOTHING = 0.5
MAX_LANGUAGES = 256  # bounds the broadcast matrix at 2^16 * 256 floats; of more values the most frequent are learned
UNKNOWN = "und"

_MAYBE_LETTER = re.compile(r"[^\W\d_]")  # also finds superscripts, fractions and the like
_STEPS = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)]  # odd
_BATCH = 1 << 19  # characters scored at once


class Model(NamedTuple):
    languages: list[str]
    prior: np.ndarray  # log probability of each language
    weights: np.ndarray  # log probability of each (bucket, language)


@functools.cache
def _folded() -> np.ndarray:
    """Character code -> the code of its lower-case letter, or a space for anything that is no letter."""
    table = np.full(0x10001, 32, np.uint32)
    for code in range(0x10000):
        if chr(code).isalpha():
            low = chr(code).lower()
            table[code] = ord(low) if len(low) == 1 else code
    table[0x10000] = 0x10000  # characters beyond the basic plane count as one letter
    return table


def has_letter(text: str) -> bool:
    return any(found[0].isalpha() for found in _MAYBE_LETTER.finditer(text))


def ngrams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text of each n-gram, its bucket) in pieces; runs over all n-grams of each text."""
    text = data.tobytes().decode("utf-8", "replace")
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    borders = leads[offsets]
    letters = _folded()[np.minimum(codes, 0x10000)]
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(borders))
    for size in NGRAMS:
        for start in range(0, len(letters) - size + 1, _BATCH):
            end = min(start + _BATCH, len(letters) - size + 1)
            own = owner[start:end]
            inside = own == owner[start + size - 1 : end + size - 1]
            value = np.full(end - start, np.uint32(size * 0x2545F491 & 0xFFFFFFFF))
            filled = np.zeros(end - start, bool)
            for i in range(size):
                part = letters[start + i : end + i]
                filled |= part != 32
                value = (value ^ part) * _STEPS[i]
                value ^= value >> np.uint32(15)
            keep = inside & filled
            yield own[keep], (value[keep] * _STEPS[3]) >> np.uint32(32 - LOG_BUCKETS)


_COUNTS = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per language of a task: the count of every bucket met, and its number of texts as bucket -1."""
    totals: dict[str, np.ndarray] = {}
    size = 1 << LOG_BUCKETS
    for batch in batches:
        for row, end, data, offsets in pieces(batch.column("text")):
            languages = batch.column("lang")[row:end].to_pylist()
            names = sorted(set(languages))
            which = np.array([names.index(x) for x in languages])
            for name in names:
                totals.setdefault(name, np.zeros(size + 1, np.int64))
            for owner, bucket in ngrams(data, offsets):
                cells = np.bincount(which[owner] * size + bucket, minlength=len(names) * size).reshape(len(names), size)
                for i, name in enumerate(names):
                    totals[name][:size] += cells[i]
            for name, count in zip(*np.unique(which, return_counts=True), strict=True):
                totals[names[name]][size] += count
    for name, counts in totals.items():
        met = np.flatnonzero(counts)
        buckets = np.where(met == size, -1, met)
        yield record(_COUNTS, lang=[name] * len(met), bucket=buckets, n=counts[met])


def fit(docs: DataFrame, learn: Column) -> Model:
    """Learn from all rows where ``learn`` holds, with text and lang. No such row: a model without languages.

    Of more than ``MAX_LANGUAGES`` values, only rows of those with most documents are learned from;
    which these are is known before anything is counted.
    """
    rows = docs.where(learn & F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    frequent = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    rows = rows.where(F.col("lang").isin([row["lang"] for row in frequent]))
    summed = rows.mapInArrow(frugal(_count), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = summed.toArrow()
    names = table["lang"].combine_chunks().dictionary_encode()
    languages = names.dictionary.to_pylist()
    size = 1 << LOG_BUCKETS
    counts = np.zeros((size + 1, len(languages)))
    if languages:
        counts[table["bucket"].to_numpy(), names.indices.to_numpy()] = table["n"].to_numpy()  # -1: the last row
    order = np.argsort(languages, kind="stable") if languages else np.empty(0, int)
    counts = counts[:, order]
    smooth = counts[:size] + SMOOTHING
    prior = np.log(counts[size] / max(counts[size].sum(), 1)) if languages else np.empty(0)
    weights = np.log(smooth / smooth.sum(axis=0)).astype(np.float32)
    return Model([languages[i] for i in order], prior, weights)


def log_scores(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The log of prior times likelihood of every (text, language)."""
    total = np.tile(model.prior, (len(offsets) - 1, 1))
    for owner, bucket in ngrams(data, offsets):
        if not len(owner):
            continue
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        total[owner[first]] += np.add.reduceat(model.weights[bucket], first, axis=0, dtype=np.float64)
    return total


def guesses(model: Model, column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, number of the best language or -1 for unknown, its probability), ``limit`` bytes at a time."""
    for row, end, data, offsets in pieces(column, limit):
        if not model.languages:
            yield row, end, np.full(end - row, -1), np.zeros(end - row)
            continue
        scores = log_scores(model, data, offsets)
        best = scores.argmax(axis=1)
        share = 1 / np.exp(scores - scores.max(axis=1, keepdims=True)).sum(axis=1)
        raw = data.tobytes()
        for i in range(end - row):
            if not has_letter(raw[offsets[i] : offsets[i + 1]].decode("utf-8", "ignore")):
                best[i], share[i] = -1, 0.0
        yield row, end, best, share


_PREDICTED = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score (the probability of that language, 0 for ``und``) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            for row, end, best, share in guesses(model, batch.column("text")):
                yield record(_PREDICTED, doc_id=batch.column("doc_id")[row:end], lang_pred=names[best], score=share)

    return docs.select("doc_id", "text").mapInArrow(frugal(run), "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document.

    Learns from the documents whose crc32(doc_id) modulo ``folds`` is not 0 and that have text
    and lang. Null texts and texts without a letter, and all texts if there is nothing to learn
    from, are ``und`` with score 0. Ties go to the language first in alphabetical order. A null
    doc_id belongs to no fold: it is neither learned from nor held out. Repeated rows count as
    often as they occur. Other columns are not looked at.
    """
    remainder = fold("doc_id", folds)
    model = fit(docs, remainder != 0)
    held = F.coalesce(remainder == 0, F.lit(False)).alias("held_out")
    return predict(docs, model).select("doc_id", held, "lang_pred", "score")
