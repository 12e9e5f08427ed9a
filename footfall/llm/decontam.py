"""Benchmark decontamination with spaced seeds: overlaps that tolerate substituted words.

A mask looks at some words of a short span and ignores the others, so equal hashes under a mask
can differ in the ignored words. The masks are chosen so that every stretch of 12 to 16 words
with a fifth of them substituted still has one mask, somewhere, that sees only equal words.
Hits are verified word by word around the hit.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import LOWER, MARKS, bitmap, frugal, in_bitmap, mix, owners, pieces, record, signed, split_words, word_hashes

# A one is a word that is compared.
MASKS = ("110101011", "11100001101", "1111011")

STRETCH = 16  # words compared around a hit; a shorter item is compared whole
SHORTEST = 12  # items with fewer words must stand in a document whole and unchanged
TOLERATED = 0.2  # share of a stretch's words that may differ
FILTER_BITS = 26  # an 8 MB set of the benchmark's hashes; beyond its capacity more hits fail the join

_SIDE = STRETCH - 1  # words kept on either side of a hit
_SEEDS = pa.schema([
    ("h", pa.int64()), ("id", pa.int64()), ("tie", pa.int64()), ("pos", pa.int32()), ("lead", pa.int32()),
    ("total", pa.int32()), ("words", pa.list_(pa.int32())),
])
_SEEDS_SQL = "h long, id long, tie long, pos int, lead int, total int, words array<int>"
_FOUND = pa.schema([
    ("id", pa.int64()), ("tie", pa.int64()), ("item_id", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("matched", pa.int32()), ("compared", pa.int32()),
])


def _seeds(words: np.ndarray, pointers: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Per mask: the first word of each place where its span fits into one text, the hash there, and the span."""
    text = owners(pointers)
    for number, mask in enumerate(MASKS):
        span = len(mask)
        if len(words) < span:
            continue
        first = np.flatnonzero(text[: len(words) - span + 1] == text[span - 1 :])
        value = np.full(len(first), number + 1, np.uint64)
        for i, bit in enumerate(mask):
            if bit == "1":
                value = value * np.uint64(0x9E3779B97F4A7C15) + words[first + i]
        yield first, mix(value), span


def _wholes(words: np.ndarray, pointers: np.ndarray, sizes: Sequence[int]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """The same for runs of words, all of them compared, of the given sizes."""
    text = owners(pointers)
    for size in sizes:
        if len(words) >= size:
            first = np.flatnonzero(text[: len(words) - size + 1] == text[size - 1 :])
            value = np.full(len(first), 100 + size, np.uint64)
            for i in range(size):
                value = value * np.uint64(0x9E3779B97F4A7C15) + words[first + i]
            yield first, mix(value), size


def _hits(batches: Iterator[pa.RecordBatch], id_name: str, wanted: np.ndarray | None, sizes: Sequence[int]) -> Iterator[pa.RecordBatch]:
    """A row for every seed (that is in ``wanted``), with the words around it as 32-bit hashes.

    ``sizes`` are those of short items. Without ``wanted`` the texts are items: a short one is taken
    whole, a longer one under the masks.
    """
    for batch in batches:
        for row, end, data, offsets in pieces(batch.column("text")):
            data = LOWER[data]
            starts, ends, pointers = split_words(data, offsets, MARKS)
            words = word_hashes(data, starts, ends)
            small = (words >> np.uint64(32)).astype(np.uint32).view(np.int32)
            text = owners(pointers)
            counts = np.diff(pointers)
            masked = ((*seed, False) for seed in _seeds(words, pointers))
            wholes = ((*seed, True) for seed in _wholes(words, pointers, sizes))
            for first, value, span, whole in itertools.chain(masked, wholes):
                total = counts[text[first]]
                if wanted is not None:
                    good = in_bitmap(wanted, value, FILTER_BITS)
                else:
                    good = total == span if whole else total >= SHORTEST
                first, value = first[good], value[good]
                own = text[first]
                low = np.maximum(first - _SIDE, pointers[own])
                high = np.minimum(first + span + _SIDE, pointers[own + 1])
                for at in range(0, len(first), 20_000):
                    part = slice(at, at + 20_000)
                    widths = (high - low)[part]
                    borders = np.concatenate([[0], np.cumsum(widths)])
                    inner = np.arange(borders[-1]) - np.repeat(borders[:-1], widths) + np.repeat(low[part], widths)
                    pick = pa.array(own[part])
                    yield record(
                        _SEEDS, h=signed(value[part]), id=batch.column(id_name)[row:end].take(pick), tie=batch.column("tie")[row:end].take(pick),
                        pos=(first - pointers[own])[part].astype(np.int32), lead=(first - low)[part].astype(np.int32),
                        total=counts[own][part].astype(np.int32),
                        words=pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(small[inner])),
                    )


def stretch(total: int) -> tuple[int, int]:
    """Words compared for an item of ``total`` words, and how many of them must be equal."""
    size = min(STRETCH, total)
    return size, size - int(TOLERATED * size) if total >= SHORTEST else size


_WIDTH = 2 * _SIDE + max(map(len, MASKS)) + SHORTEST  # words on either side of a hit, and its span


def _aligned(words: pa.Array, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One row of words per hit, the hit's first word in column ``_SIDE``; and where there are words."""
    offsets = words.offsets.to_numpy() - words.offsets[0].as_py()
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(len(sizes)), sizes)
    column = np.arange(offsets[-1]) - np.repeat(offsets[:-1] + lead, sizes) + _SIDE
    out, there = np.zeros((len(sizes), _WIDTH), np.int32), np.zeros((len(sizes), _WIDTH), bool)
    out[row, column] = words.flatten().to_numpy()
    there[row, column] = True
    return out, there


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stretches around each hit in which enough words are equal. All hits of a batch are compared together."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x, x_there = _aligned(batch.column("words"), batch.column("lead").to_numpy())
        y, y_there = _aligned(batch.column("item_words"), batch.column("item_lead").to_numpy())
        both = x_there & y_there
        none = np.zeros((len(x), 1), np.int32)
        equal = np.concatenate([none, np.cumsum(both & (x == y), axis=1)], axis=1)
        inside = np.concatenate([none, np.cumsum(both, axis=1)], axis=1)
        pos, totals = batch.column("pos").to_numpy(), batch.column("item_total").to_numpy()
        for total in np.unique(np.minimum(totals, STRETCH)).tolist():
            rows = np.flatnonzero(np.minimum(totals, STRETCH) == total)
            size, needed = stretch(total)
            matched = equal[rows, size:] - equal[rows, :-size]
            good = (matched >= needed) & (inside[rows, size:] - inside[rows, :-size] == size)
            hit = np.flatnonzero(good.any(axis=1))
            if not len(hit):
                continue
            rows, good, matched = rows[hit], good[hit], matched[hit]
            first = good.argmax(axis=1)
            last = good.shape[1] - 1 - good[:, ::-1].argmax(axis=1) + size - 1
            pick = pa.array(rows)
            yield record(
                _FOUND, id=batch.column("id").take(pick), tie=batch.column("tie").take(pick), item_id=batch.column("item_id").take(pick),
                first=pos[rows] + first - _SIDE, last=pos[rows] + last - _SIDE, matched=np.where(good, matched, 0).max(axis=1),
                compared=np.full(len(rows), size, np.int32),
            )


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for every document and benchmark item that overlap: doc_id, tie, item_id, first_word, last_word, matched, compared.

    Words are runs of letters and digits, ASCII lower-cased. They overlap if some ``STRETCH`` words
    of the item (all, if it has fewer) stand in the document in one piece, with at most a fifth of
    them substituted; an item under ``SHORTEST`` words must stand there whole and unchanged. ``first_word`` and ``last_word`` enclose all such stretches of the document,
    ``matched`` is the largest number of equal words among the ``compared`` ones. Null
    texts and texts without a word match nothing; null ids are ids like any other.
    Repeated rows give one row; different texts under one doc_id are kept apart by ``tie``, a hash
    of the text. Other columns are not looked at.
    """
    context = docs.sparkSession.sparkContext
    tie = F.xxhash64("text").alias("tie")
    every = range(1, SHORTEST)
    items = benchmark.select("item_id", "text", tie).mapInArrow(frugal(lambda b: _hits(b, "item_id", None, every)), _SEEDS_SQL)
    short = sorted(r.total for r in items.where(F.col("total") < SHORTEST).select("total").distinct().collect())  # fewer than SHORTEST
    wanted = context.broadcast(bitmap(items.select("h"), "h", FILTER_BITS))
    hits = docs.select("doc_id", "text", tie).mapInArrow(frugal(lambda b: _hits(b, "doc_id", wanted.value, short)), _SEEDS_SQL)
    items = items.select(
        "h", F.col("id").alias("item_id"), F.col("lead").alias("item_lead"), F.col("total").alias("item_total"), F.col("words").alias("item_words")
    )
    # Hits, few of the seeds, are shuffled at every size: a task then feeds one Python worker, not one that finds and one that verifies.
    met = hits.join(items.hint("merge"), "h").select("id", "tie", "item_id", "pos", "lead", "words", "item_lead", "item_total", "item_words")
    found = met.mapInArrow(frugal(_verify), "id long, tie long, item_id long, first int, last int, matched int, compared int")
    return found.groupBy(F.col("id").alias("doc_id"), "tie", "item_id").agg(
        F.min("first").alias("first_word"), F.max("last").alias("last_word"), F.max("matched").alias("matched"), F.max("compared").alias("compared")
    )


def keep_unseen(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, with all columns, that overlap no benchmark item."""
    found = overlaps(docs, benchmark).select(F.col("doc_id").alias("id"), F.col("tie").alias("own")).distinct()
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("row.text") == F.col("own"))
    return row.join(found, same, "left_anti").select("row.*")
