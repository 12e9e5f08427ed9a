"""Exact substring dedup: documents are parsed into factors copied from earlier text.

As in relative Lempel-Ziv parsing, a document is factored against an index of the reference, here
the whole collection. The index is cut into blocks by content: every window of ``WINDOW`` words has
an anchor, the smallest hash of its ``SEED``-word strings, and equal windows have equal anchors,
so a window can only have a source in its anchor's block. Blocks with one occurrence hold no
source and are skipped. In the others the windows of each occurrence, as one row of hashes, are
looked up in the order of the documents; a factor runs on while window and source move together.
Where a factor ends, the windows across the boundary are looked up like all others, so another
source there starts its own factor.

A block can hold a large share of all text (a passage that every document quotes). So blocks with
many occurrences are first resolved in parts, the more the larger they are; a window that is a copy
inside its part is settled, and at most one for each part goes on to the block as a whole. All
others are settled at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import bitmap, in_bitmap, owners, pieces, record, signed, split_words, stored, window_hashes, word_hashes

WINDOW = 20
SEED = 8
Cut = tuple[tuple[int, int], ...]
PARTS: Cut = ((1 << 10, 1 << 5), (1 << 15, 1 << 10), (1 << 20, 1 << 15))  # of a block with more occurrences than the first number
FILTER_BITS = 26  # an 8 MB set of anchors; beyond its capacity more windows are looked up in vain
LARGE_BITS = 22  # sets of large blocks' anchors; beyond their capacity more blocks are cut up

_ANCHORS = pa.schema([("anchor", pa.int64()), ("n", pa.int64())])
_OCCURRENCES = pa.schema([("anchor", pa.int64()), ("doc_id", pa.int64()), ("tie", pa.int32()), ("start", pa.int32()), ("parts", pa.int32()), ("hashes", pa.binary())])
_RESOLVED = pa.schema([
    ("anchor", pa.int64()), ("doc_id", pa.int64()), ("tie", pa.int32()), ("start", pa.int32()), ("words", pa.int32()),
    ("hashes", pa.binary()), ("source_id", pa.int64()), ("source_start", pa.int32()),
])
_RESOLVED_SQL = "anchor long, doc_id long, tie int, start int, words int, hashes binary, source_id long, source_start int"
_BYTES = 8  # of a window's hash in a row, beside the 64 bits of its anchor
_KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("kept_sha256", pa.string())])


def _windows(data: np.ndarray, offsets: np.ndarray, size: int, seed: int):
    """Hashes of the words, and of every window inside one text: its first word, text, anchor, and the anchor's place."""
    starts, ends, pointers = split_words(data, offsets)
    words = word_hashes(data, starts, ends)
    if len(words) < size:
        none = np.empty(0, np.int64)
        return words, pointers, none, none, np.empty(0, np.uint64), none
    text = owners(pointers)
    first = np.flatnonzero(text[: len(words) - size + 1] == text[size - 1 :])
    seeds = window_hashes(words, seed)
    span = size - seed + 1
    lowest, width = seeds, 1
    while 2 * width <= span:
        lowest, width = np.minimum(lowest[: len(lowest) - width], lowest[width:]), 2 * width
    lowest = np.minimum(lowest[: len(lowest) - (span - width)], lowest[span - width :])
    anchor = lowest[first]
    place = np.full(len(first), -1)
    for i in range(span - 1, -1, -1):  # the leftmost one wins
        place = np.where(seeds[first + i] == anchor, first + i, place)
    return words, pointers, first, text[first], anchor, place


def _packed(hashes: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Runs of hashes, laid end to end, as one binary value for each run."""
    raw = np.ascontiguousarray(hashes.view(np.uint8).reshape(-1, 8)[:, :_BYTES])
    ends = np.concatenate([[0], np.cumsum(sizes * _BYTES)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw.tobytes())])


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].reshape(-1, _BYTES)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :_BYTES] = raw
    return wide.view(np.uint64).ravel(), np.diff(ends) // _BYTES


class _Earlier:
    """The first occurrences met so far in the block that a batch may go on with."""

    def __init__(self):
        self.key: tuple | None = None
        self.hashes = np.empty(0, np.uint64)
        self.places = np.empty((0, 4), np.int64)  # has id, id, tie, word


def _resolve(batches: Iterator[pa.RecordBatch], size: int, survivors: bool) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (anchor, salt, place) -> factors, and (if wanted) the runs of windows without an earlier one in
    blocks that are cut up. The salt of a whole block is -1."""
    held = _Earlier()
    for batch in batches:
        if not batch.num_rows:
            continue
        anchor, salt = batch.column("anchor").to_numpy(), batch.column("salt").to_numpy()
        group = np.concatenate([[0], np.cumsum((np.diff(anchor) != 0) | (np.diff(salt) != 0))])
        hashes, sizes = _unpacked(batch.column("hashes"))
        ids = batch.column("doc_id")
        place = np.stack([
            np.asarray(ids.is_valid()).astype(np.int64), ids.fill_null(0).to_numpy(), batch.column("tie").to_numpy(),
            batch.column("start").to_numpy().astype(np.int64),
        ], axis=1)
        row = np.repeat(np.arange(len(sizes)), sizes)
        inner = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = place[row]
        at[:, 3] += inner
        block = group[row]
        old = len(held.hashes) if held.key == (anchor[0], salt[0]) else 0
        if old:
            hashes, at = np.concatenate([held.hashes, hashes]), np.concatenate([held.places, at])
            block = np.concatenate([np.zeros(old, np.int64), block])
            row, inner = np.concatenate([np.full(old, -1), row]), np.concatenate([np.full(old, -1), inner])
        order = np.lexsort((hashes, block))  # stable: equal windows stay in the order of their places
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(hashes[order]) != 0) | (np.diff(block[order]) != 0)
        source = np.empty(len(order), np.int64)
        source[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
        first = source == np.arange(len(order))
        # The same row twice (repeated documents) is not earlier than itself.
        first |= (at == at[source]).all(axis=1)
        last = (source == np.arange(len(order))) & (block == block[-1])
        held.key, held.hashes, held.places = (anchor[-1], salt[-1]), hashes[last], at[last]

        move = at[source, 3] - at[:, 3]
        from_ = at[source]
        cut = np.ones(len(row), bool)
        cut[1:] = (np.diff(row) != 0) | (np.diff(first) != 0)
        cut[1:] |= ~first[1:] & ((np.diff(move) != 0) | (from_[1:, :3] != from_[:-1, :3]).any(axis=1))
        begins = np.flatnonzero(cut)
        lengths = np.diff(begins, append=len(row))
        for copied in (True, False) if survivors else (True,):
            wanted = (row[begins] >= 0) & (first[begins] != copied)
            if not copied:
                wanted &= salt[row[begins]] >= 0
            pick, many = begins[wanted], lengths[wanted]
            if not len(pick):
                continue
            rows, none = pa.array(row[pick]), pa.nulls(len(pick), pa.int64())
            own = {"doc_id": ids.take(rows), "tie": batch.column("tie").take(rows), "start": at[pick, 3].astype(np.int32)}
            if copied:
                origin = pa.array(from_[pick, 1], mask=from_[pick, 0] == 0)
                yield record(
                    _RESOLVED, anchor=none, **own, words=(many + size - 1).astype(np.int32), hashes=pa.nulls(len(pick), pa.binary()),
                    source_id=origin, source_start=from_[pick, 3].astype(np.int32),
                )
            else:
                inside = np.repeat(pick, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                yield record(
                    _RESOLVED, anchor=anchor[row[pick]], **own, words=pa.nulls(len(pick), pa.int32()), hashes=_packed(hashes[inside], many),
                    source_id=none, source_start=pa.nulls(len(pick), pa.int32()),
                )


def factors(docs: DataFrame, size: int = WINDOW, seed: int = SEED, cut: Cut = PARTS) -> DataFrame:
    """doc_id, tie, start, words, source_id, source_start: stretches whose every window of ``size`` words starts earlier at the source.

    Earlier is a smaller (doc_id, hash of the text ``tie``), or the same and an earlier start; a
    null doc_id comes first. ``cut`` says above how many occurrences a block is resolved in how many
    parts first; the result does not depend on it. ``tie`` matters only where rows share an id. Windows are told apart by the 64 bits of their anchor and 64 of their own.
    """
    keyed = docs.select("doc_id", "text", F.hash("text").alias("tie"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in pieces(batch.column("text")):
                *_, anchor, place = _windows(data, offsets, size, seed)
                if len(anchor):
                    values, n = np.unique(anchor[np.diff(place, prepend=-1) != 0], return_counts=True)
                    yield record(_ANCHORS, anchor=signed(values), n=n)

    met = keyed.select("text").mapInArrow(count, "anchor long, n long")
    repeated = stored(met.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1"), "anchors")
    large = [bitmap(repeated.where(F.col("n") > most), "anchor", LARGE_BITS) for most, _ in cut]
    shared = docs.sparkSession.sparkContext.broadcast((bitmap(repeated, "anchor", FILTER_BITS), large))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in pieces(batch.column("text")):
                words, pointers, first, text, anchor, place = _windows(data, offsets, size, seed)
                known, large = shared.value
                hit = in_bitmap(known, anchor, FILTER_BITS)
                if not hit.any():
                    continue
                first, text, anchor, place = first[hit], text[hit], anchor[hit], place[hit]
                begins = np.flatnonzero((np.diff(place, prepend=-1) != 0) | (np.diff(first, prepend=-2) != 1))
                pick = pa.array(text[begins])
                parts = np.zeros(len(begins), np.int32)
                for block, (_, number) in zip(large, cut, strict=True):
                    parts[in_bitmap(block, anchor[begins], LARGE_BITS)] = number
                yield record(
                    _OCCURRENCES, anchor=signed(anchor[begins]), doc_id=batch.column("doc_id")[row:end].take(pick),
                    tie=batch.column("tie")[row:end].take(pick), start=(first - pointers[text])[begins].astype(np.int32), parts=parts,
                    hashes=_packed(window_hashes(words, size)[first], np.diff(begins, append=len(first))),
                )

    order = ["anchor", "salt", "doc_id", "tie", "start"]
    columns = [*order, "hashes"]
    met = keyed.mapInArrow(look, "anchor long, doc_id long, tie int, start int, parts int, hashes binary")
    met = met.withColumn("salt", F.expr("if(parts = 0, -1, int(pmod(xxhash64(doc_id, tie), parts)))")).select(*columns)
    parts = met.repartition("anchor", "salt").sortWithinPartitions(*order).mapInArrow(lambda b: _resolve(b, size, True), _RESOLVED_SQL)
    parts = stored(parts, "factors")
    left = parts.where("hashes is not null").withColumn("salt", F.lit(0)).select(*columns)
    rest = left.repartition("anchor").sortWithinPartitions(*order).mapInArrow(lambda b: _resolve(b, size, False), _RESOLVED_SQL)
    return parts.where("hashes is null").union(rest).select("doc_id", "tie", "start", "words", "source_id", "source_start")


def remove(docs: DataFrame, size: int = WINDOW, cut: Cut = PARTS) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the text left, words joined by one space) and kept_sha256 of every document.

    A word is removed if a factor covers it. Null and empty texts have no words. Repeated rows
    (equal id and text) are one document as far as sources go, and each gets the same result.
    A null doc_id comes before all others. Other columns are not looked at.
    """
    spans = factors(docs, size, cut=cut).groupBy("doc_id", "tie").agg(F.collect_list(F.struct("start", "words")).alias("spans"))
    spans = stored(spans.select(F.col("doc_id").alias("id"), F.col("tie").alias("own"), "spans"), "spans")
    keyed = docs.select("doc_id", "text", F.hash("text").alias("tie"))
    # Only texts that can have factors are shuffled to them: a set of documents in 2^18 rows at most.
    members = spans.select(F.shiftrightunsigned(F.xxhash64("id", "own"), 40).alias("slot"))
    members = members.groupBy(F.expr("shiftrightunsigned(slot, 6) as word")).agg(F.expr("bit_or(shiftleft(1L, int(slot & 63))) as bits"))
    slotted = keyed.withColumn("slot", F.shiftrightunsigned(F.xxhash64("doc_id", "tie"), 40))
    marked = slotted.join(F.broadcast(members), F.shiftrightunsigned("slot", 6) == F.col("word"), "left")
    marked = marked.withColumn("maybe", F.expr("coalesce(shiftrightunsigned(bits, int(slot & 63)) & 1 = 1, false)"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("tie") == F.col("own"))
    joined = marked.where("maybe").join(spans, same, "left").select("doc_id", "text", "spans")
    alone = marked.where("not maybe").select("doc_id", "text", F.lit(None).cast(joined.schema["spans"].dataType).alias("spans"))
    joined = joined.union(alone)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in pieces(batch.column("text")):
                raw, out = data.tobytes(), []
                for i, spans in enumerate(batch.column("spans")[row:end].to_pylist()):
                    words = raw[offsets[i] : offsets[i + 1]].split()
                    total, removed = len(words), 0
                    if spans:
                        gone = np.zeros(total + 1, np.int32)
                        for span in spans:
                            gone[span["start"]] += 1
                            gone[span["start"] + span["words"]] -= 1
                        left = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
                        removed, words = total - len(left), [words[j] for j in left]
                    kept = b" ".join(words)
                    out.append((total, removed, kept.decode("utf-8", "replace"), hashlib.sha256(kept).hexdigest()))
                total, removed, kept, digest = zip(*out, strict=True)
                yield record(_KEPT, doc_id=batch.column("doc_id")[row:end], n_words=total, n_removed=removed, kept=kept, kept_sha256=digest)

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")
