"""Language-model scores: context-tree weighting over bytes, and a unigram base score.

Every byte is eight binary decisions. The contexts of a decision are the 0 to 3 bytes before it,
and a Krichevsky-Trofimov estimate belongs to every (context, decision). Context-tree weighting
mixes the estimates of all depths: a context stops or goes deeper with equal prior weight, and
the training data say how much either explains.

Spark counts all four-byte strings of the training texts. The ``CONTEXTS`` most frequent three-byte
contexts and all shorter ones are broadcast (rows of 256 numbers, of a fixed largest size). All other
three-byte contexts belong to the same tree: tasks work out what they add to their parents and then
their rows, which lie in a stored table and are joined to the bytes that need them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import LOWER, bitmap, fold, pieces, record, signed, split_words, stored, word_hashes
from footfall.session import scratch

DEPTH = 3
CONTEXTS = 1 << 16  # deepest contexts that are broadcast; the table is at most 2 * CONTEXTS kB. The others are joined
FREQUENT = 1 << 18  # words whose counts are broadcast (4 MB); the others are joined
EDGE = 0xFF  # never a byte of UTF-8: stands before and after a text

_FLUSH = 4 << 20  # distinct strings a counting task holds before it merges them


def _strings(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every byte of every lower-cased text, and its end, with the three bytes before it: as one number. And the first number of each text."""
    count = len(offsets) - 1
    lengths = np.diff(offsets)
    starts = offsets[:-1] + DEPTH * (np.arange(count) + 1)
    line = np.full(len(data) + DEPTH * (count + 1), EDGE, np.uint8)
    line[np.arange(len(data)) + np.repeat(starts - offsets[:-1], lengths)] = LOWER[data]
    wide = line.astype(np.uint32)
    codes = wide[:-3] << np.uint32(24) | wide[1:-2] << np.uint32(16) | wide[2:-1] << np.uint32(8) | wide[3:]
    firsts = np.concatenate([[0], np.cumsum(lengths + 1)])
    place = np.arange(firsts[-1]) + np.repeat(starts - DEPTH - firsts[:-1], lengths + 1)
    return codes[place], firsts[:-1]


_COUNTS = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("n", pa.int64())])
_STRING, _WORD, _TEXT, _TOKEN = range(4)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(inverse, weights=np.concatenate([n for _, n in parts])).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's byte strings and words, its texts and its words in total."""
    held: dict[int, list] = {_STRING: [], _WORD: []}
    texts = words = 0
    for batch in batches:
        for row, end, data, offsets in pieces(batch.column("text")):
            texts += end - row
            starts, ends, _ = split_words(data := LOWER[data], offsets)
            words += len(starts)
            for kind, found in ((_STRING, _strings(data, offsets)[0]), (_WORD, signed(word_hashes(data, starts, ends)))):
                held[kind].append(np.unique(found, return_counts=True))
                if len(held[kind]) > 1 and sum(len(k) for k, _ in held[kind][1:]) > max(_FLUSH, len(held[kind][0][0])):
                    held[kind] = [_merged(held[kind])]
    for kind, parts in held.items():
        if parts:
            keys, counts = _merged(parts)
            for at in range(0, len(keys), 1 << 17):
                part = keys[at : at + (1 << 17)].astype(np.int64)
                yield record(_COUNTS, kind=np.full(len(part), kind, np.int32), key=part, n=counts[at : at + (1 << 17)])
    yield record(_COUNTS, kind=[_TEXT, _TOKEN], key=[0, 0], n=[texts, words])


class Tree(NamedTuple):
    """``logs`` holds log10 P(byte) for each context row; ``contexts[d]`` are the sorted contexts of depth d, ``rows[d]`` their rows."""

    logs: np.ndarray
    contexts: list[np.ndarray]
    rows: list[np.ndarray]


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, after moving the argument up by seven."""
    shift = np.ones_like(x)
    for i in range(7):
        shift *= x + i
    y = x + 7
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(shift)


def _decisions(counts: np.ndarray) -> np.ndarray:
    """Byte counts (row, 256) -> counts of zero and one at the decisions 1 to 255, (row, 256, 2); decision 0 is unused."""
    sums = np.zeros((len(counts), 512))
    sums[:, 256:] = counts
    for node in range(255, 0, -1):
        sums[:, node] = sums[:, 2 * node] + sums[:, 2 * node + 1]
    out = np.stack([sums[:, 0::2], sums[:, 1::2]], axis=2)
    out[:, 0] = 0
    return out


def _log_estimate(n: np.ndarray) -> np.ndarray:
    """The log of the Krichevsky-Trofimov probability of the counts."""
    half = 0.5723649429247001  # log gamma of one half
    return _log_gamma(n[..., 0] + 0.5) + _log_gamma(n[..., 1] + 0.5) - 2 * half - _log_gamma(n.sum(axis=-1) + 1)


def _byte_logs(one: np.ndarray) -> np.ndarray:
    """Probabilities of a one at decisions 1 to 255, (row, 256) -> log10 of the probability of each byte."""
    logs = np.zeros((len(one), 512))
    yes, no = np.log10(np.maximum(one, 1e-300)), np.log10(np.maximum(1 - one, 1e-300))
    for node in range(1, 256):
        logs[:, 2 * node] = logs[:, node] + no[:, node]
        logs[:, 2 * node + 1] = logs[:, node] + yes[:, node]
    return logs[:, 256:].astype(np.float32)


_CHUNK = 2048  # contexts worked on at once


class Level(NamedTuple):
    """Contexts of one length, sorted, and the bytes that follow each, with exact counts (as doubles, whole up to 2^53)."""

    contexts: np.ndarray
    first: np.ndarray  # entry of each context, and the number of entries
    byte: np.ndarray
    n: np.ndarray

    @classmethod
    def of(cls, context: np.ndarray, byte: np.ndarray, n: np.ndarray) -> Level:
        order = np.argsort(context, kind="stable")
        contexts, first = np.unique(context[order], return_index=True)
        return cls(contexts, np.append(first, len(context)), byte[order], n[order].astype(np.float64))

    def cells(self, start: int, end: int) -> np.ndarray:
        """Counts of all bytes after the contexts of a range, (context, 256)."""
        end = min(end, len(self.contexts))
        out = np.zeros((end - start, 256))
        part = slice(self.first[start], self.first[end])
        row = np.repeat(np.arange(end - start), np.diff(self.first[start : end + 1]))
        out[row, self.byte[part]] = self.n[part]
        return out


class Outer(NamedTuple):
    """The deepest contexts that are not in the last level: the log estimates of all of a parent's, summed up."""

    parents: np.ndarray  # may repeat
    whole: np.ndarray  # (parent, 256)


def build(levels: list[Level]) -> Tree:
    """The tree of contexts of 0 to ``len(levels) - 1`` bytes; see :func:`grow`."""
    return grow(levels)[0]


def _mixed(n: np.ndarray, shares: np.ndarray, weights: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimates of a one from the counts, and those mixed with what the shallower contexts give."""
    total = n.sum(axis=-1)
    own = (n[..., 1] + 0.5) / (total + 1)
    if shares is None:
        shares, weights, ends = np.zeros_like(own), np.ones_like(own), own
    return own, np.where(total > 0, shares + weights * own, ends)


def grow(levels: list[Level], outer: Outer | None = None) -> tuple[Tree, tuple[np.ndarray, ...] | None]:
    """The tree, and what the contexts above the deepest ones pass on to those (none without any).

    With ``outer`` the last level and it hold all contexts of that depth between them.

    The last byte of a context is its lowest; the parent lacks the highest. A context is in
    ``levels`` only if its parent is. For a path that ends at depth d the estimates of depth k < d
    get the weight ``stop`` of k times what the shallower ones leave; depth d gets the rest. Where
    a context has not met a decision, the path ends at its parent.
    """
    depth = len(levels) - 1
    parents = [np.searchsorted(levels[d - 1].contexts, levels[d].contexts & ((1 << 8 * (d - 1)) - 1)) if d else None for d in range(depth + 1)]
    # Upwards: the probability of the data below each context, and the weight of stopping there.
    stop: list[np.ndarray] = [np.empty(0)] * depth
    below = [np.zeros((len(level.contexts), 256)) for level in levels[:depth]]
    rest = [_decisions(level.cells(0, len(level.contexts))) for level in levels[:depth]]
    for d in range(depth, -1, -1):
        if d == depth - 1 and outer is not None:
            np.add.at(below[d], np.searchsorted(levels[d].contexts, outer.parents), outer.whole)
            rest[d][:] = 0
        if d < depth:
            stop[d] = np.empty_like(below[d])
        for at in range(0, len(levels[d].contexts), _CHUNK):
            part = slice(at, at + _CHUNK)
            n = _decisions(levels[d].cells(at, at + _CHUNK))
            whole = own = _log_estimate(n)
            if d < depth:
                # What contexts outside of the tree have counted is one more child.
                deeper = below[d][part] + _log_estimate(rest[d][part])
                whole = np.logaddexp(own, deeper) - np.log(2)
                stop[d][part] = np.exp(own - np.log(2) - whole)
            if d:
                np.add.at(below[d - 1], parents[d][part], whole)
                np.subtract.at(rest[d - 1], parents[d][part], n)
    # Downwards: sums over the shallower depths, and what they leave.
    logs, rows, first = [], [], 0
    above = None
    for d in range(depth + 1):
        kept = []
        for at in range(0, len(levels[d].contexts), _CHUNK):
            part = slice(at, at + _CHUNK)
            n = _decisions(levels[d].cells(at, at + _CHUNK))
            shares, weights, ends = (x[parents[d][part]] for x in above) if d else (None, None, None)
            own, mixed = _mixed(n, shares, weights, ends)
            logs.append(_byte_logs(mixed))
            if d < depth:
                going = stop[d][part]
                if d == 0:
                    shares, weights = np.zeros_like(own), np.ones_like(own)
                kept.append((shares + weights * going * own, weights * (1 - going), mixed))
        if d < depth:
            above = tuple(np.concatenate(x) for x in zip(*kept, strict=True))
        rows.append(first + np.arange(len(levels[d].contexts), dtype=np.int32))
        first += len(levels[d].contexts)
    return Tree(np.concatenate(logs), [level.contexts for level in levels], rows), above


_OUTER = pa.schema([("parent", pa.int64()), ("state", pa.list_(pa.float64()))])
_TAILS = pa.schema([("context", pa.int64()), ("logs", pa.list_(pa.float32()))])


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A matrix as a column of lists, one for each row."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32()), pa.array(values.ravel(), kind))


def _outer_counts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
    """Rows (context, found: bytes with counts) as ranges with their counts at all decisions."""
    for at in range(0, batch.num_rows, _CHUNK):
        found = batch.column("found").slice(at, _CHUNK)
        cells = np.zeros((len(found), 256))
        row = np.repeat(np.arange(len(found)), np.diff(found.offsets.to_numpy()))
        pairs = found.flatten()
        cells[row, pairs.field("byte").to_numpy()] = pairs.field("n").to_numpy()
        yield at, at + len(found), _decisions(cells)


def _outer_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parent = batch.column("parent").to_numpy()
        for at, end, n in _outer_counts(batch):
            parents, inverse = np.unique(parent[at:end], return_inverse=True)
            sums = np.zeros((len(parents), 256))
            np.add.at(sums, inverse, _log_estimate(n))
            yield record(_OUTER, parent=parents, state=_lists(sums, pa.float64()))


def _outer_logs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, end, n in _outer_counts(batch):
            above = batch.column("state").slice(at, end - at).flatten().to_numpy().reshape(-1, 3, 256)
            mixed = _mixed(n, above[:, 0], above[:, 1], above[:, 2])[1]
            yield record(_TAILS, context=batch.column("context")[at:end], logs=_lists(_byte_logs(mixed), pa.float32()))


class Maps(NamedTuple):
    two: np.ndarray  # row of every two-byte context (of the deepest one in the tree)
    block: np.ndarray  # for every two-byte context its block of three-byte ones; block 0 is empty
    three: np.ndarray  # rows by block and third byte, -1 where a context is not in the tree


def row_maps(tree: Tree) -> Maps:
    two = np.zeros(1 << 16, np.int32)
    if len(tree.contexts) > 1:
        byte = np.zeros(256, np.int32)
        byte[tree.contexts[1]] = tree.rows[1]
        two[:] = np.tile(byte, 256)
        two[tree.contexts[2]] = tree.rows[2]
    block = np.zeros(1 << 16, np.int32)
    if len(tree.contexts) <= 3:
        return Maps(two, block, np.full((1, 256), -1, np.int32))
    parents, number = np.unique(tree.contexts[3] & 0xFFFF, return_inverse=True)
    block[parents] = 1 + np.arange(len(parents))
    three = np.full((1 + len(parents), 256), -1, np.int32)
    three[1 + number, tree.contexts[3] >> 16] = tree.rows[3]
    return Maps(two, block, three)


def byte_scores(tree: Tree, maps: Maps, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """log10 P of every text, its end included, by a tree that holds all contexts."""
    return _byte_scores(tree, maps, np.zeros(0, np.uint64), data, offsets)[0]


def _byte_scores(
    tree: Tree, maps: Maps, outer: np.ndarray, data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """log10 P of every text without the bytes after contexts in the set ``outer``; and those: text, string and how often."""
    codes, firsts = _strings(data, offsets)
    near = codes >> np.uint32(8) & np.uint32(0xFFFF)
    row = maps.three[maps.block[near], codes >> np.uint32(24)]
    away = np.flatnonzero(row < 0)
    row[away] = maps.two[near[away]]
    values = tree.logs[row, codes & np.uint32(0xFF)]
    if len(outer):
        context = (codes[away] >> np.uint32(8)).astype(np.uint64)
        away = away[(outer[context >> np.uint64(6)] >> (context & np.uint64(63))) & np.uint64(1) == 1]
    else:
        away = away[:0]
    values[away] = 0
    text = np.searchsorted(firsts, away, side="right") - 1
    pairs, times = np.unique(text.astype(np.int64) << 32 | codes[away].astype(np.int64), return_counts=True)
    return np.add.reduceat(values, firsts, dtype=np.float64), pairs >> 32, pairs & 0xFFFFFFFF, times


class Model(NamedTuple):
    tree: Tree
    words: np.ndarray  # sorted hashes of the most frequent words
    counts: np.ndarray
    texts: int  # training texts: the count of the end token
    tokens: int
    distinct: int
    outer: np.ndarray  # bits of the three-byte contexts outside of the broadcast tree; empty if there are none
    tails: str  # folder of the table of their rows


def fit(docs: DataFrame, learn: Column) -> tuple[Model, DataFrame]:
    """The model, and the stored counts (``word``, ``n``) of all words. Learns from all rows where ``learn`` holds; null texts are empty."""
    counted = docs.where(learn).select("text").mapInArrow(_count, "kind int, key long, n long")
    counted = stored(counted.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    totals = {r.kind: r.n for r in counted.where(F.col("kind").isin(_TEXT, _TOKEN)).collect()}
    words = counted.where(F.col("kind") == _WORD).select(F.col("key").alias("word"), "n")
    strings = counted.where(F.col("kind") == _STRING).select(F.shiftright("key", 8).alias("context"), (F.col("key").bitwiseAND(255)).alias("byte"), "n")
    levels, outer, tails = [], np.zeros(0, np.uint64), ""
    summed = deepest = None
    for d in range(DEPTH + 1):
        own = strings.withColumn("context", F.col("context").bitwiseAND((1 << 8 * d) - 1))
        if d == DEPTH:
            kept = own.groupBy("context").agg(F.sum("n").alias("all")).orderBy(F.desc("all"), "context").limit(CONTEXTS).select("context")
            kept = F.broadcast(stored(kept, "contexts"))  # at most CONTEXTS numbers
            deepest = (
                own.join(kept, "context", "left_anti")
                .groupBy(F.col("context").bitwiseAND((1 << 8 * (d - 1)) - 1).alias("parent"), "context")
                .agg(F.sort_array(F.collect_list(F.struct("byte", "n"))).alias("found"))  # at most 256
            )
            own = own.join(kept, "context")
        table = own.groupBy("context", "byte").agg(F.sum("n").alias("n")).toArrow()
        context, byte, n = (table[c].to_numpy() for c in ("context", "byte", "n"))
        if not len(context):
            if d:
                break
            context, byte, n = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1)
        levels.append(Level.of(context, byte, n))
        if d == DEPTH:
            deepest = stored(deepest, "deepest")
            sums = deepest.repartition("parent").sortWithinPartitions("parent", "context").mapInArrow(_outer_sums, "parent long, state array<double>")
            sums = sums.toArrow()  # a few rows for each of at most 2^16 parents
            if sums.num_rows:
                summed = Outer(sums["parent"].to_numpy(), sums["state"].combine_chunks().flatten().to_numpy().reshape(-1, 256))
    tree, above = grow(levels, summed)
    if summed is not None:
        spark = docs.sparkSession
        parents = np.unique(summed.parents)
        at = np.searchsorted(levels[DEPTH - 1].contexts, parents)
        states = pa.table([pa.array(parents), _lists(np.concatenate([x[at] for x in above], axis=1), pa.float64())], schema=_OUTER)
        tails = scratch(spark, "tails")
        # One row of 768 numbers for each of at most 2^16 parents, on the disk before they are joined.
        states = stored(spark.createDataFrame(states), "states")
        deepest.join(states, "parent").mapInArrow(_outer_logs, "context long, logs array<float>").write.parquet(tails)
        outer = bitmap(deepest.select(F.shiftleft("context", 64 - 8 * DEPTH).alias("slot")), "slot", 8 * DEPTH)
    top = words.orderBy(F.desc("n"), "word").limit(FREQUENT).toArrow()
    order = np.argsort(top["word"].to_numpy())
    model = Model(
        tree, top["word"].to_numpy()[order], top["n"].to_numpy()[order], totals.get(_TEXT, 0),
        totals.get(_TOKEN, 0) + totals.get(_TEXT, 0), words.count() + (totals.get(_TEXT, 0) > 0), outer, tails,
    )
    return model, words


_SCORED = pa.schema([
    ("row", pa.int64()), ("word", pa.int64()), ("string", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()),
    ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("n", pa.int64()),
])


def _log_share(counts, model: Model):
    return np.log10((counts + 1) / (model.tokens + model.distinct + 1))


def scores(docs: DataFrame, model: Model, words: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score and bits_per_byte of every whole text.

    A task scores its texts with the frequent words it holds, and writes one row for every other
    word of a text, and for every string after a context outside of the broadcast tree; those meet
    their counts and rows in joins and are summed up per text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        maps = row_maps(model.tree)
        gain = _log_share(model.counts, model)
        end_gain = float(_log_share(model.texts, model))
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for row, end, data, offsets in pieces(batch.column("text")):
                size = end - row
                starts, ends, pointers = split_words(low := LOWER[data], offsets)
                found, inverse = np.unique(signed(word_hashes(low, starts, ends)), return_inverse=True)
                place = np.minimum(np.searchsorted(model.words, found), max(len(model.words) - 1, 0))
                known = model.words[place] == found if len(model.words) else np.zeros(len(found), bool)
                value = np.where(known, gain[place], 0.0) if len(gain) else np.zeros(len(found))
                owner = np.repeat(np.arange(size), np.diff(pointers))
                own = known[inverse]
                base = np.bincount(owner, weights=value[inverse], minlength=size) + end_gain
                n_known = np.bincount(owner, weights=own, minlength=size).astype(np.int64) + (model.texts > 0)
                rows = number + np.arange(size)
                number += size
                score, text, string, count = _byte_scores(model.tree, maps, model.outer, data, offsets)
                unset = pa.nulls(size, pa.int64())
                yield record(
                    _SCORED, row=rows, word=unset, string=unset, doc_id=batch.column("doc_id")[row:end],
                    n_tokens=np.diff(pointers) + 1, n_known=n_known, base_score=base,
                    score=score, n=np.diff(offsets) + 1,
                )
                pairs, times = np.unique(owner[~own] * len(found) + inverse[~own], return_counts=True)
                none = pa.nulls(len(pairs), pa.int64())
                real = pa.nulls(len(pairs), pa.float64())
                yield record(
                    _SCORED, row=rows[pairs // max(len(found), 1)], word=found[pairs % max(len(found), 1)], string=none, doc_id=none,
                    n_tokens=none, n_known=none, base_score=real, score=real, n=times,
                )
                if len(string):
                    none, real = pa.nulls(len(string), pa.int64()), pa.nulls(len(string), pa.float64())
                    yield record(
                        _SCORED, row=rows[text], word=none, string=string, doc_id=none,
                        n_tokens=none, n_known=none, base_score=real, score=real, n=count,
                    )

    kinds = "row long, word long, string long, doc_id long, n_tokens long, n_known long, base_score double, score double, n long"
    everything = stored(docs.select("doc_id", "text").mapInArrow(run, kinds), "scores")
    rest = everything.where("word is not null").select("row", "word", F.col("n").alias("times"))
    gain = F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(float(model.tokens + model.distinct + 1)))
    more = rest.join(words, "word", "left").select(
        "row", (F.col("times") * gain).alias("more"), F.when(F.col("n").isNotNull(), F.col("times")).alias("more_known"), F.lit(None).cast("double").alias("more_score")
    )
    if model.tails:
        strings = everything.where("string is not null").select("row", "string", F.shiftright("string", 8).alias("context"), F.col("n").alias("times"))
        tails = docs.sparkSession.read.schema("context long, logs array<float>").parquet(model.tails)
        value = F.get("logs", F.col("string").bitwiseAND(255).cast("int")).cast("double")
        more = more.unionByName(strings.join(tails, "context").select("row", (F.col("times") * value).alias("more_score")), allowMissingColumns=True)
    summed = more.groupBy("row").agg(*(F.sum(c).alias(c) for c in ("more", "more_known", "more_score")))
    zero = F.lit(0)
    return (
        everything.where("word is null and string is null")
        .drop("word", "string")
        .join(summed, "row", "left")
        .withColumn("score", F.col("score") + F.coalesce("more_score", F.lit(0.0)))
        .select(
            "doc_id",
            "n_tokens",
            (F.col("n_known") + F.coalesce("more_known", zero)).alias("n_known"),
            (F.col("base_score") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
            "score",
            (-F.col("score") * math.log2(10) / F.col("n")).alias("bits_per_byte"),
        )
    )


def score(docs: DataFrame, folds: int = 7, held: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte of every document.

    ``bits_per_byte`` is the code length by the tree for a byte of the text, its end counted as one.

    Learns from documents whose crc32(doc_id) modulo ``folds`` is not ``held``. Null texts are empty
    and have one token, the end. With nothing to learn from, every decision has probability one
    half and the base share is 1. A null doc_id is scored, and neither learned from nor held out.
    Repeated rows are learned from as often as they occur and get equal scores. Other columns are
    not looked at. Words are told apart by a 64-bit hash.
    """
    remainder = fold("doc_id", folds)
    model, words = fit(docs, remainder != held)
    found = scores(docs, model, words)
    return found.select(
        "doc_id",
        F.coalesce(remainder == held, F.lit(False)).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        "bits_per_byte",
    )
