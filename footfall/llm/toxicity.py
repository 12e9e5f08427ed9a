"""Toxicity: a convolutional text classifier, trained and run in numpy.

A word's embedding is the sum of hashed ones, of the whole word and of its first 4 and 8 bytes;
filters of several widths run over the words, each filter keeps its largest answer in the text,
and a logistic layer weighs those. Training starts on a bounded sample of labelled documents; from
there tasks go on over all labelled documents, and what they have learned is averaged. Thresholds
are calibrated on a fifth of all labelled documents per language, where the language is itself read
from the text; the score is shifted so that the threshold lies at one half.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm import language
from footfall.llm.common import LOWER, MARKS, PIECE_BYTES, fold, frugal, give_back, likely, pieces, record, split_words, stored, word_hashes

LOG_WORDS = 15  # hashed vocabulary of words and word beginnings
STEM_BYTES = (4, 8)  # so inflected forms share parts of their embedding
_KINDS = 1 + len(STEM_BYTES)
DIMENSION = 8
WIDTHS = (1, 2, 3)
FILTERS = 6  # of each width
SAMPLE = 3000  # documents of each class that training starts on at most, by the hash of their text
SAMPLE_WORDS = 4000  # longer documents are not sampled; both bound what reaches the driver
BATCH_WORDS = 1 << 17  # a task's batch ends at so many words
EPOCHS = 12
STEPS = 600  # at least so many batches, if the sample is small
BATCH = 64
RATE = 0.05
PENALTY = 1e-4
KEPT = 0.6  # of a text's words, drawn anew in every epoch, so that no word relies on others
MISS = 3.0  # a toxic document let through weighs as much as so many clean ones turned away
PAD = 0  # the bucket of "no word"; its embedding stays zero

_TAIL = max(WIDTHS) - 1


class Model(NamedTuple):
    taps: list[np.ndarray]  # per width: embedding times filter, (tap, bucket, filter)
    bias: np.ndarray
    dense: np.ndarray
    intercept: float
    languages: language.Model
    thresholds: np.ndarray  # logit per language, the last for unknown ones


def buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of every word (a run of letters and digits, ASCII lower-cased), and the words before each text."""
    data = LOWER[data]
    starts, ends, pointers = split_words(data, offsets, MARKS)
    whole = word_hashes(data, starts, ends)
    stems = [word_hashes(data, starts, np.minimum(ends, starts + size)) * np.uint64(2 * size + 1) for size in STEM_BYTES]
    hashed = np.stack([whole, *stems], axis=1) >> np.uint64(64 - LOG_WORDS)
    return np.maximum(hashed.astype(np.int32), 1), pointers


def padded(words: np.ndarray, pointers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts end to end, each followed by padding; the first and past-last window of each text (one at least)."""
    counts = np.diff(pointers)
    spans = np.maximum(counts, 1)
    starts = np.concatenate([[0], np.cumsum(spans + _TAIL)])
    out = np.full((starts[-1], _KINDS), PAD, np.int32)
    shift = np.repeat(starts[:-1] - pointers[:-1], counts)
    out[np.arange(len(words)) + shift] = words
    return out, starts[:-1], starts[:-1] + spans


def _pooled(answers: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The largest answer of each filter in each text."""
    cuts = np.stack([starts, ends], axis=1).ravel()
    if cuts[-1] >= len(answers):
        cuts = cuts[:-1]
    return np.maximum.reduceat(answers, cuts, axis=0)[::2]


def logits(model: Model, words: np.ndarray, pointers: np.ndarray) -> np.ndarray:
    sequence, starts, ends = padded(words, pointers)
    total = np.full(len(starts), model.intercept)
    for i, (width, taps) in enumerate(zip(WIDTHS, model.taps, strict=True)):
        count = len(sequence) - _TAIL
        answers = np.zeros((count, FILTERS), np.float32)
        for t in range(width):
            for k in range(_KINDS):
                answers += taps[t][sequence[t : count + t, k]]
        best = np.maximum(_pooled(answers, starts, ends) + model.bias[i], 0)
        total += best @ model.dense[i * FILTERS : (i + 1) * FILTERS]
    return total


class Net:
    """The parameters in training, with the sums of squared gradients that set AdaGrad's steps."""

    def __init__(self, rng: np.random.Generator):
        self.embedding = rng.normal(0, 0.03, (1 << LOG_WORDS, DIMENSION)).astype(np.float32)
        self.embedding[PAD] = 0
        self.filters = [rng.normal(0, 0.4, (w, DIMENSION, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros((len(WIDTHS), FILTERS), np.float32)
        self.dense = rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
        self.intercept = np.zeros(1, np.float32)
        self.squares = [np.full_like(x, 1e-4) for x in self.all()]
        self.touched = np.zeros(1 << LOG_WORDS)  # batches that moved an embedding

    def all(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, self.bias, self.dense, self.intercept]

    def step(self, k: int, value: np.ndarray, gradient: np.ndarray) -> None:
        self.squares[k] += gradient**2
        value -= RATE * gradient / np.sqrt(self.squares[k])

    def learn(self, texts: list[np.ndarray], labels: np.ndarray, weights: np.ndarray | float, rng: np.random.Generator) -> None:
        """One batch of AdaGrad on the weighted logistic loss. Gradients reach only the windows that won the pooling."""
        embedding, filters, bias, dense, intercept, squares, step = (
            self.embedding, self.filters, self.bias, self.dense, self.intercept, self.squares, self.step,
        )
        drawn = [t[rng.random(len(t)) < KEPT] for t in texts]
        sequence, starts, ends = padded(np.concatenate(drawn), np.concatenate([[0], np.cumsum([len(t) for t in drawn])]))
        vectors, count = embedding[sequence].sum(axis=1), len(sequence) - _TAIL
        winners, pooled = [], []
        for i, width in enumerate(WIDTHS):
            answers = sum(vectors[t : count + t] @ filters[i][t] for t in range(width))
            best = _pooled(answers, starts, ends)
            won = np.stack([s + answers[s:e].argmax(axis=0) for s, e in zip(starts, ends, strict=True)])
            winners.append(won)
            pooled.append(np.maximum(best + bias[i], 0))
        features = np.concatenate(pooled, axis=1)
        guess = 1 / (1 + np.exp(-np.clip(features @ dense + intercept[0], -30, 30)))
        error = ((guess - labels) * weights / len(texts)).astype(np.float32)
        back = np.outer(error, dense) * (features > 0)
        changes = np.zeros((0,), np.int64), np.zeros((0, DIMENSION), np.float32)
        for i, width in enumerate(WIDTHS):
            flow = back[:, i * FILTERS : (i + 1) * FILTERS]
            gradient = np.zeros_like(filters[i])
            for t in range(width):
                hit = sequence[winners[i] + t]  # text, filter, kind of bucket
                gradient[t] = np.einsum("nf,nfd->df", flow, vectors[winners[i] + t])
                moved = np.repeat((flow[:, :, None] * filters[i][t].T[None]).reshape(-1, DIMENSION), _KINDS, axis=0)
                changes = np.concatenate([changes[0], hit.ravel()]), np.concatenate([changes[1], moved])
            step(1 + i, filters[i], gradient + PENALTY * filters[i])
        rows, inverse = np.unique(changes[0], return_inverse=True)
        summed = np.zeros((len(rows), DIMENSION), np.float32)
        np.add.at(summed, inverse, changes[1])
        squares[0][rows] += summed**2
        embedding[rows] -= RATE * summed / np.sqrt(squares[0][rows])
        embedding[PAD] = 0
        k = 1 + len(WIDTHS)
        step(k, bias, np.stack([back[:, i * FILTERS : (i + 1) * FILTERS].sum(axis=0) for i in range(len(WIDTHS))]))
        step(k + 1, dense, features.T @ error + PENALTY * dense)
        step(k + 2, intercept, error.sum(keepdims=True))
        self.touched[rows] += 1

    def taps(self) -> list[np.ndarray]:
        return [np.stack([self.embedding @ self.filters[i][t] for t in range(w)]).astype(np.float32) for i, w in enumerate(WIDTHS)]


def train(net: Net, texts: list[np.ndarray], labels: np.ndarray, rng: np.random.Generator) -> None:
    """Minibatches over a sample, in several epochs."""
    for _ in range(max(EPOCHS, -(-STEPS * BATCH // len(texts)))):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            net.learn([texts[i] for i in chosen], labels[chosen], 1.0, rng)


_PARTS = pa.schema([("part", pa.int32()), ("moved", pa.list_(pa.float64()))])
_BLOCKS = 64  # of embeddings, that are averaged apart


def _refine(batches: Iterator[pa.RecordBatch], start: Net, balance: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Train on all documents of a task once, from a common start; gives the moves and the weights to average them by.

    An embedding counts as often as it was moved, so words of few tasks are not diluted by the others; all else counts by documents.
    """
    net, rng, count = copy.deepcopy(start), np.random.default_rng(TaskContext.get().partitionId()), 0
    net.touched[:] = 0
    texts, marks, held = [], [], 0

    def flush() -> None:
        nonlocal held
        labels = np.array(marks)
        net.learn(texts, labels, balance[labels], rng)
        texts.clear(), marks.clear()
        held = 0

    for batch in batches:
        toxic = batch.column("toxic").to_numpy()
        for row, end, data, offsets in pieces(batch.column("text")):
            words, pointers = buckets(data, offsets)
            for i in range(end - row):
                texts.append(words[pointers[i] : pointers[i + 1]])
                marks.append(toxic[row + i])
                held += len(texts[-1])
                count += 1
                if len(texts) == BATCH or held >= BATCH_WORDS:
                    flush()
    if texts:
        flush()
    if not count:
        return
    moves = [(b - a).astype(np.float64) for a, b in zip(start.all(), net.all(), strict=True)]
    blocks = zip(np.split(moves[0], _BLOCKS), np.split(net.touched, _BLOCKS), strict=True)
    parts = [np.concatenate([(move * times[:, None]).ravel(), times]) for move, times in blocks]
    parts.append(np.concatenate([x.ravel() * count for x in moves[1:]] + [[count]]))
    for part, moved in enumerate(parts):
        yield record(_PARTS, part=[part], moved=[moved])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, moved in zip(batch.column("part").to_pylist(), batch.column("moved"), strict=True):
            sums[part] = sums.get(part, 0) + moved.values.to_numpy()
    for part, moved in sums.items():
        yield record(_PARTS, part=[part], moved=[moved])


def _averaged(net: Net, parts: pa.Table) -> None:
    """Move the parameters by the weighted mean of what the tasks found."""
    size = (1 << LOG_WORDS) // _BLOCKS
    for part, moved in zip(parts["part"].to_pylist(), parts["moved"].combine_chunks(), strict=True):
        moved = moved.values.to_numpy()
        if part < _BLOCKS:
            times = moved[size * DIMENSION :]
            rows = slice(part * size, (part + 1) * size)
            net.embedding[rows] += moved[: size * DIMENSION].reshape(size, DIMENSION) / np.maximum(times, 1)[:, None]
        else:
            at = 0
            for value in net.all()[1:]:
                value += (moved[at : at + value.size] / moved[-1]).reshape(value.shape)
                at += value.size


def threshold(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The cut with the fewest (weighted) wrong calls, in the middle of its gap; a miss counts ``MISS`` times."""
    weights = weights * np.where(labels == 1, MISS, 1)
    order = np.argsort(scores)
    scores, labels, weights = scores[order], labels[order], weights[order]
    wrong = (weights * (labels == 0)).sum() + np.concatenate([[0], np.cumsum(weights * np.where(labels == 1, 1, -1))])
    wrong[1:-1][scores[1:] == scores[:-1]] = np.inf
    best = int(wrong.argmin())
    low = scores[best - 1] if best else scores[0] - 1
    high = scores[best] if best < len(scores) else scores[-1] + 1
    return float((low + high) / 2)


_SAMPLED = pa.schema([("h", pa.int64()), ("words", pa.list_(pa.int16())), ("toxic", pa.int32())])  # LOG_WORDS bits fit


def _views(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, end, data, offsets in pieces(batch.column("text")):
            words, pointers = buckets(data, offsets)
            lists = pa.ListArray.from_arrays(pa.array(_KINDS * pointers, pa.int32()), pa.array(words.ravel().astype(np.int16)))
            yield record(_SAMPLED, h=batch.column("h")[row:end], words=lists, toxic=batch.column("toxic")[row:end])


def _sample(marked: DataFrame) -> list[tuple[int, int, int]]:
    """(doc_id, hash, toxic) of the ``SAMPLE`` different texts of each class with the smallest hashes.

    Hashes below a bound under which about twice as many lie reach the driver, never a text; a text
    found under both classes counts as toxic.
    """
    texts = marked.where("short").groupBy("h").agg(F.max("toxic").alias("toxic"), F.min("doc_id").alias("doc_id"))
    texts = stored(texts, "sampled")
    out = []
    for row in texts.groupBy("toxic").count().collect():
        bound = min(1 << 32, -(-(2 * SAMPLE << 32) // row["count"]))
        place = F.shiftrightunsigned("h", 32)
        some = texts.where((F.col("toxic") == row["toxic"]) & (place < bound)).select("doc_id", "h").toArrow()
        order = np.argsort(some["h"].to_numpy().view(np.uint64), kind="stable")[:SAMPLE]
        ids, hashes = (some[c].to_numpy()[order].tolist() for c in ("doc_id", "h"))
        out += [(i, h, row["toxic"]) for i, h in zip(ids, hashes, strict=True)]
    return out


_BINNED = pa.schema([("spoken", pa.int32()), ("toxic", pa.int32()), ("bin", pa.int32())])
_STEP = 1 / 128  # thresholds are found in steps of this many logits, below the limit
_LIMIT = 32


def _binned(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for (row, end, data, offsets), (_, _, best, _) in zip(pieces(batch.column("text")), language.guesses(model.languages, batch.column("text")), strict=True):
            found = np.rint(np.clip(logits(model, *buckets(data, offsets)), -_LIMIT, _LIMIT) / _STEP)
            yield record(_BINNED, spoken=best.astype(np.int32), toxic=batch.column("toxic")[row:end], bin=found.astype(np.int32))


_CHOSEN = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("toxic", pa.int32())])


def _start(rows: DataFrame, marked: DataFrame, apart: bool) -> tuple[Net, bool]:
    """Parameters trained on the sample; if that lacks a class, drawn ones and False."""
    net = Net(rng := np.random.default_rng(7))
    chosen = _sample(marked)
    if len({toxic for _, _, toxic in chosen}) < 2:
        return net, False
    # At most 2 * SAMPLE rows, once; one text per hash. Out of an Arrow table Spark makes rows without Python workers.
    wanted = pa.table([pa.array(x, t) for x, t in zip(zip(*chosen, strict=True), _CHOSEN.types, strict=True)], schema=_CHOSEN)
    wanted = F.broadcast(rows.sparkSession.createDataFrame(wanted))
    found = rows.select("doc_id", "text", "h").join(wanted, ["doc_id", "h"]).select("h", "text", "toxic")
    table = found.mapInArrow(frugal(_views), "h long, words array<smallint>, toxic int").toArrow()
    table = table.take(np.unique(table["h"].to_numpy(), return_index=True)[1])  # repeated rows
    if apart:
        table = table.filter(pa.array(table["h"].to_numpy() % 5 != 0))
    values = table["words"].combine_chunks()
    texts = [x.reshape(-1, _KINDS) for x in np.split(values.flatten().to_numpy(), np.cumsum(np.diff(values.offsets.to_numpy()))[:-1])]
    # The order in which rows arrive is not fixed; their content is.
    order = sorted(range(len(texts)), key=lambda i: (len(texts[i]), texts[i].tobytes()))
    toxic = table["toxic"].to_numpy()[order]
    del found, table, values
    give_back()
    if len(set(toxic)) < 2:
        return net, False
    train(net, [texts[i] for i in order], toxic, rng)
    return net, True


def fit(docs: DataFrame, labels: DataFrame, learn: Column) -> Model | None:
    """Train on all labelled documents; None if one class is missing among them.

    At most ``SAMPLE`` documents of each class give the start. From it every task trains once on
    its part of all labelled documents, the classes weighted alike, and the moves are averaged;
    without such a start, because one class has only long documents, this is done ``EPOCHS`` times.
    A fifth of the documents, by the hash of their text, is kept from both to set the thresholds,
    weighted so that the classes have their share among all. A language with fewer than 20
    documents of either class there takes the common threshold.
    """
    known = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    rows = docs.where(learn & F.col("text").isNotNull()).select("doc_id", "text", F.xxhash64("text").alias("h"))
    short = F.size(F.split("text", " ")) <= SAMPLE_WORDS
    marked = stored(rows.select("doc_id", "h", short.alias("short")).join(known, "doc_id"), "marked")
    aside = F.pmod("h", F.lit(5)) == 0
    counts = {(r.toxic, r.aside): r.n for r in marked.groupBy("toxic", aside.alias("aside")).agg(F.count(F.lit(1)).alias("n")).collect()}
    shares = np.array([counts.get((c, True), 0) + counts.get((c, False), 0) for c in (0, 1)])
    if not shares.all():
        return None
    apart = len(counts) == 4
    languages = language.fit(docs, learn)
    net, started = _start(rows, marked, apart)
    give_back()  # the sample is gone
    spark = docs.sparkSession
    # Texts are shuffled to their labels at every size, hardly others than labelled ones; labels never pass the driver.
    labelled = likely(rows, marked, "doc_id", int(shares.sum())).join(known.hint("merge"), "doc_id").select("text", "toxic", "h")
    seen = np.array([counts[c, False] for c in (0, 1)]) if apart else shares
    trained = labelled.where(~aside if apart else F.lit(True))
    for _ in range(1 if started else EPOCHS):
        shared = spark.sparkContext.broadcast((net, seen.sum() / (2 * seen)))
        moves = trained.mapInArrow(frugal(lambda b, shared=shared: _refine(b, *shared.value)), "part int, moved array<double>")
        moves = moves.repartition("part").mapInArrow(_added, "part int, moved array<double>")
        _averaged(net, moves.toArrow())  # one row for each part
    model = Model(net.taps(), net.bias, net.dense, float(net.intercept[0]), languages, np.zeros(len(languages.languages) + 1))
    final = spark.sparkContext.broadcast(model)
    checked = labelled.where(aside if apart else F.lit(True)).mapInArrow(frugal(lambda b: _binned(b, final.value)), "spoken int, toxic int, bin int")
    # At most 2 * _LIMIT / _STEP rows for each language and class.
    bins = checked.groupBy("spoken", "toxic", "bin").agg(F.count(F.lit(1)).alias("n")).orderBy("spoken", "toxic", "bin").toArrow()
    tongue, marks, place, n = (bins[c].to_numpy() for c in ("spoken", "toxic", "bin", "n"))
    scores = place * _STEP
    weight = n * (shares / np.array([n[marks == c].sum() for c in (0, 1)]))[marks]
    model.thresholds[:] = threshold(scores, marks, weight)
    for i in range(len(languages.languages)):
        own = tongue == i
        if min(n[own & (marks == 1)].sum(), n[own & (marks == 0)].sum()) >= 20:
            model.thresholds[i] = threshold(scores[own], marks[own], weight[own])
    return model


_SCORED = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def _probabilities(model: Model | None, column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, row after the last, their probabilities) of the texts, a piece at a time; what is made of one takes about a hundred times its bytes."""
    if model is None:
        yield 0, len(column), np.zeros(len(column))
        return
    spoken = language.guesses(model.languages, column, limit)
    for (row, end, data, offsets), (_, _, best, _) in zip(pieces(column, limit), spoken, strict=True):
        shifted = logits(model, *buckets(data, offsets)) - model.thresholds[best]
        yield row, end, 1 / (1 + np.exp(-np.clip(shifted, -30, 30)))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score of every whole text (null: empty); 0 everywhere without a model."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.empty(0), *(p for _, _, p in _probabilities(shared.value, batch.column("text")))]
            yield record(_SCORED, doc_id=batch.column("doc_id"), score=np.concatenate(found))

    return docs.select("doc_id", "text").mapInArrow(frugal(run), "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted (1 if the score is at least one half) of every document.

    Learns from labelled documents whose crc32(doc_id) modulo ``folds`` is not 0; with several
    labels for an id the highest counts, null labels do not. Null texts are scored as empty.
    Repeated rows get equal scores. If no row of one class is labelled, all scores are 0.
    A null doc_id is scored, and neither learned from nor held out. Other columns are not looked at.
    """
    remainder = fold("doc_id", folds)
    model = fit(docs, labels, remainder != 0)
    held = F.coalesce(remainder == 0, F.lit(False)).alias("held_out")
    return score(docs, model).select("doc_id", held, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


_KEPT_BYTES = 1 << 17  # of text judged at once, beside the whole documents that come and go


def keep_clean(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """The documents, with all columns, whose score is below one half. Learns like :func:`classify`."""
    model = fit(docs, labels, fold("doc_id", folds) != 0)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, chances in _probabilities(shared.value, batch.column(at), _KEPT_BYTES):
                yield batch.slice(row, end - row).filter(pa.array(chances < 0.5))

    return docs.mapInArrow(frugal(run), docs.schema)
