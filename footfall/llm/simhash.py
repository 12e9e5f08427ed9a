"""SimHash fingerprints, links within a Hamming distance, and groups of linked documents.

Fingerprints are compared inside shards. A vantage point tree over all 64 bits would copy
nearly half of the points at every level (distances between unrelated fingerprints lie within
four of their mean), so the shards come from distance zero in parts of the fingerprint: the
bits are cut into ``distance + 2`` segments, and two fingerprints within the distance agree
in at least two of them. Every fingerprint is put into the shard of each pair of segments.
Inside a shard, vantage points split the fingerprints by Hamming distance, the triangle bound
prunes, and points near a boundary are compared with the other side.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import LOWER_BYTES, frugal, pieces, record, signed, stored

SHINGLE_WORDS = 4
DISTANCE = 4
SEED = 42  # of XXH64

LEAF = 128  # fingerprints compared with each other without a further vantage point

_LANES = np.uint64(0x0101010101010101)
_FINGERPRINTS = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("fp", pa.int64())])
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def shingle_hashes(text: bytes, size: int) -> list[int]:
    """XXH64 of every shingle of a lower-cased text; of the whole sequence if it is shorter."""
    words = text.split()  # bytes.split() separates at exactly the six ASCII spaces
    if not words:
        return []
    if len(words) <= size:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    return list(map(xxhash.xxh64_intdigest, shingles, itertools.repeat(SEED)))


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One fingerprint per text from its hashes laid end to end; zero for a text without any.

    Bits are counted eight at a time in the bytes of a word, over runs of at most 255 hashes.
    """
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    sizes = counts[full]
    ends = np.cumsum(sizes)
    runs = -(-sizes // 255)
    first_run = np.cumsum(runs) - runs
    inner = np.arange(runs.sum()) - np.repeat(first_run, runs)
    cuts = np.repeat(ends - sizes, runs) + 255 * inner
    found = np.zeros(len(full), np.uint64)
    for shift in range(8):
        lanes = (hashes >> np.uint64(shift)) & _LANES
        per_run = np.add.reduceat(lanes, cuts).view(np.uint8).reshape(-1, 8).astype(np.int64)
        per_text = np.add.reduceat(per_run, first_run, axis=0)
        for byte in range(8):
            over = 2 * per_text[:, byte] > sizes
            found |= over.astype(np.uint64) << np.uint64(8 * byte + shift)
    out[full] = found
    return out


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, a hash of the text ``tie``, and the fingerprint ``fp`` (a signed number) of every whole text; null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in pieces(batch.column("text")):
                raw = data.tobytes().translate(LOWER_BYTES)
                lists = [shingle_hashes(raw[a:b], size) for a, b in itertools.pairwise(offsets.tolist())]
                counts = np.fromiter(map(len, lists), np.int64, len(lists))
                hashes = np.fromiter(itertools.chain.from_iterable(lists), np.uint64, int(counts.sum()))
                ids, ties = batch.column("doc_id")[row:end], batch.column("tie")[row:end]
                yield record(_FINGERPRINTS, doc_id=ids, tie=ties, fp=signed(majority_bits(hashes, counts)))

    return docs.select("doc_id", "text", F.xxhash64("text").alias("tie")).mapInArrow(frugal(run), "doc_id long, tie long, fp long")


class _Forest:
    """Union-find; ``edges`` are real links that span its components."""

    def __init__(self, count: int):
        self.parent = np.arange(count)
        self.edges: list[tuple[int, int]] = []

    def roots(self, members: np.ndarray) -> np.ndarray:
        found = self.parent[members]
        while True:
            above = self.parent[found]
            if np.array_equal(above, found):
                self.parent[members] = found
                return found
            found = above

    def link(self, a: int, b: int) -> None:
        ra, rb = (int(self.roots(np.array([x]))[0]) for x in (a, b))
        if ra != rb:
            self.parent[max(ra, rb)] = min(ra, rb)
            self.edges.append((a, b))


def _compare(points: np.ndarray, left: np.ndarray, right: np.ndarray, radius: int, forest: _Forest) -> None:
    """Link all pairs of two blocks that lie within the radius and are not connected yet."""
    near = np.bitwise_count(points[left][:, None] ^ points[right][None, :]) <= radius
    while True:
        near &= forest.roots(left)[:, None] != forest.roots(right)[None, :]
        rows = np.flatnonzero(near.any(axis=1))
        if not len(rows):
            return
        for row, column in zip(rows, near[rows].argmax(axis=1), strict=True):
            forest.link(int(left[row]), int(right[column]))


def _search(points: np.ndarray, left: np.ndarray, right: np.ndarray, radius: int, forest: _Forest) -> None:
    """Pairs with one end in each side. Both sides are split by distance to one vantage point;
    the halves are compared with each other only where the triangle bound lets them meet."""
    work = [(left, right)]
    while work:
        left, right = work.pop()
        if not len(left) or not len(right):
            continue
        if len(left) <= LEAF and len(right) <= LEAF:
            _compare(points, left, right, radius, forest)
            continue
        roots = np.concatenate([forest.roots(left), forest.roots(right)])
        if (roots == roots[0]).all():
            continue
        vantage = points[left[len(left) // 2]]
        d_left = np.bitwise_count(points[left] ^ vantage).astype(np.int16)
        d_right = np.bitwise_count(points[right] ^ vantage).astype(np.int16)
        both = np.concatenate([d_left, d_right])
        border = int(np.median(both))
        near_l, near_r = d_left <= border, d_right <= border
        if both.max() - both.min() <= radius or near_l.all() and near_r.all():
            half_l, half_r = -(-len(left) // 2), -(-len(right) // 2)  # not told apart by distance: cut anywhere
            work += [(a, b) for a in (left[:half_l], left[half_l:]) for b in (right[:half_r], right[half_r:])]
            continue
        work.append((left[near_l], right[near_r]))
        work.append((left[~near_l], right[~near_r]))
        work.append((left[near_l & (d_left > border - radius)], right[~near_r & (d_right <= border + radius)]))
        work.append((left[~near_l & (d_left <= border + radius)], right[near_r & (d_right > border - radius)]))


def linked_pairs(points: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links (as positions) that connect all different points within the radius of each other, and no more than needed."""
    forest = _Forest(len(points))
    everything = np.arange(len(points))
    _search(points, everything, everything, radius, forest)
    return forest.edges


def _shard_links(keys: np.ndarray, points: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links inside each run of equal keys. Small runs are compared together, by distance in the sort order."""
    borders = np.flatnonzero(np.diff(keys)) + 1
    starts = np.concatenate([[0], borders])
    sizes = np.diff(np.concatenate([starts, [len(keys)]]))
    small = np.repeat(sizes <= LEAF // 4, sizes)
    shift = 1
    at = np.flatnonzero(small)
    while len(at):
        at = at[at + shift < len(keys)]
        at = at[keys[at + shift] == keys[at]]
        hit = at[np.bitwise_count(points[at] ^ points[at + shift]) <= radius]
        if len(hit):
            yield points[hit], points[hit + shift]
        shift += 1
    for start, size in zip(starts[sizes > LEAF // 4], sizes[sizes > LEAF // 4], strict=True):
        shard = points[start : start + size]
        pairs = np.array(linked_pairs(shard, radius), np.int64).reshape(-1, 2)
        if len(pairs):
            yield shard[pairs[:, 0]], shard[pairs[:, 1]]


def links(points: DataFrame, radius: int = DISTANCE) -> DataFrame:
    """Links ``a``, ``b`` between the different values of ``fp`` that connect all within the radius."""
    count = radius + 2
    widths = [64 // count + (i < 64 % count) for i in range(count)]
    lows = np.concatenate([[0], np.cumsum(widths)[:-1]]).tolist()

    def segment(i: int) -> str:
        return f"(shiftrightunsigned(fp, {lows[i]}) & {(1 << widths[i]) - 1}L)"

    # The top bits are left to the number of the pair.
    keys = [
        f"shiftleft({number}L, {widths[i] + widths[j]}) | shiftleft({segment(i)}, {widths[j]}) | {segment(j)}"
        for number, (i, j) in enumerate(itertools.combinations(range(count), 2))
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_keys, kept = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                kept_keys = np.concatenate([kept_keys, batch.column("key").to_numpy()])
                kept = np.concatenate([kept, batch.column("fp").to_numpy().view(np.uint64)])
                if not len(kept_keys):
                    continue
                whole = int(np.searchsorted(kept_keys, kept_keys[-1]))  # the last run may go on
            else:
                whole = len(kept_keys)
            if whole:
                for a, b in _shard_links(kept_keys[:whole], kept[:whole], radius):
                    yield record(_LINKS, a=signed(np.minimum(a, b)), b=signed(np.maximum(a, b)))
            kept_keys, kept = kept_keys[whole:], kept[whole:]

    shards = points.select("fp", F.explode(F.array(*map(F.expr, keys))).alias("key"))
    return shards.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(frugal(run), "a long, b long").distinct()


def connected(edges: DataFrame, label: str = "components") -> DataFrame:
    """node and root of every node on an edge ``a``, ``b``; the root is the component's smallest node.

    Alternating star contraction: every node's larger neighbours, then its smaller ones, are
    moved to its smallest neighbour, until nothing changes. Each round is a few joins over the
    edges, stored in the shared folder; the driver sees a count and a checksum.
    """

    def state(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    before, seen = None, state(now)
    while seen != before and seen[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(lowest, "a").where("b <> low").select(F.col("b").alias("x"), F.col("low").alias("y"))
        small = small.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).union(lowest.select("a", F.col("low").alias("b")))
        now = stored(small.distinct(), label)
        before, seen = seen, state(now)
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def groups(docs: DataFrame, size: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """doc_id, tie, fp, root (the group's smallest fingerprint) and component_id (its smallest doc_id) of every document.

    Null and empty texts have fingerprint zero and are linked like any other. Equal texts and
    repeated rows share a fingerprint, so they meet once, as one value. A null doc_id never
    names a group unless all its members have none (then component_id is null). Empty input
    gives an empty result; other columns of the input are not looked at.
    """
    prints = stored(fingerprints(docs, size), "fingerprints")
    values = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    roots = connected(links(values, distance))
    values = values.join(roots, values.fp == roots.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = values.groupBy("root").agg(F.min("low").alias("component_id"))
    member = stored(values.join(lowest, "root").select("fp", "root", "component_id"), "members")
    return prints.join(member, "fp").select("doc_id", "tie", "fp", "root", "component_id")


def keep_one(docs: DataFrame, size: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """The document with the smallest doc_id of each linked group, with all columns.

    A null doc_id stays only if its whole group has none; then, and among different texts under one
    doc_id, the smallest hash of the text decides. Of repeated rows (equal id and text) one stays.
    """
    found = stored(groups(docs, size, distance), "groups")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie")
    best = found.groupBy("root").agg(F.min(order).alias("best"))
    best = best.select(F.col("best.doc_id").alias("id"), F.col("best.tie").alias("own"))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("row.text") == F.col("own"))
    kept = row.join(best, same, "left_semi")
    if found.groupBy("doc_id", "tie").count().where("count > 1").limit(1).count():
        kept = kept.withColumns({"k1": F.col("row.doc_id"), "k2": F.xxhash64("row.text")}).dropDuplicates(["k1", "k2"])
    return kept.select("row.*")


def fingerprint_text(fp: str):
    """A fingerprint as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
