"""Near-duplicate lines across documents: a segment-partition join on edit distance.

A line is cut into ``edits + 1`` segments. Of two lines within the distance, one contains a
segment of the other unchanged and near its place; so each line is indexed under its segments,
and looks up, for every length a partner may have, the substrings that can match. Pairs that
meet are verified with a banded bit-parallel edit distance.

A segment that very many different lines share (a template) would put them all into one task and
compare all with all. Such a group is put off and split by a second segment: lines within one edit
that share a part of the line exactly also share, exactly, one half of the rest. That is repeated,
round by round, while groups are too large; the rest gets shorter by half each time.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import PIECE_BYTES, Recent, bitmap, frugal, in_bitmap, pieces, record, signed, stored

EDITS = 1
MIN_CHARS = 20  # shorter lines are never duplicates
FILTER_BITS = 24
HOT = 4096  # rows of a larger group are split further; the result is the same
_LEAST_REST = 3  # characters of a rest that is still split

_LINES = pa.schema([("h", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()), ("tie", pa.int64()), ("line", pa.int32())])
_KEYS = pa.schema([("key", pa.int64()), ("h", pa.int64()), ("bag", pa.int64())])
_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_MET = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("off", pa.bool_())])  # put off: line, key
_TEXTS = pa.schema([("h", pa.int64()), ("content", pa.string())])


def _long(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """(start, length) of the ``edits + 1`` segments of a line; the last ones are longer by one where needed."""
    count = edits + 1
    short, more = divmod(length, count)
    out, at = [], 0
    for i in range(count):
        size = short + (i >= count - more)
        out.append((at, size))
        at += size
    return out


def probes(own: int, other: int, edits: int) -> list[tuple[int, int, int]]:
    """(segment, start, length) of the substrings of a line of length ``own`` that a segment of a line
    of length ``other`` can equal: shifts that the edits left of the segment, and those right of it, allow."""
    out, shift = [], own - other
    for i, (at, size) in enumerate(segments(other, edits)):
        low = max(0, at - i, at + shift - (edits - i))
        high = min(own - size, at + i, at + shift + (edits - i))
        out += [(i, start, size) for start in range(low, high + 1)]
    return out


@functools.lru_cache(maxsize=1 << 14)
def _keys(length: int, edits: int, shortest: int) -> tuple[list[tuple[int, int, int]], np.ndarray, np.ndarray]:
    """What a line of this length is indexed and looked up under: (start, end, seed) of the different
    substrings to hash, and for every row its substring and its role (0 indexed, 1 looking)."""
    rows = [((at, at + size, length << 8 | i), 0) for i, (at, size) in enumerate(segments(length, edits))]
    for other in range(max(shortest, length - edits), length + 1):
        rows += [((at, at + size, other << 8 | i), 1) for i, at, size in probes(length, other, edits)]
    parts = list(dict.fromkeys(part for part, _ in rows))
    number = {part: k for k, part in enumerate(parts)}
    return parts, np.array([number[part] for part, _ in rows]), np.array([role for _, role in rows], np.int64)


class Part(NamedTuple):
    """A line in a group: the key, its role (0 indexed, 1 looking), and the rest that is not shared yet."""

    key: int
    role: int
    start: int
    end: int  # of the rest, in this line
    length: int  # of the rest, in the indexed lines


def first_parts(line: str, shortest: int) -> list[Part]:
    """The groups of a line at one edit, keys as in :func:`_keys`: one half is shared, the other is the rest."""
    out, own = [], len(line)
    for other, role in [(own, 0), *((n, 1) for n in range(max(shortest, own - 1), own + 1))]:
        for i, (at, size) in enumerate(segments(other, 1)):
            at += i * (own - other)
            key = xxhash.xxh64_intdigest(line[at : at + size], other << 8 | i)
            rest = (at + size, own) if i == 0 else (0, at)
            out.append(Part(key, role, *rest, other - size))
    return out


def halves(line: str, part: Part) -> list[Part]:
    """The groups into which a group is split: a half of the rest is shared as well, at its beginning or at its end."""
    left, right = part.length // 2, part.length - part.length // 2
    out = []
    for which, (a, b), rest, size in (
        (0, (part.start, part.start + left), (part.start + left, part.end), right),
        (1, (part.end - right, part.end), (part.start, part.end - right), left),
    ):
        key = xxhash.xxh64_intdigest(line[a:b], part.key ^ which)
        out.append(Part(key, part.role, *rest, size))
    return out


def bags(lines: list[str]) -> np.ndarray:
    """For every (not empty) line 31 parities of the characters' numbers of occurrences; an edit changes two at most."""
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    bits = np.int64(1) << ((codes * np.uint64(0x9E3779B1) >> np.uint64(7)) % np.uint64(31)).astype(np.int64)
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    return np.bitwise_xor.reduceat(bits, np.cumsum(lengths) - lengths)


def bag(line: str) -> int:
    return int(bags([line])[0]) if line else 0


def within(a: str, b: str, edits: int) -> bool:
    """Whether the edit distance (insert, delete, substitute a character) is at most ``edits``.

    Bit ``d`` of ``state[e]`` says that the part of ``b`` read so far and the part of ``a`` that is
    longer by ``d - edits`` differ by ``e`` edits at most; only this band of diagonals is kept.
    """
    if abs(len(a) - len(b)) > edits:
        return False
    if a == b:
        return True
    start = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    a, b = a[start:], b[start:]
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i + edits
    band = (1 << 2 * edits + 1) - 1
    state = [((1 << e + 1) - 1) << edits & band for e in range(edits + 1)]
    for j, c in enumerate(b):
        same = places.get(c, 0) >> j & band
        before = state
        state = [before[0] & same]
        for e in range(1, edits + 1):
            state.append(before[e] & same | before[e - 1] | before[e - 1] >> 1 | state[e - 1] << 1 & band)
        if not state[edits]:
            return False
    return bool(state[edits] >> len(a) - len(b) + edits & 1)


def _eligible(batch: pa.RecordBatch, shortest: int) -> Iterator[tuple[int, int, str, bytes]]:
    """(row, line number, line, its bytes) of the lines that are long enough."""
    for row, _, data, offsets in pieces(batch.column("text")):
        raw = data.tobytes()
        for i, (a, b) in enumerate(itertools.pairwise(offsets.tolist())):
            for number, line in enumerate(raw[a:b].split(b"\n")):
                if len(line) >= shortest and len(content := line.decode("utf-8", "replace")) >= shortest:
                    yield row + i, number, content, line


def _identity(line: bytes) -> tuple[int, int]:
    whole = xxhash.xxh3_128_intdigest(line)
    return _long(whole >> 64), _long(whole & (1 << 64) - 1)


def _meet(keys: np.ndarray, hashes: np.ndarray, bags: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one indexed and one looking line with equal keys and close bags; the two lowest bits of a bag are
    its role and whether the group can be split, which is the same for all of it."""
    borders = np.flatnonzero(np.diff(keys)) + 1
    starts = np.concatenate([[0], borders])
    sizes = np.diff(np.concatenate([starts, [len(keys)]]))
    at = np.flatnonzero(np.repeat(sizes <= 32, sizes))
    shift = 1
    while len(at):
        at = at[at + shift < len(keys)]
        at = at[keys[at + shift] == keys[at]]
        apart = bags[at] ^ bags[at + shift]
        hit = at[(apart & 1 == 1) & (np.bitwise_count(apart >> 2) <= most) & (hashes[at] != hashes[at + shift])]
        if len(hit):
            yield hashes[hit], hashes[hit + shift]
        shift += 1
    for start, size in zip(starts[sizes > 32], sizes[sizes > 32], strict=True):
        own, group = bags[start : start + size], hashes[start : start + size]
        indexed, looking = np.flatnonzero(own & 1 == 0), np.flatnonzero(own & 1)
        for block in range(0, len(looking), 256):
            some = looking[block : block + 256]
            close = np.bitwise_count((own[some][:, None] ^ own[indexed][None, :]) >> 2) <= most
            x, y = np.nonzero(close & (group[some][:, None] != group[indexed][None, :]))
            if len(x):
                yield group[some[x]], group[indexed[y]]


def _too_large(keys: np.ndarray, bags: np.ndarray, hot: int) -> np.ndarray:
    """Places of the rows of groups that have more than ``hot`` rows and can be split."""
    borders = np.flatnonzero(np.diff(keys)) + 1
    starts = np.concatenate([[0], borders])
    sizes = np.diff(np.concatenate([starts, [len(keys)]]))
    large = (sizes > hot) & (bags[starts] & 2 > 0)
    return np.flatnonzero(np.repeat(large, sizes)) if large.any() else np.empty(0, np.int64)


def similar(docs: DataFrame, edits: int = EDITS, shortest: int = MIN_CHARS, hot: int = HOT) -> DataFrame:
    """Pairs ``a < b`` of hashes of different lines within the edit distance.

    At one edit, groups of more than ``hot`` rows are split in further rounds; the driver sees whether
    there are any, and their keys and lines as sets of fixed size. At more edits they stay whole.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent = Recent()
        for batch in batches:
            hashes, lines, held = [], [], 0
            for _, _, content, line in _eligible(batch, shortest):
                hashes.append(_identity(line)[0])
                lines.append(content)
                held += len(content)
                if held > PIECE_BYTES:
                    yield from _new_rows(recent, hashes, lines)
                    hashes, lines, held = [], [], 0
            yield from _new_rows(recent, hashes, lines)

    def _new_rows(recent: Recent, hashes: list[int], lines: list[str]) -> Iterator[pa.RecordBatch]:
        new = recent.new(np.array(hashes, np.int64).view(np.uint64))
        if len(new):
            yield _rows([hashes[i] for i in new], [lines[i] for i in new])

    def _rows(hashes: list[int], lines: list[str]) -> pa.RecordBatch:
        digests: list[int] = []
        picks, roles, sizes = [], [], []
        for content in lines:
            parts, pick, role = _keys(len(content), edits, shortest)
            picks.append(pick + len(digests))
            roles.append(role)
            sizes.append(len(role))
            digests += [xxhash.xxh64_intdigest(content[a:b], seed) for a, b, seed in parts]
        keys = np.array(digests, np.uint64)[np.concatenate(picks)]
        own = np.repeat(bags(lines), sizes) << 2 | np.concatenate(roles) | 2 * (edits == 1)
        return record(_KEYS, key=signed(keys), h=np.repeat(np.array(hashes, np.int64), sizes), bag=own)

    def split(hot_lines: np.ndarray, hot_keys: list[np.ndarray]):
        """Rows of the groups that the last of ``hot_keys`` are split into, for the lines in them."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            recent = Recent()
            for batch in batches:
                rows = []
                for _, _, content, line in _eligible(batch, shortest):
                    h = _identity(line)[0]
                    own = np.array([h], np.int64).view(np.uint64)
                    if not in_bitmap(hot_lines, own, FILTER_BITS)[0] or not len(recent.new(own)):
                        continue
                    parts = first_parts(content, shortest)
                    for keys in hot_keys:
                        found = in_bitmap(keys, np.array([p.key for p in parts], np.uint64), FILTER_BITS) if parts else []
                        parts = [half for p, hit in zip(parts, found, strict=True) if hit and p.length >= _LEAST_REST for half in halves(content, p)]
                    mark = bag(content) << 2
                    rows += [(_long(p.key), h, mark | p.role | 2 * (p.length >= _LEAST_REST)) for p in parts]
                if rows:
                    key, h, own = zip(*rows, strict=True)
                    yield record(_KEYS, key=key, h=h, bag=own)

        return run

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.empty(0, np.int64)] * 3
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                kept = [np.concatenate([k, batch.column(i).to_numpy()]) for i, k in enumerate(kept)]
                whole = int(np.searchsorted(kept[0], kept[0][-1])) if len(kept[0]) else 0  # the last group may go on
            else:
                whole = len(kept[0])
            if not len(kept[0]):
                continue
            # Rows of a group that is too large already are put off now; some stay, to tell what follows.
            off = _too_large(kept[0], kept[2], hot)
            for at in range(0, len(off), 1 << 16):
                part = off[at : at + (1 << 16)]
                yield record(_MET, a=kept[1][part], b=kept[0][part], off=np.ones(len(part), bool))
            ready = np.ones(whole, bool)
            ready[off[off < whole]] = False
            if ready.any():
                for a, b in _meet(*(k[:whole][ready] for k in kept), 2 * edits):
                    yield record(_MET, a=np.minimum(a, b), b=np.maximum(a, b), off=np.zeros(len(a), bool))
            if whole < len(kept[0]) and len(off) and off[-1] >= whole:  # of a group that goes on, hot + 1 rows say enough
                kept = [k[len(k) - hot - 1 :] for k in kept]
            else:
                kept = [k[whole:] for k in kept]

    def met(keys: DataFrame) -> DataFrame:
        dealt = keys.repartition("key").sortWithinPartitions("key")
        return stored(dealt.mapInArrow(frugal(meet), "a long, b long, off boolean").distinct(), "met")

    context = docs.sparkSession.sparkContext
    rounds = [met(docs.select("text").mapInArrow(frugal(cut), "key long, h long, bag long"))]
    hot_keys: list[np.ndarray] = []
    while not (late := rounds[-1].where("off").select(F.col("a").alias("h"), F.col("b").alias("key"))).isEmpty():
        hot_keys.append(bitmap(late, "key", FILTER_BITS))
        shared = context.broadcast((bitmap(late, "h", FILTER_BITS), list(hot_keys)))
        rounds.append(met(docs.select("text").mapInArrow(frugal(lambda b, shared=shared: split(*shared.value)(b)), "key long, h long, bag long")))
    pairs = rounds[0].where("not off").select("a", "b")
    for later in rounds[1:]:
        pairs = pairs.union(later.where("not off").select("a", "b"))
    if len(rounds) > 1:
        pairs = stored(pairs.distinct(), "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("h"))
    wanted = context.broadcast(bitmap(ids, "h", FILTER_BITS))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent = Recent()
        for batch in batches:
            hashes, lines, held = [], [], 0
            for _, _, content, line in itertools.chain(_eligible(batch, shortest), [(0, 0, "", None)]):
                if line is not None:
                    hashes.append(_identity(line)[0])
                    lines.append(content)
                    held += len(content)
                if hashes and (line is None or held > PIECE_BYTES):
                    own = np.array(hashes, np.int64).view(np.uint64)
                    hit = np.flatnonzero(in_bitmap(wanted.value, own, FILTER_BITS))
                    new = hit[recent.new(own[hit])]
                    if len(new):
                        yield record(_TEXTS, h=[hashes[i] for i in new], content=[lines[i] for i in new])
                    hashes, lines, held = [], [], 0

    texts = docs.select("text").mapInArrow(frugal(fetch), "h long, content string").join(ids.distinct(), "h", "left_semi").distinct()
    left = texts.select(F.col("h").alias("a"), F.col("content").alias("x"))
    right = texts.select(F.col("h").alias("b"), F.col("content").alias("y"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            good = pa.array([within(p, q, edits) for p, q in zip(x, y, strict=True)], pa.bool_())
            yield batch.select(["a", "b"]).filter(good)

    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(frugal(verify), "a long, b long").distinct()


def deduplicate(docs: DataFrame, edits: int = EDITS, shortest: int = MIN_CHARS, hot: int = HOT) -> DataFrame:
    """The documents, all columns, with ``text`` less its duplicate lines (and ``n_chars``, if there, counted anew).

    A line (between line feeds, ``shortest`` characters or more) goes if it has occurred before, or
    if another line within ``edits`` edits first occurs before its own first occurrence. Before
    means a smaller doc_id (null first), then hash of the text, then line number. A text without
    such lines stays as it is, null and empty ones too; one that loses all its lines becomes empty.
    Repeated rows (equal id and text) count as one document and keep the same lines. Lines are
    told apart by 128 bits of hash, partners of near duplicates by 64 bits.
    """
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    keyed = row.select(F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"), F.xxhash64("row.text").alias("tie"), "row")

    def list_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, number, *_identity(line)) for i, number, _, line in _eligible(batch, shortest)]
            if found:
                at, number, h, h2 = zip(*found, strict=True)
                pick = pa.array(at)
                yield record(_LINES, h=h, h2=h2, doc_id=batch.column("doc_id").take(pick), tie=batch.column("tie").take(pick), line=number)

    lines = keyed.select("doc_id", "text", "tie").mapInArrow(frugal(list_lines), "h long, h2 long, doc_id long, tie long, line int")
    lines = stored(lines, "lines")
    place = F.struct("doc_id", "tie", "line")
    firsts = lines.groupBy("h", "h2").agg(F.min(place).alias("first"))
    links = similar(docs.select("text"), edits, shortest, hot)
    by_hash = firsts.groupBy("h").agg(F.min("first").alias("first"))
    one, two = by_hash.toDF("a", "first_a"), by_hash.toDF("b", "first_b")
    later = links.join(one, "a").join(two, "b").select(F.when(F.col("first_a") < F.col("first_b"), F.col("b")).otherwise(F.col("a")).alias("h"))
    gone = lines.join(firsts, ["h", "h2"]).join(later.distinct().withColumn("near", F.lit(True)), "h", "left")
    gone = gone.where((place > F.col("first")) | F.col("near")).groupBy("doc_id", "tie").agg(F.collect_set("line").alias("gone"))
    gone = gone.select(F.col("doc_id").alias("id"), F.col("tie").alias("own"), "gone")
    cleaned = keyed.join(gone, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("tie") == F.col("own")), "left")
    left = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("gone", i))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    out = cleaned.select(text.alias("text"), "row")
    return out.select(*[
        F.col("text") if c == "text" else F.char_length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"row.`{c}`") for c in docs.columns
    ])
