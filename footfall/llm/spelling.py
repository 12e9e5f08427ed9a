"""Spelling variants: words one edit apart, each led to the much more frequent one.

Every word of the vocabulary generates its edits: each character left out, and each replaced by a
later one of the alphabet, so that of two near words exactly one generates the other. The edits
are probed, by hash, against Bloom filters of the vocabulary: blocks of 64 bits, a shard of blocks
for every length, broadcast at a fixed largest size. Only positives are shuffled; the join with the
vocabulary removes the false ones, and the words themselves are compared last.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import LOWER_BYTES, mix, pieces, record, signed, stored

MIN_CHARS = 5
MIN_COUNT = 3
HARMED = 97  # of so many (document, run) one loses a character
LEAD = 2  # a form occurs at least so many times as often

SHARDS = 64  # by length; words of 63 characters and more share the last
WORDS_PER_BLOCK = 4
MAX_BLOCKS = 1 << 21  # 16 MB; a larger vocabulary lets more false positives pass, and loses none
BITS = 4  # set in its block for a word

# Fixed value: the characters of words, lower case.
ALPHABET = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint64)
_RUN = re.compile("[a-zÀ-ÿ]+")
_OTHER = re.compile("[^a-zÀ-ÿ]")

_BASE = 0x9E3779B97F4A7C15  # odd: the base of the polynomial hash
_BACK = np.uint64(pow(_BASE, -1, 1 << 64))
_SLICE = 1 << 20  # characters of a text looked at together
_FLUSH = 1 << 23  # characters of different words that a counting task holds
_POSITIONS = 1 << 12  # whose edits are generated together

_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])
_VOCABULARY = pa.schema([("id", pa.int64()), ("word", pa.string()), ("n", pa.int64())])
_POSITIVES = pa.schema([("candidate", pa.int64()), ("source", pa.int64()), ("at", pa.int64()), ("code", pa.int32())])


def _slices(text: str) -> Iterator[str]:
    """The text in parts that cut no run."""
    at = 0
    while at < len(text):
        found = _OTHER.search(text, at + _SLICE)
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end


def words_of(doc_id: int | None, text: str, harmed: int, shortest: int) -> Iterator[tuple[str, int]]:
    """Words of a lower-cased text with numbers of occurrences (a word may come more than once)."""
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for part in _slices(text):
        for run, n in Counter(_RUN.findall(part)).items():
            if len(run) < shortest:
                continue
            h = zlib.crc32(run.encode(), seed)
            if harmed and h % harmed == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
                if len(run) < shortest:
                    continue
            yield run, n


def word_counts(docs: DataFrame, harmed: int = HARMED, shortest: int = MIN_CHARS) -> DataFrame:
    """word and n of all words of whole texts; a task adds up before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = defaultdict(int)
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            items = list(counts.items())
            for at in range(0, len(items), 1 << 16):
                part = items[at : at + (1 << 16)]
                yield record(_COUNTS, word=[w for w, _ in part], n=[n for _, n in part])
            counts.clear()

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for row, _, data, offsets in pieces(batch.column("text")):
                raw = data.tobytes().translate(LOWER_BYTES)
                for i in range(len(offsets) - 1):
                    text = raw[offsets[i] : offsets[i + 1]].decode("utf-8", "replace")
                    for word, n in words_of(ids[row + i], text, harmed, shortest):
                        before = len(counts)
                        counts[word] += n
                        held += (len(counts) - before) * len(word)
                    if held > _FLUSH:
                        yield from flush()
                        held = 0
        yield from flush()

    found = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


class _Words(NamedTuple):
    """Words laid end to end: one entry per character."""

    codes: np.ndarray
    powers: np.ndarray  # of the base, by the place in the word
    before: np.ndarray  # sum of codes times powers of the characters before
    owner: np.ndarray  # number of the word
    place: np.ndarray
    sums: np.ndarray  # one entry per word: that sum of all its characters
    lengths: np.ndarray


def _laid_out(words: list[str]) -> _Words:
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(codes)) - np.repeat(ends - lengths, lengths)
    table = np.full(int(lengths.max(initial=0)) + 1, _BASE, np.uint64)
    table[0] = 1
    powers = np.cumprod(table)[place]
    upto = np.concatenate([[np.uint64(0)], np.cumsum(codes * powers)])
    first = upto[ends - lengths]
    return _Words(codes, powers, upto[:-1] - first[owner], owner, place, upto[ends] - first, lengths)


def word_ids(words: list[str]) -> np.ndarray:
    """A 64-bit hash of every word."""
    return mix(_laid_out(words).sums)


def vocabulary(counts: DataFrame, least: int = MIN_COUNT) -> DataFrame:
    """id (a hash), word and n of the words that occur at least ``least`` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = word_ids(batch.column("word").to_pylist())
            yield record(_VOCABULARY, id=signed(ids), word=batch.column("word"), n=batch.column("n"))

    return counts.where(F.col("n") >= least).mapInArrow(run, "id long, word string, n long")


class Filter(NamedTuple):
    blocks: np.ndarray
    first: np.ndarray  # block of each shard
    count: np.ndarray  # blocks of each shard (0: no such words)

    def holds(self, ids: np.ndarray, shards: np.ndarray) -> np.ndarray:
        """Whether a word with this hash can be in the vocabulary."""
        count = self.count[shards]
        block = self.first[shards] + ((ids >> np.uint64(32)) * count >> np.uint64(32))
        bits = np.zeros_like(ids)
        for i in range(BITS):
            bits |= np.uint64(1) << (ids >> np.uint64(6 * i) & np.uint64(63))
        return (count > 0) & (self.blocks[np.minimum(block, np.uint64(len(self.blocks) - 1))] & bits == bits)


def build_filter(words: DataFrame, most: int = MAX_BLOCKS) -> Filter:
    """The filters of all lengths. At most ``SHARDS`` counts and ``most + SHARDS`` blocks reach the driver."""
    shard = F.least(F.char_length("word"), F.lit(SHARDS - 1))
    sizes = np.zeros(SHARDS, np.int64)
    for row in words.groupBy(shard.alias("shard")).count().collect():
        sizes[row["shard"]] = row["count"]
    wanted = -(-sizes // WORDS_PER_BLOCK)
    if wanted.sum() > most:
        wanted = np.maximum(sizes * most // sizes.sum(), sizes > 0)
    first = np.cumsum(wanted) - wanted
    counts, firsts = (F.array(*[F.lit(int(x)) for x in column]) for column in (wanted, first))
    block = F.get(firsts, shard) + F.shiftrightunsigned(F.shiftrightunsigned("id", 32) * F.get(counts, shard), 32)
    bits = " | ".join(f"shiftleft(1L, cast(shiftrightunsigned(id, {6 * i}) & 63 as int))" for i in range(BITS))
    rows = words.groupBy(block.alias("block")).agg(F.bit_or(F.expr(bits)).alias("bits")).toArrow()
    blocks = np.zeros(max(int(wanted.sum()), 1), np.uint64)
    blocks[rows["block"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return Filter(blocks, first.astype(np.uint64), wanted.astype(np.uint64))


def edits(words: list[str], ids: np.ndarray, known: Filter) -> Iterator[pa.RecordBatch]:
    """The generated edits that the filter lets pass: hash of the edit and of the word, place, and new character (0: left out)."""
    laid = _laid_out(words)
    for at in range(0, len(laid.codes), _POSITIONS):
        part = slice(at, at + _POSITIONS)
        code, power, owner = laid.codes[part], laid.powers[part], laid.owner[part]
        total, before = laid.sums[owner], laid.before[part]
        out = []
        # Left out; of equal neighbours only the first. The characters behind move up by one.
        after = (total - before - code * power) * _BACK
        shard = np.minimum(laid.lengths[owner] - 1, SHARDS - 1)
        hashes = mix(before + after)
        first = np.ones(len(code), bool)
        same = laid.codes[np.maximum(np.arange(at, at + len(code)) - 1, 0)] == code
        first[same & (laid.place[part] > 0)] = False
        hit = np.flatnonzero(first & known.holds(hashes, shard))
        out.append((hashes[hit], hit, np.zeros(len(hit), np.int32)))
        # Replaced by a later character.
        shard = np.minimum(laid.lengths[owner], SHARDS - 1)
        row, letter = np.nonzero(ALPHABET[None, :] > code[:, None])
        new = ALPHABET[letter]
        hashes = mix(total[row] + (new - code[row]) * power[row])
        hit = np.flatnonzero(known.holds(hashes, shard[row]))
        out.append((hashes[hit], row[hit], new[hit].astype(np.int32)))
        found, row, code = (np.concatenate(x) for x in zip(*out, strict=True))
        if len(found):
            yield record(_POSITIVES, candidate=signed(found), source=ids[owner[row]], at=laid.place[part][row], code=code)


def near_pairs(words: DataFrame) -> DataFrame:
    """word, n, other, other_n: every two words of the vocabulary that differ by exactly one edit, once."""
    shared = words.sparkSession.sparkContext.broadcast(build_filter(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from edits(batch.column("word").to_pylist(), batch.column("id").to_numpy(), shared.value)

    positives = words.select("id", "word").mapInArrow(run, "candidate long, source long, at long, code int")
    other = words.select(F.col("id").alias("candidate"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    met = positives.join(other, "candidate").join(words.withColumnRenamed("id", "source"), "source")
    edited = F.expr("concat(substr(word, 1, int(at)), if(code = 0, '', char(code)), substr(word, int(at) + 2))")
    return met.where(edited == F.col("other")).select("word", "n", "other", "other_n")


def _roots(links: DataFrame) -> DataFrame:
    """word and root of all words that have a form: every round doubles the steps a word has taken.

    A form is at least ``LEAD`` times as frequent, so a way has at most log2(largest n) steps.
    """
    now = stored(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = stored(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if now.where("moved").limit(1).isEmpty():
            return now.select("word", "root")


def group(docs: DataFrame, harmed: int = HARMED, shortest: int = MIN_CHARS, least: int = MIN_COUNT, lead: int = LEAD) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the vocabulary.

    Words are runs of letters of whole texts, ``A-Z`` lower-cased, of ``shortest`` characters and
    ``least`` occurrences; of the runs of a document one in ``harmed`` (by a hash of id and run) loses a
    character first (0: none). Near words differ by one inserted, left out or replaced character.
    ``form`` is the near word of largest n (of equal ones the first in code-point order) if that is at
    least ``lead`` times the word's; ``root`` follows forms to the end. Null and empty texts have no
    words; a null doc_id counts as an empty one; repeated rows count as often as they occur; an empty
    table gives none; other columns are not looked at.
    """
    words = stored(vocabulary(word_counts(docs, harmed, shortest), least), "vocabulary")
    pairs = stored(near_pairs(words), "near")
    near = pairs.select("word", F.col("other").alias("near"), F.col("other_n").alias("near_n")).union(
        pairs.select("other", "word", "n")
    )
    best = near.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    led = F.coalesce(-F.col("best.less") >= lead * F.col("n"), F.lit(False))
    joined = words.select("word", "n").join(best, "word", "left").select(
        "word",
        F.when(led, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(led, -F.col("best.less")).alias("form_n"),
    )
    joined = stored(joined, "forms")
    roots = _roots(joined.where("form is not null"))
    return joined.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
