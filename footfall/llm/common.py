"""What the operators share: byte-level words and windows in numpy, fixed-size filters, stored tables."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.session import scratch

# Texts are worked on in pieces of about this many bytes (or one text), which bounds
# the memory of a Python worker whatever the size of an Arrow batch.
PIECE_BYTES = 1 << 19

# The bytes that separate words, and those of ASCII letters and digits.
SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_BYTES = LOWER.tobytes()
# Everything but ASCII letters, digits and the bytes of other scripts.
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

WORD_REGEX = "[^\\x20\\x09-\\x0D]+"
SPACE_REGEX = "[\\x20\\x09-\\x0D]+"

_ODD = 0x9E3779B97F4A7C15  # 2^64 / golden ratio, odd: the base of the rolling hashes
_INVERSE = pow(_ODD, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame into the shared folder and read it from there: short lineage, no recomputation."""
    path = scratch(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def fold(key: str, parts: int) -> Column:
    """The crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col(key).cast("string")) % parts


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """A string column as (first row, row after the last, bytes, offsets from 0). Nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    count = len(column)
    if not count:
        return
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int32)[column.offset : column.offset + count + 1].astype(np.int64)
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer else np.empty(0, np.uint8)
    row = 0
    while row < count:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), count)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def split_words(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the number of words before each text."""
    inside = ~between[data]
    before = np.ones(len(data), bool)
    after = np.ones(len(data), bool)
    before[1:] = ~inside[:-1]
    after[:-1] = ~inside[1:]
    full = offsets[:-1] < offsets[1:]
    before[offsets[:-1][full]] = True
    after[offsets[1:][full] - 1] = True
    starts = np.flatnonzero(inside & before)
    ends = np.flatnonzero(inside & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(values: np.ndarray) -> np.ndarray:
    """The finalizer of SplitMix64: spreads every bit over the whole word."""
    values = values ^ (values >> np.uint64(30))
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def _power(base: int, count: int) -> np.ndarray:
    """``base ** i`` modulo 2^64 for i < count."""
    known = _powers.get(base)
    if known is None or len(known) < count:
        steps = np.full(max(count, 1 << 16), base, np.uint64)
        steps[0] = 1
        known = _powers[base] = np.cumprod(steps)
    return known[:count]


def _spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial hash of ``values[start:end]`` that does not depend on the position."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(_ODD, len(values)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power(_INVERSE, len(values) + 1)[starts])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word's bytes."""
    return _spans(data.astype(np.uint64) + np.uint64(1), starts, ends)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every ``size`` consecutive word hashes (text borders are not looked at)."""
    if len(words) < size:
        return np.empty(0, np.uint64)
    starts = np.arange(len(words) - size + 1)
    return _spans(words, starts, starts + size)


def owners(pointers: np.ndarray) -> np.ndarray:
    """The text of every word, from the number of words before each text."""
    return np.repeat(np.arange(len(pointers) - 1), np.diff(pointers))


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def bitmap(frame: DataFrame, column: str, log_bits: int) -> np.ndarray:
    """The upper ``log_bits`` bits of a column of 64-bit hashes as a set of fixed size.

    At most ``2 ** (log_bits - 6)`` rows of two numbers reach the driver, however many
    hashes there are. Members are always found; a full set only lets more others pass.
    """
    slot = F.shiftrightunsigned(F.col(column), 64 - log_bits)
    rows = (
        frame.where(F.col(column).isNotNull())
        .groupBy(F.shiftrightunsigned(slot, 6).alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned({column}, {64 - log_bits}) & 63 as int))")).alias("bits"))
        .toArrow()
    )
    words = np.zeros(1 << (log_bits - 6), np.uint64)
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return words


def in_bitmap(words: np.ndarray, hashes: np.ndarray, log_bits: int) -> np.ndarray:
    slots = hashes >> np.uint64(64 - log_bits)
    return (words[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1) == 1


_FILTER_BITS = 24  # at most 2^18 rows of two numbers are broadcast


def likely(frame: DataFrame, members: DataFrame, key: str, count: int) -> DataFrame:
    """The rows whose key is found in ``members``, which has about ``count`` of them, and few others; null keys are left out.

    The keys lie in a broadcast set of bits of a fixed largest size: if full, it only lets more
    others pass. It stands before a join that shuffles the rows.
    """
    log_bits = min(_FILTER_BITS, max(10, (16 * count).bit_length()))
    slot = F.shiftrightunsigned(F.xxhash64(key), 64 - log_bits)
    place = (slot.bitwiseAND(F.lit(63))).cast("int")
    bits = members.where(F.col(key).isNotNull()).select(F.shiftrightunsigned(slot, 6).alias("_word"), place.alias("_place"))
    bits = bits.groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _place)")).alias("_bits"))
    found = frame.where(F.col(key).isNotNull()).withColumns({"_word": F.shiftrightunsigned(slot, 6), "_place": place}).join(F.broadcast(bits), "_word")
    return found.where(F.expr("shiftright(_bits, _place) & 1 = 1")).select(*(F.col(f"`{c}`") for c in frame.columns))


class Recent:
    """Which hashes a task has met lately, in a table of fixed size: what is forgotten only comes twice."""

    def __init__(self, log_slots: int = 16):
        self.shift = np.uint64(64 - log_slots)
        self.table = np.zeros(1 << log_slots, np.uint64)

    def new(self, hashes: np.ndarray) -> np.ndarray:
        """Positions of the hashes not known to have been met, each once; they count as met from now on."""
        found, first = np.unique(hashes, return_index=True)
        slots = found >> self.shift
        fresh = self.table[slots] != found
        self.table[slots[fresh]] = found[fresh]
        return np.sort(first[fresh])


def _libc():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # another C library
        return None


def give_back() -> None:
    """Give this process's free memory back to the system."""
    pa.default_memory_pool().release_unused()
    trim = _libc()
    if trim:
        trim(0)


def frugal(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task that gives its free memory back to the system at its end; Spark keeps the worker for later ones."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return whole


def record(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
