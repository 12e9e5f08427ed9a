"""License scan: short notices found in whole texts, also where a few characters differ.

A notice that may differ by ``k`` edits is cut into ``k + 1`` seeds; wherever it stands with at
most ``k`` edits, one of its seeds stands unharmed (pigeonhole). One automaton finds all seeds of
all notices in one pass over the text. Around each seed found, bounded-error matching of the
regex library verifies the whole notice and gives its span and its number of edits.

Texts are compared as words: ``A-Z`` lower-cased, runs of other ASCII than letters and digits are
one space. A match begins and ends at the border of a word.
"""

from __future__ import annotations

import bisect
import functools
from collections import defaultdict
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import pieces, record, split_words


class Notice(NamedTuple):
    label: str
    words: str


# The phrases whose exact places are counted.
BASE = (
    Notice("mit", "mit license"),
    Notice("apache", "apache license"),
    Notice("gpl", "general public license"),
)
MORE = (
    Notice("agpl", "gnu affero general public license"),
    Notice("apache", "licensed under the apache license version 2 0"),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Notice("bsd", "bsd 3 clause license"),
    Notice("cc", "licensed under cc by"),
    Notice("cc", "creative commons attribution"),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose"),
    Notice("lgpl", "gnu lesser general public license"),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    Notice("mpl", "mozilla public license"),
    Notice("public domain", "released into the public domain"),
    Notice("reserved", "all rights reserved"),
)
CHARS_PER_EDIT = 11  # a notice may differ by one edit for so many of its characters

# Lower case, digits and the bytes of other scripts stay; everything else parts words.
_WORD = np.array([b >= 128 or (b < 128 and chr(b).isalnum()) for b in range(256)])
_FOLDED = np.array([b + 32 if 65 <= b <= 90 else b if _WORD[b] else 32 for b in range(256)], np.uint8)
_SPACE, _END = 32, 10  # after words, and after texts


def folded(words: str) -> str:
    return " ".join(_FOLDED[np.frombuffer(words.encode(), np.uint8)].tobytes().decode().split())


def tolerance(words: str) -> int:
    return len(words) // CHARS_PER_EDIT


def seeds(words: str, edits: int) -> list[tuple[int, str]]:
    """(start, seed): the ``edits + 1`` parts of a notice, as long as each other but for one character."""
    cuts = [len(words) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, words[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Scanner:
    """The automaton and the patterns of a list of notices; made once in a task."""

    def __init__(self, notices: Sequence[Notice]):
        self.notices = [Notice(n.label, folded(n.words)) for n in notices]
        self.edits = [tolerance(n.words) for n in self.notices]
        self.patterns = [
            # No edit may take in the end of a text, or the mark of a window that begins or ends inside a word.
            regex.compile(rf"(?b)(?<=^|[ \n])(?:{regex.escape(n.words)}){{e<={k}:[^\x00\n]}}(?=[ \n]|$)")
            for n, k in zip(self.notices, self.edits, strict=True)
        ]
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for i, (notice, k) in enumerate(zip(self.notices, self.edits, strict=True)):
            for at, seed in seeds(notice.words, k):
                places[seed.encode().decode("latin-1")].append((i, len(notice.words[:at].encode())))
        self.automaton = ahocorasick.Automaton()
        for seed, found in places.items():
            self.automaton.add_word(seed, (len(seed), found))
        if places:
            self.automaton.make_automaton()
        self.verify = functools.lru_cache(maxsize=1 << 14)(self._verify)

    def _verify(self, number: int, around: bytes) -> tuple[int, int, int] | None:
        """First byte, byte after the last, and edits of the best match in the bytes around a seed."""
        text = around.decode("utf-8", "surrogateescape")
        found = self.patterns[number].search(text)
        if not found:
            return None
        first = len(text[: found.start()].encode("utf-8", "surrogateescape"))
        return first, first + len(found.group().encode("utf-8", "surrogateescape")), sum(found.fuzzy_counts)

    def hits(self, line: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(first byte, byte after the last, notice, edits) of all matches in folded bytes, in order of place.

        Every exact place counts; a place with edits counts if no match of that notice with
        fewer edits, or as many and an earlier start, overlaps it.
        """
        if not len(self.notices):
            return []
        raw = line.tobytes()
        starts: set[tuple[int, int]] = set()
        for last, (size, places) in self.automaton.iter(raw.decode("latin-1")):
            starts.update((number, last + 1 - size - before) for number, before in places)
        matches: dict[int, set[tuple[int, int, int]]] = defaultdict(set)
        for number, start in starts:
            spare = 4 * self.edits[number] + 1  # bytes of so many inserted characters, and of a border
            low = max(start - spare, 0)
            high = min(start + len(self.notices[number].words.encode()) + spare, len(raw))
            while low and raw[low] & 0xC0 == 0x80:
                low -= 1
            while high < len(raw) and raw[high] & 0xC0 == 0x80:
                high += 1
            # A window that begins or ends inside a word has no border there.
            around = raw[low:high] if not low or raw[low - 1] in (_SPACE, _END) else b"\0" + raw[low:high]
            shift = low - (len(around) - (high - low))
            if high < len(raw) and raw[high] not in (_SPACE, _END):
                around += b"\0"
            found = self.verify(number, around)
            if found:
                matches[number].add((found[2], found[0] + shift, found[1] + shift))
        out = []
        for number, places in matches.items():
            taken: list[tuple[int, int]] = []
            for edits, first, end in sorted(places):
                if not edits:
                    out.append((first, end, number, 0))
                    taken.append((first, end))
            inexact = _apart([p for p in sorted(places) if p[0]], sorted(taken))
            out += [(first, end, number, edits) for edits, first, end in inexact]
        return sorted(out)


def _apart(places: list[tuple[int, int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """The places that overlap none that is taken, nor one before them in the list. ``taken`` is sorted."""
    kept = []
    starts, ends = [a for a, _ in taken], [b for _, b in taken]
    for edits, first, end in places:
        after = bisect.bisect_left(starts, first)
        if (after and ends[after - 1] > first) or (after < len(starts) and starts[after] < end):
            continue
        starts.insert(after, first)
        ends.insert(after, end)
        kept.append((edits, first, end))
    return kept


def folded_line(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """All texts in folded form, one space after every word but perhaps the last, each text ended by a line feed."""
    low = _FOLDED[data]
    line = np.insert(low, offsets[1:], np.uint8(_END)) if len(data) else np.full(len(offsets) - 1, _END, np.uint8)
    parts = line <= _SPACE
    again = np.ones(len(line), bool)  # a space at the very start, or after another separator
    again[1:] = parts[:-1]
    return line[~((line == _SPACE) & again)]


_HIT = pa.struct([
    ("label", pa.string()), ("notice", pa.string()), ("edits", pa.int32()), ("tolerated", pa.int32()),
    ("first_word", pa.int64()), ("n_words", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
])
_SCANNED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("hits", pa.list_(_HIT))])


def _found(scanner: Scanner, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The words of every text, and its hits as a list column."""
    line = folded_line(data, offsets)
    inside = line > _SPACE
    before = np.ones(len(line), bool)
    before[1:] = ~inside[:-1]
    words = np.flatnonzero(inside & before)
    ends = np.flatnonzero(line == _END)
    upto = np.searchsorted(words, ends)
    from_word = np.concatenate([[0], upto[:-1]])
    hits = scanner.hits(line)
    first, last, number, edits = (np.array(x, np.int64) for x in zip(*hits, strict=True)) if hits else [np.empty(0, np.int64)] * 4
    text = np.searchsorted(ends, first)
    one = np.searchsorted(words, first, side="right") - 1
    past = np.searchsorted(words, last)
    # The same words, where they stand in the texts as given.
    if len(hits):
        starts, stops, _ = split_words(data, offsets, ~_WORD)
        chars = np.concatenate([[0], np.cumsum(data & 0xC0 != 0x80)])
        start = chars[starts[one]] - chars[offsets[text]]
        length = chars[stops[past - 1]] - chars[starts[one]]
    else:
        start = length = np.empty(0, np.int64)
    fields = [
        pa.array([scanner.notices[i].label for i in number], pa.string()),
        pa.array([scanner.notices[i].words for i in number], pa.string()),
        pa.array(edits, pa.int32()),
        pa.array([scanner.edits[i] for i in number], pa.int32()),
        pa.array(one - from_word[text]), pa.array(past - one), pa.array(start), pa.array(length),
    ]
    per_text = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(ends)))])
    lists = pa.ListArray.from_arrays(pa.array(per_text, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(_HIT)))
    return upto - from_word, lists


def scan(docs: DataFrame, notices: Sequence[Notice] = BASE + MORE) -> DataFrame:
    """doc_id, n_words and hits of every document: one row for a row, none dropped, no shuffle.

    ``hits`` lists every match in order of place: label, notice, edits and the edits tolerated,
    ``first_word`` (from 0) and ``n_words``, ``start`` (from 0) and ``length`` in characters of the
    text as given. Null and empty texts have no words and no hits; repeated rows get equal results;
    a null doc_id stays null; an empty table gives none; other columns are not looked at. A text is
    worked on whole. An edit is an inserted, left out or replaced character of the folded text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices)
        for batch in batches:
            for row, end, data, offsets in pieces(batch.column("text")):
                n_words, hits = _found(scanner, data, offsets)
                yield record(_SCANNED, doc_id=batch.column("doc_id")[row:end], n_words=n_words, hits=hits)

    hit = "label string, notice string, edits int, tolerated int, first_word long, n_words long, start long, length long"
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, n_words long, hits array<struct<{hit}>>")


def summary(found: DataFrame, base: Sequence[Notice] = BASE) -> DataFrame:
    """One row per scanned document: the exact places of the base notices, all labels, and a score.

    ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` tell of exact places of base notices
    (null words without one). ``labels`` are those of all hits. ``score`` is 0 without a hit, else the
    best hit's ``1 - edits / (tolerated + 1)``.
    """
    phrases = [folded(n.words) for n in base]
    exact = F.filter("hits", lambda h: (h["edits"] == 0) & h["notice"].isin(phrases))
    places = F.transform("exact", lambda h: h["first_word"])

    def names(hits: str):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["label"]))), ",")

    marks = F.transform("hits", lambda h: 1 - h["edits"] / (h["tolerated"] + 1))
    return found.withColumn("exact", exact).select(
        "doc_id",
        "n_words",
        F.size("exact").cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        names("exact").alias("base_labels"),
        names("hits").alias("labels"),
        F.coalesce(F.array_max(marks), F.lit(0.0)).alias("score"),
    )
