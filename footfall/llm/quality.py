"""Quality rules: text statistics in Spark SQL, and a learned decision list over them.

The list is learned by sequential covering from a table of counts: every labelled document
falls into a cell of binned statistics, Spark counts the cells, and rules are grown and pruned
on those counts. The rules come out as an ordered ``CASE WHEN`` over the statistics.
"""

from __future__ import annotations

import math
from collections import defaultdict
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import SPACE_REGEX, stored

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"

BINS = 8  # thresholds per statistic come from its octiles; cells are at most 8 ** 6
MAX_RULES = 12
MAX_CONDITIONS = 4
LOOKED_UP = 64  # repeated windows of a text that are looked up one by one; more are sorted
MIN_COVER = 10  # labelled documents a rule covers at least
MIN_PRECISION = 0.8  # of a rule on the pruning part

FEATURES = {
    "mean_word_chars": "word_chars / n_words",
    "symbol_share": "n_symbols / n_words",
    "repeat_share": "n_repeat_words / n_words",
    "dup_line_share": "n_dup_lines / n_words",
    "upper_share": "n_upper / word_chars",
    "mark_share": "n_marks / n_words",
}


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper, n_marks of every whole text.

    Null texts count as empty. All expressions work on one row; nothing is shuffled. A word is
    repeated if a window of three words that covers it occurs twice or more in the text: windows
    are sorted by their hash with their position, and the repeated ones give their words.
    """
    text = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", text.alias("t")).select(
        "doc_id", "t", F.expr(f"array_remove(split(t, '{_sql(SPACE_REGEX)}'), '')").alias("w")
    )
    hashes = "transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2]))"
    # An array that is used more than once is bound as a variable, so it is made once for a text.
    twice = "transform(array(sort_array(h)), s -> array_distinct(filter(s, (x, k) -> k > 0 and s[k - 1] = x)))[0]"
    # Positions of repeated windows: by looking each up while few are repeated; else the windows
    # are sorted with their positions, and neighbours compared.
    found = "filter(sequence(0, size(h) - 1), i -> array_contains(d, h[i]))"
    paired = (
        "transform(array(sort_array(transform(h, (x, i) -> struct(x as h, i as i)))), s -> sort_array(transform("
        "filter(s, (x, k) -> (k > 0 and s[k - 1].h = x.h) or (k + 1 < size(s) and s[k + 1].h = x.h)), x -> x.i)))[0]"
    )
    # Words covered by windows at sorted positions: three each, less the overlap with the next.
    counted = "aggregate({p}, struct(0L as n, -3 as last), (a, x) -> struct(a.n + least(3, x - a.last) as n, x as last)).n"
    covered = (
        f"transform(array({hashes}), h -> transform(array({twice}), d -> case when size(d) = 0 then 0L "
        f"when size(d) <= {LOOKED_UP} then {counted.format(p=found)} else {counted.format(p=paired)} end)[0])[0]"
    )
    # Stored, as a condition on these columns must not be moved below them and evaluated again.
    result = base.select(
        "doc_id",
        F.expr("cast(size(w) as long)").alias("n_words"),
        F.expr(f"cast(length(regexp_replace(t, '{_sql(SPACE_REGEX)}', '')) as long)").alias("word_chars"),
        F.expr("cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '')) as long)").alias("n_symbols"),
        F.expr(
            "transform(array(filter(split(t, '\\n'), l -> rlike(l, '[^\\\\x20\\\\x09-\\\\x0D]'))), "
            "l -> cast(size(l) - size(array_distinct(l)) as long))[0]"
        ).alias("n_dup_lines"),
        F.expr(f"case when size(w) < 4 then 0L else {covered} end").alias("n_repeat_words"),
        F.expr("cast(length(t) - length(regexp_replace(t, '\\\\p{Lu}+', '')) as long)").alias("n_upper"),
        F.expr("cast(length(t) - length(regexp_replace(t, '[.,;:!?]+', '')) as long)").alias("n_marks"),
    )
    return stored(result, "statistics")


def _sql(regex: str) -> str:
    return regex.replace("\\", "\\\\")


def base_failed(words: str = "n_words", repeats: str = "n_repeat_words") -> Column:
    return F.expr(f"{words} < {MIN_WORDS} or 100 * {repeats} > {MAX_REPEAT_PERCENT} * {words}")


class Condition(NamedTuple):
    """``feature`` is at most (or above) the threshold; ``bin`` is the threshold's number."""

    feature: str
    above: bool
    threshold: float
    bin: int


class Rule(NamedTuple):
    conditions: tuple[Condition, ...]
    label: int


Cell = tuple[int, ...]


def _holds(cell: Cell, conditions, names: list[str]) -> bool:
    return all((cell[names.index(c.feature)] > c.bin) == c.above for c in conditions)


def _covered(cells: dict[Cell, list[int]], conditions, names: list[str], label: int) -> tuple[int, int]:
    """Documents of the label, and of the other one, that a conjunction covers."""
    hit = [n for cell, n in cells.items() if _holds(cell, conditions, names)]
    return sum(n[label] for n in hit), sum(n[1 - label] for n in hit)


def _grow(cells, names, cuts, label) -> tuple[Condition, ...]:
    """Add the condition with the largest information gain until no other label is covered."""
    chosen: tuple[Condition, ...] = ()
    p, n = _covered(cells, (), names, label)
    while n and len(chosen) < MAX_CONDITIONS:
        left = {cell: c for cell, c in cells.items() if _holds(cell, chosen, names)}
        best, gain = None, 1e-9
        for f, name in enumerate(names):
            totals = defaultdict(lambda: [0, 0])
            for cell, c in left.items():
                totals[cell[f]][0] += c[label]
                totals[cell[f]][1] += c[1 - label]
            for b, threshold in enumerate(cuts[name]):
                low = [sum(v[k] for x, v in totals.items() if x <= b) for k in (0, 1)]
                for above in (False, True):
                    pp, nn = (p - low[0], n - low[1]) if above else low
                    if pp + nn < MIN_COVER or not pp:
                        continue
                    got = pp * (math.log2(pp / (pp + nn)) - math.log2(p / (p + n)))
                    if got > gain:
                        best, gain, after = Condition(name, above, threshold, b), got, (pp, nn)
        if best is None:
            break
        chosen, (p, n) = (*chosen, best), after
    return chosen


def _worth(cells, conditions, names, label) -> float:
    p, n = _covered(cells, conditions, names, label)
    return (p - n) / (p + n) if p + n else -1.0


def _prune(cells, conditions, names, label):
    """Drop last conditions while that does not hurt on documents not used for growing."""
    best = conditions
    for k in range(len(conditions) - 1, 0, -1):
        if _worth(cells, conditions[:k], names, label) >= _worth(cells, best, names, label):
            best = conditions[:k]
    return best


def cover(grow: dict[Cell, list[int]], prune: dict[Cell, list[int]], names: list[str], cuts: dict[str, list[float]]) -> list[Rule]:
    """Sequential covering of label 0 (rejected): each rule takes its documents away, until none is precise enough."""
    rules: list[Rule] = []
    while len(rules) < MAX_RULES and sum(c[0] for c in grow.values()) >= MIN_COVER:
        conditions = _grow(grow, names, cuts, 0)
        conditions = _prune(prune, conditions, names, 0) if conditions else ()
        if not conditions:
            break
        p, n = _covered(prune, conditions, names, 0)
        if not p or p / (p + n) < MIN_PRECISION:
            break
        rules.append(Rule(conditions, 0))
        grow = {cell: c for cell, c in grow.items() if not _holds(cell, conditions, names)}
        prune = {cell: c for cell, c in prune.items() if not _holds(cell, conditions, names)}
    return rules


def learn(stats: DataFrame, labels: DataFrame, target: str = "quality") -> list[Rule]:
    """A decision list from all labelled documents that pass the base rules.

    With several labels for an id the lowest counts; null labels and ids do not. One document in
    three (by crc32 of its id) prunes, the others grow. What reaches the driver is the thresholds
    and at most ``BINS ** features`` cells per part. No labelled rows: no rules, everything passes.
    """
    names = list(FEATURES)
    known = labels.where(f"doc_id is not null and {target} in (0, 1)").groupBy("doc_id").agg(F.min(target).alias("good"))
    rows = (
        stats.where(~base_failed())
        .join(known, "doc_id")
        .select("doc_id", "good", *[F.expr(e).cast("double").alias(n) for n, e in FEATURES.items()])
    )
    quantiles = [i / BINS for i in range(1, BINS)]
    found = rows.agg(*[F.percentile_approx(n, quantiles, 10000).alias(n) for n in names]).first()
    cuts = {n: sorted(set(found[n] or [])) for n in names}
    bins = [sum(((F.col(n) > c).cast("int") for c in cuts[n]), F.lit(0)).alias(n) for n in names]
    part = (F.crc32(F.col("doc_id").cast("string")) % 3 == 0).alias("prune")
    counted = rows.select("good", part, *bins).groupBy("prune", "good", *names).agg(F.count(F.lit(1)).alias("n"))
    cells: dict[bool, dict[Cell, list[int]]] = {False: {}, True: {}}
    for row in counted.collect():
        cells[row.prune].setdefault(tuple(row[n] for n in names), [0, 0])[row.good] += row.n
    return cover(cells[False], cells[True], names, cuts)


def verdict(rules: list[Rule]) -> Column:
    """True (kept) or false, by the first rule that holds; kept if none does."""
    out = None
    for rule in rules:
        whole = F.lit(True)
        for c in rule.conditions:
            value = F.expr(FEATURES[c.feature])
            whole = whole & ((value > c.threshold) if c.above else (value <= c.threshold))
        out = F.when(whole, bool(rule.label)) if out is None else out.when(whole, bool(rule.label))
    return F.lit(True) if out is None else out.otherwise(True)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The statistics of every document, base_failed, and kept: false if a base rule fails, else the learned verdict.

    Null and empty texts have no words and fail. Repeated rows get equal verdicts. Other columns
    are not looked at.
    """
    stats = statistics(docs)
    rules = learn(stats, labels)
    failed = base_failed()
    return stats.withColumn("base_failed", failed).withColumn(
        "kept", F.when(F.col("base_failed"), False).otherwise(verdict(rules))
    )
