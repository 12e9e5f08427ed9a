"""Spelling variants against plain Python, filters of any size, and odd rows."""

import random
import re
import zlib
from collections import Counter

import pytest

from footfall.llm import spelling
from footfall.llm.queries import oracle_sql, queries
from tests.compare import connect, difference
from tests.conftest import SMALL


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def expected(rows):
    counts = Counter()
    for doc_id, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}
    forms, out = {}, set()
    for w, n in words.items():
        found = [x for x in words if near(w, x)]
        best = min(found, key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best and words[best] >= 2 * n else None
        out.add((w, forms[w], n, len(found), words[best] if forms[w] else None))
    roots = {}
    for w in words:
        roots[w] = w
        while forms[roots[w]]:
            roots[w] = forms[roots[w]]
    return {(w, f, roots[w], n, k, m) for w, f, n, k, m in out}


def made():
    rng = random.Random(3)
    stems = ["letter", "Éclair", "hôtel×x", "straße", "banana", "aaaaaa", "committee", "ÿÿÿÿÿ", "z" * 70]
    rows = [(None, "LETTER letter Letter"), (1, None), (2, ""), (3, "x y z 12 !"), (3, "letter letters letterss " * 3)]
    for i in range(300):
        words = []
        for _ in range(rng.randint(1, 30)):
            w = list(rng.choice(stems))
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                at = rng.randrange(len(w))
                kind = rng.randrange(3)
                if kind == 0:
                    w[at] = rng.choice("aebxÀéÿ")
                elif kind == 1:
                    w.insert(at, rng.choice("aebxÀéÿ"))
                else:
                    del w[at]
            words.append("".join(w))
        rows.append((i * 7, rng.choice([" ", ", ", "\n"]).join(words)))
    return rows


@pytest.mark.parametrize("most", [spelling.MAX_BLOCKS, 3])
def test_made_texts(spark, monkeypatch, most):
    """Also with filters so full that nearly everything passes: then the joins decide alone."""
    monkeypatch.setattr(spelling.build_filter, "__defaults__", (most,))
    rows = made()
    docs = spark.createDataFrame([(i, t, "w", 1) for i, t in rows], "doc_id long, text string, word string, n int").repartition(3)
    got = [tuple(r) for r in spelling.group(docs).collect()]
    assert len(got) == len(set(got)) and set(got) == expected(rows)
    assert spelling.group(docs.where("false")).collect() == []
    assert spelling.group(docs.where("text is null")).collect() == []


def test_query_equals_oracle(spark):
    rows, problem = difference(queries()["op13_spelling_variants"](spark, SMALL), connect(SMALL), oracle_sql()["op13_spelling_variants"])
    assert rows and problem is None, problem


def test_long_runs_and_long_ways(spark):
    # A way of five forms, and a run longer than the slices that texts are read in.
    way = ["aaaaa", "aaaaab", "aaaaabb", "aaaaabbb", "aaaaabbbb"]
    text = " ".join(w for i, w in enumerate(way) for _ in range(3 * 2**i))
    long = "ab" * 700_000
    rows = [(1, text), (2, f"{long} {long}"), (2, f"{long}c, {long}c {long} {long} {long} {long}c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.word: r for r in spelling.group(docs, harmed=0).collect()}
    assert {got[w].root for w in way} == {way[-1]} and got[way[0]].form == way[1]
    assert got[long].n == 5 and got[long + "c"].n == 3 and got[long].n_near == got[long + "c"].n_near == 1
