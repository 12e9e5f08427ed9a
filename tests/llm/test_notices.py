"""The license scan against exhaustive search by edit distance, and odd rows."""

import random
import re

import pytest

from footfall.llm import notices
from footfall.llm.common import documents
from footfall.llm.queries import queries
from tests.conftest import SMALL

EVERY = notices.BASE + notices.MORE


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def least_edits(found, phrase):
    """Edits of the best match of a phrase in a list of words that begins and ends at words' borders."""
    line = " ".join(found)
    starts = {0} | {i + 1 for i, c in enumerate(line) if c == " "}
    ends = {len(line)} | {i for i, c in enumerate(line) if c == " "}
    state = [0] + [10**9] * len(phrase)
    best = 10**9
    for j in range(len(line) + 1):
        if j:
            before, state = state, [10**9] * (len(phrase) + 1)
            for i in range(len(phrase) + 1):
                state[i] = before[i] + 1
                if i:
                    state[i] = min(state[i], before[i - 1] + (phrase[i - 1] != line[j - 1]))
        if j in starts:
            state[0] = 0
        for i in range(1, len(phrase) + 1):
            state[i] = min(state[i], state[i - 1] + 1)
        if j in ends:
            best = min(best, state[-1])
    return best


def expected(text):
    found = words(text)
    places = [(i, n.label) for n in notices.BASE for i in range(len(found)) if found[i : i + len(n.words.split())] == n.words.split()]
    near = [(n.label, least_edits(found, n.words), notices.tolerance(n.words)) for n in EVERY] if found else []
    near = [(label, 1 - e / (k + 1)) for label, e, k in near if e <= k]
    return (
        len(found), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None),
        ",".join(sorted({x for _, x in places})), ",".join(sorted({x for x, _ in near})), round(max([0, *(s for _, s in near)]), 6),
    )


def harmed(rng, phrase):
    out = list(phrase)
    for _ in range(rng.randint(0, 8)):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice("abé x9")
        elif kind == 1:
            out.insert(at, rng.choice("abé x9"))
        elif len(out) > 2:
            del out[at]
    return "".join(out)


def made():
    rng = random.Random(5)
    out = [
        None, "", " \n\t", "MIT License", "the MIT\n\n-- license, MIT license", "xmit license mit licensex", "mit", "license mit", "Licence MIT",
        "General Public license general PUBLIC license", "été MIT–license mit license été", "mit\x00license", "mit licens mit license", "\U0001f600mit license",
    ]
    for _ in range(250):
        parts = []
        for _ in range(rng.randint(1, 4)):
            phrase = rng.choice(EVERY).words
            parts.append(harmed(rng, phrase if rng.random() < 0.8 else phrase.title().replace(" ", "  (")))
            parts.append(" ".join(rng.choice(["the", "é", "mit", "license", "public", "all", "rights", "x"]) for _ in range(rng.randint(0, 5))))
        out.append(rng.choice([" ", "\n", ". "]).join(parts))
    return out


def test_made_texts(spark):
    texts = made()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: tuple(r)[1:-1] + (round(r.score, 6),) for r in notices.summary(notices.scan(docs)).collect()}
    wrong = [(t, got[i], expected(t)) for i, t in enumerate(texts) if got[i] != expected(t)]
    assert not wrong, wrong[:3]


def test_query(spark):
    texts = {r.doc_id: r.text for r in documents(spark, SMALL).collect()}
    got = {r.doc_id: tuple(r)[1:-1] + (round(r.score, 6),) for r in queries()["op11_license_scan"](spark, SMALL).collect()}
    assert got.keys() == texts.keys()
    short = [i for i in texts if len(texts[i]) < 1500 or got[i][4]]
    assert len(short) > 50
    for i in short:
        assert got[i] == expected(texts[i])


def test_spans(spark):
    text = "Été: see the MIT\n-- Licence!  General Public License"
    docs = spark.createDataFrame([(None, text), (1, text), (1, text)], "doc_id long, text string")
    for row in notices.scan(docs).collect():
        spans = [(h.label, text[h.start : h.start + h.length], h.edits, h.first_word, h.n_words) for h in row.hits]
        assert spans == [("mit", "MIT\n-- Licence", 1, 3, 2), ("gpl", "General Public License", 0, 5, 3)]


@pytest.mark.parametrize("base", [(), (notices.Notice("y", "été  LIBRE"),)])
def test_own_notices_odd_rows_and_long_texts(spark, base):
    long = "w é " * 900_000 + "été libre " + "x" * 3_000_000 + " été libre"  # longer than a piece
    rows = [(1, long, 7), (2, None, 8), (None, "", 9), (1, long, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hits int").withColumnRenamed("hits", "n_words")
    got = [tuple(r) for r in notices.summary(notices.scan(docs, base), base).collect()]
    found = (2, 1_800_000, 1_800_003, "y", "y", 1.0) if base else (0, None, None, "", "", 0.0)
    one = (1, 1_800_005, *found)
    none = (0, 0, None, None, "", "", 0.0)
    assert sorted(got, key=str) == sorted([one, one, (2, *none), (None, *none)], key=str)
    assert notices.summary(notices.scan(docs.where("false"), base), base).collect() == []
