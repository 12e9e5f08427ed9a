"""Nulls, empty and long texts, repeated rows, empty tables and clashing column names, for every operator and stage."""

import zlib

import pytest

import corpus_pipeline
from footfall.llm import ctw, decontam, language, linededup, packing, quality, sharding, simhash, substrings, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, tie string, row int, id string, own int, score string, h long, bucket int, part int"
LONG = " ".join(f"w{i % 977} the of" for i in range(30_000))
LINE = "a line that is long enough to be looked at"
ROWS = [
    (1, f"{LINE}\nsecond part of one text\n" + "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi", "en"),
    (2, f"{LINE}!\n" + "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi", "en"),
    (3, None, "en"), (4, "", None), (5, " \t\n ", "fr"), (6, "12 34 !!", "fr"), (7, LONG, "de"), (8, LONG, None),
    (9, "été où ça", "fr"), (9, "été où ça", "fr"), (9, "another text under the same id", "en"),
    (None, "text without an id", "en"), (None, None, None), (10, "Été \x1c\x85 \U0001f600 x", "fr"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, g, None, None if t is None else len(t), 0, "x", 1, "y", 2, "z", 3, 4, 5) for i, t, g in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(1, 11)] + [(None, 1, 1), (3, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    words = " ".join(f"w{i % 977} the of" for i in range(100, 110))
    return spark.createDataFrame([(1, words), (2, None), (3, ""), (None, "too short")], "item_id long, text string")


def operators(docs, labels, benchmark):
    return {
        "simhash": lambda d: simhash.groups(d),
        "keep_one": lambda d: simhash.keep_one(d),
        "language": lambda d: language.identify(d),
        "toxicity": lambda d: toxicity.classify(d, labels),
        "keep_clean": lambda d: toxicity.keep_clean(d, labels),
        "lines": lambda d: linededup.deduplicate(d),
        "packing": lambda d: packing.pack(d),
        "quality": lambda d: quality.judge(d, labels),
        "ctw": lambda d: ctw.score(d),
        "sharding": lambda d: sharding.assign(d),
        "substrings": lambda d: substrings.remove(d),
        "decontam": lambda d: decontam.overlaps(d, benchmark),
        "keep_unseen": lambda d: decontam.keep_unseen(d, benchmark),
    }


NAMES = list(operators(None, None, None))
PER_ROW = {"simhash", "language", "toxicity", "lines", "packing", "quality", "ctw", "sharding", "substrings"}


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(docs, labels, benchmark, name):
    out = operators(docs, labels, benchmark)[name](docs).collect()
    if name in PER_ROW:
        assert len(out) == len(ROWS)
        assert sorted(str(r.doc_id) for r in out) == sorted(str(i) for i, *_ in ROWS)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(docs, labels, benchmark, name):
    empty = docs.where("false")
    out = operators(docs, labels.where("false"), benchmark.where("false"))[name](empty)
    assert out.collect() == []


def test_defined_results(docs, labels, benchmark):
    prints = {(r.doc_id, r.tie): r for r in simhash.groups(docs).collect()}
    zero = [r for r in prints.values() if r.fp == 0]
    assert {r.component_id for r in zero} == {3}  # null and empty texts are linked
    langs = {(r.doc_id, r.lang_pred) for r in language.identify(docs).collect()}
    assert {(3, "und"), (4, "und"), (5, "und"), (6, "und")} <= langs
    stats = {r.doc_id: r for r in quality.judge(docs, labels).collect()}
    assert stats[3].n_words == 0 and stats[3].base_failed and not stats[3].kept
    assert stats[7].n_words == 90_000 and stats[7].base_failed
    scored = {r.doc_id: r for r in ctw.score(docs).collect()}
    assert scored[3].n_tokens == 1 and scored[3].score < 0
    assert scored[1].held_out == (zlib.crc32(b"1") % 7 == 2)
    removed = {(r.doc_id, r.n_words): r for r in substrings.remove(docs).collect()}
    assert removed[(8, 90_000)].n_removed == 90_000 and removed[(2, 31)].n_removed == 21
    lines = {r.doc_id: r.text for r in linededup.deduplicate(docs).collect()}
    assert lines[2].split("\n") == [] or LINE not in lines[2]  # one edit from a line of document 1
    assert lines[3] is None and lines[4] == "" and lines[8] == ""
    assert {r.doc_id for r in decontam.overlaps(docs, benchmark).collect()} == {7, 8}


def test_stages(spark, docs, tmp_path, labels, benchmark):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    now = docs
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, str(tmp_path))
        if number < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{number}")
        now = spark.read.parquet(f"{tmp_path}/{number}")
        assert stage(spark, docs.where("false"), str(tmp_path)).count() == 0
    assert now.count() > 0
