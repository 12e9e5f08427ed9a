"""The operators on given tables against plain Python, and their parts against exhaustive checks."""

import collections
import itertools
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

import __spark_entry__ as contract
from footfall.llm import common, ctw, decontam, language, linededup, packing, quality, simhash, substrings, toxicity
from footfall.llm.common import documents, fold, likely
from footfall.llm.queries import oracle_sql, queries
from tests.compare import connect, difference
from tests.conftest import SMALL

WORD = re.compile("[^\x20\x09-\x0d]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in documents(spark, SMALL).select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def toxic(spark):
    return {r.doc_id: r.toxic for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}


def test_registered():
    assert set(queries()) | {"pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_equals_oracle(spark, name):
    _, problem = difference(queries()[name](spark, SMALL), connect(SMALL), oracle_sql()[name])
    assert problem is None, problem


def fingerprint(text):
    words = WORD.findall(low(text))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, texts):
    got = {r.doc_id: r for r in queries()["op1_simhash_neardup"](spark, SMALL).collect()}
    prints = {i: fingerprint(t) for i, t in texts.items()}
    assert {i: f"{p:016x}" for i, p in prints.items()} == {i: r.fingerprint for i, r in got.items()}
    lowest = dict.fromkeys(texts)
    for i in sorted(texts):
        if lowest[i] is None:
            todo, lowest[i] = [i], i
            while todo:
                at = todo.pop()
                for j in texts:
                    if lowest[j] is None and (prints[at] ^ prints[j]).bit_count() <= 4:
                        lowest[j] = i
                        todo.append(j)
    assert lowest == {i: r.component_id for i, r in got.items()}


@pytest.mark.parametrize("base", [3, 40, 2000])
def test_vantage_points_lose_no_link(base):
    rng = np.random.default_rng(base)
    points = rng.integers(0, 2**64, base, dtype=np.uint64)[rng.integers(0, base, 1500)]
    for _ in range(4):
        points ^= np.uint64(1) << rng.integers(0, 64, len(points)).astype(np.uint64)
    points = np.unique(points)
    edges = simhash.linked_pairs(points, 4)
    assert all((int(points[a]) ^ int(points[b])).bit_count() <= 4 for a, b in edges)
    some, every = simhash._Forest(len(points)), simhash._Forest(len(points))
    for a, b in edges:
        some.link(a, b)
    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(points ^ points[i]) <= 4):
            every.link(i, int(j))
    everything = np.arange(len(points))
    assert np.array_equal(some.roots(everything), every.roots(everything))


def test_connected(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 200), (300, 200), (7, 7)]
    roots = {r.node: r.root for r in simhash.connected(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert roots == {**dict.fromkeys(range(41), 0), 100: 100, 200: 100, 300: 100}


def test_language_held_out(spark):
    docs = documents(spark, SMALL)
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = language.identify(docs).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    held = [r.lang_pred == truth[r.doc_id] for r in got if r.held_out]
    assert sum(held) >= 0.95 * len(held)


def test_language_brute_force(spark, texts):
    """Counts of n-grams and log scores again, in plain Python, from the documented rule."""
    docs = documents(spark, SMALL)
    langs = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}

    def grams(text):
        letters = []
        for c in text:
            code = ord(c)
            if code >= 0x10000:
                letters.append(0x10000)
            else:
                letters.append((ord(c.lower()) if len(c.lower()) == 1 else code) if c.isalpha() else 32)
        for size in language.NGRAMS:
            for at in range(len(letters) - size + 1):
                part = letters[at : at + size]
                if any(x != 32 for x in part):
                    value = size * 0x2545F491 & 0xFFFFFFFF
                    for x, step in zip(part, language._STEPS, strict=False):
                        value = (value ^ x) * int(step) & 0xFFFFFFFF
                        value ^= value >> 15
                    yield (value * int(language._STEPS[3]) & 0xFFFFFFFF) >> 32 - language.LOG_BUCKETS

    counts, docs_of = collections.defaultdict(collections.Counter), collections.Counter()
    for i, t in texts.items():
        if langs[i] is not None and t is not None and zlib.crc32(str(i).encode()) % 5:
            counts[langs[i]].update(grams(t))
            docs_of[langs[i]] += 1
    size = 1 << language.LOG_BUCKETS
    totals = {g: sum(c.values()) + language.SMOOTHING * size for g, c in counts.items()}
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    for i in sorted(texts)[:60]:
        own = collections.Counter(grams(texts[i]))
        logs = {
            g: math.log(docs_of[g] / sum(docs_of.values())) + sum(n * math.log((c[b] + language.SMOOTHING) / totals[g]) for b, n in own.items())
            for g, c in counts.items()
        }
        best = min(logs, key=lambda g: (-logs[g], g))
        assert got[i].lang_pred == (best if any(c.isalpha() for c in texts[i]) else "und")
        if own:
            assert math.isclose(got[i].score, 1 / sum(math.exp(x - logs[best]) for x in logs.values()), rel_tol=1e-3)


def test_language_without_letters(spark):
    rows = [(1, "the cat", "en"), (2, "der Hund", "de"), (3, "²", None), (4, "½ 12", None), (5, "Ⅷ _", None), (6, "² ñ", None), (7, "٣", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language.identify(docs, folds=10**9).collect()}
    assert [got[i] for i in (3, 4, 5, 7)] == ["und"] * 4 and got[6] != "und"


def test_more_values_of_lang_than_are_learned(spark):
    rows = [(i, "the cat and the dog", "en") for i in range(5)] + [(10 + i, "der Hund und die Katze", "de") for i in range(5)]
    rows += [(100 + i, f"dirt {i}", f"value {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language.identify(docs, folds=10**9).collect()}
    assert got[0] == "en" and got[10] == "de" and len(got) == 310
    model = language.fit(docs, language.F.lit(True))
    assert len(model.languages) == language.MAX_LANGUAGES


def test_convolution_brute_force():
    """``logits`` against a loop over every window of every text."""
    rng = np.random.default_rng(5)
    taps = [rng.normal(size=(w, 1 << toxicity.LOG_WORDS, toxicity.FILTERS)).astype(np.float32) for w in toxicity.WIDTHS]
    for t in taps:
        t[:, toxicity.PAD] = 0
    dense = rng.normal(size=len(toxicity.WIDTHS) * toxicity.FILTERS).astype(np.float32)
    bias = rng.normal(size=(len(toxicity.WIDTHS), toxicity.FILTERS)).astype(np.float32)
    model = toxicity.Model(taps, bias, dense, 0.25, None, np.zeros(1))
    raw = [b"", b"one", b"You are, one TWO three\nfour", b"!!", b"a b"]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    words, pointers = toxicity.buckets(np.frombuffer(b"".join(raw), np.uint8), offsets)
    assert np.diff(pointers).tolist() == [0, 1, 6, 0, 2]
    got = toxicity.logits(model, words, pointers)
    for k, (a, b) in enumerate(itertools.pairwise(pointers)):
        total = 0.25
        for i, width in enumerate(toxicity.WIDTHS):
            windows = []
            for at in range(max(b - a, 1)):
                inside = [(t, words[a + at + t]) for t in range(width) if at + t < b - a]
                windows.append(sum((taps[i][t, w] for t, own in inside for w in own), np.zeros(toxicity.FILTERS)))
            total += np.maximum(np.max(windows, axis=0) + bias[i], 0) @ dense[i * toxicity.FILTERS : (i + 1) * toxicity.FILTERS]
        assert math.isclose(got[k], total, rel_tol=1e-4, abs_tol=1e-4)


def test_toxicity_held_out_alone(spark):
    """Recall on held-out documents only, where there are enough of them."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = {r.doc_id: r for r in toxicity.classify(documents(spark, folder), labels).collect()}
    held = [(got[r.doc_id].predicted, r.toxic) for r in labels.collect() if got[r.doc_id].held_out]
    caught, clean = [p == 1 for p, t in held if t == 1], [p == 0 for p, t in held if t == 0]
    assert len(caught) > 50 and sum(caught) >= 0.9 * len(caught) and sum(clean) >= 0.98 * len(clean)


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = {r.doc_id: r for r in toxicity.classify(documents(spark, folder), labels).collect()}
    marks = {r.doc_id: r.toxic for r in labels.collect()}
    clean = [got[i].predicted == 0 for i, t in marks.items() if t == 0]
    caught = [got[i].predicted == 1 for i, t in marks.items() if t == 1]
    assert sum(clean) >= 0.97 * len(clean) and sum(caught) >= 0.7 * len(caught)
    assert all((r.score >= 0.5) == (r.predicted == 1) for r in got.values())


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance_and_segments():
    rng = random.Random(4)
    for _ in range(2000):
        a = [rng.choice("abc") for _ in range(rng.randint(0, 9))]
        b = a[:]
        for _ in range(rng.randint(0, 3)):
            if b and rng.random() < 0.5:
                b.pop(rng.randrange(len(b)))
            else:
                b.insert(rng.randint(0, len(b)), rng.choice("abc"))
        a, b = "".join(a), "".join(b)
        apart = distance(a, b)
        for k in (1, 2, 3):
            assert linededup.within(a, b, k) == (apart <= k)
            x, y = (a, b) if len(a) >= len(b) else (b, a)
            if len(y) > k >= apart:
                cut = linededup.segments(len(y), k)
                assert any(x[at : at + n] == y[cut[i][0] : cut[i][0] + n] for i, at, n in linededup.probes(len(x), len(y), k))
                assert (linededup.bag(x) ^ linededup.bag(y)).bit_count() <= 2 * k


@pytest.mark.parametrize("edits,hot", [(1, linededup.HOT), (1, 3), (1, 10), (2, 3)])
def test_near_lines_against_all_pairs(spark, edits, hot):
    """The whole operator, also at two edits: no near line is missed, and none is removed without one."""
    rng = random.Random(edits)
    bases = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(20, 30))) for _ in range(25)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(1, 5)):
            line = list(rng.choice(bases))
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                at, kind = rng.randrange(len(line)), rng.randrange(3)
                line[at : at + (kind < 2)] = [] if kind == 0 else [rng.choice("abcdé ")]
            lines.append("".join(line))
        rows.append((i, "\n".join([*lines, "short"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.text for r in linededup.deduplicate(docs, edits, hot=hot).collect()}
    firsts = {}
    for i, text in rows:
        for n, line in enumerate(text.split("\n")):
            if len(line) >= 20:
                firsts.setdefault(line, (i, n))
    gone = {x for x in firsts for y in firsts if firsts[y] < firsts[x] and abs(len(x) - len(y)) <= edits and distance(x, y) <= edits}
    for i, text in rows:
        kept = [x for n, x in enumerate(text.split("\n")) if len(x) < 20 or (firsts[x] == (i, n) and x not in gone)]
        assert got[i] == "\n".join(kept)
    assert 5 < len(gone) < len(firsts)


def test_a_template_is_split(spark):
    """Very many lines that share most of their text, in small Arrow batches: groups go over batch borders."""
    rng = random.Random(6)
    numbers = rng.sample(range(10**6), 6000)
    lines = [f"the request was served by host number {n:06d} at noon" for n in numbers]
    lines += [f"a{rng.random()} the request was served by nobody" for _ in range(500)]
    docs = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "doc_id long, text string").repartition(6)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "700")
    try:
        got = {r.doc_id for r in linededup.deduplicate(docs, hot=500).where("text = ''").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    seen, want = {}, set()
    for i, n in enumerate(numbers):
        digits = f"{n:06d}"
        masked = [digits[:k] + "?" + digits[k + 1 :] for k in range(6)]
        if any(m in seen for m in masked):
            want.add(i)
        seen |= dict.fromkeys(masked, i)
    assert got == want and len(want) > 50


def test_optimal_buckets():
    rng = np.random.default_rng(0)
    for _ in range(150):
        n = int(rng.integers(1, 9))
        lengths, counts, k = np.sort(rng.choice(50, n, replace=False)), rng.integers(1, 9, n), int(rng.integers(1, 5))

        def padding(tops):
            return sum(c * (min(t for t in tops if t >= x) - x) for x, c in zip(lengths, counts, strict=True))

        best = min(padding([*x, lengths[-1]]) for j in range(min(k, n)) for x in itertools.combinations(lengths[:-1], j))
        found = packing.boundaries(lengths, counts, k)
        assert padding(found) == best and len(found) <= k


def test_batches(spark):
    got = packing.pack(documents(spark, SMALL), budget=3000).toPandas()
    size = got.groupby(["bucket", "batch"]).agg(rows=("slot", "size"), top=("slot", "max"), tokens=("bucket_length", "sum"), one=("bucket_length", "max"))
    assert (size.rows == size.top + 1).all() and ((size.tokens <= 3000) | (size.rows == 1)).all()
    assert (got.padding >= 0).all() and not got.duplicated(["bucket", "batch", "slot"]).any()


def test_quality_statistics(spark, texts):
    for r in quality.statistics(documents(spark, SMALL)).collect():
        text = texts[r.doc_id] or ""
        words = WORD.findall(text)
        windows = collections.Counter(zip(words, words[1:], words[2:], strict=False))
        covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        want = len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want


def test_decision_list():
    grow = {(0, x): [0, 40] for x in range(3)} | {(1, 0): [30, 1], (1, 1): [0, 30], (1, 2): [25, 0]}
    rules = quality.cover(grow, grow, ["a", "b"], {"a": [0.5], "b": [0.5, 1.5]})
    kept = {cell: not any(quality._holds(cell, r.conditions, ["a", "b"]) for r in rules) for cell in grow}
    assert [cell for cell, k in kept.items() if not k] == [(1, 0), (1, 2)]


def test_kept_follows_the_learned_list(spark):
    """``kept`` again by walking the list in plain Python, and what it does to labelled documents."""
    folder = "/root/testdata/sf0.01"
    docs, labels = documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet")
    rules = quality.learn(quality.statistics(docs), labels)
    got = {r.doc_id: r for r in quality.judge(docs, labels).collect()}

    def value(row, feature):
        over, under = quality.FEATURES[feature].split(" / ")
        return row[over] / row[under]

    for row in got.values():
        assert row.base_failed == (row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words)
        want = not row.base_failed
        if want:
            for rule in rules:
                if all((value(row, c.feature) > c.threshold) == c.above for c in rule.conditions):
                    want = bool(rule.label)
                    break
        assert row.kept == want
    marks = {r.doc_id: r.quality for r in labels.where("quality is not null").collect()}
    judged = [(got[i].kept, q) for i, q in marks.items() if not got[i].base_failed]
    bad, good = [not k for k, q in judged if q == 0], [k for k, q in judged if q == 1]
    assert rules and sum(bad) >= 0.9 * len(bad) and sum(good) >= 0.98 * len(good)


def test_no_python_in_native_operators(spark):
    for name in ("op6_quality_rules", "op8_sharding"):
        plan = queries()[name](spark, SMALL)._jdf.queryExecution().toString()
        assert "Python" not in plan and "InArrow" not in plan


def test_base_score(spark, texts):
    got = {r.doc_id: r for r in ctw.score(documents(spark, SMALL)).collect()}
    learned = [low(t) for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = collections.Counter(w for t in learned for w in WORD.findall(t))
    total, distinct = sum(counts.values()) + len(learned), len(counts) + 1
    for i, t in texts.items():
        words = WORD.findall(low(t))
        want = sum(math.log10((c + 1) / (total + distinct + 1)) for c in [*(counts[w] for w in words), len(learned)])
        assert math.isclose(got[i].base_score, want, rel_tol=1e-9)
        assert got[i].n_known == sum(counts[w] > 0 for w in words) + 1 and got[i].train_tokens == total


def test_context_tree(spark):
    """Every context's bytes have probabilities that sum to one, equal to a direct mixture over its suffixes."""
    rng = np.random.default_rng(2)
    text = bytes(rng.choice(list(b"abcd"), 400).tolist())
    levels = []
    for d in range(4):
        found = collections.defaultdict(lambda: np.zeros(256))
        for i in range(3, len(text)):
            found[int.from_bytes(text[i - d : i], "big")][text[i]] += 1
        keys = sorted(found)
        levels.append((np.array(keys), np.stack([found[k] for k in keys])))
    tree = ctw.build([ctw.Level.of(np.repeat(keys, 256), np.tile(np.arange(256), len(keys)), cells.ravel()) for keys, cells in levels])
    assert np.allclose((10.0**tree.logs).sum(axis=1), 1, atol=1e-4)

    def estimate(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(a + b + 1)

    def first_bits(d, key):  # counts of the third decision below the bits 011, where a to d part from nothing
        cells = levels[d][1][list(levels[d][0]).index(key)]
        return cells[96:112].sum(), cells[112:128].sum()

    def weighted(d, key):
        own = estimate(*first_bits(d, key))
        if d == 3:
            return own
        below = sum(weighted(d + 1, int(k)) for k in levels[d + 1][0] if k & ((1 << 8 * d) - 1) == key)
        return np.logaddexp(own, below) - math.log(2)

    def mixed(d, key, path):
        a, b = first_bits(d, key)
        own = (b + 0.5) / (a + b + 1)
        if d == path:
            return own
        stop = math.exp(estimate(a, b) - math.log(2) - weighted(d, key))
        return stop * own + (1 - stop) * mixed(d + 1, context & ((1 << 8 * (d + 1)) - 1), path)

    context = int(levels[3][0][0])
    row = 10.0 ** tree.logs[tree.rows[3][0]]
    assert math.isclose(row[112:128].sum() / row[96:128].sum(), mixed(0, 0, 3), rel_tol=1e-4)


@pytest.mark.parametrize("times", [1, 10**5, 10**10])
def test_context_tree_with_large_counts(times):
    rng = np.random.default_rng(3)
    text = rng.choice(list(b"abcd \n"), 3000, p=[0.4, 0.2, 0.2, 0.1, 0.05, 0.05])
    levels = []
    for d in range(4):
        context = sum((text[3 - i : len(text) - i].astype(np.int64) << 8 * (i - 1) for i in range(1, d + 1)), np.zeros(len(text) - 3, np.int64))
        pairs, n = np.unique(context * 256 + text[3:], return_counts=True)
        levels.append(ctw.Level.of(pairs >> 8, pairs & 255, n * times + rng.integers(0, 2) * (d == 0)))
    tree = ctw.build(levels)
    assert np.isfinite(tree.logs).all() and np.allclose((10.0**tree.logs).sum(axis=1), 1, atol=1e-4)
    maps = ctw.row_maps(tree)
    data = np.frombuffer(b"abcdabzz\xc3\xa9a", np.uint8)
    offsets = np.array([0, 4, 4, len(data)])
    got = ctw.byte_scores(tree, maps, data, offsets)
    for i, (a, b) in enumerate(itertools.pairwise(offsets)):
        line, want = bytes([ctw.EDGE] * 3) + data[a:b].tobytes() + bytes([ctw.EDGE]), 0.0
        for j in range(3, len(line)):
            for d in range(3, -1, -1):
                context = int.from_bytes(line[j - d : j], "big")
                at = np.flatnonzero(tree.contexts[d] == context)
                if len(at):
                    want += float(tree.logs[tree.rows[d][at[0]], line[j]])
                    break
        assert math.isclose(got[i], want, rel_tol=1e-5)


def test_score_is_the_sum_of_a_plain_loop(spark, texts):
    docs = documents(spark, SMALL)
    model, _ = ctw.fit(docs, ctw.fold("doc_id", 7) != 2)
    got = {r.doc_id: r for r in ctw.score(docs).collect()}
    known = [dict(zip(c.tolist(), r.tolist(), strict=True)) for c, r in zip(model.tree.contexts, model.tree.rows, strict=True)]
    for i in sorted(texts)[:40]:
        raw = low(texts[i]).encode()
        line, want = bytes([ctw.EDGE] * 3) + raw + bytes([ctw.EDGE]), 0.0
        for j in range(3, len(line)):
            d = next(d for d in range(3, -1, -1) if int.from_bytes(line[j - d : j], "big") in known[d])
            want += float(model.tree.logs[known[d][int.from_bytes(line[j - d : j], "big")], line[j]])
        assert math.isfinite(got[i].score) and math.isclose(got[i].score, want, rel_tol=1e-5)
        assert math.isclose(got[i].bits_per_byte, -want * math.log2(10) / (len(raw) + 1), rel_tol=1e-5)


@pytest.mark.parametrize("cut", [substrings.PARTS, ((1, 3),), ((2, 2), (9, 5), (30, 40))])
def test_substrings_small_batches(spark, cut):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(80):
        text = []
        for _ in range(rng.randint(0, 5)):
            a = rng.randint(0, 50)
            text += base[a : a + rng.randint(1, 40)] if rng.random() < 0.8 else ["x"] * rng.randint(1, 30)
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        got = {r.doc_id: r.kept for r in substrings.remove(docs, cut=cut).collect()}
        factors = substrings.factors(docs, cut=cut).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    seen, words = set(), {i: t.split() for i, t in rows}
    for i, w in words.items():
        gone = set()
        for p in range(len(w) - 19):
            key = tuple(w[p : p + 20])
            gone |= set(range(p, p + 20)) if key in seen else set()
            seen.add(key)
        assert got[i] == " ".join(x for j, x in enumerate(w) if j not in gone)
    for f in factors:
        assert words[f.doc_id][f.start : f.start + f.words] == words[f.source_id][f.source_start : f.source_start + f.words]
        assert (f.source_id, f.source_start) < (f.doc_id, f.start)


def test_masks_survive_a_fifth_of_substitutions():
    for size in range(decontam.SHORTEST, decontam.STRETCH + 1):
        compared, needed = decontam.stretch(size)
        for changed in itertools.combinations(range(size), compared - needed):
            assert any(
                not any(mask[c - at] == "1" for c in changed if 0 <= c - at < len(mask))
                for mask in decontam.MASKS for at in range(size - len(mask) + 1)
            )


def test_overlaps(spark, texts):
    token = re.compile("[0-9a-z\x80-\U0010ffff]+")
    items = {r.item_id: token.findall(low(r.text)) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    want = set()
    for i, t in texts.items():
        words = token.findall(low(t))
        for k, item in items.items():
            if len(item) < decontam.SHORTEST:
                continue
            size, needed = decontam.stretch(len(item))
            met = {w: [j for j, x in enumerate(item) if x == w] for w in set(item)}
            starts = collections.Counter()
            for p, w in enumerate(words):
                for j in met.get(w, ()):
                    starts[p - j] += 1
            for shift, n in starts.items():
                if n >= needed:
                    equal = [0 <= shift + j < len(words) and words[shift + j] == x for j, x in enumerate(item)]
                    inside = [0 <= shift + j < len(words) for j in range(len(item))]
                    if any(sum(equal[j : j + size]) >= needed and all(inside[j : j + size]) for j in range(len(item) - size + 1)):
                        want.add((i, k))
    got = {(r.doc_id, r.item_id) for r in queries()["op10_decontamination"](spark, SMALL).collect()}
    assert got == want and got


def test_short_items_match_whole(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(12)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(1 + k % 14))) for k in range(40)] + [(90, ""), (91, None), (92, "!!")]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))) for i in range(120)]
    rows += [(200 + k, f"W3 {t.upper()}, x") for k, t in items[:40]]
    docs, benchmark = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {}
    for r in decontam.overlaps(docs.repartition(3), benchmark).collect():
        got[(r.doc_id, r.item_id)] = (r.first_word, r.last_word, r.matched, r.compared)
    for k, item in items:
        own = (item or "").replace("!!", "").split()
        if not 0 < len(own) < decontam.SHORTEST:
            assert len(own) >= decontam.SHORTEST or not [g for g in got if g[1] == k]
            continue
        for i, text in rows:
            words = [w.strip(",").lower() for w in text.split()]
            at = [p for p in range(len(words) - len(own) + 1) if words[p : p + len(own)] == own]
            want = (at[0], at[-1] + len(own) - 1, len(own), len(own)) if at else None
            assert got.get((i, k)) == want


def test_pipeline_ends(spark, toxic):
    import corpus_pipeline

    got = corpus_pipeline.run(spark, SMALL).toPandas()
    assert len(got) == got.doc_id.nunique() and len(got) > 0.7 * documents(spark, SMALL).count()
    assert corpus_pipeline.ORACLE_SQL is None


def test_contexts_outside_of_the_broadcast_tree_score_alike(spark, monkeypatch):
    """With few contexts broadcast, all others count and score as if they were there too."""
    rng = np.random.default_rng(11)
    texts = ["".join(rng.choice(list("abcdeé \n"), size=rng.integers(0, 120)).tolist()) for _ in range(60)] + [None, ""]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    want = {r.doc_id: r for r in ctw.score(docs).collect()}
    monkeypatch.setattr(ctw, "CONTEXTS", 40)
    got = {r.doc_id: r for r in ctw.score(docs).collect()}
    assert got.keys() == want.keys() == set(range(len(texts)))
    for i, row in want.items():
        assert math.isclose(got[i].score, row.score, rel_tol=1e-6) and math.isclose(got[i].bits_per_byte, row.bits_per_byte, rel_tol=1e-6)
        assert (got[i].n_known, got[i].n_tokens) == (row.n_known, row.n_tokens) and math.isclose(got[i].base_score, row.base_score, rel_tol=1e-9)


def test_toxicity_learns_from_documents_that_the_sample_leaves_out(spark, monkeypatch):
    """Documents too long for the sample train the model and set its thresholds all the same."""
    monkeypatch.setattr(toxicity, "SAMPLE_WORDS", 5)
    rng = np.random.default_rng(5)
    pool = [f"word{i}" for i in range(200)]
    data = []
    for i in range(3000):
        words = rng.choice(pool, rng.integers(8, 15)).tolist()
        toxic = int(i % 4 == 0)
        if toxic:
            words[int(rng.integers(0, len(words)))] = "vile"
        data.append((i, " ".join(words), toxic))
    frame = spark.createDataFrame(data, "doc_id long, text string, toxic int").coalesce(2)
    docs = frame.selectExpr("doc_id", "text", "'en' AS lang")
    got = toxicity.classify(docs, frame.select("doc_id", "toxic")).where("held_out").collect()
    right = [r.predicted == int(r.doc_id % 4 == 0) for r in got]
    assert len(right) > 400 and sum(right) >= 0.95 * len(right)


def test_toxicity_shuffles_texts_of_labelled_documents_only(spark, monkeypatch):
    """Of many documents few are labelled; no others are joined to their labels."""
    data = [(i, f"words of text {i} " + ("vile" if i % 40 == 0 else "mild")) for i in range(4000)]
    docs = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "'en' AS lang")
    labels = docs.where("doc_id % 20 = 0").selectExpr("doc_id", "int(doc_id % 40 = 0) AS toxic")
    join, joined = type(docs).join, []

    def spy(self, other, on=None, how=None):
        if on == "doc_id" and "text" in self.columns and "toxic" in other.columns:
            joined.append(self.count())
        return join(self, other, on, how)

    monkeypatch.setattr(type(docs), "join", spy)
    learned = labels.where(fold("doc_id", 5) != 0).count()
    assert toxicity.fit(docs, labels, fold("doc_id", 5) != 0) is not None
    assert joined and learned <= max(joined) <= 2.5 * learned


def test_likely_rows_hold_all_members(spark, monkeypatch):
    frame = spark.createDataFrame([(i % 5000 if i % 7 else None, i) for i in range(10_000)], "key long, n int")
    members = spark.createDataFrame([(i,) for i in [*range(0, 5000, 50), -1, -2]] + [(None,)], "key long")
    wanted = {r.n for r in frame.where("key % 50 = 0").collect()}
    found = likely(frame, members, "key", 102)
    assert found.columns == frame.columns
    got = [r.n for r in found.collect()]
    assert len(got) == len(set(got)) and wanted <= set(got) and len(got) <= 2 * len(wanted) + 1000
    monkeypatch.setattr(common, "_FILTER_BITS", 6)  # so full that it tells nothing apart
    got = [r.n for r in likely(frame, members, "key", 102).collect()]
    assert len(got) == len(set(got)) and wanted <= set(got)
    assert likely(frame, members.where("false"), "key", 0).collect() == []


def test_toxicity_sample_reaches_the_driver_in_two_bytes_a_bucket(spark, monkeypatch):
    """And what the sample took is given back to the system before all documents are trained on."""
    docs = documents(spark, SMALL)
    fetch, freed, given, widths, after = type(docs).toArrow, toxicity.give_back, [], [], []

    def spy(self):
        if "words" in self.columns:
            widths.append((table := fetch(self))["words"].type.value_type.bit_width)
            return table
        if "moved" in self.columns:
            after.append(len(given))
        return fetch(self)

    monkeypatch.setattr(toxicity, "give_back", lambda: (given.append(1), freed()))
    monkeypatch.setattr(type(docs), "toArrow", spy)
    toxicity.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"), fold("doc_id", 5) != 0)
    assert widths == [16] and after and min(after) >= 1


def _stages(plan):
    """The numbers of Python operators that stand in one stage of a plan."""
    done = []

    def here(node):
        name, children = node.nodeName(), node.children()
        if name == "AdaptiveSparkPlan":
            return here(node.initialPlan())
        found = sum(here(children.apply(i)) for i in range(children.size()))
        if "Exchange" in name:
            done.append(found)
            return 0
        return found + (name == "MapInArrow")

    return [here(plan), *done]


def test_decontamination_runs_one_python_worker_a_task(spark):
    """Spark keeps the workers that tasks once needed; a second one in each would stay for all later stages."""
    found = decontam.overlaps(documents(spark, SMALL), spark.read.parquet(f"{SMALL}/benchmark.parquet"))
    assert max(_stages(found._jdf.queryExecution().executedPlan())) == 1


def test_toxicity_sample_is_sent_without_python_workers(spark, monkeypatch):
    docs, made = documents(spark, SMALL), []
    create = type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, *a, **b: made.append(create(self, *a, **b)) or made[-1])
    toxicity.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"), fold("doc_id", 5) != 0)
    assert made and not [x for x in made if "PythonRDD" in x._jdf.queryExecution().toRdd().toDebugString()]


def test_toxicity_scores_texts_piece_by_piece(texts):
    """With little memory, and as if each text were scored alone."""
    rng = np.random.default_rng(4)
    net = toxicity.Net(rng)
    spoken = language.Model(["de", "en"], np.log([0.5, 0.5]), rng.normal(-9, 1, (1 << language.LOG_BUCKETS, 2)).astype(np.float32))
    model = toxicity.Model(net.taps(), net.bias, net.dense, 0.0, spoken, np.zeros(3))
    some = [*texts.values(), None, ""]
    column = pa.array(some * (1 + (2 << 20) // sum(len(t or "") for t in some)))
    alone = np.concatenate([p for t in some for _, _, p in toxicity._probabilities(model, pa.array([t], pa.string()))])
    tracemalloc.start()
    found = list(toxicity._probabilities(model, column, toxicity._KEPT_BYTES))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [row for row, _, _ in found] == [0, *(end for _, end, _ in found)][:-1] and found[-1][1] == len(column)
    assert np.allclose(np.concatenate([p for _, _, p in found]), np.tile(alone, len(column) // len(some)), rtol=0, atol=1e-6)
    assert peak < 100 * max(toxicity._KEPT_BYTES, *(len((t or "").encode()) for t in some)) + 4e6
