"""The prefix trie against plain Python, rounds in Spark and in tasks, and odd rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from footfall.llm import prefixes
from footfall.llm.queries import oracle_sql, queries
from tests.compare import connect, difference
from tests.conftest import SMALL


def expected(rows):
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            turns[conv_id].append(((turn is not None, turn or 0, role, hashlib.md5(text.encode()).hexdigest()), role, text))
    plain = {c: [x[1:] for x in sorted(t)] for c, t in turns.items()}
    full = {}
    for c, own in plain.items():
        h = zlib.crc32(str(c).encode()) % 9
        first = c - (c % 5 if c >= 0 else -(-c % 5))
        full[c] = plain.get(first, [])[:h] + own[h:]
    members = defaultdict(list)
    for c, seq in sorted(full.items()):
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, own in members.items():
        gain = (len(own) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += gain
    out = set()
    for node, own in members.items():
        ends = ",".join(str(c) for c in own if len(full[c]) == len(node))
        parent = members[node[:-1]][0] if node else None
        out.add((own[0], len(node), parent, len(own), children[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def made():
    rng = random.Random(2)
    rows = [(None, 1, "user", "x"), (None, None, None, None)]
    for c in [*range(60), -7, -5, 10**12, 1003]:
        if c % 11 == 3:
            continue
        for t in range(rng.randint(1, 14)):
            rows.append((c, t if rng.random() < 0.9 else None, rng.choice(["user", "user", None]), rng.choice(["a", "a", "é", None, ""])))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    rows += [(200 + i, t, "user", "the same") for i in range(40) for t in range(30)]  # a group of copies
    rows += [(300, t, "user", f"turn {t}") for t in range(400)] + [(309, t, "user", f"turn {t}") for t in range(350)]  # deep
    rows += [(400 + i, 0, "user", f"different {i}") for i in range(150)]  # a wide root
    return rows


@pytest.mark.parametrize("piece", [prefixes.PIECE, 1200])
def test_made_conversations(spark, piece):
    rows = made()
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, depth int, weight int")
    got = [tuple(r) for r in prefixes.trie(table.repartition(3), piece=piece).collect()]
    assert len(got) == len(set(got))
    assert set(got) == expected(rows)


def test_nothing(spark):
    table = spark.createDataFrame([(None, 1, "user", "x")], "conv_id long, turn long, role string, text string")
    assert prefixes.trie(table).collect() == prefixes.trie(table.where("false")).collect() == []


def test_query_equals_oracle(spark):
    rows, problem = difference(queries()["op12_prefix_trie"](spark, SMALL), connect(SMALL), oracle_sql()["op12_prefix_trie"])
    assert rows and problem is None, problem


@pytest.mark.parametrize("shape", ["way", "star", "any"])
def test_decompose(shape):
    rng = random.Random(4)
    n = 3000
    parent = [-1] + [{"way": i, "star": 0, "any": rng.randint(max(0, i - 9), i)}[shape] for i in range(n - 1)]
    values = [(rng.randint(0, 3), rng.randint(0, 99)) for _ in range(n)]
    weight, want = [rng.randint(1, 5) for _ in range(n)], [list(v) for v in values]
    for i in range(n - 1, 0, -1):
        weight[parent[i]] += weight[i]
        want[parent[i]][0] += want[i][0]
        want[parent[i]][1] += want[i][1]
    assert prefixes.decompose(parent, weight, values) == [tuple(w) for w in want]
