"""The prefix trie of conversations, with totals of every subtree.

A node is a different sequence of first turns, known by 128 bits of hash: the exclusive or of two
hashes of each (place, role, text). Its name is its smallest member conversation and its depth, so
all that is needed of texts is a digest and a length, and of a long conversation a running value.

Totals of subtrees come from a centroid decomposition of the forest of parent edges. Every node
weighs its number of members; what a subtree weighs is then known from the members' lengths alone.
In a component the nodes that carry more than half of its weight form a way down from its top; the
last of them is the centroid. What the component holds below the centroid is added up and added to
all nodes of that way; without the centroid the component falls into parts of at most half its
weight, and so on. Every node meets every node above it exactly once, in about log2(weight) rounds,
however deep the trie is. Rounds over components of more than ``PIECE`` are Spark jobs; lighter
ones are gathered, each into one task, and decomposed there.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import record, stored
from footfall.operators.ordered_groups import rank_in_group, scan_groups

FAMILY = 5  # conversations of one family begin with turns of its first
MOST = 9  # fewer than so many
PIECE = 1 << 15  # the largest weight of a component that one task decomposes
CHUNK_BITS = 10  # ids of members are written in runs of so many at most

_NODE = ["conv_id", "depth"]
_PRINT = ["depth", "p1", "p2"]


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, number (from 1), role, digest and bytes of the text of every turn.

    Turns are ordered by ``turn`` (null first), then role, then digest of the text; null roles and
    texts are empty. Rows without a conv_id belong to no conversation and are left out.
    """
    text = F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id is not null").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.md5(text.cast("binary")).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    return rank_in_group(turns, ["conv_id"], ["turn", "role", "digest"], "number").drop("turn")


def rebuild(turns: DataFrame, family: int = FAMILY, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id and length) and turns (conv_id, length, number, role, digest, bytes), rebuilt from numbered ones.

    The first h turns of conversation c are those of its family's first, c - c % ``family`` (all if
    it has fewer, none if it is absent); after them come c's own without its first h. h is the
    crc32 of c modulo ``most``.
    """
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    first = sizes.select(F.col("conv_id").alias("first"), F.col("own").alias("there"))
    heads = sizes.withColumns({
        "first": F.col("conv_id") - F.col("conv_id") % family,
        "h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % most,
    })
    heads = heads.join(first, "first", "left").withColumn("taken", F.least("h", F.coalesce("there", F.lit(0))))
    heads = heads.withColumn("length", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    heads = stored(heads.select("conv_id", "first", "h", "taken", "length"), "heads")
    columns = ["conv_id", "length", "number", "role", "digest", "bytes"]
    own = turns.join(heads, "conv_id").where("number > h").withColumn("number", F.col("taken") + F.col("number") - F.col("h"))
    lent = turns.where(F.col("number") < most).withColumnRenamed("conv_id", "first").join(heads, "first").where("number <= taken")
    return heads.select("conv_id", "length"), own.select(*columns).union(lent.select(*columns))


def members(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """Every (conversation, depth) with the print ``p1, p2`` of its first turns, that of its parent, and
    ``below``: how many turns follow, itself included. Depth 0 has all conversations."""
    own = [f"xxhash64(number, role, digest, {salt})" for salt in (1, 2)]
    turns = turns.select("conv_id", "length", "number", "bytes", F.expr(own[0]).alias("g1"), F.expr(own[1]).alias("g2"))
    run = scan_groups(turns, ["conv_id"], ["number"], running={"p1": ("bit_xor", "g1"), "p2": ("bit_xor", "g2")})
    found = run.selectExpr(
        "conv_id", "number as depth", "p1", "p2", "p1 ^ g1 as q1", "p2 ^ g2 as q2", "bytes",
        "length - number + 1 as below", "length = number as ends",
    )
    roots = conversations.selectExpr(
        "conv_id", "0L as depth", "0L as p1", "0L as p2", "cast(null as long) as q1", "cast(null as long) as q2",
        "0L as bytes", "length + 1 as below", "length = 0 as ends",
    )
    return found.union(roots)


def nodes(found: DataFrame) -> DataFrame:
    """Every node with its name, its parent's, members, children, weight of its subtree and saved bytes."""
    made = found.groupBy(*_PRINT).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum("below").alias("weight"),
        F.min("q1").alias("q1"), F.min("q2").alias("q2"), F.min("bytes").alias("bytes"),
    )
    made = stored(made, "nodes")
    above = [(F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")]
    parents = made.select(F.expr("depth + 1 as depth"), F.expr("p1 as q1"), F.expr("p2 as q2"), F.expr("conv_id as parent_conv_id"))
    children = made.where("depth > 0").groupBy(*above).agg(F.count(F.lit(1)).alias("n_children"))
    return made.join(children, _PRINT, "left").join(parents, ["depth", "q1", "q2"], "left").selectExpr(
        *_PRINT, "conv_id", "parent_conv_id", "n_convs", "coalesce(n_children, 0L) as n_children", "weight",
        "(n_convs - 1) * bytes as saved",
    )


def decompose(parent: list[int], weight: list[int], values: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Totals of every subtree of one tree, whose top is node 0, by its centroids.

    ``weight`` holds what subtrees weigh; a subtree must weigh more than those it contains.
    """
    weight = list(weight)
    children: list[list[int]] = [[] for _ in parent]
    for i, p in enumerate(parent):
        if p >= 0:
            children[p].append(i)
    one, two = [0] * len(parent), [0] * len(parent)
    gone = bytearray(len(parent))
    tops = [0] if parent else []
    while tops:
        top = tops.pop()
        half = weight[top] / 2
        way = [top]
        while (heavy := next((k for k in children[way[-1]] if not gone[k] and weight[k] > half), None)) is not None:
            way.append(heavy)
        centroid = way[-1]
        x = y = 0
        under = [centroid]
        while under:
            node = under.pop()
            x += values[node][0]
            y += values[node][1]
            under += [k for k in children[node] if not gone[k]]
        for node in way:
            one[node] += x
            two[node] += y
        for node in way[:-1]:
            weight[node] -= weight[centroid]
        gone[centroid] = 1
        tops += [k for k in children[centroid] if not gone[k]]
        if centroid != top:
            tops.append(top)
    return list(zip(one, two, strict=True))


_ROLLED = pa.schema([(c, pa.int64()) for c in ("conv_id", "depth", "n_leaves", "saved_tokens")])


def _in_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole components, sorted by component and depth, one after the other."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True)

    out: list[tuple] = []
    for _, group in itertools.groupby(rows(), key=lambda r: r[:2]):
        part = list(group)
        number = {r[2:4]: i for i, r in enumerate(part)}
        parent = [number.get((r[4], r[3] - 1), -1) if i else -1 for i, r in enumerate(part)]
        totals = decompose(parent, [r[5] for r in part], [r[6:8] for r in part])
        out += [(*r[2:4], r[8] + x, r[9] + y) for r, (x, y) in zip(part, totals, strict=True)]
        if len(out) > 1 << 15:
            yield record(_ROLLED, **dict(zip(_ROLLED.names, zip(*out, strict=True), strict=True)))
            out = []
    if out:
        yield record(_ROLLED, **dict(zip(_ROLLED.names, zip(*out, strict=True), strict=True)))


def _split(now: DataFrame, ways: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round over all open components: the rows of their parts, and the centroids with their totals.

    ``ways`` names the node of every (conversation, depth) and its parent. A node lies below the
    centroid if its name's way down passes there; then it belongs to that child's part.
    """
    comp = ["top", "top_depth"]
    tops = now.where("conv_id = top and depth = top_depth").select(*comp, F.col("weight").alias("whole"))
    heavy = now.join(tops, comp).where("2 * weight > whole")
    centroids = heavy.groupBy(*comp).agg(
        F.max("whole").alias("whole"), F.min(F.struct("weight", "conv_id", "depth")).alias("centroid")
    )
    named = centroids.selectExpr(
        *comp, "whole", "centroid.weight as c_weight", "centroid.conv_id as c_conv", "centroid.depth as c_depth", "centroid.depth + 1 as next"
    )
    down = ways.selectExpr("conv_id", "depth as next", "node as child", "parent as above")
    marked = now.join(named, comp).join(down, ["conv_id", "next"], "left")
    marked = marked.withColumns({
        "inside": F.expr("depth >= next and coalesce(above = c_conv, false)"),
        "is_centroid": F.expr("conv_id = c_conv and depth = c_depth"),
        "on_way": F.expr("2 * weight > whole"),
    })
    marked = stored(marked, "marked")
    sums = marked.where("inside or is_centroid").groupBy(*comp).agg(F.sum("leaf").alias("d_leaf"), F.sum("saved").alias("d_saved"))
    summed = marked.join(sums, comp).withColumns({
        "n_leaves": F.expr("n_leaves + if(on_way, d_leaf, 0L)"),
        "saved_tokens": F.expr("saved_tokens + if(on_way, d_saved, 0L)"),
        "weight": F.expr("weight - if(on_way and not is_centroid, c_weight, 0L)"),
    })
    done = summed.where("is_centroid").select(*_ROLLED.names)
    rest = summed.where("not is_centroid").withColumns({
        "top": F.expr("if(inside, child, top)"),
        "top_depth": F.expr("if(inside, next, top_depth)"),
    })
    return rest.select(*now.columns), done


def rollup(trie: DataFrame, found: DataFrame, piece: int = PIECE) -> DataFrame:
    """conv_id, depth, n_leaves and saved_tokens of every node of the whole subtree below it.

    ``trie`` as from :func:`nodes`, ``found`` as from :func:`members`. The driver sees the weight of
    the root, and whether a component heavier than ``piece`` is left; each round is stored.
    """
    columns = "top long, top_depth long, conv_id long, depth long, parent_conv_id long, weight long, leaf long, saved long, n_leaves long, saved_tokens long"
    spark = trie.sparkSession
    root = trie.where("depth = 0").select("conv_id", "weight").first()
    if root is None:
        return spark.createDataFrame([], "conv_id long, depth long, n_leaves long, saved_tokens long")
    now = trie.selectExpr(
        f"{root.conv_id}L as top", "0L as top_depth", "conv_id", "depth", "parent_conv_id", "weight",
        "if(n_children = 0, 1L, 0L) as leaf", "saved", "0L as n_leaves", "0L as saved_tokens",
    )
    light, done, heaviest = [], [], root.weight
    if heaviest > piece:
        now = stored(now, "parts")  # else the one top is a constant, and its join a product
        names = trie.select(*_PRINT, F.col("conv_id").alias("node"), F.col("parent_conv_id").alias("parent"))
        ways = stored(found.select("conv_id", *_PRINT).join(names, _PRINT).select("conv_id", "depth", "node", "parent"), "ways")
    while heaviest > piece:
        rest, centroids = _split(now, ways)
        rest = stored(rest, "parts")
        done.append(centroids)
        heavy = rest.where("conv_id = top and depth = top_depth").select("top", "top_depth", F.col("weight").alias("whole"))
        rest = rest.join(heavy, ["top", "top_depth"])
        light.append(rest.where(F.col("whole") <= piece).drop("whole"))
        now = rest.where(F.col("whole") > piece).drop("whole")
        heaviest = heavy.agg(F.max("whole")).first()[0] or 0
    if not light:
        light = [now]
    parts = light[0]
    for frame in light[1:]:
        parts = parts.union(frame)
    comp = ["top", "top_depth"]
    rolled = parts.to(spark.createDataFrame([], columns).schema).repartition(*comp).sortWithinPartitions(*comp, "depth", "conv_id")
    rolled = rolled.mapInArrow(_in_tasks, "conv_id long, depth long, n_leaves long, saved_tokens long")
    for frame in done:
        rolled = rolled.union(frame)
    return rolled


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each node's runs of ids, which come one after the other; held is one running hash."""
    schema = pa.schema([(c, pa.int64()) for c in _PRINT] + [("ends_sha256", pa.string())])
    key, state = None, None
    for batch in batches:
        out = []
        for *own, ids in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if own == key:
                state.update(b"," + ids.encode())
            else:
                if key:
                    out.append((*key, state.hexdigest()))
                key, state = own, hashlib.sha256(ids.encode())
        if out:
            yield record(schema, **dict(zip(schema.names, zip(*out, strict=True), strict=True)))
    if key:
        yield record(schema, **dict(zip(schema.names, zip(*[(*key, state.hexdigest())], strict=True), strict=True)))


def ends(found: DataFrame) -> DataFrame:
    """Print of every node at which conversations end, and the SHA-256 of their ids, ascending, joined by commas.

    Ids are gathered in runs of at most ``2 ** CHUNK_BITS``; a node's runs are hashed in order, one at a time.
    """
    run = F.array_sort(F.collect_list("conv_id"))
    chunks = found.where("ends").groupBy(*_PRINT, F.shiftright("conv_id", CHUNK_BITS).alias("chunk"))
    chunks = chunks.agg(F.array_join(F.transform(run, lambda c: c.cast("string")), ",").alias("ids"))
    dealt = chunks.repartition(*_PRINT).sortWithinPartitions(*_PRINT, "chunk").select(*_PRINT, "ids")
    return dealt.mapInArrow(_hashed, "depth long, p1 long, p2 long, ends_sha256 string")


def trie(conversations: DataFrame, family: int = FAMILY, most: int = MOST, piece: int = PIECE) -> DataFrame:
    """One row per node of the prefix trie of all rebuilt conversations (see :func:`rebuild`).

    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs (members), n_children,
    n_leaves and saved_tokens (of the subtree, its top included: childless nodes; members less one
    times bytes of the last text), ends_sha256 (of the ids of the members with exactly ``depth``
    turns, ascending, joined by commas). Turnless conversations are members of the root. Repeated
    rows are turns of their own; rows without a conv_id are left out; an empty table, or one with
    such rows only, gives none; other columns are not looked at.
    """
    turns = stored(numbered(conversations), "turns")
    found = stored(members(*rebuild(turns, family, most)), "members")
    made = stored(nodes(found), "trie")
    rolled = rollup(made, found, piece)
    return (
        made.join(rolled, _NODE)
        .join(ends(found), _PRINT, "left")
        .selectExpr(
            *_NODE, "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "coalesce(ends_sha256, sha2('', 256)) as ends_sha256"
        )
    )
