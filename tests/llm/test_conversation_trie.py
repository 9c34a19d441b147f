"""The conversation trie against a plain trie in memory."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cabstream.llm import centroid, conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def direct(rows, base, head):
    """Nodes by a walk over every prefix of every rebuilt conversation."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    built = {c: own.get(base(c), [])[:head(c)] + ts[head(c):] for c, ts in own.items()}
    members = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[:len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(q[:len(p)] == p and len(q) > len(p) for q in members)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p)
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(path))
        out.append((min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), len(children),
                    len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def trie(df, base=lambda c: c - c % 100, head=lambda c: F.crc32(c.cast("string")) % 6, most=5, small=centroid.SMALL):
    turns = conversation_trie.ordered_turns(df)
    rebuilt = conversation_trie.with_shared_starts(turns, base(F.col("conv_id")), head(F.col("conv_id")), most)
    return sorted(tuple(r) for r in conversation_trie.prefix_trie(*rebuilt, small=small).collect())


def contract(c):
    return zlib.crc32(str(c).encode()) % 6


def grown(seed, convs, longest):
    draw = random.Random(seed)
    rows = []
    for _ in range(convs):
        c = draw.randrange(400)
        rows += [(c, t, draw.choice(["user", "bot"]), draw.choice("aaab")) for t in range(draw.randint(1, longest))]
    return rows


@pytest.mark.parametrize("small", [1, 7, 4096])
def test_nodes_equal_a_plain_trie(spark, small):
    rows = grown(small, 60, 7)
    long = [(150, t, "user", "same" * 3) for t in range(90)] + [(151, t, "user", "same" * 3) for t in range(90)]
    odd = [(7, None, None, None), (7, None, "user", None), (7, 1, None, "x"), (7, 1, None, "x"), (7, 1, "a", "x"),
           (None, 0, "user", "lost"), (399, 5, "user", "ünï 字")]
    df = spark.createDataFrame(rows + long + odd, SCHEMA).withColumns({"depth": F.lit(1), "k1": F.lit("x"), "mass": F.lit(2)})
    assert trie(df, small=small) == direct(rows + long + odd, lambda c: c - c % 100, contract)


def test_turnless_and_absent_bases(spark):
    rows = [(1001, 0, "user", "a"), (1002, 0, "user", "b"), (200, 0, "user", "c"), (201, 0, "user", "c"), (201, 1, "bot", "d")]
    assert any(contract(c) for c in (1001, 1002))
    got = trie(spark.createDataFrame(rows, SCHEMA))
    assert got == direct(rows, lambda c: c - c % 100, contract)
    assert got[0][:3] == (200, 0, None)
    everything = trie(spark.createDataFrame(rows, SCHEMA), head=lambda c: F.lit(5))
    assert everything == direct(rows, lambda c: c - c % 100, lambda c: 5)


def test_no_conversation_no_node(spark):
    assert trie(spark.createDataFrame([], SCHEMA)) == []
    assert trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)) == []


def test_common_turns_and_copies_are_one_node(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(600) for t in range(3)]
    got = trie(spark.createDataFrame(rows, SCHEMA), head=lambda c: F.lit(0))
    ids = ",".join(map(str, range(600)))
    assert [r[:7] for r in got] == [(0, d, None if d == 0 else 0, 600, int(d < 3), 1, 599 * 6 * (3 - max(d - 1, 0)))
                                    for d in range(4)]
    assert got[3][7] == hashlib.sha256(ids.encode()).hexdigest()


def test_component_sums_of_a_chain_a_star_and_random_trees():
    draw = random.Random(5)
    for shape in ("chain", "star", "random"):
        up = [-1] + [{"chain": i - 1, "star": 0, "random": draw.randrange(i)}[shape] for i in range(1, 200)]
        depth = [0] * 200
        for i in range(1, 200):
            depth[i] = depth[up[i]] + 1
        order = sorted(range(200), key=lambda i: depth[i])
        value = [draw.randrange(10) for _ in up]
        mass, want = [1] * 200, list(value)
        for i in sorted(range(1, 200), key=lambda i: -depth[i]):
            mass[up[i]] += mass[i]
            want[up[i]] += want[i]
        rows = [(i, depth[i], up[i] if i else None, mass[i], value[i], 0) for i in order]
        assert sorted(centroid.component_sums(rows, 1)) == sorted((i, depth[i], want[i]) for i in range(200))


def test_forest_of_several_tops(spark):
    rows = [(c, d, None if d == 0 else c, 20 - d, 1) for c in (3, 9) for d in range(20)]
    nodes = spark.createDataFrame(rows, "chain long, depth long, up_chain long, mass long, v long")
    paths = nodes.where("depth > 0").selectExpr("chain", "depth", "chain as node_chain", "up_chain")
    got = {(r.chain, r.depth): r.v for r in centroid.subtree_sums(nodes, paths, ["v"], small=3).collect()}
    assert got == {(c, d): 20 - d for c in (3, 9) for d in range(20)}
