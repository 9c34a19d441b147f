"""SimHash near-duplicates against a comparison of all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from cabstream.llm import simhash
from cabstream.llm.common import connected_components


def direct_fingerprint(text, shingle):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    counts = [0] * 64
    for s in shingles:
        value = xxhash.xxh64_intdigest(s.encode(), 42)
        for bit in range(64):
            counts[bit] += value >> bit & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def direct_components(marks, bits):
    root = {k: k for k in marks}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in marks:
        for b in marks:
            if a < b and (marks[a] ^ marks[b]).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in marks}


def test_fingerprints_and_components_equal_all_pairs(make_docs, awkward):
    marks = {i: direct_fingerprint(t, 4) for i, t in enumerate(awkward)}
    got = {r.doc_id: r for r in simhash.near_duplicates(make_docs(awkward)).collect()}
    assert {k: r.fingerprint for k, r in got.items()} == {k: f"{v:016x}" for k, v in marks.items()}
    assert {k: r.component_id for k, r in got.items()} == direct_components(marks, 4)


def test_null_ids_repeated_rows_and_empty_table(spark, make_docs, awkward):
    docs = make_docs(awkward)
    nameless = docs.withColumn("doc_id", F.when(F.col("doc_id") != 3, F.col("doc_id")))
    rows = simhash.near_duplicates(nameless.unionAll(nameless)).collect()
    assert len(rows) == 2 * len(awkward)
    copy = [r for r in rows if r.doc_id == 4]
    assert len(copy) == 2 and {r.component_id for r in copy} == {4}
    alone = simhash.near_duplicates(docs.withColumn("doc_id", F.lit(None).cast("long"))).collect()
    assert len(alone) == len(awkward) and {r.component_id for r in alone} == {None}
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_no_link_is_lost_in_large_buckets(spark):
    draw = np.random.default_rng(5)
    centre = int(draw.integers(0, 1 << 62))
    values = {centre}
    for _ in range(700):  # a large group of near copies, some of them far from others
        bits = draw.choice(64, int(draw.integers(1, 6)), replace=False)
        values.add(centre ^ sum(1 << int(b) for b in bits))
    values |= {int(v) for v in draw.integers(0, 1 << 62, 300)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    nodes = spark.createDataFrame([(v,) for v in signed], "fp long")
    roots = {r.node: r.root for r in connected_components(simhash.links(nodes, 4), "a", "b").collect()}
    marks = {v: v & ((1 << 64) - 1) for v in signed}
    want = direct_components(marks, 4)
    assert {v: roots.get(v, v) for v in signed} == want


def test_blocks_of_a_bucket_give_one_link_per_fingerprint():
    fp = np.arange(64, dtype=np.int64)
    far = sum(np.bitwise_count((fp ^ p).view(np.uint64)).astype(np.int64) << (8 * i)
              for i, p in enumerate(simhash.pivots()[:simhash.FILTER_PIVOTS]))
    found = simhash._forest(1)(pd.DataFrame({"fp": fp, "far": far}))
    assert len(found) == 63 and set(found["b"]) == {0}


def test_components_of_long_chains_and_hot_nodes(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 500)]
    edges = spark.createDataFrame(chain + star + [(5, 5), (None, 3), (7, None), (0, 1)], "a long, b long")
    got = {r.node: r.root for r in connected_components(edges, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(500)}}


def test_any_number_of_blocks_finds_every_pair(spark, monkeypatch):
    draw = random.Random(17)
    base = [draw.getrandbits(64) - (1 << 63) for _ in range(60)]
    near = [f ^ (1 << draw.randrange(63)) ^ (1 << draw.randrange(63)) ^ (1 << draw.randrange(63)) for f in base]
    nodes = spark.createDataFrame([(f,) for f in {*base, *near}], "fp long")
    assert [simhash.block_count(n, 4) for n in (10, 10**7, 10**9, 10**10)] == [6, 6, 7, 8]
    for count in (6, 7, 8):
        monkeypatch.setattr(simhash, "block_count", lambda n, bits, c=count: c)
        found = {(min(r.a, r.b), max(r.a, r.b)) for r in simhash.links(nodes, 4).collect()}
        assert {(min(a, b), max(a, b)) for a, b in zip(base, near, strict=True) if a != b} <= found
