"""Nearest neighbours against a comparison of all vectors."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cabstream.llm import ann, queries

DDL = "vec_id long, embedding array<float>, rank int, cls string, vec int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], DDL)


def direct(rows, every, k):
    ids, seen = [], {}
    for i, v in rows:
        x = np.asarray(v if v is not None and None not in v else [], np.float64)
        if i is not None and len(x) and np.isfinite(x).all() and x.any():
            seen.setdefault(i, x)
    ids = sorted(seen)
    out = {}
    for q in ids:
        if q % every == 0:
            a = seen[q]
            near = sorted((-float(ann.cosine(a[None], seen[i][None])[0]), i) for i in ids if i != q and len(seen[i]) == len(a))
            if near:
                out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(near[:k])]
    return out


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: sorted(v) for q, v in out.items()}


def test_awkward_vectors(spark):
    draw = np.random.default_rng(1)
    rows = [(i, np.float32(draw.standard_normal(6)).tolist()) for i in range(40)]
    copy = rows[4][1]
    rows += [(100 + i, copy) for i in range(30)] + [(200 + i, [2.0 * x for x in copy]) for i in range(3)]
    rows += [(50, None), (60, []), (70, [0.0] * 6), (80, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (90, [math.nan] + [1.0] * 5),
             (300, [math.inf] + [0.0] * 5), (310, [1.0, 2.0]), (None, copy), rows[0]]
    assert found(ann.nearest_neighbours(table(spark, rows), 10)) == direct(rows, 10, 5)


def test_fewer_rows_than_neighbours(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [-1.0, 0.0])]
    assert found(ann.nearest_neighbours(table(spark, rows), 2)) == direct(rows, 2, 5)
    assert ann.nearest_neighbours(table(spark, rows[:1]), 2).count() == 0
    assert ann.nearest_neighbours(table(spark, []), 2).count() == 0


def test_vectors_of_two_sizes_are_searched_apart(spark):
    draw = np.random.default_rng(4)
    rows = [(i, np.float32(draw.standard_normal(6 if i % 3 else 9)).tolist()) for i in range(120)]
    rows += [(1000, [1.0] * 4), (1050, [1.0, 2.0, 3.0])]
    got = found(ann.nearest_neighbours(table(spark, rows), 10))
    want = direct(rows, 10, 5)
    assert got == want and {0, 10} <= got.keys() and 1000 not in got


def test_share_of_vectors_looked_at_falls_with_the_table_where_neighbours_are_close():
    draw = np.random.default_rng(6)
    shares = []
    for n in (2_000, 40_000):
        centres = ann._unit(draw.standard_normal((n // 20, 48)))
        rows = ann._unit(centres[np.arange(n) % len(centres)] + 0.04 * draw.standard_normal((n, 48)))
        hashes = ann.StableHashes(48, ann.hash_count(n))
        own = hashes.buckets(hashes.project(rows))
        seen, met = 0, []
        for q in range(40):
            chosen = np.zeros(n, bool)
            for t, codes in enumerate(hashes.probes(hashes.project(rows[q:q + 1])[0], ann.COSINES[0], ann.FAINT)):
                chosen |= np.isin(own[:, t], codes)
            seen += chosen.mean() / 40
            near = np.argsort(-(rows @ rows[q]))[1:6]
            met.append(chosen[near].mean())
        shares.append(seen)
        assert np.mean(met) >= 0.95
    assert shares[1] < 0.5 * shares[0]


def test_close_neighbours_are_found_at_the_first_cosine(spark, monkeypatch):
    draw = np.random.default_rng(8)
    centres = draw.standard_normal((20, 16))
    rows = [(i, np.float32(centres[i % 20] + 0.1 * draw.standard_normal(16)).tolist()) for i in range(400)]
    asked = []
    search = ann._search
    monkeypatch.setattr(ann, "_search", lambda *a: asked.append(1) or search(*a))
    got, want = found(ann.nearest_neighbours(table(spark, rows), 20)), direct(rows, 20, 5)
    hits = sum(len({i for _, i, _ in got[q]} & {i for _, i, _ in want[q]}) for q in want)
    assert len(asked) == 1 and hits >= 0.95 * 5 * len(want)


def test_blocks_of_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(ann, "MEMBERS", 16)
    monkeypatch.setattr(ann, "ASKED", 4)
    draw = np.random.default_rng(2)
    centre = draw.standard_normal(8)
    rows = [(i, (centre + 0.01 * draw.standard_normal(8)).tolist()) for i in range(150)]
    rows = [(i, np.float32(v).tolist()) for i, v in rows]
    got, want = found(ann.nearest_neighbours(table(spark, rows), 5)), direct(rows, 5, 5)
    assert got == want


def test_recall_on_the_embeddings(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got, want = found(queries.QUERIES["op7_nearest_neighbours"](spark, sf_dir)), direct(rows, 50, 5)
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    hits = sum(len({i for _, i, _ in got[q]} & {i for _, i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 5 * len(want)


def test_probes_reach_the_success_asked_for():
    hashes, draw = ann.StableHashes(32), np.random.default_rng(3)
    q = ann._unit(draw.standard_normal((300, 32)))
    noise = draw.standard_normal(q.shape)
    noise = ann._unit(noise - (noise * q).sum(axis=1, keepdims=True) * q)
    for cosine, table_of in ((ann.COSINES[-1], hashes), (ann.COSINES[0], ann.StableHashes(32, 6))):
        near = cosine * q + math.sqrt(1 - cosine ** 2) * noise
        own = table_of.buckets(table_of.project(near))
        faint = 0.0 if cosine == ann.COSINES[-1] else ann.FAINT
        met = [any(b in set(v) for b, v in zip(row, table_of.probes(p, cosine, faint), strict=True))
               for row, p in zip(own, table_of.project(q), strict=True)]
        assert np.mean(met) >= ann.SUCCESS - 0.03


@pytest.mark.parametrize("bad", [None, [], [0.0], [None], [math.nan], [math.inf]])
def test_unusable_vectors(spark, bad):
    df = spark.createDataFrame([(bad,)], "v array<float>")
    assert df.select(ann.usable(F.col("v")).alias("u")).first().u is False
