"""Line de-duplication and sharding on awkward tables."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cabstream.llm import line_dedup, sharding

SPACE = " \t\n\x0b\x0c\r"


def line_key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def direct(texts, least):
    lines = [(t or "").split("\n") for t in texts]
    found = Counter(k for own in lines for k in {line_key(x) for x in own})
    out = []
    for own in lines:
        kept = [x for x in own if not line_key(x) or found[line_key(x)] < least]
        out.append((len(own), len(own) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("batches", [1, 5])
def test_lines_equal_direct_count(make_docs, awkward, batches):
    texts = awkward + ["again\n\n  AGAIN\t\nonly here " + str(i % 2) for i in range(4)] + ["\n", "ÄGAIN\nägain", "\x85again"]
    for least in (2, 4):
        df = line_dedup.drop_repeated_lines(make_docs(texts), min_docs=least, batches=batches)
        got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in df.collect()}
        assert [got[i] for i in range(len(texts))] == direct(texts, least)


def test_lines_of_null_ids_repeated_rows_and_empty_table(make_docs):
    docs = make_docs(["same\nx", "same\ny"])
    nameless = docs.withColumn("doc_id", F.lit(None).cast("long"))
    rows = line_dedup.drop_repeated_lines(nameless.unionAll(docs), min_docs=4).collect()
    assert sorted(r.kept_text for r in rows) == ["x", "x", "y", "y"]
    assert line_dedup.drop_repeated_lines(docs.limit(0)).count() == 0


def test_runs_are_compacted_and_settled_lines_left_out(spark):
    runs = line_dedup.LineRuns(spark, settled=3, fanout=2)
    for i in range(5):
        runs.add(spark.createDataFrame([(1, 1, 2), (i + 10, 0, 1)], "h1 long, h2 long, n long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    got = {(r.h1, r.h2): r.n for r in runs.counts().collect()}
    assert got == {(1, 1): 4, **{(i + 10, 0): 1 for i in range(5)}}
    plan = line_dedup.LineRuns._merge(*(spark.table(r) for r in runs._runs()))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_matrix_has_exact_margins_and_the_right_law():
    matrix = sharding.communication_matrix([7, 0, 13, 5], [9, 8, 8], 1)
    assert [sum(r) for r in matrix] == [7, 0, 13, 5] and [sum(c) for c in zip(*matrix)] == [9, 8, 8]
    draws = [sharding.communication_matrix([6, 14], [10, 10], s)[0][0] for s in range(2000)]
    assert abs(np.mean(draws) - 3) < 0.1 and abs(np.var(draws) - 6 * 0.25 * 14 / 19) < 0.12
    rng = np.random.default_rng(0)
    huge = sharding.hypergeometric(rng, 10 ** 12, 3 * 10 ** 12, 10 ** 10)
    assert abs(huge - 2.5e9) < 10 * 43_500
    with pytest.raises(ValueError):
        sharding.communication_matrix([1], [2], 0)


def test_shards_are_exact_and_gapless(make_docs, awkward):
    df = make_docs(awkward).withColumn("crc", F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    rows = sharding.uniform_shards(df.unionAll(df.limit(7)), 4, ["doc_id", "crc"]).collect()
    sizes = Counter(r.shard for r in rows)
    assert sorted(sizes.values()) == [6, 7, 7, 7]
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(n)) for s, n in sizes.items())
    assert Counter(r.doc_id for r in rows) == Counter([*range(len(awkward)), *[r.doc_id for r in df.limit(7).collect()]])
    assert all(r.crc == zlib.crc32((r.text or "").encode()) for r in rows)
    nameless = df.withColumn("doc_id", F.lit(None).cast("long"))
    assert sharding.uniform_shards(nameless, 24, ["doc_id", "crc"]).count() == len(awkward)
    assert sharding.uniform_shards(df.limit(0), 24, ["doc_id"]).count() == 0


def test_shuffle_depends_on_the_seed_only(spark):
    df = spark.range(500).withColumnRenamed("id", "doc_id")
    first = {r.doc_id: (r.shard, r.slot) for r in sharding.uniform_shards(df, 5, ["doc_id"], 1).collect()}
    again = {r.doc_id: (r.shard, r.slot) for r in sharding.uniform_shards(df.repartition(3), 5, ["doc_id"], 1).collect()}
    other = {r.doc_id: (r.shard, r.slot) for r in sharding.uniform_shards(df, 5, ["doc_id"], 2).collect()}
    assert first == again != other
