"""Spelling variants against a comparison of all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cabstream.llm import spelling


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def direct_counts(rows, garble=31, least=7, count=2):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % garble == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= count}


def direct(counts, ratio=10):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def found(spark, counts, **options):
    words = spark.createDataFrame(sorted(counts.items()), "word string, n long")
    return sorted(tuple(r) for r in spelling.variants(words, **options).collect())


def crowd(seed, letters, size, shortest=7, longest=11):
    """Random words and edits of them, edits of edits too."""
    draw = random.Random(seed)
    words = ["".join(draw.choices(letters, k=draw.randint(shortest, longest))) for _ in range(size // 3)]
    while len(words) < size:
        w = draw.choice(words)
        i = draw.randrange(len(w))
        new = draw.choice([w[:i] + w[i + 1:], w[:i] + draw.choice(letters) + w[i:], w[:i] + draw.choice(letters) + w[i + 1:]])
        if len(new) >= shortest:
            words.append(new)
    return {w: draw.choice([2, 3, 5, 20, 30, 50, 200, 300, 2000]) for w in words}


@pytest.mark.parametrize("seed, letters", [(1, "ab"), (2, "abcdé"), (3, "ÿéa"), (4, "abcdefghijklmnop")])
def test_variants_equal_all_pairs(spark, seed, letters):
    counts = crowd(seed, letters, 250)
    assert found(spark, counts) == direct(counts)


def test_words_beyond_the_depth_meet_their_neighbours(spark):
    counts = crowd(7, "ab", 150, 7, 13) | {"a" * k: 3 ** (k % 5) * 2 for k in range(7, 16)}
    assert found(spark, counts, depth=9) == direct(counts)
    long = {"x" * 5000 + "y" + "z" * 5000: 2, "x" * 5000 + "z" * 5000: 40, "x" * 5001 + "z" * 5000: 3, "é" * 70: 2, "é" * 71: 2}
    assert found(spark, long) == direct(long)


def test_forms_are_followed_to_the_last(spark):
    counts = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000, "aaabbbb": 20000, "aabbbbb": 200000}
    got = found(spark, counts)
    assert got == direct(counts) and {r[2] for r in got} == {"aabbbbb"}
    ties = {"wordone": 2, "wordoneb": 20, "wordonea": 20, "alone word": 2}
    assert found(spark, ties) == direct(ties)


def test_word_counts_equal_direct_counts(spark, make_docs, awkward, monkeypatch):
    texts = [*awkward, "Straße STRASSE straße Größenwahn größenwahn ÀÉÎÕÜ÷×ÿ àéîõü÷×ÿ", "under_score under-score 12abcdefgh34abcdefgh",
             "letters" * 3000 + " " + "letters" * 3000, *(f"separate Separate seperate {c}" for c in "abc")]
    docs = make_docs(texts).withColumn("word", F.lit(9))
    ids = docs.withColumn("doc_id", F.when(F.col("doc_id") % 3 > 0, F.col("doc_id")))
    monkeypatch.setattr(spelling, "HELD", 5)
    monkeypatch.setattr(spelling, "LONG_TEXT", 20)
    for garble in (31, 2):
        rows = [(i if i % 3 else None, t) for i, t in enumerate(texts)]
        got = {r.word: r.n for r in spelling.word_counts(ids, garble=garble).collect()}
        assert got == direct_counts(rows, garble)
        twice = {r.word: r.n for r in spelling.word_counts(ids.unionAll(ids), garble=garble).collect()}
        assert twice == direct_counts(rows * 2, garble)


def test_no_join_broadcasts(spark, monkeypatch):
    """A few MB on disk may be millions of rows once exploded, too many for the driver."""
    plans, store = [], spelling.stored

    def ran(df):
        df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(spelling, "stored", lambda df, purpose: store(ran(df), purpose))
    counts = crowd(5, "ab", 120, 7, 12) | {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000}
    words = spark.createDataFrame(sorted(counts.items()), "word string, n long")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100m")
    try:
        got = ran(spelling.variants(words, depth=9)).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sorted(tuple(r) for r in got) == direct(counts)
    assert all("isFinalPlan=true" in p for p in plans if "Join" in p) and sum("SortMergeJoin" in p for p in plans) > 4
    assert not [p for p in plans if "Broadcast" in p]


def test_empty_tables(spark, make_docs):
    docs = make_docs(["a b", None])
    assert spelling.variants(spelling.word_counts(docs)).count() == 0
    assert spelling.variants(spelling.word_counts(docs.limit(0))).count() == 0
