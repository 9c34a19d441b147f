"""Decontamination: planted items and paraphrases are found, clean documents aren't."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from cabstream.llm import decontaminate, queries

from .conftest import prose


def benchmark(spark, rows, ddl="item_id long, text string, doc_id int"):
    return spark.createDataFrame([(*r, 1) for r in rows], ddl)


def matches(docs, bench):
    return {(r.doc_id, r.item_id) for r in decontaminate.benchmark_matches(docs, bench).collect()}


def common(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_common_subsequence_equals_the_table():
    draw = random.Random(4)
    for _ in range(300):
        a, b = (draw.choices("abcd", k=draw.randint(1, 12)) for _ in range(2))
        assert decontaminate.common_subsequence(decontaminate.Item(0, a, []).masks, len(a), b) == common(a, b)


def test_exact_copies_and_paraphrases(spark, make_docs):
    items = [(i, prose(100 + i, 18 + i)) for i in range(12)]
    texts = [prose(i, 80) for i in range(40)]
    planted = set()
    for i, item in items:
        words = item.split()
        changed = [w if j % 6 else "other" for j, w in enumerate(words[:-6])] + words[-6:]
        added = [x for j, w in enumerate(words) for x in ([w, "so"] if j % 6 == 0 else [w])]
        for k, version in enumerate((item, item.upper().replace(" ", ", "), " ".join(changed), " ".join(added))):
            planted.add((len(texts), i))
            texts.append(f"{prose(1000 + 7 * i + k, 13 * k + i)} {version}\n{prose(2000 + i, 40)}")
    assert matches(make_docs(texts), benchmark(spark, items)) == planted


def test_share_and_answer_are_asked_for(spark, make_docs):
    item = prose(1, 30)
    words = item.split()
    half = " ".join(words[:15]) + " " + prose(2, 15)
    unanswered = " ".join(words[:25]) + " " + prose(3, 5)
    docs = make_docs([half, unanswered, item] + [prose(10 + i, 60) for i in range(20)])
    assert matches(docs, benchmark(spark, [(0, item)])) == {(1, 0), (2, 0)}
    with_answer = spark.createDataFrame([(0, item, "zebra crossing")], "item_id long, text string, answer string")
    assert matches(docs, with_answer) == set()
    told = make_docs([item, f"{item} zebra crossing"])
    assert matches(told, with_answer) == {(1, 0)}


def test_items_without_an_answer_are_decided_by_the_share(spark, make_docs, tmp_path):
    item = prose(1, 30)
    words = item.split()
    cut, half = " ".join(words[:25]) + " " + prose(3, 5), " ".join(words[:15]) + " " + prose(2, 15)
    docs, bench = make_docs([half, cut, item] + [prose(10 + i, 60) for i in range(20)]), benchmark(spark, [(0, item)])
    found = decontaminate.benchmark_matches(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 0), (2, 0)}
    answers = [(0, item, None), (1, item, " ?"), (2, item, "zebra crossing")]
    answered = spark.createDataFrame(answers, "item_id long, text string, answer string")
    found = decontaminate.benchmark_matches(docs, answered).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(d, i) for d in (1, 2) for i in (0, 1)}
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    assert {r.doc_id for r in queries.QUERIES["op4_decontamination"](spark, str(tmp_path)).collect()} == {1, 2}


def test_awkward_tables(spark, make_docs, awkward):
    docs = make_docs(awkward)
    bench = benchmark(spark, [(0, prose(1, 60)), (1, None), (2, ""), (3, "one"), (None, prose(3, 40)), (0, prose(1, 60)),
                              (5, "a b c"), (6, "b a"), (7, "..")])
    got = matches(docs, bench)
    assert got == {(i, 0) for i in (3, 4, 5, 7, 17)} | {(7, None), (10, 3), (11, 5)}
    nameless = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert matches(nameless.unionAll(nameless), bench) == {(None, i) for i in (0, None, 3, 5)}
    assert matches(docs.limit(0), bench) == set() and matches(docs, bench.limit(0)) == set()


def test_blocks_of_items(spark, make_docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 60)
    items = [(i, prose(100 + i, 20)) for i in range(10)]
    docs = make_docs([f"{prose(i, 30)} {t} {prose(50 + i, 30)}" for i, t in items] + [prose(70, 50)])
    assert matches(docs, benchmark(spark, items)) == {(i, i) for i in range(10)}


def test_latent_space_spans_the_leading_directions(spark):
    draw = np.random.default_rng(0)
    items = [decontaminate.Item(i, draw.choice([f"w{k}" for k in range(30)], 12).tolist(), []) for i in range(20)]
    vocab = decontaminate.vocabulary(items, {}, 50)
    spans = spark.createDataFrame([(" ".join(draw.choice([f"w{k}" for k in range(30)], 32)),) for _ in range(40)],
                                  "words string")
    space = decontaminate.latent_space(spans, vocab, items)
    rows = [r.words.split() for r in spans.collect()]
    dense = np.zeros((len(rows) + len(items), len(vocab.terms)))
    for i, words in enumerate([*rows, *(it.words for it in items)]):
        for c in vocab.codes(words):
            if c < len(vocab.terms):
                dense[i, c] += vocab.idf[c] * (1 if i < len(rows) else np.sqrt(len(rows) / len(items)))
    assert np.allclose(space.T @ space, np.eye(space.shape[1]), atol=1e-4)
    assert np.allclose(dense @ space @ space.T, dense, atol=1e-2)


def test_exact_copies_need_no_cosine(spark, make_docs, monkeypatch):
    draw = random.Random(5)
    items = [(i, " ".join(draw.choices([f"w{k}" for k in range(3000)], k=5 + i % 20))) for i in range(400)]
    docs = make_docs([f"{prose(i, 7 + i % 9)} {t.upper()}, {prose(900 + i, 30)}" for i, t in items])
    monkeypatch.setattr(decontaminate, "LATENT", 2)
    for words in (50_000, 1_000):
        monkeypatch.setattr(decontaminate, "GROUP_WORDS", words)
        found = decontaminate.benchmark_matches(docs, benchmark(spark, items)).collect()
        assert {(i, i) for i, _ in items} <= {(r.doc_id, r.item_id) for r in found}


def test_each_group_of_items_has_its_own_parts():
    items = [decontaminate.Item(i, prose(i, 20).split(), []) for i in range(6)]
    terms = decontaminate.vocabulary(items, {}, 0).terms
    vocab = decontaminate.Vocabulary(terms, np.zeros(0))
    gate = decontaminate.Gate([items[:3], items[3:]], terms)
    words = [*prose(50, 100).split(), *items[4].words, *prose(51, 100).split(), *items[1].words]
    spans = gate.spans(vocab.codes(words))
    assert [g for g, a, b in spans] == [0, 1]
    assert all(a <= at and at + 20 <= b for (_, a, b), at in zip(spans, (220, 100), strict=True))


def test_matches_equal_a_search_of_every_window(spark, make_docs):
    """No gate and no cosine: every window of every document against every item."""
    draw = random.Random(21)
    items = [(i, prose(500 + i, draw.choice([9, 14, 25, 40, 60]))) for i in range(25)]
    texts = [prose(i, draw.choice([5, 60, 300])) for i in range(30)] + [None, "", items[0][1][:9]]
    for _i, item in items:
        words = item.split()
        for share in (0.0, 0.1, 0.2, 0.3, 0.5):
            changed = [w if draw.random() >= share else prose(draw.randrange(10**6), 1) for w in words]
            kept = [w for w in changed if draw.random() >= share / 4]
            texts.append(f"{prose(draw.randrange(9999), draw.randrange(60))} {' '.join(kept)} {prose(draw.randrange(9999), 30)}")
    made = [decontaminate.Item(i, decontaminate.words_of(t), []) for i, t in items]
    want = set()
    for d, text in enumerate(texts):
        words = decontaminate.words_of(text)
        for item in made:
            starts = range(0, max(1, len(words)), decontaminate.STEP)
            if any(item.match(words[s:s + item.window]) for s in starts):
                want.add((d, item.item_id))
    got = matches(make_docs(texts), benchmark(spark, items))
    assert got <= want and len(got) >= 0.98 * len(want) and len(want) > 60
