"""Language identification: gradients, held-out accuracy, awkward texts."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cabstream.llm import lang_id, queries

ENDINGS = {"aa": ["ka", "lo", "mi"], "bb": ["str", "cht", "sch"], "cc": ["é", "ço", "ñu"]}


def text(lang, seed, n=30):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices(ENDINGS[lang], k=3)) for _ in range(n))


@pytest.fixture(scope="module")
def model():
    return lang_id.train({k: [w.encode() for i in range(20) for w in text(k, i).split()] for k in ENDINGS}, steps=60)


def test_backpropagation_gives_the_slopes():
    model = lang_id.new_model(["a", "b", "c"], units=3)
    for d in (model.ahead, model.back):
        d.inputs, d.hidden, d.bias = (w.astype(np.float64) for w in d.weights())
    model.output, model.offset = model.output.astype(np.float64), model.offset.astype(np.float64)
    codes, lengths = lang_id._codes([b"abc", b"xyzzy", b"q", b"abca"])
    truth = np.array([0, 1, 2, 0])
    _, slopes = model.gradients(codes, lengths, truth)
    for weight, slope in zip(model.weights(), slopes, strict=True):
        for place in list(zip(*np.nonzero(np.abs(slope) > 1e-4)))[:6]:
            before = weight[place]
            losses = []
            for step in (1e-3, -1e-3):
                weight[place] = before + step
                losses.append(model.gradients(codes, lengths, truth)[0])
            weight[place] = before
            assert abs((losses[0] - losses[1]) / 2e-3 - slope[place]) < 2e-3


def test_labels_every_position_of_whole_texts(model):
    words = [b"kalomi", b"strchtsch", "éçoñu".encode(), b"k"]
    sums = model.label(words)
    assert np.allclose(sums.sum(axis=1), [len(w) for w in words], atol=1e-4)
    own = lang_id.Labeller(model)
    late = (text("aa", 1, 4) + " " + text("bb", 2, 5000)).encode()
    assert [x for x, _ in own.label([text("aa", 7).encode(), late, text("cc", 3).encode()])] == ["aa", "bb", "cc"]
    one = own.label([late])[0]
    assert own.label([late, late]) == [one, one]


def test_awkward_texts(model, make_docs):
    texts = [None, "", "  \n", "12 34 !!", "１２ ..", "é", "x" * 5000, "字" * 100, text("bb", 9), text("bb", 9), "-" * 99]
    docs = make_docs(texts)
    rows = lang_id.identify(docs, model, keep=docs.columns).orderBy("doc_id").collect()
    got = [(r.lang_pred, r.score) for r in rows]
    assert [g[0] == "und" for g in got] == [True, True, True, True, True, False, False, False, False, False, True]
    assert all(0 <= s <= 1 for _, s in got) and got[8] == got[9] and got[8][0] == "bb"
    assert [r.text for r in rows] == texts and set(docs.columns) <= set(rows[0].asDict())
    assert lang_id.identify(docs.limit(0), model).count() == 0


def test_memory_of_words_is_bounded(model, monkeypatch):
    own, few = lang_id.Labeller(model), lang_id.Labeller(model)
    texts = [text(k, i).encode() for i in range(5) for k in ENDINGS]
    want = own.label(texts)
    monkeypatch.setattr(lang_id, "REMEMBERED", 10)
    monkeypatch.setattr(lang_id, "TOGETHER", 20)
    got = few.label(texts)
    assert [a for a, _ in got] == [a for a, _ in want]
    assert np.allclose([b for _, b in got], [b for _, b in want], atol=1e-5)


def test_learns_only_from_documents_that_are_not_held_out(make_docs, spark):
    texts = [text("aa", i) if zlib.crc32(str(i).encode()) % 4 != 2 else "secret" for i in range(40)] + [None, "x"]
    docs = make_docs(texts, lang=["aa"] * 40 + ["bb", None])
    words = {w for own in lang_id.training_words(docs).values() for w in own}
    assert words and b"secret" not in words and b"x" not in words
    assert lang_id.training_words(docs.limit(0)) == {}
    nothing = lang_id.languages(docs.limit(0))
    assert nothing.count() == 0 and nothing.columns == ["doc_id", "held_out", "lang_pred", "score"]
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in lang_id.languages(unlabelled).collect()} == {"und"}


def test_every_label_is_learned(make_docs):
    labels = [f"l{i % 100:03d}" for i in range(800)] + [f"r{i:04d}" for i in range(1300)]
    words = lang_id.training_words(make_docs([f"word{x} text" for x in labels], lang=labels))
    ids = [i for i in range(len(labels)) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert set(words) == {labels[i] for i in ids} and len(words) > 1000
    few = [f"l{i % 100:03d}" for i in range(800)]
    model = lang_id.train(lang_id.training_words(make_docs([f"{x * 3} {x}" for x in few], lang=few)), steps=2)
    assert len(model.languages) == 100 and model.label([b"l001"]).shape == (1, 100)


def test_label_equals_a_plain_pass_over_the_bytes(model):
    """One byte after the other, one word at a time, in double precision."""
    def steps(direction, codes):
        inputs, hidden, bias = (w.astype(np.float64) for w in direction.weights())
        units, state, out = hidden.shape[0], np.zeros(hidden.shape[0]), []
        for code in codes:
            mixed, given = state @ hidden + bias, inputs[code]
            update, reset = (1 / (1 + np.exp(-(mixed[a:a + units] + given[a:a + units]))) for a in (0, units))
            new = np.tanh(given[2 * units:] + reset * mixed[2 * units:])
            state = update * state + (1 - update) * new
            out.append(state)
        return out

    words = [b"a", "kalomi", "straße", "x" * 31, "éà字", "b", "kalomi"]
    words = [w if isinstance(w, bytes) else w.encode() for w in words]
    for word, sums in zip(words, model.label(words), strict=True):
        ahead, back = steps(model.ahead, word), steps(model.back, word[::-1])[::-1]
        want = 0
        for a, b in zip(ahead, back, strict=True):
            scores = np.concatenate([a, b]) @ model.output.astype(np.float64) + model.offset
            want = want + np.exp(scores) / np.exp(scores).sum()
        assert np.allclose(sums, want, atol=1e-4)


def test_held_out_accuracy(spark, sf_dir):
    got = queries.QUERIES["op8_language_id"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").collect()
    assert len(rows) == 200 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


def test_long_words_are_cut_between_characters():
    word = ("é" * 100).encode()
    assert b"".join(lang_id.cut_words(word)) == word
    assert all(len(w) <= lang_id.LONGEST and w.decode() for w in lang_id.cut_words(b"a" + word))
    parts = list(lang_id.blocks(b"ab " * 700_000))
    assert b"".join(parts) == b"ab " * 700_000 and len(parts) > 1
