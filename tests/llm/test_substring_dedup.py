"""Substring de-duplication against a table of all windows."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from cabstream.llm import substring_dedup


def direct(texts, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen, out = set(), []
    for own in words:
        cover = [False] * len(own)
        for i in range(len(own) - window + 1):
            key = tuple(own[i:i + window])
            if key in seen:
                cover[i:i + window] = [True] * window
            seen.add(key)
        out.append((len(own), sum(cover), " ".join(w for w, c in zip(own, cover) if not c)))
    return out


@pytest.mark.parametrize("hot", [256, 1])
def test_equals_direct_removal(make_docs, awkward, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    draw = random.Random(1)
    mixed = [" ".join(draw.choices(["a", "b"], k=90)) for _ in range(6)] + [" ".join(["a", "b", "c"] * 40)]
    texts = awkward + mixed
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text)
           for r in substring_dedup.remove_repeats(make_docs(texts), 20).collect()}
    assert [got[i] for i in range(len(texts))] == direct(texts, 20)


def test_small_shards_and_windows(make_docs, awkward, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", 50)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text)
           for r in substring_dedup.remove_repeats(make_docs(awkward), 3).collect()}
    assert [got[i] for i in range(len(awkward))] == direct(awkward, 3)


def test_null_ids_come_first_and_equal_rows_are_one(make_docs, awkward):
    docs = make_docs(awkward[3:5])
    nameless = docs.withColumn("doc_id", F.when(F.col("doc_id") != 1, F.col("doc_id")))
    rows = substring_dedup.remove_repeats(nameless).collect()
    assert {(r.doc_id, r.n_removed) for r in rows} == {(None, 0), (0, 60)}
    twice = docs.where("doc_id = 0")
    assert [r.n_removed for r in substring_dedup.remove_repeats(twice.unionAll(twice)).collect()] == [0, 0]
    assert substring_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_automaton_tells_repeats_in_order():
    texts = [list("abcabcab"), list("xbcab"), list("abcx")]
    seen, want = set(), []
    for t in texts:
        mask = 0
        for i in range(len(t) - 2):
            key = tuple(t[i:i + 3])
            mask |= (key in seen) << i
            seen.add(key)
        want.append(mask)
    assert substring_dedup.repeated_windows(texts, 3) == want
