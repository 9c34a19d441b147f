"""Licence scans against a search of every place for every template."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from cabstream.llm import license_scan

from .conftest import prose


def plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def direct(text, share=0.8, templates=license_scan.TEMPLATES):
    own = plain_words(text)
    at = [(i, label) for p, label in license_scan.BASE.items() for i in range(len(own))
          if own[i:i + len(p.split())] == p.split()]
    labels, score = {label for _i, label in at}, 1.0 if at else 0.0
    for t in templates:
        wanted = plain_words(t.text)
        for start in range(1 - len(wanted), len(own)):
            same = [0 <= start + j < len(own) and own[start + j] == w for j, w in enumerate(wanted)]
            part = sum(same) / len(wanted)
            if part >= share - 1e-12 and all(_stands(wanted, same, plain_words(p)) for p in t.phrases):
                labels.add(t.label)
                score = max(score, part)
    starts = [i for i, _label in at]
    return (len(own), len(at), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _i, label in at})), ",".join(sorted(labels)), score)


def _stands(wanted, same, phrase):
    at = next(i for i in range(len(wanted)) if wanted[i:i + len(phrase)] == phrase)
    return all(same[at:at + len(phrase)])


def texts(seed):
    """Whole notices, with words changed or cut, as comments, in prose, twice, and base phrases that follow each other."""
    draw, out = random.Random(seed), []
    for t in license_scan.TEMPLATES:
        own = t.text.split()
        for changes in (0, 1, 2, 4, 8):
            new = list(own)
            for i in draw.sample(range(len(own)), min(changes, len(own))):
                new[i] = draw.choice(["changed", "THE", "", "license"])
            out.append(f"{prose(draw.randrange(99), 12)}\n# {' '.join(new)}\n{prose(draw.randrange(99), 9)}")
        out += [" ".join(own[:-3]), " ".join(own[4:]), f"{t.text.upper()} {t.text}", "/* " + t.text.replace(" ", "\n * ")]
    return out + ["MIT License mit license", "cc-by", "CC\tBY-SA", "Xcc by", "cc byé", "gnu general public", "apache  LICENSE."]


@pytest.fixture(scope="module")
def rows(awkward):
    return [*awkward, *texts(1)]


@pytest.mark.parametrize("piece", [license_scan.PIECE, 40])
def test_scan_equals_a_search_of_every_place(make_docs, rows, piece):
    got = {r[0]: tuple(r)[1:] for r in license_scan.scan(make_docs(rows), piece=piece).collect()}
    want = {i: direct(t) for i, t in enumerate(rows)}
    assert {i: r[:6] for i, r in got.items()} == {i: r[:6] for i, r in want.items()}
    assert all(abs(got[i][6] - want[i][6]) < 1e-12 for i in want)


@pytest.mark.parametrize("share", [0.5, 1.0])
def test_other_shares(make_docs, share):
    sample = texts(2)
    got = {r.doc_id: r.labels for r in license_scan.scan(make_docs(sample), share=share).collect()}
    assert got == {i: direct(t, share)[5] for i, t in enumerate(sample)}


def test_common_licence_words_are_not_looked_up(spark):
    holding = {b"license": 900, b"the": 1000, b"released": 400, b"under": 800, b"mit": 3}
    index = license_scan.Index([license_scan.Template("mit", "Released under the MIT License", ("mit license",))],
                               1000, holding, 0.8)
    assert set(index.postings) == {b"mit", b"released"}


def test_frequencies_cover_all_texts(make_docs):
    docs = make_docs(["the license", "the", None, "license " * 9, ""])
    assert license_scan.document_frequencies(docs, [b"the", b"license", b"none"]) == (5, {b"the": 2, b"license": 2})


def test_repeated_rows_null_ids_and_an_empty_table(make_docs):
    docs = make_docs([license_scan.TEMPLATES[0].text, None]).withColumn("labels", F.lit("x"))
    nameless = docs.withColumn("doc_id", F.lit(None).cast("long"))
    got = license_scan.scan(docs.unionAll(docs).unionAll(nameless)).collect()
    assert sorted(r.labels for r in got) == [""] * 3 + ["mit"] * 3 and sum(r.doc_id is None for r in got) == 2
    assert license_scan.scan(docs.limit(0)).collect() == []


def test_a_phrase_outside_its_template_is_refused():
    with pytest.raises(ValueError):
        license_scan.Index([license_scan.Template("x", "some words", ("other words",))], 1, {}, 0.8)
