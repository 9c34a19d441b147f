"""Licence notices in texts, by a positional index of licence words that are rare in the corpus."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabstream.session import ship_package

#: Byte table: digits, a-z and bytes of non-ASCII letters stay, A-Z are lower-cased, all else parts words.
WORDS = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
#: Bytes of a text that are split into words at a time.
PIECE = 1 << 20


class Template(NamedTuple):
    """A passage of a licence: its label, its words and the phrases that must stand in place word for word."""

    label: str
    text: str
    phrases: tuple[str, ...]


#: Phrases that give a label wherever their words follow each other. Fixed values.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Passages of public licences.
TEMPLATES = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
             "associated documentation files (the \"Software\"), to deal in the Software without restriction",
             ("permission is hereby granted free of charge",)),
    Template("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial "
             "portions of the Software", ("permission notice shall be included",)),
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
             "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
             ("with or without fee",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
             "provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    Template("bsd-3-clause", "may be used to endorse or promote products derived from this software without specific prior "
             "written permission", ("endorse or promote products",)),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license version 2 0",)),
    Template("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the "
             "License at http://www.apache.org/licenses/LICENSE-2.0", ("except in compliance with the license",)),
    Template("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the "
             "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express "
             "or implied", ("without warranties or conditions of any kind",)),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
             "General Public License as published by the Free Software Foundation", ("gnu general public license",)),
    Template("gpl-2.0", "GNU General Public License, version 2", ("public license version 2",)),
    Template("gpl-3.0", "GNU General Public License, version 3", ("public license version 3",)),
    Template("lgpl", "it under the terms of the GNU Lesser General Public License as published by the Free Software "
             "Foundation", ("gnu lesser general public license",)),
    Template("agpl", "it under the terms of the GNU Affero General Public License as published by the Free Software "
             "Foundation", ("gnu affero general public license",)),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
             ("mozilla public license v 2 0",)),
    Template("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse "
             "Public License 2.0", ("eclipse public license 2 0",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain",
             ("unencumbered software released into the public domain",)),
    Template("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring "
             "rights to this work", ("waived all copyright and related or neighboring rights",)),
    Template("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License",
             ("creative commons attribution 4 0",)),
    Template("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
             "License", ("attribution sharealike 4 0",)),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ("cc by nc 4 0",)),
)


def words(text: bytes) -> list[bytes]:
    """Runs of digits, letters and non-ASCII characters, A-Z lower-cased."""
    return text.translate(WORDS).split()


def pieces(text: bytes | None, overlap: int, size: int = PIECE) -> Iterator[tuple[list[bytes], int]]:
    """A text's words in pieces, each after the last `overlap` words of those before, whose number comes with it."""
    plain, at, kept = (text or b"").translate(WORDS), 0, []
    while at < len(plain):
        end = plain.find(b" ", at + size)
        end = len(plain) if end < 0 else end
        own = kept + plain[at:end].split()
        yield own, len(kept)
        at, kept = end, own[max(0, len(own) - overlap):] if overlap else []


def document_frequencies(docs: DataFrame, vocabulary: Iterable[bytes], text_col: str = "text") -> tuple[int, dict[bytes, int]]:
    """Number of rows of `docs` and of those that hold each word of a small vocabulary, over whole texts of all rows."""
    ship_package(docs.sparkSession)
    wanted = frozenset(vocabulary)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            found[b""] += batch.num_rows
            for text in batch.column(0).to_pylist():
                found.update(set().union(*(wanted.intersection(own) for own, _kept in pieces(text, 0))))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())],
                                         names=["word", "n"])

    rows = docs.select(F.col(text_col).cast("binary")).mapInArrow(counted, "word binary, n long")
    sums = {bytes(r.word): r.n for r in rows.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return sums.pop(b"", 0), sums


class Index:
    """Positional postings of each template's rarest words.

    A template of m words is in place if at least `share` of them stand at the
    same distance from its start. Then at least one of its m - ceil(share m) + 1 rarest
    positions does, whichever words are missing; so these are indexed and no
    match is lost. Rare are words of a high inverse document frequency.
    """

    def __init__(self, templates: Sequence[Template], n_docs: int, holding: dict[bytes, int], share: float):
        self.labels = [t.label for t in templates]
        self.words = [words(t.text.encode()) for t in templates]
        self.least = [math.ceil(share * len(w) - 1e-9) for w in self.words]
        self.phrases = [[_place(w, words(p.encode())) for p in t.phrases] for t, w in zip(templates, self.words, strict=True)]
        self.idf = {w: math.log((n_docs + 1) / (holding.get(w, 0) + 1)) for own in self.words for w in own}
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        for t, own in enumerate(self.words):
            rarest = sorted(range(len(own)), key=lambda j: (-self.idf[own[j]], j))
            for j in rarest[:len(own) - self.least[t] + 1]:
                self.postings.setdefault(own[j], []).append((t, j))
        self.longest = max(map(len, self.words), default=0)

    def matches(self, text: list[bytes]) -> dict[int, float]:
        """Templates in place in a list of words, with the largest share of their words that stand there."""
        look_up = self.postings
        starts = {(t, i - j) for i, w in enumerate(text) if w in look_up for t, j in look_up[w]}
        found: dict[int, float] = {}
        for t, start in starts:
            own = self.words[t]
            inside = range(max(0, -start), min(len(own), len(text) - start))
            aligned = sum(text[start + j] == own[j] for j in inside)
            if aligned >= self.least[t] and all(
                    start + at >= 0 and text[start + at:start + at + len(p)] == p for at, p in self.phrases[t]):
                found[t] = max(found.get(t, 0.0), aligned / len(own))
        return found


def _place(own: list[bytes], phrase: list[bytes]) -> tuple[int, list[bytes]]:
    """Where a key phrase stands in its template."""
    for at in range(len(own) - len(phrase) + 1):
        if own[at:at + len(phrase)] == phrase:
            return at, phrase
    raise ValueError(f"the phrase {b' '.join(phrase).decode()!r} isn't in its template")


def places(text: list[bytes], phrase: bytes) -> list[int]:
    """Starts of a phrase's words in a list of words."""
    joined, wanted = b" " + b" ".join(text) + b" ", b" " + phrase + b" "
    found, at = [], joined.find(wanted)
    while at >= 0:
        found.append(joined.count(b" ", 0, at))
        at = joined.find(wanted, at + 1)
    return found


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, base: dict[str, str] | None = None,
         share: float = 0.8, id_col: str = "doc_id", text_col: str = "text", piece: int = PIECE) -> DataFrame:
    """One row per row of `docs`: what it holds of the base phrases and of the licence templates.

    Columns id_col, n_words, n_base (places where a base phrase stands),
    first_word and last_word (the first and last word at which one starts, from 0; null without
    any), base_labels, labels (those of templates in place too; both distinct,
    sorted, joined by commas, empty without any) and score: 1 with a base
    phrase, else the largest share of a template's words in place, 0 without.
    A template is in place if at least `share` of its words stand in order
    without gaps and its key phrases stand word for word; so notices with some
    words changed are found. Null and empty texts have no words. Rows stand for
    themselves, repeated ones and null ids too; other columns are not read. An empty table gives no rows.

    Document frequencies are taken over all texts; the templates and their
    index are constants of this call. Very long texts are read in pieces of about
    `piece` bytes that overlap by the longest template.
    """
    ship_package(docs.sparkSession)
    base = BASE if base is None else base
    n_docs, holding = document_frequencies(docs, {w for t in templates for w in words(t.text.encode())}, text_col)
    index = Index(templates, n_docs, holding, share)
    phrases = [(b" ".join(words(p.encode())), len(words(p.encode())), label) for p, label in base.items()]
    overlap = max([index.longest, *(n for _p, n, _label in phrases)])

    def looked_through(text: bytes | None) -> tuple:
        total, count, first, last, score = 0, 0, None, None, 0.0
        found: set[str] = set()
        more: set[str] = set()
        for own, kept in pieces(text, overlap, piece):
            shift = total - kept
            total += len(own) - kept
            for phrase, size, label in phrases:
                at = [shift + i for i in places(own, phrase) if i + size > kept]
                if at:
                    found.add(label)
                    count += len(at)
                    first = at[0] if first is None else min(first, at[0])
                    last = at[-1] if last is None else max(last, at[-1])
            for t, part in index.matches(own).items():
                more.add(index.labels[t])
                score = max(score, part)
        return (total, count, first, last, ",".join(sorted(found)), ",".join(sorted(found | more)),
                1.0 if found else score)

    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    names = [id_col, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [looked_through(t) for t in batch.column(1).to_pylist()]
            columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("binary").alias("_text")).mapInArrow(
        scanned, f"`{id_col}` {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
                 "labels string, score double")
