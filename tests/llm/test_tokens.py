"""Token counts, packing and token files against the libraries themselves."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cabstream.llm import binary_output, packing, token_counts, tokens
from cabstream.session import work_folder

WORDS, PIECES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "piece_bpe_32k.model"))
BYTES = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = [*"ab éß.,'s\n\t\r\x0b\x0c\x1c\x85\xa0   ▁<0Σςİ字", "<|endoftext|>", "<s>", "　", "th", "word" * 20, "'re"]


@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def ids_of(words, text):
    return words.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_cut_texts_give_the_library_s_tokens(words, pieces):
    draw, encode, count = random.Random(3), tokens.WordIds(WORDS), tokens.PieceCounts(PIECES)
    whole = tokens.WordIds(BYTES)
    other = Tokenizer.from_file(BYTES)
    assert encode._cuts and count._cuts and not whole._cuts
    texts = ["".join(draw.choices(ALPHABET, k=draw.randrange(14))) for _ in range(3000)]
    assert count.count([t.encode() for t in texts]) == [len(pieces.encode(t)) for t in texts]
    for t in texts:
        assert np.frombuffer(encode(t.encode()), "<u4").tolist() == ids_of(words, t)
    for t in texts[:200]:
        assert np.frombuffer(whole(t.encode()), "<u4").tolist() == other.encode(t, add_special_tokens=False).ids


def test_marks_behind_every_letter_give_the_library_s_tokens(words):
    encode = tokens.WordIds(WORDS)
    letters = [chr(c) for c in [*range(65, 91), *range(97, 123), 0xC9, 0x130, 0x212A]]
    for mark in [chr(c) for c in [*range(0x300, 0x370), 0x483, 0x5B0, 0x1AB0, 0x20D0, 0x3099, 0xFE20]]:
        texts = [f"{x}{mark}{y}" for x in letters for y in ("", ".", "a", " Next")] + [f"No Mark {mark} W{mark}, .{mark}B"]
        for t, ids in zip(texts, encode.many([t.encode() for t in texts]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == ids_of(words, t), ascii(t)


def test_random_texts_with_marks_give_the_library_s_tokens(words):
    draw, encode = random.Random(9), tokens.WordIds(WORDS)
    alphabet = [*ALPHABET, *"HTWYJAEIOU", "\u0331", "\u0308", "\u030a", "\u030c", "\u0301", "\u0345", ". ", ", ", "é"]
    texts = ["".join(draw.choices(alphabet, k=draw.randrange(16))) for _ in range(5000)]
    for at in range(0, len(texts), 50):
        found = encode.many([t.encode() for t in texts[at:at + 50]])
        assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [ids_of(words, t) for t in texts[at:at + 50]]


def test_bytes_that_are_no_text_count_as_replaced(words):
    encode, raw = tokens.WordIds(WORDS), [b"Good text.", b"bad \xff\xfe bytes\xc3", b"", None, "é\u0301 ok".encode(), b"\xe2\x82 cut"]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in encode.many(raw)]
    assert got == [ids_of(words, (t or b"").decode("utf-8", "replace")) for t in raw]
    assert encode.many([]) == [] and encode.many([b"", None]) == [b"", b""]


def test_memory_of_pieces_is_bounded(pieces, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    count = tokens.PieceCounts(PIECES)
    for t in ("a b c d", "e f g h a", "a b", "long" * 40 + " a b c d e f g", ""):
        assert count.count([t.encode()]) == [len(pieces.encode(t))]
    assert len(count._known) <= 13


def test_counts(make_docs, awkward, pieces):
    got = token_counts.token_counts(make_docs(awkward), PIECES, limit=100).collect()
    want = [(i, len((t or "").encode()), len(pieces.encode(t or ""))) for i, t in enumerate(awkward)]
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 100) for r in got)
    assert token_counts.token_counts(make_docs(awkward).limit(0), PIECES).count() == 0
    assert list(tokens.byte_batches([3, 3, 9, 1], 6)) == [(0, 2), (2, 3), (3, 4)]


@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), max_size=25), st.integers(60, 90))
@settings(max_examples=150, deadline=None)
def test_plan_places_every_piece_once_without_gaps(counts, capacity):
    bins, ranks = defaultdict(list), defaultdict(list)
    for s in packing.packing_plan(counts, capacity):
        after = [x.rank for x in packing.packing_plan(counts, capacity) if x.length == s.length and x.rank > s.rank]
        for rank in range(s.rank, min(after, default=counts[s.length])):
            k = rank - s.rank
            bins[s.first + k % s.bins].append((s.offset + k // s.bins * s.length, s.length))
            ranks[s.length].append(rank)
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(n * c for n, c in counts.items())
    large = sum(c for n, c in counts.items() if 2 * n > capacity)
    assert max(-(-total // capacity), large) <= len(bins) <= max(1.5 * total / capacity + 1, large + 2 * total / capacity)


@given(st.dictionaries(st.integers(1, 60), st.integers(1, 12), max_size=20), st.integers(60, 90))
@settings(max_examples=100, deadline=None)
def test_plan_equals_packing_piece_by_piece(counts, capacity):
    """Large pieces: the longest left with the longest that fits; small ones: longest first into the smallest gap."""
    large = sorted((n for n, c in counts.items() if 3 * n > capacity for _ in range(c)), reverse=True)
    bins = []
    while large:
        first = large.pop(0)
        mate = next((n for n in large if first + n <= capacity), None)
        if mate is not None:
            large.remove(mate)
        bins.append([first] + [mate] * (mate is not None))
    for n in sorted((n for n, c in counts.items() if 3 * n <= capacity for _ in range(c)), reverse=True):
        fits = [b for b in bins if sum(b) + n <= capacity]
        best = max(fits, key=sum, default=None)
        if best is None:
            bins.append([n])
        else:
            best.append(n)
    made = defaultdict(list)
    slots = packing.packing_plan(counts, capacity)
    for s in slots:
        after = [x.rank for x in slots if x.length == s.length and x.rank > s.rank]
        for rank in range(s.rank, min(after, default=counts[s.length])):
            made[s.first + (rank - s.rank) % s.bins].append(s.length)
    assert len(made) == len(bins) and sorted(map(sum, made.values())) == sorted(map(sum, bins))


def test_packing_of_awkward_documents(make_docs, awkward, words):
    packed = packing.packed_documents(make_docs(awkward), WORDS, capacity=512, with_ids=True)
    rows = packed.collect()
    for i, text in enumerate(awkward):
        ids = ids_of(words, text) + [1]
        own = sorted((r.piece, r.start, r.length, r.ids_crc32, r.ids) for r in rows if r.doc_id == i)
        cut = [ids[j:j + 512] for j in range(0, len(ids), 512)]
        assert own == [(k, 512 * k, len(c), crc(c), c) for k, c in enumerate(cut)]
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.ids))
    joined = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    assert {k: [x for _, ids in sorted(v) for x in ids] for k, v in by.items()} == joined
    assert max(map(len, joined.values())) <= 512
    assert len(joined) <= -(-sum(r.length for r in rows) // 512) + 1


def test_packing_of_null_ids_repeated_rows_and_empty_table(make_docs, awkward):
    docs = make_docs(awkward).withColumn("doc_id", F.lit(None).cast("long"))
    rows = packing.packed_documents(docs.unionAll(docs), WORDS, capacity=4096).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
    assert packing.packed_documents(docs.limit(0), WORDS).count() == 0


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_files_give_back_every_id(spark, make_docs, awkward, words, planes, monkeypatch):
    monkeypatch.setattr(binary_output, "SEGMENT_IDS", 5000)
    path = work_folder(spark, "test-files")
    binary_output.write_token_files(make_docs(awkward), path, WORDS, planes=planes, shards=3)
    rows = sorted(binary_output.read_documents(spark, path, planes=planes, with_ids=True).collect())
    at = 0
    for i, (text, r) in enumerate(zip(awkward, rows, strict=True)):
        ids = ids_of(words, text) + [2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32, r.ids) == (i, at, len(ids), crc(ids), ids)
        at += len(ids)


def test_files_of_null_ids_and_of_an_empty_table(spark, make_docs, awkward):
    for name, docs in (("none", make_docs(awkward).limit(0)),
                       ("null", make_docs(awkward[:5]).withColumn("doc_id", F.lit(None).cast("long")))):
        path = work_folder(spark, f"test-{name}")
        binary_output.write_token_files(docs, path, WORDS)
        rows = binary_output.read_documents(spark, path).orderBy("start").collect()
        assert len(rows) == docs.count()
        assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:i]) for i in range(len(rows))]


@given(st.lists(st.integers(0, 2 ** 32 - 1), max_size=300))
@settings(max_examples=60, deadline=None)
def test_planes_round_trip(ids):
    raw = np.array(ids, "<u4").tobytes()
    for planes in ("byte", "bit"):
        index, payload = binary_output.pack_ids(raw, planes)
        assert binary_output.unpack_ids(index, payload, len(ids), planes) == raw
        assert len(index) == binary_output.PLANES[planes] * -(-len(ids) // binary_output.BLOCK_IDS)
