"""Public tokenizers in Python workers: exact ids and counts, each distinct piece of text encoded once."""

from __future__ import annotations

import codecs
import json
import os
import re
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from cabstream.llm.common import give_back

#: Pieces remembered by a worker and the longest one that is; together they bound the memory.
REMEMBERED = 3 << 17
LONGEST = 48
#: Bytes of text that are encoded at a time: each distinct piece of a batch once.
BATCH_BYTES = 6 << 20
#: Ends of words of a vocabulary, and punctuation that is a token of its own behind a letter or digit.
WORD_END, TAIL = "</w>", b".,;:!?"
#: Plain words that are encoded as one text.
RUN = 500
#: What a byte-level vocabulary shows for each byte: printable ones as they are, the others as letters from U+0100 on.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_SHOWN = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED) if b != 0x20}
SHOWN = "".join(chr(_SHOWN.get(b, b)) for b in range(256))
#: First bytes of U+0300 to U+036F, the combining marks that compose with an ASCII letter among them.
MARK_BYTES = (b"\xcc", b"\xcd")


def byte_batches(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about `limit` bytes; a longer text is a range of its own."""
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes)


class WordIds:
    """Token ids of the tokenizers library, without added special tokens.

    Where the tokenizer drops white space and no token can span it, a text is
    cut at ASCII white space, a boundary that can't change any id, and each
    distinct piece of a batch is encoded once; so are a word and the punctuation
    behind it, another such boundary. Nothing is remembered from batch to
    batch. Other tokenizers encode whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        self._encoder = Tokenizer.from_file(path)
        self._encoder.no_truncation()
        self._encoder.no_padding()
        self._cuts = _drops_space(parts)
        steps = parts.get("normalizer") or {}
        self._folds = any(s.get("type") == "Lowercase" for s in steps.get("normalizers", [steps]))
        self._added = [t["content"].lower().encode() for t in parts.get("added_tokens") or []]
        ends = (i for token, i in self._encoder.get_vocab().items() if token.endswith(WORD_END))
        self._ends = np.zeros(self._encoder.get_vocab_size() + 1, bool)
        self._ends[list(ends)] = True
        kinds = [s.get("type") for s in (parts.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        self._tells_words = (self._cuts and self._ends.any() and kinds == ["Split", "ByteLevel"]
                             and all(s.get("type") in ("NFC", "Lowercase") or s.get("pattern") == {"Regex": r"\s+"}
                                     for s in steps.get("normalizers", [steps])))
        # For plain words: white space parts them and nothing is left to normalise.
        self._plain = Tokenizer(self._encoder.model)
        self._plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        del parts, ends
        give_back()  # reading the file takes more memory than what is kept of it

    def __call__(self, text: bytes | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, one after the other."""
        return self.many([text])[0]

    def together(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each text of a column, encoded in batches of about BATCH_BYTES."""
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        for i, j in byte_batches(sizes, BATCH_BYTES):
            yield from self.many(texts.slice(i, j - i).to_pylist())

    def many(self, texts: Sequence[bytes | None]) -> list[bytes]:
        """Ids of each text. Texts are split and their pieces told apart by Arrow; each distinct piece is looked up once."""
        if not self._cuts:
            whole = self._one_by_one(pa.array([(t or b"").decode("utf-8", "replace") for t in texts], pa.large_string()))
            return whole.to_pylist()
        folded = pa.array([self._folded(t) if t else b"" for t in texts], pa.large_binary()).view(pa.large_string())
        try:
            folded.validate(full=True)
        except pa.ArrowInvalid:  # no UTF-8
            folded = pa.array([self._folded((t or b"").decode("utf-8", "replace").encode()) for t in texts], pa.large_string())
        split = pc.ascii_split_whitespace(folded)
        del folded
        pieces, bounds = split.values.dictionary_encode(), np.array(split.offsets)
        del split
        ids = self._ids(pieces.dictionary).take(pieces.indices)
        del pieces
        if not len(ids):
            return [b""] * len(texts)
        _valid, ends, data = ids.buffers()
        places = np.frombuffer(ends, np.int64)[bounds].tolist()
        data = memoryview(data)
        return [bytes(data[i:j]) for i, j in zip(places, places[1:], strict=False)]

    def _folded(self, text: bytes) -> bytes:
        """The text with A-Z lower-cased where case doesn't count.

        It counts in added tokens, and for letters that a mark follows: only
        some pairs are composed before the tokenizer folds case, e.g. small h
        with a line below. Marks that compose with A-Z begin with MARK_BYTES.
        """
        if not self._folds or any(b in text for b in MARK_BYTES):
            return text
        folded = text.lower()
        return text if any(t in folded for t in self._added) else folded

    def _ids(self, pieces: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """Ids of distinct pieces; of a word and the punctuation behind it, each on its own."""
        cores, ends = _without_tails(pieces)
        tails = pa.array([p[n:] for p, n in zip(pieces.filter(ends["cut"]).to_pylist(), ends["chars"], strict=True)], pa.large_string())
        parts = pa.concat_arrays([cores, tails]).dictionary_encode()
        ids = self._encode(parts.dictionary).take(parts.indices)
        behind = np.full(len(pieces), -1)
        behind[np.flatnonzero(ends["cut"])] = len(pieces) + np.arange(len(tails))
        empty = pa.array([b""], pa.large_binary())
        tail_ids = pa.concat_arrays([ids, empty]).take(pa.array(np.where(behind < 0, len(ids), behind)))
        return pc.binary_join_element_wise(ids.slice(0, len(pieces)), tail_ids, empty[0])

    def _encode(self, pieces: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """Ids of each piece; words are encoded many at a time and told apart by the tokens that end a word."""
        if not self._tells_words:
            return self._one_by_one(pieces)
        plain = np.asarray(pc.and_(pc.ascii_is_alpha(pieces), pc.ascii_is_lower(pieces)))
        other = np.flatnonzero(~np.asarray(pc.string_is_ascii(pieces)))
        kind = np.where(plain, 1, 0)  # 1: letters that stay as they are, 2: letters that are composed or lower-cased first
        kind[other] = [_letters(p) for p in pieces.take(pa.array(other)).to_pylist()]
        order, found = [], []
        for number, encoder in ((1, self._plain), (2, self._encoder)):
            which = np.flatnonzero(kind == number)
            runs = [which[i:i + RUN] for i in range(0, len(which), RUN)]
            texts = [" ".join(pieces.take(pa.array(run)).to_pylist()) for run in runs]
            if number == 1:
                texts = [t if t.isascii() else codecs.charmap_decode(t.encode(), "strict", SHOWN)[0] for t in texts]
            for run, told in zip(runs, encoder.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                ids = np.array(told.ids, "<u4")
                ends = np.flatnonzero(self._ends[ids]) + 1
                if len(ends) != len(run) or ends[-1] != len(ids):  # letters that become several words
                    kind[run] = 0
                    continue
                order.append(run)
                starts = pa.py_buffer(np.concatenate([[0], 4 * ends]).astype(np.int64))
                found.append(pa.Array.from_buffers(pa.large_binary(), len(run), [None, starts, pa.py_buffer(ids.tobytes())]))
        rest = np.flatnonzero(kind == 0)
        order.append(rest)
        found.append(self._one_by_one(pieces.take(pa.array(rest))))
        place = np.empty(len(pieces), np.int64)
        place[np.concatenate(order)] = np.arange(len(pieces))
        return pa.concat_arrays(found).take(pa.array(place))

    def _one_by_one(self, pieces: pa.LargeStringArray) -> pa.LargeBinaryArray:
        found = self._encoder.encode_batch_fast(pieces.to_pylist(), add_special_tokens=False)
        return pa.array([np.array(e.ids, "<u4").tobytes() for e in found], pa.large_binary())


def _letters(piece: str) -> int:
    """0: not all letters; 1: letters that composing and lower-casing leave as they are; 2: other letters."""
    if not piece.isalpha():
        return 0
    return 1 if piece.lower() == piece and unicodedata.is_normalized("NFC", piece) else 2


def _without_tails(pieces: pa.LargeStringArray) -> tuple[pa.LargeStringArray, dict]:
    """Pieces without the punctuation behind them where it parts from the word (`cut`), and their characters then.

    It does if the word ends in an ASCII letter or digit, or in another letter that stays one.
    """
    cores = pc.ascii_rtrim(pieces, characters=TAIL.decode())
    sizes, whole = np.asarray(pc.binary_length(cores)), np.asarray(pc.binary_length(pieces))
    _valid, offsets, data = cores.buffers()
    ends = np.frombuffer(offsets, np.int64)[cores.offset + 1:cores.offset + 1 + len(cores)]
    codes = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(1, np.uint8)
    last = np.where(sizes > 0, codes[np.maximum(ends - 1, 0)], 0)
    alnum = (last >= 48) & (last <= 57) | (last >= 65) & (last <= 90) | (last >= 97) & (last <= 122)
    cut = (sizes < whole) & (sizes > 0) & (alnum | (last >= 128))
    unsure = np.flatnonzero(cut & (last >= 128))
    cut[unsure] = [unicodedata.normalize("NFC", c[-1]).lower().isalpha() for c in cores.take(pa.array(unsure)).to_pylist()]
    kept = pc.if_else(pa.array(cut), cores, pieces)
    return kept, {"cut": pa.array(cut), "chars": pc.utf8_length(cores.filter(pa.array(cut))).to_pylist()}


def _drops_space(parts: dict) -> bool:
    """Whether pieces found by the tokenizer never hold white space, added tokens included."""
    import regex

    steps = parts.get("pre_tokenizer") or {}
    first = (steps.get("pretokenizers") or [steps])[0]
    pattern = (first.get("pattern") or {}).get("Regex")
    if first.get("type") != "Split" or first.get("behavior") != "Removed" or not first.get("invert") or not pattern:
        return False
    added = [t["content"] for t in parts.get("added_tokens") or []]
    probe = "".join(f"{a}{s}{b}" for s in " \t\n\x0b\x0c\r" for a in "a1.'" for b in "a1.'s")
    return (not any(re.search(r"\s", t) for t in added)
            and not any(re.search(r"[ \t-\r]", found) for found in regex.findall(pattern, probe)))


class PieceCounts:
    """Numbers of tokens of the sentencepiece library, without begin and end.

    A space becomes the mark U+2581. If no piece of the vocabulary has the mark
    after another character, no merge spans the place before a space that
    follows another character: texts are cut there and each distinct part is
    encoded once. Other models encode whole texts.
    """

    MARK = "▁"

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (self._model.id_to_piece(i) for i in range(self._model.get_piece_size()))
        self._cuts = not any(self.MARK in p.lstrip(self.MARK) for p in pieces) and self._plain_spaces()
        self._last = len(self._model.encode("a ")) - len(self._model.encode("a"))
        self._known: dict[bytes, int] = {}

    def _plain_spaces(self) -> bool:
        """Whether each space counts and one mark is put before a text."""
        shown = "".join(self._model.encode("a  b", out_type=str))
        return shown == f"{self.MARK}a{self.MARK}{self.MARK}b"

    def parts(self, text: bytes) -> list[bytes]:
        """Parts which encoded on their own, each after one mark, give the text's tokens."""
        text = text.replace(self.MARK.encode(), b" ")
        if b"  " not in text and not text.startswith(b" ") and not text.endswith(b" "):
            return text.split(b" ")
        # A part holds the spaces before its word but one, which the library adds.
        return [p[1:] for p in re.findall(rb" +[^ ]+| +$", b" " + text)]

    def count(self, texts: Sequence[bytes | None]) -> list[int]:
        """Tokens of each text; null and empty ones have none."""
        if not self._cuts:
            return [len(ids) for ids in self._model.encode([(t or b"").decode("utf-8", "replace") for t in texts],
                                                           num_threads=1)]
        known, cut = self._known, [self.parts(t) if t else [] for t in texts]
        new = [p for p in set().union(*cut) if p not in known]
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = list(set().union(*cut))
        found = dict(zip(new, map(len, self._model.encode([p.decode("utf-8", "replace") for p in new], num_threads=1)),
                         strict=True)) if new else {}
        if b"" in found:  # a last space; the library adds no mark to an empty text
            found[b""] = self._last
        if found and max(map(len, found)) > LONGEST:
            counts = [sum([known[p] if p in known else found[p] for p in parts]) for parts in cut]
            known.update((p, n) for p, n in found.items() if len(p) <= LONGEST)
            return counts
        known.update(found)
        return [sum(map(known.__getitem__, parts)) for parts in cut]


@lru_cache(maxsize=4)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


@lru_cache(maxsize=4)
def piece_counts(path: str) -> PieceCounts:
    return PieceCounts(path)
