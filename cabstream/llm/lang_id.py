"""Language identification with a bidirectional gated recurrent network over bytes, trained in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from cabstream.llm.common import give_back
from cabstream.session import ship_package

#: Bounds of the training sample: documents over all languages, words of a document. Every language has one document at least.
SAMPLE_DOCS, SAMPLE_WORDS = 1200, 200
#: Units per direction, training steps, words per step, step size.
UNITS, STEPS, BATCH, RATE = 16, 500, 256, 0.01
#: Longest run of bytes that is one sequence; longer words are cut between characters.
LONGEST = 32
#: Words that a worker remembers, words that it labels at a time, bytes of a text that it splits at a time.
REMEMBERED, TOGETHER, BLOCK = 1 << 18, 1 << 17, 1 << 20
#: Words that run through the network side by side.
AT_ONCE = 256
UNDECIDED = "und"
_SPACE = re.compile(rb"[ \t-\r]")


@dataclass
class Direction:
    """One direction: input weights per byte, recurrent weights and biases for update, reset and new state."""

    inputs: np.ndarray
    hidden: np.ndarray
    bias: np.ndarray

    def forward(self, codes: np.ndarray) -> tuple[np.ndarray, list]:
        """States (time, rows, units) for byte codes (time, rows), and what backpropagation needs."""
        units = self.hidden.shape[0]
        state = np.zeros((codes.shape[1], units), np.float32)
        states, trace = [], []
        for code in codes:
            mixed, given = state @ self.hidden + self.bias, self.inputs[code]
            gates = _sigmoid(mixed[:, :2 * units] + given[:, :2 * units])
            update, reset = gates[:, :units], gates[:, units:]
            new = np.tanh(given[:, 2 * units:] + reset * mixed[:, 2 * units:])
            trace.append((state, update, reset, new, mixed[:, 2 * units:]))
            state = new + update * (state - new)
            states.append(state)
        return np.stack(states), trace

    def backward(self, codes: np.ndarray, trace: list, wanted: np.ndarray) -> Direction:
        """Gradients by backpropagation through time; `wanted` is the loss's gradient by each state."""
        units = self.hidden.shape[0]
        inputs, hidden, bias = (np.zeros_like(w) for w in (self.inputs, self.hidden, self.bias))
        carried = np.zeros_like(wanted[0])
        for code, (state, update, reset, new, mixed), direct in zip(codes[::-1], trace[::-1], wanted[::-1], strict=True):
            carried = carried + direct
            to_new = carried * (1 - update) * (1 - new * new)
            to_update = carried * (state - new) * update * (1 - update)
            to_reset = to_new * mixed * reset * (1 - reset)
            to_given = np.concatenate([to_update, to_reset, to_new], axis=1)
            to_mixed = np.concatenate([to_update, to_reset, to_new * reset], axis=1)
            np.add.at(inputs, code, to_given)
            hidden += state.T @ to_mixed
            bias += to_mixed.sum(axis=0)
            carried = carried * update + to_mixed @ self.hidden.T
        return Direction(inputs, hidden, bias)

    def weights(self) -> list[np.ndarray]:
        return [self.inputs, self.hidden, self.bias]


@dataclass
class Model:
    """Labels every byte position of a word with language probabilities."""

    languages: list[str]
    ahead: Direction
    back: Direction
    output: np.ndarray
    offset: np.ndarray

    def label(self, words: Sequence[bytes]) -> np.ndarray:
        """Probabilities summed over the positions of each word (rows, languages)."""
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        sums = np.zeros((len(words), len(self.languages)))
        for at in range(0, len(order) if self.languages else 0, AT_ONCE):
            part = order[at:at + AT_ONCE]
            codes, lengths = _codes([words[i] for i in part])
            chances = _softmax(self._run(codes, lengths)[0])
            real = np.arange(codes.shape[0])[:, None] < lengths
            sums[part] = (chances * real[:, :, None]).sum(axis=0, dtype=np.float64)
        return sums

    def _run(self, codes: np.ndarray, lengths: np.ndarray) -> tuple:
        turned = _turn(codes, lengths)
        ahead, trace = self.ahead.forward(codes)
        back, trace_back = self.back.forward(turned)
        states = np.concatenate([ahead, _turn(back, lengths)], axis=2)
        return states @ self.output + self.offset, states, trace, turned, trace_back

    def gradients(self, codes: np.ndarray, lengths: np.ndarray, truth: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy over all positions and its gradient by each weight."""
        scores, states, trace, turned, trace_back = self._run(codes, lengths)
        chances = _softmax(scores)
        real = (np.arange(codes.shape[0])[:, None] < lengths).astype(np.float32)
        rows = np.arange(len(truth))
        loss = -(np.log(chances[:, rows, truth] + 1e-9) * real).sum() / real.sum()
        error = chances
        error[:, rows, truth] -= 1
        error *= real[:, :, None] / real.sum()
        flat, units = error.reshape(-1, error.shape[2]), self.ahead.hidden.shape[0]
        to_states = error @ self.output.T
        ahead = self.ahead.backward(codes, trace, to_states[:, :, :units])
        back = self.back.backward(turned, trace_back, _turn(to_states[:, :, units:], lengths))
        return float(loss), [*ahead.weights(), *back.weights(),
                             states.reshape(-1, states.shape[2]).T @ flat, flat.sum(axis=0)]

    def weights(self) -> list[np.ndarray]:
        return [*self.ahead.weights(), *self.back.weights(), self.output, self.offset]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.tanh(x / 2) / 2 + 0.5


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _codes(words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte codes (time, rows), zero behind a word's end, and the words' lengths."""
    lengths = np.array([len(w) for w in words])
    longest = int(lengths.max())
    padded = b"".join(w.ljust(longest, b"\0") for w in words)
    return np.frombuffer(padded, np.uint8).reshape(len(words), longest).T, lengths


def _turn(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Reverse the first `lengths` steps of each row."""
    time = np.arange(x.shape[0])[:, None]
    source = np.where(time < lengths, lengths - 1 - time, time)
    return x[source, np.arange(x.shape[1])]


def new_model(languages: list[str], seed: int = 0, units: int = UNITS) -> Model:
    draw = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return draw.normal(0, scale, shape).astype(np.float32)

    def direction() -> Direction:
        return Direction(normal(256, 3 * units, scale=0.3), normal(units, 3 * units, scale=units ** -0.5),
                         np.zeros(3 * units, np.float32))

    return Model(languages, direction(), direction(), normal(2 * units, len(languages), scale=0.2),
                 np.zeros(len(languages), np.float32))


def train(samples: dict[str, list[bytes]], steps: int = STEPS, seed: int = 0) -> Model:
    """Fit a model to words by language; each step takes as many words of every language (Adam)."""
    languages = sorted(lang for lang, words in samples.items() if words)
    model, draw = new_model(languages, seed), np.random.default_rng(seed + 1)
    if len(languages) < 2:
        return model
    mean, spread = ([np.zeros_like(w) for w in model.weights()] for _ in range(2))
    each = -(-BATCH // len(languages))
    truth = np.repeat(np.arange(len(languages)), each)
    for step in range(1, steps + 1):
        words = [samples[lang][i] for lang in languages for i in draw.integers(0, len(samples[lang]), each)]
        _, slopes = model.gradients(*_codes(words), truth)
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for weight, slope, m, v in zip(model.weights(), slopes, mean, spread, strict=True):
            m += 0.1 * (slope - m)
            v += 0.001 * (slope * slope - v)
            weight -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return model


def cut_words(text: bytes) -> list[bytes]:
    """Words of a text; words over LONGEST bytes are cut between characters."""
    words = text.split()
    if max(map(len, words), default=0) <= LONGEST:
        return words
    out = []
    for word in words:
        while len(word) > LONGEST:
            end = LONGEST
            while end > LONGEST - 4 and word[end] & 0xC0 == 0x80:
                end -= 1
            out.append(word[:end])
            word = word[end:]
        out.append(word)
    return out


def blocks(text: bytes) -> Iterator[bytes]:
    """A text in pieces of about BLOCK bytes, cut at white space."""
    at = 0
    while at < len(text):
        found = _SPACE.search(text, at + BLOCK)
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end


class Labeller:
    """Pools the labels of all positions of a text; each distinct word is run through the network once."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.sums = np.zeros((0, len(self.model.languages)))
        self.sizes = np.zeros(0)
        self.letters = np.zeros(0, bool)

    def _learn(self, words: set[bytes]) -> None:
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self._forget()
            new = list(words)
        if new:
            self.known.update(zip(new, range(len(self.sizes), len(self.sizes) + len(new)), strict=True))
            self.sums = np.concatenate([self.sums, self.model.label(new)])
            self.sizes = np.concatenate([self.sizes, [len(w) for w in new]])
            self.letters = np.concatenate([self.letters, [any(map(str.isalpha, w.decode("utf-8", "replace")))
                                                          for w in new]])

    def label(self, texts: Sequence[bytes | None]) -> list[tuple[str, float]]:
        """Language and pooled probability of each text; `und` and 0 for texts without a letter."""
        pooled = np.zeros((len(texts), len(self.model.languages) + 2))
        held: list[tuple[int, list[bytes]]] = []
        waiting = 0

        def settle() -> None:
            self._learn(set().union(*(w for _, w in held)))
            for i, words in held:
                where = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
                pooled[i, :-2] += self.sums[where].sum(axis=0)
                pooled[i, -2] += self.sizes[where].sum()
                pooled[i, -1] += self.letters[where].any()
            held.clear()

        for i, text in enumerate(texts):
            for block in blocks(text or b""):
                words = cut_words(block)
                held.append((i, words))
                waiting += len(words)
                if waiting >= TOGETHER:
                    settle()
                    waiting = 0
        settle()
        chances = pooled[:, :-2] / np.maximum(pooled[:, -2:-1], 1)
        best = chances.argmax(axis=1) if chances.shape[1] else np.zeros(len(texts), int)
        return [(self.model.languages[b], round(float(c[b]), 6)) if letters and len(c) else (UNDECIDED, 0.0)
                for b, c, letters in zip(best, chances, pooled[:, -1] > 0, strict=True)]


def held_out(docs: DataFrame, id_col: str = "doc_id"):
    """Whether crc32 of the id as text leaves 2 when divided by 4; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   lang_col: str = "lang") -> dict[str, list[bytes]]:
    """A bounded sample of words by language from documents that aren't held out.

    Every label that occurs is learned. SAMPLE_DOCS documents are dealt over
    the labels in the order of a hash of their id, one for each where there are more
    labels; of each document up to SAMPLE_WORDS consecutive words from a place
    that the hash chooses are taken. Ties go to the smaller id; repeated rows
    may be drawn together. A table without labels gives an empty sample.
    """
    usable = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull()
                        & ~held_out(docs, id_col)).select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    each = max(1, SAMPLE_DOCS // max(1, usable.agg(F.count_distinct("lang")).first()[0]))
    draw = F.xxhash64("id")
    chosen = (usable.select("id", "lang")
              .withColumn("n", F.row_number().over(W.partitionBy("lang").orderBy(draw, "id"))).where(F.col("n") <= each))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # About SAMPLE_DOCS ids, so they go to the texts and not the other way round.
    taken = usable.join(F.broadcast(chosen.select("id", "lang")), ["id", "lang"], "left_semi").select("id", "lang", words.alias("w"))
    start = F.pmod(draw, F.greatest(F.size("w") - SAMPLE_WORDS, F.lit(0)) + 1).cast("int") + 1
    rows = taken.select("lang", "id", F.slice("w", start, SAMPLE_WORDS).alias("w")).collect()
    found: dict[str, list[bytes]] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["id"], r["w"])):
        found.setdefault(row["lang"], []).extend(w for x in row["w"] for w in cut_words(x.encode()))
    return found


def identify(docs: DataFrame, model: Model, text_col: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns `keep` of every row, with lang_pred and score.

    Every byte position of the whole text is labelled; words are the network's
    sequences. The score is the mean probability of the predicted language over
    all positions; ties go to the first language in code-point order. Null and
    empty texts and texts without a letter get `und` and 0. Only the text
    decides; kept columns called lang_pred or score are replaced. Repeated rows
    are labelled alike; an empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    keep = [c for c in keep if c not in ("lang_pred", "score")]
    apart = text_col not in keep or docs.schema[text_col].dataType != T.StringType()  # a text that is kept goes to Python once

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model)
        for whole in batches:
            for at in range(0, len(whole), 1024):
                batch = whole.slice(at, 1024)
                texts = batch.column(len(keep) if apart else keep.index(text_col))
                found = labeller.label(texts.cast(pa.binary()).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:len(keep)], pa.array([x for x, _ in found], pa.string()),
                     pa.array([x for _, x in found], pa.float64())], [*keep, "lang_pred", "score"])
        del labeller
        give_back()

    kinds = T.StructType([*(docs.schema[c] for c in keep), T.StructField("lang_pred", T.StringType()),
                          T.StructField("score", T.DoubleType())])
    return docs.select(*keep, *([F.col(text_col).cast("string").alias("_text")] if apart else [])).mapInArrow(labelled, kinds)


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Rows (id_col, held_out, lang_pred, score): train on documents that aren't held out, label all.

    Without labels every text is `und` with score 0. See `training_words` and
    `identify` for nulls, ties, repeated rows and empty tables; other columns
    are not read.
    """
    model = train(training_words(docs, id_col, text_col, lang_col))
    found = identify(docs, model, text_col, [id_col])
    return found.select(id_col, held_out(found, id_col).alias("held_out"), "lang_pred", "score")
