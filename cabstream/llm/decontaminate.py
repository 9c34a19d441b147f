"""Benchmark decontamination by latent semantic retrieval, verified by common subsequences and answers."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from cabstream.llm.common import discard, give_back, stored
from cabstream.session import ship_package

#: Items are matched in blocks of about so many words, so that what a task holds is bounded. A block's items are
#: searched in groups of about so many words, each with a latent space of its own that suits its few items.
BLOCK_WORDS, GROUP_WORDS = 50_000, 8_000
#: Words of a step: windows start at multiples of it. Words of a passage of the TF-IDF matrix.
STEP, PASSAGE = 8, 32
#: Dimensions of the latent space and of the random projection it is found with.
LATENT, SKETCH = 96, 112
#: Cosine of a candidate; share of an item's words, and of its answer's, in the common subsequence of a match.
COSINE, SHARE, ANSWER_SHARE = 0.4, 0.75, 0.6
#: Items with fewer words match only word for word.
SHORT = 8
#: Words of an item, beside those that a match may miss, that let a part of a document pass the gate.
HITS = 6
SEED = 3
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters, digits and underscores."""
    return _WORD.findall(text.lower()) if text else []


@dataclass
class Item:
    item_id: object
    words: list[str]
    answer: list[str]
    #: Words of the windows that the item is looked for in: itself, a quarter of insertions and a step's shift.
    window: int = 0
    masks: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        self.window = 16 * math.ceil((1.25 * len(self.words) + STEP) / 16)
        for i, w in enumerate(self.words):
            self.masks[w] = self.masks.get(w, 0) | 1 << i

    def least_common(self) -> int:
        """Words that a match has in common with the item."""
        return len(self.words) if len(self.words) < SHORT else math.ceil(SHARE * len(self.words))

    def match(self, window: Sequence[str]) -> int:
        """Length of the longest common subsequence if the window is a match, else 0."""
        if len(self.words) < SHORT:
            return len(self.words) if f" {' '.join(self.words)} " in f" {' '.join(window)} " else 0
        common = common_subsequence(self.masks, len(self.words), window)
        if common < self.least_common():
            return 0
        masks: dict[str, int] = {}
        for i, w in enumerate(self.answer):
            masks[w] = masks.get(w, 0) | 1 << i
        return common if common_subsequence(masks, len(self.answer), window) >= ANSWER_SHARE * len(self.answer) else 0


def common_subsequence(masks: dict[str, int], n: int, window: Sequence[str]) -> int:
    """Length of the longest common subsequence of n words, given as bits of their places, and a window."""
    full = (1 << n) - 1
    row = full
    for word in window:
        hit = row & masks.get(word, 0)
        if hit:
            row = (row + hit | row - hit) & full
    return n - row.bit_count()


@dataclass
class Vocabulary:
    """Words of a block of items and their weights."""

    terms: dict[str, int]
    idf: np.ndarray

    def codes(self, words: Sequence[str]) -> np.ndarray:
        """Number of each word; words outside the vocabulary share the number behind the last."""
        return np.fromiter(map(self.terms.get, words, repeat(len(self.terms))), np.int64, len(words))


def vocabulary(items: Sequence[Item], counts: dict[int, int], passages: int) -> Vocabulary:
    terms = {w: i for i, w in enumerate(sorted({w for it in items for w in it.words}))}
    idf = np.array([math.log((passages + 1) / (counts.get(i, 0) + 1)) + 0.05 for i in range(len(terms))] + [0.0])
    return Vocabulary(terms, idf)


class Gate:
    """Tells the parts of a document in which an item can match at all; nothing else is searched.

    A match misses a known number of an item's words at most. Of that many
    words and HITS more it has HITS, whichever they are; the gate takes those
    found in the fewest items. A part is kept if that many of them lie within
    the width of the item's window. Each group of items has parts of its own.
    """

    def __init__(self, groups: Sequence[Sequence[Item]], terms: dict[str, int]):
        items = [it for group in groups for it in group]
        uses = Counter(w for it in items for w in set(it.words))
        pairs, need, width = [], [], []
        for number, it in enumerate(items):
            missed = len(it.words) - it.least_common()
            chosen = sorted(it.words, key=lambda w: (uses[w], -len(w), w))[:missed + HITS]
            need.append(len(chosen) - missed)
            width.append(it.window)
            pairs += [(terms[w], number) for w in set(chosen)]
        pairs.sort()
        self.need, self.width = np.array(need), np.array(width)
        self.group = np.repeat(np.arange(len(groups)), [len(group) for group in groups])
        self.items = np.array([i for _, i in pairs], np.int64)
        self.first = np.searchsorted([t for t, _ in pairs], np.arange(len(terms) + 2))

    def spans(self, codes: np.ndarray) -> list[tuple[int, int, int]]:
        """(group, start, end) of word ranges that cover every window in which an item of the group can match."""
        first, count = self.first[codes], self.first[codes + 1] - self.first[codes]
        place = np.flatnonzero(count)
        if not len(place):
            return []
        many = count[place]
        where = np.repeat(place, many)
        inner = np.arange(len(where)) - np.repeat(np.cumsum(many) - many, many)
        item = self.items[np.repeat(first[place], many) + inner]
        order = np.lexsort((where, item))
        item, where = item[order], where[order]
        last = np.arange(len(item)) + self.need[item] - 1
        full = last < len(item)
        last = np.minimum(last, len(item) - 1)
        met = full & (item[last] == item) & (where[last] - where < self.width[item])
        starts = np.maximum(where[met] - self.width[item[met]], 0)
        ends = np.minimum(where[last[met]] + self.width[item[met]], len(codes))
        merged: list[list[int]] = []
        for g, a, b in sorted(zip(self.group[item[met]].tolist(), starts.tolist(), ends.tolist(), strict=True)):
            if merged and g == merged[-1][0] and a <= merged[-1][2]:
                merged[-1][2] = max(b, merged[-1][2])
            else:
                merged.append([g, a, b])
        return [(g, a, b) for g, a, b in merged]


def _scan(docs: DataFrame, id_col: str, text_col: str, terms: dict[str, int], gate: Gate) -> DataFrame:
    """One pass over all documents: rows (id, words, group) of parts to search, and rows (term, n) of passage counts.

    The counts say in how many passages of a task's documents each term is
    found; at term -1 stands the number of passages. They have no words.
    """
    kinds = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("words", T.StringType()),
                          *(T.StructField(n, T.LongType()) for n in ("group", "term", "n"))])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("_text"))
    names = ["id", "words", "group", "term", "n"]

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, size, kind_of_id = Vocabulary(terms, np.zeros(0)), len(terms), None
        counts, passages = np.zeros(size, np.int64), 0
        for batch in batches:
            owner, texts, groups, kind_of_id = [], [], [], batch.schema.field(0).type
            for i, text in enumerate(batch.column(1)):
                words = words_of(text.as_py())
                codes = vocab.codes(words)
                known = np.flatnonzero(codes < size)
                marks = np.unique(known // PASSAGE * size + codes[known])
                counts += np.bincount(marks % size, minlength=size)
                passages += -(-len(codes) // PASSAGE)
                for g, a, b in gate.spans(codes):
                    owner.append(i)
                    groups.append(g)
                    texts.append(" ".join(words[a:b]))
            none = pa.nulls(len(owner), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner, pa.int64())),
                                              pa.array(texts, pa.string()), pa.array(groups, pa.int64()), none, none],
                                             names)
        if kind_of_id is not None:
            found = np.flatnonzero(counts)
            term = pa.array(np.append(found, -1))
            yield pa.RecordBatch.from_arrays([pa.nulls(len(term), kind_of_id), pa.nulls(len(term), pa.string()),
                                              pa.nulls(len(term), pa.int64()), term,
                                              pa.array(np.append(counts[found], passages))], names)
        give_back()

    return rows.mapInArrow(scanned, kinds)


def _sums(rows: np.ndarray, where: np.ndarray, n: int) -> np.ndarray:
    """Sum rows by group number."""
    out = np.zeros((n, rows.shape[1]))
    if len(where):
        order = np.argsort(where, kind="stable")
        first = np.nonzero(np.diff(where[order], prepend=-1))[0]
        out[where[order][first]] = np.add.reduceat(rows[order], first, axis=0)
    return out


def _product(codes: np.ndarray, passage: np.ndarray, idf: np.ndarray, omega: np.ndarray) -> np.ndarray:
    """A'A omega for the TF-IDF matrix A of passages, given as the codes of their words."""
    weights = idf[codes][:, None]
    known = codes < len(omega)
    codes, passage, weights = codes[known], passage[known], weights[known]
    if not len(codes):
        return np.zeros_like(omega)
    seen = _sums(weights * omega[codes], passage, int(passage.max()) + 1)
    return _sums(weights * seen[passage], codes, len(omega))


def latent_space(spans: DataFrame, vocab: Vocabulary, items: Sequence[Item]) -> np.ndarray:
    """Right singular vectors (terms, LATENT) of the TF-IDF passages of spans and items, by a randomised SVD.

    Each task multiplies its passages with a random matrix and sums the
    product by term; the sums meet in one shuffle. The Nystroem form of the
    method needs no second pass. Items weigh as much as all passages.
    """
    terms = len(vocab.terms)
    wide = min(SKETCH, terms)
    omega = np.random.default_rng(SEED).standard_normal((terms, wide))
    names = [f"y{j}" for j in range(wide)]

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((terms, wide)), 0
        for batch in batches:
            for at in range(0, len(batch), 256):
                codes = [vocab.codes(t.as_py().split()) for t in batch.column(0).slice(at, 256)]
                place, before = [], 0
                for c in codes:
                    place.append(before + np.arange(len(c)) // PASSAGE)
                    before += -(-len(c) // PASSAGE)
                total += _product(np.concatenate(codes), np.concatenate(place), vocab.idf, omega)
                rows += before
        found = np.nonzero(total.any(axis=1))[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(found, -1)), *(pa.array(np.append(total[found, j], rows)) for j in range(wide))],
            ["term", *names])

    kinds = ", ".join(f"{n} double" for n in names)
    sums = spans.select("words").mapInArrow(multiplied, f"term long, {kinds}").groupBy("term").agg(
        *[F.sum(n).alias(n) for n in names]).toArrow()
    product, passages, found = np.zeros((terms, wide)), 1.0, np.array(sums["term"])
    if len(found):
        values = np.stack([np.array(sums[n]) for n in names], axis=1)
        passages = max(1.0, values[found == -1].max(initial=1.0))
        product[found[found >= 0]] = values[found >= 0]
    codes = [vocab.codes(it.words) for it in items]
    own = _product(np.concatenate(codes), np.repeat(np.arange(len(codes)), [len(c) for c in codes]), vocab.idf, omega)
    product += own * (passages / len(items))
    core = omega.T @ product
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > max(values.max(), 1e-12) * 1e-10
    root = product @ (vectors[:, good] / np.sqrt(values[good]))
    left, _, _ = np.linalg.svd(root, full_matrices=False)
    return left[:, :LATENT].astype(np.float32)


class Searcher:
    """Cosine search of windows in the latent space, then the exact checks.

    Windows that hold an item word for word are checked whatever their cosine.
    """

    def __init__(self, items: Sequence[Item], vocab: Vocabulary, space: np.ndarray):
        self.vocab = vocab
        self.table = np.concatenate([space * vocab.idf[:-1, None], np.zeros((1, space.shape[1]))]).astype(np.float32)
        self.by_size: dict[int, tuple[list[Item], np.ndarray]] = {}
        for size in {it.window for it in items}:
            own = [it for it in items if it.window == size]
            vectors = np.stack([self.table[vocab.codes(it.words)].sum(axis=0) for it in own])
            self.by_size[size] = own, _unit(vectors)
        #: By an item's rarest word: its window, its number among those of that window, the word's place, its words.
        self.rare: dict[str, list[tuple[int, int, int, list[str]]]] = {}
        for size, (own, _) in self.by_size.items():
            for i, it in enumerate(own):
                at = int(np.argmax(vocab.idf[vocab.codes(it.words)]))
                self.rare.setdefault(it.words[at], []).append((size, i, at, it.words))

    def copies(self, words: list[str]) -> dict[int, list[tuple[int, int]]]:
        """By window size: (item's number, place) wherever an item stands word for word."""
        found: dict[int, list[tuple[int, int]]] = {}
        for place, word in enumerate(words):
            for size, i, at, own in self.rare.get(word, ()):
                if place >= at and words[place - at:place - at + len(own)] == own:
                    found.setdefault(size, []).append((i, place - at))
        return found

    def search(self, words: list[str]) -> list[tuple[object, int, int, float, int]]:
        """(item, start, common words, cosine, item's words) of the best window for each item matched."""
        steps = self.table[self.vocab.codes(words)]
        cuts = np.arange(0, len(words), STEP)
        sums = np.concatenate([np.zeros((1, steps.shape[1]), np.float32),
                               np.cumsum(np.add.reduceat(steps, cuts, axis=0), axis=0, dtype=np.float32)])
        best: dict[object, tuple] = {}
        copies = self.copies(words)
        for size, (items, vectors) in self.by_size.items():
            starts = np.arange(max(1, len(cuts) - size // STEP + 1))
            ends = np.minimum(starts + size // STEP, len(cuts))
            near = _unit(sums[ends] - sums[starts]) @ vectors.T
            asked = near >= COSINE
            for i, place in copies.get(size, ()):
                asked[max(0, -(-(place + len(items[i].words) - size) // STEP)):place // STEP + 1, i] = True
            for s, i in zip(*np.nonzero(asked), strict=True):
                start = int(s) * STEP
                item = items[i]
                common = item.match(words[start:start + size])
                found = (item.item_id, start, common, float(near[s, i]), len(item.words))
                if common and found[2:4] > best.get(item.item_id, (0, 0, 0, 0.0))[2:4]:
                    best[item.item_id] = found
        return list(best.values())


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-9)


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[Item]]:
    """Blocks of items with words; the number of blocks follows the size of the benchmark."""
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    rows = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).cast("string").alias("text"),
                            answer.alias("answer"))
    size = F.size(F.split("text", r"\s+"))
    blocks = math.ceil((rows.agg(F.sum(size)).first()[0] or 0) / BLOCK_WORDS)
    for i in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == i).collect()
        made = [(r["item"], words_of(r["text"]), words_of(r["answer"])) for r in part]
        block = [Item(item, words, answer) for item, words, answer in made if words]
        if block:
            yield sorted(block, key=lambda it: (str(it.item_id), it.words))


def _groups(items: list[Item]) -> list[list[Item]]:
    """Items in groups of equal numbers, of about GROUP_WORDS words."""
    count = min(len(items), math.ceil(sum(len(it.words) for it in items) / GROUP_WORDS))
    return [items[i::count] for i in range(count)]


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Rows (id_col, item_col, common_words, item_words, cosine): which items a document holds.

    A window of a document holds an item if its cosine in the latent space is
    at least COSINE or the item stands in it word for word, the longest common
    subsequence has SHARE of the item's words, and that with the answer (a column
    `answer`) ANSWER_SHARE of the answer's. Items without an answer are decided by SHARE alone.
    Items of fewer than SHORT words must stand word for word. Case and
    punctuation don't count. Null and empty texts and items match nothing;
    null ids are kept as null; repeated rows of an id are one. One row per
    document and item, that of the best window (ties: the higher cosine). Every
    document is read whole. Other columns are not read; empty tables give no rows.
    """
    ship_package(docs.sparkSession)
    own_id, item_id = docs.schema[id_col].dataType, benchmark.schema[item_col].dataType
    rest = [("common", T.IntegerType()), ("n", T.IntegerType()), ("cosine", T.DoubleType())]
    kinds = T.StructType([T.StructField(n, t) for n, t in [("id", own_id), ("item", item_id), *rest]])
    parts = []
    for items in _items(benchmark, item_col, item_text_col):
        terms = vocabulary(items, {}, 0).terms
        groups = _groups(items)
        scan = stored(_scan(docs, id_col, text_col, terms, Gate(groups, terms)), "decontamination-scan")
        sums = scan.where("words is null").groupBy("term").agg(F.sum("n").alias("n")).collect()
        counts = {r["term"]: r["n"] for r in sums}
        for number, group in enumerate(groups):
            spans = scan.where((F.col("group") == number) & F.col("words").isNotNull())
            own = {i: counts.get(terms[w], 0) for w, i in vocabulary(group, {}, 0).terms.items()}
            vocab = vocabulary(group, own, counts.get(-1, 0))
            searcher = Searcher(group, vocab, latent_space(spans, vocab, group))
            parts.append(stored(_matches(spans, searcher, kinds), "benchmark-matches"))
        discard(scan)
    if not parts:
        names = [id_col, item_col, "common_words", "item_words", "cosine"]
        empty = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, kinds, strict=True)])
        return docs.sparkSession.createDataFrame([], empty)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    best = found.groupBy("id", "item").agg(F.max(F.struct("common", "n", "cosine")).alias("best"))
    return best.select(F.col("id").alias(id_col), F.col("item").alias(item_col),
                       F.col("best.common").alias("common_words"), F.col("best.n").alias("item_words"),
                       F.round("best.cosine", 3).alias("cosine"))


def _matches(spans: DataFrame, searcher: Searcher, kinds: T.StructType) -> DataFrame:
    item_type = to_arrow_type(kinds["item"].dataType)

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, *found) for i, text in enumerate(batch.column(1)) for found in searcher.search(text.as_py().split())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array([r[0] for r in rows], pa.int64())),
                 pa.array([r[1] for r in rows], item_type), pa.array([r[3] for r in rows], pa.int32()),
                 pa.array([r[5] for r in rows], pa.int32()), pa.array([r[4] for r in rows], pa.float64())],
                ["id", "item", "common", "n", "cosine"])
        give_back()

    return spans.select("id", "words").mapInArrow(searched, kinds)
