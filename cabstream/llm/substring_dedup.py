"""Substring de-duplication: word windows that start earlier in the corpus are removed.

Documents are too many to stream past an automaton of all of them. So each
window chooses an anchor, the smallest hash of the short word sequences in it;
equal windows choose equal anchors. The windows of a document with one anchor
are consecutive and make a unit. Units whose anchor is found once can't repeat
and go no further; units with the same words are told by their hash. What is
left, units that share an anchor but not all words, is dealt to shards by
anchor. A shard is a bounded reference text: its suffix automaton grows with
the units in order, and the matching statistics of each unit against all before
it say which of its windows are repeats.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabstream.llm.common import discard, release, stored
from cabstream.session import ship_package

SEED = 42
#: Words of the sequence that anchors a window.
GRAM = 8
#: Words of a shard's text, about; units of an anchor beyond which they are compared window by window.
SHARD_WORDS, HOT = 100_000, 256
#: Hashes of words that a worker remembers.
REMEMBERED = 1 << 18
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
ROW = ["id", "t"]


class WordHashes:
    """XXH64 of words, each distinct word hashed once."""

    def __init__(self):
        self._known: dict[bytes, int] = {}

    def __call__(self, words: Sequence[bytes]) -> np.ndarray:
        import xxhash

        known, digest = self._known, xxhash.xxh64_intdigest
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            if len(known) > REMEMBERED:
                known.clear()
            known.update((w, digest(w, SEED)) for w in set(words) if w not in known)
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))
    return tuple(np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, base)])) for base in (_ODD, inverse))


def range_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each range of words that doesn't depend on its place."""
    up, down = _powers(len(words))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(words * up[:-1], dtype=np.uint64)])
    return _mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def units(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows, anchor and content hash of each unit of a document's word hashes."""
    gram = min(GRAM, window)
    windows = len(hashes) - window + 1
    if windows < 1:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    grams = np.zeros(len(hashes) - gram + 1, np.uint64)
    for j in range(gram):
        grams += hashes[j:len(hashes) - gram + 1 + j] * np.uint64(pow(int(_ODD), j + 1, 1 << 64))
    grams = _mixed(grams)
    width = window - gram + 1
    place = np.lib.stride_tricks.sliding_window_view(grams, width).argmin(axis=1) + np.arange(windows)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    count = np.diff(first, append=windows)
    return first, count, grams[place[first]], range_hashes(hashes, first, first + count + window - 1)


class Automaton:
    """Suffix automaton that grows word by word over several texts."""

    def __init__(self):
        self.length, self.link, self.step = [0], [-1], [{}]
        self.last = 0

    def begin(self) -> None:
        """Start another text."""
        self.last = 0

    def add(self, word: int) -> int:
        """Append a word; the length of the longest end of the text so far that was there before."""
        length, link, step = self.length, self.link, self.step
        at = self.last
        known = step[at].get(word)
        if known is not None:
            if length[known] != length[at] + 1:
                known = self._split(at, word, known)
            self.last = known
            return length[known]
        new = len(length)
        length.append(length[at] + 1)
        step.append({})
        link.append(0)
        self.last = new
        while at >= 0 and word not in step[at]:
            step[at][word] = new
            at = link[at]
        if at >= 0:
            known = step[at][word]
            link[new] = known if length[known] == length[at] + 1 else self._split(at, word, known)
        return length[link[new]]

    def _split(self, at: int, word: int, state: int) -> int:
        """Part the words that `state` stands for at the length reached from `at`."""
        length, link, step = self.length, self.link, self.step
        part = len(length)
        length.append(length[at] + 1)
        step.append(dict(step[state]))
        link.append(link[state])
        link[state] = part
        while at >= 0 and step[at].get(word) == state:
            step[at][word] = part
            at = link[at]
        return part


def repeated_windows(texts: Sequence[Sequence[str]], window: int) -> list[int]:
    """For each text, in order, the windows found before it or earlier in it; bit i is the window from word i."""
    automaton, codes, masks = Automaton(), {}, []
    for words in texts:
        automaton.begin()
        mask = 0
        for i, word in enumerate(words):
            if automaton.add(codes.setdefault(word, len(codes))) >= window:
                mask |= 1 << (i - window + 1)
        masks.append(mask)
    return masks


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (id, t, text): a document is told by its id and a hash of its text."""
    text = F.col(text_col).cast("binary")
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("t"), text.alias("text"))


def _units(rows: DataFrame, window: int) -> DataFrame:
    kind = rows.schema["id"].dataType.simpleString()

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for whole in batches:
            for at in range(0, len(whole), 512):
                batch = whole.slice(at, 512)
                parts = [units(hashes((t.as_py() or b"").split()), window) for t in batch.column(2)]
                owner = pa.array(np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts]))
                first, count, anchor, content = (np.concatenate(c) for c in zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(owner), batch.column(1).take(owner), pa.array(first.astype(np.int32)),
                     pa.array(count.astype(np.int32)), pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64))],
                    ["id", "t", "lo", "n", "anchor", "u"])

    return rows.mapInArrow(found, f"id {kind}, t long, lo int, n int, anchor long, u long")


def _with_words(rows: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """The words of units: `wanted` (id, t, lo, n, anchor, u, hot) with `words` and the windows' hashes if hot."""
    per_row = wanted.groupBy(*ROW).agg(F.collect_list(F.struct("lo", "n", "anchor", "u", "hot")).alias("parts"))
    kind = rows.schema["id"].dataType.simpleString()
    # Repeated rows have the same units; one of them is enough.
    joined = _join_rows(rows, per_row, "inner")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for whole in batches:
            for at in range(0, len(whole), 256):
                batch = whole.slice(at, 256)
                owner, parts, texts, windows = [], [], [], []
                for i, (text, own) in enumerate(zip(batch.column(2), batch.column(3).to_pylist(), strict=True)):
                    words = text.as_py().split()
                    numbers = hashes(words) if any(p["hot"] for p in own) else None
                    for p in own:
                        lo, end = p["lo"], p["lo"] + p["n"] + window - 1
                        owner.append(i)
                        parts.append(p)
                        texts.append(b" ".join(words[lo:end]))
                        if p["hot"]:
                            starts = np.arange(p["n"])
                            part = numbers[lo:end]
                            pair = [range_hashes(h, starts, starts + window) for h in (part, _mixed(part))]
                            windows.append(np.stack(pair, axis=1).view(np.int64).tolist())
                        else:
                            windows.append([])
                where = pa.array(owner, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(where), batch.column(1).take(where),
                     *(pa.array([p[c] for p in parts], k) for c, k in (("lo", pa.int32()), ("n", pa.int32()),
                                                                        ("anchor", pa.int64()), ("u", pa.int64()),
                                                                        ("hot", pa.bool_()))),
                     pa.array(texts, pa.binary()), pa.array(windows, pa.list_(pa.list_(pa.int64())))],
                    ["id", "t", "lo", "n", "anchor", "u", "hot", "words", "windows"])

    return joined.mapInArrow(cut, f"id {kind}, t long, lo int, n int, anchor long, u long, hot boolean, words binary, "
                             "windows array<array<long>>").dropDuplicates(["anchor", "u"])


def _join_rows(rows: DataFrame, other: DataFrame, how: str) -> DataFrame:
    """Join on (id, t); null ids meet null ids."""
    other = other.select(F.col("id").alias("_id"), F.col("t").alias("_t"), *[c for c in other.columns if c not in ROW])
    same = rows["id"].eqNullSafe(other["_id"]) & (rows["t"] == other["_t"])
    return rows.join(other, same, how).drop("_id", "_t")


def _by_automaton(cold: DataFrame, shards: int, window: int) -> DataFrame:
    """Rows (anchor, u, mask) from one suffix automaton per shard."""

    def shard(table: pa.Table) -> pa.Table:
        keys = [(c, "ascending") for c in ("id", "t", "lo")]
        table = table.take(pc.sort_indices(table, sort_keys=keys, null_placement="at_start"))
        masks = repeated_windows([w.split() for w in table["words"].to_pylist()], window)
        return pa.table({"anchor": table["anchor"], "u": table["u"], "mask": pa.array(masks, pa.int64())})

    dealt = cold.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(shard, "anchor long, u long, mask long")


def _by_window(hot: DataFrame) -> DataFrame:
    """Rows (anchor, u, mask) from the windows' hashes: all but the first of equal windows are repeats."""
    single = hot.select("id", "t", "lo", "anchor", "u", F.posexplode("windows").alias("at", "w")).select(
        "anchor", "u", "at", F.col("w")[0].alias("w1"), F.col("w")[1].alias("w2"),
        F.struct("id", "t", (F.col("lo") + F.col("at")).alias("start")).alias("place"))
    # Stored, so that Spark can split the places of a common window.
    first = stored(single.groupBy("w1", "w2").agg(F.min("place").alias("first")), "first-windows")
    bit = F.when(F.col("place") == F.col("first"), 0).otherwise(F.expr("shiftleft(1L, at)"))
    return single.join(first, ["w1", "w2"]).groupBy("anchor", "u").agg(F.bit_or(bit).alias("mask"))


def repeats(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, t, parts): for each document with repeated windows, structs of a first window `lo` and a `mask`.

    Bit i of the mask says that the window from word lo + i also starts earlier:
    in a document with a smaller id (null is smallest; of equal ids the smaller
    text hash), or before in the same one. Windows of up to 63 words.
    """
    if not 1 < window < 64:
        raise ValueError("a window has 2 to 63 words")
    ship_package(docs.sparkSession)
    rows = _keyed(docs, id_col, text_col)
    # Equal rows are one document.
    found = stored(_units(rows, window), "units")
    # Stored, so that both sides of the join are shuffled for it and a hot anchor's partition can be split.
    uses = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("uses"))
    shared = stored(uses.where("uses > 1").select("anchor"), "shared-anchors")
    hits = stored(found.join(shared, "anchor").distinct(), "shared-units")
    discard(found, shared)
    release(docs.sparkSession)
    firsts = hits.groupBy("anchor", "u").agg(F.min(F.struct("id", "t", "lo", "n")).alias("first"))
    firsts = stored(firsts, "first-units")
    several = firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("contents")).where("contents > 1")
    wanted = firsts.join(several, "anchor").select("first.*", "anchor", "u", (F.col("contents") > HOT).alias("hot"))
    texts = stored(_with_words(rows, wanted, window), "unit-words")
    words = texts.where("not hot").agg(F.sum(F.col("n") + window)).first()[0] or 0
    masks = _by_automaton(texts.where("not hot"), int(words // SHARD_WORDS) + 1, window).unionAll(
        _by_window(texts.where("hot")))
    masks = stored(masks.where("mask != 0"), "repeat-masks")
    discard(texts)
    release(docs.sparkSession)
    marked = firsts.join(masks, ["anchor", "u"], "left")
    here = F.struct("id", "t", "lo", "n")
    mask = F.when(here == F.col("first"), F.coalesce("mask", F.lit(0))).otherwise(F.expr("shiftleft(1L, n) - 1"))
    return (hits.join(marked, ["anchor", "u"]).select("id", "t", F.struct("lo", mask.alias("mask")).alias("part"))
            .where("part.mask != 0").groupBy(*ROW).agg(F.collect_list("part").alias("parts")))


def kept_words(words: list[bytes], parts: Sequence[dict], window: int) -> list[bytes]:
    """The words that no repeated window covers."""
    cover = np.zeros(len(words) + 1, np.int64)
    for part in parts:
        mask, start = part["mask"], part["lo"]
        while mask:
            low = (mask & -mask).bit_length() - 1
            run = (~(mask >> low) & ((mask >> low) + 1)).bit_length() - 1
            cover[start + low] += 1
            cover[start + low + run - 1 + window] -= 1
            mask &= ~(((1 << run) - 1) << low)
    keep = np.cumsum(cover[:-1]) == 0
    return [w for w, k in zip(words, keep.tolist(), strict=True) if k]


def remove_repeats(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id_col, kept_text, n_words, n_removed), one per row of `docs`.

    Words are runs of bytes other than ASCII white space, unchanged; a null or
    empty text has none. Every word covered by a window whose words also start
    earlier is removed; windows are judged on the input. The kept words are
    joined by one space. Documents of fewer words than a window stay whole.
    Rows equal in id and text are one document and get the same result each.
    Columns other than the two named are not read; an empty table gives no rows.
    """
    rows = _keyed(docs, id_col, text_col)
    joined = _join_rows(rows, stored(repeats(docs, window, id_col, text_col), "repeats"), "left")
    kind = rows.schema["id"].dataType.simpleString()

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 512):
                batch = whole.slice(at, 512)
                texts, before, gone = [], [], []
                for text, parts in zip(batch.column(2), batch.column(3).to_pylist(), strict=True):
                    words = (text.as_py() or b"").split()
                    kept = kept_words(words, parts, window) if parts else words
                    texts.append(b" ".join(kept))
                    before.append(len(words))
                    gone.append(len(words) - len(kept))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(before, pa.int64()),
                     pa.array(gone, pa.int64())], [id_col, "kept_text", "n_words", "n_removed"])

    return joined.mapInArrow(cleaned, f"`{id_col}` {kind}, kept_text string, n_words long, n_removed long")
