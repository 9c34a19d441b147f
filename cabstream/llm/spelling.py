"""Spelling variants: words one code point apart, found by walking a trie's edge table level by level."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabstream.llm.common import discard, stored
from cabstream.session import ship_package

LETTERS = "A-Za-zÀ-ÿ"
#: Distinct words that a worker counts before it passes them on, and code points above which a text is read run by run.
HELD, LONG_TEXT = 1 << 17, 1 << 20
#: Code points of the longest word that is walked through the trie: each is a level, and a level is a job.
DEPTH = 48
#: The rolling hash of longer words: a prime and two bases.
PRIME, BASES = (1 << 61) - 1, (1_000_003, 998_244_353)
DELETE, REPLACE = 0, 1


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 7,
                min_count: int = 2, garble: int = 31) -> DataFrame:
    """Rows (word, n): words of at least `min_chars` code points that occur at least `min_count` times.

    Words are whole runs of LETTERS with A-Z lower-cased. A run loses the code
    point h % length if `garble` divides h, the CRC-32 of `<id>:<run>` (0: none
    does); a null id counts as empty. Null texts have no words. Rows count each,
    repeated ones too. Other columns are not read.
    """
    ship_package(docs.sparkSession)
    run_of = re.compile(f"[{LETTERS}]{{{min_chars},}}")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Counter[str] = Counter()

        def passed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(known), pa.string()), pa.array(list(known.values()), pa.int64())],
                                             names=["word", "n"])
            known.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                body = text.lower().decode("utf-8", "replace")  # of bytes: A-Z only
                runs = Counter(run_of.findall(body) if len(body) < LONG_TEXT else (m.group() for m in run_of.finditer(body)))
                start = zlib.crc32(f"{doc}:".encode())
                for run, n in runs.items():
                    h = zlib.crc32(run.encode(), start) if garble else 1
                    if garble and h % garble == 0:
                        run = run[:h % len(run)] + run[h % len(run) + 1:]
                        if len(run) < min_chars:
                            continue
                    known[run] += n
                if len(known) > HELD:
                    yield passed()
        yield passed()

    texts = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                        F.col(text_col).cast("binary").alias("text")).where("text is not null")
    found = texts.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") >= min_count)


def _matched(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Join by shuffles, never by a broadcast.

    Spark sizes a stored table by its compressed files and what it explodes into as no more rows, so
    that a few MB on disk may be millions of rows, all of which a broadcast gathers in the driver.
    """
    return left.join(right.hint("merge"), on, how)


def spelled(words: DataFrame) -> DataFrame:
    """Each word forward and backward: (word, n, len, way, s, start).

    A word and its near word agree on the word's first half or on the rest. So
    an edit in the second half is looked for in the trie of the words, one in
    the first half in that of the reversed words, from position `start` on, where tries are
    thin. Words of different lengths are in tries of their own.
    """
    size, half = F.length("word"), F.floor(F.length("word") / 2).cast("int")
    ways = F.array(F.struct(F.lit(0).alias("way"), F.col("word").alias("s"), half.alias("start")),
                   F.struct(F.lit(1).alias("way"), F.reverse("word").alias("s"), (size - half).alias("start")))
    return words.select("word", "n", size.alias("len"), F.inline(ways))


def _edge(way: Column, size: Column, prefix: Column) -> Column:
    return F.xxhash64(F.lit(0), way, size, prefix)


def _skip(way: Column, size: Column, prefix: Column, following: Column) -> Column:
    return F.xxhash64(F.lit(1), way, size, prefix, following)


def trie_nodes(words: DataFrame) -> DataFrame:
    """The tries' nodes below the starts: (way, len, depth, below, low, high).

    `low` and `high` are the first and last (word, n) below a node, of which
    `low` spells its prefix; `high` is null if there is one word only. `below`
    is their number, 3 for more than two.
    """
    one = F.struct("word", "n")
    prefixes = spelled(words).select("way", "len", one.alias("one"), "s", F.explode(
        F.sequence(F.col("start") + 1, F.col("len"))).alias("depth"))
    nodes = prefixes.groupBy("way", "len", "depth", F.expr("substring(s, 1, depth)").alias("node")).agg(
        F.count(F.lit(1)).alias("n"), F.min("one").alias("low"), F.max("one").alias("high"))
    return nodes.select("way", "len", "depth", F.least("n", F.lit(3)).cast("int").alias("below"), "low",
                        F.when(F.col("n") > 1, F.col("high")).alias("high"))


def edge_table(nodes: DataFrame) -> DataFrame:
    """The tries' edges, one row per key and node: (key, to, low, high); `to` packs the op, `below` and the depth.

    An edge (op DELETE: reached by the next letter) has the key of its lower
    node; a pair of edges (op REPLACE) has that of the node above both and of the second letter, any
    letter standing between; the key of a last edge has no second letter.
    """
    way, size, depth, node = F.col("way"), F.col("len"), F.col("depth"), F.expr("substring(s, 1, depth)")
    half = F.floor(size / 2).cast("int")
    inside = depth >= F.when(way == 0, half).otherwise(size - half) + 2
    keys = F.array(
        F.struct(_edge(way, size, node).alias("key"), F.lit(DELETE).alias("op")),
        F.struct(F.when(inside, _skip(way, size, F.expr("substring(s, 1, depth - 2)"), F.expr("substring(s, depth, 1)")))
                 .alias("key"), F.lit(REPLACE).alias("op")),
        F.struct(F.when(depth == size, _skip(way, size, F.expr("substring(s, 1, depth - 1)"), F.lit(""))).alias("key"),
                 F.lit(REPLACE).alias("op")))
    rows = nodes.withColumn("s", _spelled("low.word")).select(F.inline(keys), "depth", "below", "low", "high")
    to = F.col("depth") * 8 + F.col("below") * 2 + F.col("op")
    return rows.where("key is not null").select("key", to.alias("to"), "low", "high")


def _first_states(words: DataFrame) -> DataFrame:
    """States after one edit: (word, n, edit, key); `edit` packs the op, the way and the edited position of the spelled word.

    An unedited word is at its own prefixes, so these states need no join. Of a
    run of equal letters only the last can be deleted (in reading order), as any gives the same word.
    """
    at, s, size, way = F.col("at"), F.col("s"), F.col("len"), F.col("way")
    own, following = F.expr("substring(s, 1, at)"), F.expr("substring(s, at + 2, 1)")
    repeats = F.when(way == 0, following == F.expr("substring(s, at + 1, 1)")).otherwise(
        F.expr("substring(s, at, 1) = substring(s, at + 1, 1)"))
    states = F.array(
        F.struct(F.lit(DELETE).alias("op"), F.when(~repeats, _edge(way, size - 1, F.concat(own, following))).alias("key")),
        F.struct(F.lit(REPLACE).alias("op"), _skip(way, size, own, following).alias("key")))
    positions = spelled(words).select("*", F.explode(F.sequence(F.col("start"), F.col("len") - 1)).alias("at"))
    rows = positions.select("word", "n", "way", "at", F.inline(states)).where("key is not null")
    return rows.select("word", "n", (at * 4 + way * 2 + F.col("op")).alias("edit"), "key")


def _unpacked(states: DataFrame) -> DataFrame:
    """States that have met a node: (word, n, way, at, op, depth, below, low, high)."""
    edit, to = F.col("edit"), F.col("to")
    return states.select(
        "word", "n", F.shiftright(edit, 1).bitwiseAND(F.lit(1)).alias("way"), F.shiftright(edit, 2).alias("at"),
        edit.bitwiseAND(F.lit(1)).alias("op"), F.shiftright(to, 3).alias("depth"),
        F.shiftright(to, 1).bitwiseAND(F.lit(3)).alias("below"), "low", "high")


def _spelled(word: str) -> Column:
    return F.when(F.col("way") == 0, F.col(word)).otherwise(F.reverse(word))


def _arrived(states: DataFrame) -> DataFrame:
    """Near words of states whose node has one or two words below: (word, n, near, near_n)."""
    ends = F.array_compact(F.array("low", "high"))
    found = states.where("below <= 2").select("word", "n", "way", "at", "op", F.inline(ends).alias("near", "near_n"))
    rest = "substring(w, 1, at) = substring(v, 1, at) and substring(w, at + 2) = substring(v, at + {})"
    true = F.when(F.col("op") == DELETE, F.expr(rest.format(1))).otherwise(
        F.expr(f"{rest.format(2)} and substring(w, at + 1, 1) < substring(v, at + 1, 1)"))
    return found.withColumns({"w": _spelled("word"), "v": _spelled("near")}).where(true).select(
        "word", "n", "near", "near_n")


def near_words(words: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Rows (word, n, near, near_n): every pair of words one code point apart, in both orders, each once.

    `words` has distinct `word` and `n`. States (word, position, node, edits)
    walk the tries' edge table: from an edit on, a state follows its word's
    letters with one join a level, and ends where no edge has the letter or at
    most two words are left below its node, which are then compared. A replaced
    letter and the one behind it are one step; insertions are deletions seen
    from the other word. Words longer than `depth` would need a job for each
    letter; they meet by hashes of what is left without a letter (`long_pairs`), as exactly.
    """
    short = words.where(F.length("word") <= depth)
    nodes = stored(trie_nodes(short), "trie-nodes")
    edges = edge_table(nodes)
    links = edges.where(F.col("to").bitwiseAND(F.lit(1)) == DELETE)
    bigger = F.expr("substring(v, at + 1, 1) > substring(w, at + 1, 1)")
    met = _unpacked(_matched(_first_states(short), edges, "key")).withColumns({"w": _spelled("word"), "v": _spelled("low.word")})
    # Of a pair of words of one length only the first walks; at the replaced letter all words below a node agree.
    step = stored(met.where((F.col("op") == DELETE) | bigger).drop("w", "v"), "trie-states")
    found, used = [_arrived(step)], [step]
    while True:
        going = step.where("below > 2").withColumns({"s": _spelled("word"), "node": _spelled("low.word")})
        if going.isEmpty():
            break
        size = F.length("word") - F.when(F.col("op") == DELETE, 1).otherwise(0)
        seen = F.col("depth") + F.when(F.col("op") == DELETE, 2).otherwise(1)
        child = F.concat(F.expr("substring(node, 1, depth)"), F.substring("s", seen, F.lit(1)))
        edit = F.col("at") * 4 + F.col("way") * 2 + F.col("op")
        wanted = going.select("word", "n", edit.alias("edit"), _edge(F.col("way"), size, child).alias("key"))
        step = stored(_unpacked(_matched(wanted, links, "key")), "trie-states")
        found.append(_arrived(step))
        used.append(step)
    pairs = found[0]
    for more in [*found[1:], long_pairs(words, depth)]:
        pairs = pairs.unionAll(more)
    pairs = stored(pairs, "near-words")
    discard(nodes, *used)
    return pairs.unionAll(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"),
                                       F.col("word").alias("near"), F.col("n").alias("near_n")))


def long_pairs(words: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Near pairs, each once, in which the longer word has over `depth` code points: (word, n, near, near_n).

    Words are named by a number; a word of any length gives rows of fixed size,
    two for each of its letters, with a 122-bit rolling hash.
    """
    ship_package(words.sparkSession)
    large = stored(words.where(F.length("word") >= depth).select(
        "word", "n", F.monotonically_increasing_id().alias("id")), "long-words")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield from signatures(number, word, depth)

    rows = stored(large.select("id", "word").mapInArrow(
        hashed, "id long, kind int, len long, at long, h1 long, h2 long"), "long-word-hashes")
    key = ["len", "at", "h1", "h2"]
    other = rows.withColumnRenamed("id", "other")
    replaced = _matched(rows.where(F.col("kind") == REPLACE), other.where(F.col("kind") == REPLACE), key).where("id < other")
    deleted = _matched(rows.where(F.col("kind") == DELETE), other.where("kind = 2"), key)
    ids = replaced.select("id", "other").unionAll(deleted.select("id", "other"))
    ends = large.select(F.col("id").alias("other"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return _matched(_matched(ids, large, "id"), ends, "other").select("word", "n", "near", "near_n")


def signatures(number: int, word: str, depth: int, rows: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    """Hashes of a word (kind 2), of it without a letter (DELETE) and of the letters around a place (REPLACE)."""
    size = len(word)
    heads, tails, powers = [], [], []
    for base in BASES:
        head, power = [0], [1]
        for c in word:
            head.append((head[-1] * base + ord(c) + 1) % PRIME)
            power.append(power[-1] * base % PRIME)
        heads.append(head)
        powers.append(power)
        # The hash of word[i:] from those of the word's starts.
        tails.append([(head[size] - head[i] * power[size - i]) % PRIME for i in range(size + 1)])
    out: list[tuple] = [(number, 2, size, -1, heads[0][size], heads[1][size])]
    for i in range(size if size > depth else 0):
        rest = [(h[i] * p[size - 1 - i] + t[i + 1]) % PRIME for h, t, p in zip(heads, tails, powers, strict=True)]
        out.append((number, REPLACE, size, i, *rest))
        if i + 1 == size or word[i + 1] != word[i]:
            out.append((number, DELETE, size - 1, -1, *rest))
        if len(out) >= rows:
            yield _batch(out)
            out = []
    yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 4]
    columns = list(zip(*rows, strict=True)) or [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                      names=["id", "kind", "len", "at", "h1", "h2"])


def variants(words: DataFrame, ratio: int = 10, depth: int = DEPTH) -> DataFrame:
    """One row per word: (word, form, root, n, n_near, form_n).

    `n_near` counts the words one code point away. The form is the most
    frequent of them (ties: the first in code-point order) if it is at least
    `ratio` times as frequent, else null; the root is found by following
    forms to the last, the word itself if it has none. Counts grow by `ratio`
    from form to form, which bounds the steps. No words, no rows.
    """
    words = stored(words, "words")
    best = near_words(words, depth).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    often = -F.col("best.less")
    chosen = F.coalesce(often >= F.col("n") * ratio, F.lit(False))
    forms = stored(_matched(words, best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(chosen, F.col("best.near")).alias("form"), F.when(chosen, often).alias("form_n")), "forms")
    roots = forms.where("form is not null").select("word", F.col("form").alias("root"))
    least, most = words.agg(F.min("n"), F.max("n")).first()
    steps = math.floor(math.log(most / least, ratio) + 1e-9) if least else 0
    for _ in range(math.ceil(math.log2(max(steps, 1)))):  # each round doubles the steps followed
        roots = stored(roots, "roots")
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = _matched(roots, further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return _matched(forms, roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
