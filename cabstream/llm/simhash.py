"""SimHash near-duplicates through pivot distance tables."""

from __future__ import annotations

import random
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabstream.llm.common import ASCII_LOWER, connected_components, give_back, stored
from cabstream.session import ship_package

SEED = 42
BITS = 64
#: Pivots per table row; 16 coordinates of 4 bits fill one long.
PIVOTS = 16
#: Pivots whose whole distances are held against each other before a pair is verified.
FILTER_PIVOTS = 8
#: Shingles hashed at a time.
CHUNK = 1 << 15
#: Fingerprints of one bucket that a join compares; larger buckets go to `_forest`.
SMALL_BUCKET = 16
#: Fingerprints of one block of a large bucket.
BLOCK = 1024


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """One row (id_col, fp) per row of `docs`: the 64-bit SimHash of its word shingles, as a signed long.

    A-Z are lower-cased, words are runs of bytes other than ASCII white space,
    shingles count as often as they occur. A text with fewer words is one
    shingle; a null, empty or blank text has fingerprint 0. A bit is set if it
    is set in over half of the shingles' XXH64 values (seed 42). Very long texts
    are hashed in pieces of bounded size. Other columns are not read.
    """
    ship_package(docs.sparkSession)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], [id_col, "fp"])
        give_back()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("binary").alias("_text")).mapInArrow(
        hashed, f"`{id_col}` {kind}, fp long")


def fingerprint(text: bytes | None, shingle: int) -> int:
    import xxhash

    words = (text or b"").translate(ASCII_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(words) > shingle:
        starts, ends = starts[:len(words) - shingle + 1], ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(starts), CHUNK):
        spans = zip(starts[at:at + CHUNK].tolist(), ends[at:at + CHUNK].tolist(), strict=True)
        values = np.array([digest(joined[i:j], SEED) for i, j in spans], "<u8")
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    chosen = np.packbits(counts * 2 > len(starts), bitorder="little")
    return int(chosen.view("<i8")[0])


def pivots() -> list[int]:
    """Reference fingerprints as signed longs, from a fixed seed."""
    draw = random.Random(SEED)
    return [draw.getrandbits(BITS) - (1 << (BITS - 1)) for _ in range(PIVOTS)]


def block_count(fingerprints: int, max_bits: int) -> int:
    """Bit blocks to cut fingerprints into: as few as keep the expected bucket below SMALL_BUCKET.

    Of b blocks b - max_bits agree, so keys have 64 (b - max_bits) / b bits; any number of blocks loses no pair.
    """
    count = max(max_bits + 2, 5)
    while fingerprints / 2 ** (BITS * (count - max_bits) / count) > SMALL_BUCKET and count < max_bits + 6:
        count += 1
    return count


def block_masks(count: int) -> list[int]:
    """Disjoint bit blocks of about one size."""
    edges = [BITS * i // count for i in range(count + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def pivot_table(nodes: DataFrame, max_bits: int, count: int) -> DataFrame:
    """Add `far` (whole distances to the first pivots, a byte each) and `keys` to distinct fingerprints `fp`.

    The distance to a pivot is the sum of the distances within the `count` bit
    blocks. Where two fingerprints agree on a block, all their coordinates of
    that block are equal. Fingerprints at most `max_bits` apart agree on all but
    that many blocks; each choice of so many blocks is bucketed by their coordinates.
    """
    fp, points = F.col("fp"), pivots()
    far = sum((F.shiftleft(F.bit_count(fp.bitwiseXOR(F.lit(p))).cast("long"), 8 * i)
               for i, p in enumerate(points[:FILTER_PIVOTS])), F.lit(0).cast("long"))
    near = []
    for mask in block_masks(count):
        packed = F.lit(0).cast("long")
        for i, p in enumerate(points):
            part = F.bit_count(fp.bitwiseXOR(F.lit(p)).bitwiseAND(F.lit(mask))).cast("long")
            packed = packed.bitwiseOR(F.shiftleft(part, 4 * i))
        near.append(packed)
    table = stored(nodes.select("fp", far.alias("far"), *[c.alias(f"near{i}") for i, c in enumerate(near)]),
                   "pivot-table")
    keys = [F.xxhash64(F.lit(sum(1 << i for i in chosen)), *[f"near{i}" for i in chosen])
            for chosen in combinations(range(count), count - max_bits)]
    return table.select("fp", "far", F.array(*keys).alias("keys"))


def _close(max_bits: int) -> Column:
    """Pairs that the pivot table can't part and that are close indeed."""
    apart = [F.abs(F.shiftright("l.far", 8 * i).bitwiseAND(F.lit(255))
                   - F.shiftright("r.far", 8 * i).bitwiseAND(F.lit(255))) for i in range(FILTER_PIVOTS)]
    return (F.greatest(*apart) <= max_bits) & (F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp"))) <= max_bits)


def _forest(max_bits: int):
    """For a block pair of a large bucket: a link from each fingerprint to the first of its component there.

    All pairs within the blocks are held against the pivot table; links that
    join nothing new are left out, so at most one row per fingerprint leaves.
    """

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("fp").sort_values("fp")
        fp = rows["fp"].to_numpy(np.int64)
        far = rows["far"].to_numpy(np.int64).astype("<i8").view(np.int8).reshape(-1, 8)[:, :FILTER_PIVOTS]
        keep = np.ones((len(fp), len(fp)), bool)
        for column in far.T:
            keep &= np.abs(column[:, None] - column[None, :]) <= max_bits
        left, right = np.nonzero(np.triu(keep, 1))
        true = np.bitwise_count((fp[left] ^ fp[right]).view(np.uint64)) <= max_bits
        left, right = left[true], right[true]
        label = np.arange(len(fp))
        while True:
            lower = np.minimum(label[left], label[right])
            new = label.copy()
            np.minimum.at(new, left, lower)
            np.minimum.at(new, right, lower)
            np.minimum.at(new, label[left], lower)
            np.minimum.at(new, label[right], lower)
            new = new[new]
            if (new == label).all():
                break
            label = new
        linked = label != np.arange(len(fp))
        return pd.DataFrame({"a": fp[linked], "b": fp[label[linked]]})

    return links


def links(nodes: DataFrame, max_bits: int = 4) -> DataFrame:
    """Columns a, b: pairs of fingerprints at most `max_bits` apart that join all which such pairs join.

    `nodes` has distinct fingerprints `fp`. Buckets of few fingerprints give
    every true link; a large bucket is cut into blocks, each pair of blocks
    gives a spanning forest. No pair of a bucket is left unexamined.
    """
    ship_package(nodes.sparkSession)
    table = pivot_table(nodes, max_bits, block_count(nodes.count(), max_bits))
    keyed = table.select("fp", "far", F.explode("keys").alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stored(keyed.join(sizes, "key"), "pivot-buckets")
    small = shared.where(F.col("n") <= SMALL_BUCKET)
    true = small.alias("l").join(small.alias("r"), (F.col("l.key") == F.col("r.key"))
                                 & (F.col("l.fp") < F.col("r.fp")) & _close(max_bits))
    large = (shared.where(F.col("n") > SMALL_BUCKET)
             .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
             .withColumn("mine", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", "fp", "far", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi")))
    forest = large.groupBy("key", "lo", "hi").applyInPandas(_forest(max_bits), "a long, b long")
    found = true.select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b")).unionAll(forest)
    return found.distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    max_bits: int = 4) -> DataFrame:
    """One row (id_col, fingerprint, component_id) per row of `docs`.

    `fingerprint` is 16 lowercase hex digits. Documents whose fingerprints
    differ in at most `max_bits` bits are linked, equal ones included;
    `component_id` is the smallest id reachable. Null ids stay rows of their
    own; a component of null ids alone has a null component_id. Empty tables
    give no rows. Column names of `docs` beside the two given don't matter.
    """
    marks = stored(fingerprints(docs, id_col, text_col, shingle).withColumnRenamed(id_col, "id"), "fingerprints")
    nodes = stored(marks.groupBy("fp").agg(F.min("id").alias("first")), "nodes")
    roots = connected_components(links(nodes.select("fp"), max_bits), "a", "b")
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        nodes["fp"], "first", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(smallest, "root").select("fp", "component_id")
    return marks.join(classes, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
