"""Best-fit packing of token sequences: large pieces are matched in pairs, small ones fill the gaps."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabstream.llm.common import give_back, numbered, stored, workers
from cabstream.llm.tokens import word_ids
from cabstream.session import ship_package

#: Pieces of one length are ranked in so many parts per shuffle task.
PARTS_PER_TASK = 4
#: Rows that leave a Python worker at a time, when they carry ids.
ROWS = 512


class Slots(NamedTuple):
    """Places for the pieces of one length with ranks from `rank`: piece k goes to bin first + k % bins."""

    length: int
    rank: int
    first: int
    bins: int
    offset: int


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = 4096, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """Rows (id_col, piece, start, length, ids_crc32[, ids]): each document's ids and `end_id`, cut at `capacity`.

    Only documents longer than `capacity` have more than one piece. A null text
    counts as empty: it has the end id alone. `ids_crc32` is that of the ids as
    little-endian unsigned 32-bit integers. Other columns are not read.
    """
    ship_package(docs.sparkSession)
    names = [id_col, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, step, end = word_ids(tokenizer), 4 * capacity, np.array([end_id], "<u4").tobytes()
        for whole in batches:
            found = encode.together(whole.column(1))
            for at in range(0, len(whole), ROWS):
                batch = whole.slice(at, ROWS)
                rows, pieces = [], []
                for i, encoded in enumerate(islice(found, len(batch))):
                    ids = encoded + end
                    parts = [ids[j:j + step] for j in range(0, len(ids), step)]
                    rows += [(i, k) for k in range(len(parts))]
                    pieces += parts
                where = pa.array([i for i, _ in rows], pa.int64())
                columns = [batch.column(0).take(where), pa.array([k for _, k in rows], pa.int32()),
                           pa.array([k * capacity for _, k in rows], pa.int64()),
                           pa.array([len(p) // 4 for p in pieces], pa.int64()),
                           pa.array([zlib.crc32(p) for p in pieces], pa.int64())]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(p, "<i4") for p in pieces], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names)
        give_back()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("binary").alias("_text")).mapInArrow(
        cut, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


def packing_plan(counts: dict[int, int], capacity: int) -> list[Slots]:
    """Where pieces go, from the number of pieces of each length alone.

    Pieces over a third of the capacity fit at most twice in a bin: from the
    longest on, each is matched with the longest other that still fits, equal
    lengths all at once. Shorter pieces then go, longest first, to the bin with
    the smallest gap that takes them, or open new bins. The plan has a few
    entries per length, however many pieces there are.
    """
    if bad := [n for n in counts if not 0 < n <= capacity]:
        raise ValueError(f"lengths outside 1 to {capacity}: {bad[:5]}")
    slots: list[Slots] = []
    left, ranks, bins = dict(counts), defaultdict(int), 0
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)
    open_gaps: list[int] = []

    def place(length: int, first: int, n: int, each: int, used: int) -> None:
        slots.append(Slots(length, ranks[length], first, n, used))
        ranks[length] += n * each

    def leave(first: int, n: int, used: int) -> None:
        gap = capacity - used
        if n and gap:
            if not gaps[gap]:
                insort(open_gaps, gap)
            gaps[gap].append((first, n))

    large = sorted(n for n in counts if 3 * n > capacity)
    while large:
        length = large[-1]
        if not left[length]:
            large.pop()
            continue
        fits = [n for n in large[:bisect_left(large, capacity - length + 1)] if left[n]]
        mate = fits[-1] if fits else None
        if mate == length and left[length] == 1:
            mate = fits[-2] if len(fits) > 1 else None
        if mate is None:
            n, used = left[length], length
            place(length, bins, n, 1, 0)
        elif mate == length:
            n, used = left[length] // 2, 2 * length
            place(length, bins, n, 2, 0)
        else:
            n, used = min(left[length], left[mate]), length + mate
            place(length, bins, n, 1, 0)
            place(mate, bins, n, 1, length)
            left[mate] -= n
        left[length] -= 2 * n if mate == length else n
        leave(bins, n, used)
        bins += n

    for length in sorted((n for n in counts if 3 * n <= capacity), reverse=True):
        while left[length]:
            at = bisect_left(open_gaps, length)
            if at < len(open_gaps):
                gap = open_gaps[at]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    open_gaps.pop(at)
            else:
                gap = capacity
                first, n = bins, -(-left[length] // (capacity // length))
                bins += n
            each, used = gap // length, capacity - gap
            full = min(n, left[length] // each)
            if full:
                place(length, first, full, each, used)
                leave(first, full, used + each * length)
                left[length] -= full * each
            if full < n:
                if rest := left[length]:
                    place(length, first + full, 1, rest, used)
                    leave(first + full, 1, used + rest * length)
                    left[length] = 0
                    full += 1
                leave(first + full, n - full, used)
    return slots


def pack(pieces: DataFrame, capacity: int = 4096, order: tuple[str, ...] = ("doc_id", "piece", "ids_crc32")) -> DataFrame:
    """Add sequence_id and offset to pieces of `length` 1 to `capacity`; every other column is kept.

    Only the counts by length, at most `capacity` rows, come to the driver. The
    pieces of a length are ranked in many parts, so a length that a third of
    all rows share is not gathered; their ranks say which slot they take.
    Pieces alike in all `order` columns are interchangeable. Input columns
    called sequence_id or offset are replaced.
    """
    spark, pieces = pieces.sparkSession, pieces.drop("sequence_id", "offset")
    ship_package(spark)
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = sorted(packing_plan(counts, capacity))
    by = np.array([s.length << 48 | s.rank for s in slots], np.int64)
    table = np.array(slots, np.int64).reshape(-1, 5)
    ranked = numbered(pieces, ["length"], [F.col(c) for c in order], F.xxhash64(*order),
                      workers(spark) * PARTS_PER_TASK, "__at")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank, length = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("__at", "length"))
            slot = table[np.searchsorted(by, length << 48 | rank, "right") - 1]
            k = rank - slot[:, 1]
            keep = [i for i, c in enumerate(batch.schema.names) if c != "__at"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in keep), pa.array(slot[:, 2] + k % np.maximum(slot[:, 3], 1)),
                 pa.array(slot[:, 4] + k // np.maximum(slot[:, 3], 1) * length)],
                [*(batch.schema.names[i] for i in keep), "sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "__at")
    return ranked.mapInArrow(placed, f"{kinds}, sequence_id long, offset long")


def packed_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                     capacity: int = 4096, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their place: sequence_id and offset. Empty tables give no rows."""
    pieces = stored(token_pieces(docs, tokenizer, id_col, text_col, capacity, end_id, with_ids), "pieces")
    return pack(pieces, capacity, (id_col, "piece", "ids_crc32"))


def sequences(packed: DataFrame) -> DataFrame:
    """One row (sequence_id, ids) per sequence, from pieces packed with their ids; a group holds one sequence."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.col("parts")["ids"]).alias("ids"))
