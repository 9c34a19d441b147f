"""Token ids in binary files: fixed-size blocks cut into byte or bit planes, each plane compressed on its own.

A folder holds `data`, a Parquet container written by Spark, and nothing else
is needed to read it. Each row is a segment: whole documents of consecutive
ids, the last segment row of a shard included. Its columns:

* shard, segment: place in the order of ids; shards follow each other, segments within a shard as well;
* shard_start: ids in the shard before the segment; n_ids: ids in it;
* doc_ids, doc_lengths: the documents in order and their numbers of ids;
* index: the chunk index, compressed bytes of each plane of each block, block after block;
* payload: the planes one after the other, each a zstandard frame.

Blocks have BLOCK_IDS ids but for the last of a segment. Any block can be read
on its own: its place in the payload is the sum of the index entries before.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cabstream.llm.common import give_back, workers
from cabstream.llm.tokens import word_ids
from cabstream.session import ship_package

BLOCK_IDS = 1 << 14
SEGMENT_IDS = 1 << 18
LEVEL = 3
#: Planes of a block of 32-bit ids.
PLANES = {"byte": 4, "bit": 32}


def to_planes(ids: bytes, planes: str) -> list[bytes]:
    """Planes of little-endian 32-bit ids: the k-th byte, or the k-th bit, of every id."""
    table = np.frombuffer(ids, np.uint8).reshape(-1, 4)
    if planes == "byte":
        return [np.ascontiguousarray(table[:, k]).tobytes() for k in range(4)]
    bits = np.unpackbits(table, axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(parts: list[bytes], n: int, planes: str) -> bytes:
    if planes == "byte":
        return np.stack([np.frombuffer(p, np.uint8) for p in parts], axis=1).tobytes()
    bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in parts], axis=1)
    return np.packbits(bits, axis=1, bitorder="little").tobytes()


def pack_ids(ids: bytes, planes: str) -> tuple[list[int], bytes]:
    """Chunk index and payload of a segment's ids."""
    import zstandard

    press = zstandard.ZstdCompressor(level=LEVEL)
    frames = [press.compress(p) for at in range(0, len(ids), 4 * BLOCK_IDS)
              for p in to_planes(ids[at:at + 4 * BLOCK_IDS], planes)]
    return [len(f) for f in frames], b"".join(frames)


def unpack_ids(index: list[int], payload: bytes, n_ids: int, planes: str) -> bytes:
    import zstandard

    unpress, per, at, out = zstandard.ZstdDecompressor(), PLANES[planes], 0, []
    for k in range(0, len(index), per):
        parts = []
        for size in index[k:k + per]:
            parts.append(unpress.decompress(payload[at:at + size]))
            at += size
        out.append(from_planes(parts, min(BLOCK_IDS, n_ids - k // per * BLOCK_IDS), planes))
    return b"".join(out)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int = 2, planes: str = "byte", shards: int | None = None) -> None:
    """Encode all documents, each followed by `end_id`, and write the ids to `path` in ascending order of id_col.

    Null texts count as empty; null ids come first; rows with the same id are
    ordered by a hash of their text, so that any number of them is spread over
    shards (but for equal rows). Other columns are not read. A range partition makes one shard; a shard is written by
    one task and committed by Spark, so that a lost executor leaves no part of
    a file. An empty table gives an empty container.
    """
    spark = docs.sparkSession
    ship_package(spark)
    id_field = docs.schema[id_col]
    arrow_id = to_arrow_type(id_field.dataType)
    names = ["shard", "segment", "shard_start", "n_ids", "doc_ids", "doc_lengths", "index", "payload"]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(arrow_id), pa.list_(pa.int64()),
             pa.list_(pa.int32()), pa.binary()]

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, shard = word_ids(tokenizer), TaskContext.get().partitionId()
        end, segment, before, held, owners, lengths = np.array([end_id], "<u4").tobytes(), 0, 0, [], [], []

        def close() -> pa.RecordBatch:
            ids = b"".join(held)
            index, payload = pack_ids(ids, planes)
            row = [shard, segment, before, len(ids) // 4, owners, lengths, index, payload]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names)

        for batch in batches:
            for owner, ids in zip(batch.column(0).to_pylist(), encode.together(batch.column(1)), strict=True):
                ids += end
                held.append(ids)
                owners.append(owner)
                lengths.append(len(ids) // 4)
                if (full := sum(lengths) if len(lengths) % 64 == 0 or lengths[-1] > 4096 else 0) >= SEGMENT_IDS:
                    yield close()
                    segment, before, held, owners, lengths = segment + 1, before + full, [], [], []
        if owners:
            yield close()
        give_back()

    rows = (docs.select(id_col, F.col(text_col).cast("binary").alias("_text"))
            .withColumn("_part", F.xxhash64("_text"))
            .repartitionByRange(shards or workers(spark), id_col, "_part").sortWithinPartitions(id_col, "_part", "_text")
            .drop("_part"))
    rows.mapInArrow(encoded, f"shard int, segment int, shard_start long, n_ids long, "
                    f"doc_ids array<{id_field.dataType.simpleString()}>, doc_lengths array<long>, index array<int>, "
                    "payload binary").write.option("compression", "none").parquet(f"{path}/data")


def read_documents(spark: SparkSession, path: str, id_col: str = "doc_id", planes: str = "byte",
                   with_ids: bool = False) -> DataFrame:
    """One row (id_col, start, n_tokens, ids_crc32[, ids]) per document, from the files alone.

    `start` is the number of ids of all documents before. Segments are decoded
    wherever their file is read; only the sizes of the shards are summed up in
    order, one row per shard.
    """
    ship_package(spark)
    data = spark.read.parquet(f"{path}/data")
    id_type = data.schema["doc_ids"].dataType.elementType.simpleString()
    names = [id_col, "_shard", "_at", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                shard, at, n_ids, owners, lengths, index, payload = (batch.column(c)[i] for c in range(7))
                ids = memoryview(unpack_ids(index.as_py(), payload.as_py(), n_ids.as_py(), planes))
                sizes = np.array(lengths.as_py(), np.int64)
                ends = np.cumsum(sizes)
                parts = [ids[4 * a:4 * b] for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
                columns = [owners.values, pa.array(np.full(len(sizes), shard.as_py(), np.int32)),
                           pa.array(at.as_py() + ends - sizes), pa.array(sizes),
                           pa.array([zlib.crc32(p) for p in parts], pa.int64())]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(p, "<i4") for p in parts], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names)

    docs = data.select("shard", "shard_start", "n_ids", "doc_ids", "doc_lengths", "index", "payload").mapInArrow(
        decoded, f"`{id_col}` {id_type}, _shard int, _at long, n_tokens long, ids_crc32 long"
        + ", ids array<int>" * with_ids)
    sizes = data.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("shard").alias("_shard"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    return docs.join(starts, "_shard").withColumn("start", F.col("_base") + F.col("_at")).select(
        id_col, "start", "n_tokens", "ids_crc32", *["ids"] * with_ids)
