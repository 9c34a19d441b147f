"""Token counts by batch encoding that returns lengths only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabstream.llm.tokens import byte_batches, piece_counts, word_ids
from cabstream.session import ship_package

#: Bytes of text that are encoded at a time.
BATCH_BYTES = 1 << 20

def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096) -> DataFrame:
    """One row (id_col, n_bytes, n_tokens, over_limit) per row of `docs`.

    `tokenizer` is the path of a sentencepiece .model or a tokenizers .json
    file, readable on every worker. Null texts count as empty: no bytes, no
    tokens. Texts are encoded in batches of about BATCH_BYTES, long ones cut at
    boundaries that no token can span; only lengths leave the worker. Repeated
    rows are counted each. Other columns are not read.
    """
    ship_package(docs.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer.endswith(".model"):
            count = piece_counts(tokenizer).count
        else:
            encode = word_ids(tokenizer)
            count = lambda texts: [len(ids) // 4 for ids in encode.many(texts)]
        for batch in batches:
            texts = batch.column(1).to_pylist()
            sizes = [len(t or b"") for t in texts]
            tokens = [n for i, j in byte_batches(sizes, BATCH_BYTES) for n in count(texts[i:j])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())],
                [id_col, "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("binary").alias("_text")).mapInArrow(
        counted, f"`{id_col}` {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
