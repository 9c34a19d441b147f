"""Batch and stream sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cabstream.operators.latest import latest_per_key
from cabstream.session import hadoop_path


def write_partitioned(df: DataFrame, path: str, by: str | Sequence[str] | None = None,
                      mode: str = "overwrite", rows_per_file: int = 5_000_000) -> None:
    """Snappy Parquet; a rerun replaces only the partitions it writes.

    Rows are rebalanced by the partition columns first: a month goes to one
    task, or to several of about equal size if it is large, so the number of
    files follows the data and not the number of tasks.
    """
    keys = [by] if isinstance(by, str) else list(by or ())
    rows = df.hint("rebalance", *keys) if keys else df
    writer = rows.write.mode(mode).option("compression", "snappy") \
        .option("maxRecordsPerFile", rows_per_file) \
        .option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*keys) if keys else writer).parquet(path)


def to_json_events(df: DataFrame, key: str | None = None,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """Rows as JSON text in ``value`` (and ``key``), the form a broker topic takes."""
    fields = list(columns or df.columns)
    value = F.to_json(F.struct(*fields)).alias("value")
    return df.select(value) if key is None else df.select(F.col(key).cast("string").alias("key"), value)


def iso_instant(ts: Column | str) -> Column:
    """ISO-8601 UTC text of a TIMESTAMP; the fraction is written only when there is one."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    whole = F.unix_micros(ts) % 1_000_000 == 0
    return F.when(whole, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")) \
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))


def write_stream(df: DataFrame, fmt: str, checkpoint: str, options: dict[str, str] | None = None,
                 mode: str = "append", trigger: dict | None = None) -> StreamingQuery:
    """Start an append/update query with a checkpoint; the trigger defaults to one minute."""
    return (
        df.writeStream.format(fmt).outputMode(mode).options(**(options or {}))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "60 seconds"})).start()
    )


def split_matches(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(matched, unmatched) halves of match results."""
    return df.filter("matched"), df.filter("not matched")


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def routing_writer(matched_path: str, unmatched_path: str,
                   fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function writing both halves from one evaluation of the batch.

    Each micro-batch overwrites its own folder, so a redelivered batch changes nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            matched, unmatched = split_matches(batch)
            for half, path in ((matched, matched_path), (unmatched, unmatched_path)):
                half.write.mode("overwrite").format(fmt).save(batch_folder(path, batch_id))
        finally:
            batch.unpersist()

    return write


def upsert_writer(path: str, keys: Sequence[str], order_by: Sequence[str],
                  merge_into: str | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for a keyed serving table where the last write wins.

    Without a table format that has MERGE, each batch is stored as its own
    folder holding one row per key, idempotent on the batch id; ``read_upserted``
    resolves keys across batches. With ``merge_into`` the rows are merged into
    that table instead.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = latest_per_key(batch, keys, order_by)
        if merge_into is None:
            rows.write.mode("overwrite").parquet(batch_folder(path, batch_id))
            return
        rows.createOrReplaceTempView("cabstream_upsert_rows")
        on = " and ".join(f"t.{k} <=> s.{k}" for k in keys)
        batch.sparkSession.sql(
            f"merge into {merge_into} t using cabstream_upsert_rows s on {on} "
            "when matched then update set * when not matched then insert *"
        )

    return write


def read_upserted(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Current rows of a table written by ``upsert_writer``: per key, the last batch's row.

    After a compaction only the newest base and the batches behind it are read.
    """
    base, batches = _upserted_parts(spark, path)
    parts = [spark.read.parquet(f"{path}/base/upto={base}").withColumn("batch_id", F.lit(base))] if base is not None else []
    if batches:
        parts.append(spark.read.option("basePath", path).parquet(*[batch_folder(path, b) for b in batches]).withColumn(
            "batch_id", F.col("batch_id").cast("bigint")))
    rows = parts[0] if len(parts) == 1 else parts[0].withColumn("batch_id", F.col("batch_id").cast("bigint")).unionByName(parts[1])
    return latest_per_key(rows, keys, ["batch_id"]).drop("batch_id")


def compact_upserted(spark: SparkSession, path: str, keys: Sequence[str]) -> int:
    """Fold the batches written so far into a new base, then delete what it replaces; returns its last batch."""
    base, batches = _upserted_parts(spark, path)
    if not batches:
        return base if base is not None else -1
    read_upserted(spark, path, keys).write.mode("overwrite").parquet(f"{path}/base/upto={batches[-1]}")
    for old in [batch_folder(path, b) for b in batches] + ([f"{path}/base/upto={base}"] if base is not None else []):
        files, where = hadoop_path(spark, old)
        files.delete(where, True)
    return batches[-1]


def _upserted_parts(spark: SparkSession, path: str) -> tuple[int | None, list[int]]:
    """Last batch of the newest complete base, and the batches written after it."""
    def numbers(folder: str, prefix: str) -> list[int]:
        files, where = hadoop_path(spark, folder)
        found = files.listStatus(where) if files.exists(where) else []
        done = (s.getPath() for s in found if files.exists(hadoop_path(spark, f"{s.getPath()}/_SUCCESS")[1]))
        return sorted(int(p.getName().removeprefix(prefix)) for p in done if p.getName().startswith(prefix))

    bases = numbers(f"{path}/base", "upto=")
    base = bases[-1] if bases else None
    return base, [b for b in numbers(path, "batch_id=") if base is None or b > base]


def archive_events(stream: DataFrame, path: str, checkpoint: str, topic: str,
                   granularity: str = "hour", trigger: dict | None = None) -> StreamingQuery:
    """Archive a raw event stream as JSON below ingest-time folders (wall clock, UTC)."""
    parts = ["year", "month", "day", "hour"]
    if granularity not in ("hour", "day"):
        raise ValueError(f"granularity is 'hour' or 'day', not {granularity!r}")
    used = parts if granularity == "hour" else parts[:3]
    formats = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    stamped = stream.withColumn("topic", F.lit(topic)).withColumns(
        {p: F.date_format(F.current_timestamp(), formats[p]) for p in used})
    return (
        stamped.writeStream.format("json").outputMode("append")
        .partitionBy("topic", *used).option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "60 seconds"})).start()
    )
