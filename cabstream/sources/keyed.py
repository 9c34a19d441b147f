"""Serving tables that are read by key: sorted in ranges, with a manifest that says which files a key can be in.

A plain Parquet table has to be listed and every footer opened to find one
trip. Here rows are sorted into files by their key, each file has a Bloom
filter for it, and a manifest holds the smallest and largest key of every file.
A read looks the key up in the manifest and opens only the files that can hold
it, one for a key that few rows share, however many files there are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabstream.operators.latest import latest_per_key
from cabstream.session import hadoop_path

#: Rows of one file; a hot key is spread over files by the columns it is sorted by behind the key.
ROWS_PER_FILE = 1_000_000


def write_keyed(df: DataFrame, path: str, key: Sequence[str], within: Sequence[str] = (), files: int | None = None) -> None:
    """Replace the table at ``path`` by rows sorted by ``key``, then ``within``.

    A key with very many rows is cut into several files by ``within``. The data
    and its manifest go to a new folder, and the name of the folder is what
    readers look up, so a reader sees the old table or the new one, never
    parts of both. Null keys come first. An empty table is fine.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    order = [*key, *within]
    dealt = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    writer = dealt.sortWithinPartitions(*order).write.option("maxRecordsPerFile", ROWS_PER_FILE)
    for c in key:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    where = f"{path}/{version}"
    writer.parquet(f"{where}/data")
    written = spark.read.schema(df.schema).parquet(f"{where}/data")
    ends = F.struct(*[F.col(f"`{c}`") for c in key])
    written.groupBy(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file")).agg(
        F.min(ends).alias("low"), F.max(ends).alias("high"), F.count(F.lit(1)).alias("rows")
    ).coalesce(1).write.parquet(f"{where}/manifest")
    _write_text(spark, f"{path}/current", json.dumps({"version": version, "key": list(key), "schema": df.schema.json()}))


def candidate_files(spark: SparkSession, path: str, **values: object) -> list[str]:
    """Files that can hold the key, given by its first columns; nothing but the manifest is read."""
    table = _table(spark, path)
    given = _given(table["key"], values)
    manifest = spark.read.parquet(f"{path}/{table['version']}/manifest")
    ends = [F.struct(*[F.col(f"{side}.`{c}`") for c in given]) for side in ("low", "high")]
    wanted = F.struct(*[F.lit(v).cast(manifest.schema["low"].dataType[c].dataType).alias(c) for c, v in given.items()])
    found = manifest.where((ends[0] <= wanted) & (ends[1] >= wanted)).select("file").collect()
    return sorted(f"{path}/{table['version']}/data/{r['file']}" for r in found)


def read_key(spark: SparkSession, path: str, **values: object) -> DataFrame:
    """Rows of one key, or of all keys that begin with the given columns; no row if there is none."""
    table = _table(spark, path)
    schema = T.StructType.fromJson(json.loads(table["schema"]))
    files = candidate_files(spark, path, **values)
    if not files:
        return spark.createDataFrame([], schema)
    same: Column = F.lit(True)
    for c, v in _given(table["key"], values).items():
        same = same & F.col(f"`{c}`").eqNullSafe(F.lit(v).cast(schema[c].dataType))
    return spark.read.schema(schema).parquet(*files).where(same)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """The whole table."""
    table = _table(spark, path)
    return spark.read.schema(T.StructType.fromJson(json.loads(table["schema"]))).parquet(f"{path}/{table['version']}/data")


def drop_old(spark: SparkSession, path: str) -> None:
    """Delete versions that readers no longer find; call it when no reader can still be at one."""
    current = _table(spark, path)["version"]
    files, where = hadoop_path(spark, path)
    for status in files.listStatus(where):
        if status.isDirectory() and status.getPath().getName() != current:
            files.delete(status.getPath(), True)


def upsert_keyed(df: DataFrame, path: str, key: Sequence[str], order_by: Sequence[str], files: int | None = None) -> None:
    """Fold rows into a keyed table: per key the row with the largest ``order_by`` stays, new rows win ties.

    The table is written anew, so fold what has gathered since, as ``read_upserted`` reads it, from time to time.
    """
    spark = df.sparkSession
    rows = df.withColumn("_new", F.lit(1))
    files_there, where = hadoop_path(spark, f"{path}/current")
    if files_there.exists(where):
        rows = rows.unionByName(read_keyed(spark, path).withColumn("_new", F.lit(0)))
    write_keyed(latest_per_key(rows, list(key), [*order_by, "_new"]).drop("_new"), path, key, files=files)


def _given(key: Sequence[str], values: dict[str, object]) -> dict[str, object]:
    if not values or list(key[:len(values)]) != [c for c in key if c in values] or set(values) - set(key):
        raise ValueError(f"a read names the first of the columns {list(key)}, not {list(values)}")
    return {c: values[c] for c in key if c in values}


def _table(spark: SparkSession, path: str) -> dict:
    files, where = hadoop_path(spark, f"{path}/current")
    stream = files.open(where)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside its place and move it there, so that no reader sees half of it."""
    files, where = hadoop_path(spark, path)
    new = hadoop_path(spark, f"{path}.{uuid.uuid4().hex}")[1]
    out = files.create(new, True)
    out.write(bytearray(text.encode()))
    out.close()
    files.delete(where, False)
    if not files.rename(new, where):
        raise OSError(f"{path} can't be replaced")
