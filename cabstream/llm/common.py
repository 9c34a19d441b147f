"""Helpers shared by the training-data operators: stored tables, words, connected components."""

from __future__ import annotations

import contextlib
import ctypes
import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cabstream.session import hadoop_path, work_folder

#: ASCII white space; `bytes.split()` cuts at the same six bytes.
SPACE = " \t\n\x0b\x0c\r"
#: Byte table that lower-cases A-Z only.
ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write rows to a table in the shared folder and read them back: lineage is cut, lost executors cost nothing."""
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by `stored` which nothing reads any more."""
    for df in tables:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            files, where = hadoop_path(df.sparkSession, path)
            files.delete(where, True)


def release(spark: SparkSession) -> None:
    """Have Spark's cleaner remove the shuffle files of finished steps, which it does once the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """At the end of a task, return what a Python worker has freed to the system: workers live on, idle, beside the JVM."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def workers(spark: SparkSession) -> int:
    """Tasks that are worth having for one shuffle."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def ascii_lower(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def null_safe(left: DataFrame, right: DataFrame, on: str, how: str) -> DataFrame:
    """Join on one column, null meeting null; `right` has that column as `_on`."""
    return left.join(right, left[on].eqNullSafe(right["_on"]), how)


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Columns node, root: the smallest node reachable, for every node of an edge.

    Large-star and small-star steps alternate until the edges stay the same. A
    step takes minima with partial aggregation and joins them back, so that a
    node with very many edges is never gathered in one task. Each step is
    written to the shared folder. The number of rounds grows with the logarithm
    of the longest chain. Null ends, loops and repeated edges are ignored.
    """
    now = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                 .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), "edges")
    before = None
    while (mark := _fingerprint(now)) != before:
        before = mark
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Minima are stored before they meet the edges again, so that Spark can split the edges of a hub.
        low = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "star-centres")
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        large = stored(large, "large-star")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "star-centres")
        small = (large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(least.select("u", F.col("m").alias("v"))).distinct())
        small = stored(small, "small-star")
        discard(now, large, low, least)
        now = small
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    digest = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(digest)).first())


def numbered(df: DataFrame, group: list[str], order: list[Column], salt: Column, ways: int, name: str) -> DataFrame:
    """Add the rank of each row in its group, from 0, without gathering a group in one task.

    Rows of a group are dealt to `ways` parts by `salt`; a row's rank is its
    rank in its part plus the sizes of the parts before. `salt` and `order`
    should depend on the row only, so that a repeated task deals alike.
    """
    dealt = df.withColumn("__part", F.pmod(salt, F.lit(ways)).cast("int"))
    sizes = dealt.groupBy(*group, "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = W.partitionBy(*group).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(*group, "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    within = W.partitionBy(*group, "__part").orderBy(*order)
    ranked = dealt.withColumn("__rank", F.row_number().over(within) - 1)
    return (ranked.join(starts, [*group, "__part"])
            .withColumn(name, (F.col("__before") + F.col("__rank")).cast("long")).drop("__part", "__rank", "__before"))
