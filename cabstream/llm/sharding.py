"""A uniform shuffle into shards of exact sizes, by a communication matrix drawn beforehand."""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cabstream.llm.common import numbered, workers

#: Partitions per shuffle task, in the first and in the second permutation.
PARTS_PER_TASK = 2


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of `drawn` items are good, by inversion around the mode; any sizes.

    The weights of all outcomes within 40 standard deviations of the mode come
    from the ratios of neighbours; what lies beyond is below double precision.
    """
    lowest, highest = max(0, drawn - bad), min(good, drawn)
    if lowest == highest:
        return lowest
    total = good + bad
    mode = min(max((drawn + 1) * (good + 1) // (total + 2), lowest), highest)
    spread = math.sqrt(drawn * (good / total) * (bad / total) * ((total - drawn) / max(1, total - 1)))
    reach = int(40 * spread) + 40
    first, last = max(lowest, mode - reach), min(highest, mode + reach)
    up = np.arange(mode, last, dtype=np.float64)
    down = np.arange(mode, first, -1, dtype=np.float64)
    rise = np.log(good - up) + np.log(drawn - up) - np.log(up + 1) - np.log(bad - drawn + up + 1)
    fall = np.log(down) + np.log(bad - drawn + down) - np.log(good - down + 1) - np.log(drawn - down + 1)
    weights = np.exp(np.concatenate([np.cumsum(fall)[::-1], [0.0], np.cumsum(rise)]))
    chosen = np.searchsorted(np.cumsum(weights), rng.random() * weights.sum(), "right")
    return first + int(min(chosen, len(weights) - 1))


def communication_matrix(sources: list[int], targets: list[int], seed: int) -> list[list[int]]:
    """Rows: how many items each source sends to each target, as a uniform shuffle of all items would.

    Row by row the items of a source are drawn from what the targets still
    take, target by target: each entry is hypergeometric given those before.
    Row sums are the sources' sizes, column sums the targets'.
    """
    if sum(sources) != sum(targets):
        raise ValueError("sources and targets hold different numbers of items")
    rng, free, matrix = np.random.default_rng(seed), list(targets), []
    for size in sources:
        rest, row = sum(free), []
        for room in free:
            n = hypergeometric(rng, room, rest - room, size)
            row.append(n)
            rest, size = rest - room, size - n
        free = [room - n for room, n in zip(free, row, strict=True)]
        matrix.append(row)
    return matrix


def uniform_shards(df: DataFrame, shards: int, key: list[str], seed: int = 0) -> DataFrame:
    """Add `shard` (0 to shards - 1) and `slot` (gapless from 0 in each shard) to every row.

    Every arrangement of the rows is as likely as any other, and shard sizes
    differ by one at most. Rows are dealt to virtual partitions and permuted
    there by a hash of `key` and the seed, so that a repeated task decides
    alike; rows equal in all of `key` are interchangeable and are permuted in
    one part, so let `key` tell rows of a table with very many copies apart. Only the sizes of
    the partitions, a fixed number per shuffle task, come to the driver, where
    the matrix is drawn. In its shard a row's slot follows a second
    permutation, ranked in many parts. An empty table gives no rows. Input
    columns called shard or slot are replaced.
    """
    spark, df = df.sparkSession, df.drop("shard", "slot")
    ways = workers(spark) * PARTS_PER_TASK

    def drawn(purpose: str) -> Column:
        return F.xxhash64(F.lit(f"{purpose} {seed}"), *key)

    dealt = df.withColumn("__from", F.pmod(drawn("partition"), F.lit(ways)).cast("int"))
    sizes = {r["__from"]: r["n"] for r in dealt.groupBy("__from").agg(F.count(F.lit(1)).alias("n")).collect()}
    sources, total = sorted(sizes), sum(sizes.values())
    targets = [total // shards + (i < total % shards) for i in range(shards)]
    matrix = communication_matrix([sizes[p] for p in sources], targets, seed)
    # Ends of the shards' shares in each partition's permutation; the table has a row per partition.
    ends = [{"__from": p, "__ends": np.cumsum(row).tolist()} for p, row in zip(sources, matrix, strict=True)]
    shares = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(ends)),
                                                        "array<struct<__from:int,__ends:array<bigint>>>")))
    local = W.partitionBy("__from").orderBy(drawn("local"), *key)
    sent = (dealt.withColumn("__rank", F.row_number().over(local))
            .join(shares, "__from")
            .withColumn("shard", F.size(F.filter("__ends", lambda e: e < F.col("__rank"))).cast("int"))
            .drop("__ends", "__rank", "__from"))
    return numbered(sent, ["shard"], [drawn("slot"), *[F.col(k) for k in key]], drawn("part"), ways, "slot")
