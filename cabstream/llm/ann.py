"""Nearest neighbours by cosine: p-stable hashing, buckets visited in order of estimated success."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cabstream.llm.common import stored
from cabstream.session import ship_package

#: Tables and cell width; a projection of a unit vector is standard normal.
TABLES, WIDTH = 2, 1.5
#: Neighbours are looked for at these cosines, one after the other; a neighbour at such a cosine is met in at least one
#: table with this estimated probability.
COSINES, SUCCESS = (0.9, 0.35), 0.97
#: Hash functions per table at the last cosine, and at most; vectors for each occupied bucket at the others.
HASHES, MOST_HASHES, LOAD = 3, 12, 16
#: Buckets whose chance is below this share of the likeliest aren't listed before the last cosine.
FAINT = 1e-4
SEED = 7
#: Vectors and queries of a bucket that are held against each other at a time.
MEMBERS, ASKED = 4096, 1024
#: Matrix products of one pair may differ by this much; closer scores are computed anew, pair by pair.
SLACK = 1e-9


class StableHashes:
    """Tables of p-stable hashes floor((a.v + b) / width), a normal, b uniform, for unit vectors v."""

    def __init__(self, size: int, hashes: int = HASHES):
        draw = np.random.default_rng(SEED)
        self.lines = draw.standard_normal((TABLES, hashes, size))
        self.shifts = draw.uniform(0, WIDTH, (TABLES, hashes))
        self.reach = math.ceil(4 / WIDTH)
        self.base = (2 * self.reach + 1) ** np.arange(hashes)

    def project(self, unit: np.ndarray) -> np.ndarray:
        return np.einsum("rd,thd->rth", unit, self.lines)

    def buckets(self, projected: np.ndarray) -> np.ndarray:
        """Bucket numbers (rows, tables): cells are digits, the outermost ones reach to infinity."""
        cells = np.floor((projected + self.shifts) / WIDTH).astype(np.int64)
        return np.clip(cells + self.reach, 0, 2 * self.reach) @ self.base

    def probes(self, projected: np.ndarray, cosine: float = COSINES[-1], faint: float = 0.0) -> Iterator[np.ndarray]:
        """For each table the buckets to visit, likeliest first, until the estimated success is enough.

        Along a line, a neighbour at the cosine c of a query at x lies at c x
        plus normal noise of variance 1 - c^2. A bucket's chance is the product
        of its cells' chances; perturbed buckets are taken in that order.
        Combinations that have fallen below `faint` of the likeliest are given up on the way.
        """
        edges = np.arange(1 - self.reach, self.reach + 1) * WIDTH
        spread = math.sqrt(2 * (1 - cosine * cosine))
        for x, shifts in zip(projected, self.shifts, strict=True):
            below = _erf((edges - shifts[:, None] - cosine * x[:, None]) / spread) / 2 + 0.5
            ends = np.zeros((len(x), 1)), np.ones((len(x), 1))
            chances = np.diff(np.concatenate([ends[0], below, ends[1]], axis=1))
            chance, code = np.ones(1), np.zeros(1, np.int64)
            for digit, row in enumerate(chances):
                chance = (chance[:, None] * row).ravel()
                code = (code[:, None] + np.arange(len(row)) * self.base[digit]).ravel()
                kept = chance >= faint * chance.max()
                chance, code = chance[kept], code[kept]
            order = np.argsort(-chance, kind="stable")
            wanted = 1 - (1 - SUCCESS) ** (1 / TABLES)
            yield code[order[:np.searchsorted(np.cumsum(chance[order]), wanted) + 1]]


def hash_count(vectors: int) -> int:
    """Hash functions with which a bucket that is occupied has about LOAD vectors; a cell is one of about four."""
    return min(MOST_HASHES, max(HASHES, round(math.log(max(vectors, 1) / LOAD, 4))))


_erf = np.vectorize(math.erf)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _bucketed(rows: DataFrame, hashes: int, cosine: float | None = None) -> DataFrame:
    """Rows (size, slot, bucket) added: one per table for members, one per visited bucket for queries at a cosine.

    Vectors of different sizes are in tables of their own.
    """
    kept = [f for f in rows.schema.fields]
    faint = 0.0 if cosine == COSINES[-1] else FAINT

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables_of: dict[int, StableHashes] = {}
        for whole in batches:
            lengths = np.array(pc.list_value_length(whole.column("vec")), np.int64)
            for size in np.unique(lengths).tolist():
                alike = whole.take(pa.array(np.flatnonzero(lengths == size)))
                table = tables_of.setdefault(size, StableHashes(size, hashes))
                for at in range(0, len(alike), 256):
                    batch = alike.slice(at, 256)
                    places = table.project(_unit(_matrix(batch.column("vec"))))
                    if cosine is not None:
                        found = [list(table.probes(p, cosine, faint)) for p in places]
                    else:
                        found = [[row[t:t + 1] for t in range(TABLES)] for row in table.buckets(places)]
                    count = [sum(map(len, f)) for f in found]
                    rows = batch.take(pa.array(np.repeat(np.arange(len(batch)), count)))
                    slots = np.concatenate([np.full(len(c), t) for f in found for t, c in enumerate(f)])
                    codes = np.concatenate([c for f in found for c in f])
                    yield pa.RecordBatch.from_arrays(
                        [*rows.columns, pa.array(np.full(len(rows), size, np.int32)), pa.array(slots.astype(np.int32)),
                         pa.array(codes)], [*rows.schema.names, "size", "slot", "bucket"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return rows.mapInArrow(routed, f"{kinds}, size int, slot int, bucket long")


def _nearest(top: int):
    """For a block of queries and a block of members: each query's `top` members by cosine, ties by first id."""

    def best(asked: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"asked": pd.Series(dtype=str), "cls": pd.Series(dtype=str),
                              "first": pd.Series(dtype="int64"), "score": pd.Series(dtype=float)})
        if not len(asked) or not len(members):
            return empty
        queries, rows = (np.stack(f["vec"].to_numpy()).astype(np.float64) for f in (asked, members))
        rough = _unit(queries) @ _unit(rows).T
        least = np.partition(rough, -top, axis=1)[:, -top] if rough.shape[1] > top else np.full(len(rough), -2.0)
        q, m = np.nonzero(rough >= least[:, None] - SLACK)
        found = pd.DataFrame({"asked": asked["cls"].to_numpy()[q], "cls": members["cls"].to_numpy()[m],
                              "first": members["first"].to_numpy()[m], "score": cosine(queries[q], rows[m])})
        found = found.sort_values(["asked", "score", "first"], ascending=[True, False, True])
        return found.groupby("asked", sort=False).head(top)

    return best


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row in double precision; the sums don't depend on the other rows."""
    def norm(x: np.ndarray) -> np.ndarray:
        return np.sqrt((x * x).sum(axis=1))

    return np.clip((a * b).sum(axis=1) / (norm(a) * norm(b)), -1.0, 1.0)


def _search(asked: DataFrame, members: DataFrame, top: int) -> DataFrame:
    """Rows (asked, cls, first, score): the best of each block of (size, slot, bucket).

    Buckets are cut into blocks of bounded size on both sides; each block of
    queries meets each block of members of its bucket once.
    """
    key = ["size", "slot", "bucket"]
    # Stored, so that Spark can split the rows of a large bucket when they join their one row here.
    sizes = (members.groupBy(*key).agg(F.count(F.lit(1)).alias("m"))
             .join(asked.groupBy(*key).agg(F.count(F.lit(1)).alias("q")), key)
             .select(*key, F.ceil(F.col("m") / MEMBERS).cast("int").alias("mb"),
                     F.ceil(F.col("q") / ASKED).cast("int").alias("qb")))
    sizes = stored(sizes, "bucket-sizes")

    def blocks(rows: DataFrame, mine: str, other: str) -> DataFrame:
        own = F.pmod(F.xxhash64("cls"), F.col(mine)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        return rows.join(sizes, key).select(*rows.columns, own.alias(f"{mine}_at"), every.alias(f"{other}_at"))

    grid = [*key, "mb_at", "qb_at"]
    left = blocks(asked, "qb", "mb").groupBy(*grid)
    right = blocks(members, "mb", "qb").groupBy(*grid)
    return left.cogroup(right).applyInPandas(_nearest(top), "asked string, cls string, first long, score double")


def usable(vec: Column) -> Column:
    """Neither null nor empty nor zero, all components present and finite."""
    def bad(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    return F.coalesce((F.size(vec) > 0) & ~F.exists(vec, bad) & F.exists(vec, lambda x: x != 0), F.lit(False))


def nearest_neighbours(table: DataFrame, every: int, k: int = 5, id_col: str = "vec_id",
                       vec_col: str = "embedding") -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the `k` rows nearest by cosine to each row whose id `every` divides.

    Rank 1 is the nearest; ties go to the smaller id. A query never finds its
    own id. Null ids and vectors that are null, empty, zero or hold null or
    non-finite components take no part; vectors of different sizes are no
    candidates of each other. All vectors are indexed. Equal vectors are searched for
    once and stand in for the copies, of which the k + 1 smallest ids can be
    found. Close neighbours are looked for first, in tables whose buckets grow
    in number with the vectors; a query with k + 1 of them at the first of
    COSINES or nearer is done, the others go on to the next. A query that the
    visited buckets give too few neighbours is held against all rows of its
    size, in blocks; up to k rows give all candidates. Repeated rows count once.
    An empty table gives no rows; other columns are not read.
    """
    spark = table.sparkSession
    ship_package(spark)
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec")).where(
        F.col("id").isNotNull() & usable(F.col("vec")))
    digest = F.md5(F.array_join(F.transform("vec", lambda x: x.cast("string")), ","))
    ids = stored(rows.select("id", "vec", digest.alias("cls")), "vectors")
    is_query = F.col("id") % every == 0
    classes = stored(ids.groupBy("cls").agg(F.min("id").alias("first"), F.max(is_query).alias("asks"),
                                            F.any_value("vec").alias("vec")), "vector-classes")
    asked = classes.where("asks").select("cls", "vec")
    members = classes.select("cls", "vec", "first")

    def best(found: DataFrame) -> DataFrame:
        once = found.groupBy("asked", "cls").agg(F.min("first").alias("first"), F.max("score").alias("score"))
        order = W.partitionBy("asked").orderBy(F.desc("score"), "first")
        return once.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1)

    fine = hash_count(classes.count())
    near, left = None, asked
    for cosine in COSINES:
        hashes = HASHES if cosine == COSINES[-1] else fine
        found = stored(best(_search(_bucketed(left, hashes, cosine), _bucketed(members, hashes), k + 1)), "near")
        least = F.col("at") > k if cosine == COSINES[-1] else (F.col("at") > k) & (F.col("score") >= cosine)
        done = stored(found.where(least).select("asked").distinct(), "nearest-done")
        near = found.join(done, "asked") if near is None else near.unionAll(found.join(done, "asked"))
        left = left.join(done, left["cls"] == done["asked"], "left_anti")
        if left.isEmpty():
            break
    else:
        def whole(rows: DataFrame) -> DataFrame:
            own = [F.col(c).alias(c) for c in rows.columns]  # both sides come from one table
            return rows.select(*own, F.size("vec").alias("size"), F.lit(0).alias("slot"),
                               F.lit(0).cast("long").alias("bucket"))

        near = near.unionAll(best(_search(whole(left), whole(members), k + 1)).select(*near.columns))
    copies = ids.select("cls", "id").distinct().withColumn(
        "n", F.row_number().over(W.partitionBy("cls").orderBy("id"))).where(F.col("n") <= k + 1)
    queries = ids.where(is_query).select(F.col("cls").alias("asked"), F.col("id").alias("query_id")).distinct()
    pairs = (queries.join(near.select("asked", "cls", "score"), "asked").join(copies.select("cls", "id"), "cls")
             .where("id != query_id"))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias("vec_id"), "score"))
