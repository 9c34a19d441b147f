"""Subtree sums of a forest by centroid decomposition, for trees of any size and shape."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabstream.llm.common import discard, stored
from cabstream.session import ship_package

#: Mass of a component that one task finishes by itself.
SMALL = 4096
NODE, TOP = ["chain", "depth"], ["top_chain", "top_depth"]


def subtree_sums(nodes: DataFrame, paths: DataFrame, values: Sequence[str], small: int = SMALL) -> DataFrame:
    """Rows (chain, depth, *values): each value summed over the node's subtree, the node included.

    A node is named by `chain` and `depth`; `up_chain` is the chain of its
    parent, one level higher (null for a top of the forest, whose depth may be any).
    `mass` is a positive integer weight of the node's subtree: a node's mass is
    larger than the sum of its children's. `paths` has a row (chain, depth,
    node_chain, up_chain) for every ancestor-or-self of a chain's deepest node,
    the tops excluded: the chain of the node there and of its parent.

    In each round every component with a mass over `small` loses its centroid,
    the deepest node with more than half of the component's mass: what hangs
    below falls apart into components of at most half the mass, and so does
    what is left above. A component's node is an ancestor of the centroid
    exactly if it has more than half of the mass, and lies below it exactly if
    its path passes the centroid. The total from the centroid down is added
    along the path from the centroid to the component's top. So the number of
    rounds grows with the logarithm of the mass, not with the depth. Components
    of at most `small` are finished in one task each by the same steps.

    Rows of one component, however large, meet in aggregations and in joins with one row
    a component, which is stored before, so that Spark can split them. An empty
    forest gives no rows.
    """
    tops = nodes.where("up_chain is null").select(
        F.col("chain").alias("top_chain"), F.col("depth").alias("top_depth"), F.col("mass").alias("whole"))
    rows = nodes.select(*NODE, "up_chain", "mass", *values, *[F.lit(0).cast("long").alias(f"sum_{v}") for v in values])
    roots = tops.limit(2).collect()
    if not roots:
        return nodes.select(*NODE, *values)
    if len(roots) == 1:
        state = rows.select("*", *[F.lit(roots[0][c]).alias(c) for c in (*TOP, "whole")])
    else:
        first = paths.where("up_chain is not null").groupBy("chain").agg(
            F.min_by(F.struct(F.col("up_chain").alias("top_chain"), (F.col("depth") - 1).alias("top_depth")), "depth").alias("t"))
        state = (rows.join(first, "chain", "left")
                 .withColumns({"top_chain": F.coalesce("t.top_chain", "chain"), "top_depth": F.coalesce("t.top_depth", "depth")})
                 .join(tops, TOP).select(*rows.columns, *TOP, "whole"))
    state = stored(state, "centroid-state")
    finished, little = [], []
    while True:
        little.append(state.where(F.col("whole") <= small))
        big = state.where(F.col("whole") > small)
        if big.isEmpty():
            break
        state, done = _split(big, paths, values)
        finished.append(done)
    parts = reduce(DataFrame.unionAll, little)
    return reduce(DataFrame.unionAll, finished, _finish(parts, values))


def _split(big: DataFrame, paths: DataFrame, values: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """One round: the components without their centroids, and the centroids with their sums."""
    sums = [f"sum_{v}" for v in values]
    chosen = big.where(F.col("mass") * 2 > F.col("whole")).groupBy(*TOP).agg(
        F.max(F.struct("depth", "chain", "mass", *values, *sums)).alias("c"))
    chosen = stored(chosen, "centroids")
    # Nodes deeper than the centroid look up their path one level below it; the others look up nothing.
    marked = big.join(chosen, TOP).withColumn(
        "_at", F.when(F.col("depth") > F.col("c.depth"), F.col("c.depth") + 1).otherwise(-1 - F.col("depth")))
    steps = paths.select(F.col("chain").alias("_of"), F.col("depth").alias("_level"), "node_chain",
                         F.col("up_chain").alias("_up"))
    placed = marked.join(steps, (F.col("chain") == F.col("_of")) & (F.col("_at") == F.col("_level")), "left")
    is_centroid = (F.col("depth") == F.col("c.depth")) & (F.col("chain") == F.col("c.chain"))
    below = F.coalesce(F.col("_up") == F.col("c.chain"), F.lit(False))
    above = (F.col("mass") * 2 > F.col("whole")) & ~is_centroid
    placed = placed.where(~is_centroid).select(
        *NODE, "up_chain", F.when(above, F.col("mass") - F.col("c.mass")).otherwise(F.col("mass")).alias("mass"),
        *values, *sums, below.alias("below"), above.alias("above"), *[F.col(t).alias(f"old_{t}") for t in TOP],
        F.when(below, F.col("node_chain")).otherwise(F.col("top_chain")).alias("top_chain"),
        F.when(below, F.col("_level")).otherwise(F.col("top_depth")).alias("top_depth"))
    placed = stored(placed, "centroid-placed")
    parts = placed.groupBy(*TOP, "below", *[f"old_{t}" for t in TOP]).agg(
        F.max("mass").alias("whole"), *[F.sum(v).alias(v) for v in values])
    parts = stored(parts, "centroid-parts")
    under = parts.where("below").groupBy(*[F.col(f"old_{t}").alias(t) for t in TOP]).agg(
        *[F.sum(v).alias(f"under_{v}") for v in values])
    totals = stored(chosen.join(under, TOP, "left").select(
        *TOP, "c", *[(F.col(f"c.{v}") + F.coalesce(f"under_{v}", F.lit(0))).alias(f"total_{v}") for v in values]),
        "centroid-totals")
    done = totals.select("c.chain", "c.depth", *[(F.col(f"c.sum_{v}") + F.col(f"total_{v}")).alias(v) for v in values])
    # The part above its centroid keeps the old top, so totals meet it there and nowhere else.
    sized = parts.select(*TOP, "below", "whole").join(totals.drop("c"), TOP, "left")
    sized = stored(sized.select(*TOP, "whole", *[F.when(~F.col("below"), F.col(f"total_{v}")).alias(f"total_{v}")
                                                 for v in values]), "centroid-sizes")
    added = [(F.col(f"sum_{v}") + F.when(F.col("above"), F.col(f"total_{v}")).otherwise(0)).alias(f"sum_{v}") for v in values]
    state = stored(placed.join(sized, TOP).select(*NODE, "up_chain", "mass", *values, *added, *TOP, "whole"),
                   "centroid-state")
    discard(placed, parts, sized, chosen)
    return state, done


def _finish(rows: DataFrame, values: Sequence[str]) -> DataFrame:
    """Sums of components of bounded mass, one after the other as they come sorted into a task."""
    ship_package(rows.sparkSession)
    names = [*TOP, *NODE, "up_chain", "mass", *values, *[f"sum_{v}" for v in values]]
    many = len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, held = None, []

        def out(done: list) -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) if done else [[]] * (2 + many)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[*NODE, *values])

        for batch in batches:
            done: list = []
            for row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                if row[:2] != top:
                    done += component_sums(held, many)
                    top, held = row[:2], []
                held.append(row[2:])
            yield out(done)
        yield out(component_sums(held, many))

    dealt = rows.select(*names).repartition(*TOP).sortWithinPartitions(*TOP, "depth")
    return dealt.mapInArrow(run, ", ".join(f"{n} long" for n in [*NODE, *values]))


def component_sums(rows: Sequence[tuple], many: int) -> list[tuple]:
    """(chain, depth, *sums) of one component; rows (chain, depth, up_chain, mass, *values, *sums so far) by depth."""
    place = {(r[0], r[1]): i for i, r in enumerate(rows)}
    up = [place.get((r[2], r[1] - 1), -1) for r in rows]
    mass = [r[3] for r in rows]
    sums = [list(r[4 + many:]) for r in rows]
    open_parts = [list(range(len(rows)))] if rows else []
    while open_parts:
        part = open_parts.pop()
        half = mass[part[0]]
        centre = max(i for i in part if mass[i] * 2 > half)
        label = {centre: centre}  # of nodes from the centroid down: the child of the centroid they hang below
        pieces: dict[int, list[int]] = {}
        total = list(rows[centre][4:4 + many])
        for i in part:
            if i == centre:
                continue
            above = label.get(up[i])
            if above is not None:
                label[i] = i if above == centre else above
                total = [t + v for t, v in zip(total, rows[i][4:4 + many], strict=True)]
            pieces.setdefault(label.get(i, -1), []).append(i)
        node, inside, lost = centre, set(pieces.get(-1, ())), mass[centre]
        while node == centre or node in inside:
            sums[node] = [s + t for s, t in zip(sums[node], total, strict=True)]
            if node != centre:
                mass[node] -= lost
            node = up[node]
        open_parts.extend(pieces.values())
    return [(r[0], r[1], *s) for r, s in zip(rows, sums, strict=True)]
