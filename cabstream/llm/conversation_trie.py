"""The prefix trie of conversations: shared starts, members and balanced roll-ups over subtrees."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cabstream.llm.centroid import SMALL, subtree_sums
from cabstream.llm.common import discard, stored
from cabstream.session import ship_package

#: Turns of one conversation whose keys are summed in one group, and ids joined to one text before they are hashed.
STRETCH, IDS = 1024, 8
KEY = ["depth", "k1", "k2"]


def ordered_turns(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """Stored rows (conv_id, at, h1, h2, chars): a turn's place from 1, 128 bits of (role, text), its code points.

    Turns are in the order of `turn_col`, null first, ties by role and text;
    equal rows are turns of their own. A null role or text is empty. Rows
    without an id belong to no conversation. The table is sorted into ranges, so a
    conversation of any length is cut into many; its places are counted on from
    range to range.
    """
    rows = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("row"))
    order = ["conv_id", "turn", "role", "text", "row"]
    content = [F.xxhash64(F.lit(i), "role", "text").alias(f"h{i}") for i in (1, 2)]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", *content, F.length("text").cast("long").alias("chars"), F.spark_partition_id().alias("range"),
        F.monotonically_increasing_id().alias("row"))
    kept = stored(sorted_rows, "sorted-turns")
    before = W.partitionBy("conv_id").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    ranges = kept.groupBy("conv_id", "range").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n")).select(
        "conv_id", "range", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("shift"))
    placed = kept.join(ranges, ["conv_id", "range"]).select(
        "conv_id", (F.col("row") + F.col("shift")).alias("at"), "h1", "h2", "chars")
    out = stored(placed, "placed-turns")
    discard(kept)
    return out


def with_shared_starts(turns: DataFrame, base: Column, head: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Rebuild conversations: the first `head` turns of conversation `base`, then the own turns after the first `head`.

    `base` and `head` are expressions on conv_id, `head` is 0 to `most`. A base
    that is absent gives no turns, a shorter one all it has. Returns the turns
    and the conversations (conv_id, turns); a conversation may be left without any.
    """
    sizes = turns.groupBy("conv_id").agg(F.max("at").alias("size"))
    plan = sizes.select("conv_id", "size", base.alias("base"), head.cast("long").alias("head"))
    lengths = sizes.select(F.col("conv_id").alias("base"), F.col("size").alias("base_size"))
    taken = F.least("head", F.coalesce("base_size", F.lit(0)))
    plan = plan.join(lengths, "base", "left").withColumn("taken", taken)
    rebuilt = stored(plan.select("conv_id", "base", "head", "taken", (
        F.col("taken") + F.greatest(F.col("size") - F.col("head"), F.lit(0))).alias("turns")), "rebuilt-conversations")
    # The join is splittable: a long conversation's own turns meet one stored row.
    own = turns.join(rebuilt, "conv_id").where(F.col("at") > F.col("head")).select(
        "conv_id", (F.col("at") - F.col("head") + F.col("taken")).alias("at"), "h1", "h2", "chars")
    starts = turns.where(F.col("at") <= most).withColumnRenamed("conv_id", "base")
    shared = rebuilt.where("taken > 0").join(starts, "base").where(F.col("at") <= F.col("taken")).select(*own.columns)
    return own.unionAll(shared), rebuilt.select("conv_id", "turns")


def prefix_trie(turns: DataFrame, conversations: DataFrame, small: int = SMALL) -> DataFrame:
    """One row per distinct sequence of first turns, from the root without text.

    `turns` has (conv_id, at from 1, h1, h2, chars), `conversations` every
    (conv_id, turns), those without a turn as well. Returns, all long but the
    last: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256 (see `ends`). A node is known by 128
    bits made of its turns' hashes and places. No conversation, no row.

    Members are only ever counted, with partial aggregation. Subtree sums come
    from a centroid decomposition (`centroid.subtree_sums`); its mass is the
    number of turns that conversations have from a node on.
    """
    steps = turns.join(conversations, "conv_id").select(
        "conv_id", F.col("at").alias("depth"), "chars", "turns", F.floor((F.col("at") - 1) / STRETCH).alias("stretch"),
        *[F.xxhash64(F.lit(i), "at", "h1", "h2").alias(f"s{i}") for i in (1, 2)])
    steps = stored(steps, "steps")
    inside = W.partitionBy("conv_id", "stretch").orderBy("depth").rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.partitionBy("conv_id").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    carried = steps.groupBy("conv_id", "stretch").agg(F.bit_xor("s1").alias("c1"), F.bit_xor("s2").alias("c2")).select(
        "conv_id", "stretch", *[F.coalesce(F.bit_xor(c).over(before), F.lit(0)).alias(c) for c in ("c1", "c2")])
    run = steps.select("*", *[F.bit_xor(f"s{i}").over(inside).alias(f"r{i}") for i in (1, 2)]).join(
        carried, ["conv_id", "stretch"])
    keys = {f"k{i}": F.col(f"r{i}").bitwiseXOR(F.col(f"c{i}")) for i in (1, 2)}
    ups = {f"u{i}": F.col(f"k{i}").bitwiseXOR(F.col(f"s{i}")) for i in (1, 2)}
    columns = ["conv_id", *KEY, "u1", "u2", "chars", "turns"]
    zero = F.lit(0).cast("long")
    roots = conversations.select("conv_id", *[zero.alias(c) for c in (*KEY, "u1", "u2", "chars")], "turns")
    visits = stored(run.withColumns(keys).withColumns(ups).select(*columns).unionAll(roots.select(*columns)), "visits")
    discard(steps)

    nodes = stored(visits.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"),
        F.count_if(F.col("depth") == F.col("turns")).alias("n_ends"), F.max("u1").alias("u1"), F.max("u2").alias("u2"),
        F.sum(F.col("turns") - F.col("depth") + 1).alias("mass")), "nodes")
    root = nodes.where("depth = 0").select("conv_id").first()
    first = F.lit(root[0] if root else None).cast("long")
    heads = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("u1"), F.col("k2").alias("u2"),
                         F.col("conv_id").alias("up_chain"))
    # All first turns hang below the root; it is a value, not a join key.
    low = nodes.where("depth > 1").join(heads.where("depth > 1"), ["depth", "u1", "u2"])
    high = nodes.where("depth <= 1").withColumn("up_chain", F.when(F.col("depth") == 1, first))
    linked = stored(low.select(*nodes.columns, "up_chain").unionAll(high).select(
        *KEY, F.col("conv_id").alias("chain"), "up_chain", "n_convs", "n_ends", "mass",
        (F.col("n_ends") == F.col("n_convs")).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens")), "linked-nodes")
    paths = stored(visits.where("depth > 0").select("conv_id", *KEY).join(linked, KEY).select(
        F.col("conv_id").alias("chain"), "depth", F.col("chain").alias("node_chain"), "up_chain"), "paths")
    values = ["n_leaves", "saved_tokens"]
    sums = subtree_sums(linked.select("chain", "depth", "up_chain", "mass", *values), paths, values, small)
    children = linked.where("depth > 0").groupBy(F.col("up_chain").alias("chain"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children"))
    ended = ends(visits.where(F.col("depth") == F.col("turns")))
    return (linked.drop(*values).join(sums, ["chain", "depth"]).join(children, ["chain", "depth"], "left")
            .join(ended, KEY, "left").select(
                F.col("chain").alias("conv_id"), "depth", F.col("up_chain").alias("parent_conv_id"), "n_convs",
                F.coalesce("n_children", zero).alias("n_children"), *values,
                F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")))


def ends(visits: DataFrame) -> DataFrame:
    """Rows (depth, k1, k2, ends_sha256): SHA-256 of the node's ids, ascending, as decimals joined by commas.

    Ids are first joined to texts of at most 2^IDS of them, by ranges of their
    value. A hash of one text has to see its parts in order, so one task reads
    a node's texts one after the other, whatever their number; none is held.
    """
    ship_package(visits.sparkSession)
    blocks = visits.groupBy(*KEY, F.shiftright("conv_id", IDS).alias("block")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, hashlib.sha256()

        def out(found: list) -> pa.RecordBatch:
            columns = list(zip(*[(*k, h) for k, h in found], strict=True)) or [[]] * 4
            kinds = [pa.int64()] * 3 + [pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                              names=[*KEY, "ends_sha256"])

        for batch in batches:
            found = []
            *keys, texts = (batch.column(n).to_pylist() for n in [*KEY, "ids"])
            for *new, text in zip(*keys, texts, strict=True):
                if new == key:
                    state.update(b"," + text.encode())
                    continue
                if key is not None:
                    found.append((key, state.hexdigest()))
                key, state = new, hashlib.sha256(text.encode())
            yield out(found)
        yield out([] if key is None else [(key, state.hexdigest())])

    dealt = blocks.repartition(*KEY).sortWithinPartitions(*KEY, "block").select(*KEY, "ids")
    return dealt.mapInArrow(hashed, "depth long, k1 long, k2 long, ends_sha256 string")
