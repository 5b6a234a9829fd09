"""Prefix trie of conversations, rolled up in depth bands.

Two conversations share a node of depth ``d`` when their first ``d`` turns are
equal. A node is named by the exclusive or of one hash per (place, turn) of its
prefix, twice 64 bits: prefix names are running sums that need no text, and a
long conversation adds them up block by block.

Totals over subtrees need no round per depth. Bands are ``BAND`` depths high.
A node explodes to its ancestors inside its band only, at most ``BAND`` rows.
Nodes whose depth is a multiple of ``BAND`` are band roots: what they hold from
their own band is rolled up over the tree of band roots in the same way (bands
of bands), and the completed totals then reach the ancestors in the band above.
A tree of depth ``D`` takes ``2 * log_BAND(D)`` groupings, all partially
aggregated, so a node that most conversations share is no hot key.

Defined cases: rows are ordered by turn (null first), then role, then text; a
null role or text is empty; repeated rows are repeated turns; rows with a null
``conv_id`` belong to no conversation and are left out; extra columns are
ignored; an empty table has no node, not even a root. Turns are numbered in
blocks of ``BLOCK`` turn numbers, so a very long conversation is spread; only
rows that repeat one turn number meet in one task, sorted with spilling.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.components import stored
from strata.llm.words import released

BAND = 16
BLOCK = 256
#: Parents with more than this share of all nodes as children are broadcast:
#: there are at most ``1 / HOT_SHARE`` of them.
HOT_SHARE = 0.001
NODE = ["depth", "a", "b"]
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def ordered_turns(turns: DataFrame) -> DataFrame:
    """``(conv_id, place, first, second, bytes)``: every turn with its place
    from 1 and two hashes of role and text."""
    rows = turns.filter("conv_id IS NOT NULL").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.floor(F.col("turn") / BLOCK).alias("block"))
    order = Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = stored(rows.select(
        "conv_id", "block", F.row_number().over(order).alias("row"),
        F.xxhash64(F.lit(1), "role", "text").alias("first"), F.xxhash64(F.lit(2), "text", "role").alias("second"),
        F.octet_length("text").cast("long").alias("bytes")), "turns")
    earlier = (Window.partitionBy("conv").orderBy(F.col("of").asc_nulls_first())
               .rowsBetween(Window.unboundedPreceding, -1))
    starts = (rows.groupBy(F.col("conv_id").alias("conv"), F.col("block").alias("of")).agg(F.count(F.lit(1)).alias("n"))
              .select("conv", "of", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start")))
    placed = rows.join(starts, F.expr("conv_id = conv AND block <=> of"))
    return placed.select("conv_id", (F.col("start") + F.col("row")).alias("place"), "first", "second", "bytes")


def rebuilt(turns: DataFrame, parent: Column, shared: Column) -> DataFrame:
    """Rows of :func:`ordered_turns`, each conversation ``c`` replaced by the
    first ``shared`` turns of conversation ``parent`` (all if it has fewer, none
    if it is absent) and its own turns after its first ``shared``. Both are
    expressions over ``conv_id``; ``shared`` is small. ``length`` is the new
    number of turns; a row of place 0 stands for the conversation itself.
    """
    sizes = turns.groupBy("conv_id").agg(F.max("place").alias("own"))
    plans = sizes.select("conv_id", "own", parent.alias("parent"), shared.cast("long").alias("take")).join(
        sizes.select(F.col("conv_id").alias("parent"), F.col("own").alias("theirs")), "parent", "left")
    kept, rest = F.least("take", F.coalesce("theirs", F.lit(0))), F.greatest(F.col("own") - F.col("take"), F.lit(0))
    plans = stored(plans.select("parent", F.col("conv_id").alias("c"), "take", kept.alias("kept"),
                                (kept + rest).alias("length")), "rebuilt")
    one, facts = F.lit(1).cast("long"), ["first", "second", "bytes", "length"]
    heads = plans.filter("kept > 0").select("parent", "c", "length", F.explode(F.sequence(one, "kept")).alias("place"))
    heads = heads.join(turns.withColumnRenamed("conv_id", "parent"), ["parent", "place"]).select("c", "place", *facts)
    tails = turns.withColumnRenamed("conv_id", "c").join(plans.filter("length > kept"), "c").filter("place > take")
    tails = tails.select("c", (F.col("kept") + F.col("place") - F.col("take")).alias("place"), *facts)
    zero = one - one
    tops = plans.select("c", zero.alias("place"), zero.alias("first"), zero.alias("second"), zero.alias("bytes"), "length")
    return heads.union(tails).union(tops)


def whole(turns: DataFrame) -> DataFrame:
    """Rows of :func:`ordered_turns` as they are, in the form of :func:`rebuilt`."""
    return rebuilt(turns, F.lit(None).cast("long"), F.lit(0))


def named_prefixes(rows: DataFrame) -> DataFrame:
    """``(c, depth, a, b, up_a, up_b, bytes, length)``: the node that each row of
    :func:`rebuilt` reaches and that node's parent."""
    none = F.lit(0).cast("long")
    rows = rows.select(
        "c", F.col("place").alias("depth"), F.floor(F.col("place") / BLOCK).alias("block"), "bytes", "length",
        F.when(F.col("place") == 0, none).otherwise(F.xxhash64(F.lit(3), "place", "first", "second")).alias("step_a"),
        F.when(F.col("place") == 0, none).otherwise(F.xxhash64(F.lit(4), "place", "second", "first")).alias("step_b"))
    inside = Window.partitionBy("c", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = stored(rows.select("*", F.bit_xor("step_a").over(inside).alias("in_a"),
                              F.bit_xor("step_b").over(inside).alias("in_b")), "places")
    earlier = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("c", "block").agg(F.bit_xor("step_a").alias("all_a"), F.bit_xor("step_b").alias("all_b")).select(
        "c", "block", *(F.coalesce(F.bit_xor(f"all_{x}").over(earlier), none).alias(f"base_{x}") for x in "ab"))
    rows = rows.join(blocks, ["c", "block"])
    names = [F.col(f"base_{x}").bitwiseXOR(F.col(f"in_{x}")) for x in "ab"]
    return rows.select("c", "depth", names[0].alias("a"), names[1].alias("b"), names[0].bitwiseXOR(F.col("step_a")).alias("up_a"),
                       names[1].bitwiseXOR(F.col("step_b")).alias("up_b"), "bytes", "length")


def subtree_totals(nodes: DataFrame, paths: DataFrame, sums: list[str], deepest: int, stride: int = 1) -> DataFrame:
    """``(depth, a, b, *sums)`` for every node: ``sums`` added up over its
    subtree, itself included.

    ``nodes``: ``depth, a, b, c`` and the columns ``sums``, ``c`` being one
    conversation through the node; ``paths``: ``c, depth, a, b`` for all nodes on
    the way of each conversation. Depths are multiples of ``stride``, up to ``deepest``.
    """
    span = stride * BAND
    band = F.floor((F.col("depth") / stride - 1) / BAND)
    on_path = paths.filter(F.col("depth") % stride == 0)
    below_top = on_path.filter("depth > 0").select("c", band.alias("band"), *NODE)
    tops = on_path.filter(F.col("depth") % span == 0).select("c", (F.col("depth") / span).cast("long").alias("band"), *NODE)

    def up(these: DataFrame, ancestors: DataFrame) -> DataFrame:
        here = these.select("c", band.alias("band"), F.col("depth").alias("from"), *sums)
        return here.join(ancestors, ["c", "band"]).filter("depth <= from").select(*NODE, *sums)

    def added(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*NODE).agg(*(F.sum(s).alias(s) for s in sums))

    is_root = F.col("depth") % span == 0
    roots = nodes.filter(is_root)
    local = added(up(nodes.filter(~is_root), below_top.union(tops)).union(roots.select(*NODE, *sums)))
    if deepest < span:
        return local
    local = stored(local, "band-totals")
    roots = roots.select(*NODE, "c")
    complete = subtree_totals(stored(roots.join(local, NODE), "band-roots"), paths.filter(is_root), sums, deepest, span)
    complete = stored(complete, "complete")
    lifted = up(roots.filter("depth > 0").join(complete, NODE), below_top.filter(~is_root))
    return added(local.filter(~is_root).union(lifted)).union(complete)


def _chunks(batches):
    """Sorted rows ``(depth, a, b, c)`` as runs of one node, their ids joined."""
    for batch in released(batches):
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy() for i in range(3)])
        begins = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)))
        ids = batch.column(3).to_pylist()
        joined = [",".join(map(str, ids[x:y])) for x, y in zip(begins, [*begins[1:], len(ids)], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(i).take(pa.array(begins)) for i in range(4)] + [pa.array(joined, type=pa.string())],
            names=["depth", "a", "b", "c", "ids"])


def _digested(batches):
    """One hash per node from its runs in order; a node may span batches."""
    node, state, done = None, None, []

    def rows():
        columns = list(zip(*done, strict=True)) or [()] * 4
        done.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(x, type=pa.int64()) for x in columns[:3]] + [pa.array(columns[3], type=pa.string())],
            names=["depth", "a", "b", "ends_sha256"])

    for batch in released(batches):
        for *key, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4)), strict=True):
            if key == node:
                state.update(b"," + ids.encode())
                continue
            if node:
                done.append((*node, state.hexdigest()))
            node, state = key, hashlib.sha256(ids.encode())
        yield rows()
    if node:
        done.append((*node, state.hexdigest()))
    yield rows()


def end_digests(prefixes: DataFrame) -> DataFrame:
    """``(depth, a, b, ends_sha256)`` of nodes where conversations end. Ids are
    sorted over the whole cluster and joined in runs; a node's hash then reads
    its runs one after another, whatever their number."""
    ends = prefixes.filter("depth = length").select(*NODE, "c")
    runs = (ends.repartitionByRange(*NODE, "c").sortWithinPartitions(*NODE, "c")
            .mapInArrow(_chunks, "depth long, a long, b long, c long, ids string"))
    return (runs.repartition(*NODE).sortWithinPartitions(*NODE, "c")
            .mapInArrow(_digested, "depth long, a long, b long, ends_sha256 string"))


def with_parents(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``n_children`` and ``parent_conv_id``, the parent's ``conv_id``."""
    children = nodes.filter("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = stored(nodes.join(children, NODE, "left").fillna(0, ["n_children"]), "family")
    least = int(nodes.count() * HOT_SHARE) + 1
    parents = nodes.filter("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"),
        F.col("conv_id").alias("parent_conv_id"), "n_children")
    hot = F.broadcast(parents.filter(F.col("n_children") >= least).drop("n_children"))
    cold = parents.filter(F.col("n_children") < least).drop("n_children")
    key = ["depth", "up_a", "up_b"]
    busy = nodes.join(hot, key)
    quiet = nodes.filter("depth > 0").join(hot, key, "left_anti").join(cold, key)
    root = nodes.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return root.unionByName(busy).unionByName(quiet)


def prefix_trie(rows: DataFrame) -> DataFrame:
    """One row per node over the rows of :func:`rebuilt` or :func:`whole`:
    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``."""
    prefixes = stored(named_prefixes(rows), "prefixes")
    nodes = prefixes.groupBy(*NODE).agg(
        F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("length").alias("longest"),
        F.max("bytes").alias("bytes"), F.max("up_a").alias("up_a"), F.max("up_b").alias("up_b"))
    nodes = with_parents(nodes)
    nodes = stored(nodes.select(*NODE, "conv_id", "parent_conv_id", "n_convs", "n_children",
                                (F.col("longest") == F.col("depth")).cast("long").alias("own_leaf"),
                                ((F.col("n_convs") - 1) * F.col("bytes")).alias("own_saved")), "nodes")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    totals = subtree_totals(
        nodes.select(*NODE, F.col("conv_id").alias("c"), F.col("own_leaf").alias("n_leaves"),
                     F.col("own_saved").alias("saved_tokens")),
        prefixes.select("c", *NODE), ["n_leaves", "saved_tokens"], deepest)
    found = nodes.join(totals, NODE).join(end_digests(prefixes), NODE, "left")
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"))
