"""Trie of conversation prefixes, rolled up by centroid decomposition of its parent edges."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthlens.llm.common import cut_lineage

# Components of more nodes are split by Spark jobs, smaller ones inside a task.
TASK_NODES = 20_000
# Rows of one conversation that a window or a joined key meets at a time.
BLOCK = 4096
# Ids of conversations that end at a node are joined to text in stretches of this many ids.
ID_STRETCH_BITS = 12
_NODE = ["conv_id", "depth"]


def _zero() -> Column:
    return F.lit(0).cast("long")


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), two content hashes and text_bytes of every turn, numbered by turn.

    Null turns come first, ties go by role and by the digest of the text.  The
    narrow rows are sorted by range and numbered by the partitions' counts, so a
    conversation with a large share of all rows is spread over many tasks.
    Rows without a conv_id belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat_ws(":", F.length(role), role, text))
    halves = [F.conv(F.substring(digest, at, 15), 16, 10).cast("long") for at in (1, 17)]
    narrow = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"), "turn", role.alias("role"), F.md5(text).alias("tie"),
        halves[0].alias("h1"), halves[1].alias("h2"), F.octet_length(text).cast("long").alias("text_bytes"),
    )
    keys = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("tie")]
    ranged = narrow.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("turn", "role", "tie")
    ranged = cut_lineage(ranged.withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    parts = ranged.groupBy(F.col("conv_id").alias("of"), part.alias("part")).agg(F.count("*").alias("n"), F.min("at").alias("first"))
    ahead = Window.partitionBy("of").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("of", "part", (F.coalesce(F.sum("n").over(ahead), _zero()) - F.col("first")).alias("shift"))
    rows = ranged.withColumn("in_part", part)
    joined = rows.join(parts, (F.col("conv_id") == F.col("of")) & (F.col("in_part") == F.col("part")))
    return joined.select("conv_id", (F.col("at") + F.col("shift")).alias("pos"), "h1", "h2", "text_bytes")


def spliced(turns: DataFrame, group: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt from their group's first one, as (conv_id) and turns.

    With base = conv_id - conv_id % ``group`` and h = crc32(conv_id) % ``most``:
    the first h turns of the base (all if fewer, none if there is no such
    conversation), then the conversation's own behind its first h.
    """
    turns = cut_lineage(turns)
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    held = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = cut_lineage(convs.withColumn("h", held).withColumn("base", F.col("conv_id") - F.col("conv_id") % group))
    sizes = convs.select(F.col("conv_id").alias("b"), F.col("n").alias("base_n"))
    plan = convs.join(sizes, F.col("base") == F.col("b"), "left").select(
        F.col("conv_id").alias("of"), "base", "h", F.least("h", F.coalesce("base_n", _zero())).alias("head")
    )
    plan = cut_lineage(plan)
    columns = ["h1", "h2", "text_bytes"]
    head = turns.where(F.col("pos") < most).join(plan, (F.col("conv_id") == F.col("base")) & (F.col("pos") < F.col("h")))
    # the longest conversations meet their plan in stretches of pos, so no key has many rows
    stretch = F.shiftright("pos", BLOCK.bit_length() - 1)
    stretches = turns.groupBy(F.col("conv_id").alias("c"), stretch.alias("s")).agg(F.count("*").alias("rows"))
    stretches = stretches.join(plan, F.col("c") == F.col("of")).select("c", "s", "h", "head")
    tail = turns.withColumn("in_s", stretch).join(stretches, (F.col("conv_id") == F.col("c")) & (F.col("in_s") == F.col("s")))
    tail = tail.where(F.col("pos") >= F.col("h")).select("conv_id", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), *columns)
    return convs.select("conv_id"), head.select(F.col("of").alias("conv_id"), "pos", *columns).unionByName(tail)


def prefix_members(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """conv_id, depth, rep, n_convs and text_bytes of every prefix of every conversation.

    A prefix is known by the exclusive or of its turns' 128-bit hashes, each
    mixed with its place, and named by ``rep``, the smallest conversation that
    starts with it, and its depth.  Running values go through blocks of a
    conversation's turns, and a prefix that many share is sorted over many
    partitions, which settle its smallest member and its count among
    themselves.
    """
    cells = [F.xxhash64(F.lit(k), "pos", "h1", "h2").alias(f"e{k}") for k in (1, 2)]
    placed = turns.select("conv_id", "pos", "text_bytes", F.shiftright("pos", BLOCK.bit_length() - 1).alias("block"), *cells)
    placed = cut_lineage(placed)
    blocks = placed.groupBy(F.col("conv_id").alias("of"), F.col("block").alias("b")).agg(
        F.bit_xor("e1").alias("b1"), F.bit_xor("e2").alias("b2")
    )
    earlier = Window.partitionBy("of").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("of", "b", *[F.coalesce(F.bit_xor(f"b{k}").over(earlier), _zero()).alias(f"b{k}") for k in (1, 2)])
    inside = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    running = placed.select("conv_id", "block", "pos", "text_bytes", *[F.bit_xor(f"e{k}").over(inside).alias(f"r{k}") for k in (1, 2)])
    keyed = running.join(blocks, (F.col("conv_id") == F.col("of")) & (F.col("block") == F.col("b"))).select(
        "conv_id", (F.col("pos") + 1).alias("depth"), "text_bytes", *[F.col(f"r{k}").bitwiseXOR(F.col(f"b{k}")).alias(f"k{k}") for k in (1, 2)]
    )
    roots = convs.select("conv_id", _zero().alias("depth"), _zero().alias("text_bytes"), _zero().alias("k1"), _zero().alias("k2"))
    order = ["k1", "k2", "conv_id"]
    ranged = keyed.unionByName(roots).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = cut_lineage(ranged.withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    parts = ranged.groupBy(F.col("k1").alias("p1"), F.col("k2").alias("p2"), part.alias("part")).agg(
        F.min("conv_id").alias("least"), F.count("*").alias("n")
    )
    same = Window.partitionBy("p1", "p2")
    parts = parts.select("p1", "p2", "part", F.min("least").over(same).alias("rep"), F.sum("n").over(same).alias("n_convs"))
    rows = ranged.withColumn("in_part", part)
    joined = rows.join(parts, (F.col("k1") == F.col("p1")) & (F.col("k2") == F.col("p2")) & (F.col("in_part") == F.col("part")))
    return cut_lineage(joined.select("conv_id", "depth", "rep", "n_convs", "text_bytes"))


def decomposed(
    conv: np.ndarray, depth: np.ndarray, parent: np.ndarray, top: np.ndarray, size: np.ndarray, values: list[np.ndarray]
) -> list[np.ndarray]:
    """Subtree sums of ``values`` within the components of a forest, by centroid decomposition.

    ``parent`` is the place of a node's parent, -1 at the top of a component,
    ``top`` the place of its component's top, ``size`` the nodes of its subtree
    in the component.  In each round every component gives up its centroid, the
    deepest node that holds half of it or more.  The parts that are left are
    labelled by following parents, their totals add up to the centroid's sum,
    and that sum is added along the path from the centroid to the top.
    """
    n = len(conv)
    parent, size, top = parent.copy(), size.copy(), top.copy()
    added = [np.zeros(n, np.int64) for _ in values]
    alive = np.ones(n, bool)
    while alive.any():
        at = np.flatnonzero(alive)
        half = at[2 * size[at] >= size[top[at]]]
        best = np.full(n, -1, np.int64)
        np.maximum.at(best, top[half], depth[half] * n + half)
        centre = best[best >= 0] % n
        chosen = np.zeros(n, bool)
        chosen[centre] = True
        above = parent.copy()
        loose = at[(parent[at] >= 0) & chosen[parent[at]]]
        parent[loose] = -1
        alive[centre] = False
        at = at[~chosen[at]]
        jump = np.where(parent < 0, np.arange(n), parent)
        while True:
            further = jump.copy()
            further[at] = jump[jump[at]]
            if (further == jump).all():
                break
            jump = further
        sums = []
        for value in values:
            total = np.zeros(n, np.int64)
            np.add.at(total, jump[at], value[at])
            below = np.zeros(n, np.int64)
            np.add.at(below, above[loose], total[loose])
            sums.append(value + below)
        top[at] = jump[at]
        walkers, here = centre, above[centre]
        while True:
            going = here >= 0
            walkers, here = walkers[going], here[going]
            if not len(here):
                break
            for k, got in enumerate(sums):
                added[k][here] += got[walkers]
            size[here] -= size[walkers]
            here = above[here]
        for k, got in enumerate(sums):
            added[k][centre] += got[centre]
    return added


def _split(nodes: DataFrame, paths: DataFrame, big: DataFrame, sums: list[str]) -> DataFrame:
    """``nodes`` after every component of ``big`` (top_conv, top_depth, total) has given up its centroid.

    A node below the centroid moves to the component of the centroid's child on
    its path; the nodes above it add its sums and lose its size.  ``paths``
    (path_conv, path_depth, rep, next) tells both from any node's own conversation.
    """
    in_big = (F.col("c_top_conv") == F.col("top_conv")) & (F.col("c_top_depth") == F.col("top_depth"))
    big = big.select(F.col("top_conv").alias("c_top_conv"), F.col("top_depth").alias("c_top_depth"), "total")
    held = nodes.join(big, in_big).where(2 * F.col("size") >= F.col("total"))
    centres = held.groupBy("c_top_conv", "c_top_depth").agg(F.max(F.struct("depth", "conv_id", "size")).alias("c"))
    centres = cut_lineage(
        centres.select("c_top_conv", "c_top_depth", *[F.col(f"c.{x}").alias(f"c_{y}") for x, y in (("conv_id", "conv"), ("depth", "depth"), ("size", "size"))])
    )
    # stretches of a conversation's nodes look up where their path meets the centroid's depth
    stretch = F.shiftright("depth", BLOCK.bit_length() - 1)
    stretches = nodes.join(centres, in_big).groupBy("conv_id", stretch.alias("s"), "c_top_conv", "c_top_depth", "c_conv", "c_depth", "c_size")
    stretches = stretches.agg(F.count("*").alias("rows"))
    meets = (F.col("conv_id") == F.col("path_conv")) & (F.col("c_depth") == F.col("path_depth"))
    stretches = stretches.join(paths, meets, "left").select(
        F.col("conv_id").alias("of"), "s", F.col("c_top_conv").alias("of_conv"), F.col("c_top_depth").alias("of_depth"),
        "c_conv", "c_depth", (F.col("rep") == F.col("c_conv")).alias("under"), "next",
    )
    mine = (F.col("conv_id") == F.col("of")) & (F.col("in_s") == F.col("s"))
    mine = mine & (F.col("top_conv") == F.col("of_conv")) & (F.col("top_depth") == F.col("of_depth"))
    seen = cut_lineage(nodes.withColumn("in_s", stretch).join(stretches, mine, "left").drop("of", "in_s", "s", "of_conv", "of_depth"))
    under = F.coalesce(F.col("under") & (F.col("depth") >= F.col("c_depth")), F.lit(False))
    totals = seen.where(under).groupBy("top_conv", "top_depth").agg(*[F.sum(x).alias(f"t_{x}") for x in sums])
    centres = cut_lineage(
        centres.join(totals, (F.col("top_conv") == F.col("c_top_conv")) & (F.col("top_depth") == F.col("c_top_depth")))
    )
    between = (F.col("path_conv") == F.col("c_conv")) & F.col("path_depth").between(F.col("c_top_depth"), F.col("c_depth"))
    trail = paths.join(centres, between).select(
        F.col("rep").alias("a_conv"), F.col("path_depth").alias("a_depth"),
        F.when(F.col("path_depth") < F.col("c_depth"), F.col("c_size")).otherwise(_zero()).alias("lost"), *[f"t_{x}" for x in sums],
    )
    out = seen.join(trail, (F.col("conv_id") == F.col("a_conv")) & (F.col("depth") == F.col("a_depth")), "left")
    gone = under & (F.col("depth") == F.col("c_depth"))
    return cut_lineage(
        out.select(
            "conv_id", "depth", "parent_conv",
            F.when(~gone, F.when(under, F.col("next")).otherwise(F.col("top_conv"))).alias("top_conv"),
            F.when(~gone, F.when(under, F.col("c_depth") + 1).otherwise(F.col("top_depth"))).alias("top_depth"),
            (F.col("size") - F.coalesce("lost", _zero())).alias("size"), *sums,
            *[(F.col(f"all_{x}") + F.coalesce(f"t_{x}", _zero())).alias(f"all_{x}") for x in sums],
        )
    )


def rolled_up(nodes: DataFrame, paths: DataFrame, sums: list[str], task_nodes: int = TASK_NODES) -> DataFrame:
    """conv_id, depth and, as ``all_x``, the sum of each x of ``sums`` over the node's subtree.

    ``nodes`` (conv_id, depth, parent_conv, size, sums) form one tree.
    Components of more than ``task_nodes`` nodes are split at their centroids by
    Spark jobs, whose number is logarithmic in the nodes; the components that
    are left are dealt over tasks and decomposed there.
    """
    top = nodes.agg(F.min("conv_id").alias("top_conv"), _zero().alias("top_depth"), F.count("*").alias("total")).head()
    if not top["total"]:
        return nodes.select(*_NODE, *[F.lit(0).cast("long").alias(f"all_{x}") for x in sums])
    nodes = nodes.select(
        *_NODE, "parent_conv", F.lit(top["top_conv"]).cast("long").alias("top_conv"), _zero().alias("top_depth"), "size", *sums,
        *[_zero().alias(f"all_{x}") for x in sums],
    )
    is_top = (F.col("conv_id") == F.col("top_conv")) & (F.col("depth") == F.col("top_depth"))
    while True:
        big = nodes.where(is_top & (F.col("size") > task_nodes)).select("top_conv", "top_depth", F.col("size").alias("total"))
        if big.isEmpty():
            break
        nodes = _split(nodes, paths, big, sums)
    answer = [*_NODE, *[f"all_{x}" for x in sums]]
    tasks = max(1, top["total"] // task_nodes)

    def finish(frame: pd.DataFrame) -> pd.DataFrame:
        conv, depth = frame["conv_id"].to_numpy(), frame["depth"].to_numpy()
        place = pd.MultiIndex.from_arrays([conv, depth])
        above = place.get_indexer(pd.MultiIndex.from_arrays([frame["parent_conv"].to_numpy(), depth - 1]))
        tops = frame["top_conv"].to_numpy(), frame["top_depth"].to_numpy()
        parent = np.where((conv == tops[0]) & (depth == tops[1]), -1, above).astype(np.int64)
        values = [frame[x].to_numpy(np.int64) for x in sums]
        got = decomposed(conv, depth, parent, place.get_indexer(pd.MultiIndex.from_arrays(tops)), frame["size"].to_numpy(np.int64), values)
        return frame[_NODE].assign(**{f"all_{x}": frame[f"all_{x}"] + g for x, g in zip(sums, got, strict=True)})

    left = nodes.where(F.col("top_conv").isNotNull()).fillna({"parent_conv": 0})
    schema = ", ".join(f"{c} long" for c in answer)
    finished = left.groupBy(F.pmod(F.xxhash64("top_conv", "top_depth"), F.lit(tasks)).alias("task")).applyInPandas(finish, schema)
    return finished.unionByName(nodes.where(F.col("top_conv").isNull()).select(*answer))


def _ends_digest(ends: DataFrame) -> DataFrame:
    """e_conv, e_depth and the SHA-256 of the comma-joined, ascending ids of the conversations that end there.

    Ids are joined to text by stretches of the id range, and a node's stretches
    pass through one running digest, whatever their number.
    """
    stretch = F.shiftright("conv_id", ID_STRETCH_BITS).alias("stretch")
    ids = ends.groupBy("rep", "depth", stretch).agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    ids = ids.repartition("rep", "depth").sortWithinPartitions("rep", "depth", "stretch").select("rep", "depth", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["e_conv", "e_depth", "ends_sha256"]
        now, digest = None, None
        for batch in batches:
            done = []
            for rep, depth, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now == (rep, depth):
                    digest.update(b"," + text.encode())
                    continue
                if now:
                    done.append((*now, digest.hexdigest()))
                now, digest = (rep, depth), hashlib.sha256(text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=names)
        if now:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*now, digest.hexdigest())], names=names)

    return ids.mapInArrow(run, "e_conv long, e_depth long, ends_sha256 string")


def prefix_trie(convs: DataFrame, turns: DataFrame, task_nodes: int = TASK_NODES) -> DataFrame:
    """The trie of all prefixes of conversations, a row per node.

    ``convs`` (conv_id) are the conversations, also those without turns;
    ``turns`` (conv_id, pos, h1, h2, text_bytes) come from ``ordered_turns``.
    conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs,
    n_children, n_leaves, saved_tokens (bytes of last texts that later members
    share, over the subtree) and ends_sha256 (of the ids that end at the node).

    Equal conversations are members of one leaf; without conversations there
    are no rows.  Sums over subtrees come from a centroid decomposition.
    """
    members = prefix_members(convs, turns)
    last = members.groupBy("conv_id").agg(F.max("depth").alias("last"), F.count_if(F.col("conv_id") == F.col("rep")).alias("owned"))
    last = cut_lineage(last.select(F.col("conv_id").alias("of"), "last", "owned"))
    own = members.where(F.col("conv_id") == F.col("rep"))
    # a conversation owns the nodes from some depth to its end, so a member adds what it owns from a node's depth on
    stretch = F.shiftright("depth", BLOCK.bit_length() - 1)
    spread = last.select("of", "last", "owned", F.explode(F.sequence(_zero(), F.shiftright("last", BLOCK.bit_length() - 1))).alias("s"))
    with_last = members.withColumn("in_s", stretch).join(spread, (F.col("conv_id") == F.col("of")) & (F.col("in_s") == F.col("s")))
    with_last = cut_lineage(with_last.select("conv_id", "depth", "rep", "last", "owned"))
    sizes = with_last.where("owned > 0").groupBy(F.col("rep").alias("z_conv"), F.col("depth").alias("z_depth")).agg(
        F.sum(F.least("owned", F.col("last") - F.col("depth") + 1)).alias("size")
    )
    # only conversations that own nodes are ever asked for their paths
    paths = with_last.where("owned > 0").select(F.col("conv_id").alias("path_conv"), F.col("depth").alias("path_depth"), "rep")
    following = paths.select(F.col("path_conv").alias("f_conv"), (F.col("path_depth") - 1).alias("f_depth"), F.col("rep").alias("next"))
    paths = paths.join(following, (F.col("path_conv") == F.col("f_conv")) & (F.col("path_depth") == F.col("f_depth")), "left")
    paths = cut_lineage(paths.drop("f_conv", "f_depth"))
    up = paths.select(F.col("path_conv").alias("u_conv"), (F.col("path_depth") + 1).alias("u_depth"), F.col("rep").alias("parent_conv"))
    nodes = own.join(sizes, (F.col("conv_id") == F.col("z_conv")) & (F.col("depth") == F.col("z_depth")))
    nodes = nodes.join(up, (F.col("conv_id") == F.col("u_conv")) & (F.col("depth") == F.col("u_depth")), "left")
    saved = (F.col("n_convs") - 1) * F.col("text_bytes")
    nodes = cut_lineage(nodes.select(*_NODE, "parent_conv", "n_convs", "size", (F.col("size") == 1).cast("long").alias("leaf"), saved.alias("saved")))
    children = nodes.where("depth > 0").groupBy(F.col("parent_conv").alias("p_conv"), (F.col("depth") - 1).alias("p_depth"))
    children = children.agg(F.count("*").alias("n_children"))
    sums = rolled_up(nodes.drop("n_convs"), paths, ["leaf", "saved"], task_nodes)
    sums = sums.select(F.col("conv_id").alias("s_conv"), F.col("depth").alias("s_depth"), F.col("all_leaf").alias("n_leaves"), F.col("all_saved").alias("saved_tokens"))
    ends = _ends_digest(with_last.where("depth = last").select("conv_id", "rep", "depth"))
    out = nodes.join(sums, (F.col("conv_id") == F.col("s_conv")) & (F.col("depth") == F.col("s_depth")))
    out = out.join(children, (F.col("conv_id") == F.col("p_conv")) & (F.col("depth") == F.col("p_depth")), "left")
    out = out.join(ends, (F.col("conv_id") == F.col("e_conv")) & (F.col("depth") == F.col("e_depth")), "left")
    return out.select(
        *_NODE, F.col("parent_conv").alias("parent_conv_id"), "n_convs", F.coalesce("n_children", _zero()).alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, task_nodes: int = TASK_NODES) -> DataFrame:
    """``prefix_trie`` of ``conversations`` (conv_id, turn, role, text) as they are."""
    turns = cut_lineage(ordered_turns(conversations))
    return prefix_trie(turns.select("conv_id").distinct(), turns, task_nodes)


def rebuilt_trie(conversations: DataFrame, task_nodes: int = TASK_NODES) -> DataFrame:
    """``prefix_trie`` of the conversations that ``spliced`` rebuilds, those left without turns included."""
    return prefix_trie(*spliced(ordered_turns(conversations)), task_nodes)
