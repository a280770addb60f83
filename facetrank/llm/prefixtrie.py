"""The trie of conversation prefixes, by halving depths.

Turns are known by digests. Going up, neighbouring blocks of 1, 2, 4, ... turns are
named by their halves. Going down, the sequences are cut at half depth: the prefix
at the cut is named by the name of the prefix where its interval starts and the
block from there to the cut. That gives an upper trie and a forest of lower ones,
which share nothing but the cut, and all of them are halved again in one step. So
every prefix has its name after as many steps as the depth has binary digits, however
long a conversation is.

Totals are grafted in the other order. A trie of one level knows its nodes. Two
neighbouring levels of tries are joined by adding what hangs below each node at
the cut to its ancestors in the upper trie, on the path of the smallest member.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetrank.llm.common import stored
from facetrank.llm.sequences import joined_sha256, numbered


def _digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _root() -> Column:
    return F.unhex(F.lit("00"))


def _blocks(turns: DataFrame, depth: int) -> list[DataFrame]:
    """Full blocks of 2**level turns: ``(conv_id, block, name, tokens)``, level by level.

    ``tokens`` are those of a block's last turn.
    """
    level = turns.select("conv_id", (F.col("place") - 1).alias("block"), "name", "tokens")
    levels = [level]
    while 1 << len(levels) <= depth:
        half = F.shiftright("block", 1)
        is_left = F.col("block") % 2 == 0

        def of(column: str, left: bool, on_left: Column = is_left) -> Column:
            return F.max(F.when(on_left if left else ~on_left, F.col(column)))

        pairs = level.groupBy("conv_id", half.alias("half")).agg(
            F.count("*").alias("n"),
            of("name", True).alias("left"),
            of("name", False).alias("right"),
            of("tokens", False).alias("tokens"),
        )
        level = stored(
            pairs.where("n = 2").select(
                "conv_id", F.col("half").alias("block"), _digest(F.col("left"), F.col("right")).alias("name"), "tokens"
            ),
            "blocks",
        )
        levels.append(level)
    return levels


def _prefixes(sequences: DataFrame, turns: DataFrame, depth: int) -> DataFrame:
    """``(conv_id, depth, name, tokens)`` of every prefix, the empty one too."""
    known = sequences.select(
        "conv_id", F.lit(0).cast("bigint").alias("depth"), _root().alias("name"), F.lit(0).cast("bigint").alias("tokens")
    )
    blocks = _blocks(turns, depth)
    for level in reversed(range(len(blocks))):
        # Cuts at odd multiples of 2**level; the interval starts at an even one.
        lower = blocks[level].where(F.col("block") % 2 == 0).select(
            "conv_id",
            F.shiftleft("block", level).alias("depth"),
            F.col("name").alias("block_name"),
            F.col("tokens").alias("own_tokens"),
        )
        cut = lower.join(known.drop("tokens"), ["conv_id", "depth"]).select(
            "conv_id",
            (F.col("depth") + (1 << level)).alias("depth"),
            _digest(F.col("name"), F.col("block_name")).alias("name"),
            F.col("own_tokens").alias("tokens"),
        )
        known = stored(known.unionByName(cut), "prefix_names")
    return known


def _named_nodes(prefixes: DataFrame) -> DataFrame:
    """One row per node: ``(depth, name, rep, n_convs, tokens)``; ``rep`` is its smallest member."""
    return prefixes.groupBy("depth", "name").agg(
        F.min("conv_id").alias("rep"), F.count("*").alias("n_convs"), F.max("tokens").alias("tokens")
    )


def _graft(nodes: DataFrame, paths: DataFrame, depth: int) -> DataFrame:
    """``(rep, depth, n_leaves, saved)`` summed over the subtree of each node.

    ``nodes`` are ``(rep, depth, parent, n_leaves, saved)`` with their own shares;
    ``paths`` are ``(conv_id, depth, rep)``: the nodes on the way of each member.
    """
    totals = nodes
    level = 0
    while 1 << level < depth:
        span = 1 << level
        # What hangs below a node at a cut, from the roots of its lower tries.
        at_cut = F.pmod(F.col("depth") - 1, F.lit(2 * span)) == span
        hanging = (
            totals.where(at_cut)
            .groupBy(F.col("parent").alias("conv_id"), (F.shiftright(F.col("depth") - 2, level)).alias("interval"))
            .agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        )
        above = paths.where(F.col("depth") > 0).withColumn(
            "interval", F.shiftright(F.col("depth") - 1, level)
        )
        grafts = (
            above.join(hanging, ["conv_id", "interval"])
            .groupBy("rep", "depth")
            .agg(F.sum("more_leaves").alias("more_leaves"), F.sum("more_saved").alias("more_saved"))
        )
        totals = stored(
            totals.join(grafts, ["rep", "depth"], "left").select(
                "rep",
                "depth",
                "parent",
                (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            ),
            "grafted",
        )
        level += 1
    # The root stands above all: what hangs below it are the nodes of depth 1.
    below = totals.where("depth = 1").agg(
        F.sum("n_leaves").alias("all_leaves"), F.sum("saved").alias("all_saved")
    )
    root = totals.where("depth = 0").crossJoin(F.broadcast(below)).select(
        "rep",
        "depth",
        "parent",
        (F.col("n_leaves") + F.coalesce("all_leaves", F.lit(0))).alias("n_leaves"),
        (F.col("saved") + F.coalesce("all_saved", F.lit(0))).alias("saved"),
    )
    return totals.where("depth > 0").unionByName(root)


def trie(sequences: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per node of the trie of ``turns``.

    ``sequences`` has a row per ``conv_id``; ``turns`` are ``(conv_id, place, name,
    tokens)`` with places from 1 without gaps; equal turns have equal names. A
    sequence without turns is a member of the root. No sequences, no nodes.

    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256)``; nodes go by their smallest member and depth.
    """
    depth = turns.agg(F.max("place")).first()[0] or 0
    prefixes = _prefixes(sequences, turns, depth)
    nodes = stored(_named_nodes(prefixes), "trie_nodes")
    # The root holds every sequence: its rows need no join.
    root = prefixes.where("depth = 0").crossJoin(
        F.broadcast(nodes.where("depth = 0").select(F.col("rep")))
    ).select("conv_id", "depth", "rep")
    deeper = prefixes.where("depth > 0").join(
        nodes.where("depth > 0").select("depth", "name", "rep"), ["depth", "name"]
    ).select("conv_id", "depth", "rep")
    paths = stored(root.unionByName(deeper), "trie_paths")
    up = paths.select(
        F.col("conv_id").alias("rep"), (F.col("depth") + 1).alias("depth"), F.col("rep").alias("parent")
    )
    placed = nodes.drop("name").join(up, ["rep", "depth"], "left")
    children = (
        placed.where("depth > 0")
        .groupBy(F.col("parent").alias("rep"), (F.col("depth") - 1).alias("depth"))
        .agg(F.count("*").alias("n_children"))
    )
    full = stored(
        placed.join(children, ["rep", "depth"], "left").select(
            "rep", "depth", "parent", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "tokens"
        ),
        "trie_shape",
    )
    own = full.select(
        "rep",
        "depth",
        "parent",
        (F.col("n_children") == 0).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("tokens")).alias("saved"),
    )
    totals = _graft(own, paths, depth)
    # A sequence ends at the deepest node of its path.
    last = paths.groupBy("conv_id").agg(F.max(F.struct("depth", "rep")).alias("last"))
    ends = last.select("conv_id", "last.rep", "last.depth")
    sums = joined_sha256(
        ends, ["rep", "depth"], [F.col("conv_id")], F.col("conv_id").cast("string"), b","
    )
    return (
        full.join(totals.drop("parent"), ["rep", "depth"])
        .join(sums, ["rep", "depth"], "left")
        .select(
            F.col("rep").alias("conv_id"),
            "depth",
            F.col("parent").alias("parent_conv_id"),
            "n_convs",
            "n_children",
            "n_leaves",
            F.col("saved").alias("saved_tokens"),
            F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )


def named_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, place, name, tokens)``: turns in order, named by role and text.

    Turns are ordered by ``turn``, null first, then by name. Null roles and texts are
    empty. Rows without a conv_id belong to no conversation and are left out. Rows
    that repeat a turn stand one after the other. Other columns are ignored.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    light = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        _digest(F.octet_length(role).cast("string"), F.lit(":"), role, text).alias("name"),
        F.char_length(text).cast("bigint").alias("tokens"),
    )
    light = stored(light, "named_turns")
    return numbered(
        light, "conv_id", [F.col("turn").asc_nulls_first(), F.col("name")], "numbered_turns"
    ).select("conv_id", "place", "name", "tokens")
