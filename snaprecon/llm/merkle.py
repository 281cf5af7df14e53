"""Merkle manifest of a dataset: trees of three children per group, a tree of the groups' roots, and a proof for each row.

A level of an aligned block of ``BLOCK`` nodes is one hex string, 64 digits a
node. Parents are the hashes of its substrings of three nodes; the siblings of
a node are the substrings that flank it in its run of three. A block makes its
levels in one row, and the topmost nodes of all blocks are the nodes of the
next round, so a tree of N leaves takes log(N) / log(``BLOCK``) rounds, and no
task holds more than a block. The way back gives every block the siblings
above it, once for all its rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaprecon.llm._common import cut
from snaprecon.llm._ranks import positions

FAN = 3
STEPS = 5  # levels that a block climbs
BLOCK = FAN**STEPS
DIGITS = 64  # of a hash in hex
_PATH = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """One value as it enters a leaf: its UTF-8 byte count, ``:`` and itself; ``-`` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """Lowercase hex SHA-256 of the values, each by :func:`field`."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def siblings(path: Column) -> Column:
    """The hashes beside a row's way to the root as one text, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf comes to with these siblings."""
    return F.aggregate(path, start, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def _parents(level: Column) -> Column:
    last = (F.length(level) - 1).cast("int")
    starts = F.sequence(F.lit(1), last + 1, F.lit(FAN * DIGITS))
    return F.array_join(F.transform(starts, lambda at: F.sha2(F.substring(level, at, F.lit(FAN * DIGITS)), 256)), "")


def _blocks(nodes: DataFrame) -> DataFrame:
    """(grp, block, n, items, levels) of the nodes (grp, pos, n, hash, item); the last of the levels is the block's one topmost node."""
    blocks = nodes.groupBy("grp", F.floor(F.col("pos") / BLOCK).alias("block")).agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "hash", "item"))).alias("items"))
    blocks = blocks.withColumn("l0", F.array_join(F.transform("items", lambda i: i["hash"]), ""))
    for step in range(1, STEPS + 1):  # a level has a next one while the group has several nodes on it
        blocks = blocks.withColumn(f"l{step}", F.when(F.col("n") > FAN ** (step - 1), _parents(F.col(f"l{step - 1}"))))
    levels = F.array_compact(F.array(*[F.col(f"l{step}") for step in range(STEPS + 1)]))
    return cut(blocks.select("grp", "block", "n", F.transform("items", lambda i: i["item"]).alias("items"), levels.alias("levels")))


def _steps(levels: Column, at: Column) -> Column:
    """The flanks of node ``at`` of the block's first level, and of its parents, within their runs."""

    def flanks(level: Column, depth: Column) -> Column:
        here = F.floor(at / F.pow(F.lit(FAN), depth)).cast("int")
        run = here - here % FAN
        left = F.substring(level, run * DIGITS + 1, (here - run) * DIGITS)
        right = F.substring(level, (here + 1) * DIGITS + 1, (run + FAN - 1 - here) * DIGITS)
        return F.struct(left.alias("left"), right.alias("right"))

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), flanks)


def _paths(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """(grp, pos, item, subroot, path) of every node, from the ways up of the blocks (grp, block, subroot, path)."""
    rows = blocks.join(above, ["grp", "block"]).select("grp", "block", "levels", "subroot", F.col("path").alias("up"), F.posexplode("items").alias("at", "item"))
    return rows.select("grp", (F.col("block") * BLOCK + F.col("at")).alias("pos"), "item", "subroot", F.concat(_steps(F.col("levels"), F.col("at")), F.col("up")).alias("path"))


def _climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of each round, and (grp, root) of every group of the nodes (grp, pos, n, hash, item)."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    rounds = [_blocks(nodes)]
    while most > BLOCK ** len(rounds):
        up = rounds[-1].where(F.col("n") > BLOCK)
        rounds.append(_blocks(up.select("grp", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).alias("n"), F.element_at("levels", -1).alias("hash"), F.lit(None).cast("string").alias("item"))))
    done = [blocks.where(F.col("n") <= BLOCK).select("grp", F.element_at("levels", -1).alias("root")) for blocks in rounds]
    return rounds, reduce(DataFrame.unionByName, done)


def _descend(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """(grp, pos, item, subroot, path) of the first round's nodes, from the way up of each group's root (grp, subroot, path)."""
    paths = None
    for blocks in reversed(rounds):
        ways = above.join(blocks.where(F.col("n") <= BLOCK).select("grp", "block"), "grp").select("grp", "block", "subroot", "path")
        if paths is not None:
            ways = ways.unionByName(paths.select("grp", F.col("pos").alias("block"), "subroot", "path"))
        paths = _paths(blocks, ways)
    return paths


def manifest(leaves: DataFrame, group: str, order: list[str], keep: list[str]) -> DataFrame:
    """``keep``'s columns of every row, its leaf, its group's subroot, the root, and its path: the left and right siblings of each level.

    ``leaves`` has a column ``leaf`` (64 hex digits). In each group (null is
    one, and the first) the rows ascend by ``order``, nulls first; while
    several nodes remain, every three (the last run: fewer, even one) become
    the hash of their digits. The groups' subroots, ordered by group as UTF-8
    bytes, likewise make the root; a lone leaf is its own root. Rows equal in
    ``order`` stand side by side, and repeated rows are leaves of their own.
    An empty table gives no rows.
    """
    grp = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))  # sorts as the group does, null first
    rows = leaves.select(grp.alias("grp"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.col("leaf").alias("hash"), F.struct(*keep).alias("item"))
    placed = positions(rows, "grp", [f"o{i}" for i in range(len(order))]).select("grp", "pos", "n", "hash", "item")
    rounds, subroots = _climb(cut(placed))
    tops = positions(subroots.select(F.lit("=").alias("all"), F.col("grp").alias("item"), F.col("root").alias("hash")), "all", ["item"])
    top_rounds, root = _climb(cut(tops.select(F.col("all").alias("grp"), "pos", "n", "hash", F.struct("item", "hash").alias("item"))))
    root = [r["root"] for r in root.collect()]  # one, or none of an empty table
    start = tops.sparkSession.createDataFrame([("=", None, [])], f"grp string, subroot string, path {_PATH}")
    above = cut(_descend(top_rounds, start).select(F.col("item.item").alias("grp"), F.col("item.hash").alias("subroot"), "path"))
    found = _descend(rounds, above)
    return found.select(*[F.col("item")[c].alias(c) for c in keep], "subroot", F.lit(root[0] if root else None).cast("string").alias("root"), "path")
