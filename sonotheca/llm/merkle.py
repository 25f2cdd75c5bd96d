"""A Merkle manifest of a dataset: one hash over all rows, and a proof for every row.

A row is a leaf: the hash of its fields.  Leaves are ranked per group (here the language),
pairs of nodes become their hash level by level until one node is left, and the groups'
roots are joined in the same way to the dataset's root.  A proof lists the siblings on the
way up; whoever holds the root can check a row against it without the other rows.

The tree is built with groupings only.  The last ``LEVELS`` binary digits of a rank name a
place inside a block of ``2 ** LEVELS`` leaves.  Rows are shuffled once by block; the digit
columns are then grouped away one after the other, each time nesting the children as an
array of structs inside their parent.  These groupings need no further shuffle, because the
rows of a block already lie together.  A nested block holds all of its inner nodes, so
transforming and exploding it emits the proofs of all its leaves without a join.  The
roots of the blocks are the leaves of the next tree above, handled alike, until every group
is one block; what a block's root needs to reach the top is handed down by one join on the
block, a row on either side.  No task ever holds more than a block.

Ranks come from range partitions that are counted and then numbered inside, so a group that
holds all rows is still ranked by many tasks.

Nulls and edge cases: a null field counts as ``-``.  Groups are ordered with null first, then
by their UTF-8 bytes.  Within a group, rows ascend by id, null first; rows with one id by their
leaf.  A row that repeats is a leaf each time.  A group of one leaf is its own root, and so is a
single group; a dataset of one row has an empty proof.  An empty table gives no rows.  Other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonotheca.session import written

LEVELS = 8
GROUP_LEVELS = 4
_STEPS = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """A field for hashing: its UTF-8 length, a colon and its text, or a dash for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def hashed(*texts: Column) -> Column:
    """Lower-case hex SHA-256 of the texts one after the other."""
    return F.sha2(F.concat(*texts).cast("binary"), 256)


def ranked(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """Adds ``rank`` (from 0) within the group by ``order``, and ``n``, the size of the group."""
    place = F.monotonically_increasing_id()  # the partition above 33 bits for the row in it
    part = written(
        rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
        .withColumn("_part", F.shiftright(place, 33)).withColumn("_at", place.bitwiseAND((1 << 33) - 1)), "ranked")
    counts = part.groupBy(group, "_part").agg(F.count("*").alias("_own"), F.min("_at").alias("_first"))
    groups = Window.partitionBy(group)
    before = counts.select(  # one row a group and range partition
        group, "_part", F.sum("_own").over(groups).alias("n"),
        (F.sum("_own").over(groups.orderBy("_part")) - F.col("_own") - F.col("_first")).alias("_before"))
    return (part.join(written(before, "counts"), ["_part", group])
            .withColumn("rank", F.col("_before") + F.col("_at")).drop("_part", "_at", "_before"))


def _digit(level: int) -> str:
    return f"_d{level}"


def _above(n: str, levels: int) -> Column:
    """How many nodes ``n`` nodes have become so many levels up."""
    return F.shiftright(F.col(n) + ((1 << levels) - 1), levels)


def blocks(nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Blocks of ``2 ** levels`` consecutive nodes of a tree, nested.

    ``nodes`` holds ``tree, rank, n`` (nodes of that tree), ``hash`` and ``payload``.  The result
    has ``tree, rank`` and ``n`` of the blocks, their ``hash``, and the nested ``node``.
    """
    rank = F.col("rank")
    digits = [F.shiftright(rank, level).bitwiseAND(1).cast("int").alias(_digit(level)) for level in range(levels)]
    leaf = F.struct(F.col("hash"), F.col("payload"))
    rows = nodes.select(
        "tree", F.shiftright(rank, levels).alias("block"), "n", *digits, leaf.alias("node")
    ).repartition("tree", "block")
    for level in range(levels):
        upper = [_digit(above) for above in range(level + 1, levels)]
        below = F.struct(F.col(_digit(level)).alias("digit"), F.col("node.hash").alias("hash"), F.col("node").alias("node"))
        grouped = rows.groupBy("tree", "block", "n", *upper).agg(F.array_sort(F.collect_list(below), _by_digit).alias("kids"))
        # nodes of the tree at this level; the last one left is passed up as it is
        here = _above("n", level)
        both = F.array_join(F.transform("kids", lambda kid: kid["hash"]), "")
        up = F.when(here > 1, hashed(both)).otherwise(F.get("kids", F.lit(0))["hash"])
        rows = grouped.select("tree", "block", "n", *upper, F.struct(up.alias("hash"), (here > 1).alias("joined"), F.col("kids")).alias("node"))
    return rows.select(
        "tree", F.col("block").alias("rank"), _above("n", levels).alias("n"), F.col("node.hash").alias("hash"), "node")


def _by_digit(a: Column, b: Column) -> Column:
    return a["digit"] - b["digit"]


def _steps(node: Column) -> Column:
    """The children of a nested node, each with the step that leads from it to its parent."""
    def other(kid: Column, side: int) -> Column:
        beside = F.filter(node["kids"], lambda k: (k["digit"] == side) & (kid["digit"] != side))
        return F.coalesce(F.get(beside, F.lit(0))["hash"], F.lit(""))

    def step(kid: Column) -> Column:
        both = F.array(F.struct(other(kid, 0).alias("left"), other(kid, 1).alias("right")))
        return F.struct(kid["node"].alias("node"), F.when(node["joined"], both).otherwise(F.array().cast(_STEPS)).alias("own"))

    return F.transform(node["kids"], step)


def unnested(nested: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``tree, subroot, hash, payload, steps``: a row for every leaf of blocks that carry the ``steps`` of their root."""
    rows = nested.select("tree", "subroot", "node", "steps")
    for _ in range(levels):
        kids = rows.select("tree", "subroot", "steps", F.explode(_steps(F.col("node"))).alias("_kid"))
        rows = kids.select("tree", "subroot", F.col("_kid.node").alias("node"), F.concat("_kid.own", "steps").alias("steps"))
    return rows.select("tree", "subroot", "node.hash", "node.payload", "steps")


def _tree(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The nested blocks of every storey, and ``tree, hash`` of the roots."""
    storeys = []
    while True:
        nested = written(blocks(nodes, levels), "blocks")
        storeys.append(nested)
        if (nested.agg(F.max("n")).first()[0] or 0) <= 1:
            return storeys, nested.select("tree", "hash")
        nodes = nested.select("tree", "rank", "n", "hash", F.struct("rank").alias("payload"))


def _handed_down(storeys: list[DataFrame], tops: DataFrame, levels: int) -> DataFrame:
    """The leaves of all trees with their steps; ``tops`` holds ``tree, subroot`` and the ``steps`` of a tree's root."""
    found = tops.withColumn("payload", F.struct(F.lit(0).cast("bigint").alias("rank")))
    for nested in reversed(storeys):
        steps = found.select("tree", "subroot", F.col("payload.rank").alias("rank"), "steps")
        found = unnested(nested.join(steps, ["tree", "rank"]), levels)
    return found


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(steps, leaf, lambda node, step: hashed(step["left"], node, step["right"]))


def proof_hash(steps: Column) -> Column:
    """The hash of all siblings of a proof, bottom to top, left to right."""
    return hashed(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""))


def manifest(rows: DataFrame, payload: list[str], levels: int = LEVELS) -> DataFrame:
    """``payload`` of every row with ``leaf``, ``subroot``, ``root`` and its proof ``steps``.

    ``rows`` holds the tree ``grp`` (nullable string), the order ``id``, the hash ``leaf`` and
    the columns ``payload``.  A step is a pair of sibling hashes ``left`` and ``right`` of which
    at most one is not empty.
    """
    # a null group is named "0" and sorts before all others, which start with "1"
    named = written(rows.select(
        F.coalesce(F.concat(F.lit("1"), F.col("grp")), F.lit("0")).alias("tree"), F.col("id").alias("_id"),
        F.col("leaf").alias("hash"), F.struct(*payload).alias("payload")), "leaves")
    storeys, subroots = _tree(ranked(named, "tree", "_id", "hash").drop("_id"), levels)
    # the groups' roots are the leaves of one more tree
    top = ranked(subroots.select(F.lit("all").alias("tree"), F.col("tree").alias("grp"), "hash"), "tree", "grp")
    few = min(levels, GROUP_LEVELS)
    upper, root = _tree(top.select("tree", "rank", "n", "hash", F.struct("grp").alias("payload")), few)
    begun = root.select("tree", F.col("hash").alias("subroot"), F.array().cast(_STEPS).alias("steps"))
    tops = written(_handed_down(upper, begun, few).select(
        F.col("payload.grp").alias("tree"), F.col("hash").alias("subroot"), "steps"), "subroots")
    whole = root.first()
    return _handed_down(storeys, tops, levels).select(
        "payload.*", F.col("hash").alias("leaf"), "subroot",
        F.lit(whole["hash"] if whole else None).cast("string").alias("root"), "steps")
