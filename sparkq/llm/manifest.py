"""A Merkle manifest of a table, with a proof for every row.

A row's leaf is a digest of its fields. Leaves of a group ascend by an order column;
two neighbours at a time (a last one alone) become the digest of their digests until
the group's subroot is left, and the subroots become the root likewise.

Leaves are dealt to superblocks of ``2 ** BITS`` neighbours. A first pass reduces every
superblock to its node. These nodes are the leaves of the next tier, and so on, so that
no task holds more than a superblock. What a superblock needs of the tree outside it are
the siblings of its own way to the root: these outer nodes are cogrouped with its leaves
in ``applyInPandas``, where the local reduction is finished, proofs are joined from inner
and outer siblings, and claimed digests are folded up to a root.

A way upwards is two texts: ``sides`` has a letter for each level (L: the sibling stands
left, R: right, -: none), ``siblings`` the digests of the siblings in that order.

Defined results: a null field counts as ``-``; null groups come first and are a group,
null orders come first in theirs; rows that tie in order ascend by leaf, so equal rows
are leaves of their own in either order. An empty table has no rows and no root.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkq.plans.ordered import row_index
from sparkq.plans.sizing import broadcast_if_small
from sparkq.plans.staging import stage

# A superblock has 2 ** BITS nodes.
BITS = 10
# Hex letters of a digest.
DIGEST = 64


def field(value: Column) -> Column:
    """A field as ``length:value`` in UTF-8 bytes, ``-`` for null."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Iterable[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def levels_above(nodes: list[str], n: int) -> list[list[str]]:
    """The nodes and ``n`` levels above them."""
    levels = [nodes]
    for _ in range(n):
        below = levels[-1]
        levels.append([digest("".join(below[i : i + 2])) for i in range(0, len(below), 2)])
    return levels


def depth(n: int, block: int, bits: int) -> int:
    """Levels inside a superblock of ``n`` nodes: all of them if its group has others."""
    return bits if block > 0 or n == 1 << bits else (n - 1).bit_length()


def ways(levels: list[list[str]], sides: str, siblings: str) -> list[tuple[str, str]]:
    """The way upwards of each node of the lowest level, given that of the top node."""
    above = [(sides, siblings)]
    for nodes in reversed(levels[:-1]):
        here = []
        for i in range(len(nodes)):
            side, sibling = above[i >> 1]
            if i & 1:
                here.append(("L" + side, nodes[i - 1] + sibling))
            elif i + 1 < len(nodes):
                here.append(("R" + side, nodes[i + 1] + sibling))
            else:
                here.append(("-" + side, sibling))
        above = here
    return above


def fold(node: str, sides: str, siblings: str) -> str:
    """The root that ``node`` leads to on a way upwards."""
    at = 0
    for side in sides:
        if side == "-":
            node = digest(node)
            continue
        sibling = siblings[at : at + DIGEST]
        at += DIGEST
        node = digest(sibling + node if side == "L" else node + sibling)
    return node


def in_blocks(nodes: DataFrame, bits: int) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("place", bits))


def nodes_in_order(rows: pd.DataFrame) -> tuple[pd.DataFrame, list[str]]:
    rows = rows.sort_values("place")
    return rows, [d.hex() for d in rows["node"]]


WAY = "sides string, siblings string"
BINARY = "node binary"


def reduced(blocks: DataFrame, bits: int) -> DataFrame:
    """The top node of each superblock, as a node (group, place) of the next tier."""

    def top(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, nodes = nodes_in_order(rows)
        node = levels_above(nodes, depth(len(nodes), key[1], bits))[-1][0]
        return pd.DataFrame({"group": [key[0]], "place": [key[1]], "node": [bytes.fromhex(node)]})

    return blocks.groupBy("group", "block").applyInPandas(top, f"group long, place long, {BINARY}")


def tree(nodes: DataFrame, bits: int) -> DataFrame:
    """The way upwards of every node (group, place, node; staged) and its group's top."""
    blocks = in_blocks(nodes, bits)
    most = nodes.agg(F.max("place")).first()[0] or 0
    if most < 1 << bits:
        outer = blocks.groupBy("group", "block").agg(F.lit("").alias("sides"), F.lit("").alias("siblings"))
        outer = outer.withColumn("top", F.lit(None).cast("string"))
    else:
        tier = stage(reduced(blocks, bits), "manifest-tier")
        outer = tree(tier, bits).withColumnRenamed("place", "block")

    def finish(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows, nodes = nodes_in_order(rows)
        levels = levels_above(nodes, depth(len(nodes), key[1], bits))
        sides, siblings = zip(*ways(levels, above["sides"][0], above["siblings"][0]))
        top = above["top"][0] or levels[-1][0]
        return pd.DataFrame({"group": key[0], "place": rows["place"], "sides": sides, "siblings": siblings, "top": top})

    return cogrouped(blocks, outer).applyInPandas(finish, f"group long, place long, {WAY}, top string")


def cogrouped(blocks: DataFrame, outer: DataFrame):
    return blocks.groupBy("group", "block").cogroup(outer.groupBy("group", "block"))


def manifest(
    docs: DataFrame,
    fields: Sequence[str],
    order: str,
    group: str,
    claim: Column | None = None,
    bits: int = BITS,
) -> DataFrame:
    """A row for each row of ``docs``: the column ``order``, leaf, subroot, root, sides,
    siblings (the proof), folded_root and verified.

    The leaf is made of ``fields``. ``claim`` is the digest that is folded with the
    proof, where it is not null; else the leaf is. ``verified`` says whether that
    leads to the root.
    """
    quoted = [F.col(f"`{c}`") for c in fields]
    claimed = F.lit(None).cast("string") if claim is None else claim
    leaves = stage(
        docs.select(
            F.col(f"`{order}`").alias("id"),
            F.col(f"`{group}`").alias("name"),
            F.unhex(leaf_digest(quoted)).alias("node"),
            F.unhex(claimed).alias("claim"),
        ),
        "manifest-leaves",
    )
    placed = row_index(leaves, ["name", "id", "node"], "nth")
    groups = stage(placed.groupBy("name").agg(F.min("nth").alias("first")), "manifest-groups")
    groups = stage(row_index(groups, ["name"], "group"), "manifest-groups")
    known = broadcast_if_small(groups)
    leaves = stage(
        placed.join(known, placed["name"].eqNullSafe(known["name"])).select(
            "id", "group", (F.col("nth") - F.col("first")).alias("place"), "node", "claim"
        ),
        "manifest-placed",
    )
    blocks = in_blocks(leaves, bits)

    tier = stage(reduced(blocks, bits), "manifest-tier")
    inside = stage(tree(tier, bits).withColumnRenamed("top", "subroot"), "manifest-ways")
    subroots = inside.where("place = 0").select(
        F.lit(0).cast("long").alias("group"), F.col("group").alias("place"), F.unhex("subroot").alias("node")
    )
    across = tree(stage(subroots, "manifest-subroots"), bits).select(
        F.col("place").alias("group"), F.col("sides").alias("s"), F.col("siblings").alias("b"), F.col("top").alias("root")
    )
    outer = inside.join(broadcast_if_small(stage(across, "manifest-ways")), "group").select(
        "group",
        F.col("place").alias("block"),
        F.concat("sides", "s").alias("sides"),
        F.concat("siblings", "b").alias("siblings"),
        "subroot",
        "root",
    )
    columns = ["leaf", "subroot", "root", "sides", "siblings", "folded_root"]

    def finish(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows, nodes = nodes_in_order(rows)
        levels = levels_above(nodes, depth(len(nodes), key[1], bits))
        found = ways(levels, above["sides"][0], above["siblings"][0])
        folded = [fold(c.hex() if c is not None else n, *way) for n, c, way in zip(nodes, rows["claim"], found)]
        values = [nodes, above["subroot"][0], above["root"][0], *zip(*found), folded]
        return pd.DataFrame({"id": rows["id"], **dict(zip(columns, values))})

    kind = leaves.schema["id"].dataType.simpleString()
    result = cogrouped(blocks, outer).applyInPandas(finish, f"id {kind}, " + ", ".join(f"{c} string" for c in columns))
    return result.select(F.col("id").alias(order), *columns, (F.col("folded_root") == F.col("root")).alias("verified"))
