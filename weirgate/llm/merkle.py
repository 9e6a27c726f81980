"""A Merkle tree over the rows of a table, one subtree per group, with a proof for every row.

A run of ``FANOUT`` consecutive nodes is one parent. Each level is a slot pivot: a conditional aggregate for each
slot spreads the children of a run into as many columns, and the concatenated columns give the parent's digest. A
row of slot columns also holds all that its children's proofs need of this level: the columns before the own slot
and those after it. So the proofs are made on the way down, where each run hands its children their siblings
behind those it got from its own parent, and leaves meet no table but the row of their run.

Positions within a group come from a range partitioning and sums over its partitions, so a group of any size
spreads over tasks; a run is a key of its own. What reaches the driver is the size of the largest group, which
gives the number of levels, and the root.

Nulls: a null field is ``-`` in its row's digest; a null group is a group, the first one; a null id comes before all
others. Rows of one id go by their digest; equal rows are leaves of their own, next to each other. Empty texts and
texts of any length are digested whole. An empty table has no root and no rows. Columns that are not named take no part.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import stage
from weirgate.operators.ordinals import with_ordinal

FANOUT = 16
_SLOTS = [f"s{j}" for j in range(FANOUT)]
_PATH = "array<struct<before:string,after:string>>"


@dataclass(frozen=True)
class Manifest:
    """``proofs``: group, id, digest, other, subroot and path, one row per leaf; a path has a (before, after) per level.

    ``root`` is None for a table without rows.
    """

    proofs: DataFrame
    subroots: DataFrame
    root: str | None


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf(fields: Sequence[Column]) -> Column:
    """The digest of a row: each field as ``-`` if null, else its length in bytes, a colon and its text."""
    told = [c.cast("string") for c in fields]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in told]))


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf's digest and its siblings lead to."""
    return F.aggregate(path, start, lambda below, level: digest(F.concat(level["before"], below, level["after"])))


def siblings(path: Column) -> Column:
    """The digests beside the way to the root, from the leaf upwards and from left to right."""
    return F.array_join(F.transform(path, lambda level: F.concat(level["before"], level["after"])), "")


def _joined(slots: Sequence[str]) -> str:
    return f"concat_ws({', '.join(["''", *[f'{s}.digest' for s in slots]])})"


#: What a run says of each of its children: position, node, and the siblings before and after it.
_CHILDREN = "array({})".format(
    ", ".join(
        f"struct(run * {FANOUT} + {j} AS i, {s} AS node, struct({_joined(_SLOTS[:j])} AS before, {_joined(_SLOTS[j + 1:])} AS after) AS level)"
        for j, s in enumerate(_SLOTS)
    )
)


def _runs(nodes: DataFrame) -> DataFrame:
    """(tree, n, i, node) become (tree, n, run, a column for each slot)."""
    spread = [F.expr(f"max(CASE WHEN i % {FANOUT} = {j} THEN node END) AS {s}") for j, s in enumerate(_SLOTS)]
    return nodes.groupBy("tree", "n", F.expr(f"i div {FANOUT}").alias("run")).agg(*spread)


def _climb(leaves: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame]:
    """The runs of all levels, and (tree, node) of each tree's top; ``most`` is the size of the largest tree."""
    levels, nodes = [], leaves
    tops = leaves.where("n = 1").select("tree", F.col("node.digest").alias("digest"))
    while most > 1:
        levels.append(stage(_runs(nodes.where("n > 1")), "runs"))
        parent = F.struct(digest(F.expr(_joined(_SLOTS))).alias("digest"))
        nodes = levels[-1].select("tree", F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"), F.col("run").alias("i"), parent.alias("node"))
        tops = tops.union(nodes.where("n = 1").select("tree", F.col("node.digest")))
        most = -(-most // FANOUT)
    return levels, tops


def _descend(levels: Sequence[DataFrame], leaves: DataFrame, above: DataFrame) -> DataFrame:
    """(tree, node, top, path) of every leaf; ``above`` has (tree, top, path), the path from a tree's top on."""
    lone = leaves.where("n = 1").join(above, "tree").select("tree", "node", "top", "path")
    paths = None
    for runs in reversed(levels):
        # A tree whose top is the parent of this run starts here; the runs of a larger one got theirs a level above.
        placed = runs.where(f"n <= {FANOUT}").join(above, "tree")
        if paths is not None:
            higher = paths.select("tree", F.col("i").alias("run"), "top", "path")
            placed = placed.unionByName(runs.where(f"n > {FANOUT}").join(higher, ["tree", "run"]))
        held = F.expr(f"filter({_CHILDREN}, c -> c.node IS NOT NULL)")
        each = placed.select("tree", "top", "path", F.explode(held).alias("c"))
        paths = each.select("tree", "c.i", "c.node", "top", F.concat(F.array("c.level"), "path").alias("path"))
    return lone if paths is None else lone.unionByName(paths.drop("i"))


def manifest(rows: DataFrame) -> Manifest:
    """The tree over ``rows`` (group, id, digest, other); ``other`` is any text that goes with a leaf."""
    rows = rows.select("group", "id", "digest", "other")
    tree = F.coalesce(F.concat(F.lit("="), F.col("group").cast("string")), F.lit(""))
    node = F.struct("digest", "id", "other")
    ordered = with_ordinal(rows, ["id", "digest"], ["group"])
    placed = ordered.select(tree.alias("tree"), F.col("group_rows").alias("n"), F.col("ordinal").alias("i"), node.alias("node"))
    leaves = stage(placed, "leaves")
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels, tops = _climb(leaves, most)
    subroots = stage(tops, "subroots")

    named = F.struct("digest", F.col("tree").alias("of"))
    ranked = with_ordinal(subroots, ["tree"])
    trees = stage(ranked.select(F.lit("").alias("tree"), F.col("group_rows").alias("n"), F.col("ordinal").alias("i"), named.alias("node")), "trees")
    upper, top = _climb(trees, trees.agg(F.max("n")).first()[0] or 0)
    found = top.first()
    root = found and found["digest"]
    start = top.select("tree", F.col("digest").alias("top"), F.array().cast(_PATH).alias("path"))
    above = _descend(upper, trees, start).select(F.col("node.of").alias("tree"), F.col("node.digest").alias("top"), "path")
    proofs = _descend(levels, leaves, stage(above, "paths")).select(
        F.when(F.col("tree") != "", F.expr("substring(tree, 2)")).alias("group"),
        "node.id",
        "node.digest",
        "node.other",
        F.col("top").alias("subroot"),
        "path",
    )
    named_subroots = subroots.select(F.when(F.col("tree") != "", F.expr("substring(tree, 2)")).alias("group"), "digest")
    return Manifest(proofs, named_subroots, root)


def audit(proofs: DataFrame, root: str | None) -> DataFrame:
    """id, leaf, subroot, root, proof_sha256, folded_root, verified of each leaf.

    The fold starts from ``other``, the digest of what is to be audited, or from the leaf's own where that is null.
    """
    known = F.lit(root).cast("string")
    folded = proofs.withColumn("folded_root", fold(F.coalesce("other", "digest"), F.col("path")))
    return folded.select(
        "id",
        F.col("digest").alias("leaf"),
        "subroot",
        known.alias("root"),
        digest(siblings(F.col("path"))).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == known).alias("verified"),
    )
