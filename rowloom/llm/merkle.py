"""Merkle manifest of a table: one leaf per row, a tree per group, and a tree over the groups.

Every level is a sibling-shift self-join.  Nodes carry (tree, place, size of the level);
the node in slot zero of a run asks for the places next to it (XOR for runs of two, slot
offsets otherwise), an equijoin finds their digests, and the slot-zero row emits the
parent.  What a run's nodes need to prove themselves is passed down from the root in the
same way: a run takes over what its parent's run proved and adds its own digests.

How it scales.  Texts are read once and never shuffled: leaves of 32 bytes are written
and numbered in (group, order) by range partitioning, without a task per group, so a
group that holds a third of the rows is as divided as any other.  All joins are on
(tree, place), of which no value is frequent.  A level has one sixteenth of the rows of
the one below, so the number of rounds is the logarithm of the largest group.  Each
level is a written table.  The driver sees one size per level and the root.

Defined cases: null cells are ``-``; rows of equal order value are ordered by their leaf,
so repeated rows have equal leaves in neighbouring places; null order values come last,
the null group first; an empty table has no rows and no root; columns not named do not
matter.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from rowloom.operators.ordering import dense_index
from rowloom.session import written

ARITY = 16


def digest(text: Column) -> Column:
    """SHA-256 as 32 bytes."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def spelled(raw: Column) -> Column:
    return F.lower(F.hex(raw))


def cell(value: Column) -> Column:
    """``-`` for null, else the length in UTF-8 bytes, ``:`` and the text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(cells: Sequence[Column]) -> Column:
    return digest(F.concat(*[cell(c) for c in cells]))


def next_places(place: Column, arity: int) -> Column:
    """What the node in slot zero asks for: the other places of its run."""
    if arity == 2:
        return F.array(place.bitwiseXOR(F.lit(1).cast("long")))
    return F.transform(F.sequence(F.lit(1), F.lit(arity - 1)), lambda o: place + o)


@dataclass
class Tree:
    """Runs of each level, bottom first (tree, run, n above, nodes), and one root per tree."""

    levels: list[DataFrame]
    roots: DataFrame
    arity: int


def grow(nodes: DataFrame, arity: int = ARITY) -> Tree:
    """``nodes`` of tree, place (0, 1, ...), n (nodes of the tree), digest."""
    levels, roots = [], nodes.where("n = 1").select("tree", "digest")
    nodes = nodes.where("n > 1")
    while (nodes.agg(F.max("n")).first()[0] or 0) > 1:
        run = F.expr(f"place div {arity}")
        heads = nodes.where(F.col("place") % arity == 0)
        asked = heads.select("tree", "n", F.explode(next_places(F.col("place"), arity)).alias("place")).where("place < n")
        siblings = asked.join(nodes.select("tree", "place", "digest"), ["tree", "place"])
        own = heads.select("tree", "place", "n", "digest")
        gathered = (
            own.unionByName(siblings.select("tree", "place", "n", "digest"))
            .groupBy("tree", run.alias("run"), "n")
            .agg(F.sort_array(F.collect_list(F.struct("place", "digest"))).alias("found"))
        )
        runs = gathered.select(
            "tree",
            "run",
            F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
            F.transform("found", lambda x: spelled(x["digest"])).alias("nodes"),
        )
        runs = written(runs, "merkle-runs")
        levels.append(runs)
        parents = runs.select("tree", F.col("run").alias("place"), "n", digest(F.array_join("nodes", "")).alias("digest"))
        roots = roots.unionByName(parents.where("n = 1").select("tree", "digest"))
        nodes = parents.where("n > 1")
    return Tree(levels, written(roots, "merkle-roots"), arity)


def beside(nodes: Column, slot: Column) -> Column:
    """What stands left and right of a slot in its run, as text."""
    left = F.array_join(F.slice(nodes, F.lit(1), slot), "")
    return F.struct(left.alias("left"), F.array_join(F.slice(nodes, slot + 2, F.size(nodes)), "").alias("right"))


def proofs(tree: Tree, above: DataFrame) -> DataFrame | None:
    """tree, run, nodes, ``above`` of each lowest run, what its parent needs level by level, and subroot.

    ``above`` (tree, above, subroot) is what each tree's root needs, and the root itself.
    None if no tree has runs.
    """
    upper = None
    for runs in reversed(tree.levels):
        parts = [runs.where("n = 1").join(above, "tree").select("tree", "run", "nodes", "above", "subroot")]
        if upper is not None:
            place = F.col("run")
            parent = upper.select(
                "tree", F.col("run").alias("parent"), F.col("nodes").alias("around"), F.col("above").alias("higher"), "subroot"
            )
            inner = runs.where("n > 1").withColumn("parent", F.expr(f"run div {tree.arity}")).join(parent, ["tree", "parent"])
            own = F.array(beside(F.col("around"), (place % tree.arity).cast("int")))
            parts.append(inner.select("tree", "run", "nodes", F.concat(own, "higher").alias("above"), "subroot"))
        upper = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        upper = written(upper, "merkle-proofs")
    return upper


@dataclass
class Manifest:
    """A manifest and its proofs.

    ``leaves``: the rows' carried columns, tree, place, n and digest; ``groups``: group,
    tree, n; ``subroots``: tree, digest; ``root`` as hexadecimal text, None without rows.
    """

    leaves: DataFrame
    groups: DataFrame
    subroots: DataFrame
    root: str | None
    below: Tree
    over: Tree

    def proven(self) -> DataFrame:
        """``leaves`` with subroot, and proof: (left, right) texts level by level up to the root."""
        nothing = F.expr("cast(array() as array<struct<left: string, right: string>>)")
        top = self.subroots.select("tree", spelled(F.col("digest")).alias("subroot"))
        top_runs = proofs(self.over, self.over.roots.select("tree", nothing.alias("above"), F.lit("").alias("subroot")))
        places = self.groups.select("tree")
        if top_runs is None:
            above = places.select("tree", nothing.alias("above"))
        else:
            up = top_runs.select(F.col("run").alias("up"), F.col("nodes").alias("around"), F.col("above").alias("higher"))
            own = F.array(beside(F.col("around"), (F.col("tree") % self.over.arity).cast("int")))
            above = places.withColumn("up", F.expr(f"tree div {self.over.arity}")).join(up, "up")
            above = above.select("tree", F.concat(own, "higher").alias("above"))
        above = written(above.join(top, "tree"), "merkle-top")
        alone = self.leaves.where("n = 1").join(above, "tree").withColumnRenamed("above", "proof")
        runs = proofs(self.below, above)
        if runs is None:
            return alone
        at = F.expr(f"place div {self.below.arity}")
        own = F.array(beside(F.col("nodes"), (F.col("place") % self.below.arity).cast("int")))
        many = self.leaves.where("n > 1").withColumn("run", at).join(runs, ["tree", "run"])
        many = many.withColumn("proof", F.concat(own, "above")).drop("run", "nodes", "above")
        return alone.unionByName(many)


def manifest(
    df: DataFrame, columns: Sequence[str], group: str, order: str, carry: dict[str, Column] | None = None, arity: int = ARITY
) -> Manifest:
    """Leaves of ``columns``, a tree per ``group`` in the order of ``order``, and one over the groups.

    ``carry`` names further columns of ``leaves`` (not tree, place, n, digest, group or order).
    """
    own = {"order": F.col(f"`{order}`"), "group": F.col(f"`{group}`"), "digest": leaf_of([F.col(f"`{c}`") for c in columns])}
    leaves = written(df.select(*[c.alias(n) for n, c in {**own, **(carry or {})}.items()]), "merkle-leaves")
    group_first = [F.col("group").isNotNull(), F.col("group")]
    placed = dense_index(leaves, [*group_first, F.col("order"), F.col("digest")], "at")
    sizes = placed.groupBy("group").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    groups = written(dense_index(sizes, group_first, "tree"), "merkle-groups")
    # No hint: a few groups are broadcast by their size on disk, many are joined by a shuffle.
    facts = groups.select(F.col("group").alias("__group"), "tree", "first", "n")
    placed = placed.join(facts, placed["group"].eqNullSafe(F.col("__group")))
    placed = written(placed.withColumn("place", F.col("at") - F.col("first")).drop("at", "first", "__group"), "merkle-placed")
    below = grow(placed.select("tree", "place", "n", "digest"), arity)
    count = below.roots.count()
    over = below.roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(count).cast("long").alias("n"), "digest")
    top = grow(over, arity)
    root = top.roots.select(spelled(F.col("digest"))).first()
    return Manifest(placed, groups, below.roots, root[0] if root else None, below, top)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf (as text) leads to with a proof."""
    return F.aggregate(proof, leaf, lambda node, p: F.sha2(F.concat(p["left"], node, p["right"]).cast("binary"), 256))


def spelled_proof(proof: Column) -> Column:
    """All siblings, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda p: F.concat(p["left"], p["right"])), "")
