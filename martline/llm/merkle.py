"""Merkle manifest of a dataset: leaves per group, roots of groups, one root, and proofs.

Leaves are numbered within their group and cut into aligned blocks.  A block
keeps each level of its tree as one string of fixed-width digests: parents are
hashes of fixed-width pieces of it, and the pieces beside a node's own are its
siblings.  The blocks' roots are the leaves of the next round, until every
group has one; the groups' roots then make a tree of their own.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.llm.common import packed, unpacked, written
from martline.operators.keys import sequence_number
from martline.session import checked_broadcast

#: Levels of a block: it holds 2 ** LEVELS leaves at most.
LEVELS = 9
#: Hexadecimal digits of a digest.
WIDTH = 64


def field(value: Column) -> Column:
    """A value that cannot run into the next one: ``-`` for null, else its UTF-8 byte count, a colon and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    """Digest of a row: SHA-256 of its fields one after another."""
    return F.sha2(F.concat(*map(field, values)), 256)


def tree_levels(leaves: Column) -> Column:
    """Levels above so many leaves: how often they must be halved, rounding up, until one is left."""
    return F.when(leaves > 1, F.length(F.bin(leaves - 1))).otherwise(F.lit(0))


def _piece(level: Column, node: Column) -> Column:
    """The digest of a node (0, 1, ...) of a level, empty behind its end."""
    return F.substring(level, (node * WIDTH + 1).cast("int"), F.lit(WIDTH))


def _parents(level: Column) -> Column:
    """The next level: the hash of every two digests, the last one alone if it has no neighbour."""
    pairs = ((F.octet_length(level) + (2 * WIDTH - 1)) / (2 * WIDTH)).cast("int")
    hashed = F.transform(F.sequence(F.lit(0), pairs - 1),
                         lambda n: F.sha2(F.substring(level, n * (2 * WIDTH) + 1, F.lit(2 * WIDTH)), 256))
    return F.array_join(hashed, "").cast("binary")  # of a binary value, pieces are cut without counting characters


def _siblings(levels: Column, place: Column) -> Column:
    """The digests beside a leaf's path, from the bottom, one after another."""
    beside = F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1),
                         lambda level, i: _piece(level, F.call_function("shiftright", place, i).bitwiseXOR(F.lit(1))).cast("string"))
    return F.array_join(beside, "")


@dataclass
class Tree:
    """``proofs``: the rows with ``_path`` (siblings up to their group's root) and ``_n``; ``roots``: ``_g, _root, _count``."""

    proofs: DataFrame
    roots: DataFrame


def _tree(leaves: DataFrame) -> Tree:
    """Trees of ``_g`` over rows ``_g, _leaf, _n`` (numbered from 0 in each group) and any others."""
    rounds: list[DataFrame] = []
    counts = written(leaves.groupBy("_g").agg((F.max("_n") + 1).alias("_count")), "merkle-counts")
    least = checked_broadcast(counts.select(F.col("_g").alias("_cg"), "_count"))
    rows, most = leaves, counts.agg(F.max("_count")).first()[0] or 0
    while True:
        rest = [c for c in rows.columns if c not in ("_g",)]
        blocks = rows.groupBy("_g", F.shiftright("_n", LEVELS).alias("_b")).agg(
            F.sort_array(F.collect_list(F.struct("_n", *[c for c in rest if c != "_n"]))).alias("_items"))
        # A group of one block ends at its root; a block among others has all levels.
        blocks = blocks.join(least, F.col("_g").eqNullSafe(F.col("_cg"))).withColumn(
            "_up", F.when(F.col("_count") <= (1 << LEVELS), tree_levels(F.col("_count"))).otherwise(F.lit(LEVELS)))
        bottom = F.array(F.array_join(F.transform("_items", lambda x: x["_leaf"]), "").cast("binary"))
        levels = F.when(F.col("_up") == 0, bottom).otherwise(F.aggregate(
            F.sequence(F.lit(1), F.greatest(F.col("_up"), F.lit(1))), bottom,
            lambda levels, _: F.concat(levels, F.array(_parents(F.element_at(levels, -1))))))
        rounds.append(written(blocks.select("_g", "_b", "_items", levels.alias("_levels")), "merkle-blocks"))
        top = rounds[-1].select("_g", F.col("_b").alias("_n"), F.element_at("_levels", -1).cast("string").alias("_leaf"))
        if most <= 1 << LEVELS:
            break
        rows, most = top, -(-most >> LEVELS)
        least = checked_broadcast(written(rows.groupBy("_g").agg((F.max("_n") + 1).alias("_count")), "merkle-counts")
                                  .select(F.col("_g").alias("_cg"), "_count"))
    roots = top.select("_g", F.col("_leaf").alias("_root")).join(
        counts.withColumnRenamed("_g", "_cg"), F.col("_g").eqNullSafe(F.col("_cg"))).drop("_cg")
    above = None
    for blocks in reversed(rounds):  # from the top: what lies beside a block's root comes from the round above
        if above is not None:
            blocks = blocks.join(above, F.col("_g").eqNullSafe(F.col("_ag")) & (F.col("_b") == F.col("_ab")))
        path = F.lit("") if above is None else F.col("_above")
        found = blocks.select("_g", path.alias("_above"), F.inline("_items"), "_levels", "_b")
        place = F.col("_n") - F.shiftleft("_b", LEVELS)
        proofs = found.withColumn("_path", F.concat(_siblings(F.col("_levels"), place), "_above")).drop("_above", "_levels", "_b")
        above = proofs.select(F.col("_g").alias("_ag"), F.col("_n").alias("_ab"), F.col("_path").alias("_above"))
    return Tree(proofs, roots)


def merkle_proofs(leaves: DataFrame, key: str, group: str, leaf: str = "leaf") -> DataFrame:
    """Input columns plus ``position, leaves, subroot, subtree, subtrees, root, proof``.

    Leaves ascend by key in their group, nulls first, rows of one key by their
    digest; ``position`` is their place, from 0, among the group's ``leaves``.
    Groups ascend bytewise, null (a group of its own) first; ``subtree`` is a
    group's place among all ``subtrees``.  ``proof`` holds the siblings up to
    the group's root and from there to the root, digest after digest (empty
    for the only leaf).  Repeated rows are leaves of their own; an empty table
    gives an empty result; a null leaf is an error.  Pass narrow rows: all
    columns are carried.  Input columns with a result's name are replaced.
    """
    row = packed(leaves)
    inner = row.select("_row", F.col("_row").getField(group).cast("string").alias("_g"), F.col("_row").getField(key).alias("_k"),
                       F.coalesce(F.col("_row").getField(leaf), F.raise_error(F.lit("a leaf is null")).cast("string")).alias("_leaf"))
    numbered = sequence_number(written(inner, "merkle-leaves"), ["_g"], ["_k", "_leaf"], name="_n")
    low = _tree(numbered.select("_row", "_g", "_leaf", (F.col("_n") - 1).alias("_n")))
    groups = low.roots.select(F.lit("all").alias("_t"), "_g", F.col("_root").alias("_leaf"), "_count")
    ranked = sequence_number(groups, ["_t"], ["_g"], name="_n")
    high = _tree(ranked.select(F.col("_t").alias("_g"), F.col("_g").alias("_name"), "_leaf", "_count", (F.col("_n") - 1).alias("_n")))
    top = high.roots.select(F.col("_g").alias("_t"), F.col("_root"), F.col("_count").alias("_subtrees"))
    # One row, so a broadcast of fixed size.
    known = high.proofs.join(F.broadcast(top), F.col("_g") == F.col("_t")).select(
        F.col("_name").alias("_hg"), F.col("_leaf").alias("_subroot"), F.col("_n").alias("_subtree"), "_subtrees", "_root",
        F.col("_path").alias("_upper"), "_count")
    known = checked_broadcast(written(known, "merkle-groups"))
    return unpacked(low.proofs.join(known, F.col("_g").eqNullSafe(F.col("_hg"))), {
        "position": F.col("_n"), "leaves": F.col("_count"), "subroot": F.col("_subroot"), "subtree": F.col("_subtree"),
        "subtrees": F.col("_subtrees"), "root": F.col("_root"), "proof": F.concat("_path", "_upper")})


def folded_root(leaf: Column, position: Column, leaves: Column, subtree: Column, subtrees: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of its proof give; the dataset's root if nothing was changed."""
    start = F.struct(leaf.alias("digest"), F.lit(0).alias("used"))

    def climb(state: Column, node: Column, count: Column) -> Column:
        """One tree, from its bottom: the neighbour is hashed on its side where there is one."""
        def step(s: Column, level: Column) -> Column:
            at = F.call_function("shiftright", node, level)
            beside = at.bitwiseXOR(F.lit(1))
            last = F.call_function("shiftright", count - 1, level)
            sibling = F.when(beside <= last, F.substring(proof, s["used"] * WIDTH + 1, F.lit(WIDTH))).otherwise(F.lit(""))
            both = F.when(at % 2 == 0, F.concat(s["digest"], sibling)).otherwise(F.concat(sibling, s["digest"]))
            return F.struct(F.sha2(both, 256).alias("digest"), (s["used"] + F.when(beside <= last, 1).otherwise(0)).alias("used"))

        steps = F.slice(F.sequence(F.lit(0), F.greatest(tree_levels(count), F.lit(1))), F.lit(1), tree_levels(count))
        return F.aggregate(steps, state, step)

    ends = reduce(lambda state, tree: climb(state, *tree), [(position, leaves), (subtree, subtrees)], start)
    return ends["digest"]
