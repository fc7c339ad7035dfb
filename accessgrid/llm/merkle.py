"""Merkle manifest of a table: a tree for each group, and one over the groups' roots.

Every level is an equijoin of its nodes with their computed sibling places (XOR for two, offsets from
the own slot for more); the nodes in slot zero then emit the parents.  Levels are tables in the shared
folder, each smaller by the number of siblings, so a lost executor costs a part of one level.  Proofs go
the other way: children take their parent's proof and put their siblings before it.  No group is ever
gathered: a language with all rows is as many nodes, found by place.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accessgrid.llm.common import numbered, written

#: Nodes under one parent.
SIBLINGS = 2
#: One row in this many, by CRC-32 of its id, is altered when the manifest is tried.
TAMPERED = 7


def field(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def hashed(*texts: Column) -> Column:
    """Binary SHA-256 of texts written one after the other."""
    return F.unhex(F.sha2(F.concat(*texts), 256))


def as_hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def hash_of(digests: Column) -> Column:
    """Binary SHA-256 of an array of digests, each as hex text."""
    return F.unhex(F.sha2(F.array_join(F.transform(digests, as_hex), ""), 256))


def _height(nodes: int, siblings: int) -> int:
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // siblings), levels + 1
    return levels


def with_siblings(nodes: DataFrame, siblings: int) -> DataFrame:
    """Adds slot and others: the digests of the run's other nodes, from left to right."""
    slot = (F.col("at") % siblings).cast("int")
    theirs = nodes.select(F.col("tree").alias("_tree"), F.col("at").alias("_at"), F.col("digest").alias("_digest"))
    if siblings == 2:
        met = nodes.join(theirs, (F.col("tree") == F.col("_tree")) & (F.col("at").bitwiseXOR(F.lit(1)) == F.col("_at")), "left")
        others = F.filter(F.array("_digest"), lambda d: d.isNotNull())
        return met.select(*nodes.columns, slot.alias("slot"), others.alias("others"))
    run, offsets = F.col("at") - slot, F.sequence(F.lit(1), F.lit(siblings - 1))
    places = nodes.select("tree", "at", F.explode(F.transform(offsets, lambda o: run + (slot + o) % siblings)).alias("_of"))
    found = places.join(theirs, (F.col("tree") == F.col("_tree")) & (F.col("_of") == F.col("_at")))
    each = found.groupBy("tree", "at").agg(F.array_sort(F.collect_list(F.struct("_at", "_digest"))).alias("_found"))
    others = F.coalesce(F.col("_found._digest"), F.array().cast("array<binary>"))
    return nodes.join(each, ["tree", "at"], "left").select(*nodes.columns, slot.alias("slot"), others.alias("others"))


def climb(nodes: DataFrame, height: int, siblings: int) -> tuple[list[DataFrame], DataFrame]:
    """The levels' tables from the lowest up, and (tree, height, digest) of the roots.

    nodes has tree, at (place from 0), nodes (of the tree on this level) and digest; other columns
    stay on the lowest level.  A tree that has come to one node takes no part in the levels above.
    """
    levels: list[DataFrame] = []
    roots = nodes.filter(F.col("nodes") == 1).select("tree", F.lit(0).alias("height"), "digest")
    for level in range(1, height + 1):
        table = written(with_siblings(nodes.filter(F.col("nodes") > 1), siblings))
        levels.append(table)
        # In slot zero all others stand on the right.
        nodes = table.filter(F.col("slot") == 0).select(
            "tree",
            F.floor(F.col("at") / siblings).alias("at"),
            F.ceil(F.col("nodes") / siblings).alias("nodes"),
            hash_of(F.concat(F.array("digest"), "others")).alias("digest"),
        )
        roots = roots.union(nodes.filter(F.col("nodes") == 1).select("tree", F.lit(level).alias("height"), "digest"))
    return levels, roots


def descend(levels: list[DataFrame], tops: DataFrame, siblings: int) -> DataFrame:
    """The lowest level's nodes with path: (slot, others) of each level from their own to the top.

    tops has tree, height, path and what else belongs to each tree's root (`carried`), which its nodes take over.
    """
    carried = [c for c in tops.columns if c not in ("tree", "height", "path")]

    def ending(height: int) -> DataFrame:
        return tops.filter(F.col("height") == height).select("tree", F.lit(0).cast("long").alias("at"), "path", *carried)

    above = ending(len(levels))
    for height in range(len(levels) - 1, -1, -1):
        parents = above.select(F.col("tree").alias("_tree"), F.col("at").alias("_at"), F.col("path").alias("_path"), *carried)
        nodes = levels[height].withColumn("_up", F.floor(F.col("at") / siblings))
        met = nodes.join(parents, (F.col("tree") == F.col("_tree")) & (F.col("_up") == F.col("_at")))
        path = F.concat(F.array(F.struct("slot", "others")), "_path").alias("path")
        above = met.select("tree", "at", path, *carried).union(ending(height))
    return above


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""

    def up(digest: Column, step: Column) -> Column:
        left = F.slice(step["others"], F.lit(1), step["slot"])
        right = F.slice(step["others"], step["slot"] + 1, F.size(step["others"]))
        return hash_of(F.concat(left, F.array(digest), right))

    return F.aggregate(path, leaf, up)


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, from the lowest level up, left to right."""
    return hash_of(F.flatten(F.transform(path, lambda step: step["others"])))


@dataclass(frozen=True)
class Manifest:
    """Proofs of all rows (the rows' columns, digest, subroot, path) and the table's root, as hex."""

    proofs: DataFrame
    root: str | None


def manifest(rows: DataFrame, digest: Column, group: str, order: list[Column], siblings: int = SIBLINGS) -> Manifest:
    """A leaf for each row, a tree for each group in the order given, and a tree of the groups' roots.

    Groups ascend, null first; so do equal rows, whose order changes no result as their leaves are equal
    where the order ends with the digest.  A run's last nodes may be fewer, even one, and still have a
    parent.  A lone leaf is its group's root, a lone group's root the table's.  An empty table has no
    proofs and the root None.  All columns of rows stay, but for those named digest, subroot or path.
    """
    spark = rows.sparkSession
    own = [c for c in rows.columns if c.lower() not in ("digest", "subroot", "path")]
    kept = [F.col(c).alias(f"own {n}") for n, c in enumerate(own)]
    flat = rows.select(*kept, F.col(group).alias("group"), digest.alias("digest"), *[o.alias(f"by {n}") for n, o in enumerate(order)])
    placed = written(numbered(flat, [F.col("group"), *[F.col(f"by {n}") for n in range(len(order))]], "place"))

    sizes = placed.groupBy("group").agg(F.min("place").alias("first"), F.count("*").alias("nodes"))
    groups = written(numbered(sizes, [F.col("group")], "tree"))
    most, trees = groups.agg(F.max("nodes"), F.count("*")).first()
    if not trees:
        out = rows.select(*own, digest.alias("digest")).limit(0)
        path = "array<struct<slot: int, others: array<binary>>>"
        return Manifest(out.withColumn("subroot", F.col("digest")).withColumn("path", F.lit(None).cast(path)), None)

    theirs = groups.select(F.col("group").alias("_group"), "first", "nodes", "tree")
    leaves = placed.join(theirs, F.col("group").eqNullSafe(F.col("_group")))
    leaves = leaves.select("tree", (F.col("place") - F.col("first")).alias("at"), "nodes", "digest", *[f"own {n}" for n in range(len(own))])
    leaves = written(leaves)
    levels, roots = climb(leaves, _height(most, siblings), siblings)
    roots = written(roots)

    upper = roots.select(F.lit(0).alias("tree"), F.col("tree").cast("long").alias("at"), F.lit(trees).alias("nodes"), "digest", "height")
    upper_levels, top = climb(written(upper), _height(trees, siblings), siblings)
    top = top.select("tree", "height", F.array().cast("array<struct<slot: int, others: array<binary>>>").alias("path"), F.col("digest").alias("root"))
    top = written(top)
    root = top.first()["root"]
    over = descend(upper_levels, top.drop("root"), siblings).select(F.col("at").alias("tree"), "path")
    tops = written(roots.join(over, "tree").select("tree", "height", "path", F.col("digest").alias("subroot")))

    paths = descend(levels, tops, siblings)
    proofs = leaves.join(paths, ["tree", "at"])
    back = [F.col(f"own {n}").alias(c) for n, c in enumerate(own)]
    return Manifest(proofs.select(*back, "digest", "subroot", "path"), bytes(root).hex())


def verified_manifest(
    docs: DataFrame, id_col: str = "doc_id", group: str = "lang", fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    altered: str = "n_chars", siblings: int = SIBLINGS,
) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified), a row for each row of docs.

    The manifest is of the rows as they are.  Then one row in TAMPERED, by its id, has one added to
    `altered`, and every row's leaf goes up its proof again: folded_root, verified if that is the root.
    A null in any field is `-`; null ids come first in their group, are never altered and neither are
    null numbers.  Repeated rows are leaves of their own.  Texts are hashed whole where they are read
    and go no further.  Other columns aren't read.  An empty table gives an empty one.
    """
    leaf = hashed(*[field(F.col(c)) for c in fields])
    changed = hashed(*[field(F.try_add(F.col(c), F.lit(1).cast("long")) if c == altered else F.col(c)) for c in fields])
    hit = (F.crc32(F.col(id_col).cast("string")) % TAMPERED == 0) & F.col(altered).isNotNull()
    rows = docs.select(F.col(id_col).alias("id"), F.col(group).alias("group"), leaf.alias("leaf"), F.when(hit, changed).alias("changed"))
    made = manifest(rows, F.col("leaf"), "group", [F.col("id"), F.col("leaf")], siblings)
    again = as_hex(folded(F.coalesce("changed", "leaf"), F.col("path")))
    out = made.proofs.select(
        F.col("id").alias(id_col),
        as_hex(F.col("leaf")).alias("leaf"),
        as_hex(F.col("subroot")).alias("subroot"),
        F.lit(made.root).cast("string").alias("root"),
        as_hex(proof_digest(F.col("path"))).alias("proof_sha256"),
        again.alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
