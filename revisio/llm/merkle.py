"""Merkle manifest of a dataset, proved through the stored preimages of its parents.

Each row is a leaf. The leaves of a tree stand in order; every `ARITY` neighbours become one
parent, whose preimage, the children's digests end to end, is stored beside its own digest.
One tree for each source gives its subroot, and one tree over the subroots gives the root.

A node's place in its parent's preimage is a slot of 64 characters. Cutting the slot out leaves
its siblings, and putting another digest between the two pieces is the parent's preimage after
a change: from the top down each level's nodes join the preimages of the level above, so that a
leaf ends with the pieces of all its ancestors and folds any replacement up to the root alone.

Places in a tree are prefix sums: rows are dealt by range of (source, order), numbered inside
their range, and shifted by what earlier ranges hold of the source. No source is ever one task's
work, and texts are hashed where they are read and never move.

Defined results. Null fields are `-`; a null source is a source of its own, before all others;
null ids stand before all other ids and are never tampered with. Rows that share an id are
leaves each, in the order of their digests. A source of one row: its leaf is the subroot; one
source: its subroot is the root; no row at all: no row. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revisio.plans.lineage import Scratch

ARITY, DIGEST = 3, 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<before:string,after:string>>"
_TALLEST = 39  # levels that a long can number
_MASK = (1 << 33) - 1  # monotonically_increasing_id: the place inside a partition


def field(value: Column) -> Column:
    """A value so that no two rows read alike: `-` for null, else its bytes' number, a colon, itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(**changed: Column) -> Column:
    """The digest of a row, with other values for the fields named."""
    return digest(*(field(changed.get(c, F.col(c))) for c in FIELDS))


def source_key(source: Column) -> Column:
    """Sources in the order of their bytes, null before all."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit(""))


def placed(scratch: Scratch, rows: DataFrame, tree: str, order: list[str], name: str) -> DataFrame:
    """rows with idx (from 0, in their tree by `order`) and n, the tree's number of rows."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, tree, *order).sortWithinPartitions(tree, *order)
    at = F.monotonically_increasing_id()
    dealt = scratch.cut(dealt.select("*", F.shiftright(at, 33).alias("part"), at.bitwiseAND(F.lit(_MASK)).alias("seq")), f"{name}-dealt")
    held = dealt.groupBy(tree, "part").agg(F.count("*").alias("here"), F.min("seq").alias("first"))
    ranges = Window.partitionBy(tree)  # a row for each range that holds the tree, however many rows it has
    shift = F.sum("here").over(ranges.orderBy("part")) - F.col("here") - F.col("first")
    held = held.select(tree, "part", shift.alias("shift"), F.sum("here").over(ranges).alias("n"))
    return dealt.join(held, [tree, "part"]).select(*rows.columns, (F.col("seq") + F.col("shift")).alias("idx"), "n")


@dataclass
class Forest:
    """Levels of nodes (tree, idx, n, hash, preimage) from the leaves' parents on, and the top node of each tree."""

    leaves: DataFrame
    levels: list[DataFrame]
    heights: set[int]

    def tops(self, tree: str) -> DataFrame:
        """(tree, hash) of each tree's last node."""
        found = [(self.levels[k - 1] if k else self.leaves).where("n = 1").select(tree, "hash") for k in sorted(self.heights)]
        return reduce(DataFrame.union, found or [self.leaves.select(tree, "hash")])

    def paths(self, above: DataFrame, tree: str) -> DataFrame:
        """The leaves with `path`, the pieces around their own and their ancestors' slots, and what else `above` says of their tree.

        above: (tree, path, ...), the path of each tree's top. It joins one node of a tree and is
        handed down, so that no large tree is joined by its name.
        """
        told = [c for c in above.columns if c != tree]
        path = None
        for k in range(len(self.levels), -1, -1):
            nodes = (self.levels[k - 1].withColumnRenamed("preimage", "own") if k else self.leaves).withColumn("up", F.when(F.col("n") > 1, F.expr(f"idx div {ARITY}")).otherwise(F.lit(-1)))
            if k in self.heights or path is None:
                tops = nodes.where("n = 1").select(tree, "up").join(above, tree).select(tree, "up", F.lit(None).cast("string").alias("preimage"), *told)
                path = tops if path is None else path.union(tops)
            joined = nodes.join(path, [tree, "up"])
            slot = (F.col("idx") % ARITY * DIGEST).cast("int")
            around = F.struct(F.substring("preimage", F.lit(1), slot).alias("before"), F.substring("preimage", slot + DIGEST + 1, F.lit(ARITY * DIGEST)).alias("after"))
            whole = F.when(F.col("preimage").isNull(), F.col("path")).otherwise(F.concat(F.array(around), F.col("path"))).alias("path")
            told_now = [whole if c == "path" else F.col(c) for c in told]
            if k:
                path = joined.select(tree, F.col("idx").alias("up"), F.col("own").alias("preimage"), *told_now)
        return joined.select(*self.leaves.columns, *told_now)


def grow(scratch: Scratch, leaves: DataFrame, tree: str, name: str) -> Forest:
    """Parents of parents until each tree has one node. leaves: (tree, idx, n, hash, ...)."""
    n = F.col("n")
    height = F.size(F.filter(F.sequence(F.lit(0), F.lit(_TALLEST)), lambda k: n > F.pow(F.lit(ARITY), k)))
    heights = set(leaves.agg(F.collect_set(height)).first()[0])  # a number or two for each order of size
    levels: list[DataFrame] = []
    now = leaves
    for k in range(max(heights, default=0)):
        runs = now.where("n > 1").groupBy(tree, F.expr(f"idx div {ARITY}").alias("idx")).agg(F.array_sort(F.collect_list(F.struct("idx", "hash"))).alias("children"), F.max("n").alias("n"))
        preimage = F.array_join("children.hash", "")
        now = scratch.cut(runs.select(tree, "idx", F.ceil(n / ARITY).alias("n"), F.sha2(preimage, 256).alias("hash"), preimage.alias("preimage")), f"{name}-{k}")
        levels.append(now)
    return Forest(leaves, levels, heights)


def manifest(docs: DataFrame, replacement: Column | None = None) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, path (the pieces around each slot up to the root) and folded_root.

    replacement: the digest that a leaf is folded with; its own where it is null.
    """
    scratch = Scratch(docs.sparkSession, "merkle")
    other = F.lit(None).cast("string") if replacement is None else replacement
    rows = scratch.cut(docs.select("doc_id", source_key(F.col("source")).alias("tree"), leaf().alias("hash"), other.alias("other")), "rows")
    sources = grow(scratch, scratch.cut(placed(scratch, rows, "tree", ["doc_id", "hash"], "rows"), "leaves"), "tree", "sources")
    tops = scratch.cut(sources.tops("tree").select(F.lit("").alias("all"), "tree", "hash"), "tops")
    whole = grow(scratch, scratch.cut(placed(scratch, tops, "all", ["tree"], "tops"), "subroots"), "all", "whole")
    root = whole.tops("all").select("all", F.array().cast(_PATH).alias("path"), F.col("hash").alias("root"))
    above = scratch.cut(whole.paths(root, "all").select("tree", "path", F.col("hash").alias("subroot"), "root"), "above")
    out = sources.paths(above, "tree")
    folded = F.aggregate("path", F.coalesce("other", "hash"), lambda h, x: F.sha2(F.concat(x["before"], h, x["after"]), 256))
    return out.select("doc_id", F.col("hash").alias("leaf"), "subroot", "root", "path", folded.alias("folded_root"))


def proof(path: Column) -> Column:
    """The digest of the siblings alone, from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["before"], x["after"])), ""), 256)


def digests(docs: DataFrame) -> DataFrame:
    """The digest columns: untampered proofs, and what a row whose text lost its line ends folds to."""
    bent = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, leaf(text=F.translate("text", "\n", "")))
    out = manifest(docs, bent)
    return out.select("doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
