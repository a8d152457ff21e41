"""SimHash near-duplicates, found by forests of BK-trees.

Distinct fingerprints are dealt to shards by blocks of their bits: of `blocks` blocks,
every choice of `blocks - spare` blocks is a key, where two fingerprints within `radius`
bits share a key by the pigeonhole rule. A shard's fingerprints form one BK-tree per key:
a node's children are keyed by their integer Hamming distance to it, and a search follows
only edges whose distance is within the radius of the query's. A search also leaves out a
subtree whose nodes are all in the query's own component already, so that a large group
of near copies costs no pairs once it is linked. Each tree gives a spanning set of links
(one per fingerprint at most); components of these are found in Spark.

Shard trees travel with the shuffle instead of a broadcast: together they are as large as
the fingerprints of the whole corpus, which has no bound. A key with more fingerprints than
`tree_size` is split: each pair of parts is a group of its own, where one part's tree meets
the other part's queries. A task reads its groups in order and holds few at a time.

Defined results. Null text and texts without words: fingerprint zero, linked as any other.
Fewer words than a shingle: the whole sequence. Exact copies share a fingerprint and are
one node. Null ids: kept; they never name a component unless all its ids are null.
Repeated rows: kept. Empty table: no rows. Other columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revisio.llm import jaccard
from revisio.llm.keyed import whole_groups
from revisio.llm.tokens import slices
from revisio.operators.components import connected_components
from revisio.plans.lineage import Scratch

SHINGLE, RADIUS, SEED, TREE_SIZE = 4, 4, 42, 20_000
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def _add(counts: np.ndarray, hashes: np.ndarray) -> None:
    octets = hashes.view(np.uint8).reshape(-1, 8)
    if len(hashes) < 300:
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    else:
        counts += np.concatenate([np.bincount(octets[:, k], minlength=256) @ _BITS for k in range(8)])


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64 bits; a bit is set if it is set in over half the shingles' hashes. Long texts go through in slices."""
    counts, n, kept = np.zeros(64, np.int64), 0, []
    for part in slices((text or b"").lower()):
        words = kept + part.split()
        kept = words[max(0, len(words) - shingle + 1) :]
        if len(words) < shingle:
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        begins = np.concatenate(([0], ends[:-1]))[: len(words) - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(begins, (ends[shingle - 1 :] - 1).tolist(), strict=True)], np.uint64)
        _add(counts, hashes)
        n += len(hashes)
    if not n and kept:
        return xxhash.xxh64_intdigest(b" ".join(kept), SEED)
    return _majority(counts, n)


def _majority(counts: np.ndarray, n: int) -> int:
    return int(np.packbits((2 * counts > n).astype(np.uint8), bitorder="little").view("<u8")[0])


def mark(hashes: np.ndarray) -> int:
    """The fingerprint of a set of shingles' hashes, as a signed long."""
    counts = np.zeros(64, np.int64)
    _add(counts, hashes)
    return int(np.uint64(_majority(counts, len(hashes))).view(np.int64))


class Forest:
    """BK-trees over arrays: one tree per group, built level by level for all groups at once."""

    def __init__(self, prints: np.ndarray, groups: np.ndarray):
        self.prints, self.visited = prints, 0  # visited: nodes that searches met
        n = len(prints)
        self.parent, self.edge = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        _, roots = np.unique(groups, return_index=True)
        self.root = roots[np.searchsorted(groups[roots], groups)]
        waiting = np.flatnonzero(self.root != np.arange(n))
        at, self.levels = self.root[waiting], [roots]
        while len(waiting):
            d = np.bitwise_count(prints[waiting] ^ prints[at]).astype(np.int64)
            _, first, place = np.unique(at * 65 + d, return_index=True, return_inverse=True)
            child = waiting[first]
            self.parent[child], self.edge[child] = at[first], d[first]
            self.levels.append(child)
            stay = np.ones(len(waiting), bool)
            stay[first] = False
            waiting, at = waiting[stay], child[place][stay]
        order = np.argsort(self.parent, kind="stable")
        self.kids = order[np.searchsorted(self.parent[order], 0) :]
        self.begin = np.searchsorted(self.parent[self.kids], np.arange(n + 1))

    def uniform(self, label: np.ndarray) -> np.ndarray:
        """The label that a node's whole subtree has, or -1."""
        out = label.copy()
        for level in reversed(self.levels[1:]):
            up = self.parent[level]
            out[up[out[level] != label[up]]] = -1
        return out

    def search(self, queries: np.ndarray, starts: np.ndarray, radius: int, skip: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) within the radius. skip: a label of each query, and the uniform label of each subtree."""
        q, at = np.arange(len(queries)), starts
        hits: list[tuple[np.ndarray, np.ndarray]] = []
        while len(q):
            self.visited += len(q)
            if skip is not None:
                go = skip[0][q] != skip[1][at]
                q, at = q[go], at[go]
            d = np.bitwise_count(queries[q] ^ self.prints[at]).astype(np.int64)
            near = d <= radius
            hits.append((q[near], at[near]))
            sizes = self.begin[at + 1] - self.begin[at]
            some = np.repeat(np.arange(len(at)), sizes)
            offset = np.arange(len(some)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            child = self.kids[self.begin[at][some] + offset]
            go = np.abs(self.edge[child] - d[some]) <= radius
            q, at = q[some][go], child[go]
        if not hits:
            return q, at
        return np.concatenate([h[0] for h in hits]), np.concatenate([h[1] for h in hits])


def _roots(label: np.ndarray) -> np.ndarray:
    while True:
        up = label[label]
        if (up == label).all():
            return label
        label = up


def _union(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-label union of the pairs into a flat label array."""
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return label
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        label = _roots(label)


def spanning_links(prints: np.ndarray, groups: np.ndarray, is_query: np.ndarray | None = None, radius: int = RADIUS, block: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """Links (positions) that join what lies within the radius in a group, at most one for each position.

    Ordered by group. is_query: positions that only ask (a split group's other parts).
    """
    n = len(prints)
    members = np.arange(n) if is_query is None else np.flatnonzero(~is_query)
    if not len(members):
        return members, members
    forest = Forest(prints[members], groups[members])
    label = np.arange(n)
    tree_of, root_at = groups[members][forest.levels[0]], forest.levels[0]
    for start in range(0, n, block):
        asking = np.arange(start, min(n, start + block))
        place = np.searchsorted(tree_of, groups[asking])
        known = (place < len(tree_of)) & (tree_of[np.minimum(place, len(tree_of) - 1)] == groups[asking])
        asking, place = asking[known], place[known]
        whole = forest.uniform(label[members]) if n > 4 * block else None
        q, node = forest.search(prints[asking], root_at[place], radius, None if whole is None else (label[asking], whole))
        label = _union(label, asking[q], members[node])
    moved = np.flatnonzero(label != np.arange(n))
    return moved, label[moved]


def band_plan(n: int) -> tuple[int, int]:
    """(blocks, blocks in a key): longer keys for more fingerprints, exact for RADIUS either way."""
    return (5, 1) if n <= 1_000_000 else (6, 2) if n <= 100_000_000 else (7, 3)


def _keys(print_col: str, blocks: int, chosen: int):
    """Array of keys: the bits of each choice of blocks, and the choice's number."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    keys = []
    for number, some in enumerate(itertools.combinations(range(blocks), chosen)):
        mask = sum(((1 << edges[k + 1]) - (1 << edges[k])) for k in some)
        keys.append(F.xxhash64(F.lit(number), F.col(print_col).bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))))
    return F.array(*keys)


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for at in range(0, batch.num_rows, 256):
            out += [fingerprint(t, shingle) for t in batch.column(1).slice(at, 256).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(out, np.uint64).view(np.int64))], names=["doc_id", "print"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, print): print holds the 64 bits as a signed long."""
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(lambda it: _fingerprints(it, shingle), f"doc_id {kind}, print bigint")


_PAIR = ["key", "low", "high"]


def _links_of(batches: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    for rows in whole_groups(batches, _PAIR):
        group = (rows[_PAIR] != rows[_PAIR].shift()).any(axis=1).cumsum().to_numpy()
        prints = rows["print"].to_numpy().view(np.uint64)
        a, b = spanning_links(prints, group, rows["asks"].to_numpy(), radius)
        signed = prints.view(np.int64)
        links = np.unique(np.stack([signed[a], signed[b]], axis=1), axis=0)
        for at in range(0, len(links), 10_000):
            yield pd.DataFrame(links[at : at + 10_000], columns=["a", "b"])


def links(prints: DataFrame, n: int, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """Spanning links (a, b) of distinct fingerprints (column print)."""
    if radius > RADIUS:
        raise ValueError(f"keys are exact up to {RADIUS} bits")
    keyed = prints.select("print", F.explode(_keys("print", *band_plan(n))).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > 1)
    keyed = keyed.join(sizes, "key").withColumn("parts", F.ceil(F.col("size") / tree_size).cast("int"))
    own = F.pmod(F.xxhash64("print", F.lit(7)), F.col("parts")).cast("int")
    met = keyed.select("key", "print", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    dealt = met.select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "print", (F.col("own") > F.col("other")).alias("asks"))
    ordered = dealt.repartition(*_PAIR).sortWithinPartitions(*_PAIR, "asks", "print")
    return ordered.mapInPandas(lambda it: _links_of(it, radius), "a bigint, b bigint")


def components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id (least id that can be reached)."""
    scratch = Scratch(docs.sparkSession, "simhash")
    marked = scratch.cut(fingerprints(docs, id_col, text_col, shingle), "prints")
    least = scratch.cut(marked.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct")
    found = scratch.cut(links(least.select("print"), least.count(), radius, tree_size), "links")
    joined = connected_components(found)
    root = least.join(joined.withColumnRenamed("node", "print"), "print", "left").withColumn("root", F.coalesce("component", "print"))
    named = scratch.cut(root.join(root.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("print", "component_id"), "named")
    return marked.join(named, "print").select(F.col("doc_id").alias(id_col), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def linked_sets(sets: DataFrame, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """Rows (node, print) to pairs (a, b): each node with the least of its fingerprint, and the least ones of fingerprints that the forest links."""
    scratch = Scratch(sets.sparkSession, "simhash-sets")
    least = scratch.cut(sets.groupBy("print").agg(F.min("node").alias("least")), "distinct")
    found = scratch.cut(links(least.select("print"), least.count(), radius, tree_size), "links")
    of = lambda end: least.select(F.col("print").alias(end), F.col("least").alias(f"{end}_node"))
    across = found.join(of("a"), "a").join(of("b"), "b").select("a_node", "b_node")
    pairs = across.union(sets.join(least, "print").where(F.col("node") != F.col("least")).select("least", "node"))
    return pairs.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b"))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near copies, columns as they come.

    Every set of shingles goes through the BK-tree forests; an exact check of whole texts
    (`jaccard`) follows, which also finds the similar pairs that lie beyond the radius.

    The row of the least id stays (null ids last; among rows of one id, that of the least hash
    of its text; among equal ones, any).
    """
    found = jaccard.components(docs, id_col=id_col, text_col=text_col, mark=mark, linked=linked_sets)
    scratch = Scratch(docs.sparkSession, "keep-one")
    rank = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col("text_hash").alias("hash"))
    each = scratch.cut(found.groupBy(F.col(id_col).alias("id"), "text_hash").agg(F.first("root").alias("root"), F.count("*").alias("rows"), F.min(rank).alias("rank")), "rows")
    best = each.join(each.groupBy("root").agg(F.min("rank").alias("best")), "root")
    out = scratch.cut(best.where((F.col("rank") != F.col("best")) | (F.col("rows") > 1)).select("id", "text_hash", (F.col("rank") == F.col("best")).alias("stays")), "out")
    n, repeated = out.agg(F.count("*"), F.count_if("stays")).first()
    same = lambda side: docs[id_col].eqNullSafe(side["id"]) & (F.xxhash64(docs[text_col]) == side["text_hash"])
    gone = jaccard.small_side(out.select("id", "text_hash"), n)
    kept = docs.join(gone, same(gone), "left_anti")
    if not repeated:
        return kept
    once = jaccard.small_side(out.where("stays"), repeated)
    return kept.unionByName(docs.join(once, same(once), "left_semi").dropDuplicates([id_col, text_col]))
