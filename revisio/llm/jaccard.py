"""Near copies by word shingles: exact Jaccard similarity of SHINGLE words at 4/5 or more.

Candidates come from prefixes: in any one order of all shingles, two sets that are similar
enough share a shingle among the first fifth of each (n - ceil(4n/5) + 1 places), so that no
pair is missed. The order puts shingles that a sample of texts repeats last; a poor sample
costs time alone.

Most candidates only share a passage. Each set has a parity sketch: bit h mod m is the parity
of the number of its hashes that fall there. Sets that differ in D hashes have sketches that
differ in at most D bits, so that a pair whose sketches differ in more than (|A| + |B|) / 9
bits cannot be similar. Sketches are a few bits a shingle; texts are read for the pairs alone
that they leave, and are compared whole.

A first round compares the pairs that a caller's fingerprints link (`simhash`), and the sets of a
shared shingle with one of them, the one that has the
fewest shingles of its own (an unchanged original, where there is one), so that a large group
of near copies is one component early. Then all sets that share a shingle and
lie in different components are compared: pairs of few rows by a join; where more than CROWD
rows share a shingle, sketches meet in groups, one for all shingles with the same first set,
and only what they leave is a pair. A large group is dealt to pairs of its parts.

Defined results. Fewer words than a shingle: the whole sequence is the one shingle. Texts
without words are copies of each other alone. Words are as in `simhash`. Shingles, equal sets
and equal texts are told apart by hashes of 64 bits.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revisio.llm.keyed import all_pairs, open_rows, shared_keys, stars, whole_groups
from revisio.llm.tokens import give_back, slices, text_batches
from revisio.operators.components import connected_components
from revisio.plans.lineage import Scratch

SHINGLE, SEED, COMMON = 5, 42, 400_000
#: The order of shingles follows one text in SAMPLE_EACH, or SAMPLE texts where that is more: a share that thinned
#: out as tables grow would take ever more frequent passages for rare ones, and pair their texts.
SAMPLE, SAMPLE_EACH = 10_000, 5
#: Rows (16 bytes each) up to which a side is broadcast; beyond, both sides are shuffled.
BROADCAST_ROWS, SKETCH_BITS = 500_000, 1 << 23
#: Rows of a shingle that are paired by a join, and rows of a part of a larger group.
CROWD, PART = 32, 2_048


def shingle_set(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles. Long texts go through in slices."""
    parts, kept, digest = [], [], xxhash.xxh64_intdigest
    for part in slices((text or b"").lower()):
        words = kept + part.split()
        kept = words[max(0, len(words) - shingle + 1) :]
        if len(words) < shingle:
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        begins = np.concatenate(([0], ends[:-1]))[: len(words) - shingle + 1].tolist()
        parts.append(np.unique(np.array([digest(joined[a:b], SEED) for a, b in zip(begins, (ends[shingle - 1 :] - 1).tolist(), strict=True)], np.uint64).view(np.int64)))
    if not parts:
        return np.array([digest(b" ".join(kept), SEED)] if kept else [], np.uint64).view(np.int64)
    return parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 5 * both >= 4 * (len(a) + len(b) - both)


def sketch(found: np.ndarray) -> bytes:
    """Parities of the hashes by their lowest bits, at least four bits a hash (up to SKETCH_BITS)."""
    m = min(SKETCH_BITS, 1 << max(6, (4 * len(found) - 1).bit_length()))
    odd = np.bincount((found & (m - 1)).astype(np.int64), minlength=m) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def apart(a: bytes, b: bytes) -> int:
    """At most the number of hashes in one set alone. The longer sketch is folded to the length of the shorter."""
    x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
    x, y = (x, y) if len(x) <= len(y) else (y, x)
    return int(np.bitwise_count(x ^ np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)).sum())


def prefix(found: np.ndarray, common: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The first shingles in the order of (times in the sample, hash); common is sorted."""
    n = len(found)
    if not n:
        return found
    place = np.minimum(np.searchsorted(common, found), max(0, len(common) - 1))
    seen = np.where(common[place] == found, times[place], 0) if len(common) else np.zeros(n, np.int64)
    return found[np.argsort(seen, kind="stable")][: n - (4 * n + 4) // 5 + 1]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *arrays])))


def _texts(column: pa.Array) -> Iterator[list[bytes | None]]:
    for at in range(0, len(column), 256):
        yield column.slice(at, 256).cast(pa.binary()).to_pylist()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for texts in _texts(batch.column(1)):
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), _lists([shingle_set(t) for t in texts])], names=["node", "shingles"])
            at += len(texts)
        give_back()


def _prefixes(batches: Iterator[pa.RecordBatch], common: np.ndarray, times: np.ndarray, mark: Callable[[np.ndarray], int] | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for texts in _texts(batch.column(2)):
            sets = [shingle_set(t) for t in texts]
            nodes = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64).view(np.int64)
            marks = pa.array([None if mark is None else mark(s) for s in sets], pa.int64())
            rest = [pa.array(nodes), pa.array([len(s) for s in sets], pa.int32()), marks, pa.array([sketch(s) for s in sets], pa.binary()), _lists([prefix(s, common, times) for s in sets])]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), batch.column(1).slice(at, len(texts)), *rest], names=["id", "text_hash", "node", "n", "print", "sketch", "keys"])
            at += len(texts)
        give_back()


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns a, b, n, sketch, other_n, other_sketch to the (a, b) whose sketches may belong to similar sets."""
    for batch in batches:
        n = np.asarray(batch.column(2)) + np.asarray(batch.column(4))
        far = np.fromiter((apart(x, y) for x, y in zip(batch.column(3).to_pylist(), batch.column(5).to_pylist(), strict=True)), np.int64, batch.num_rows)
        yield batch.select([0, 1]).filter(pa.array(9 * far <= n))


def _check(batches: Iterator[pa.RecordBatch], kept_bytes: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """Columns a, b, text, other to the (a, b) of similar texts. The sets of the last texts are kept: one text meets many."""
    kept: OrderedDict[int, np.ndarray] = OrderedDict()
    size = 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some, ok = batch.slice(at, 256), []
            sides = [some.column(k).to_pylist() if k < 2 else some.column(k).cast(pa.binary()).to_pylist() for k in range(4)]
            for a, b, text, other in zip(*sides, strict=True):
                for node, raw in ((b, other), (a, text)):
                    if node not in kept:
                        kept[node] = shingle_set(raw)
                        size += kept[node].nbytes
                    kept.move_to_end(node)
                ok.append(similar(kept[a], kept[b]))
                while size > kept_bytes and len(kept) > 2:
                    size -= kept.popitem(last=False)[1].nbytes
            yield some.select([0, 1]).filter(pa.array(ok, pa.bool_()))
        give_back()


def _common(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that at least three texts of a sample have, and how many have each; the COMMON most frequent."""
    every = min(SAMPLE_EACH, max(1, texts.count() // SAMPLE))
    some = texts.where(F.pmod("text_hash", F.lit(every)) == 0).select("text_hash", "text").dropDuplicates(["text_hash"])
    seen = some.mapInArrow(_sets, "node bigint, shingles array<bigint>").select(F.explode("shingles").alias("s")).groupBy("s").count()
    rows = seen.where("count > 2").orderBy(F.desc("count"), "s").limit(COMMON).toPandas().sort_values("s")
    out = rows["s"].to_numpy(np.int64), rows["count"].to_numpy(np.int64)
    del rows
    give_back()
    return out


def small_side(side: DataFrame, rows: int, most: int = BROADCAST_ROWS) -> DataFrame:
    """The side of a join, broadcast if it has few rows."""
    return F.broadcast(side) if rows <= most else side


def _fits(x: str, y: str):
    return 5 * F.least(x, y) >= 4 * F.greatest(x, y)


def _compare(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs that sketches do not rule out."""
    other = sketches.select(F.col("node").alias("b"), F.col("n").alias("other_n"), F.col("sketch").alias("other_sketch"))
    both = pairs.join(sketches.withColumnRenamed("node", "a"), "a").join(other, "b")
    return both.select("a", "b", "n", "sketch", "other_n", "other_sketch").mapInArrow(_near, "a bigint, b bigint")


def _confirm(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """The pairs of similar texts. held: node, text."""
    both = pairs.join(held.select(F.col("node").alias("b"), F.col("text").alias("other")), "b").join(held.withColumnRenamed("node", "a"), "a")
    return both.select("a", "b", "text", "other").mapInArrow(_check, "a bigint, b bigint")


def _folded(words: np.ndarray, width: int) -> np.ndarray:
    return words if words.shape[1] == width else np.bitwise_xor.reduce(words.reshape(len(words), -1, width), axis=1)


def near_in_group(node: np.ndarray, n: np.ndarray, label: np.ndarray, sketches: list[bytes], asks: np.ndarray, rows: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of sets with different labels that sketches do not rule out. asks: rows that only meet the others; none: all pairs."""
    sizes = np.array([len(x) // 8 for x in sketches])
    by_width = {w: np.flatnonzero(sizes == w) for w in np.unique(sizes).tolist()}
    words = {w: np.frombuffer(b"".join(sketches[k] for k in at), "<u8").reshape(-1, w) for w, at in by_width.items()}
    found = []
    for w, at in by_width.items():
        for v, other in by_width.items():
            if not w <= v <= 2 * w:  # sizes of similar sets differ by a quarter at most
                continue
            far = _folded(words[v], w)
            for begin in range(0, len(at), rows):
                some = at[begin : begin + rows]
                fits = (label[some][:, None] != label[other][None]) & (5 * np.minimum(n[some][:, None], n[other][None]) >= 4 * np.maximum(n[some][:, None], n[other][None]))
                fits &= (asks[some][:, None] != asks[other][None]) if asks.any() else (node[some][:, None] < node[other][None]) if w == v else True
                i, j = np.nonzero(fits)
                for k in range(0, len(i), 65_536):
                    x, y = i[k : k + 65_536], j[k : k + 65_536]
                    apart_by = np.bitwise_count(words[w][begin + x] ^ far[y]).sum(1, dtype=np.int64)
                    near = 9 * apart_by <= n[some[x]] + n[other[y]]
                    found.append((some[x[near]], other[y[near]]))
    return tuple(np.concatenate([np.empty(0, np.int64), *(f[k] for f in found)]) for k in range(2))


def _near_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in whole_groups(batches, ["center", "low", "high"], 10_000):
        for at in rows.groupby(["center", "low", "high"], sort=False).indices.values():
            some = rows.iloc[at]
            node = some["node"].to_numpy()
            i, j = near_in_group(node, some["n"].to_numpy(np.int64), some["label"].to_numpy(), some["sketch"].to_list(), some["asks"].to_numpy(bool))
            pairs = np.unique(np.stack([np.minimum(node[i], node[j]), np.maximum(node[i], node[j])], axis=1), axis=0)
            for k in range(0, len(pairs), 10_000):
                yield pd.DataFrame(pairs[k : k + 10_000], columns=["a", "b"])


def _crowded_pairs(rows: DataFrame, slim: DataFrame, part: int) -> DataFrame:
    """rows: center, node, label. Pairs (a, b) of a group with different labels that sketches do not rule out."""
    sizes = rows.groupBy("center").agg(F.ceil(F.count("*") / part).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("node", F.lit(7)), F.col("parts")).cast("int")
    met = rows.join(sizes, "center").select("center", "node", "label", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    dealt = met.select("center", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "node", "label", (F.col("own") > F.col("other")).alias("asks"))
    of = ["center", "low", "high"]
    return dealt.join(slim, "node").repartition(*of).sortWithinPartitions(*of, "node").mapInPandas(_near_groups, "a bigint, b bigint").distinct()


def links(shared: DataFrame, sketches: DataFrame, texts: DataFrame, crowd: int = CROWD, part: int = PART, first: DataFrame | None = None) -> DataFrame:
    """Similar pairs (a, b) that join all that is similar. first: pairs to compare before all others. shared: key, node, n, own (shingles of its prefix that no other has); sketches: node, n, sketch, text_hash; texts: text_hash, text."""
    scratch = Scratch(shared.sparkSession, "jaccard-links")
    slim = sketches.select("node", "n", "sketch")

    def texts_of(pairs: DataFrame, name: str) -> DataFrame:
        asked = scratch.cut(sketches.select("node", "text_hash").join(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node"), f"asked-{name}")
        return scratch.cut(texts.join(small_side(asked, asked.count()), "text_hash").dropDuplicates(["node"]).select("node", "text"), f"held-{name}")

    asked = stars(open_rows(shared, None), F.struct("own", "node"), _fits)
    near = scratch.cut(_compare(asked if first is None else asked.union(first).distinct(), slim), "near-stars")
    found = scratch.cut(_confirm(near, texts_of(near, "stars")), "links-stars")
    # What is in different components by texts: all pairs that no round has compared.
    state = scratch.cut(open_rows(shared, connected_components(found)), "state-rest")
    keys = state.groupBy("key").agg(F.count("*").alias("rows"), F.min_by("node", F.struct("own", "node")).alias("center"))
    few = all_pairs(state.join(keys.where(F.col("rows") <= crowd).select("key"), "key"), _fits)
    many = state.join(keys.where(F.col("rows") > crowd).select("key", "center"), "key").select("center", "node", "label").distinct()
    pairs = scratch.cut(_compare(few, slim).union(_crowded_pairs(many, slim, part)), "near-rest").distinct().join(near, ["a", "b"], "left_anti")
    rest = scratch.cut(pairs, "rest")
    return found.union(scratch.cut(_confirm(rest, texts_of(rest, "rest")), "links-rest"))


def components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", mark: Callable[[np.ndarray], int] | None = None, linked: Callable[[DataFrame], DataFrame] | None = None, **groups: int) -> DataFrame:
    """One row per document: id, text_hash, root (the same for all that similar pairs join).

    mark: a fingerprint of a set of shingles; linked: sets (node, print) to the pairs (a, b) that
    their fingerprints link, which are compared first. groups: crowd and part of `links`.
    """
    scratch = Scratch(docs.sparkSession, "jaccard")
    kind = docs.schema[id_col].dataType.simpleString()
    text_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    common, times = _common(texts)
    marked = scratch.cut(texts.mapInArrow(lambda it: _prefixes(it, common, times, mark), f"id {kind}, text_hash bigint, node bigint, n int, print bigint, sketch binary, keys array<bigint>"), "prefixes")
    rows = scratch.cut(marked.select("id", "text_hash", "node"), "rows")
    sketches = scratch.cut(marked.groupBy("node").agg(F.min("text_hash").alias("text_hash"), F.first("n").alias("n"), F.first("print").alias("print"), F.first("sketch").alias("sketch")), "sketches")
    each = marked.select("node", F.explode("keys").alias("key"))
    found = scratch.cut(shared_keys(each), "keys")
    of = found.groupBy("node").agg(F.count("*").alias("others")).join(sketches.select("node", "n"), "node")
    own = F.col("n") - F.floor((4 * F.col("n") + 4) / 5) + 1 - F.col("others")
    shared = scratch.cut(found.join(of.select("node", "n", own.alias("own")), "node"), "shared")
    scratch.drop("prefixes")
    first = None if linked is None else linked(sketches.select("node", "print"))
    joined = connected_components(links(shared, sketches, texts.select("text_hash", "text"), first=first, **groups))
    return rows.join(joined, "node", "left").select(F.col("id").alias(id_col), "text_hash", F.coalesce("component", "node").alias("root"))
