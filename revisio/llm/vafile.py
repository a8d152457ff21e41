"""Exact top-k by inner product with vector-approximation files.

Vectors stand in blocks. A block holds its vectors twice: exactly, as integers of the least
width that fits, and as cells, half a byte a component. The cells of a component are CELLS
equal steps from its least to its largest value in the block, so that all rows set them and no
value lies outside. A query's score is bounded from cells alone: one product with the cell
numbers, and a constant for the width of the steps.

Two rounds share what is known of a query's k-th score. First each block of queries probes
`probe` blocks: the vectors of the k largest bounds are read and scored, and the k-th best
score is a limit that no result may fall below. Then each block of queries meets all blocks:
exact vectors are read in the order of their bounds, a few at first and then twice as many,
each read raises the limit, and reading ends when no bound that is left reaches it. The
blocks' lists merge in a window.

The stated queries meet the cells of all rows; nothing is pruned by an index that could miss.

Defined results. Null vectors, vectors without components and vectors with null or non-finite
components take no part, and neither do null ids. Vectors of another length than a query's are
not its candidates. Ties go to the smaller id. A query is not its own candidate: rows that
share its id are left out. Repeated rows are candidates each; queries that share an id get one
list, the k best of all their scores. Fewer rows than k: all. Components are floor(scale * x),
held as doubles: exact while scores stay below 2**53. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revisio.plans.lineage import Scratch

SCALE, CELLS, BLOCK, QUERY_BLOCK, PROBE = 64, 16, 8_192, 2_048, 2
_KINDS = ("<i1", "<i2", "<i4", "<f8")


def _vectors(table: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    v = F.col(vector_col)
    whole = v.isNotNull() & F.col(id_col).isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return table.where(whole).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("v"))


def narrow(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the least width that holds them."""
    most = np.abs(x).max(initial=0)
    return x.astype(next((k for k in _KINDS[:3] if most <= np.iinfo(k).max), _KINDS[3]))


def cells_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(least value, step) of each component, and cells packed in pairs: x is in [least + step * cell, least + step * (cell + 1) - 1]."""
    least = x.min(0).astype("<f8")
    step = np.maximum(1, np.ceil((x.max(0) - least + 1) / CELLS))
    cell = np.minimum((x - least) // step, CELLS - 1).astype(np.uint8)
    if cell.shape[1] % 2:
        cell = np.pad(cell, ((0, 0), (0, 1)))
    return least, step, cell[:, ::2] | (cell[:, 1::2] << 4)


def bounds(q: np.ndarray, least: np.ndarray, step: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """(queries, rows): no score of the row can be larger."""
    cell = np.stack([packed & 15, packed >> 4], axis=2).reshape(len(packed), -1)[:, : len(least)]
    weight = q * step
    exact_single = np.abs(weight).sum(1).max(initial=0) * CELLS < 1 << 24
    near = weight.astype("f4") @ cell.astype("f4").T if exact_single else weight @ cell.astype("f8").T
    return near + (q @ least + np.maximum(q, 0) @ (step - 1))[:, None]


class Limits:
    """Running k-th score of each query, from the scores that are read."""

    def __init__(self, limit: np.ndarray, k: int):
        self.limit, self.best = limit.astype(float), np.full((len(limit), k), -np.inf)

    def add(self, rows: np.ndarray, scores: np.ndarray) -> None:
        n, k = self.best.shape
        all_rows, all_scores = np.concatenate([np.repeat(np.arange(n), k), rows]), np.concatenate([self.best.ravel(), scores])
        order = np.lexsort((-all_scores, all_rows))
        all_rows = all_rows[order]
        rank = np.arange(len(order)) - np.searchsorted(all_rows, all_rows)
        self.best = all_scores[order][rank < k].reshape(n, k)
        self.limit = np.maximum(self.limit, self.best[:, -1])


def top_of_block(q: np.ndarray, q_ids: np.ndarray, limit: np.ndarray, x: np.ndarray, x_ids: np.ndarray, cells: tuple[np.ndarray, np.ndarray, np.ndarray], k: int, probe: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query position, candidate position, score) of the k best of a block that reach a query's limit, and the vectors read for each query; ids ascend in x_ids.

    probe: read the k largest bounds alone.
    """
    upper = bounds(q, *cells)
    for r in np.flatnonzero(np.isin(q_ids, x_ids)):
        upper[r, x_ids == q_ids[r]] = -np.inf
    if probe and k < len(x):
        cols = np.argpartition(-upper, k - 1, axis=1)[:, :k].ravel()
        rows = np.repeat(np.arange(len(q)), k)
        fine = upper[rows, cols] > -np.inf
        rows, cols = rows[fine], cols[fine]
    else:
        rows, cols = np.nonzero((upper >= limit[:, None]) & (upper > -np.inf))
    bound = upper[rows, cols]
    order = np.lexsort((-bound, rows))
    rows, cols, bound = rows[order], cols[order], bound[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    scores, known = np.full(len(rows), -np.inf), Limits(limit, k)
    begin, end = 0, k
    while (left := (place >= begin) & (bound >= known.limit[rows])).any():
        at = np.flatnonzero(left & (place < end))
        for some in np.split(at, range(65_536, len(at), 65_536)):
            scores[some] = np.einsum("nd,nd->n", x[cols[some]].astype("f8"), q[rows[some]])
        known.add(rows[at], scores[at])
        begin, end = end, 2 * end
    reads = np.bincount(rows[scores > -np.inf], minlength=len(q))
    keep = (scores >= known.limit[rows]) & (scores > -np.inf)
    rows, cols, scores = rows[keep], cols[keep], scores[keep]
    order = np.lexsort((x_ids[cols], -scores, rows))
    rows, cols, scores = rows[order], cols[order], scores[order]
    rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return rows[rank < k], cols[rank < k], scores[rank < k], reads


def _blocks(vectors: DataFrame, size: int, block: Column, with_cells: bool) -> DataFrame:
    """One row per block, packed as bytes, in ascending id order: dim, block, ids, kind and values, and the cells where they are wanted."""

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        frame = frame.sort_values("vec_id", kind="stable")
        for at in range(0, len(frame), size):
            some = frame.iloc[at : at + size]
            x = np.stack(some["v"].to_list())
            exact = narrow(x)
            row = (some["dim"].iloc[0], some["block"].iloc[0] * 1_000_000 + at // size, some["vec_id"].to_numpy("<i8").tobytes(), exact.dtype.str.replace("|", "<"), exact.tobytes())
            out.append((*row, *(c.tobytes() for c in cells_of(x))) if with_cells else row)
        return pd.DataFrame(out, columns=names)

    names = ["dim", "block", "ids", "kind", "values", *(("least", "step", "cells") if with_cells else ())]
    layout = "dim int, block bigint, ids binary, kind string, values binary" + (", least binary, step binary, cells binary" if with_cells else "")
    return vectors.withColumn("dim", F.size("v")).withColumn("block", block).groupBy("dim", "block").applyInPandas(pack, layout)


def top_k(table: DataFrame, queries: Column, *, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, block: int = BLOCK, query_block: int = QUERY_BLOCK, probe: int = PROBE, with_reads: bool = False) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best rows for each row where `queries` (over vec_id) holds.

    block, query_block: rows a block. probe: blocks that a query's first limit comes from.
    with_reads: a column exact_reads more, the exact vectors that the scan of all blocks read
    for the query.
    """
    scratch = Scratch(table.sparkSession, "vafile")
    vectors = _vectors(table, id_col, vector_col, scale)
    asked = vectors.where(queries)
    total, n_queries = vectors.agg(F.count("*"), F.count_if(queries)).first()
    dealt = lambda n, size: F.pmod(F.xxhash64("vec_id"), F.lit(max(1, -(-n * 5 // (size * 4))))).cast("long")
    files = scratch.cut(_blocks(vectors, block, dealt(total, block), True), "blocks").withColumn("block", F.xxhash64("dim", "block"))
    asks = scratch.cut(_blocks(asked, query_block, dealt(n_queries, query_block), False), "queries").select("dim", F.xxhash64("dim", "block").alias("ask"), F.col("ids").alias("q_ids"), F.col("kind").alias("q_kind"), F.col("values").alias("q_values"))
    columns = ("ask", "dim", "ids", "kind", "values", "least", "step", "cells", "q_ids", "q_kind", "q_values", "known_ids", "known")

    def meet(batches: Iterator[pa.RecordBatch], first: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                r = {c: batch.column(n)[at].as_py() for n, c in enumerate(columns)}
                x, x_ids = np.frombuffer(r["values"], r["kind"]).reshape(-1, r["dim"]), np.frombuffer(r["ids"], "<i8")
                cells = np.frombuffer(r["least"], "<f8"), np.frombuffer(r["step"], "<f8"), np.frombuffer(r["cells"], "u1").reshape(len(x), -1)
                q, own = np.frombuffer(r["q_values"], r["q_kind"]).reshape(-1, r["dim"]).astype("f8"), np.frombuffer(r["q_ids"], "<i8")
                limit = np.full(len(q), -np.inf)
                if r["known_ids"]:
                    ids, known = np.array(r["known_ids"]), np.array(r["known"], float)
                    place = np.searchsorted(ids, own).clip(max=len(ids) - 1)
                    limit = np.where(ids[place] == own, known[place], -np.inf)
                for a in range(0, len(q), 256):
                    of = own[a : a + 256]
                    rows, cols, scores, reads = top_of_block(q[a : a + 256], of, limit[a : a + 256], x, x_ids, cells, k, first)
                    lists = [(of[rows], pa.array(x_ids[cols]), pa.array(scores.astype(np.int64)), pa.nulls(len(rows), pa.int64()))]
                    if with_reads and not first:
                        lists.append((of, pa.nulls(len(of), pa.int64()), pa.nulls(len(of), pa.int64()), pa.array(reads)))
                    for ids, *rest in lists:
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), r["ask"])), pa.array(ids), *rest], names=["ask", "query_id", "vec_id", "score", "reads"])

    def met(keys: DataFrame, asks: DataFrame, first: bool) -> DataFrame:
        """Rows are whole blocks. Each side is dealt to the pairs that it is part of, so that a task gets pairs, not a side."""
        left = files.join(keys, "block")
        right = asks.join(keys.withColumnRenamed("block", "block_key"), "ask").withColumnRenamed("ask", "ask_key").drop("dim")
        pairs = left.join(right, (F.col("block") == F.col("block_key")) & (F.col("ask") == F.col("ask_key"))).select(*columns)
        return pairs.mapInArrow(lambda it: meet(it, first), "ask bigint, query_id bigint, vec_id bigint, score bigint, reads bigint")

    # As many rows as there are pairs of blocks.
    keys = files.select("dim", "block").join(asks.select("dim", "ask"), "dim").select("block", "ask")
    near = Window.partitionBy("ask").orderBy(F.xxhash64("ask", "block"), "block")
    probed = keys.withColumn("n", F.row_number().over(near)).where(F.col("n") <= probe).select("block", "ask")
    none = F.lit(None).cast("array<bigint>")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = met(probed, asks.withColumns({"known_ids": none, "known": none}), True).withColumn("rank", F.row_number().over(best))
    ranked = scratch.cut(ranked.where(F.col("rank") <= k).select("ask", "query_id", "score", "rank"), "probed")
    told = ranked.where(F.col("rank") == k).select("query_id", "score").join(ranked.select("ask", "query_id").distinct(), "query_id").groupBy("ask").agg(F.sort_array(F.collect_list(F.struct("query_id", "score"))).alias("known"))
    limited = asks.join(told, "ask", "left").withColumns({"known_ids": F.col("known.query_id"), "known": F.col("known.score")})
    found = met(keys, limited, False)
    out = found.where(F.col("vec_id").isNotNull()).withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    if not with_reads:
        return out
    return out.join(found.groupBy("query_id").agg(F.coalesce(F.sum("reads"), F.lit(0)).alias("exact_reads")), "query_id")
