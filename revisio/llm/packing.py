"""Best-fit packing of token sequences, by hierarchical residual packing.

Each partition tokenises its documents and packs its pieces best-fit decreasing. Nearly
full bins are final there and then. Underfull bins become the items of the next round:
`fan_in` partitions' bins meet in one task, are packed best-fit again, and so on up a tree.
A bin that joins another moves as one block, so that only (bin, root, base) triples move,
never the pieces. All pieces meet their final places in one equi-join at the end.

No two bins that a round leaves fit together, so that a node has at most one bin that is at
most half full, and every merge of the next round needs one of these: at most `fan_in` in a
group. Of the bins of one fill a group therefore reads `fan_in`, all that the round could use,
whatever the number of underfull bins; what moves is less than one bin a partition.

Defined results. Null or empty text: one piece that holds the end id alone. A document
over the capacity: pieces of exactly the capacity, the last one shorter. Repeated rows:
each row has pieces of its own. Null ids: kept as null. Empty table: no rows. Other
columns are not read, so that their names cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revisio.llm import tokens
from revisio.plans.lineage import Scratch

CAPACITY, END_ID, SLACK, FAN_IN = 4096, 1, 4, 16
GROUP_BYTES = 1 << 21  # text that a worker encodes at once


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: (bin of each item, its offset there, fill of each bin). Ties by position."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by free room
    rooms, fills = 0, []  # rooms: bit r is set while some bin has r free
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        if fitting := rooms >> n:
            room = n + (fitting & -fitting).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += n
        if left := room - n:
            open_bins[left].append(b)
            rooms |= 1 << left
    return bins, offsets, np.array(fills, np.int64)


def _pack_partition(batches: Iterator[pa.RecordBatch], path: str | None, capacity: int, end_id: int, cache_words: int = tokens.CACHE_WORDS) -> Iterator[pa.RecordBatch]:
    encoder, end = tokens.encoder(path, GROUP_BYTES, cache_words), np.array([end_id], "<u4").tobytes()
    ids, rows, pieces, starts, lengths, crcs = [], [], [], [], [], []
    n_docs = 0
    for batch in batches:
        ids.append(batch.column(0))
        for at, n in tokens.runs(batch.column(1), GROUP_BYTES):
            for k, data in enumerate(encoder.encode_all(batch.column(1).slice(at, n).cast(pa.binary()).to_pylist())):
                data += end
                for p, start in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[start : start + 4 * capacity]
                    rows.append(n_docs + at + k)
                    pieces.append(p)
                    starts.append(start // 4)
                    lengths.append(len(part) // 4)
                    crcs.append(zlib.crc32(part))
            tokens.give_back()
        n_docs += batch.num_rows
    if not rows:
        return
    length = np.array(lengths, np.int64)
    bins, offsets, fills = best_fit(length, capacity)
    base = TaskContext.get().partitionId() << 32
    table = pa.table({
        "doc_id": pa.chunked_array(ids).take(pa.array(rows)), "piece": pa.array(pieces, pa.int32()), "start": pa.array(starts, pa.int64()), "length": length,
        "ids_crc32": pa.array(crcs, pa.int64()), "bin": bins + base, "place": offsets, "fill": fills[bins],
    })
    yield from table.to_batches(max_chunksize=10_000)


def _pack_bins(frame: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """What changes: bins that move into another (their root, at `base`), and roots with the fill they have now."""
    frame = frame.sort_values(["fill", "bin"], ascending=[False, True], kind="stable", ignore_index=True)
    bins, offsets, fills = best_fit(frame["fill"].to_numpy(), capacity)
    first = np.full(len(fills), -1, np.int64)
    starting = np.flatnonzero(offsets == 0)
    first[bins[starting]] = frame["bin"].to_numpy()[starting]
    packed = pd.DataFrame({"bin": frame["bin"], "root": first[bins], "base": offsets, "fill": fills[bins]})
    return packed[(np.bincount(bins, minlength=len(fills)) > 1)[bins]]


def pack(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, slack: int = SLACK, fan_in: int = FAN_IN, cache_words: int = tokens.CACHE_WORDS) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    slack: free tokens up to which a bin is nearly full. fan_in: nodes that meet in a round. cache_words: pieces of words that a worker keeps; fewer cost time, and leave memory to others.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    scratch = Scratch(spark, "packing")
    tokens.text_batches(spark)
    layout = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, bin bigint, place bigint, fill bigint"
    placed = scratch.cut(docs.select(id_col, text_col).mapInArrow(lambda it: _pack_partition(it, vocabulary, capacity, end_id, cache_words), layout), "round-0")

    items = scratch.cut(placed.where((F.col("place") == 0) & (F.col("fill") < capacity - slack)).select("bin", "fill"), "items")
    nodes = (items.agg(F.max(F.shiftright("bin", 32))).first()[0] or 0) + 1
    changed, moved, width, turn = None, None, 1, 0
    while width < nodes:
        width, turn = width * fan_in, turn + 1
        now = items
        if changed is not None:
            told = changed.select(F.col("bin").alias("told"), F.when(F.col("bin") == F.col("root"), F.col("fill")).otherwise(-1).alias("now"))
            now = items.join(told, F.col("bin") == F.col("told"), "left").select("bin", F.coalesce("now", "fill").alias("fill")).where((F.col("fill") >= 0) & (F.col("fill") < capacity - slack))
        group = F.floor(F.shiftright("bin", 32) / width)
        of_fill = Window.partitionBy("node", "fill").orderBy("bin")
        met = now.withColumn("node", group).withColumn("n", F.row_number().over(of_fill)).where(F.col("n") <= fan_in)
        step = scratch.cut(met.groupBy("node").applyInPandas(lambda x: _pack_bins(x, capacity), "bin bigint, root bigint, base bigint, fill bigint"), f"round-{turn}")
        new = step.where("bin <> root").select(F.col("bin").alias("root"), F.col("root").alias("root_2"), F.col("base").alias("base_2"))
        own = step.where("bin <> root").select("bin", "root", "base")
        if moved is not None:
            own = moved.join(new, "root", "left").select("bin", F.coalesce("root_2", "root").alias("root"), (F.col("base") + F.coalesce("base_2", F.lit(0))).alias("base")).union(own)
            step = changed.join(step.select("bin"), "bin", "left_anti").union(step)
        moved, changed = scratch.cut(own, f"moved-{turn}"), scratch.cut(step, f"changed-{turn}")
    if moved is None:
        moved = spark.createDataFrame([], "bin bigint, root bigint, base bigint")
    return placed.join(moved, "bin", "left").select(
        F.col("doc_id").alias(id_col), "piece", "start", "length", "ids_crc32",
        F.coalesce("root", "bin").alias("sequence_id"), (F.coalesce("base", F.lit(0)) + F.col("place")).cast("long").alias("offset"),
    )
