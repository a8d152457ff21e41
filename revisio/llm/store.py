"""Content-addressed store of token ids.

A gear-style rolling hash over the last 16 ids cuts each document's id stream into chunks
at places that depend on content alone, so that shared passages give equal chunks. Each
distinct chunk is stored once under its BLAKE2b digest. A recipe lists the digests of a
document. Recipes stand in files (parts) in ascending doc_id order; the manifest has a Merkle
root over each part's recipes and one root over all parts.

Layout below the store's folder (Parquet, zstd):
  chunks/     at (number of the chunk as it was read), digest, n_ids, ids_crc32, payload (little-endian ids, 16 or 32 bits each)
  recipes/    part, place (in its part), start_in_part, doc_id, n_tokens, chunks (digests in order); ascending, file after file
  manifest/   part, documents, n_tokens, documents_before, tokens_before, root of the part's recipes
  root/       documents, n_tokens, root of all parts' roots

`verify` recomputes all roots from the recipes, and every chunk's digest from its payload;
`read` re-hashes what it reads as well. Payloads never move: equal chunks are told by their
digests, and each partition writes those of its chunks that it owns. The CRC-32 of a document is combined from its chunks'
CRCs, so that checking whole documents shuffles digests alone.

Defined results. Null or empty text: the end id alone. Ids order ascending, recipes of one id by
a hash of their digests. Repeated rows and repeated ids:
a recipe each. Null ids: first. Empty table: an empty store. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revisio.llm import tokens
from revisio.llm.jaccard import small_side
from revisio.plans.lineage import Scratch

END_ID, MIN_IDS, MEAN_IDS, MAX_IDS, WINDOW = 1, 128, 1024, 8192, 16
_GEAR = np.random.default_rng(8).integers(0, 1 << 32, 1 << 16, dtype=np.uint32)


def rolling(ids: np.ndarray) -> np.ndarray:
    """h[i]: the gears of the last WINDOW ids up to i, each shifted by its distance and summed."""
    h, step = _GEAR[ids & 0xFFFF] ^ (ids >> 16).astype(np.uint32), 1
    while step < WINDOW:
        shifted = np.zeros_like(h)
        shifted[step:] = h[:-step] << np.uint32(step)
        h, step = h + shifted, 2 * step
    return h


def cut_points(sizes: list[int], ids: np.ndarray, least: int = MIN_IDS, mean: int = MEAN_IDS, most: int = MAX_IDS) -> list[list[int]]:
    """Chunk ends of each document; ids are those of all documents, end to end. mean is a power of two.

    No cut is nearer than `least` >= WINDOW to a document's start, so that what stands
    before a document never decides a cut.
    """
    marks = np.flatnonzero((rolling(ids) >> np.uint32(16)) & np.uint32(mean - 1) == 0) + 1
    out, start = [], 0
    for size, lo, hi in zip(sizes, *np.searchsorted(marks, [np.cumsum([0, *sizes[:-1]]), np.cumsum(sizes)]).tolist(), strict=True):
        ends, begin = [], 0
        for at in (marks[lo:hi] - start).tolist():
            while at - begin > most:
                begin += most
                ends.append(begin)
            if at - begin >= least and at < size:
                ends.append(at)
                begin = at
        while size - begin > most:
            begin += most
            ends.append(begin)
        if begin < size:
            ends.append(size)
        out.append(ends)
        start += size
    return out


def digest_of(payload: bytes) -> bytes:
    return hashlib.blake2b(payload, digest_size=20).digest()


def merkle(leaves: list[bytes]) -> bytes:
    """Root of a binary hash tree; an odd node goes up as it is."""
    if not leaves:
        return digest_of(b"")
    while len(leaves) > 1:
        leaves = [digest_of(b"".join(leaves[i : i + 2])) if i + 1 < len(leaves) else leaves[i] for i in range(0, len(leaves), 2)]
    return leaves[0]


def _gf2_times(matrix: list[int], vector: int) -> int:
    total, k = 0, 0
    while vector:
        if vector & 1:
            total ^= matrix[k]
        vector >>= 1
        k += 1
    return total


def _zero_operators() -> list[list[int]]:
    """Operators that append 2**k zero bytes to a CRC-32."""
    one_bit = [0xEDB88320, *(1 << k for k in range(31))]
    square = lambda m: [_gf2_times(m, m[k]) for k in range(32)]
    ops = [square(square(square(one_bit)))]
    while len(ops) < 48:
        ops.append(square(ops[-1]))
    return ops


_OPERATORS = _zero_operators()


def crc32_join(a: int, b: int, b_bytes: int) -> int:
    """CRC-32 of two strings end to end, from their CRCs and the length of the second."""
    k = 0
    while b_bytes:
        if b_bytes & 1:
            a = _gf2_times(_OPERATORS[k], a)
        b_bytes >>= 1
        k += 1
    return a ^ b


def _chunk(batches: Iterator[pa.RecordBatch], path: str | None, end_id: int) -> Iterator[pa.RecordBatch]:
    encoder, end = tokens.encoder(path), np.array([end_id], "<u4").tobytes()
    wide = max(encoder.tokenizer.get_vocab_size(), end_id + 1) > 1 << 16
    width, number = 4 if wide else 2, TaskContext.get().partitionId() << 36
    for batch in batches:
        for at, n in tokens.runs(batch.column(1)):
            texts = [data + end for data in encoder.encode_all(batch.column(1).slice(at, n).cast(pa.binary()).to_pylist())]
            sizes, whole = [len(t) // 4 for t in texts], memoryview(b"".join(texts))
            ids = np.frombuffer(whole, "<u4")
            raw, start, spans, begins = (ids if wide else ids.astype("<u2")).tobytes(), 0, [], [0]
            for size, ends in zip(sizes, cut_points(sizes, ids), strict=True):
                spans += [(start + a, start + b) for a, b in zip([0, *ends], ends, strict=False)]
                begins.append(len(spans))
                start += size
            payloads = [raw[a * width : b * width] for a, b in spans]
            columns = pa.array(np.arange(number, number + len(spans))), pa.array(map(digest_of, payloads), pa.binary()), pa.array([b - a for a, b in spans], pa.int32()), pa.array([zlib.crc32(whole[4 * a : 4 * b]) for a, b in spans], pa.int64()), pa.array(payloads, pa.binary())
            chunks = pa.StructArray.from_arrays(columns, names=["at", "digest", "n_ids", "ids_crc32", "payload"])
            number += len(spans)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(begins, pa.int32()), chunks)], names=["doc_id", "n_tokens", "chunks"])
        tokens.give_back()


def _crcs(payloads: pd.Series, wide: bool) -> pd.Series:
    return payloads.map(lambda p: zlib.crc32(p if wide else np.frombuffer(p, "<u2").astype("<u4").tobytes())).astype("int64")


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns part, place and start_in_part before the columns doc_id, n_tokens, chunks of a sorted partition."""
    part, place, start = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        n, sizes = batch.num_rows, np.asarray(batch.column(1))
        before = [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(place, place + n)), pa.array(start + np.cumsum(sizes) - sizes)]
        place, start = place + n, start + int(sizes.sum())
        yield pa.RecordBatch.from_arrays([*before, *(batch.column(k) for k in range(3))], names=["part", "place", "start_in_part", "doc_id", "n_tokens", "chunks"])


def write(docs: DataFrame, folder: str, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, end_id: int = END_ID, files: int | None = None) -> str:
    """Write the store of all rows; returns its folder. files: recipe files, one per shuffle partition if not given."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    scratch = Scratch(spark, "store")
    staged = docs.select(id_col, text_col).mapInArrow(lambda it: _chunk(it, vocabulary, end_id), f"doc_id {kind}, n_tokens bigint, chunks array<struct<at:bigint,digest:binary,n_ids:int,ids_crc32:bigint,payload:binary>>")
    staged = scratch.cut(staged, "staged", compression="snappy")  # read back soon: cheap to write

    named = staged.select(F.explode("chunks").alias("c")).select("c.at", "c.digest")
    owners = named.groupBy("digest").agg(F.min("at").alias("owner"), F.count("*").alias("n")).where("n > 1")
    again = scratch.cut(named.join(owners, "digest").where("at <> owner").select("at"), "again")
    chunks = staged.select(F.explode("chunks").alias("c")).select("c.*")
    chunks.join(small_side(again, again.count()), "at", "left_anti").write.option("compression", "zstd").parquet(f"{folder}/chunks")

    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    recipes = staged.select("doc_id", "n_tokens", F.transform("chunks", lambda c: c["digest"]).alias("chunks"))
    order = ["doc_id", F.xxhash64("n_tokens", "chunks"), "chunks"]
    ranged = recipes.repartitionByRange(n, *order).sortWithinPartitions(*order)
    ranged.mapInArrow(_place, f"part int, place bigint, start_in_part bigint, doc_id {kind}, n_tokens bigint, chunks array<binary>").write.option("compression", "zstd").parquet(f"{folder}/recipes")
    roots = _roots(spark.read.parquet(f"{folder}/recipes")).collect()  # a row per recipe file
    rows, documents, total = [], 0, 0
    for r in sorted(roots):
        rows.append((r.part, r.documents, r.n_tokens, documents, total, r.root))
        documents, total = documents + r.documents, total + r.n_tokens
    spark.createDataFrame(rows, "part int, documents bigint, n_tokens bigint, documents_before bigint, tokens_before bigint, root string").coalesce(1).write.parquet(f"{folder}/manifest")
    spark.createDataFrame([(documents, total, _top(rows))], "documents bigint, n_tokens bigint, root string").coalesce(1).write.parquet(f"{folder}/root")
    scratch.drop("staged", "again")
    return folder


def _top(manifest: list[tuple]) -> str:
    return merkle([digest_of("|".join(map(str, row)).encode()) for row in sorted(manifest)]).hex()


def _merkle_of(leaves: Column) -> Column:
    """Root over an array of (place, hex leaf)."""
    root = F.pandas_udf(lambda s: s.map(lambda x: merkle([bytes.fromhex(v["leaf"]) for v in x]).hex()), "string")
    return root(F.array_sort(leaves))


def _roots(recipes: DataFrame, block: int = 4096) -> DataFrame:
    """(part, documents, n_tokens, root) of recipes: a root over each block of them, then over a part's blocks."""
    told = F.array_join(F.transform("chunks", lambda c: F.coalesce(F.hex(c), F.lit("-"))), "")
    leaf = F.sha2(F.concat_ws("|", "part", "place", "start_in_part", "n_tokens", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), told), 256)
    blocks = recipes.groupBy("part", F.floor(F.col("place") / block).alias("place")).agg(F.count("*").alias("documents"), F.sum("n_tokens").alias("n_tokens"), F.collect_list(F.struct("place", leaf.alias("leaf"))).alias("v"))
    blocks = blocks.select("part", "place", "documents", "n_tokens", _merkle_of(F.col("v")).alias("leaf"))
    parts = blocks.groupBy("part").agg(F.sum("documents").alias("documents"), F.sum("n_tokens").alias("n_tokens"), F.collect_list(F.struct("place", "leaf")).alias("v"))
    return parts.select("part", "documents", "n_tokens", _merkle_of(F.col("v")).alias("root"))


def verify_recipes(spark: SparkSession, folder: str) -> None:
    """Raise unless recipes, manifest and root agree."""
    manifest = [tuple(r) for r in spark.read.parquet(f"{folder}/manifest").select("part", "documents", "n_tokens", "documents_before", "tokens_before", "root").collect()]
    told = {(r[0], r[1], r[2], r[5]) for r in manifest}
    seen = {tuple(r) for r in _roots(spark.read.parquet(f"{folder}/recipes")).collect()}
    if told != seen:
        raise ValueError(f"recipes of the parts {sorted({r[0] for r in told ^ seen})} differ from the manifest")
    rows = spark.read.parquet(f"{folder}/root").collect()
    if [tuple(r) for r in rows] != [(sum(r[1] for r in manifest), sum(r[2] for r in manifest), _top(manifest))]:
        raise ValueError("the manifest differs from the root")


def verify(spark: SparkSession, folder: str) -> None:
    """Raise unless recipes, manifest and root agree, and every chunk with its digest."""
    verify_recipes(spark, folder)
    differs = F.pandas_udf(lambda d, p: pd.Series([digest_of(x) != y for x, y in zip(p, d, strict=True)]), "boolean")
    wrong = spark.read.parquet(f"{folder}/chunks").where(differs("digest", "payload")).count()
    if wrong:
        raise ValueError(f"{wrong} chunks are damaged")


def _recipes(spark: SparkSession, folder: str) -> DataFrame:
    """Recipes with ordinal and start in the whole store."""
    manifest = spark.read.parquet(f"{folder}/manifest").select("part", "documents_before", "tokens_before")
    return spark.read.parquet(f"{folder}/recipes").join(F.broadcast(manifest), "part").select(
        (F.col("documents_before") + F.col("place")).alias("ordinal"), "doc_id", (F.col("tokens_before") + F.col("start_in_part")).alias("start"), "n_tokens", "chunks"
    )


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32. A chunk that differs from its digest fails the query."""

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, payloads, sizes = (batch.column(k).to_pylist() for k in range(3))
            wide = any(len(p) == 4 * n for p, n in zip(payloads, sizes, strict=True))
            for d, p in zip(digests, payloads, strict=True):
                if digest_of(p) != d:
                    raise ValueError(f"chunk {d.hex()} is damaged")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(_crcs(pd.Series(payloads, dtype=object), wide), pa.int64())], names=["digest", "n_ids", "crc"])

    chunks = spark.read.parquet(f"{folder}/chunks").select("digest", "payload", "n_ids").mapInArrow(checked, "digest binary, n_ids int, crc bigint")
    used = _recipes(spark, folder).select("ordinal", "doc_id", "start", "n_tokens", F.posexplode("chunks").alias("k", "digest"))
    docs = (
        used.join(chunks, "digest", "left")
        .groupBy("ordinal")
        .agg(F.first("doc_id").alias("doc_id"), F.first("start").alias("start"), F.first("n_tokens").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("k", "n_ids", "crc"))).alias("parts"))
    )

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crcs = []
            for n, parts in zip(batch.column("n_tokens").to_pylist(), batch.column("parts").to_pylist(), strict=True):
                crc = size = 0
                for p in parts:
                    if p["crc"] is None:
                        raise ValueError("a recipe names a chunk that is not stored")
                    crc, size = crc32_join(crc, p["crc"], 4 * p["n_ids"]), size + p["n_ids"]
                if size != n:
                    raise ValueError(f"a recipe gives {size} ids instead of {n}")
                crcs.append(crc)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "start", "n_tokens", "parts").mapInArrow(whole, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: ordinal, doc_id, ids (whole reconstruction)."""
    to_ids = F.pandas_udf(lambda p, n: pd.Series([np.frombuffer(x, "<u4" if len(x) == 4 * k else "<u2").astype("int64") for x, k in zip(p, n, strict=True)]), "array<bigint>")
    used = _recipes(spark, folder).select("ordinal", "doc_id", F.posexplode("chunks").alias("k", "digest"))
    chunks = spark.read.parquet(f"{folder}/chunks").select("digest", to_ids("payload", "n_ids").alias("ids"))
    parts = used.join(chunks, "digest").groupBy("ordinal", "doc_id").agg(F.array_sort(F.collect_list(F.struct("k", "ids"))).alias("parts"))
    return parts.select("ordinal", "doc_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
