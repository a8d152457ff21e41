"""Language identification by averaged hashed subword embeddings and a linear softmax.

Subwords are the character n-grams of a text's letter runs, word ends included, hashed into
`buckets` rows of an embedding table. The mean embedding of all subwords of the whole text
goes through a linear softmax. Table and head are trained by stochastic gradient descent in
numpy. The temperature is fitted on training rows that no gradient step sees, and so is the
rejection threshold: the confidence from which on the precision is reached. The head is
linear, so scoring reads a row of the product of table and head for each subword.

Training uses a bounded sample: the `sample` labelled rows with the least hash of their id,
of which the counts of distinct buckets go to the driver.

Defined results. Null text or no letter: `und`, score 0. Null languages are not learnt.
Ties of languages: the first by code point. No usable row: every text is `und`. Repeated
ids: each row has a result. Null ids: never held out, never learnt from. Other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revisio.llm.tokens import slices

SAMPLE, BUCKETS, DIM, GRAMS = 2_000, 1 << 16, 16, (1, 2, 3, 4)
UNKNOWN = "und"


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def subwords(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of every n-gram of letters, with at most a word end at either side."""
    chars = [np.frombuffer(("\n" + t.decode().lower()).encode("utf-32-le", "replace"), "<u4") for t in texts]
    of = np.repeat(np.arange(len(texts)), [len(c) for c in chars])
    codes = np.concatenate([*chars, np.array([10], np.uint32)])
    of = np.append(of, len(texts))
    letter = _letters()[codes]
    keep = letter.copy()
    keep[:-1] |= letter[1:]  # of a run without letters, its last place stands for the word end
    keep[-1] = letter.any()  # the end of the last run, whatever stands after it
    codes, of, letter = np.where(letter, codes, 0)[keep].astype(np.uint64), of[keep], letter[keep]
    buckets, texts_of = [], []
    for n in GRAMS:
        if len(codes) < n:
            continue
        count = len(codes) - n + 1
        h = np.full(count, n, np.uint64)
        good = np.ones(count, bool)
        for k in range(n):
            h = (h ^ codes[k : k + count]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            if n == 1 or 0 < k < n - 1:
                good &= letter[k : k + count]
        if n == 2:
            good &= letter[:count] | letter[1:]
        buckets.append((h[good] >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1))
        texts_of.append(of[:count][good])
    none = np.empty(0, np.int64)
    return np.concatenate([none, *buckets]), np.concatenate([none, *texts_of])


@dataclass
class Model:
    """languages, the product of table and head (buckets x languages), bias, temperature, threshold."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """(logits, number of subwords) of each text; long texts go through in slices."""
        sums, sizes = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        parts = [(k, part) for k, t in enumerate(texts) for part in slices(t or b"", 1 << 18)]
        while parts:
            take, size = 0, 0
            while take < len(parts) and (not take or size + len(parts[take][1]) <= 1 << 18):
                size += len(parts[take][1])
                take += 1
            some, parts = parts[:take], parts[take:]
            bucket, of = subwords([p for _, p in some])
            of = np.array([k for k, _ in some])[of]
            for c in range(len(self.languages)):
                sums[:, c] += np.bincount(of, self.table[:, c][bucket], minlength=len(texts))
            sizes += np.bincount(of, minlength=len(texts))
        return sums / np.maximum(sizes, 1)[:, None] + self.bias, sizes

    def predict(self, texts: list[bytes | None]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        z, sizes = self.logits(texts)
        p = _softmax(z / self.temperature)
        best, score = p.argmax(1), p.max(1)
        sure = (sizes > 0) & (score >= self.threshold)
        return [self.languages[k] if s else UNKNOWN for k, s in zip(best, sure, strict=True)], np.where(sizes > 0, score, 0.0)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray]], langs: list[str], *, epochs: int = 12, rate: float = 4.0, batch: int = 16, seed: int = 10, precision: float = 0.99) -> Model:
    """rows: (distinct buckets, counts) of each text. One text in eight calibrates."""
    names = sorted(set(langs))
    if not names:
        return Model([], np.zeros((0, 0)), np.zeros(0))
    y = np.array([names.index(x) for x in langs])
    sparse = [(at, counts / max(counts.sum(), 1)) for at, counts in rows]
    rng = np.random.default_rng(seed)
    table, head, bias = rng.normal(0, 1, (BUCKETS, DIM)), np.zeros((DIM, len(names))), np.zeros(len(names))
    calibrates = np.arange(len(rows)) % 8 == 7 if len(rows) >= 64 else np.zeros(len(rows), bool)
    learns = np.flatnonzero(~calibrates)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for some in np.array_split(rng.permutation(learns), max(1, len(learns) // batch)):
            at, place = np.unique(np.concatenate([sparse[i][0] for i in some]), return_inverse=True)
            share = np.zeros((len(some), len(at)))
            share[np.repeat(np.arange(len(some)), [len(sparse[i][0]) for i in some]), place] = np.concatenate([sparse[i][1] for i in some])
            mean = share @ table[at]
            slope = _softmax(mean @ head + bias)
            slope[np.arange(len(some)), y[some]] -= 1
            slope /= len(some)
            back = slope @ head.T
            head -= step * mean.T @ slope
            bias -= 0.1 * step * slope.sum(0)
            table[at] -= step * share.T @ back
    model = Model(names, table @ head, bias)
    if calibrates.any():
        kept = np.flatnonzero(calibrates)
        z = np.stack([sparse[i][1] @ model.table[sparse[i][0]] + bias for i in kept])
        loss = lambda t: -np.log(_softmax(z / t)[np.arange(len(kept)), y[kept]] + 1e-12).mean()
        model.temperature = float(min(np.geomspace(0.05, 20, 60), key=loss))
        p = _softmax(z / model.temperature)
        order = np.argsort(-p.max(1), kind="stable")
        right = np.cumsum(p.argmax(1)[order] == y[kept][order]) / np.arange(1, len(kept) + 1)
        good = np.flatnonzero(right >= precision)
        model.threshold = float(p.max(1)[order][good[-1]]) if len(good) else 1.0
    return model


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [np.unique(subwords([t or b""])[0], return_counts=True) for t in batch.column(0).cast(pa.binary()).to_pylist()]
        ints = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([f[0] for f in found], ints), pa.array([f[1] for f in found], ints), batch.column(2)], names=["lang", "buckets", "counts", "key"])


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, **options: float) -> Model:
    """Train on rows with a language whose id is not held out: at most `sample` rows."""
    usable = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    chosen = usable.select(id_col).orderBy(F.xxhash64(id_col), id_col).limit(sample).distinct()
    rows = usable.select(id_col, text_col, lang_col).join(F.broadcast(chosen), id_col).select(text_col, lang_col, F.xxhash64(id_col))
    counted = rows.mapInArrow(_training_rows, "lang string, buckets array<int>, counts array<int>, key bigint")
    found = counted.where(F.size("buckets") > 0).orderBy("key", "lang").limit(sample).toArrow()
    lists = [found.column(c).combine_chunks() for c in ("buckets", "counts")]
    (at, ends), (counts, _) = ((x.values.to_numpy().astype(np.int64), x.offsets.to_numpy()) for x in lists)
    return train([(at[a:b], counts[a:b].astype(float)) for a, b in zip(ends, ends[1:], strict=False)], found.column("lang").to_pylist(), **options)


def predict(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score), one row per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], [np.empty(0)]
            for at in range(0, batch.num_rows, 256):
                n, s = model.predict(batch.column(1).slice(at, 256).cast(pa.binary()).to_pylist())
                names += n
                scores.append(s)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(np.concatenate(scores))], names=["doc_id", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double").withColumnRenamed("doc_id", id_col)
