"""Toxicity scores by a counterfactual-regularised linear classifier.

A text is the set of its words and word stems, hashed. The model is a sparse logistic
regression, trained with proximal gradient steps in numpy. For each sentence of a labelled
text that names a group, twins are made that name another group of its kind instead; squared
differences of the logits of sentence and twin are penalised, so that naming a group moves the
score as little as possible and the neutral mention of one is not taken for an insult. The
groups are a parameter; IDENTITIES has some of English, German, French and Spanish.

Training uses a bounded sample: the `sample` labelled documents with the least hashes of id and
text. Only the features of these rows come to the driver. Words of fewer than `least` sampled
texts are not features.

Defined results. Null and empty texts: the model's bias alone. Labels other than 0 and 1,
null labels, labels of null ids or of ids that no document has: not used. Conflicting labels
of one id: toxic. Repeated ids: each row is scored, and each may be in the sample, which stays
within its bound. Null ids: scored, never held out. No usable labels, or one class alone: the base rate (0.5 without any) for every text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revisio.llm.tokens import give_back, slices, text_batches

SAMPLE, LEAST, STEM, SPACE = 12_000, 3, 5, 1 << 22
#: Groups whose names are swapped for one another.
IDENTITIES = (
    ("women", "men", "girls", "boys", "females", "males"),
    ("woman", "man", "girl", "boy", "female", "male"),
    ("gay", "straight", "lesbian", "bisexual", "queer", "heterosexual", "transgender"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("deaf", "blind", "disabled", "autistic"),
    ("immigrant", "foreigner", "refugee", "citizen"),
    ("immigrants", "foreigners", "refugees", "citizens"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("schwule", "lesben", "heterosexuelle", "bisexuelle"),
    ("muslime", "christen", "juden", "hindus", "buddhisten", "atheisten", "katholiken"),
    ("ausländer", "flüchtlinge", "einwanderer", "einheimische"),
    ("femmes", "hommes", "filles", "garçons"),
    ("gays", "lesbiennes", "hétérosexuels", "bisexuels"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées", "catholiques"),
    ("immigrés", "étrangers", "réfugiés", "citoyens"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("homosexuales", "lesbianas", "heterosexuales", "bisexuales"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos", "católicos"),
    ("inmigrantes", "extranjeros", "refugiados", "ciudadanos"),
)
_SENTENCE = re.compile(r"[.!?\n]+")
_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(raw: bytes) -> set[str]:
    """Distinct lower-case letter runs of a whole text."""
    found: set[str] = set()
    for part in slices(raw):
        found.update(_LETTERS.findall(part.decode().lower()))
    return found


def features_of(word: str) -> list[int]:
    """A word's own hash and, for long words, the hash of its stem."""
    h = [xxhash.xxh32_intdigest(word.encode()) % SPACE]
    return h if len(word) <= STEM else [*h, xxhash.xxh32_intdigest(b"^" + word[:STEM].encode()) % SPACE]


@dataclass
class Model:
    """Weights of the few features that matter; scores whole texts."""

    bias: float
    weights: dict[int, float]
    known: dict[str, float] = field(default_factory=dict)
    twins: int = 0  # counterfactual sentences that the fit used

    def of_word(self, word: str) -> tuple[tuple[int, float], ...]:
        return tuple((f, self.weights[f]) for f in features_of(word) if f in self.weights)

    def logit(self, raw: bytes) -> float:
        """Each feature counts once, however many words share it."""
        if len(self.known) > 300_000:
            self.known.clear()
        known, hits = self.known, {}
        for w in words_of(raw):
            got = known.get(w)
            if got is None:
                got = known[w] = self.of_word(w)
            if got:
                hits.update(got)
        return self.bias + sum(hits[f] for f in sorted(hits))

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        z = np.array([self.logit(t or b"") for t in texts], float)
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class _Rows:
    """Sparse 0/1 rows."""

    def __init__(self, rows: list[np.ndarray]):
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.at = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
        self.of = np.repeat(np.arange(len(rows)), self.sizes)
        self.n = len(rows)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.of, w[self.at], minlength=self.n)

    def back(self, r: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(self.at, r[self.of], minlength=n)


def train(rows: list[np.ndarray], twins: list[tuple[int, np.ndarray, np.ndarray]], y: np.ndarray, *, l1: float = 4e-4, fair: float = 1.0, steps: int = 500, least: int = LEAST, screen: float = 8.0) -> Model:
    """rows: feature hashes of each text. twins: (row, features lost, features gained) of each counterfactual.

    Minimises mean log loss + fair * mean squared logit difference of the twins + l1 * |w|
    by accelerated proximal steps. Features of fewer than `least` texts, and those whose
    share in the two classes does not differ by `screen` (chi-square), are left out.
    """
    if not len(y):
        return Model(0.0, {})
    rate = float(y.mean())
    if not 0 < rate < 1:
        return Model(float(np.log((rate + 1e-3) / (1 - rate + 1e-3))), {})
    both = np.unique(np.concatenate(rows), return_counts=True)
    toxic = np.unique(np.concatenate([r for r, v in zip(rows, y, strict=True) if v]), return_counts=True)
    in_all, in_toxic = both[1].astype(float), np.zeros(len(both[0]))
    in_toxic[np.searchsorted(both[0], toxic[0])] = toxic[1]
    spread = (in_toxic - in_all * rate) ** 2 / (in_all * rate * (1 - rate) * np.maximum(1 - in_all / len(y), 1e-9))
    named = np.unique(np.concatenate([np.empty(0, np.int64), *(t[k] for t in twins for k in (1, 2))]))
    kept = both[0][(in_all >= least) & ((spread >= screen) | np.isin(both[0], named))]
    if not len(kept):
        return Model(float(np.log(rate / (1 - rate))), {})

    def place(f: np.ndarray) -> np.ndarray:
        at = np.searchsorted(kept, f).clip(max=len(kept) - 1)
        return at[kept[at] == f]

    n = len(kept)
    x = _Rows([np.append(place(r), n) for r in rows])  # the last column is the bias
    lost, gained = _Rows([place(t[1]) for t in twins]), _Rows([place(t[2]) for t in twins])

    def curve(v: np.ndarray) -> np.ndarray:
        out = 0.25 * x.back(x.dot(v), n + 1) / x.n
        if len(twins):
            gap = lost.dot(v) - gained.dot(v)
            out = out + 2 * fair / len(twins) * (lost.back(gap, n + 1) - gained.back(gap, n + 1))
        return out

    v = np.ones(n + 1)
    for _ in range(20):
        v = curve(v)
        v /= np.linalg.norm(v)
    step = 0.9 / np.linalg.norm(curve(v))
    penalty = np.append(np.full(n, l1 * step), 0.0)
    w, t = np.append(np.zeros(n), np.log(rate / (1 - rate))), 1.0
    ahead = w
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x.dot(ahead), -40, 40)))
        slope = x.back(p - y, n + 1) / x.n
        if len(twins):
            gap = lost.dot(ahead) - gained.dot(ahead)
            slope = slope + 2 * fair / len(twins) * (lost.back(gap, n + 1) - gained.back(gap, n + 1))
        moved = ahead - step * slope
        after = np.sign(moved) * np.maximum(np.abs(moved) - penalty, 0)
        if float(((ahead - after) * (after - w)).sum()) > 0:
            t = 1.0
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = after + (t - 1) / t_next * (after - w), after, t_next
    return Model(float(w[n]), {int(f): float(c) for f, c in zip(kept, w[:n], strict=True) if c})


def features_of_all(words: set[str]) -> set[int]:
    return {f for w in words for f in features_of(w)}


def twin_features(text: str, identities: tuple[tuple[str, ...], ...] = IDENTITIES, most: int = 3) -> list[tuple[list[int], list[int]]]:
    """For each sentence that names a group and each of `most` other groups of its kind: (features lost, features gained).

    Features that another word of the sentence has as well are neither.
    """
    kind_of = {w: g for g in identities for w in g}
    out: dict[tuple[tuple[int, ...], tuple[int, ...]], None] = {}
    for sentence in _SENTENCE.split(text.lower()):
        words = set(_LETTERS.findall(sentence))
        for w in sorted(words & kind_of.keys()):
            group = kind_of[w]
            k, before = group.index(w), features_of_all(words)
            for other in [group[(k + j) % len(group)] for j in range(1, min(most, len(group) - 1) + 1)]:
                after = features_of_all((words - {w}) | {other})
                out[tuple(sorted(before - after)), tuple(sorted(after - before))] = None
    return [(list(a), list(b)) for a, b in out if a or b]


def _training_rows(batches: Iterator[pa.RecordBatch], identities: tuple[tuple[str, ...], ...]) -> Iterator[pa.RecordBatch]:
    """Columns text, y, place to y, place, features, twins."""
    longs = pa.list_(pa.int64())
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some, rows, twins = batch.slice(at, 256), [], []
            for raw in some.column(0).cast(pa.binary()).to_pylist():
                rows.append(sorted(features_of_all(words_of(raw or b""))))
                found = [t for part in slices(raw or b"") for t in twin_features(part.decode(), identities)]
                twins.append([{"lost": a, "gained": b} for a, b in found])
            yield pa.RecordBatch.from_arrays([some.column(1), some.column(2), pa.array(rows, pa.list_(pa.int32())), pa.array(twins, pa.list_(pa.struct([("lost", longs), ("gained", longs)])))], names=["y", "place", "features", "twins"])


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE, identities: tuple[tuple[str, ...], ...] = IDENTITIES, **options: float) -> Model:
    """Train on documents with a label whose id is not held out, at most `sample` of them. options: those of `train`."""
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(id_col).agg(F.max(label_col).cast("int").alias("toxicity_y"))
    chosen = usable.orderBy(F.xxhash64(id_col), id_col).limit(sample)
    rows = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col).select(text_col, "toxicity_y", F.struct(F.xxhash64(id_col).alias("h"), F.xxhash64(text_col).alias("t")).alias("place"))
    made = rows.mapInArrow(lambda it: _training_rows(it, identities), "y int, place struct<h:bigint,t:bigint>, features array<int>, twins array<struct<lost:array<bigint>,gained:array<bigint>>>")
    found = made.orderBy("place").limit(sample).select("y", "features", "twins").toArrow()
    lists = found.column("features").combine_chunks()
    values, ends = lists.values.to_numpy().astype(np.int64), lists.offsets.to_numpy()
    x = [values[a:b] for a, b in zip(ends, ends[1:], strict=False)]
    twins = [(i, np.array(t["lost"], np.int64), np.array(t["gained"], np.int64)) for i, ts in enumerate(found.column("twins").to_pylist()) for t in ts]
    model = train(x, twins, np.array(found.column("y").to_pylist(), float), **options)
    model.twins = len(twins)
    del found, lists, values, x, twins  # the driver lives on through a pipeline's other stages
    give_back()
    return model


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted), one row per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.concatenate([np.empty(0), *(model.scores(batch.column(1).slice(at, 256).cast(pa.binary()).to_pylist()) for at in range(0, batch.num_rows, 256))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {kind}, score double, predicted int").withColumnRenamed("doc_id", id_col)


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows that the model does not reject, with their columns."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                keep = model.scores(some.column(names.index(text_col)).cast(pa.binary()).to_pylist()) < threshold
                if keep.any():
                    yield some.filter(pa.array(keep))
            give_back()

    text_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
