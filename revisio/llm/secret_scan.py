"""Secret scans with a random forest that removes false positives.

Three patterns propose candidates in the whole text, of any length. Runs of key characters that
hold a digit. Private-key blocks from header to footer (without a footer: the lines of key
characters that follow). Values of six bytes or more after `=` or `:`: in quotes all up to the
closing quote on the same line, whatever stands in between; without, up to white space or a quote,
or a comma or semicolon that ends it or that another name and its sign follow; the
name (letters, digits, `_`, `-` and dots) has a credential word in it. All read a text once,
whatever stands in it. The forest scores each
from its length, character transitions, dictionary coverage, path and neighbouring words.
It is grown in numpy from labelled findings: (value, before, after, path, is_secret). A
seeded generator gives a labelled set of public credential formats and of look-alikes
(checksums, placeholders, identifiers, numbers); reviewed findings of one's own can be
passed instead or besides.

Defined results. Null and empty texts: no finding, unchanged. A value found by several
patterns: one finding over all of them. Repeated values: a finding each. Null paths: empty.
Repeated ids: each row has its findings. Empty table: no rows. `redact` keeps all rows and
columns; `scan` reads id, text and path alone.
"""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import string
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from revisio.llm.tokens import give_back, text_batches

THRESHOLD, NEAR, MASK = 0.5, 48, "[SECRET]"
_RUN = re.compile(rb"[A-Za-z0-9_+/\-]{14,}+={0,2}")
_ASSIGN = re.compile(rb"(?<![\w.\-])([\w.\-]++)[\"']?+\s*+[=:]")
_QUOTED = re.compile(rb"""[ \t]*+(["'])((?:\\[^\n]|(?!\1)[^\\\n]){6,}+)\1""")
_VALUE = re.compile(rb"""[ \t]*+["']?+((?:[^\s"',;]|[,;](?=[^\s"',;])(?![\w.\-]++[ \t]*+[=:])){6,}+)""")
_BEGIN, _END = re.compile(rb"-----BEGIN (?:[A-Z0-9]++ )*?PRIVATE KEY-----"), re.compile(rb"-----END (?:[A-Z0-9]++ )*?PRIVATE KEY-----")
_LINES = re.compile(rb"(?:\s*+[A-Za-z0-9+/=]{8,}+)*+")
_NAME = re.compile(rb"(?i)pass(?:word|wd|phrase)|pwd|secret|token|api[_-]?key|access[_-]?key|auth|bearer|credential|private[_-]?key|(?<![a-z])pass(?![a-z])")
_DIGIT = re.compile(rb"[0-9]")
#: Words whose presence in a value speaks for prose, code or a placeholder.
WORDS = tuple(
    """about access account address admin after alpha api application archive article background backup before beta between build
    button case change changeme channel chapter class client code color commit common config connection const container content
    count country current data database date debug default demo description design device document domain download dummy email
    enabled endpoint error event example export feature field file final first folder format from function group guide header
    here home host html http image import index info insert integer internal introduction item java json key label language last
    level library license line link list local location login main manager message method mobile model module month name network
    node null number object online option order other output package page parameter part password path placeholder port preview
    private process product profile project property public python query readme record report request resource response result
    root sample schema script search second secret section server service session setting source start state status string style
    summary support system table target template test text this time title token type update upload user username value version
    video view website window word world year your""".split()
)
#: Neighbouring words for and against a secret.
FOR = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "api-key", "access_key", "auth", "bearer", "credential", "private_key")
AGAINST = ("commit", "sha1", "sha256", "md5", "checksum", "hash", "digest", "uuid", "guid", "isbn", "example", "sample", "revision", "version", "build", "phone", "card", "order", "invoice", "tracking")
_KNOWN = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----[\s\S]*|AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|xox[abprs]-[0-9A-Za-z-]{10,}|eyJ[0-9A-Za-z_-]{8,}|AIza[0-9A-Za-z_-]{35}|sk_(?:live|test)_[0-9A-Za-z]{16,}")
_COVER = re.compile("|".join(sorted(WORDS, key=len, reverse=True)))


@dataclass(frozen=True)
class Finding:
    """A candidate with what stands around it."""

    value: str
    before: str = ""
    after: str = ""
    path: str = ""
    name: str = ""  # what the value is assigned to, where it is longer than `before` shows


def _blocks(raw: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Private-key blocks. Once no footer follows, none follows any later header."""
    at, footers = 0, True
    while m := _BEGIN.search(raw, at):
        end = _END.search(raw, m.end()) if footers else None
        footers = end is not None
        at = end.end() if end else _LINES.match(raw, m.end()).end()
        yield m.start(), at, b"private_key"


def candidates(raw: bytes) -> list[tuple[int, int, bytes]]:
    """Byte spans of candidates, in order and apart from one another, and the names of values that have one."""
    spans = [(m.start(), m.end(), b"") for m in _RUN.finditer(raw) if _DIGIT.search(m[0])]
    spans += _blocks(raw)
    end = 0
    for m in _ASSIGN.finditer(raw):
        if m.end() >= end and _NAME.search(m[1]):  # what stands in a value is in its span
            if value := _QUOTED.match(raw, m.end()):
                span = value.span(2)
            elif value := _VALUE.match(raw, m.end()):
                span = value.span(1)
            else:
                continue
            spans.append((*span, m[1]))
            end = value.end()
    out: list[tuple[int, int, bytes]] = []
    for a, b, name in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]), out[-1][2] or name)
        else:
            out.append((a, b, name))
    return out


def _class(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def features(f: Finding) -> list[float]:
    v, n = f.value, max(len(f.value), 1)
    kinds = [_class(c) for c in v]
    counts = Counter(v)
    longest, run = 1, 1
    for a, b in zip(v, v[1:], strict=False):
        run = run + 1 if a == b else 1
        longest = max(longest, run)
    moves = Counter(zip(kinds, kinds[1:], strict=False))
    low, near, path, name = v.lower(), f.before.lower()[-NEAR:], f.path.lower(), f.name.lower()
    vowels = sum(c in "aeiou" for c in low)
    steps = sum(ord(b) - ord(a) == 1 for a, b in zip(v, v[1:], strict=False))
    return [
        len(v), *(kinds.count(k) / n for k in range(4)),
        sum(c for (a, b), c in moves.items() if a != b) / n, moves[2, 0] / n, moves[0, 2] / n, moves[1, 0] / n, moves[0, 1] / n,
        -sum(c / n * math.log2(c / n) for c in counts.values()), len(counts) / min(n, 64), longest, steps / n, vowels / n,
        float(all(c in string.hexdigits for c in v)), float(v.isdigit()), float(len(v) in (32, 40, 64)),
        sum(len(m[0]) for m in _COVER.finditer(low)) / n, float(bool(_KNOWN.fullmatch(v))),
        float(any(w in near[-24:] or w in name for w in FOR)), float(any(w in near for w in AGAINST)), float(near.rstrip(" \t\"'")[-1:] in ("=", ":")), float(near[-1:] in "\"'" and f.after[:1] in "\"'" and near != ""),
        float(bool(re.search(r"test|example|sample|fixture|doc|readme", path))), float(bool(re.search(r"\.(env|cfg|ini|ya?ml|toml|pem|json)$", path))), float("/" in v or "." in v),
    ]


def labelled_findings(n: int = 6000, seed: int = 2) -> list[tuple[Finding, int]]:
    """A seeded labelled set: public credential formats in use, and look-alikes."""
    r = random.Random(seed)
    pick = lambda alphabet, k: "".join(r.choices(alphabet, k=k))
    hexes, alnum, upper = "0123456789abcdef", string.ascii_letters + string.digits, string.ascii_uppercase + "234567"
    syllables = ["".join(r.choices("bcdfghlmnprstvw", k=1)) + r.choice(["a", "e", "i", "o", "u", "an", "er", "on", "ti"]) for _ in range(80)]
    prose = lambda: " ".join("".join(r.choices(syllables, k=r.randint(1, 5))) for _ in range(r.randint(0, 6)))
    named = lambda: r.choice(FOR) + r.choice(["=", ": ", " = ", ' = "', "='", ':"'])
    real = [
        lambda: (pick(hexes, r.choice([16, 18, 20, 24, 32, 40, 48, 64])), named()), lambda: ("AKIA" + pick(upper, 16), r.choice(["", " ", named()])), lambda: (pick(alnum + "+/", 40), named()),
        lambda: ("gh" + r.choice("pousr") + "_" + pick(alnum, 36), r.choice(["", named()])), lambda: ("xoxb-" + pick(string.digits, 12) + "-" + pick(alnum, 24), r.choice(["", named()])),
        lambda: ("eyJ" + base64.urlsafe_b64encode(pick(alnum, 40).encode()).decode().rstrip("="), r.choice(["Bearer ", named()])), lambda: (pick(alnum + "!#%&*@", r.randint(9, 20)) + pick(string.digits, 2), r.choice(["password=", "passwd: ", "pwd = '"])),
        lambda: ("AIza" + pick(alnum + "_-", 35), r.choice(["", named()])), lambda: ("sk_live_" + pick(alnum, 24), r.choice(["", named()])),
        lambda: (pick(r.choice([alnum + "+/", alnum + "!#%&*@", hexes]), r.choice([100, 250, 600, 1600, 4000])), named()),
        lambda: (" ".join(pick(alnum, r.randint(2, 4)) for _ in range(r.randint(3, 5))) + pick(string.digits, 1), r.choice(FOR[:4]) + r.choice(['="', "='", ': "', ' = "'])),
        lambda: (pick(alnum + "!#%&*@,;.", r.randint(9, 20)) + pick(string.digits, 2), r.choice(FOR) + r.choice(['="', "='", ': "'])), lambda: (pick(alnum, r.randint(4, 8)) + r.choice(",;") + pick(alnum, r.randint(7, 12)) + pick(string.digits, 1), named()),
        lambda: ("-----BEGIN {0}PRIVATE KEY-----\n{1}\n-----END {0}PRIVATE KEY-----".format(r.choice(["", "RSA ", "EC ", "OPENSSH "]), "\n".join(pick(alnum + "+/", 64) for _ in range(r.randint(1, 24)))), r.choice(["", "\n", named()])),
    ]
    alike = [
        lambda: (pick(hexes, r.choice([32, 40, 64])), r.choice(AGAINST[:6]) + r.choice([" ", ": ", "="])), lambda: ("_".join(r.choices(WORDS, k=r.randint(2, 4))) + pick(string.digits, r.randint(1, 4)), r.choice(["", named()])),
        lambda: (r.choice(["x", "*", "0", "A"]) * r.randint(8, 30) + pick(string.digits, 2), named()), lambda: (pick(string.digits, r.randint(14, 19)), r.choice(["", "card ", "phone: ", "order "])),
        lambda: ("-".join(pick(hexes, k) for k in (8, 4, 4, 4, 12)), r.choice(["uuid ", "guid=", "id: ", ""])), lambda: ("".join(r.choices(syllables, k=r.randint(6, 12))) + pick(string.digits, r.randint(1, 2)), ""),
        lambda: ("/".join(r.choices(WORDS, k=4)) + "/" + pick(string.digits, 4), r.choice(["", "path=", "https:"])), lambda: (r.choice(["changeme", "your-api-key-here-", "example-token-", "password"]) + "1234", named()),
        lambda: (f"{r.randint(2000, 2030)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}-{r.choice(WORDS)}-{r.choice(WORDS)}", ""), lambda: ("0123456789abcdef"[: r.randint(14, 16)] * r.randint(1, 3), r.choice(["", named()])),
        lambda: (pick(r.choice([alnum + "+/", hexes]), r.choice([100, 250, 600, 1600, 4000])), r.choice(["", "base64,", "checksum: ", "data="])),
        lambda: (" ".join(r.choices(r.choice([WORDS, syllables]), k=r.randint(2, 6))), r.choice(FOR) + r.choice(['="', "='", ': "', ": "])), lambda: (", ".join(r.choices(WORDS, k=r.randint(2, 4))), r.choice(FOR) + r.choice(['="', ': "'])),
    ]
    paths, mild = ["", "", "src/app/settings.env", "config/prod.yaml", "notes.txt", "src3"], ["", "docs/readme.md", "tests/fixtures/data.json", "src7", "notes.txt"]
    out = []
    for k in range(n):
        label = k % 2
        value, lead = r.choice(real if label else alike)()
        closing = lead[-1:] if lead[-1:] in ("'", '"') else ""
        out.append((Finding(value, f"{prose()} {lead}"[-NEAR:], f"{closing} {prose()}"[:NEAR], r.choice(paths if label else mild)), label))
    return out


@dataclass
class Forest:
    """Trees over binned features, as arrays: feature, threshold, left, right, share of secrets."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, threshold, left, right, share in self.trees:
            at = np.zeros(len(x), np.int64)
            while True:
                inner = left[at] >= 0
                if not inner.any():
                    break
                below = x[rows, feature[at]] <= threshold[at]
                at = np.where(inner, np.where(below, left[at], right[at]), at)
            total += share[at]
        return total / max(len(self.trees), 1)


def grow(x: np.ndarray, y: np.ndarray, *, trees: int = 40, depth: int = 9, least: int = 3, bins: int = 32, seed: int = 2) -> Forest:
    """Bootstrap trees; each node tries a random square root of the features, split by Gini impurity."""
    rng = np.random.default_rng(seed)
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(edges)], axis=1)
    tries, out = max(1, round(math.sqrt(x.shape[1]))), []
    for _ in range(trees):
        nodes: list[list[float]] = [[0, 0.0, -1, -1, 0.0]]
        stack = [(0, rng.integers(0, len(x), len(x)), 0)]
        while stack:
            at, rows, level = stack.pop()
            ones = int(y[rows].sum())
            nodes[at][4] = ones / len(rows)
            if level == depth or len(rows) < 2 * least or ones in (0, len(rows)):
                continue
            best = (1e-9, -1, -1)
            for k in rng.choice(x.shape[1], tries, replace=False):
                b = binned[rows, k]
                n = np.bincount(b, minlength=bins)[:-1].cumsum()
                p = np.bincount(b, y[rows], minlength=bins)[:-1].cumsum()
                m, q = len(rows) - n, ones - p
                fine = (n >= least) & (m >= least)
                if fine.any():
                    gain = np.where(fine, p * p / np.maximum(n, 1) + q * q / np.maximum(m, 1), -1)
                    j = int(gain.argmax())
                    if gain[j] - ones * ones / len(rows) > best[0]:
                        best = (gain[j] - ones * ones / len(rows), int(k), j)
            if best[1] < 0 or best[2] >= len(edges[best[1]]):
                continue
            below = binned[rows, best[1]] <= best[2]
            nodes[at][:4] = best[1], float(edges[best[1]][best[2]]), len(nodes), len(nodes) + 1
            stack += [(len(nodes), rows[below], level + 1), (len(nodes) + 1, rows[~below], level + 1)]
            nodes += [[0, 0.0, -1, -1, 0.0], [0, 0.0, -1, -1, 0.0]]
        table = np.array(nodes)
        out.append((table[:, 0].astype(np.int64), table[:, 1], table[:, 2].astype(np.int64), table[:, 3].astype(np.int64), table[:, 4]))
    return Forest(out)


def fit(findings: Iterable[tuple[Finding, int]] | None = None, **options: int) -> Forest:
    """A forest from labelled findings; the generated set if none are given."""
    rows = list(labelled_findings() if findings is None else findings)
    return grow(np.array([features(f) for f, _ in rows]), np.array([y for _, y in rows], float), **options)


def find(raw: bytes | None, path: str | None, forest: Forest, threshold: float = THRESHOLD) -> list[tuple[int, int, float]]:
    """(begin, end, score) of the candidates of one text that score at least the threshold; byte offsets."""
    spans = candidates(raw or b"")
    if not spans:
        return []
    some = [Finding(raw[a:b].decode(errors="replace"), raw[max(0, a - NEAR) : a].decode(errors="replace"), raw[b : b + NEAR].decode(errors="replace"), path or "", name.decode(errors="replace")) for a, b, name in spans]
    scores = forest.scores(np.array([features(f) for f in some]))
    return [(a, b, float(s)) for (a, b, _), s in zip(spans, scores, strict=True) if s >= threshold]


def scan(docs: DataFrame, forest: Forest, *, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", threshold: float = THRESHOLD) -> DataFrame:
    """One row per finding: id, start and length in characters, score, sha256 of the value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, starts, lengths, scores, hashes = [], [], [], [], []
            paths = batch.column(2).to_pylist() if path_col else [None] * batch.num_rows
            for k0 in range(0, batch.num_rows, 256):
                for k, raw in enumerate(batch.column(1).slice(k0, 256).cast(pa.binary()).to_pylist(), k0):
                    last = chars = 0
                    for a, b, s in find(raw, paths[k], forest, threshold):
                        at.append(k)
                        chars, last = chars + len(raw[last:a].decode(errors="replace")), a
                        starts.append(chars)
                        lengths.append(len(raw[a:b].decode(errors="replace")))
                        scores.append(s)
                        hashes.append(hashlib.sha256(raw[a:b]).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(scores, pa.float64()), pa.array(hashes, pa.string())], names=["doc_id", "start", "length", "score", "value_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    columns = [docs[id_col], docs[text_col], *([docs[path_col].cast("string")] if path_col else [])]
    return docs.select(*columns).mapInArrow(run, f"doc_id {kind}, start bigint, length bigint, score double, value_sha256 string").withColumnRenamed("doc_id", id_col)


def redact(docs: DataFrame, forest: Forest, *, text_col: str = "text", path_col: str | None = "source", length_col: str | None = "n_chars", threshold: float = THRESHOLD, mask: str = MASK) -> DataFrame:
    """All rows and columns; secrets in the text give way to the mask, and length_col (if there is one) follows."""
    names = docs.columns
    text_at, path_at = names.index(text_col), names.index(path_col) if path_col in names else None
    length_at = names.index(length_col) if length_col in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k0 in range(0, whole.num_rows, 1024):
                batch = whole.slice(k0, 1024)
                texts = batch.column(text_at).cast(pa.binary()).to_pylist()
                paths = [None] * len(texts) if path_at is None else batch.column(path_at).to_pylist()
                changed = False
                for k, raw in enumerate(texts):
                    if found := find(raw, paths[k] and str(paths[k]), forest, threshold):
                        parts, last = [], 0
                        for a, b, _ in found:
                            parts += [raw[last:a], mask.encode()]
                            last = b
                        texts[k], changed = b"".join([*parts, raw[last:]]), True
                if not changed:
                    yield batch
                    continue
                columns = list(batch.columns)
                columns[text_at] = pa.array(texts, pa.binary()).cast(pa.string()).cast(columns[text_at].type)
                if length_at is not None:
                    columns[length_at] = pa.array([None if t is None else len(t.decode()) for t in texts], columns[length_at].type)
                yield pa.RecordBatch.from_arrays(columns, names=names)
            give_back()

    text_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
