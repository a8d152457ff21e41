"""Language-model scores from n-gram tries in Elias-Fano levels, learnt and queried shard by shard.

Texts are cut into words once and kept as blocks: distinct word keys and a stream of word numbers,
with one end token a document. For each order a block sends every distinct gram once to the shard
of the gram's context, with its training count. The shard adds the counts up over all blocks,
builds a trie of the grams that were learnt, and answers every gram of every block by descending
the trie: at each context a successor search within the context's range. Nothing is pruned, and
nothing but counts of counts reaches the driver.

Probabilities are interpolated absolute discounting. A leaf holds the quantised discounted
probability of its word, a context the quantised count, and the number of its successors is the
distance of two pointers; together they give the weight of the next lower order:

    p(w | uv) = a(uvw) + g(uv) * (a(vw) + g(v) * p(w)),   p(w) = (c + 1) / (N + V + 1)

Hot contexts. One word may stand before a third of all others. Words and then pairs of more than
`HOT_ROWS` training occurrences (there are N / HOT_ROWS of them at most, so that the list is
bounded by the number of shards) are dealt over all shards by the word that follows; their exact
count goes along with the list, and the numbers of successors meet in a sum.

Word keys are 64 bits of a 128-bit hash. The other 64 are compared where words meet; if two words
share a key, all is done anew under another seed, so that counts are exact.

Defined results. Null text: empty, the end token alone. Rows of null `learn` are not learnt from.
Repeated rows and ids: a result each, and each is counted. Texts of any length: a document may
span blocks, which carry the words before them. No learnt row: N = 0, and every token is unknown.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revisio.llm.eliasfano import Trie, codebook, rank
from revisio.llm.tokens import give_back, runs, slices
from revisio.plans.lineage import Scratch

ORDER, ORDER_MOST, DISCOUNT, BITS, SHARD_ROWS, HOT_ROWS = 3, 5, 0.75, 8, 1_500_000, 400_000
BLOCK_BYTES, BLOCK_DOCS = 12_000_000, 300_000
START, END = 0, 1  # places of the two marks before the words
_ZSTD = pa.Codec("zstd", compression_level=1)
_BLOCKS = "block bigint, row array<bigint>, doc_id array<bigint>, learn array<boolean>, size array<bigint>, lead array<int>, start bigint, tokens binary, n_tokens bigint, n_words bigint, keys binary, checks binary"
_LEARNT = "block bigint, row array<bigint>, doc_id array<bigint>, learn array<boolean>, size array<bigint>, lead array<int>, start bigint, tokens binary, ids binary, counts binary"
_MESSAGES = "shard bigint, block bigint, n bigint, grams binary, counts binary, checks binary"
_ANSWERS = "kind string, shard bigint, block bigint, n bigint, first binary, second binary, key bigint, count bigint"
_SCORES = "row bigint, doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double"
Row = dict


_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<boolean>": pa.list_(pa.bool_())}


def _schema(ddl: str) -> pa.Schema:
    """The Arrow schema of columns as Spark is told them."""
    return pa.schema([(name, _TYPES[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def _table(rows: list[Row], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema)


def _pack(values: np.ndarray, kind: str) -> bytes:
    """The numbers' lowest bytes, then the next ones, and so on: most of the upper ones are equal."""
    raw = np.ascontiguousarray(values, kind)
    planes = np.ascontiguousarray(raw.view(np.uint8).reshape(len(raw), raw.itemsize).T)
    return len(raw).to_bytes(8, "little") + _ZSTD.compress(planes.tobytes(), asbytes=True)


def _unpack(raw: bytes, kind: str) -> np.ndarray:
    n, size = int.from_bytes(raw[:8], "little"), np.dtype(kind).itemsize
    if not n:
        return np.empty(0, kind)
    planes = np.frombuffer(_ZSTD.decompress(raw[8:], n * size, asbytes=True), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _pack_coded(codes: np.ndarray, values: np.ndarray) -> bytes:
    """Codes and the values of those that occur."""
    used = np.zeros(len(values), np.bool_)
    used[codes] = True
    table = values[used].astype("<f4")
    return len(table).to_bytes(4, "little") + table.tobytes() + _pack((np.cumsum(used) - 1)[codes], "<u4")


def _unpack_coded(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:4], "little")
    return np.frombuffer(raw, "<f4", n, 4)[_unpack(raw[4 + 4 * n :], "<u4")]


def _steps(ascending: np.ndarray) -> np.ndarray:
    return np.diff(ascending, prepend=ascending.dtype.type(0))


def _mixed(parts: list[np.ndarray]) -> np.ndarray:
    """A 64-bit number for each row of the columns."""
    h = np.zeros(len(parts[0]) if parts else 0, np.uint64)
    for part in parts:
        h = (h ^ part.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def _signed(h: np.uint64) -> int:
    """A 64-bit number as Spark holds it; `_unsigned` is the way back."""
    return int(h.astype(np.int64))


def _unsigned(key: int) -> int:
    return key % (1 << 64)


# ---- texts to blocks


def _cut_words(raw: bytes) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """(begin of each word, distinct words, number of each word among them)."""
    chars = np.frombuffer(raw.lower(), np.uint8)  # of bytes, A-Z alone
    solid = (chars != 32) & (chars - np.uint8(9) > 4)
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    begins = np.flatnonzero(first)
    if not len(begins):
        return begins, [], begins
    data = chars[solid]
    ends = np.append(np.flatnonzero(first[solid]), len(data)).astype(np.int32)
    words = pa.BinaryArray.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(ends), pa.py_buffer(data)]).dictionary_encode()
    _, places, held = words.dictionary.buffers()
    places, held = np.frombuffer(places, np.int32, len(words.dictionary) + 1).tolist(), held.to_pybytes()
    return begins, [held[a:b] for a, b in pairwise(places)], words.indices.to_numpy()


def _keys(words: list[bytes], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Key and check of the two marks, which no word can be, and of the words."""
    raw = b"".join(xxhash.xxh3_128_digest(w, seed) for w in (b" ", b"\n", *words))
    both = np.frombuffer(raw, "<u8").reshape(-1, 2)
    return both[:, 0], both[:, 1].astype(np.uint32)


def _renumbered(order: np.ndarray) -> np.ndarray:
    """The new number of each old one, if they are put in this order."""
    number = np.empty(len(order), np.uint32)
    number[order] = np.arange(len(order), dtype=np.uint32)
    return number


def _block(block: int, pieces: list[tuple[Row, bytes, bool]], lead: list[bytes], seed: int) -> Row:
    """Words are numbered in the order of their keys. pieces: a document, some of its text, and whether it ends there. lead: the words before the first piece, if its document began earlier."""
    raw, at, ends = [], 0, []
    for _, text, _ in [(None, b" ".join(lead), False), *pieces]:
        raw.append(text)
        at += len(text) + 1
        ends.append(at)
    begins, words, which = _cut_words(b"\n".join(raw))
    keys, checks = _keys(words, seed)
    order = np.argsort(keys)
    number = _renumbered(order)
    which = number[which + 2]
    upto = np.searchsorted(begins, ends)
    last = np.array([done for *_, done in pieces])
    tokens = which[upto[0] :]
    upto = upto[1:] - upto[0]
    tokens = np.insert(tokens, upto[last], number[END])
    size = np.diff(upto, prepend=0) + last
    before = ([number[START]] * ORDER_MOST + which[: len(lead)].tolist())[-(ORDER_MOST - 1) :]
    return {
        "block": block, "row": [d["row"] for d, *_ in pieces], "doc_id": [d["doc_id"] for d, *_ in pieces], "learn": [d["learn"] for d, *_ in pieces], "size": size.tolist(), "lead": [int(x) for x in before], "start": int(number[START]),
        "tokens": _pack(tokens, "<u4"), "n_tokens": len(tokens), "n_words": len(keys), "keys": _pack(_steps(keys[order]), "<u8"), "checks": _pack(checks[order], "<u4"),
    }


def _tokenise(seed: int, block_bytes: int):
    schema = _schema(_BLOCKS)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, bytes, bool]]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for begin, n in runs(batch.column("text")):
                for doc in batch.slice(begin, n).to_pylist():
                    row += 1
                    raw = (doc.pop("text") or "").encode()
                    parts = list(slices(raw)) if len(raw) > block_bytes // 2 else [raw]
                    for k, part in enumerate(parts or [b""]):
                        yield doc | {"row": row}, part, k + 1 >= len(parts)

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        pieces: list[tuple[dict, bytes, bool]] = []
        lead: list[bytes] = []
        held = 0
        for piece in documents(batches):
            if pieces and (held + len(piece[1]) > block_bytes or len(pieces) >= BLOCK_DOCS):
                number += 1
                yield from _table([_block(number, pieces, lead, seed)], schema).to_batches()
                lead = [] if pieces[-1][2] else _last_words(lead, pieces)
                pieces, held = [], 0
                give_back()
            pieces.append(piece)
            held += len(piece[1])
        if pieces:
            yield from _table([_block(number + 1, pieces, lead, seed)], schema).to_batches()

    return tokenise


def _last_words(lead: list[bytes], pieces: list[tuple[dict, bytes, bool]]) -> list[bytes]:
    """The words that stand before the next piece of a document that goes on."""
    row = pieces[-1][0]["row"]
    own = [text for d, text, _ in pieces if d["row"] == row]
    before = lead if pieces[0][0]["row"] == row else []
    return [*before, *(w for text in own for w in text.lower().split())][-(ORDER_MOST - 1) :]


# ---- grams of a block


@dataclass
class Hot:
    """Contexts that are dealt by the word that follows, ascending, with their training counts and (once known) weights."""

    keys: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    counts: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.empty(0))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places in the list, -1 for other contexts."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)


@dataclass
class Grams:
    """Distinct grams of a block: numbers by place, training counts, the gram of each token, and rows by shard."""

    columns: list[np.ndarray]
    counts: np.ndarray
    of_token: np.ndarray
    rows: np.ndarray
    ends: np.ndarray
    hot: np.ndarray


def _ranked(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(a row of each distinct row, in ascending order, and the place of each row among them)."""
    n = len(columns[0])
    code = columns[0].astype(np.uint64)
    for column in columns[1:]:
        most = int(column.max(initial=0)) + 1
        if ((int(code.max(initial=0)) + 1) * most - 1).bit_length() + n.bit_length() > 64:
            code = rank(code)[1].astype(np.uint64)
        code = code * np.uint64(most) + column.astype(np.uint64)
    return rank(code)


def _begun(row: dict, n: int) -> np.ndarray:
    """For each token, whether a document begins with it."""
    size = np.array(row["size"], np.int64)
    fresh = np.cumsum(size) - size
    if row["lead"][-1] != row["start"]:  # the first document began in an earlier block
        fresh = fresh[1:]
    out = np.zeros(n + 1, np.bool_)
    out[fresh] = True
    return out[:n]


def _grams(row: dict, ids: np.ndarray, order: int, shards: int, hot: Hot) -> Grams:
    tokens = _unpack(row["tokens"], "<u4")
    begun = _begun(row, len(tokens))
    columns = [tokens]
    for k in range(1, order):
        before = np.empty_like(tokens)
        before[1:] = columns[0][:-1]
        before[:1] = row["lead"][-k]
        before[begun] = row["start"]
        columns.insert(0, before)
    first, of_token = _ranked(columns)
    learn = np.repeat(np.array([bool(x) for x in row["learn"]], np.bool_), row["size"])
    counts = np.bincount(of_token[learn], minlength=len(first)) if len(first) else np.empty(0, np.int64)
    named = [ids[c[first]] for c in columns]
    key = _mixed(named[:-1])
    at = hot.find(key)
    key = np.where(at >= 0, _mixed([key, named[-1]]), key)
    shard = (key % np.uint64(shards)).astype(np.uint16 if shards < 1 << 16 else np.int64)
    rows = np.argsort(shard, kind="stable")
    return Grams(named, counts, of_token, rows, np.searchsorted(shard[rows], np.arange(shards + 1)), at)


# ---- words: order one


def _word_messages(shards: int):
    schema = _schema(_MESSAGES)

    def messages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, checks, tokens = np.cumsum(_unpack(row["keys"], "<u8"), dtype=np.uint64), _unpack(row["checks"], "<u4"), _unpack(row["tokens"], "<u4")
                learn = np.repeat(np.array([bool(x) for x in row["learn"]], np.bool_), row["size"])
                counts = np.bincount(tokens[learn], minlength=len(keys))
                counts[row["start"]] = (learn & _begun(row, len(tokens))).sum()
                ends = np.searchsorted(keys, np.array([-(-(k << 64) // shards) for k in range(shards)] + [0], np.uint64))
                ends[-1] = len(keys)
                out = []
                for k in np.flatnonzero(np.diff(ends)).tolist():
                    some = slice(ends[k], ends[k + 1])
                    out.append({"shard": k, "block": row["block"], "n": ends[k + 1] - ends[k], "grams": _pack(_steps(keys[some]), "<u8"), "counts": _pack(counts[some], "<u4"), "checks": _pack(checks[some], "<u4")})
                yield from _table(out, schema).to_batches()

    return messages


def _word_shard(shards: int, order: int, hot_rows: int, seed: int):
    """Ids and counts of each block's words; ids interleave the shards, so that they need no other shard."""
    schema = _schema(_ANSWERS)
    start = _keys([], seed)[0][START]

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        shard = rows[0]["shard"]
        keys = [np.cumsum(_unpack(r["grams"], "<u8"), dtype=np.uint64) for r in rows]
        every = np.concatenate(keys)
        first, which = rank(every)
        words = every[first]
        checks = np.concatenate([_unpack(r["checks"], "<u4") for r in rows])
        counts = np.bincount(which, np.concatenate([_unpack(r["counts"], "<u4") for r in rows])).astype(np.int64)
        ids = np.empty(len(words), np.uint64)
        ids[np.lexsort((words, -counts))] = np.arange(len(words), dtype=np.uint64) * np.uint64(shards) + np.uint64(shard)  # small ones for frequent words
        out = [{"kind": "clashes", "count": int((checks != checks[first][which]).sum())}]
        token = words != start  # the start is counted as a context, and is no token
        out += [{"kind": "tokens", "count": int(counts[token].sum())}, {"kind": "words", "count": int((counts[token] > 0).sum())}]
        for k in np.flatnonzero(~token).tolist():
            out += [{"kind": "start", "n": n, "key": _signed(_mixed([ids[k : k + 1]] * n)[0]), "count": int(counts[k])} for n in range(2, order)]
        for k in np.flatnonzero(counts > hot_rows).tolist():
            out.append({"kind": "hot", "key": _signed(_mixed([ids[k : k + 1]])[0]), "count": int(counts[k])})
        at = 0
        for r, own in zip(rows, keys, strict=True):
            some = which[at : at + len(own)]
            at += len(own)
            out.append({"kind": "answer", "shard": shard, "block": r["block"], "n": len(own), "first": _pack(ids[some], "<u8"), "second": _pack(counts[some], "<u8")})
        give_back()
        return _table(out, schema)

    return answer


# ---- grams of higher orders


def _gram_messages(order: int, shards: int, hot: Hot):
    schema = _schema(_MESSAGES)

    def messages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                g = _grams(row, np.cumsum(_unpack(row["ids"], "<u8")), order, shards, hot)
                for k in np.flatnonzero(np.diff(g.ends)).tolist():
                    some = g.rows[g.ends[k] : g.ends[k + 1]]
                    grams = np.concatenate([_steps(g.columns[0][some]), *(c[some] for c in g.columns[1:])])
                    kind = "<u4" if int(grams.max()) < 1 << 32 else "<u8"
                    out = {"shard": k, "block": row["block"], "n": len(some), "grams": kind[-1].encode() + _pack(grams, kind), "counts": _pack(g.counts[some], "<u4")}
                    yield from _table([out], schema).to_batches()
            give_back()

    return messages


def _learnt_trie(columns: list[np.ndarray], counts: np.ndarray, hot: Hot, discount: float, bits: int) -> tuple[Trie, np.ndarray, np.ndarray]:
    """The trie of distinct ascending grams with a count; and, of the hot contexts, their places in the list and successors here."""
    new = np.zeros(len(counts), np.bool_)
    new[:1] = True
    for c in columns[:-1]:
        new[1:] |= c[1:] != c[:-1]
    begins = np.flatnonzero(new)
    at = hot.find(_mixed([c[begins] for c in columns[:-1]]))
    total = np.add.reduceat(counts, begins) if len(begins) else np.empty(0, np.int64)
    if len(hot.keys):
        total = np.where(at >= 0, hot.counts[at], total)
    context = np.cumsum(new) - 1
    leaf = np.maximum(counts - discount, 0) / total[context] if len(counts) else np.empty(0)
    every = np.concatenate([columns[-1], *(c[begins] for c in columns[:-1])])
    first, which = rank(every)
    last, *before = np.split(which, len(counts) + len(begins) * np.arange(len(columns) - 1))
    trie = Trie.build(every[first], [*(b[context] for b in before), last], leaf, total.astype(np.float64), bits)
    return trie, at[at >= 0], np.diff(np.append(begins, len(counts)))[at >= 0]


def _answers(trie: Trie, columns: list[np.ndarray], discount: float, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of distinct ascending grams the leaf's code, and the code and values of the lower order's weight; a context that was never learnt has weight 1."""
    new = np.zeros(len(columns[0]), np.bool_)
    new[:1] = True
    for c in columns[:-1]:
        new[1:] |= c[1:] != c[:-1]
    begins, context = np.flatnonzero(new), np.cumsum(new) - 1
    numbers = []
    for column in [c[begins] for c in columns[:-1]] + [columns[-1]]:
        first, which = rank(column)
        numbers.append(trie.numbers(column[first])[which])
    node = trie.context(numbers[:-1])
    weight = np.ones(len(begins))
    known = node >= 0
    weight[known] = discount * trie.successors(node[known]) / trie.context_value(node[known])
    code, values = codebook(weight, bits)
    return trie.leaf_code(node[context], numbers[-1]), code[context], values


def _gram_shard(order: int, hot: Hot, discount: float, bits: int, hot_rows: int):
    """Counts meet, the learnt grams become a trie, and the trie answers every block's grams."""
    schema = _schema(_ANSWERS)

    def answer(table: pa.Table) -> pa.Table:
        rows = table.drop_columns(["grams", "counts", "checks"]).to_pylist()
        flat = [_unpack(r[1:], "<u" + r[:1].decode()).reshape(order, -1) for r in table.column("grams").to_pylist()]
        columns = [np.concatenate([np.cumsum(f[0], dtype=f.dtype) if k == 0 else f[k] for f in flat]) for k in range(order)]
        del flat
        first, which = _ranked(columns)
        counts = np.bincount(which, np.concatenate([_unpack(r, "<u4") for r in table.column("counts").to_pylist()])).astype(np.int64)
        columns = [c[first].astype(np.uint64) for c in columns]
        learnt = counts > 0
        trie, at, successors = _learnt_trie([c[learnt] for c in columns], counts[learnt], hot, discount, bits)
        levels = trie.to_bytes()
        opened = Trie.open(levels)
        leaf, weight, weights = _answers(opened, columns, discount, bits)
        out: list[Row] = [{"kind": "levels", "shard": rows[0]["shard"], "n": int(learnt.sum()), "first": levels}]
        out += [{"kind": "successors", "key": _signed(hot.keys[k]), "count": int(n)} for k, n in zip(at, successors, strict=True)]
        some = np.flatnonzero(counts > hot_rows)
        out += [{"kind": "hot", "key": _signed(h), "count": int(n)} for h, n in zip(_mixed([c[some] for c in columns]), counts[some], strict=True)]
        begin = 0
        for r in rows:
            part = which[begin : begin + r["n"]]
            begin += r["n"]
            out.append({"kind": "answer", "shard": r["shard"], "block": r["block"], "n": r["n"], "first": _pack_coded(leaf[part], opened.leaf_values()), "second": _pack_coded(weight[part], weights)})
        del columns, which, leaf, weight
        give_back()
        return _table(out, schema)

    return answer


# ---- blocks with their answers


def _with_ids(blocks: pa.Table, answers: pa.Table) -> pa.Table:
    """A block with the id and count of each of its words, which are then numbered as their ids ascend, so that grams come in the order of ids. Shards hold ranges of keys, in which a block's words stand."""
    out, got = [], answers.sort_by("shard").to_pylist()
    for row in blocks.to_pylist():
        ids = np.concatenate([_unpack(a["first"], "<u8") for a in got])
        counts = np.concatenate([_unpack(a["second"], "<u8") for a in got])
        order = np.argsort(ids)
        number = _renumbered(order)
        kept = {k: row[k] for k in ("block", "row", "doc_id", "learn", "size")}
        out.append(kept | {"lead": number[row["lead"]].tolist(), "start": int(number[row["start"]]), "tokens": _pack(number[_unpack(row["tokens"], "<u4")], "<u4"), "ids": _pack(_steps(ids[order]), "<u8"), "counts": _pack(counts[order], "<u8")})
        give_back()
    return _table(out, _schema(_LEARNT))


def _score(model: Model):
    schema = _schema(_SCORES)

    def score(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        got = answers.sort_by("shard").to_pylist()
        for row in blocks.to_pylist():
            tokens = _unpack(row["tokens"], "<u4")
            ids, counts = np.cumsum(_unpack(row["ids"], "<u8")), _unpack(row["counts"], "<u8").astype(np.float64)
            base = ((counts + 1) / (model.tokens + model.words + 1))[tokens]
            p = base
            for k in range(2, model.order + 1):
                hot = model.hot[k]
                g = _grams(row, ids, k, model.shards, hot)
                leaf, weight = np.empty(len(g.rows)), np.empty(len(g.rows))
                mine = [a for a in got if a["count"] == k]
                leaf[g.rows] = np.concatenate([_unpack_coded(a["first"]) for a in mine] or [np.empty(0)])
                weight[g.rows] = np.concatenate([_unpack_coded(a["second"]) for a in mine] or [np.empty(0)])
                weight[g.hot >= 0] = hot.weights[g.hot[g.hot >= 0]]
                p = leaf[g.of_token] + weight[g.of_token] * p
            of = np.repeat(np.arange(len(row["size"])), row["size"])
            total = lambda values, of=of, n=len(row["size"]): np.bincount(of, values, n)
            out.append(pa.table([row["row"], row["doc_id"], row["size"], total(counts[tokens] > 0).astype(np.int64), total(np.log10(base)), total(np.log10(p))], schema=schema))
        return pa.concat_tables(out) if out else _table([], schema)

    return score


@dataclass
class Model:
    """order, number of shards, training tokens N and distinct words V, the hot contexts of each order, and the folder of the levels (kind `levels`, a row a shard)."""

    order: int
    shards: int
    tokens: int
    words: int
    hot: dict[int, Hot]
    levels: dict[int, str] = field(default_factory=dict)


def _sweep(docs: DataFrame) -> None:
    """Collect the driver's garbage: shuffle files of plans that have run go with it, and there are several times the input of them."""
    docs.sparkSession.sparkContext._jvm.System.gc()


def _hot(rows: list, least: int) -> Hot:
    kept = sorted((_unsigned(r.key), r["count"]) for r in rows if r["count"] > least)
    return Hot(np.array([k for k, _ in kept], np.uint64), np.array([n for _, n in kept], np.int64), np.ones(len(kept)))


def scores(docs: DataFrame, learn: Column, order: int = ORDER, discount: float = DISCOUNT, bits: int = BITS, shard_rows: int = SHARD_ROWS, hot_rows: int = HOT_ROWS, block_bytes: int = BLOCK_BYTES, seed: int = 0) -> tuple[DataFrame, Model]:
    """Per document (row): doc_id, n_tokens, n_known, base_score and score, by a model learnt from the rows where `learn` holds; and the model."""
    if not 0 < discount < 1 or not 2 <= order <= ORDER_MOST:
        raise ValueError(f"a discount lies between 0 and 1, an order between 2 and {ORDER_MOST}")
    scratch = Scratch(docs.sparkSession, "ngrams")
    texts = docs.select("doc_id", "text", F.coalesce(learn, F.lit(False)).alias("learn"))
    while True:
        blocks = scratch.cut(texts.mapInArrow(_tokenise(seed, block_bytes), _BLOCKS), f"blocks-{seed}", compression="zstd")
        sizes = blocks.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("n_words"), F.lit(0)).alias("words")).first()
        shards = [max(1, -(-n // shard_rows)) for n in (sizes.words, sizes.tokens)]
        first = blocks.mapInArrow(_word_messages(shards[0]), _MESSAGES).groupBy("shard").applyInArrow(_word_shard(shards[0], order, hot_rows, seed), _ANSWERS)
        answers = scratch.cut(first, f"words-{seed}", compression="zstd")
        told = {r.kind: r["sum(count)"] for r in answers.where("kind IN ('clashes', 'tokens', 'words')").groupBy("kind").sum("count").collect()}
        if not told.get("clashes"):
            break
        scratch.drop(f"blocks-{seed}", f"words-{seed}")
        seed += 1
    model = Model(order, shards[1], told.get("tokens", 0), told.get("words", 0), {2: _hot(answers.where("kind = 'hot'").collect(), hot_rows)})
    starts = answers.where("kind = 'start'").collect()
    mine = answers.where("kind = 'answer'")
    _sweep(docs)
    learnt = scratch.cut(blocks.drop("n_tokens", "n_words", "keys", "checks").groupBy("block").cogroup(mine.groupBy("block")).applyInArrow(_with_ids, _LEARNT), "learnt", compression="zstd")
    scratch.drop(f"blocks-{seed}", f"words-{seed}")
    _sweep(docs)
    given = None
    for k in range(2, order + 1):
        hot = model.hot[k]
        parts = learnt.mapInArrow(_gram_messages(k, model.shards, hot), _MESSAGES).groupBy("shard").applyInArrow(_gram_shard(k, hot, discount, bits, hot_rows), _ANSWERS)
        parts = scratch.cut(parts, f"order-{k}", compression="zstd")
        model.levels[k] = scratch.path(f"order-{k}")
        followed = {_unsigned(r.key): r["sum(count)"] for r in parts.where("kind = 'successors'").groupBy("key").sum("count").collect()}
        hot.weights = np.array([discount * followed.get(int(h), 0) / n for h, n in zip(hot.keys, hot.counts, strict=True)])
        model.hot[k + 1] = _hot(parts.where("kind = 'hot'").collect() + [r for r in starts if r.n == k], hot_rows)
        _sweep(docs)
        own = parts.where("kind = 'answer'").withColumn("count", F.lit(k).cast("bigint"))
        given = own if given is None else given.union(own)
    if given is None:
        given = docs.sparkSession.createDataFrame([], _ANSWERS)
    found = learnt.groupBy("block").cogroup(given.groupBy("block")).applyInArrow(_score(model), _SCORES)
    whole = found.groupBy("row").agg(F.max("doc_id").alias("doc_id"), *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")))
    return whole, model


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))


def digests(docs: DataFrame, **options) -> DataFrame:
    """Scores of all documents by a model of those that are not held out; rows of a null id are neither held out nor learnt from."""
    found, model = scores(docs, ~held_out() & F.col("doc_id").isNotNull(), **options)
    return found.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
