"""Elias-Fano sequences and n-gram tries over them, read in place from one buffer.

A sequence of n ascending numbers below u keeps the low log2(u / n) bits of each packed side by
side, and the high bits as a unary bit vector: about two bits more than that for each number.
Few questions are answered where they stand; for many the sequence is read once from end to end.
Everything is an array of a single buffer at aligned places, so that a trie opens from bytes that
Arrow hands over, or from a mapped file, without a copy. All queries take arrays.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

import numpy as np

_PAD = 16
_MANY = 8  # one reading of the whole sequence costs less than so many numbers a question


def _low_bits(values: np.ndarray, width: int) -> np.ndarray:
    """The lowest `width` bits of each value, packed, with room to read eight bytes anywhere."""
    packed = []
    for at in range(0, len(values) if width else 0, 1 << 16):  # each piece ends at a byte
        some = np.ascontiguousarray(values[at : at + (1 << 16)]).view(np.uint8).reshape(-1, 8)
        packed.append(np.packbits(np.unpackbits(some, axis=1, bitorder="little")[:, :width].ravel(), bitorder="little"))
    return np.concatenate([*packed, np.zeros(_PAD, np.uint8)])


def _nth_one(words: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """The place of each word's nth set bit."""
    place, nth, words = np.zeros(len(words), np.int64), nth.astype(np.int64), words.copy()
    for half in (32, 16, 8, 4, 2, 1):
        below = np.bitwise_count(words & np.uint64((1 << half) - 1)).astype(np.int64)
        right = nth >= below
        nth -= np.where(right, below, 0)
        words >>= np.where(right, half, 0).astype(np.uint64)
        place += np.where(right, half, 0)
    return place


class Sequence:
    """n ascending unsigned numbers."""

    def __init__(self, parts: Mapping[str, np.ndarray]):
        self.parts = parts
        self.n, self.width = (int(x) for x in parts["shape"])
        self.words, self.low = parts["high"], parts["low"]
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.ones = np.cumsum(ones) - ones
        self.zeros = np.arange(len(ones)) * 64 - self.ones

    @classmethod
    def pack(cls, values: np.ndarray) -> Sequence:
        values = np.asarray(values, np.uint64)
        n, last = len(values), int(values[-1]) if len(values) else 0
        width = min(max(0, ((last + 1) // n).bit_length() - 1), 56) if n else 0
        places = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        bits = np.zeros((((last >> width) + n) // 64 + 3) * 64, np.bool_)
        bits[places] = True
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        return cls({"shape": np.array([n, width], np.int64), "high": high, "low": _low_bits(values, width)})

    def _lows(self, index: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(index), np.uint64)
        bit = index * self.width
        every = np.ndarray((len(self.low) - 7,), "<u8", self.low, strides=(1,))  # eight bytes from any byte on
        return (every[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.width) - 1)

    def _after_zeros(self, h: np.ndarray) -> np.ndarray:
        """How many numbers have a high part below h."""
        out = np.zeros(len(h), np.int64)
        some = h > 0
        nth = h[some] - 1
        word = np.searchsorted(self.zeros, nth, side="right") - 1
        out[some] = word * 64 + _nth_one(~self.words[word], nth - self.zeros[word]) - nth
        return out

    def _run(self, bit: np.ndarray) -> np.ndarray:
        """How many set bits stand from each place on, exact below 56."""
        raw = self.words.view(np.uint8)
        every = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
        some = every[bit >> 3] >> (bit & 7).astype(np.uint64)
        return np.bitwise_count((some ^ (some + np.uint64(1))) >> np.uint64(1)).astype(np.int64)

    def every(self) -> np.ndarray:
        """All numbers, read from the first to the last."""
        ones = np.flatnonzero(np.unpackbits(self.words.view(np.uint8), bitorder="little").view(np.bool_))
        index = np.arange(self.n)
        return ((ones - index).astype(np.uint64) << np.uint64(self.width)) | self._lows(index)

    def get(self, index: np.ndarray) -> np.ndarray:
        index = np.asarray(index, np.int64)
        if len(index) * _MANY > self.n:
            return self.every()[index]
        word = np.searchsorted(self.ones, index, side="right") - 1
        place = word * 64 + _nth_one(self.words[word], index - self.ones[word])
        return ((place - index).astype(np.uint64) << np.uint64(self.width)) | self._lows(index)

    def successor(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of the first number that is not below each wanted one (n if there is none), and whether it equals it."""
        wanted = np.asarray(wanted, np.uint64)
        if not self.n:
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), np.bool_)
        if len(wanted) * _MANY > self.n:
            every = self.every()
            at = np.searchsorted(every, wanted)
            return at, every[np.minimum(at, self.n - 1)] == wanted
        most = len(self.words) * 64 - self.n - 65  # more than any high part, and eight bytes before the end
        high = np.minimum(wanted >> np.uint64(self.width), np.uint64(most)).astype(np.int64)
        beyond = (wanted >> np.uint64(self.width)) > np.uint64(most)
        at = self._after_zeros(high)
        end = at + self._run(at + high)
        long = np.flatnonzero(end - at >= 56)
        end[long] = self._after_zeros(np.minimum(high[long] + 1, most))
        low = wanted & np.uint64((1 << self.width) - 1)
        stop, open_ = end.copy(), np.flatnonzero(at < end)
        while len(open_):  # halve what is left of each bucket
            middle = (at[open_] + stop[open_]) >> 1
            less = self._lows(middle) < low[open_]
            at[open_[less]], stop[open_[~less]] = middle[less] + 1, middle[~less]
            open_ = open_[at[open_] < stop[open_]]
        same = at < end
        same[same] = self._lows(at[same]) == low[same]
        at[beyond], same[beyond] = self.n, False
        return at, same


def codebook(values: np.ndarray, bits: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """(code of each value, mean of each code) of positive values, in equal steps of the logarithm."""
    kind = np.uint8 if bits <= 8 else np.uint16
    if not len(values):
        return np.empty(0, kind), np.empty(0, np.float32)
    logs = np.log(values)
    low = logs.min()
    step = (logs.max() - low) / ((1 << bits) - 1) or 1.0
    code = np.round((logs - low) / step).astype(kind)
    n = np.bincount(code)
    return code, (np.bincount(code, values) / np.maximum(n, 1)).astype(np.float32)


def rank(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a row of each distinct number, ascending, and the place of each row among them). Numbers that leave room for a row's own below them are sorted with it, without an index."""
    n = len(code)
    bits = n.bit_length()
    if int(code.max(initial=0)).bit_length() + bits <= 64:
        both = np.sort((code.astype(np.uint64) << np.uint64(bits)) | np.arange(n, dtype=np.uint64))
        order, code = (both & np.uint64((1 << bits) - 1)).astype(np.int64), both >> np.uint64(bits)
    else:
        order = np.argsort(code)
        code = code[order]
    new = np.ones(n, np.bool_)
    np.not_equal(code[1:], code[:-1], out=new[1:])
    place = np.empty(n, np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    return order[new], place


class Trie:
    """Grams of one order as levels of nodes: each level's numbers are (place of the parent) * words + word.

    `pointers` say where a context's successors begin, as one ascending sequence. A leaf holds the
    code of its smoothed probability, a context the code of its count.
    """

    def __init__(self, parts: Mapping[str, np.ndarray]):
        self.parts = parts
        self.order, self.n_words = (int(x) for x in parts["shape"])
        of = lambda name: Sequence({k: parts[f"{name}.{k}"] for k in ("shape", "high", "low")})
        self.words, self.pointers = of("words"), of("pointers")
        self.levels = [of(f"level{k}") for k in range(self.order)]

    @classmethod
    def build(cls, keys: np.ndarray, grams: list[np.ndarray], leaf: np.ndarray, context: np.ndarray, bits: int = 8) -> Trie:
        """keys: ascending word keys; grams: a column of word numbers for each place, rows ascending; leaf: value by row; context: value by distinct context."""
        n = len(grams[0])
        parts: dict[str, np.ndarray] = {"shape": np.array([len(grams), len(keys)], np.int64)}
        node, new = np.zeros(n, np.int64), np.zeros(n, np.bool_)
        pack = lambda name, values: parts.update({f"{name}.{k}": v for k, v in Sequence.pack(values).parts.items()})
        pack("words", keys)
        begins = np.zeros(1 if n else 0, np.int64)
        for k, column in enumerate(grams):
            if k == len(grams) - 1:
                begins = np.flatnonzero(new) if k else begins
            value = node.astype(np.uint64) * np.uint64(max(1, len(keys))) + column.astype(np.uint64)
            new = np.ones(n, np.bool_)
            new[1:] = value[1:] != value[:-1]
            pack(f"level{k}", value[new])
            node = np.cumsum(new) - 1
        pack("pointers", np.append(begins, n))
        parts["leaf"], parts["leaf_values"] = codebook(leaf, bits)
        parts["context"], parts["context_values"] = codebook(context, bits)
        return cls(parts)

    def context(self, words: list[np.ndarray]) -> np.ndarray:
        """The node of each context, -1 for those that are not there. words: a column of word numbers for each place, -1 for unknown."""
        node = np.zeros(len(words[0]) if words else 1, np.int64)
        for level, column in zip(self.levels, words, strict=False):
            node = self._down(level, node, column)
        return node

    def _down(self, level: Sequence, node: np.ndarray, word: np.ndarray) -> np.ndarray:
        out = np.full(len(word), -1, np.int64)
        some = np.flatnonzero((node >= 0) & (word >= 0))
        at, same = level.successor(node[some].astype(np.uint64) * np.uint64(self.n_words) + word[some].astype(np.uint64))
        out[some[same]] = at[same]
        return out

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        at, same = self.words.successor(keys)
        return np.where(same, at, -1)

    def leaf_code(self, node: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The code of each successor word within its context's range, from 1 on; 0 where there is none."""
        at = self._down(self.levels[-1], node, word)
        out = np.zeros(len(word), np.uint16 if self.parts["leaf"].itemsize == 1 else np.uint32)
        out[at >= 0] = self.parts["leaf"][at[at >= 0]].astype(out.dtype) + 1
        return out

    def leaf_values(self) -> np.ndarray:
        """The value of each code of `leaf_code`."""
        return np.append(np.float32(0), self.parts["leaf_values"])

    def leaf(self, node: np.ndarray, word: np.ndarray) -> np.ndarray:
        return self.leaf_values()[self.leaf_code(node, word)]

    def successors(self, node: np.ndarray) -> np.ndarray:
        """How many words have followed each context: the distance of two pointers."""
        ends = self.pointers.get(np.concatenate([node, node + 1]))
        return (ends[len(node) :] - ends[: len(node)]).astype(np.int64)

    def context_value(self, node: np.ndarray) -> np.ndarray:
        return self.parts["context_values"][self.parts["context"][node]].astype(np.float64)

    def to_bytes(self) -> bytes:
        """A header and all arrays at places that 16 divides."""
        at, table, body = 0, {}, []
        for name, value in self.parts.items():
            raw = np.ascontiguousarray(value).tobytes()
            table[name] = (at, len(value), value.dtype.str)
            body.append(raw + bytes(-len(raw) % _PAD))
            at += len(body[-1])
        head = json.dumps(table).encode()
        head += b" " * (-(len(head) + 8) % _PAD)
        return len(head).to_bytes(8, "little") + head + b"".join(body)

    @classmethod
    def open(cls, buffer) -> Trie:
        """Any buffer: bytes, an Arrow buffer or a mapped file. Nothing is copied."""
        view = memoryview(buffer).cast("B")
        size = int.from_bytes(view[:8], "little")
        table = json.loads(bytes(view[8 : 8 + size]))
        return cls({name: np.frombuffer(view, kind, n, 8 + size + at) if n else np.empty(0, kind) for name, (at, n, kind) in table.items()})
