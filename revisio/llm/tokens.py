"""Token ids by the `tokenizers` library, each distinct word of a group of texts once.

The word vocabulary drops white space before it splits a text, so that the ids of a
text are the ids of its space-separated words, one after another. A group of texts is cut
into words and these are numbered in Arrow and numpy; the library encodes the distinct
ones, and their ids are then laid out by number. The ids of letter runs and runs of marks
are kept from group to group, in a cache of bounded size.

Ids are those of the library's plain call on the whole text. A text that holds the string of an
added token goes to the library whole, and so does every text if the file's normaliser or
pre-tokenizer is not the one that the cutting relies on.
"""

from __future__ import annotations

import ctypes
import functools
import json
import os
import re
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

SLICE_BYTES = 1 << 21
GROUP_BYTES = 1 << 22
CACHE_WORDS = 400_000
TEXT_ROWS = 4_000
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_IS_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Lower-case Latin-1 letters, then ASCII marks but the apostrophe: two pieces that no rule changes.
_LETTERS, _MARKS = "^[a-zß-öø-ÿ]+$", "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
#: The normaliser and the pre-tokenizer under which words can be encoded apart.
_NORMALISER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
#: The byte-level alphabet: printable bytes stand for themselves, the others for the characters from 256 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _SHOWN)} | {32: 32}


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Path of a public vocabulary file; the files are never copied into the repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Whole texts to little-endian unsigned 32-bit ids. cache_words: pieces that are kept; group_bytes: text that is held at once."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS, group_bytes: int = GROUP_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.path = Tokenizer.from_file(path), path
        with open(path, encoding="utf-8") as f:
            layout = json.load(f)
        self.by_word = layout["normalizer"] == _NORMALISER and layout["pre_tokenizer"] == _PRE_TOKENIZER
        added = [t["content"].encode() for t in layout["added_tokens"]]
        self.added, self.added_start = added, os.path.commonprefix(added)
        if self.by_word:
            self.tokenizer.encode_special_tokens = True  # strings that only become an added token's when they are lower-cased are ordinary text
            self.pieces = Tokenizer.from_str(json.dumps(layout | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}}))
            (self.zero,) = self.pieces.encode("0", add_special_tokens=False).ids
        self.cache_words, self.group_bytes = cache_words, group_bytes
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {"": 0}  # pieces by number
        self.ids, self.begin, self.size = np.empty(0, "<u4"), np.zeros(1, np.int64), np.zeros(1, np.int64)

    def encode(self, text: str | bytes | None) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: Iterable[str | bytes | None]) -> list[bytes]:
        """Ids of each text, no special ids; null: none. Texts of any length go through in slices."""
        out: list[bytes] = []
        group: list[bytes] = []
        size = 0
        for text in texts:
            raw = text.encode() if isinstance(text, str) else text or b""
            if not self.by_word or (self.added and self.added_start in raw and any(t in raw for t in self.added)):
                out += self._group(group) if group else []
                out.append(self._plain_call(raw))
                group, size = [], 0
                continue
            if size + len(raw) > self.group_bytes:
                out += self._group(group) if group else []
                group, size = [], 0
            if len(raw) > self.group_bytes:
                out.append(b"".join(self._group([part])[0] for part in slices(raw, self.group_bytes)))
                continue
            group.append(raw)
            size += len(raw) + 1
        return out + (self._group(group) if group else [])

    def _plain_call(self, raw: bytes) -> bytes:
        return np.array(plain(self.path).encode(raw.decode(), add_special_tokens=False).ids, "<u4").tobytes()

    def _group(self, texts: list[bytes]) -> list[bytes]:
        chars = np.frombuffer(b"\n".join(texts).lower(), np.uint8)
        solid = ~_IS_SPACE[chars]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        place = np.flatnonzero(first)
        if not len(place):
            return [b""] * len(texts)
        data = chars[solid]
        big = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        data[1:][big] += 0x20  # Latin-1 capitals
        words = _binary(np.append(np.flatnonzero(first[solid]), len(data)), data).dictionary_encode()
        ids, begin, size = self._words(words.dictionary.cast(pa.string()))
        del chars, solid, first, data, big
        which = words.indices.to_numpy()
        before = np.concatenate(([0], np.cumsum(size[which])))
        flat = _gather(ids, begin[which], size[which]).tobytes()
        bounds = np.searchsorted(place, np.cumsum([0, *(len(t) + 1 for t in texts)]))
        return [flat[a:b] for a, b in pairwise((4 * before[bounds]).tolist())]

    def _words(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct words end to end, and the begin and number of each word's."""
        core = pc.utf8_rtrim(words, characters=_MARKS)
        plain = pc.match_substring_regex(core, _LETTERS)
        ids, sizes = self._plain(words.filter(plain), core.filter(plain))
        rest, rest_sizes = self._whole(words.filter(pc.invert(plain)).to_pylist())
        is_plain, size = plain.to_numpy(zero_copy_only=False), np.empty(len(words), np.int64)
        size[is_plain], size[~is_plain] = sizes, rest_sizes
        begin = np.empty(len(words), np.int64)
        begin[is_plain], begin[~is_plain] = np.cumsum(sizes) - sizes, len(ids) + np.cumsum(rest_sizes) - rest_sizes
        return np.concatenate([ids, rest]), begin, size

    def _plain(self, words: pa.StringArray, core: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of two pieces end to end, and the number of each word's."""
        if not len(words):
            return np.empty(0, "<u4"), np.empty(0, np.int64)
        ends = np.frombuffer(words.buffers()[1], np.int32)[: len(words) + 1]
        lengths, heads = np.diff(ends), pc.binary_length(core).to_numpy()
        inside = np.arange(ends[-1]) - np.repeat(ends[:-1], lengths)
        marks = np.frombuffer(words.buffers()[2], np.uint8)[: ends[-1]][inside >= np.repeat(heads, lengths)]
        tails = _binary(np.concatenate(([0], np.cumsum(lengths - heads))), marks)
        pieces = pa.concat_arrays([core.cast(pa.binary()), tails]).dictionary_encode()
        number = self._pieces(pieces.dictionary.cast(pa.string()).to_pylist())
        both = number[pieces.indices.to_numpy().reshape(2, -1)]
        return _gather(self.ids, self.begin[both.T.ravel()], self.size[both.T.ravel()]), self.size[both].sum(0)

    def _pieces(self, pieces: list[str], per_line: int = 256) -> np.ndarray:
        """Numbers of pieces that normaliser and pre-tokenizer leave as they are."""
        if len(self.known) > self.cache_words:
            self._forget()
        new = [p for p in pieces if p not in self.known]
        ascii_only = [p for p in new if p.isascii()]
        others = [p for p in new if not p.isascii()]
        lines = [" 0 ".join([*ascii_only[at : at + per_line], ""]) for at in range(0, len(ascii_only), per_line)]  # `0` ends each
        lines += [" 0 ".join([*others[at : at + per_line], ""]).encode().decode("latin-1").translate(_BYTE_CHARS) for at in range(0, len(others), per_line)]
        ids = [np.array(e.ids, "<u4") for at in range(0, len(lines), 16) for e in self.pieces.encode_batch_fast(lines[at : at + 16], add_special_tokens=False)]
        if ids:
            flat = np.concatenate(ids)
            ends = np.flatnonzero(flat == self.zero)
            begin = np.concatenate(([0], ends[:-1] + 1))
            self.known.update(zip(ascii_only + others, range(len(self.begin), len(self.begin) + len(new)), strict=True))
            self.begin, self.size = np.append(self.begin, len(self.ids) + begin), np.append(self.size, ends - begin)
            self.ids = np.append(self.ids, flat)
        return np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))

    def _whole(self, words: list[str], per_line: int = 64) -> tuple[np.ndarray, np.ndarray]:
        """Ids of any other words, and the number of each word's, by the offsets that the whole tokenizer gives."""
        ids, sizes = [np.empty(0, "<u4")], [np.empty(0, np.int64)]
        lines = [words[i : i + per_line] for i in range(0, len(words), per_line)]
        for at in range(0, len(lines), 64):
            some = lines[at : at + 64]
            for line, e in zip(some, self.tokenizer.encode_batch(list(map(" ".join, some)), add_special_tokens=False), strict=True):
                begins = np.cumsum([0, *(len(w) + 1 for w in line)])
                word = np.searchsorted(begins, np.array([o[0] for o in e.offsets], np.int64), side="right") - 1
                ids.append(np.array(e.ids, "<u4"))
                sizes.append(np.bincount(word, minlength=len(line)))
        return np.concatenate(ids), np.concatenate(sizes)


def _binary(ends: np.ndarray, data: np.ndarray) -> pa.BinaryArray:
    """Values that stand end to end in data; ends starts with 0."""
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def _gather(ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs of ids that start at `begin`, end to end."""
    at = np.repeat((begin - (np.cumsum(size) - size)).astype(np.int32), size)
    at += np.arange(len(at), dtype=np.int32)
    return ids[at]


def runs(texts: pa.Array, size: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """(begin, rows) of runs of about `size` bytes of text; a longer text is in a run with what stands before it."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        end = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size)) + 1
        yield at, min(end, len(texts)) - at
        at = end


def slices(raw: bytes, size: int = SLICE_BYTES) -> Iterator[bytes]:
    """Cut only where white space is; a run without any stays whole."""
    at = 0
    while at < len(raw):
        m = _SPACE.search(raw, at + size)
        end = m.end() if m else len(raw)
        yield raw[at:end]
        at = end


@functools.cache
def plain(path: str):
    """The library's tokenizer as the file has it."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.cache
def encoder(path: str | None, group_bytes: int = GROUP_BYTES, cache_words: int = CACHE_WORDS) -> WordEncoder:
    """One encoder for each Python worker and its sizes, kept from task to task. path: on the worker; the default vocabulary where the worker has it, if null."""
    made = WordEncoder(path or vocabulary(), cache_words, group_bytes)
    give_back()
    return made


def text_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> None:
    """Let batches of texts between Spark and Python have so many rows at most: both sides hold several."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))


def give_back() -> None:
    """Return freed memory to the system: workers live on, beside those of other stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass
