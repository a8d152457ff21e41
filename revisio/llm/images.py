"""Cropped and edited copies of images, by local descriptors.

Corners of a Harris response at several scales, each the strongest within APART pixels, so
that their number grows with the image and a crop keeps those inside it, are turned to the direction of their
intensity centroid and described by 128 binary tests of a smoothed patch. Descriptors meet
in Hamming tables: a key is one of a descriptor's three blocks, so that two that differ in up to
two bits share a key by the pigeonhole rule, and many that differ in more bits do so as well. Keys
are as long for many descriptors as for few: longer ones would lose copies. A copy shares many corners. Images that share a key are compared: corners within `near_bits` of each other, wherever they stand, are matches, and `agree` of
them must follow one similarity transform (scale, turn, shift) before the two count as copies.

Images of equal pixels are one node from the start. In two rounds each image first meets one
other, of those that stand for a key the one it shares most keys with; then all pairs of images that share a key and are not in one component yet are
compared, so that only pairs already joined are left out (`links` does not count them).

Defined results. Null and empty images: a class of their own each. Undecodable images and
images without corners: equal bytes or pixels are one class, nothing else links to them.
Repeated ids: each row has the class of its own picture. Null ids: rows of their class, which
they name only where it has no other id (a null class). Equal pixels are told apart from others
by 64 bits of their SHA-256. Formats: binary PGM and PPM, PNG of 8 bits without interlacing.
Other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revisio.llm.keyed import all_pairs, nearest_stars, open_rows, shared_keys
from revisio.operators.components import connected_components
from revisio.plans.lineage import Scratch

SCALES, APART, PATCH, NEAR_BITS, AGREE, PIXELS = (1.0, 0.7071, 0.5), 3, 15, 20, 5, 3.0
BLOCKS, CHOSEN = 3, 1  # whatever the number of descriptors: of a hundred billion random ones, each shares a key of 43 bits with 0.02 others
TIE = 0.01  # grey levels: flat places give equal bits whatever the rounding
_RNG = np.random.default_rng(4)
_TESTS = np.clip(_RNG.normal(0, PATCH / 2.2, (128, 4)), -PATCH + 1, PATCH - 1)
_TURNS = 90
_ROTATED = np.stack([np.concatenate([_TESTS[:, :2] @ m, _TESTS[:, 2:] @ m], axis=1) for m in (np.array([[np.cos(a), np.sin(a)], [-np.sin(a), np.cos(a)]]) for a in np.arange(_TURNS) * 2 * np.pi / _TURNS)]).round().astype(np.int64)


def decode(raw: bytes | None) -> np.ndarray | None:
    """Grey values (height, width) from 0 to 255, or None."""
    try:
        if raw and raw[:2] in (b"P5", b"P6"):
            m = re.match(rb"P[56](?:\s+#[^\n]*)*\s+(\d+)\s+(\d+)\s+(\d+)\s", raw)
            w, h, k = int(m[1]), int(m[2]), 3 if raw[:2] == b"P6" else 1
            return np.frombuffer(raw, np.uint8, w * h * k, m.end()).reshape(h, w, k).mean(2)
        if raw and raw[:8] == b"\x89PNG\r\n\x1a\n":
            return _png(raw)
    except (ValueError, TypeError, KeyError, IndexError, struct.error, zlib.error):
        pass
    return None


def _png(raw: bytes) -> np.ndarray | None:
    at, data, head = 8, b"", b""
    while at + 8 <= len(raw):
        n, kind = struct.unpack(">I4s", raw[at : at + 8])
        body = raw[at + 8 : at + 8 + n]
        head, data = (body if kind == b"IHDR" else head), (data + body if kind == b"IDAT" else data)
        at += 12 + n
    w, h, bits, colour, _, _, interlace = struct.unpack(">IIBBBBB", head)
    channels = {0: 1, 2: 3, 4: 2, 6: 4}[colour]
    if bits != 8 or interlace:
        return None
    rows = np.frombuffer(zlib.decompress(data), np.uint8).reshape(h, 1 + w * channels)
    out = np.zeros((h, w * channels), np.int64)
    above = np.zeros(w * channels, np.int64)
    for y in range(h):
        kind, line = rows[y, 0], rows[y, 1:].astype(np.int64)
        if kind == 2:
            line = (line + above) & 255
        elif kind == 1:
            line = (line.reshape(w, channels).cumsum(0) & 255).ravel()
        elif kind:
            for x in range(len(line)):
                a, b, c = (line[x - channels], above[x], above[x - channels]) if x >= channels else (0, above[x], 0)
                p = a + b - c
                guess = (a + b) // 2 if kind == 3 else min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
                line[x] = (line[x] + guess) & 255
        out[y] = above = line
    pixels = out.reshape(h, w, channels)
    return pixels[:, :, : 3 if channels > 2 else 1].mean(2)


def encode_pgm(grey: np.ndarray) -> bytes:
    return b"P5 %d %d 255\n" % (grey.shape[1], grey.shape[0]) + np.clip(np.rint(grey), 0, 255).astype(np.uint8).tobytes()


def _box(x: np.ndarray, r: int) -> np.ndarray:
    """Sums over (2r+1)-squares of a stack, edges repeated."""
    p = np.pad(x, ((0, 0), (r + 1, r), (r + 1, r)), mode="edge").cumsum(1).cumsum(2)
    n = 2 * r + 1
    return p[:, n:, n:] - p[:, :-n, n:] - p[:, n:, :-n] + p[:, :-n, :-n]


def _resize(x: np.ndarray, scale: float) -> np.ndarray:
    if scale == 1:
        return x
    h, w = max(1, int(x.shape[1] * scale)), max(1, int(x.shape[2] * scale))
    soft = _box(x, 1) / 9
    ys, xs = np.minimum((np.arange(h) + 0.5) / scale - 0.5, x.shape[1] - 1).clip(0), np.minimum((np.arange(w) + 0.5) / scale - 0.5, x.shape[2] - 1).clip(0)
    y0, x0 = ys.astype(int), xs.astype(int)
    y1, x1 = np.minimum(y0 + 1, x.shape[1] - 1), np.minimum(x0 + 1, x.shape[2] - 1)
    fy, fx = (ys - y0)[None, :, None], (xs - x0)[None, None, :]
    rows = soft[:, y0] * (1 - fy) + soft[:, y1] * fy
    return rows[:, :, x0] * (1 - fx) + rows[:, :, x1] * fx


def describe(stack: np.ndarray) -> list[np.ndarray]:
    """Corners of images of one size: per image, rows of x, y, scale, turn, and two 64-bit words (as float-free structure)."""
    kind = np.dtype([("x", "f4"), ("y", "f4"), ("scale", "f4"), ("turn", "f4"), ("d0", "i8"), ("d1", "i8"), ("power", "f8")])
    found: list[list[np.ndarray]] = [[] for _ in range(len(stack))]
    margin = int(PATCH * 1.5) + 1
    for scale in SCALES:
        x = _resize(stack.astype(float), scale)
        if min(x.shape[1:]) <= 2 * margin:
            continue
        dx, dy = np.zeros_like(x), np.zeros_like(x)
        dx[:, :, 1:-1], dy[:, 1:-1] = x[:, :, 2:] - x[:, :, :-2], x[:, 2:] - x[:, :-2]
        a, b, c = _box(dx * dx, 2), _box(dy * dy, 2), _box(dx * dy, 2)
        power = a * b - c * c - 0.05 * (a + b) ** 2
        inner = np.zeros(power.shape, bool)
        inner[:, margin:-margin, margin:-margin] = True
        peak = power
        for axis in (1, 2):
            peak = np.max([np.roll(peak, k, axis) for k in range(-APART, APART + 1)], axis=0)
        n, ys, xs = np.nonzero(inner & (power == peak) & (power > 1e4))
        if not len(n):
            continue
        span = np.arange(-PATCH + 2, PATCH - 1)
        wy, wx = (g.ravel() for g in np.meshgrid(span, span, indexing="ij"))
        disc = wy * wy + wx * wx <= (PATCH - 2) ** 2
        patch = x[n[:, None], ys[:, None] + wy[disc], xs[:, None] + wx[disc]]
        turn = np.arctan2(patch @ wy[disc].astype(float), patch @ wx[disc].astype(float))
        offsets = _ROTATED[np.rint(turn * _TURNS / (2 * np.pi)).astype(int) % _TURNS]
        soft = _box(_box(x, 2), 1) / 225
        first = soft[n[:, None], ys[:, None] + offsets[:, :, 1], xs[:, None] + offsets[:, :, 0]]
        second = soft[n[:, None], ys[:, None] + offsets[:, :, 3], xs[:, None] + offsets[:, :, 2]]
        words = np.packbits(second - first > TIE, axis=1, bitorder="little").view("<i8")
        rows = np.zeros(len(n), kind)
        rows["x"], rows["y"], rows["scale"], rows["turn"], rows["power"] = xs / scale, ys / scale, 1 / scale, turn, power[n, ys, xs]
        rows["d0"], rows["d1"] = words[:, 0], words[:, 1]
        for k, begin, end in zip(*(lambda u, at: (u, at, np.append(at[1:], len(n))))(*np.unique(n, return_index=True)), strict=True):
            found[k].append(rows[begin:end])
    out = []
    for parts in found:
        rows = np.concatenate(parts) if parts else np.zeros(0, kind)
        out.append(rows[np.lexsort((rows["x"], rows["y"], rows["scale"], -rows["power"]))])
    return out


_CORNER = "struct<x:float,y:float,scale:float,turn:float,d0:bigint,d1:bigint>"


def _describe_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("x", "y", "scale", "turn", "d0", "d1")
    types = [pa.float32()] * 4 + [pa.int64()] * 2
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            raws = batch.column(1).slice(at, 64).to_pylist()
            grey = [decode(r) for r in raws]
            shapes = defaultdict(list)
            for k, g in enumerate(grey):
                if g is not None and g.size:
                    shapes[g.shape].append(k)
            corners: list[np.ndarray | None] = [None] * len(raws)
            for some in shapes.values():
                for k, rows in zip(some, describe(np.stack([grey[k] for k in some])), strict=True):
                    corners[k] = rows
            sizes = [0 if c is None else len(c) for c in corners]
            flat = [np.concatenate([np.empty(0), *(c[n] for c in corners if c is not None)]).astype("f4") if n in names[:4] else np.concatenate([np.empty(0, "i8"), *(c[n] for c in corners if c is not None)]) for n in names]
            values = pa.StructArray.from_arrays([pa.array(f, t) for f, t in zip(flat, types, strict=True)], names=list(names))
            digests = [hashlib.sha256(str(g.shape).encode() + g.astype("<f8").tobytes() if g is not None else b"raw" + r).digest() if r else None for g, r in zip(grey, raws, strict=True)]
            nodes = pa.array([None if d is None else int.from_bytes(d[:8], "little", signed=True) for d in digests], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 64), nodes, pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), values)], names=["id", "node", "corners"])


def agreement(a: np.ndarray, b: np.ndarray, enough: int | None = None) -> int:
    """Most distinct corners whose matches follow one similarity transform; a and b: x, y, scale, turn of either side of each match.

    enough: stop once so many agree.
    """
    zoom, turn = b[:, 2] / a[:, 2], b[:, 3] - a[:, 3]
    cos, sin = zoom * np.cos(turn), zoom * np.sin(turn)
    best = 0
    for k in range(len(a)):
        px = b[k, 0] + cos[k] * (a[:, 0] - a[k, 0]) - sin[k] * (a[:, 1] - a[k, 1])
        py = b[k, 1] + sin[k] * (a[:, 0] - a[k, 0]) + cos[k] * (a[:, 1] - a[k, 1])
        near = (np.hypot(px - b[:, 0], py - b[:, 1]) <= PIXELS * max(1, zoom[k])) & (np.abs(np.log(zoom / zoom[k])) < 0.3)
        best = max(best, min(len({*map(tuple, a[near, :2])}), len({*map(tuple, b[near, :2])})))
        if enough and best >= enough:
            break
    return best


def matches(a: np.ndarray, b: np.ndarray, near_bits: int = NEAR_BITS, rows: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Places of corners within near_bits of each other; columns d0, d1 of either image."""
    found = []
    for at in range(0, len(a), rows):
        some = a[at : at + rows]
        i, j = np.nonzero(np.bitwise_count(some[:, None, 0] ^ b[None, :, 0]) + np.bitwise_count(some[:, None, 1] ^ b[None, :, 1]) <= near_bits)
        found.append((i + at, j))
    return (np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])) if found else (np.empty(0, int), np.empty(0, int))


def _corner_lists(column: pa.ListArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(x, y, scale, turn) and (d0, d1) of each list."""
    flat = column.flatten()
    places = np.stack([flat.field(n).to_numpy() for n in ("x", "y", "scale", "turn")], axis=1).astype(float)
    words = np.stack([flat.field(n).to_numpy() for n in ("d0", "d1")], axis=1)
    ends = np.cumsum([0, *(len(x) for x in column)])
    return [(places[a:b], words[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


def _consent(batches: Iterator[pa.RecordBatch], near_bits: int, agree: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some, ok = batch.slice(at, 256), []
            for (pa_, da), (pb, db) in zip(_corner_lists(some.column(2)), _corner_lists(some.column(3)), strict=True):
                i, j = matches(da, db, near_bits)
                ok.append(len(i) >= agree and agreement(pa_[i], pb[j], agree) >= agree)
            yield some.select([0, 1]).filter(pa.array(ok, pa.bool_()))


def _keys(d0: Column, d1: Column, blocks: int = BLOCKS, chosen: int = CHOSEN) -> Column:
    """Array of keys: the bits of each choice of blocks, and the choice's number."""
    edges = [128 * k // blocks for k in range(blocks + 1)]
    keys = []
    for number, some in enumerate(itertools.combinations(range(blocks), chosen)):
        mask = sum((1 << edges[k + 1]) - (1 << edges[k]) for k in some)
        halves = [m - (1 << 64) if m >> 63 else m for m in (mask & (1 << 64) - 1, mask >> 64)]
        keys.append(F.xxhash64(F.lit(number), d0.bitwiseAND(F.lit(halves[0])), d1.bitwiseAND(F.lit(halves[1]))))
    return F.array(*keys)


def links(corners: DataFrame, near_bits: int = NEAR_BITS, agree: int = AGREE) -> DataFrame:
    """Pairs (a, b), a < b, of images (columns node, corners) whose corners agree; they join all that agrees."""
    scratch = Scratch(corners.sparkSession, "image-links")
    keyed = corners.select("node", F.explode("corners").alias("c")).select("node", F.explode(_keys(F.col("c.d0"), F.col("c.d1"))).alias("key"))
    keys = scratch.cut(shared_keys(keyed), "keys")
    shared = scratch.cut(keys.join(keys.groupBy("node").agg((-F.count("*")).alias("rest")), "node"), "shared")
    found = tried = None
    for turn, find in enumerate((lambda s: nearest_stars(s, F.struct("rest", "node")), lambda s: nearest_stars(s, F.xxhash64("node", "key")), all_pairs)):
        state = scratch.cut(open_rows(shared, found if found is None else connected_components(found)), f"state-{turn}")
        pairs = find(state)
        pairs = scratch.cut(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), f"pairs-{turn}")
        both = pairs.join(corners.select(F.col("node").alias("a"), F.col("corners").alias("left")), "a").join(corners.select(F.col("node").alias("b"), F.col("corners").alias("right")), "b")
        new = scratch.cut(both.select("a", "b", "left", "right").mapInArrow(lambda it: _consent(it, near_bits, agree), "a bigint, b bigint"), f"links-{turn}")
        scratch.drop(f"state-{turn}")
        found, tried = (new, pairs) if found is None else (found.union(new), tried.union(pairs))
    scratch.drop("keys", "shared")
    return found


def copies(table: DataFrame, *, id_col: str = "image_id", image_col: str = "image", **options: int) -> DataFrame:
    """One row per row: id, class_id (least id of the images linked to it), links (between different images), corners."""
    scratch = Scratch(table.sparkSession, "images")
    kind = table.schema[id_col].dataType.simpleString()
    seen = scratch.cut(table.select(id_col, image_col).mapInArrow(_describe_rows, f"id {kind}, node bigint, corners array<{_CORNER}>"), "corners")
    nodes = scratch.cut(seen.where("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("least"), F.first("corners").alias("corners")), "nodes")
    found = scratch.cut(links(nodes.select("node", "corners"), **options), "links")
    degree = found.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("links"))
    rooted = nodes.select("node", "least").join(connected_components(found), "node", "left").withColumn("root", F.coalesce("component", "node")).join(degree, "node", "left")
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("class_id")), "root").select(F.col("node").alias("named"), "class_id", F.coalesce("links", F.lit(0)).alias("links"))
    alone = F.col("node").isNull()
    return seen.join(named, F.col("node") == F.col("named"), "left").select(
        F.col("id").alias(id_col), F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"), F.size("corners").alias("corners")
    )


SIDE = 112


@functools.lru_cache(maxsize=8)
def _fields(part: int, side: int = SIDE) -> np.ndarray:
    """Pictures of 256 components: smooth noise, fine and coarse."""
    noise = np.random.default_rng((4, part)).normal(size=(256, side, side))
    both = _box(_box(noise, 2) / 25, 1) / 9 + _box(_box(noise[::-1], 3) / 49, 2) / 25
    return (both / both.std()).reshape(256, -1).astype("f4")


def render(vectors: np.ndarray, side: int = SIDE) -> np.ndarray:
    """Grey images of the rows: sums of a picture for each component, at the strength of the vector's direction. Close vectors give close images, and every patch depends on all components."""
    total = np.zeros((len(vectors), side * side), "f4")
    for at in range(0, vectors.shape[1], 256):
        part = vectors[:, at : at + 256]
        total += part.astype("f4") @ _fields(at // 256, side)[: part.shape[1]]
    norm = np.linalg.norm(vectors, axis=1).clip(1e-12)
    return np.clip(128 + 45 * total / norm[:, None], 0, 255).reshape(-1, side, side)


def turned(grey: np.ndarray, degrees: float) -> np.ndarray:
    """The image turned about its centre; edges repeat."""
    h, w = grey.shape
    ys, xs = np.mgrid[:h, :w] - np.array([(h - 1) / 2, (w - 1) / 2])[:, None, None]
    c, s = np.cos(np.radians(degrees)), np.sin(np.radians(degrees))
    y, x = np.clip(c * ys - s * xs + (h - 1) / 2, 0, h - 1), np.clip(s * ys + c * xs + (w - 1) / 2, 0, w - 1)
    y0, x0 = np.minimum(y.astype(int), h - 2), np.minimum(x.astype(int), w - 2)
    fy, fx = y - y0, x - x0
    return (grey[y0, x0] * (1 - fx) + grey[y0, x0 + 1] * fx) * (1 - fy) + (grey[y0 + 1, x0] * (1 - fx) + grey[y0 + 1, x0 + 1] * fx) * fy


#: Copies of a rendered image, by kind: a crop of 56 % of its area, a turn, an edit of brightness and contrast.
EDITS = {"crop": lambda g: g[15:99, 10:94], "turn": lambda g: turned(g, 25), "edit": lambda g: g * 0.7 + 40}


def render_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", copied: Column | None = None) -> DataFrame:
    """(id, image): each vector as a PGM; null vectors, empty ones and null or non-finite components: a null image.

    copied: rows whose image is also written with each of EDITS (k-th: id -3 * id - 1 - k, below
    all ids that are not negative).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                ids, vectors, more = (batch.column(k).slice(at, 256).to_pylist() for k in range(3))
                images: list[bytes | None] = [None] * len(ids)
                sizes = defaultdict(list)
                for k, v in enumerate(vectors):
                    if v and all(c is not None and np.isfinite(c) for c in v):
                        sizes[len(v)].append(k)
                extra: list[tuple[int, bytes]] = []
                for some in sizes.values():
                    for k, grey in zip(some, render(np.array([vectors[k] for k in some], float)), strict=True):
                        images[k] = encode_pgm(grey)
                        if more[k] and ids[k] is not None:
                            extra += [(-3 * ids[k] - 1 - n, encode_pgm(edit(np.rint(grey)))) for n, edit in enumerate(EDITS.values())]
                yield pa.RecordBatch.from_arrays([pa.array([*ids, *(e[0] for e in extra)], batch.column(0).type), pa.array([*images, *(e[1] for e in extra)], pa.binary())], names=["id", "image"])

    kind = table.schema[id_col].dataType.simpleString()
    chosen = F.coalesce(copied, F.lit(False)) if copied is not None else F.lit(False)
    return table.select(F.col(id_col), F.col(vector_col), chosen.alias("copied")).mapInArrow(run, f"id {kind}, image binary").withColumnRenamed("id", id_col)
