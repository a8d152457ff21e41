"""The n-gram tries, ball trees and Merkle manifest against brute force, with the edge cases of each contract."""

import hashlib
import mmap
import re
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revisio.llm import balltree, eliasfano, merkle, ngram

SF = "/root/testdata/sf0.001"


# ---- Elias-Fano


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=60), st.integers(1, 64), st.lists(st.integers(0, 2**64 - 1), max_size=20))
def test_sequence_equals_a_sorted_array(numbers, bits, wanted):
    values = np.sort(np.array([x >> (64 - bits) for x in numbers], np.uint64))
    s = eliasfano.Sequence.pack(values)
    assert (s.get(np.arange(len(values))) == values).all()
    asked = np.concatenate([values, np.array(wanted, np.uint64), np.array([0, 2**64 - 1], np.uint64)])
    at, same = s.successor(asked)
    assert (at == np.searchsorted(values, asked)).all() and (same == np.isin(asked, values)).all()


def test_sequence_with_a_long_bucket():
    values = np.concatenate([np.arange(5000), [1 << 50]]).astype(np.uint64)
    s = eliasfano.Sequence.pack(values)
    asked = np.arange(6000)
    assert (s.successor(asked)[0] == np.searchsorted(values, asked)).all()


def test_many_questions_read_a_sequence_once(monkeypatch):
    """As many as the numbers are answered without a search for each, and alike to few."""
    rng = np.random.default_rng(5)
    values = np.sort(np.concatenate([rng.integers(0, 1 << 60, 4000, np.uint64), rng.integers(0, 5000, 4000, np.uint64), np.array([0, 0, 7, 7, 1 << 63], np.uint64)]))
    s = eliasfano.Sequence.pack(values)
    asked = np.concatenate([rng.choice(values, 500), rng.integers(0, 1 << 61, 398, np.uint64), np.array([0, 2**64 - 1], np.uint64)])
    index = rng.integers(0, len(values), 900)
    few = [(s.get(index[k : k + 90]), *s.successor(asked[k : k + 90])) for k in range(0, 900, 90)]  # less than an eighth of the numbers each
    monkeypatch.setattr(eliasfano, "_nth_one", None)
    assert (s.get(np.arange(len(values))) == values).all()
    many = [np.tile(x, 9) for x in (index, asked)]
    got = (s.get(many[0])[:900], *(x[:900] for x in s.successor(many[1])))
    assert all((np.concatenate([f[k] for f in few]) == got[k]).all() for k in range(3))
    assert (got[1] == np.searchsorted(values, asked)).all() and (got[2] == np.isin(asked, values)).all()


def test_codes_are_exact_or_within_a_step():
    few = np.array([0.5, 0.25, 0.5, 1e-9])
    code, mean = eliasfano.codebook(few)
    assert np.allclose(mean[code], few, rtol=1e-6)
    many = np.random.default_rng(0).lognormal(-5, 3, 50_000)
    code, mean = eliasfano.codebook(many)
    step = np.log(many.max() / many.min()) / 255
    assert code.dtype == np.uint8 and np.abs(np.log(mean[code] / many)).max() <= step


def test_trie_is_read_from_a_mapped_file(tmp_path):
    rng = np.random.default_rng(3)
    grams = np.unique(rng.integers(0, 30, (4000, 3)), axis=0)
    keys = np.sort(rng.choice(1 << 40, 30, replace=False)).astype(np.uint64)
    contexts = np.unique(grams[:, :2], axis=0)
    leaf = rng.random(len(grams)) + 0.1
    (tmp_path / "levels").write_bytes(eliasfano.Trie.build(keys, list(grams.T), leaf, np.ones(len(contexts)), bits=16).to_bytes())
    with (tmp_path / "levels").open("rb") as f:
        trie = eliasfano.Trie.open(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
    assert (trie.numbers(keys) == np.arange(30)).all() and (trie.numbers(keys + np.uint64(1)) == -1).all()
    found = dict(zip(map(tuple, grams.tolist()), leaf, strict=True))
    asked = np.stack(np.meshgrid(*[np.arange(30)] * 3), -1).reshape(-1, 3)
    node = trie.context([asked[:, 0], asked[:, 1]])
    assert np.allclose(trie.leaf(node, asked[:, 2]), [found.get(tuple(g), 0) for g in asked.tolist()], rtol=1e-3)
    each = Counter(map(tuple, grams[:, :2].tolist()))
    assert trie.successors(trie.context(list(contexts.T))).tolist() == [each[tuple(c)] for c in contexts.tolist()]
    assert (trie.context([np.array([-1, 0]), np.array([0, -1])]) == -1).all()


# ---- scores


def words(text):
    return [*re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower()), None]


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def brute_scores(rows, discount=0.75):
    learnt = [words(r.text) for r in rows if r.doc_id is not None and not is_held_out(r.doc_id)]
    counts = Counter(w for t in learnt for w in t)
    n, v = sum(counts.values()), len(counts)
    after = {2: defaultdict(Counter), 3: defaultdict(Counter)}
    for t in learnt:
        s = [0, 0, *t]
        for k in range(2, len(s)):
            after[2][s[k - 1]][s[k]] += 1
            after[3][s[k - 2], s[k - 1]][s[k]] += 1
    out = []
    for r in rows:
        t = words(r.text)
        s, base, score = [0, 0, *t], 0.0, 0.0
        for k in range(2, len(s)):
            p = (counts[s[k]] + 1) / (n + v + 1)
            base += log10(p)
            for order, context in ((2, s[k - 1]), (3, (s[k - 2], s[k - 1]))):
                if c := after[order].get(context):
                    total = sum(c.values())
                    p = max(c.get(s[k], 0) - discount, 0) / total + discount * len(c) / total * p
            score += log10(p)
        out.append((r.doc_id, is_held_out(r.doc_id), len(t), sum(counts[w] > 0 for w in t), n, base, score))
    return sorted(out, key=lambda x: (str(x[0]), x[5]))


def compare_scores(frame, off, **options):
    got = sorted((tuple(r) for r in ngram.digests(frame, **options).collect()), key=lambda x: (str(x[0]), x[5]))
    want = brute_scores(frame.select("doc_id", "text").collect())
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(abs(g[5] - w[5]) <= 1e-9 * max(1, g[2]) and abs(g[6] - w[6]) <= off * g[2] for g, w in zip(got, want, strict=True))
    return got


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(1, "a b c a b d", 1), (2, None, 2), (None, "x a b", 3), (1, "A b C", 4), (4, "", 5), (6, "a b c é É " + "z " * 3000, 6), (7, " \t a\x1cb c a b c", 7), (7, " \t a\x1cb c a b c", 7)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, row bigint")


def test_scores_of_odd_rows(spark, texts):
    compare_scores(texts, 1e-6)
    compare_scores(texts.limit(0), 0)
    compare_scores(texts.where("text IS NULL"), 1e-6)
    compare_scores(texts.where("doc_id IS NULL"), 1e-6)  # nothing is learnt


def test_scores_do_not_depend_on_blocks_shards_and_hot_contexts(texts):
    compare_scores(texts, 1e-6, hot_rows=2, shard_rows=5, block_bytes=64)


def test_scores_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = compare_scores(docs, 1e-6, hot_rows=50, shard_rows=3000, block_bytes=20_000, bits=16)
    assert compare_scores(docs, 0.03, shard_rows=100_000)
    held = [g for g in got if g[1]]
    assert sum(g[6] for g in held) > sum(g[5] for g in held)  # better than single words on texts that were not learnt


def test_shared_keys_are_noticed():
    """Two checks under one key are a clash, upon which `scores` takes the next seed."""
    pack = lambda checks: {"shard": 0, "block": 1, "n": 2, "grams": ngram._pack(np.array([5, 0]), "<u8"), "counts": ngram._pack(np.array([1, 1]), "<u4"), "checks": ngram._pack(np.array(checks), "<u4")}
    for checks, clashes in (([1, 2], 1), ([1, 1], 0)):
        told = ngram._word_shard(1, 3, 10, 0)(ngram._table([pack(checks)], ngram._schema(ngram._MESSAGES))).to_pylist()
        assert next(r["count"] for r in told if r["kind"] == "clashes") == clashes
    assert (ngram._keys([b"a"], 0)[0] != ngram._keys([b"a"], 1)[0]).all()


def test_levels_stay_in_the_shared_folder(spark, texts):
    _, model = ngram.scores(texts, F.lit(True))
    for order, path in model.levels.items():
        kept = spark.read.parquet(path).where("kind = 'levels'").collect()
        assert kept and all(eliasfano.Trie.open(bytes(r["first"])).order == order for r in kept)


def test_impossible_settings_are_refused(texts):
    with pytest.raises(ValueError, match="discount"):
        ngram.scores(texts, F.lit(True), discount=1.0)


# ---- clusters


def brute_clusters(rows, k=40, rounds=5, dim=64):
    kept = [(i, np.floor(256 * np.array(v, np.float64)).astype(np.int64)) for i, v in rows if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v.tolist()) for i, v in kept if i is not None)[:k]
    centroids = np.array([v for _, v in first], np.int64).reshape(-1, dim)
    if not len(centroids):
        return []
    data = np.array([v for _, v in kept])
    for turn in range(rounds + 1):
        far = ((data[:, None] - centroids[None]) ** 2).sum(2)
        best = far.argmin(1)
        if turn < rounds:
            for c in range(len(centroids)):
                if (best == c).any():
                    centroids[c] = data[best == c].sum(0) // (best == c).sum()
    d = far[np.arange(len(data)), best]
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    return sorted(((i, int(c), int(x), int(d[best == c].sum()), int(d.sum()), names[c]) for (i, _), c, x in zip(kept, best, d, strict=True)), key=str)


def got_clusters(frame, **options):
    return sorted((tuple(r) for r in balltree.digests(frame, **options).collect()), key=str)


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    near = (rng.normal(size=(30, 64))[rng.integers(0, 30, 1500)] + 0.05 * rng.normal(size=(1500, 64))).astype(np.float32)
    rows = [(i, v.tolist(), "x") for i, v in enumerate(near)]
    rows += [(3, near[0].tolist(), "x"), (3, near[0].tolist(), "x"), (None, near[1].tolist(), "x"), (9001, None, "x"), (9002, [1.0] * 63, "x"), (9003, [float("nan")] * 64, "x"), (9004, [None] * 64, "x"), (9005, [float("-inf")] * 64, "x"), (9006, [], "x")]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, cluster string").repartition(3)
    assert got_clusters(frame, tree_rows=200) == brute_clusters([r[:2] for r in rows])
    alike = spark.createDataFrame([(i, [0.5] * 64) for i in range(50)], "vec_id bigint, embedding array<float>")
    assert got_clusters(alike) == brute_clusters([(i, [0.5] * 64) for i in range(50)])  # all ties: the smaller centroid
    few = frame.where("vec_id < 5")
    assert got_clusters(few) == brute_clusters([(r.vec_id, r.embedding) for r in few.collect()])
    assert got_clusters(frame.limit(0)) == [] and got_clusters(frame.where("vec_id IS NULL")) == []


def test_balls_are_given_away_whole():
    rng = np.random.default_rng(7)
    centres = rng.integers(-5000, 5000, (8, 64))
    vectors = (centres[rng.integers(0, 8, 4000)] + rng.integers(-20, 20, (4000, 64))).astype(np.int32)
    tree = balltree.Tree.build(np.arange(4000), np.ones(4000, bool), vectors)
    whole, open_ = tree.filtered(centres)
    assert sum(tree.ends[b] - tree.starts[b] for b, _ in whole) > 3500 > len(whole) + len(open_)
    cluster, distance = tree.assigned(centres)
    far = ((tree.vectors[:, None].astype(np.int64) - centres[None]) ** 2).sum(2)
    assert (cluster == far.argmin(1)).all() and (distance == far.min(1)).all()


def test_components_beyond_exact_distances_stop_the_query(spark):
    with pytest.raises(Exception, match="too large"):
        got_clusters(spark.createDataFrame([(1, [1e30] * 64)], "vec_id bigint, embedding array<float>"))


# ---- Merkle manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (row.doc_id, row.source, row.lang, row.n_chars, text)))


def brute_tree(nodes):
    """The top node and, for each leaf, what stands before and after it at each level."""
    paths, groups = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = range(0, len(nodes), 3)
        for at in runs:
            run = nodes[at : at + 3]
            for j in range(len(run)):
                for i in groups[at + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
        nodes, groups = [sha("".join(nodes[at : at + 3])) for at in runs], [sum(groups[at : at + 3], []) for at in runs]
    return nodes[0], paths


def brute_manifest(rows):
    by = defaultdict(list)
    for r in rows:
        by["" if r.source is None else "s" + r.source].append((r.doc_id is not None, r.doc_id or 0, leaf(r, r.text), r))
    keys = sorted(by, key=str.encode)
    trees = [brute_tree([x[2] for x in sorted(by[k], key=lambda x: x[:3])]) for k in keys]
    if not keys:
        return []
    root, over = brute_tree([t[0] for t in trees])
    out = []
    for k, (subroot, paths), up in zip(keys, trees, over, strict=True):
        for (*_, own, r), path in zip(sorted(by[k], key=lambda x: x[:3]), paths, strict=True):
            h = own
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0:
                h = leaf(r, None if r.text is None else r.text.replace("\n", ""))
            for before, after in path + up:
                h = sha(before + h + after)
            out.append((r.doc_id, own, subroot, root, sha("".join(a + b for a, b in path + up)), h, h == root))
    return sorted(out, key=str)


def test_manifest_equals_brute_force(spark):
    rows = [(1, "a\nb", "en", "s", 3, 9), (2, None, None, None, None, 9), (None, "x", None, "s", 1, 9), (1, "a\nb", "en", "s", 3, 9), (2, "\n", "é", "é", 1, 9), (6, "a\n", "en", "s", 3, 9), (7, "a\n", "en", "s", 3, 9), (8, "long " * 50_000 + "\n", "en", "z", 1, 9)]
    odd = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, idx int")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for frame in (odd, odd.limit(0), odd.where("source IS NULL"), odd.where("source = 's'"), docs, docs.select("*").withColumn("source", F.col("doc_id").cast("string"))):
        got = sorted((tuple(r) for r in merkle.digests(frame).collect()), key=str)
        assert got == brute_manifest(frame.collect())


def test_tampering_is_seen_and_paths_hold_whole_preimages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = merkle.digests(docs).join(docs.select("doc_id", "text"), "doc_id").collect()
    for r in out:
        tampered = zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and "\n" in (r.text or "")
        assert r.verified != tampered
    paths = merkle.manifest(docs).collect()
    assert all(r.folded_root == r.root for r in paths) and all((len(x.before) + len(x.after)) % 64 == 0 for r in paths for x in r.path)
