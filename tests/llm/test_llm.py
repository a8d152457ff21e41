"""Training-data operators against brute force, exact round trips and held-out accuracy, with the edge cases of each contract."""

import hashlib
import zlib
from datetime import UTC

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from revisio.llm import chat, images, jaccard, langid, mixing, packing, queries, secret_scan, simhash, store, tokens, toxicity, vafile

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, piece int, start string"
assert UTC


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty, long and repeated texts, ties, clashing extra columns."""
    long = " ".join(f"word{k}" for k in range(9000))
    rows = [(1, "a b c d e f", "en", "s1", 11, 7, "x"), (1, "a b c d e f", "en", "s1", 11, 7, "x"), (2, None, None, None, None, None, None), (3, "", "en", "s2", 0, None, None), (None, "a b", "en", "s1", 3, None, None),
            (5, long, "en", "s3", len(long), 1, "y"), (6, " \t\n", "fr", "s2", 3, 1, "y"), (7, "naïve </s> É [INST] 12.5, it's", None, "s3", 20, 1, "y")]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def reference_ids(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.vocabulary())  # the plain call of the library
    return [*t.encode(text or "", add_special_tokens=False).ids, 1]


def test_word_encoder_equals_the_library(docs):
    texts = [r.text for r in docs.collect()] + ["", None, "İ can't, won't. ÉÁ \x1cx\x85y z 12.5,a.b,c. <|endoftext|> </s>, 你好 ΣΣ. x́ ́ 한 ,. a,. don't.###", "a,", "x <|ENDOFTEXT|> y", "a<|startoftext|>b <|EndOfText|>", "<|endoftext|>" * 3, "<|endoftext |> <|", "È<|endoftext|>É"]
    small = tokens.WordEncoder(tokens.vocabulary(), cache_words=50)
    assert [np.frombuffer(x, "<u4").tolist() for x in small.encode_all(texts)] == [reference_ids(t)[:-1] for t in texts]
    long = "ab, cd " * 500_000
    assert small.encode(long) == small.encode("ab, cd ") * 500_000


def test_other_vocabularies_are_encoded_whole():
    """A file with another normaliser gives the library's own ids."""
    from tokenizers import Tokenizer

    path = tokens.vocabulary("byte_bpe_50k.json")
    other, library = tokens.WordEncoder(path), Tokenizer.from_file(path)
    texts = ["Two  spaces, a tab\tand É", "", None, "don't <|endoftext|> stop"]
    assert not other.by_word
    assert [np.frombuffer(x, "<u4").tolist() for x in other.encode_all(texts)] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_chat(spark):
    rows = [(1, 1, "assistant", "x</s>\\[INST] <\\/s>"), (1, 0, "user", None), (1, 1, "assistant", "x</s>\\[INST] <\\/s>"), (2, None, None, "[/INST]"), (None, 0, "assistant", ""), (3, 0, "system", "<s>s"), (3, 1, "assistant", "é𝄞"), (3, 2, "assistant", "b")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("segments", F.lit(1))
    out = {r.conv_id: r for r in chat.digests(frame).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert out[1].turns_sha256 == sha("user\n\n" + "assistant\nx</s>\\[INST] <\\/s>\n" * 2) and out[1].loss_sha256 == sha("x</s>\\[INST] <\\/s>" * 2)
    assert out[3].loss_sha256 == sha("é𝄞b") and out[3].loss_chars == 3 and out[2].n_turns == 1 and out[None].loss_chars == 0
    formatted = chat.format_conversations(frame)
    spans = sorted((r.example, r.prompt, r.target) for r in chat.materialise(formatted).where("conv_id = 3").collect())
    assert spans == [(0, "[INST]system[/INST]<\\s>s</s>[INST]assistant[/INST]", "é𝄞"), (1, "[INST]system[/INST]<\\s>s</s>[INST]assistant[/INST]é𝄞</s>[INST]assistant[/INST]", "b")]
    assert chat.digests(frame.where("false")).count() == 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql_twins(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    fix = lambda rows: sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=repr)
    assert fix(df.select(*columns).collect()) == fix(con.sql(f"SELECT {', '.join(columns)} FROM ({queries.SQL[name]})").fetchall())


def test_packing(spark, docs, odd, nothing):
    both = docs.select("doc_id", "text").union(odd.select("doc_id", "text"))
    rows = packing.pack(both.repartition(6, "doc_id"), fan_in=2).collect()
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 4096
    total = sum(r.length for r in rows)
    assert len(sequences) <= 1.02 * total / 4096 + 2
    whole = {}
    for r in both.collect():
        ids = np.array(reference_ids(r.text), "<u4")
        for p, a in enumerate(range(0, len(ids), 4096)):
            part = ids[a : a + 4096]
            whole.setdefault((r.doc_id, p, a, len(part), zlib.crc32(part.tobytes())), []).append(1)
    got = {}
    for r in rows:
        got.setdefault((r.doc_id, r.piece, r.start, r.length, r.ids_crc32), []).append(1)
    assert got == whole
    assert packing.pack(nothing).count() == 0


def fewest_bins(sizes, capacity):
    """Least number of bins, by trying all ways."""
    best = len(sizes)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(sizes):
            best = len(rooms)
            return
        for i in range(len(rooms)):
            if rooms[i] >= sizes[k]:
                place(k + 1, [*rooms[:i], rooms[i] - sizes[k], *rooms[i + 1 :]])
        place(k + 1, [*rooms, capacity - sizes[k]])

    place(0, [])
    return best


@pytest.mark.parametrize("kind", ["few", "halves", "large", "mixed"])
def test_packing_up_the_tree(spark, kind):
    """No two sequences fit together, over partitions whose bins only meet up the tree; few pieces: against all packings."""
    rng = np.random.default_rng(21)
    sizes = {"few": rng.integers(1, 16, 9), "halves": rng.integers(7, 10, 300), "large": rng.integers(9, 17, 400), "mixed": rng.integers(1, 40, 500)}[kind].tolist()
    frame = spark.createDataFrame([(k, " ".join(["a"] * (n - 1))) for k, n in enumerate(sizes)], "doc_id bigint, text string").repartition(11)
    rows = packing.pack(frame, capacity=16, slack=0, fan_in=2).collect()
    fills, pieces = {}, {}
    for r in rows:
        fills[r.sequence_id] = fills.get(r.sequence_id, 0) + r.length
        pieces.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(fills.values()) == sum(sizes) and max(fills.values()) <= 16
    assert all(sorted(p) == [(sum(n for _, n in sorted(p)[:k]), sorted(p)[k][1]) for k in range(len(p))] for p in pieces.values())
    least = sorted(fills.values())
    assert len(least) < 2 or least[0] + least[1] > 16
    if kind == "few":
        assert len(fills) <= fewest_bins(sizes, 16) + 1


def test_best_fit_of_large_items():
    bins, offsets, fills = packing.best_fit(np.array([2500, 2500, 1500, 1500, 96, 96]))
    assert fills.tolist() == [4096, 4096] and bins[0] != bins[1] and offsets.max() == 4000


def brute_print(text):
    words = simhash_words(text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_words(text):
    import re

    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def brute_components(prints):
    distinct = sorted({p for _, p in prints})
    label = {p: p for p in distinct}
    changed = True
    while changed:
        changed = False
        for a in distinct:
            for b in distinct:
                if (a ^ b).bit_count() <= 4 and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    least = {}
    for i, p in prints:
        if i is not None:
            least[label[p]] = min(least.get(label[p], i), i)
    return sorted(((i, f"{p:016x}", least.get(label[p])) for i, p in prints), key=repr)


@pytest.mark.parametrize("tree_size", [20_000, 3])
def test_simhash(spark, docs, odd, nothing, tree_size):
    both = docs.select("doc_id", "text").union(odd.select("doc_id", "text"))
    got = sorted((tuple(r) for r in simhash.components(both, tree_size=tree_size).collect()), key=repr)
    assert got == brute_components([(r.doc_id, brute_print(r.text)) for r in both.collect()])
    assert simhash.components(nothing).count() == 0


def test_forest_finds_what_brute_force_finds():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 12, dtype=np.uint64)
    noise = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (12, 150, 3)).astype(np.uint64), axis=2)
    prints = np.unique((base[:, None] ^ noise).ravel())
    i, j = np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None]) <= 4)
    want = simhash._union(np.arange(len(prints)), i, j)
    for block in (40, 100_000):
        a, b = simhash.spanning_links(prints, np.zeros(len(prints), np.int64), block=block)
        assert len(a) < len(prints) and (simhash._union(np.arange(len(prints)), a, b) == want).all()
    for n in (10, 10**7, 10**9):
        blocks, chosen = simhash.band_plan(n)
        assert blocks - chosen >= 4


def test_trees_prune():
    """A search of a shard's tree meets a part of its nodes alone, and in a linked group next to none."""
    rng = np.random.default_rng(4)
    prints = np.unique(rng.integers(0, 2**63, 3000, dtype=np.uint64))
    forest = simhash.Forest(prints, np.zeros(len(prints), np.int64))
    forest.search(prints, np.zeros(len(prints), np.int64), 4)
    apart = forest.visited / len(prints) ** 2
    group = np.unique(prints[0] ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (3000, 2)).astype(np.uint64), axis=1))
    forest = simhash.Forest(group, np.zeros(len(group), np.int64))
    label = np.zeros(len(group), np.int64)
    forest.search(group, np.zeros(len(group), np.int64), 4, (label, forest.uniform(label)))
    assert apart < 0.5 and forest.visited <= len(group)


def test_keep_one(spark, odd):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and sorted(map(repr, (r.doc_id for r in kept.collect()))) == ["1", "2", "5", "7", "None"]
    text, other = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(30))
    rows = [(1, text, "x"), (5, text, "x"), (5, other, "x"), (None, text, "x"), (None, "c d", "x"), (None, "c d", "x")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string, root string"))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == [(1, text), (5, other), (None, "c d")]


def test_keep_one_goes_through_the_forest(spark, monkeypatch):
    """Sets are linked by fingerprints first; what these link wrongly is refuted, what they miss is found."""
    words = [f"w{k}" for k in range(200)]
    near, far = [*words[:199], "other"], [f"x{k}" if k % 40 == 0 else w for k, w in enumerate(words)]
    sets = [jaccard.shingle_set(" ".join(w).encode()) for w in (words, near, far, [f"v{k}" for k in range(50)])]
    prints = [simhash.mark(s) for s in sets]
    apart = [(a ^ prints[0]).bit_count() if (a ^ prints[0]) >= 0 else ((a ^ prints[0]) + 2**64).bit_count() for a in prints]
    assert apart[1] <= simhash.RADIUS < apart[3]
    found = {(r.a, r.b) for r in simhash.linked_sets(spark.createDataFrame([*zip(range(4), prints, strict=True), (9, prints[3])], "node bigint, print bigint")).collect()}
    assert {(0, 1), (3, 9)} <= found and (0, 3) not in found
    asked, real = [], simhash.linked_sets
    monkeypatch.setattr(simhash, "linked_sets", lambda s: asked.append(s.count()) or real(s))
    rows = [(k, " ".join(w)) for k, w in enumerate((words, near, far, words, ["a", "b"]))]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string"))
    want = brute_near_copies(rows)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(min(i for i, k in enumerate(want) if k == w) for w in set(want)) and asked == [4]


def test_sketches_bound_the_difference():
    """Sketches never tell more than the true difference, and tell apart what is far from similar."""
    rng = np.random.default_rng(6)
    for n in (1, 5, 70, 900, 30_000):
        base = np.unique(rng.integers(-(2**63), 2**63, n))
        for share in (0.0, 0.05, 0.12, 0.4, 1.0):
            other = np.unique(np.concatenate([base[rng.random(len(base)) >= share], rng.integers(-(2**63), 2**63, int(n * share))]))
            true = len(np.setxor1d(base, other))
            told = jaccard.apart(jaccard.sketch(base), jaccard.sketch(other))
            assert told <= true and (told - true) % 2 == 0
            assert jaccard.similar(base, other) == (9 * true <= len(base) + len(other))
            if n >= 900 and share >= 0.4:
                assert 9 * told > len(base) + len(other)
    assert jaccard.sketch(np.empty(0, np.int64)) == bytes(8)


def variants(rng):
    """Originals with copies of one to ten changed words of 200: their similarity is around the threshold."""
    rows = []
    for base in range(6):
        words = [f"g{base}w{k}" for k in range(200)]
        for copy in range(12):
            at = set(rng.choice(200, rng.integers(1, 11), replace=False).tolist())
            rows.append((100 * base + copy, " ".join(f"x{copy}k{k}" if k in at else w for k, w in enumerate(words))))
    return rows


@pytest.mark.parametrize("groups", [{}, {"crowd": 1, "part": 4}, {"crowd": 1}])
def test_refuted_pairs_hide_no_link(spark, groups):
    """Pairs that only sketches let pass hide nothing, and groups in parts find what joins find."""
    rows = variants(np.random.default_rng(12))
    want, first = brute_near_copies(rows), {}
    for (i, _), k in zip(rows, want, strict=True):
        first[k] = min(first.get(k, i), i)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    roots = {}
    for r in jaccard.components(frame, **groups).collect():
        roots.setdefault(r.root, []).append(r.doc_id)
    assert 6 < len(first) < len(rows) and sorted(map(min, roots.values())) == sorted(first.values())


def test_groups_of_sketches_equal_all_pairs():
    rng = np.random.default_rng(13)
    sets = []
    for size in (5, 14, 15, 16, 17, 30, 60, 64, 65, 130):
        base = rng.integers(-(2**63), 2**63, size)
        sets += [np.unique(np.concatenate([base[rng.random(size) > share], rng.integers(-(2**63), 2**63, int(size * share))])) for share in (0, 0, 0.05, 0.1, 0.2)]
    n, node = np.array([len(x) for x in sets]), rng.permutation(len(sets))
    label, sketches = rng.integers(0, 40, len(sets)), [jaccard.sketch(x) for x in sets]
    fits = lambda i, j: label[i] != label[j] and 5 * min(n[i], n[j]) >= 4 * max(n[i], n[j]) and 9 * jaccard.apart(sketches[i], sketches[j]) <= n[i] + n[j]
    want = {(i, j) for i in range(len(sets)) for j in range(i) if fits(i, j)}
    order = lambda i, j: {(max(a, b), min(a, b)) for a, b in zip(i.tolist(), j.tolist(), strict=True)}
    assert len(want) > 30 and order(*jaccard.near_in_group(node, n, label, sketches, np.zeros(len(sets), bool), 7)) == want
    asks = rng.random(len(sets)) < 0.5
    assert order(*jaccard.near_in_group(node, n, label, sketches, asks, 7)) == {(i, j) for i, j in want if asks[i] != asks[j]}


def brute_near_copies(rows):
    """Least id of each document's group: all pairs, shingle sets of five words, Jaccard of 0.8 or more."""
    words = [simhash_words(t) for _, t in rows]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    label = list(range(len(rows)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i):
            if a == sets[j] or (5 * min(len(a), len(sets[j])) >= 4 * max(len(a), len(sets[j])) > 0 and 5 * len(a & sets[j]) >= 4 * len(a | sets[j])):
                label[root(i)] = root(j)
    return [root(k) for k in range(len(rows))]


def test_near_copies_equal_brute_force(spark, docs, nothing):
    """Groups of exact and near copies around the threshold, one of them large, and a line that all texts have."""
    rng = np.random.default_rng(5)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    line = " ".join(f"common{k}" for k in range(30))
    for base in range(4):
        words = [f"b{base}w{k}" for k in range(150)]
        for copy in range(60 if base == 0 else 12):
            other = [f"x{base}c{copy}k{k}" if k in set(rng.integers(0, 150, copy % 6)) else w for k, w in enumerate(words)]
            rows.append((10_000 + 100 * base + copy, " ".join(other) + (" " + line if base % 2 else "")))
    rows += [(20_000 + k, f"{line} only {k} of these") for k in range(40)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute_near_copies(rows)
    first = {}
    for (i, _), k in zip(rows, want, strict=True):
        first[k] = min(first.get(k, i), i)
    assert len(first) < len(rows) - 80
    assert sorted(r.doc_id for r in simhash.keep_one(frame).select("doc_id").collect()) == sorted(first.values())
    assert simhash.keep_one(nothing).count() == 0


def test_toxicity(spark, docs, odd, nothing):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = toxicity.fit(table, labels)
    rows = toxicity.score(table, model).join(labels, "doc_id").where(toxicity.held_out()).collect()
    right = sum(r.predicted == r.toxic for r in rows) / len(rows)
    assert right > 0.93 and sum(r.predicted for r in rows if not r.toxic) <= 2
    out = {(r.doc_id, r.score) for r in toxicity.score(odd, model).collect()}
    assert all(0 <= s <= 1 for _, s in out) and toxicity.keep_clean(odd, model).columns == odd.columns
    assert toxicity.score(nothing, model).count() == 0
    assert toxicity.fit(docs, labels.where("false")).scores([None, b"x"]).tolist() == pytest.approx([0.5, 0.5])


def test_counterfactual_pull():
    """With the penalty, a group's name moves a neutral mention's score less."""
    said = [(f"the {g} neighbour is {w}", y) for g in ("muslim", "gay") for w, y in (("a moron", 1), ("scum", 1), ("kind", 0))] * 6
    said += [(f"the christian neighbour is {w}", 0) for w in ("kind", "nice", "here")] * 8 + [("what a moron and scum", 1), ("a nice day here", 0)] * 6
    words = [toxicity.words_of(t.encode()) for t, _ in said]
    rows = [np.array(sorted({f for w in ws for f in toxicity.features_of(w)})) for ws in words]
    twins = [(i, np.array(a), np.array(b)) for i, (t, _) in enumerate(said) for a, b in toxicity.twin_features(t)]
    y = np.array([v for _, v in said], float)
    gap = lambda m: abs(m.logit(b"the muslim neighbour is kind") - m.logit(b"the christian neighbour is kind"))
    plain, fair = toxicity.train(rows, [], y, least=1, screen=0.5), toxicity.train(rows, twins, y, least=1, screen=0.5, fair=5.0)
    assert gap(fair) < 0.5 * gap(plain) and fair.scores([b"what a moron"])[0] > 0.5


def test_twins_are_of_sentences():
    """A feature that another word of the sentence has is neither lost nor gained; other sentences do not matter."""
    one = toxicity.twin_features("The female and the females. Women came")
    f = lambda w: set(toxicity.features_of(w))
    lost = [set(a) for a, _ in one]
    assert {toxicity.features_of("female")[0]} in lost and f("women") in lost  # the stem of `female` stays with `females`
    assert not toxicity.twin_features("nothing here. ") and toxicity.twin_features("die frauen", (("frauen", "männer"),)) == [(sorted(f("frauen")), sorted(f("männer")))]


def test_counterfactuals_lower_false_positives(spark):
    """Documents with planted mentions: groups that toxic texts name often are not held against neutral ones."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "toxic")
    rng = np.random.default_rng(17)
    named, others = ("muslims", "immigrants", "women", "juden", "musulmans", "mujeres"), ("christians", "citizens", "men", "christen", "chrétiens", "hombres")
    texts, marks = [], []
    for r in table.join(labels, "doc_id").collect():
        if rng.random() < (0.8 if r.toxic else 0.02):
            pick = named[rng.integers(6)]
        else:
            pick = others[rng.integers(6)]
        texts.append((r.doc_id, f"{r.text} . all the {pick} of the town ."))
        marks.append((r.doc_id, r.toxic))
    frame, marked = spark.createDataFrame(texts, "doc_id bigint, text string"), spark.createDataFrame(marks, "doc_id bigint, toxic int")
    plain, fair = toxicity.fit(frame, marked, fair=0.0), toxicity.fit(frame, marked, fair=5.0)
    assert fair.twins > 300
    said = [f"the meeting of {w} was in the town hall ." for w in named]
    swapped = [f"the meeting of {w} was in the town hall ." for w in others]
    gap = lambda m: np.abs(m.scores([t.encode() for t in said]) - m.scores([t.encode() for t in swapped])).mean()
    clean = [t for (i, t), (_, y) in zip(texts, marks, strict=True) if not y]
    neutral = [t.encode().rpartition(b" . all the ")[0] + b" . all the " + w.encode() + b" of the town ." for t in clean for w in named]
    wrong = lambda m: float((m.scores(neutral) >= 0.5).mean())
    rows = [(t, y) for (i, t), (_, y) in zip(texts, marks, strict=True) if zlib.crc32(str(i).encode()) % 5 == 0]
    right = lambda m: np.mean((m.scores([t.encode() for t, _ in rows]) >= 0.5) == [y for _, y in rows])
    print(gap(plain), gap(fair), wrong(plain), wrong(fair), right(plain), right(fair))
    assert gap(fair) < 0.5 * gap(plain) and wrong(fair) < wrong(plain) and right(fair) >= right(plain) - 0.03


def test_toxicity_sample_is_bounded(spark):
    """An id that many rows repeat does not stretch the sample; null ids are scored and not held out."""
    rows = [(1, f"awful scum {k}") for k in range(300)] + [(k, "a kind day here") for k in range(2, 40)] + [(None, "scum")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, int(k == 1)) for k in range(1, 40)], "doc_id bigint, toxic int")
    model = toxicity.fit(frame, labels, sample=50)
    assert model.twins == 0
    out = toxicity.score(frame, model).select("doc_id", toxicity.held_out().alias("h")).where("doc_id is null").collect()
    assert [r.h for r in out] == [False]


def test_secrets(spark, odd, nothing):
    rows = secret_scan.labelled_findings(2000)
    forest = secret_scan.fit(rows[:1500])
    scores = forest.scores(np.array([secret_scan.features(f) for f, _ in rows[1500:]]))
    assert np.mean((scores >= 0.5) == [y for _, y in rows[1500:]]) > 0.97
    texts = [(1, 'é token = "4b579d3cee1dcaf48e80dfd04d785e892fc7d365" of', "src", 9, "k"), (2, "card 4041894974608795 paid", None, None, "k"), (3, None, None, None, "k")]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string, source string, n_chars bigint, score string")
    found = secret_scan.scan(frame, forest).collect()
    assert [(r.doc_id, r.start, r.length) for r in found] == [(1, 11, 40)]
    red = {r.doc_id: r for r in secret_scan.redact(frame, forest).collect()}
    assert red[1].text == 'é token = "[SECRET]" of' and red[1].n_chars == len(red[1].text) and red[2].text == texts[1][1] and red[3].text is None
    assert secret_scan.scan(nothing, forest).count() == 0 and secret_scan.redact(odd, forest).count() == odd.count()


def test_long_secrets_leave_no_byte(spark):
    """Values of any length go whole, whatever stands between name and value; look-alikes of that length stay."""
    rng = np.random.default_rng(3)
    forest, rows, want = secret_scan.fit(), [], {}
    letters = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"))
    for n in (20, 40, 512, 513, 600, 5_000, 100_000):
        value = "".join(rng.choice(letters, n))
        for k, (head, tail) in enumerate((('é token = "', '" of'), ("the password: ", " is"), ("secret_for_the_production_database_of_the_shop=", "\nx"), ("api_key" + " " * 60 + "= '", "';"), ("https://host/?lang=en&token=", ""))):
            rows.append((10 * n + k, head + value + tail))
            want[10 * n + k] = (head + "[SECRET]" if k < 4 else "", tail)
        rows.append((10 * n + 9, "data:image/png;base64," + value + " end"))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    red = {r.doc_id: r.text for r in secret_scan.redact(frame, forest, path_col=None).collect()}
    for i, (head, tail) in want.items():
        assert red[i] == head + "[SECRET]" * (not head) + tail or (not head and red[i].endswith("[SECRET]") and len(red[i]) < 60), (i, red[i][:80])
    assert sum(red[10 * n + 9] == dict(rows)[10 * n + 9] for n in (512, 513, 600, 5_000, 100_000)) >= 4
    spans = {r.doc_id: (r.start, r.length) for r in secret_scan.scan(frame, forest, path_col=None).collect()}
    assert spans[5_130] == (11, 513) and spans[1_000_001] == (14, 100_000)


def test_candidates_read_a_text_once():
    """Texts made to set patterns back take time in proportion to their length."""
    import time

    for unit in (b"token=", b"a.", b"x ", b"= ", b"password : ", b"aaaaaaaaaaaaaaa", b"'\"=:"):
        began = time.perf_counter()
        secret_scan.candidates(unit * (1_000_000 // len(unit)))
        assert time.perf_counter() - began < 3, unit
    assert secret_scan.candidates(b"token=" * 1000) == [(6, 6000, b"token")]


def test_secrets_of_the_documents(spark):
    """The marked tokens of the tables are found, all of them, and card numbers are not."""
    import re

    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "source")
    found = {(r.doc_id, r.start, r.length) for r in secret_scan.scan(table, secret_scan.fit()).collect()}
    marked, numbers = set(), set()
    for r in table.collect():
        marked |= {(r.doc_id, m.start(1), m.end(1) - m.start(1)) for m in re.finditer(r'token = "([0-9a-f]{40})"', r.text or "")}
        numbers |= {(r.doc_id, m.start(), 16) for m in re.finditer(r"(?<!\w)\d{16}(?!\w)", r.text or "")}
    assert len(marked) >= 10 and len(numbers) >= 20
    assert marked <= found and not found & numbers and len(found) <= len(marked) + 2


def test_mixing(spark, odd, nothing):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "source", F.lit(1).alias("n_chars"), F.lit("x").alias("range"))
    rows = mixing.digests(table).collect()
    by = {}
    source = {r.doc_id: r.source for r in table.collect()}
    for r in rows:
        s = by.setdefault(source[r.doc_id], [0, r.target, r.source_size])
        s[0] += r.taken
        assert r.taken <= 3 * r.size
    assert all(abs(t - goal) <= 1 and goal <= 3 * size for t, goal, size in by.values()) and sum(g for _, g, _ in by.values()) == pytest.approx(sum(s for _, _, s in by.values()))
    mixed = mixing.mixture(table)
    assert mixed.columns == table.columns and mixed.select(F.sum(mixing.words(F.col("text")))).first()[0] == sum(r.taken for r in rows)
    out = mixing.digests(odd).collect()
    assert len(out) == odd.count() and sum(r.taken for r in out) > 0 and mixing.mixture(odd).columns == odd.columns
    assert mixing.digests(nothing).count() == 0


def test_store(spark, docs, odd, nothing, tmp_path):
    for k, table in enumerate((docs, odd, nothing)):
        folder = store.write(table, f"file://{tmp_path}/s{k}", files=3)
        store.verify(spark, folder)
        rows = sorted(table.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
        ids = [reference_ids(r.text) for r in rows]
        starts = np.cumsum([0, *map(len, ids)]).tolist()
        want = sorted(((r.doc_id, s, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for r, s, x in zip(rows, starts, ids, strict=False)), key=repr)
        assert sorted((tuple(r) for r in store.read(spark, folder).collect()), key=repr) == want
        assert [r.ids for r in store.read_ids(spark, folder).orderBy("ordinal").collect()] == ids
    stored = spark.read.parquet(f"file://{tmp_path}/s0/chunks")
    assert stored.count() == stored.select("digest").distinct().count()
    assert stored.count() < spark.read.parquet(f"file://{tmp_path}/s0/recipes").select(F.explode("chunks")).count()


def copy_of(spark, tmp_path, name, **changed):
    for part in ("chunks", "recipes", "manifest", "root"):
        df = spark.read.parquet(f"file://{tmp_path}/whole/{part}")
        changed.get(part, lambda d: d)(df).write.mode("overwrite").parquet(f"file://{tmp_path}/{name}/{part}")
    return f"file://{tmp_path}/{name}"


def test_damage_is_seen(spark, docs, tmp_path):
    """A changed payload, recipe, manifest or root fails verify; a chunk that is gone fails read."""
    store.write(docs, f"file://{tmp_path}/whole", files=3)
    store.verify(spark, copy_of(spark, tmp_path, "same"))
    first = (F.col("part") == 0) & (F.col("place") == 0)
    bad = {
        "payload": {"chunks": lambda d: d.withColumn("payload", F.when(F.col("at") == d.agg(F.min("at")).first()[0], F.concat("payload", F.lit(b"\0\0"))).otherwise(F.col("payload")))},
        "digests": {"recipes": lambda d: d.withColumn("chunks", F.when(first, F.reverse("chunks")).otherwise(F.col("chunks"))).withColumn("chunks", F.when(first & (F.size("chunks") == 1), F.array(F.lit(b"x"))).otherwise(F.col("chunks")))},
        "tokens": {"recipes": lambda d: d.withColumn("n_tokens", F.col("n_tokens") + first.cast("long"))},
        "id": {"recipes": lambda d: d.withColumn("doc_id", F.when(first, -7).otherwise(F.col("doc_id")))},
        "lost": {"recipes": lambda d: d.where(~first)},
        "manifest": {"manifest": lambda d: d.withColumn("tokens_before", F.col("tokens_before") + 1)},
        "root": {"root": lambda d: d.withColumn("root", F.reverse("root"))},
    }
    for name, changed in bad.items():
        folder = copy_of(spark, tmp_path, name, **changed)
        with pytest.raises(Exception, match="differ|damaged"):
            store.verify(spark, folder)
    with pytest.raises(Exception, match="damaged"):
        store.read(spark, f"file://{tmp_path}/payload").collect()
    with pytest.raises(Exception, match="not stored"):
        store.read(spark, copy_of(spark, tmp_path, "gone", chunks=lambda d: d.where(F.col("at") != d.agg(F.min("at")).first()[0]))).collect()


def test_recipe_files_ascend(spark, tmp_path):
    """Eight files, one after another, hold the documents in ascending order of their ids, without coalescing."""
    import glob

    import pyarrow.parquet as pq

    table = spark.createDataFrame([((k * 37) % 1000, f"text {k}") for k in range(1000)], "doc_id bigint, text string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store.write(table, f"file://{tmp_path}/order", files=8)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = [pq.read_table(f).to_pydict() for f in sorted(glob.glob(f"{tmp_path}/order/recipes/*.parquet"))]
    assert len([f for f in files if f["doc_id"]]) == 8
    assert [i for f in files for i in f["doc_id"]] == list(range(1000))
    assert all(f["place"] == list(range(len(f["place"]))) and len(set(f["part"])) <= 1 for f in files)


def test_cuts_and_crcs():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 49_000, 30_000, dtype=np.uint32), rng.integers(0, 49_000, 500, dtype=np.uint32)
    ends = store.cut_points([len(a), len(b)], np.concatenate([a, b]))
    assert ends[1] == store.cut_points([len(b)], b)[0] and ends[0][-1] == len(a)
    shifted = store.cut_points([len(a) + 7], np.concatenate([b[:7], a]))[0]
    assert len({e + 7 for e in ends[0]} & set(shifted)) > 0.8 * len(ends[0])
    x, y = a.tobytes(), b.tobytes()
    assert store.crc32_join(zlib.crc32(x), zlib.crc32(y), len(y)) == zlib.crc32(x + y) and store.crc32_join(5, 0, 0) == 5


def brute_top(whole, ids, query_ids, k=20):
    """(query, rank, id, score) by all products."""
    out = []
    for q in query_ids:
        found = sorted((-int(whole[i] @ whole[j]), int(ids[j])) for i in np.flatnonzero(ids == q) for j in np.flatnonzero(ids != q))
        out += [(int(q), n + 1, j, -s) for n, (s, j) in enumerate(found[:k])]
    return sorted(out)


def test_vafile(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(0, 0.2, (300, 7)).astype(np.float32)
    x[50:90] = x[3]
    ids = np.arange(300)
    rows = [(k, v.tolist(), 1) for k, v in enumerate(x)] + [(1000, None, 1), (1020, [None] * 7, 1), (1040, [float("nan")] * 7, 1), (1060, [0.1, 0.2], 1), (1080, [], 1), (None, [0.5] * 7, 1), (1100, [float("inf")] * 7, 1)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, rank int")
    of = F.col("vec_id") % 20 == 0
    whole = np.floor(64 * x.astype(float)).astype(int)
    want = brute_top(whole, ids, range(0, 300, 20))
    for sizes in ({"block": 64, "query_block": 4}, {"block": 64, "query_block": 4, "probe": 9}, {}):
        assert sorted(tuple(r) for r in vafile.top_k(frame, of, **sizes).collect()) == want
    again = frame.union(frame.where("vec_id in (3, 20, 40)")).union(frame.where("vec_id = 7").withColumn("vec_id", F.lit(40).cast("long")))
    more = [*range(300), 3, 20, 40, 40]
    values = whole[[*range(300), 3, 20, 40, 7]]
    assert sorted(tuple(r) for r in vafile.top_k(again, of, block=64, query_block=4).collect()) == brute_top(values, np.array(more), range(0, 300, 20))
    assert vafile.top_k(frame.where("false"), of).count() == 0 and vafile.top_k(frame.where("vec_id < 15"), of).count() == 14


def test_vafile_reads_few_exact_vectors(spark):
    """On clustered vectors the cells leave few rows to read; wide values and one component work as well."""
    rng = np.random.default_rng(10)
    centres = rng.normal(0, 0.125, (40, 64))
    x = np.repeat(centres, 75, axis=0) + rng.normal(0, 0.02, (3000, 64))
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    rows = vafile.top_k(frame, F.col("vec_id") % 100 == 0, block=512, query_block=8, with_reads=True).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in rows) == brute_top(np.floor(64 * x).astype(int), np.arange(3000), range(0, 3000, 100))
    reads = [r.exact_reads for r in rows if r["rank"] == 1]
    assert all(20 <= n < 3000 for n in reads) and np.mean(reads) < 0.2 * 3000
    y = rng.normal(0, 900, (200, 1))
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(y)], "vec_id bigint, embedding array<double>")
    assert sorted(tuple(r) for r in vafile.top_k(frame, F.col("vec_id") % 20 == 0, block=32).collect()) == brute_top(np.floor(64 * y).astype(np.int64), np.arange(200), range(0, 200, 20))
    for q in (whole := np.floor(64 * x).astype(float))[:5]:
        assert (vafile.bounds(q[None], *vafile.cells_of(whole))[0] >= whole @ q).all()


def test_language(spark, odd, nothing):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(table)
    assert 0 < model.threshold <= 1
    model.threshold = 0.0
    rows = langid.predict(table, model).join(table.select("doc_id", "lang"), "doc_id").where(langid.held_out()).collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.97
    out = {r.doc_id: r for r in langid.predict(odd, model).collect()}
    assert out[2].lang_pred == out[3].lang_pred == out[6].lang_pred == "und" and out[7].lang_pred in model.languages and out[2].score == 0.0
    assert langid.predict(nothing, model).count() == 0 and langid.fit(nothing).predict([b"x"])[0] == ["und"]


def test_language_rejection_acts(spark):
    """What is no language of the sample scores under the calibrated threshold more often than what is."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(table)
    rows = queries.op10_language_id(spark, "/root/testdata/sf0.01")
    kept = rows.agg(F.avg(F.col("accepted").cast("int")), F.count_if(F.col("accepted") & (F.col("lang_pred") == "und"))).first()
    assert kept[0] > 0.5 and kept[1] == 0
    junk = ["xqz wvk jjq zzx", "qqqq wwww", "kjhg fdsa poiu"]
    assert model.predict([t.encode() for t in junk])[0].count("und") >= 2


def brute_buckets(text):
    """n-grams of 1 to 4 characters of each run of letters with a word end at either side, hashed one by one."""
    out, mask = [], (1 << 64) - 1
    runs, run = [], ""
    for c in (text or "").lower() + " ":
        if c.isalpha():
            run += c
        elif run:
            runs.append(run)
            run = ""
    for run in runs:
        codes = [0, *map(ord, run), 0]
        for n in langid.GRAMS:
            for k in range(len(codes) - n + 1):
                gram = codes[k : k + n]
                if n == 1 and gram == [0]:
                    continue
                h = n
                for c in gram:
                    h = (h ^ c) * 0x9E3779B97F4A7C15 & mask
                    h ^= h >> 29
                out.append((h >> 40) & (langid.BUCKETS - 1))
    return out


def test_language_equals_brute_force(spark, docs, odd):
    """Scores of whole texts are the softmax of the mean of all subwords' rows, gram by gram."""
    model = langid.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    model.threshold = 0.0
    both = docs.select("doc_id", "text").limit(40).union(odd.select("doc_id", "text"))
    texts = [r.text for r in both.collect()]
    found = {(r.doc_id, r.lang_pred, round(r.score, 9)) for r in langid.predict(both, model).collect()}
    want = set()
    for r in both.collect():
        at = brute_buckets(r.text)
        z = (model.table[at].mean(0) if at else np.zeros(len(model.languages))) + model.bias
        e = np.exp((z - z.max()) / model.temperature)
        want.add((r.doc_id, model.languages[int(e.argmax())] if at else "und", round(float((e / e.sum()).max()), 9) if at else 0.0))
    assert len(texts) > 40 and found == want


def picture(seed, n=160):
    rng = np.random.default_rng(seed)
    coarse = rng.integers(20, 235, (n // 8, n // 8)).astype(float)
    return coarse.repeat(8, 0).repeat(8, 1)


def test_images(spark):
    base = [picture(k) for k in range(12)]
    rows = [(k, images.encode_pgm(b)) for k, b in enumerate(base)]
    rows += [(100 + k, images.encode_pgm(b[16:150, 8:140])) for k, b in enumerate(base)]  # crops
    rows += [(200 + k, images.encode_pgm(b * 0.8 + 20)) for k, b in enumerate(base)]  # edits of brightness
    rows += [(300, images.encode_pgm(base[0])), (301, None), (302, b""), (303, b"junk"), (304, b"junk"), (305, images.encode_pgm(np.full((64, 64), 9.0))), (None, images.encode_pgm(base[1])), (None, None)]
    frame = spark.createDataFrame(rows, "image_id bigint, image binary").withColumn("corners", F.lit("x"))
    got = {r.image_id: r.class_id for r in images.copies(frame).where("image_id is not null").collect()}
    hits = sum(got[100 + k] == k for k in range(12)) + sum(got[200 + k] == k for k in range(12))
    assert hits >= 0.9 * 24 and got[300] == 0 and got[304] == 303 and [got[k] for k in (301, 302, 305)] == [301, 302, 305]
    assert all(got[k] == k for k in range(12))
    assert {(r.image_id, r.class_id) for r in images.copies(frame).where("image_id is null").collect()} == {(None, 1), (None, None)}
    assert images.copies(frame.where("false")).count() == 0


def test_one_id_with_two_pictures(spark):
    """Rows have the class of their own picture, whatever else has their id."""
    a, b = picture(1), picture(2)
    rows = [(1, a), (2, b), (5, a[16:150, 8:140]), (5, b[16:150, 8:140])]
    out = images.copies(spark.createDataFrame([(k, images.encode_pgm(x)) for k, x in rows], "image_id bigint, image binary")).collect()
    assert sorted((r.image_id, r.class_id, r.links) for r in out) == [(1, 1, 1), (2, 2, 1), (5, 1, 1), (5, 2, 1)]


def compared(stack):
    """All pairs (i, j), i < j, that the definition links: corners that agree, by brute force."""
    found = [images.describe(np.rint(g)[None])[0] for g in stack]
    places = [np.stack([c[n] for n in ("x", "y", "scale", "turn")], axis=1).astype(float) for c in found]
    words = [np.stack([c["d0"], c["d1"]], axis=1) for c in found]
    out = set()
    for i in range(len(stack)):
        for j in range(i + 1, len(stack)):
            p, q = images.matches(words[i], words[j])
            if len(p) >= images.AGREE and images.agreement(places[i][p], places[j][q], images.AGREE) >= images.AGREE:
                out.add((i, j))
    return out


def test_rendered_copies_against_brute_force(spark):
    """200 images: vectors, near vectors, and a crop, a turn and an edit of each; classes are those of all pairs."""
    rng = np.random.default_rng(7)
    base = rng.normal(0, 0.125, (40, 64))
    grey = [np.rint(g) for g in images.render(np.concatenate([base, base + rng.normal(0, 0.01, base.shape)]))]
    stack = grey + [np.rint(np.clip(edit(g), 0, 255)) for g in grey[:40] for edit in images.EDITS.values()]
    pairs = compared(stack)
    label = list(range(len(stack)))
    for i, j in sorted(pairs):
        label = [min(label[i], label[j]) if x in (label[i], label[j]) else x for x in label]
    frame = spark.createDataFrame([(k, images.encode_pgm(g)) for k, g in enumerate(stack)], "image_id bigint, image binary")
    got = {r.image_id: r.class_id for r in images.copies(frame).collect()}
    linked = [(i, j) for i, j in pairs if label[i] == label[j]]
    assert np.mean([got[i] == got[j] for i, j in linked]) >= 0.9
    assert all(got[i] == got[j] <= i for i in range(len(stack)) for j in range(i) if got[i] == got[j] and label[i] == label[j])
    assert not any(got[i] == got[j] and label[i] != label[j] for i in range(len(stack)) for j in range(i))
    kinds = {name: np.mean([got[80 + 3 * k + n] == got[k] for k in range(40)]) for n, name in enumerate(images.EDITS)}
    assert kinds["crop"] >= 0.95 and kinds["edit"] >= 0.95 and kinds["turn"] >= 0.9, kinds
    assert np.mean([got[40 + k] == k for k in range(40)]) >= 0.95 and all(got[k] == k for k in range(40))


def test_planted_copies_of_rendered_rows(spark):
    rows = [(k, np.random.default_rng(k).normal(0, 0.125, 64).tolist()) for k in range(6)] + [(6, None), (7, []), (8, [None]), (None, [0.1] * 64)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    out = images.render_vectors(frame, copied=F.col("vec_id") % 2 == 0)
    assert sorted((r.vec_id for r in out.collect() if r.vec_id is not None)) == sorted([*range(9), -1, -2, -3, -7, -8, -9, -13, -14, -15])
    got = {r.vec_id: r.class_id for r in images.copies(out, id_col="vec_id").collect()}
    assert got[-1] == got[-3] == got[0] and got[-7] == got[-9] == got[2] and got[6] == 6 and got[7] == 7 and got[1] == 1


@pytest.mark.parametrize("size", [10, 100, 1000])
def test_groups_of_crops_lose_no_links(spark, size):
    """Crops and noisy edits of one picture, in a group of any size, beside others."""
    rng, whole = np.random.default_rng(8), images.render(np.random.default_rng(3).normal(size=(1, 64)))[0]
    rows = []
    for k in range(size):
        y, x = rng.integers(0, 28, 2)
        rows.append((k, images.encode_pgm((whole + rng.normal(0, 4, whole.shape))[y : y + 84, x : x + 84])))
    rows += [(2000 + k, images.encode_pgm(g)) for k, g in enumerate(images.render(rng.normal(size=(20, 64))))]
    found = images.copies(spark.createDataFrame(rows, "image_id bigint, image binary")).collect()
    got = {r.image_id: r.class_id for r in found}
    assert sum(got[k] == 0 for k in range(size)) >= 0.97 * size and all(got[2000 + k] == 2000 + k for k in range(20))


def test_keys_are_exact_for_two_bits(spark):
    """Descriptors that differ in any two bits share a key."""
    rng = np.random.default_rng(2)
    rows = [(0, 0, 0)]
    for k in range(1, 60):
        d = 0
        for b in rng.integers(0, 128, 2):
            d ^= 1 << int(b)
        halves = [h - (1 << 64) if h >> 63 else h for h in (d & (1 << 64) - 1, d >> 64)]
        rows.append((k, *halves))
    frame = spark.createDataFrame(rows, "k bigint, d0 bigint, d1 bigint")
    assert images.BLOCKS - images.CHOSEN == 2
    keys = {r.k: set(r.keys) for r in frame.select("k", images._keys(F.col("d0"), F.col("d1")).alias("keys")).collect()}
    assert all(keys[0] & keys[k] for k in keys)


def test_small_crops_of_a_large_picture():
    """Crops of 5 to 25 % of the area agree with the whole, from corners that share a key."""
    rng, whole = np.random.default_rng(9), images.render(np.random.default_rng(1).normal(size=(1, 64)), 480)[0]
    a = images.describe(whole[None])[0]
    assert len(a) > 500
    for share in (0.05, 0.1, 0.15, 0.25):
        for _ in range(3):
            n = int(480 * share**0.5)
            y, x = rng.integers(0, 480 - n, 2)
            b = images.describe(whole[y : y + n, x : x + n][None])[0]
            same = [(np.stack([c["d0"], c["d1"]], axis=1), np.stack([c[k] for k in ("x", "y", "scale", "turn")], axis=1).astype(float)) for c in (a, b)]
            i, j = images.matches(same[0][0], same[1][0])
            xor = same[0][0][i] ^ same[1][0][j]
            assert (xor == 0).all(1).sum() >= images.AGREE and images.agreement(same[0][1][i], same[1][1][j]) >= images.AGREE
