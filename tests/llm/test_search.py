"""Pairs of documents and vectors: exact against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import ann, common, jaccard
from strandline.llm.ann import near_duplicates
from strandline.llm.common import components
from strandline.llm.decontam import contamination
from strandline.llm.jaccard import jaccard_components


def classes(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 400)]
    edges = chain + star + [(5000, 5000)]
    rng.shuffle(edges)
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {got.get(i, i) for i in range(301)} == {0} and {got.get(1000 + i, 1000 + i) for i in range(400)} == {1000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors(seed, n=260, dim=16):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 4, dim))
    rows = [base[rng.integers(len(base))] + rng.normal(size=dim) * rng.choice([0.0, 0.15, 0.25]) for _ in range(n)]
    return [(i, [float(np.float32(x)) for x in v], int(i % 3)) for i, v in enumerate(rows)]


@pytest.mark.parametrize("shard", [10_000, 40])
def test_near_duplicates_match_brute_force(spark, shard):
    rows = vectors(2)
    n = len(rows)
    bad = [(n, None, 0), (n + 1, [0.0] * 16, 0), (n + 2, [float("nan")] + [1.0] * 15, 0), (n + 3, rows[0][1], None), (n + 4, [None] + [1.0] * 15, 0), (n + 5, [], 1), (n + 6, rows[0][1], 0), (n + 7, rows[0][1][:8], 0)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, label int")
    x = np.array([r[1] for r in rows] + [rows[0][1]], np.float32).astype(float)
    ids, labels = [*range(n), n + 6], [r[2] for r in rows] + [0]
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = [(ids[i], ids[j]) for i in range(len(ids)) for j in range(i) if labels[i] == labels[j] and u[i] @ u[j] >= 0.93]
    want = classes(n + 8, near)
    links = [sum(i in p for p in near) for i in range(n + 8)]
    got = near_duplicates(df, shard=shard).orderBy("vec_id").collect()
    assert [(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got] == [(i, links[i], want[i], want[i] == i) for i in range(n + 8)]


@pytest.mark.parametrize(("noise", "shard"), [(0.0, 10_000), (0.0, 40), (1e-3, 10_000)])
def test_near_duplicates_beyond_the_beam(spark, noise, shard):
    rng = np.random.default_rng(3)
    a, b = np.eye(16)[0], 0.95 * np.eye(16)[0] + np.sqrt(1 - 0.95**2) * np.eye(16)[1]
    rows = [(k, (v + noise * rng.normal(size=16)).tolist(), 0) for k, v in enumerate([a] * 60 + [b] * 60)]
    got = near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), shard=shard).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == [(k, 119, 0) for k in range(120)]


def test_audit_widens_beams_until_all_groups_are_joined():
    rng = np.random.default_rng(4)
    centre = np.repeat(rng.normal(size=(40, 24)), [150] * 10 + [20] * 30, 0)
    x = ann.unit(centre + 0.1 * rng.normal(size=centre.shape))
    near = x @ x.T >= 0.93
    a, b, (_, recall, *_) = ann.audited(ann.Graph(x, np.arange(len(x))), x.astype(np.float32), np.arange(len(x)), 0.93)
    assert near.sum() > len(x) and recall >= ann.AUDIT_RECALL
    assert classes(len(x), zip(a % len(x), b % len(x))) == classes(len(x), zip(*np.nonzero(near)))


def test_layers_hang_together():
    rng = np.random.default_rng(8)
    x = ann.unit(np.repeat(rng.normal(size=(60, 64)), 50, 0) + 0.02 * rng.normal(size=(3000, 64)))
    g = ann.Graph(x, np.arange(len(x)))
    low = g.neighbours[0]
    rows, cols = np.nonzero(low >= 0)
    assert set(classes(len(x), zip(rows, low[rows, cols]))) == {0}


@pytest.mark.parametrize("shard", [16_384, 700])
def test_no_link_of_many_groups_is_lost(spark, shard):
    rng = np.random.default_rng(8)
    v = np.repeat(rng.normal(size=(60, 64)), 50, 0) + 0.02 * rng.normal(size=(3000, 64))
    df = spark.createDataFrame([(k, x.tolist(), 0) for k, x in enumerate(v)], "vec_id long, embedding array<double>, label int")
    got = near_duplicates(df, shard=shard).collect()
    assert sum(r["n_links"] for r in got) == 147_000 and all(r["component_id"] == r["vec_id"] // 50 * 50 for r in got)


def test_audits_are_returned_and_bad_graphs_compared_whole(spark, monkeypatch):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(900, 8))
    nodes = spark.createDataFrame([(k, "x", 8, x.tolist()) for k, x in enumerate(v)], "node long, label string, dim int, vector array<double>")
    _, audits = ann.search_links(nodes, 0.93, 500)
    rows = audits.collect()
    assert len(rows) == 4 and all(r["recall"] >= ann.AUDIT_RECALL and r["sampled"] == 128 for r in rows)


def test_repeated_ids_count_other_ids_once(spark):
    a, b = [1.0, 0.0, 0.0], [0.99, 0.1, 0.0]
    rows = [(1, a, 0), (1, b, 0), (2, a, 0), (1, a, 0), (3, [0.0, 0.0, 1.0], 0), (3, b, 0), (4, [0.0, 0.1, 1.0], 0), (None, a, 0), (5, a, None), (6, a, 1), (6, a, 2)]
    df = spark.createDataFrame([(*r, "x", 9) for r in rows], "vec_id long, embedding array<double>, label int, node string, count int")
    got = near_duplicates(df).collect()
    want = {(1, 2, 1, True), (2, 2, 1, False), (3, 3, 1, False), (4, 1, 1, False), (None, 0, None, True), (5, 0, 5, True), (6, 0, 6, True)}
    assert len(got) == len(rows) and {tuple(r) for r in got} == want


def test_near_duplicates_of_no_rows(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert near_duplicates(empty).count() == 0


def shingle_set(text):
    w = [x for x in (text or "").encode().lower().split()]
    if not w:
        return frozenset()
    k = min(3, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def near_copies(seed):
    rng = random.Random(seed)
    vocabulary = [f"W{i}" if i % 5 else f"é{i}" for i in range(400)]
    texts = [None, "", " ", "one", "ONE", "two words", "Two  words"]
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([4, 30, 120, 400]))]
        for _ in range(6):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    return texts


def links_of(texts, n=3, percent=90):
    def shingles(text):
        w = (text or "").encode().lower().split()
        k = min(n, len(w))
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()

    sets = [shingles(t) for t in texts]
    near = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    return sets, classes(len(texts), near)


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_jaccard_matches_brute_force(spark, monkeypatch, n, percent, small):
    if small:  # hot lists, many chunks and blocks
        monkeypatch.setattr(common, "HOT_ROWS", 2)
        for name, value in (("BLOCK", 3), ("SALTS", 3), ("FRAGMENTS", 5)):
            monkeypatch.setattr(jaccard, name, value)
    texts = near_copies(4)
    sets, want = links_of(texts, n, percent)
    got = jaccard_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), n, percent).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got] == [(i, len(sets[i]), want[i]) for i in range(len(texts))]


@pytest.mark.parametrize("percent", [80, 90])
def test_neighbours_connect_all_that_can_link(spark, percent):
    rng = random.Random(percent)
    rows = [(s if hot else s - (1 << 60), rng.randrange(1, 60), 1000 * hot + k) for s, hot in ((1 << 60, True), (2 << 60, False)) for k in range(90)]
    got = jaccard.neighbours(spark.createDataFrame(rows, "s long, n int, node long"), percent, 1).collect()
    nodes = [r[2] for r in rows]
    root = classes(len(nodes), [(nodes.index(r["a"]), nodes.index(r["b"])) for r in got])
    for i, (s, n, _) in enumerate(rows):
        for j in range(i):
            if s == rows[j][0] and 100 * min(n, rows[j][1]) >= percent * max(n, rows[j][1]):
                assert root[i] == root[j]


def test_jaccard_of_a_passage_that_many_share(spark):
    """Around the threshold, with most of every text in common."""
    rng = random.Random(6)
    common_ = [f"c{k}" for k in range(60)]
    texts = []
    for _ in range(150):
        own = common_ + [f"w{rng.randrange(40)}" for _ in range(8)]
        cut = rng.randrange(5)
        texts.append(" ".join(own[cut:]))
    for n, percent in ((3, 90), (5, 80)):
        _, want = links_of(texts, n, percent)
        got = jaccard_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), n, percent)
        assert [r["component_id"] for r in got.orderBy("doc_id").collect()] == want and len(set(want)) > 3


def test_jaccard_of_repeated_ids_and_large_groups(spark):
    rng = random.Random(9)
    base = [f"w{rng.randrange(3000)}" for _ in range(120)]
    rows = [(5, " ".join(base)), (5, "another text of five"), (9, "another text of five"), (9, "and one more here"), (11, "And one more  here"), (None, " ".join(base)), (3, None)]
    for k in range(400):
        copy = list(base)
        copy[rng.randrange(120)] = f"n{k}"
        rows.append((100 + k, " ".join(copy)))
    rows += [(600 + k, "the very same words in all of these") for k in range(2000)] + [(600, "the very same words in all of these")] * 50
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    by = {(r["doc_id"], r["component_id"]) for r in got.collect()}
    assert got.count() == len(rows) and by == {(5, 5), (9, 5), (11, 5), (None, None), (3, 3), *((100 + k, 5) for k in range(400)), *((600 + k, 600) for k in range(2000))}


def test_jaccard_takes_any_table(spark, documents):
    got = jaccard_components(documents).collect()
    assert len(got) == documents.count()
    by = {r["doc_id"]: r["component_id"] for r in got}
    assert by[4] == 3 and by[None] is None and by[0] == 0 and by[1] == 1
    assert jaccard_components(documents.limit(0)).count() == 0


def doc_words(text):
    import re

    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def contaminated(texts, items, size=10):
    out = []
    for t in texts:
        w, hit, found = doc_words(t), set(), set()
        for i, item in items:
            v = doc_words(item)
            n = min(size, len(v))
            windows = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if v else set()
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= {str(i)} - {"None"}
        out.append((len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("broadcast_bytes", [1 << 25, 0])
def test_decontamination_matches_brute_force(spark, broadcast_bytes):
    import hashlib

    rng = random.Random(8)
    words = ["The", "the", "of", "É", "é", "x1", "rare", "moon", "Sun", "tide", "ß"]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([3, 9, 10, 11, 14, 25])))) for i in range(12)] + [(20, ""), (21, None), (22, "moon"), (3, "sun, tide; moon"), (None, "É moon ß")]
    texts = [None, "", "...", "moon", "Sun tide moon!"]
    for _ in range(40):
        parts = [" ".join(rng.choice(words[:6]) for _ in range(rng.randrange(12)))]
        for _ in range(rng.randrange(3)):
            v = (rng.choice(items)[1] or "").split()
            cut = rng.randrange(3)
            parts += [", ".join(v[cut:]), rng.choice(words)]
        texts.append(" ".join(parts))
    rows = [(i, t, "w") for i, t in enumerate(texts)] + [(None, "moon", "w"), (4, "Sun tide moon!", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string")
    got = contamination(docs, spark.createDataFrame(items, "item_id long, text string"), broadcast_bytes=broadcast_bytes).collect()
    want = contaminated([r[1] for r in rows], items)
    expected = sorted((str(r[0]), n, h, len(f), hashlib.sha256(",".join(f).encode()).hexdigest(), h > 0) for r, (n, h, f) in zip(rows, want, strict=True))
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got) == expected


@pytest.mark.parametrize("broadcast_bytes", [1 << 25, 0])
def test_decontamination_of_long_items_and_repeats(spark, broadcast_bytes):
    word = [f"w{k}" for k in range(50_000)]
    items = spark.createDataFrame([(1, " ".join(word))], "item_id long, text string")
    rows = [(None, "so " + " ".join(word[40_000:40_012]))] * 300 + [(1, " ".join(reversed(word)))] * 3 + [(2, " ".join(word))]
    got = contamination(spark.createDataFrame(rows, "doc_id long, text string"), items, broadcast_bytes=broadcast_bytes).groupBy("doc_id", "n_words", "n_hit", "n_items").count()
    assert {tuple(r) for r in got.collect()} == {(None, 13, 12, 1, 300), (1, 50_000, 0, 0, 3), (2, 50_000, 50_000, 1, 1)}


def test_decontamination_of_no_rows(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination(documents, none).where("contaminated").count() == 0
    assert contamination(documents.limit(0), spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0


def test_jaccard_with_a_third_of_all_rows_repeated(spark):
    """One id's rows are a third of the table, another third has no id; neither reaches a comparison more than once."""
    from strandline.llm import jaccard

    text = " ".join(f"w{k}" for k in range(60))
    near = text.replace("w59", "other")
    rows = [(1, text)] * 3000 + [(None, text)] * 3000 + [(2, near), (3, near + " more"), (4, "else where it is"), *((10 + k, f"alone {k} " * 9) for k in range(50))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = jaccard.jaccard_components(docs)
    per = {(r["doc_id"], r["component_id"], r["n_shingles"]) for r in got.collect()}
    assert got.count() == len(rows) and (None, None, 58) in per
    assert {c for i, c, _ in per if i in (1, 2, 3)} == {1} and all(c == i for i, c, _ in per if i is not None and i > 3)
    once = jaccard._once(docs.where("doc_id is not null"), docs.select("doc_id")).where("doc_id = 1")
    assert once.count() == 1


@pytest.mark.parametrize("d, n, pairs", [(768, 3000, 80), (16, 4000, 300)])
def test_rare_pairs_are_not_lost_where_graphs_are_searched(spark, d, n, pairs):
    """Lone vectors with a few near copies about as far away as a link may be, in two shards of one label; `whole` makes
    every shard be searched by its graph. In many dimensions chance neighbours tell a search nothing, and audits fail; in few
    they pass. Either way each pair is found from both sides."""
    rng = np.random.default_rng(d)
    x = rng.normal(size=(n, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    own = rng.choice(n // 2, pairs, replace=False)
    away = rng.normal(size=(pairs, d))
    away -= (away * x[own]).sum(1, keepdims=True) * x[own]
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    x[n // 2 + np.arange(pairs)] = 0.94 * x[own] + np.sqrt(1 - 0.94**2) * away
    vectors = spark.createDataFrame([(i, v, 1) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>, label int").repartition(4)
    nodes = vectors.select(F.col("vec_id").alias("node"), F.lit("1").alias("label"), F.lit(d).alias("dim"), F.col("embedding").alias("vector"))
    _, audits = ann.search_links(nodes, 0.93, n // 2, 1)
    rows = audits.collect()
    assert len(rows) == 4 and all(r["partners"] >= ann.PARTNERS and r["recall"] == 1.0 for r in rows)
    if d == 16:
        assert not all(r["compared"] for r in rows)
    sims = x @ x.T >= 0.93
    np.fill_diagonal(sims, False)
    got = {r["vec_id"]: r for r in ann.near_duplicates(vectors, 0.93, n // 2, 1).collect()}
    assert sims.sum() >= 2 * pairs and all(got[i]["n_links"] == int(sims[i].sum()) for i in range(n))
