"""Near-duplicate joins, components, near vectors and exact search against brute force."""

import itertools
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from parley.llm import covertree, jaccard, vectors
from parley.llm.components import components
from parley.llm.queries import catalog
from pyspark.sql import functions as F

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _roots(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def _shingles(text, words):
    found = [w for w in re.split("[\x20\x09-\x0d]+", (text or "").translate(_LOWER)) if w]
    if 0 < len(found) < words:
        return {tuple(found)}
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}


def _expected(docs, words, part):
    sets = [(i, _shingles(t, words)) for i, t in docs]
    pairs = [
        (a, b)
        for (a, x), (b, y) in itertools.combinations(sets, 2)
        if x and y and 100 * len(x & y) >= part * len(x | y)
    ]
    roots = _roots({i for i, _ in sets}, pairs)
    return sorted((i, len(s), roots[i]) for i, s in sets)


def _edited(words, edits, rng, vocabulary):
    words = list(words)
    for _ in range(min(edits, len(words) - 1)):
        at = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words[at] = rng.choice(vocabulary)
        elif kind == 1:
            del words[at]
        else:
            words.insert(at, rng.choice(vocabulary))
    return words


@pytest.mark.parametrize(("words", "part"), [(4, 85), (5, 80), (1, 50)])
def test_join_loses_no_link(spark, words, part):
    """Copies with few to many edits, at every size of text, with a passage that all share."""
    rng = random.Random(words)
    vocabulary = [f"w{i}" for i in range(3000)]
    shared = [rng.choice(vocabulary) for _ in range(60)]
    docs = []
    for size in (1, 2, 3, 5, 6, 7, 8, 10, 13, 15, 20, 30, 45, 70, 120, 250, 600):
        for _ in range(4):
            text = [rng.choice(vocabulary) for _ in range(size)]
            if size > 60 and rng.random() < 0.7:
                text[10:70] = shared
            for edits in {0, 1, 2, size // 60, size // 40, size // 30, size // 25}:
                docs.append(_edited(text, edits, rng, vocabulary))
    rows = [(i, rng.choice([" ", "\n", "  \t"]).join(d)) for i, d in enumerate(rng.sample(docs, len(docs)))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = jaccard.near_duplicates(frame, words, part, 100).collect()
    assert sorted(map(tuple, found)) == _expected(rows, words, part)


def test_blocks_hold_what_they_promise():
    """Linked sets share a key: any two sets within the bound of their sizes."""
    rng = np.random.default_rng(1)
    for part in (85, 80, 50):
        bands = jaccard.Bands(part, 100)
        for size in (2, 3, 6, 7, 9, 12, 14, 20, 50, 200, 1000):
            for _ in range(30):
                base = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
                # as many differences as a link allows
                gone = rng.integers(0, len(base) // 2 + 1)
                fewer = np.sort(rng.permutation(base)[gone:])
                more = np.unique(np.concatenate([fewer, rng.integers(0, 2**64, rng.integers(0, 1 + size // 4), dtype=np.uint64)]))
                common, union = len(np.intersect1d(base, more)), len(np.union1d(base, more))
                if len(more) and 100 * common >= part * union:
                    assert set(bands.keys(base)) & set(bands.keys(more))


def test_neighbouring_bands_hold_all_linked_sizes():
    for part in (85, 80, 34):
        bands = jaccard.Bands(part, 100)
        for size in range(1, 3000):
            assert bands.of(size * 100 // part) <= bands.of(size) + 1


def test_near_duplicates_of_edges(edge_docs, no_docs):
    found = jaccard.near_duplicates(edge_docs).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str)
    want = []
    same = {4: 4, 5: 4, 9: 9, 10: 9}
    for row in edge_docs.collect():
        size = len(_shingles(row.text, 5))
        want.append((row.doc_id, size, same.get(row.doc_id, row.doc_id)))
    assert got == sorted(want, key=str)
    assert jaccard.near_duplicates(no_docs).count() == 0


def test_texts_of_one_id_are_one_document(spark):
    a, b = "a b c d e f g h", "n o p q r s t u"
    rows = [(1, a), (2, b), (3, a), (3, b), (4, "x y z v w x y")]
    found = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85, 100)
    assert {(r.doc_id, r.component_id) for r in found.collect()} == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_op2_query(spark, folder):
    found = catalog()["op2_parity_sketch_join"](spark, folder).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert sorted(map(tuple, found)) == _expected(docs, 4, 85)


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    chain = [(i, i + 1) for i in range(60)]
    star = [(100, 100 + i) for i in range(1, 80)]
    loose = [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    pairs = chain + star + loose + [(5, 5), (1, 0)]
    rng.shuffle(pairs)
    got = {(r.node, r.component) for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    nodes = {n for p in pairs if p[0] != p[1] for n in p}
    assert got == set(_roots(nodes, [p for p in pairs if p[0] != p[1]]).items())


def test_no_pairs_no_components(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


VECTORS = "vec_id long, embedding array<float>, a string, rep string, vector string, copies string"


def _clustered(rng, clusters, size, dimension=32):
    rows = []
    for _ in range(clusters):
        centre = rng.normal(size=dimension)
        for spread in rng.uniform(0.0, 0.55, size):
            rows.append(centre + spread * rng.normal(size=dimension))
    return np.array(rows, dtype=np.float32)


def test_near_vectors_recall_and_precision(spark):
    data = _clustered(np.random.default_rng(2), 60, 15)
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    found = {r.vec_id: r for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    wide = data.astype(float)
    unit = wide / np.linalg.norm(wide, axis=1)[:, None]
    cosine = unit @ unit.T
    np.fill_diagonal(cosine, 0)
    true = (cosine >= 0.9).sum(axis=1)
    links = np.array([found[i].n_links for i in range(len(rows))])
    assert (links <= true).all()
    assert links.sum() >= 0.9 * true.sum() > 0
    roots = _roots(range(len(rows)), zip(*np.nonzero(cosine >= 0.9), strict=True))
    assert np.mean([found[i].component_id == roots[i] for i in range(len(rows))]) > 0.95
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())


@pytest.mark.parametrize("dimension", [64, 100])
def test_near_vectors_with_a_common_mean(spark, dimension):
    """Pairs just above the threshold among vectors that share most of their direction."""
    rng = np.random.default_rng(5)
    mean = np.sqrt(0.7) * np.linalg.qr(rng.normal(size=(dimension, 1)))[0][:, 0]
    ones = mean + rng.normal(size=(250, dimension)) * np.sqrt(0.3 / dimension)
    ones /= np.linalg.norm(ones, axis=1)[:, None]
    aside = rng.normal(size=ones.shape)
    aside -= (aside * ones).sum(axis=1)[:, None] * ones
    others = 0.905 * ones + np.sqrt(1 - 0.905**2) * aside / np.linalg.norm(aside, axis=1)[:, None]
    data = np.concatenate([ones, others])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    links = {r.vec_id: r.n_links for r in vectors.near_vectors(frame).collect()}
    true = (data @ data.T >= 0.9).sum(axis=1) - 1
    assert true.sum() >= 500
    assert all(links[i] <= n for i, n in enumerate(true))
    assert sum(links.values()) >= 0.9 * true.sum()


def test_near_vectors_of_edges(spark):
    one = [1.0, 2.0, 3.0, 4.0]
    rows = [
        (1, one), (2, one), (3, [2.0, 4.0, 6.0, 8.0]), (3, [2.0, 4.0, 6.0, 8.0]), (4, None), (5, []), (6, [0.0] * 4),
        (7, [1.0, None, 3.0, 4.0]), (8, [float("nan"), 1.0, 1.0, 1.0]), (9, [float("inf"), 1.0, 1.0, 1.0]),
        (10, [1.0, 2.0]), (None, one), (11, [-1.0, -2.0, -3.0, -4.0]),
    ]
    frame = spark.createDataFrame([(*r, None, None, None, None) for r in rows], VECTORS)
    found = sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in vectors.near_vectors(frame).collect())
    linked = {1: 3, 2: 3, 3: 3}
    assert found == sorted((str(i), linked.get(i, 0), "1" if i in linked else str(i)) for i, _ in rows)
    assert vectors.near_vectors(frame.where("false")).count() == 0


def _best(rows, k, every):
    found = []
    for i, v in rows:
        if i % every == 0:
            scaled = np.floor(1024 * np.array(v, float))
            scores = sorted((-int(scaled @ np.floor(1024 * np.array(w, float))), j) for j, w in rows if j != i)
            found += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores[:k], 1)]
    return sorted(found)


def test_top_k_is_exact(spark, monkeypatch):
    """Several blocks, clusters, ties by equal vectors, and fewer candidates than k."""
    rng = np.random.default_rng(4)
    data = np.concatenate([_clustered(rng, 5, 40, 8), np.repeat(rng.normal(size=(3, 8)).astype(np.float32), 20, axis=0)])
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    monkeypatch.setattr(covertree, "BLOCK", 70)
    monkeypatch.setattr(covertree, "QUERIES", 10)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for k in (1, 10, 300):
        found = covertree.top_k(frame, F.col("vec_id") % 7 == 0, k)
        assert sorted(map(tuple, found.collect())) == _best(rows, k, 7)


def test_search_leaves_out_far_nodes():
    """Clusters that cannot hold a best candidate are not compared."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 6)) * 20_000
    data = np.floor(np.concatenate([c + rng.normal(size=(50, 6)) * 50 for c in centres])).astype(np.int64)
    queries = data[::50][:10]
    search = covertree.Search(queries, np.arange(0, 500, 50), data, np.arange(len(data)), 5)
    search.run()
    for query, own, best in zip(queries, range(0, 500, 50), search.best, strict=True):
        scores = data @ query
        order = [j for j in np.lexsort((np.arange(len(data)), -scores)) if j != own][:5]
        assert best.tolist() == [[scores[j], j] for j in order]
    assert search.compared < 0.5 * len(queries) * len(data)


def test_top_k_of_edges(spark):
    rows = [
        (0, [1.0, 2.0]), (1, [1.0, 2.0]), (100, None), (200, [1.0, None]), (300, [float("nan"), 1.0]), (400, [1e30, 1.0]),
        (None, [1.0, 1.0]), (2, [-1.0, 0.5]), (500, [0.0, 0.0]), (2, [3.0, 3.0]), (3, [1.0, 2.0, 3.0]), (600, []),
    ]
    frame = spark.createDataFrame([(*r, None, None, None, None) for r in rows], VECTORS)
    found = covertree.top_k(frame, F.col("vec_id") % 100 == 0, 10)
    valid = [(i, v) for i, v in rows if i in (0, 1, 2, 500) and len(v) == 2]
    # one component is far beyond 64 bits: its products are given as the nearest long
    huge = float(np.float32(1e30))
    lists = {0: [], 500: [], 400: []}
    for query, own in [(0, [1.0, 2.0]), (500, [0.0, 0.0]), (400, [huge, 1.0])]:
        scaled = [int(1024 * x) for x in own]
        for i, v in [*valid, (400, [huge, 1.0])]:
            if i != query:
                score = sum(a * int(np.floor(1024 * x)) for a, x in zip(scaled, v))
                lists[query].append((-score, i))
    want = [(q, r, i, max(-(2**63), min(2**63 - 1, -s))) for q, of in lists.items() for r, (s, i) in enumerate(sorted(of), 1)]
    assert sorted(map(tuple, found.collect())) == sorted(want)
    assert covertree.top_k(frame.where("false"), F.col("vec_id") % 100 == 0).count() == 0


@pytest.mark.parametrize("size", [1.0, 1e4, 1e6, 1e12])
def test_top_k_of_large_components_and_several_lengths(spark, monkeypatch, size):
    """Every length is searched for itself; sums beyond 53 and 63 bits stay exact."""
    rng = np.random.default_rng(int(size) % 97)
    monkeypatch.setattr(covertree, "BLOCK", 40)
    rows = []
    for length, count in ((3, 90), (5, 30), (8, 12), (1, 1)):
        # small leading components keep the sums of products within 64 bits
        scale = np.where(np.arange(length) == 0, min(size, 1e6), 1.0)
        rows += [(len(rows) + i, (rng.normal(size=length) * scale).tolist()) for i in range(count)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = []
    for i, v in rows:
        if i % 5 == 0:
            left = [int(np.floor(1024 * x)) for x in v]
            scores = sorted((-sum(a * int(np.floor(1024 * x)) for a, x in zip(left, w)), j) for j, w in rows if j != i and len(w) == len(v))
            want += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores[:10], 1)]
    assert all(abs(s) < 2**63 for *_, s in want)
    assert sorted(map(tuple, covertree.top_k(frame, F.col("vec_id") % 5 == 0).collect())) == sorted(want)


def test_near_vectors_of_several_lengths(spark):
    """A minority of another length keeps its links."""
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(60)]
    for i in range(10):
        base = rng.normal(size=24)
        rows += [(100 + 2 * i, base.tolist()), (101 + 2 * i, (base * 2).tolist())]
    found = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert len(found) == 80
    for i in range(10):
        assert found[100 + 2 * i] == found[101 + 2 * i] == (1, 100 + 2 * i)
    assert all(n == 0 for v, (n, _) in found.items() if v < 60)


def test_op9_query(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert sorted(map(tuple, catalog()["op9_dual_tree_top_k"](spark, folder).collect())) == _best(rows, 10, 100)


def test_a_copy_without_id_hides_no_link(spark):
    """The text of a row without id comes first in its task; its copy still finds the near copy."""
    words = [f"w{i}" for i in range(60)]
    text, near = " ".join(words), " ".join(words[:-1])
    docs = spark.createDataFrame([(None, text), (1, text), (2, near)], "doc_id long, text string").coalesce(1)
    found = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(docs, words=4, part=85, whole=100).collect()}
    assert found == {None: None, 1: 1, 2: 1}


def test_shingles_remember_no_words():
    """A worker's memory does not grow with the distinct words of its texts."""
    shingles = jaccard.Shingles(5)
    shingles.of("some words to begin with, more than five")
    tracemalloc.start()
    try:
        for i in range(100):
            assert len(shingles.of(" ".join(f"word{i}x{j}" for j in range(200)))) == 196
        assert tracemalloc.get_traced_memory()[0] < 200_000
    finally:
        tracemalloc.stop()


def test_sketches_tell_large_sets_apart(spark):
    """Large sets with nothing in common need no look at their texts; sketches of two sizes compare."""
    rng = np.random.default_rng(5)
    other, large, above = (np.sort(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (4000, 4000, 1100))
    # the last has 1000 of 1100 shingles and a sketch of half the size
    rows = [(i, len(h), jaccard._bits(h).tolist()) for i, h in enumerate((large, other, above, above[:1000]))]
    classes = spark.createDataFrame(rows, "rep bigint, n bigint, bits array<bigint>")
    pairs = spark.createDataFrame([(1, 0), (3, 2), (2, 0)], "a bigint, b bigint")
    assert [tuple(r) for r in jaccard._plausible(pairs, classes, 80, 100).collect()] == [(3, 2)]
    assert [len(r[2]) for r in rows] == [64, 64, 32, 16]
    folded = jaccard._folded_rows(pa.array([rows[2][2], rows[3][2]], pa.list_(pa.int64())))
    assert folded.shape == (2, 16)
    distance = int(np.bitwise_count(folded[0] ^ folded[1]).sum())
    assert 0 < distance <= 100
    a, b = (F.array(*map(F.lit, rows[i][2])) for i in (2, 3))
    assert spark.range(1).select(jaccard._distance(a, b)).first()[0] == distance


def test_no_link_is_lost_between_sketches_of_two_sizes(spark):
    """Near copies of more and of fewer than 1024 shingles."""
    rng = random.Random(9)
    base = [[f"t{k}w{rng.randrange(10**9)}" for _ in range(1100)] for k in range(4)]
    texts = [" ".join(words[: 1100 - cut]) for words in base for cut in (0, 40, 90, 150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(docs, words=5, part=80, whole=100).collect()}
    assert found == {i: i // 4 * 4 for i in range(16)}


def test_signs_of_sketches_lose_no_link(spark):
    """A linked pair whose sketches differ in the highest bits is found across components."""
    rest = 1024 * np.arange(1, 301, dtype=np.uint64) + np.uint64(5)
    more = np.array([64 * word + place for word in range(16) for place in (1, 56)], np.uint64)
    rows = [(i, len(h), jaccard._bits(h).tolist()) for i, h in enumerate((rest, np.sort(np.concatenate([rest, more]))))]
    classes = spark.createDataFrame(rows, "rep bigint, n bigint, bits array<bigint>")
    buckets = spark.createDataFrame([(0, [7], 2), (1, [7], 2)], "doc_id bigint, keys array<bigint>, weight bigint")
    labels = spark.createDataFrame([(0, 0, 0), (1, 1, 1)], "doc_id bigint, rep bigint, label bigint")
    assert [tuple(r) for r in jaccard._across(buckets, labels, classes, 80, 100).collect()] == [(1, 0)]
