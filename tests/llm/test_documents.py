"""Languages, quality, licences, shards and the pipeline: brute force and held-out rows."""

import re
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from parley.llm import langid, licenses, quality, shards
from parley.llm.oracles import oracles
from parley.llm.queries import catalog, fold

ENOUGH = "/root/testdata/sf0.01"


def _read(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


# -- shards -----------------------------------------------------------------------------------


def _jump(key, shards_):
    """The published loop."""
    state, shard, following = key % 2**64, -1, 0
    while following < shards_:
        shard = following
        state = (state * 2862933555777941757 + 1) % 2**64
        following = int((shard + 1) * (float(1 << 31) / float((state >> 33) + 1)))
    return shard


def test_jump_equals_the_published_loop(spark):
    keys = [0, 1, 2, 7, 10**6, 2**31, 2**40 + 5, 2**63 - 1, -1, -(2**63), *range(100, 400)]
    frame = spark.createDataFrame([(k,) for k in keys], "k long")
    for count in (1, 2, 16, 100):
        got = {r.k: (r.j.shard, r.j.grown_shard) for r in frame.select("k", shards.jump(F.col("k"), count).alias("j")).collect()}
        assert got == {k: (_jump(k, count), _jump(k, count + 1)) for k in keys}


def test_one_more_shard_takes_only_its_share(spark):
    rows = shards.shard(spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")), 16)
    moved = rows.where("grown_shard <> shard")
    assert moved.where("grown_shard <> 16").count() == 0
    assert 0.8 < moved.count() / (30_000 / 17) < 1.2
    sizes = [r["count"] for r in rows.groupBy("shard").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 1.15 * min(sizes)


def test_slots_are_gapless_and_edges_hold(edge_docs, no_docs):
    rows = shards.shard(edge_docs, 3).collect()
    slots = defaultdict(list)
    for row in rows:
        slots[row.shard].append(row.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts = defaultdict(list)
    for row in edge_docs.collect():
        data = (row.text or "").encode()
        texts[row.doc_id].append((len(data) + 1, zlib.crc32(data), _jump(row.doc_id or 0, 3)))
    got = defaultdict(list)
    for row in rows:
        got[row.doc_id].append((row.size, row.text_crc32, row.shard))
    assert got == texts
    assert shards.shard(no_docs).count() == 0


def test_op4_equals_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS FROM '{ENOUGH}/documents.parquet'")
    want = duck.execute(oracles()["op4_jump_shards"])
    columns = [c[0] for c in want.description]
    got = catalog()["op4_jump_shards"](spark, ENOUGH).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


# -- licences -----------------------------------------------------------------------------------

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _scan(text, rules):
    """Plain counterpart: every rule on every text, containment pair by pair."""
    words = _WORD.findall((text or "").translate(_LOWER))
    places, base = [], set()
    for phrase, label in licenses.BASE.items():
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                places.append(i)
                base.add(label)
    line = " " + " ".join(words) + " " if words else " "
    found = [(m.start(), m.end(), r.priority, r.order, r.label) for r in rules for m in r.pattern_.finditer(line)]
    kept = [
        d for d in found
        if not any(
            o is not d and o[0] <= d[0] and d[1] <= o[1] and o[2] <= d[2]
            and ((o[0], o[1]) != (d[0], d[1]) or (o[2], o[3]) < (d[2], d[3]))
            for o in found
        )
    ]
    score = max([licenses.CONFIDENCE[d[2]] for d in kept] + [0.5 if base else 0.0])
    ends = (min(places), max(places)) if places else (None, None)
    return (len(words), len(places), *ends, ",".join(sorted(base)), ",".join(sorted(base | {d[4] for d in kept})), score)


@pytest.fixture(scope="module")
def compiled():
    rules = licenses.rules()
    assert len(rules) > 300
    for rule in rules:
        object.__setattr__(rule, "pattern_", re.compile(rule.pattern))
    return rules


TEXTS = [
    "cc by", "CC-BY cc by, general public license!! x", "...", "é cc by é", "a\0cc by\0", "cc cc by by",
    "Licensed under the GNU General Public License, version 3.", "GPL general public License all rights reserved cc by cc by",
    "Released under the MIT License.", "mit mit der MIT", "Apache License, Version 2.0 and apache", "SPDX-License-Identifier: Apache-2.0",
    "SPDX-License-Identifier: MIT", "Licensed under CC BY-NC 4.0. Some Creative Commons Attribution Share Alike 3.0 text",
    "LGPL v2.1 or AGPL 3 or gplv3 or GNU lesser general public license version 2.1", "Copyright (c) 2019 X. All rights reserved.",
    "without warranty of any kind, provided as is, in the public domain", "the ISC license; BSD 3 clause license, new BSD",
    "Mozilla Public License 2.0 MPL 1.1 Eclipse Public License", "cc by sa 4.0 cc by nc nd 2.5 cc0 1.0 creative commons zero",
]


def test_scan_equals_all_rules_on_all_texts(spark, compiled):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in licenses.scan(frame).collect()}
    assert got == {i: _scan(t, compiled) for i, t in enumerate(TEXTS)}


def test_every_keyword_is_in_every_match(compiled):
    """The prefilter loses nothing: the rules without it give the same."""
    for text in TEXTS:
        line = " " + " ".join(_WORD.findall(text.translate(_LOWER))) + " "
        for rule in compiled:
            assert rule.keyword in line or not rule.pattern_.search(line), (rule, text)


def test_labels_of_the_examples(compiled):
    assert _scan(TEXTS[6], compiled)[5] == "gpl,gpl-3.0"
    assert _scan(TEXTS[8], compiled)[5] == "mit"
    assert _scan(TEXTS[9], compiled)[5] == ""
    assert "apache-2.0" in _scan(TEXTS[11], compiled)[5]


def test_bare_names_behind_a_grant(spark, compiled):
    """Everyday words are names behind a grant, and a name needs no keyword that it lacks."""
    texts = {
        "Licensed under MIT.": "mit", "Released under the MIT": "mit", "available under the terms of the MIT, too": "mit",
        "Distributed under the terms of the ISC": "isc", "Published under ISC or later": "isc", "the MIT Public License": "mit",
        "ISC public licence": "isc", "Runs on FreeBSD": "bsd-2-clause", "Licensed under FreeBSD": "bsd-2-clause",
        "under the bridge mit dem ISC": "", "mit under mit": "",
    }
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in licenses.scan(frame).collect()}
    assert [got[i][5] for i in sorted(got)] == list(texts.values())
    assert got == {i: _scan(t, compiled) for i, t in enumerate(texts)}


def test_op5_query_and_edges(spark, folder, edge_docs, no_docs, compiled):
    docs = _read(spark, folder, "documents").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in catalog()["op5_license_rules"](spark, folder).collect()}
    assert got == {d.doc_id: _scan(d.text, compiled) for d in docs}
    edges = sorted(str(tuple(r)) for r in licenses.scan(edge_docs).collect())
    assert edges == sorted(str((r.doc_id, *_scan(r.text, compiled))) for r in edge_docs.collect())
    assert licenses.scan(no_docs).count() == 0


def test_a_text_full_of_licences_takes_no_quadratic_time(spark):
    """The square of 80,000 matches would take minutes."""
    frame = spark.createDataFrame([(1, "gpl bsd " * 40_000)], "doc_id long, text string")
    begin = time.monotonic()
    found = licenses.scan(frame).first()
    assert found["labels"] == "bsd,gpl" and found["n_words"] == 80_000
    assert time.monotonic() - begin < 60



# -- languages ------------------------------------------------------------------------------------


def _plain_kneser_ney(words, text_words, symbols_of_all):
    """Cross-entropy of words by the textbook recursion, for one language."""
    order = langid.ORDER
    tables = [defaultdict(float) for _ in range(order)]
    for word, n in words.items():
        padded = langid._START * (order - 1) + word + langid._END
        for i in range(order, len(padded) + 1):
            tables[-1][padded[i - order : i]] += n
    for k in range(order - 1, 0, -1):
        for gram in tables[k]:
            tables[k - 1][gram[1:]] += 1
    discounts = []
    for table in tables:
        once, twice = sum(v == 1 for v in table.values()), sum(v == 2 for v in table.values())
        discounts.append(once / max(once + 2 * twice, 1) if once else 0.75)

    def chance(gram):
        if not gram:
            return 1 / (symbols_of_all + 1)
        table, d = tables[len(gram) - 1], discounts[len(gram) - 1]
        followers = {g: v for g, v in table.items() if g[:-1] == gram[:-1]}
        if not followers:
            return chance(gram[1:])
        total = sum(followers.values())
        share = min(d * len(followers) / total, 1)
        return max(followers.get(gram, 0) - d, 0) / total + share * chance(gram[1:])

    def known(gram):
        return gram if gram[-1:] in tables[0] else None

    bits = symbols = 0
    for word in text_words:
        padded = langid._START * (order - 1) + word + langid._END
        for i in range(order, len(padded) + 1):
            assert known(padded[i - order : i])
            bits -= np.log2(chance(padded[i - order : i]))
            symbols += 1
    return bits / symbols


def test_models_follow_the_textbook(spark):
    train = spark.createDataFrame([("a", "banana band abba"), ("a", "nab dab band"), ("b", "cello bell lob")], "lang string, text string")
    models = langid.learn(train)
    assert models.languages == ["a", "b"]
    words = {"banana": 1, "band": 2, "abba": 1, "nab": 1, "dab": 1}
    for text in ("banana", "nand dabba", "bad"):
        sums = models.word_scores(text.split()).sum(axis=0)
        assert sums[0] / sums[-1] == pytest.approx(_plain_kneser_ney(words, text.split(), len(set("banandbcellobellob")) + 1), rel=1e-6)


def test_models_hold_all_languages_and_grams(spark):
    """More languages than 64, and one with more than 200,000 n-grams."""
    rng = np.random.default_rng(3)
    large = ["".join(map(chr, w)) for w in rng.integers(0x4E00, 0x9000, (60_000, 4))]
    rows = [("large", " ".join(large))]
    rows += [(f"l{i:02}", " ".join(chr(0x1200 + 4 * i + d) * n for d in range(4) for n in (1, 2, 3))) for i in range(70)]
    train = spark.createDataFrame(rows, "lang string, text string")
    models = langid.learn(train)
    assert models.languages == sorted(r[0] for r in rows)
    words = Counter(large)
    grams, counts = langid.count_grams(words)
    assert len(grams) > 200_000
    n1, n2 = (counts == 1).sum(), (counts == 2).sum()
    discount = n1 / (n1 + 2 * n2)
    # a context seen once keeps the rest of the discount for what was not seen
    held = langid._load(models.folder)
    place = models.languages.index("large")
    context = large[0][:3]
    follow = [int(n) for g, n in zip(grams, counts, strict=True) if g[:3] == context]
    _, places, weights = held[2 * langid.ORDER - 1].find(np.array([langid._hash(context)], np.uint64))
    assert places.tolist() == [place]
    assert weights[0] == pytest.approx(min(discount * len(follow) / sum(follow), 1))
    assert (held[2 * langid.ORDER - 2].places == place).sum() == len(grams)
    best = models.word_scores([r[1].split()[2] for r in rows[1:]])[:, :-1].argmin(axis=1)
    assert [models.languages[i] for i in best] == [r[0] for r in rows[1:]]


def test_new_words_are_scored_some_at_a_time(spark):
    """A batch full of new words takes memory for some of them, and gives the same scores."""
    train = spark.createDataFrame([("a", "banana band abba"), ("b", "cello bell lob")], "lang string, text string")
    models = langid.learn(train)
    letters = "abcdelno"
    words = ["".join(letters[i >> shift & 7] for shift in range(0, 18, 3)) + "bell" for i in range(80_000)]
    expected = [models.word_scores([w])[0] for w in words[:50_000:10_000]]
    tracemalloc.start()
    try:
        scorer = langid._Scorer(models)
        scorer.learn(set(words))
        assert tracemalloc.get_traced_memory()[1] < 60e6
    finally:
        tracemalloc.stop()
    for word, row in zip(words[:50_000:10_000], expected, strict=True):
        assert scorer.text([word]) == pytest.approx(row, rel=1e-6)


def test_op3_on_held_out_documents(spark):
    rows = catalog()["op3_kneser_ney_languages"](spark, ENOUGH).collect()
    docs = {r.doc_id: r for r in _read(spark, ENOUGH, "documents").collect()}
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) > 0.98
    assert np.mean([r.rejected for r in rows]) < 0.01


def test_languages_of_edges(spark, edge_docs, no_docs):
    train = _read(spark, ENOUGH, "documents").selectExpr("doc_id + 1000 AS doc_id", "text", "lang", "source", "n_chars")
    both = train.unionByName(edge_docs.select("doc_id", "text", "lang", "source", "n_chars"))
    found = langid.identify(both, (F.col("doc_id") >= 1000)).where("doc_id IS NULL OR doc_id < 1000").collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == edge_docs.count()
    for doc_id in (1, 2, 3, 8):
        assert (by_id[doc_id].lang_pred, by_id[doc_id].score, by_id[doc_id].rejected) == ("und", 0.0, True)
    for doc_id in (None, 4, 5, 6, 7, 9, 10, 11):
        assert by_id[doc_id].lang_pred in ("de", "en", "es", "fr")
    assert by_id[7].rejected, "one letter without end is no language"
    assert not by_id[4].rejected
    assert (by_id[9].lang_pred, by_id[9].score) == (by_id[10].lang_pred, by_id[10].score), "case does not matter"
    assert langid.identify(no_docs, F.lit(True)).count() == 0
    untrained = langid.identify(edge_docs, F.lit(False)).collect()
    assert {r.lang_pred for r in untrained} == {"und"} and len(untrained) == len(found)


# -- quality ----------------------------------------------------------------------------------------


def test_op10_on_held_out_documents(spark):
    rows = {r.doc_id: r for r in catalog()["op10_fourier_quality"](spark, ENOUGH).collect()}
    labels = {r.doc_id: r.quality for r in _read(spark, ENOUGH, "labels").collect()}
    assert len(rows) == _read(spark, ENOUGH, "documents").count()
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in rows.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    held = [(rows[i].score, q) for i, q in labels.items() if rows[i].held_out]
    good, bad = ([s for s, q in held if q == k] for k in (1, 0))
    pairs = [(g > b) + 0.5 * (g == b) for g in good for b in bad]
    assert np.mean(pairs) > 0.95


def test_normal_equations_are_those_of_all_rows(spark):
    rng = np.random.default_rng(0)
    k = len(quality.STATISTICS)
    values = rng.normal(size=(500, k))
    labels = (values[:, 0] > 0).astype(float)
    model = quality.Model(np.zeros(k), np.ones(k), rng.normal(size=(k, 20)), rng.uniform(size=20))
    rows = spark.createDataFrame([(v.tolist(), float(y)) for v, y in zip(values, labels, strict=True)], "statistics array<double>, label double")
    squares, products, n = quality.normal_equations(rows.repartition(7), model)
    z = model.features(values)
    assert n == 500 and np.allclose(squares, z.T @ z) and np.allclose(products, z.T @ labels)


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(1)
    k = len(quality.STATISTICS)
    model = quality.Model(np.zeros(k), np.ones(k), rng.normal(size=(k, 20_000)) / quality.WIDTH, rng.uniform(0, 2 * np.pi, 20_000))
    x = rng.normal(size=(6, k))
    z = model.features(x)[:, :-1]
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * quality.WIDTH**2))
    assert np.allclose(z @ z.T, kernel, atol=0.03)


def test_isotonic_pools_what_falls():
    points, chances = quality.isotonic([(0.0, 10, 0), (1.0, 10, 6), (2.0, 10, 4), (3.0, 10, 10)])
    assert points.tolist() == [0.0, 1.5, 3.0]
    assert chances.tolist() == pytest.approx([0.5 / 11, 10.5 / 21, 10.5 / 11])


def test_quality_of_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(4, 1), (6, 0), (7, 0), (9, 1), (9, None), (None, 1), (77, 0)], "doc_id long, quality int")
    rows = quality.score(edge_docs, labels, F.lit(True), F.lit(False)).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (4, 5)}) == 1, "equal texts score alike"
    # without both labels the share of label 1
    one = quality.score(edge_docs, labels.where("quality = 1"), F.lit(True), F.lit(False))
    assert {r.score for r in one.collect()} == {1.0}
    none = quality.score(edge_docs, labels.where("false"), F.lit(True), F.lit(False))
    assert {r.score for r in none.collect()} == {0.5}
    assert quality.score(no_docs, labels, F.lit(True), F.lit(False)).count() == 0
    assert quality.statistics_of("") == [0.0] * len(quality.STATISTICS)


# -- pipeline -----------------------------------------------------------------------------------------


def test_stages_decide_as_their_operators(spark):
    docs = _read(spark, ENOUGH, "documents")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_duplicates", "packing"]
    frames = {}
    for name, stage in corpus_pipeline.STAGES:
        frames[name] = docs = corpus_pipeline.stored(stage(spark, docs, ENOUGH))
        if name != "packing":
            assert docs.columns == columns
    ids = {n: {r.doc_id for r in f.select("doc_id").collect()} for n, f in frames.items()}
    assert ids["packing"] == ids["near_duplicates"] < ids["quality"] < ids["language"]

    labels = {r.doc_id: r.quality for r in _read(spark, ENOUGH, "labels").collect()}
    good = {i for i, q in labels.items() if q == 1}
    bad = {i for i, q in labels.items() if q == 0}
    assert good <= ids["language"]
    assert len(good - ids["quality"]) <= 0.02 * len(good)
    assert len(bad & ids["quality"]) <= 0.15 * len(bad)

    # one document of each group, by brute force over the stage's input
    sets = {}
    for row in frames["quality"].collect():
        words = [w for w in re.split("[\x20\x09-\x0d]+", row.text.translate(_LOWER)) if w]
        sets[row.doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    order = sorted(sets)
    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            common = len(sets[a] & sets[b])
            if 10 * common >= 8 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    assert ids["near_duplicates"] == {i for i in sets if find(i) == i}


def test_stages_on_edges(spark, edge_docs, no_docs):
    for frame in (edge_docs, no_docs):
        docs = frame
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stored(stage(spark, docs, ENOUGH))
            if name != "packing":
                assert docs.columns == frame.columns
        assert docs.columns[0] == "doc_id"
    assert docs.count() == 0


def test_the_subpackage_is_optional():
    """Nothing else imports it, and the contract still works when it is gone."""
    import subprocess
    import sys
    from pathlib import Path

    root = Path(corpus_pipeline.__file__).parent
    for file in (root / "parley").rglob("*.py"):
        if file.parent.name != "llm":
            assert "parley.llm" not in file.read_text() and "corpus_pipeline" not in file.read_text()
    hidden = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.startswith("parley.llm") or name == "corpus_pipeline":
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert "count_by_channel" in e.queries() and not any(q.startswith("op") for q in e.queries())
assert "pipeline" not in e.queries() and "count_by_channel" in e.oracle_sql()
"""
    subprocess.run([sys.executable, "-c", hidden], cwd=root, check=True)


def test_folds_are_checksums(spark):
    rows = spark.createDataFrame([(i,) for i in (0, 7, 12345, None)], "doc_id long").select("doc_id", fold(3).alias("f")).collect()
    assert {r.doc_id: r.f for r in rows} == {i: None if i is None else zlib.crc32(str(i).encode()) % 3 for i in (0, 7, 12345, None)}
