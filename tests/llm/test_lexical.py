"""Ranked lexical search against a plain scan of all pairs."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parley.llm import lexical
from parley.llm.queries import catalog

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_SMALL = {c: c + 32 for c in range(65, 91)}


def _terms(text):
    return _TERM.findall((text or "").translate(_SMALL))


def _plain(docs, items, k=10):
    """(item, rank, doc, score) by scoring every pair of (id, text) rows."""
    texts = [(d, Counter(_terms(t))) for d, t in docs]
    texts = [(d, c, sum(c.values())) for d, c in texts if c]
    n_docs, total = len(texts), sum(n for _, _, n in texts)
    holding = Counter(t for _, c, _ in texts for t in c)
    wanted = {}
    for item, text in items:
        if item is not None:
            wanted.setdefault(item, Counter()).update(_terms(text))
    rows = []
    for item, terms in wanted.items():
        scored = []
        for doc, counts, n in texts:
            m = 25 + 75 * n * n_docs // total
            score = 0
            for t, q in terms.items():
                if t in counts:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1)))
                    score += q * w * (1_000_000_000 * counts[t] // (1000 * counts[t] + 8 * m))
            if score > 0 and doc is not None:
                scored.append((-score, doc))
        rows += [(item, rank, doc, -score) for rank, (score, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(rows)


def _searched(spark, docs, items, k=10):
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(items, "item_id long, text string")
    return sorted(tuple(r) for r in lexical.search(docs, items, k).collect())


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=40), st.text(max_size=40))
def test_terms(raw, text):
    assert [t.decode() for t in lexical.terms_of(text.encode())] == _terms(text)
    plain = raw.decode("latin-1")
    assert [t.decode() for t in lexical.terms_of(plain.encode())] == _terms(plain)


def _made_up(count, seed):
    random = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(60)] + ["Über", "ÜBER", "x9"]
    weights = 1 / np.arange(1, len(words) + 1)
    return [" ".join(random.choice(words, random.integers(0, 25), p=weights / weights.sum())) for _ in range(count)]


@pytest.mark.parametrize(("items", "terms", "chunk", "cells"), [(1024, 8192, 1024, 1 << 22), (7, 8192, 16, 1 << 22), (1024, 20, 64, 400)])
def test_blocks_and_chunks_do_not_change_the_lists(spark, monkeypatch, items, terms, chunk, cells):
    docs = list(enumerate(_made_up(300, 1)))
    wanted = list(enumerate(_made_up(23, 2), 100))
    expected = _plain(docs, wanted)
    for name, value in (("ITEMS", items), ("TERMS", terms)):
        monkeypatch.setattr(lexical, name, value)
    assert _searched(spark, docs, wanted) == expected
    # the tasks have their own constants, so small chunks are tried without Spark
    counts = {i: Counter(lexical.terms_of(t.encode())) for i, t in wanted}
    held = Counter(t for _, text in docs for t in set(lexical.terms_of(text.encode())))
    sizes = [len(_terms(t)) for _, t in docs]
    block = lexical.Items(counts, lexical.Statistics(sum(map(bool, sizes)), sum(sizes), held))
    lists = lexical.Lists(block, 10)
    for start in range(0, len(docs), chunk):
        part = docs[start : start + chunk]
        lists.add(np.array([d for d, _ in part]), lexical.coordinates([t.encode() for _, t in part], block))
    table = lists.table().to_pylist()
    assert sorted((r["item_id"], r["doc_id"], r["score"]) for r in table) == sorted((i, d, s) for i, _, d, s in expected)


def test_pruning_leaves_out_most_pairs_of_other_topics():
    """Items and documents of eight topics, mixed: few are scored against items of another topic."""
    random = np.random.default_rng(4)
    docs = [" ".join(f"t{d % 8}x{v}" for v in random.integers(0, 30, 14)) for d in range(4_000)]
    wanted = {i: Counter(lexical.terms_of(docs[11 * i].encode())) for i in range(64)}
    held = Counter(t for text in docs for t in set(lexical.terms_of(text.encode())))
    items = lexical.Items(wanted, lexical.Statistics(len(docs), 14 * len(docs), held))
    lists = lexical.Lists(items, 10)
    for start in range(0, len(docs), 500):
        lists.add(np.arange(start, start + 500), lexical.coordinates([t.encode() for t in docs[start : start + 500]], items))
    assert lists.scored < 0.15 * lists.possible
    before = lists.scored
    far = [" ".join(f"t9x{v}" for v in range(9)) for _ in range(500)] + [f"t{d % 8}x1" for d in range(500)]
    lists.add(np.arange(4_000, 5_000), lexical.coordinates([t.encode() for t in far], items))
    assert lists.scored == before, "a chunk that cannot enter a list is left out as a whole"


def test_large_weights_stay_exact():
    """Items which repeat a term a thousand million times, without a text of that size."""
    docs = [(d, "rare " * (d % 5) + "word " * (d % 3) + "other") for d in range(400)]
    wanted = {i: Counter({b"rare": 1_000_000_000 + i, b"word": 1 + i % 3}) for i in range(40)}
    held = Counter(t for _, text in docs for t in set(lexical.terms_of(text.encode())))
    statistics = lexical.Statistics(400, sum(len(_terms(t)) for _, t in docs), held)
    items = lexical.Items(wanted, statistics)
    assert items.kind == np.int64
    lists = lexical.Lists(items, 10)
    lists.add(np.arange(400), lexical.coordinates([t.encode() for _, t in docs], items))
    for place, item in enumerate(items.ids.tolist()):
        scores = []
        for doc, text in docs:
            terms = Counter(lexical.terms_of(text.encode()))
            m = 25 + 75 * sum(terms.values()) * 400 // statistics.terms
            score = sum(q * statistics.weight(t) * (10**9 * terms[t] // (1000 * terms[t] + 8 * m)) for t, q in wanted[item].items())
            scores.append((-score, doc))
        best = sorted(scores)[:10]
        assert -best[0][0] > 1 << 53
        assert lists.scores[place].tolist() == [-s for s, _ in best] and lists.docs[place].tolist() == [d for _, d in best]


def test_nulls_ties_and_repeats(spark):
    docs = [(None, "alpha beta"), (1, None), (2, ""), (3, " .,- "), (4, "Alpha beta"), (5, "alpha beta"), (5, "alpha beta")]
    docs += [(d, "alpha BETA gamma" if d % 2 else "delta") for d in range(20, 60)]
    items = [(7, "alpha"), (7, "beta beta"), (8, None), (9, "never seen"), (None, "alpha"), (-3, "DELTA, alpha!")]
    expected = _plain(docs, items)
    assert _searched(spark, docs, items) == expected
    assert {r[0] for r in expected} == {7, -3}
    assert _searched(spark, docs, items, k=1) == _plain(docs, items, 1)


def test_edges(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "same plain words"), (2, "word5 one")], "item_id long, text string")
    wide = items.selectExpr("*", "1 AS doc_id", "2 AS score", "3 AS rank")
    found = sorted(tuple(r) for r in lexical.search(edge_docs, wide).collect())
    assert found == _plain([(r["doc_id"], r["text"]) for r in edge_docs.collect()], [tuple(r) for r in items.collect()])
    assert lexical.search(no_docs, items).count() == 0
    assert lexical.search(edge_docs, items.where("false")).count() == 0


def test_query_equals_plain_scan(spark, folder):
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    assert sorted(tuple(r) for r in catalog()["op11_dual_tree_lexical"](spark, folder).collect()) == _plain(docs, items)
