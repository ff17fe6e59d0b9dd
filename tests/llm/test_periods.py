"""Runs of words against all lags of each text, and the query against a plain reading of its contract."""

import hashlib
import re
import time
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from parley.llm import periods
from parley.llm.queries import catalog, with_planted_runs


def _all_lags(words):
    found = {}
    for lag in range(1, len(words) // 4 + 1):
        start = 0
        while start + lag < len(words):
            stop = start
            while stop + lag < len(words) and words[stop] == words[stop + lag]:
                stop += 1
            length = stop - start + lag
            if stop > start and length >= max(6, 4 * lag):
                found.setdefault((start, length), lag)
            start = stop + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def _without_repeats(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


_part = st.tuples(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 6), st.lists(st.integers(0, 2), max_size=9))


@settings(max_examples=250, deadline=None)
@given(st.lists(st.lists(_part, max_size=4), max_size=5))
def test_runs_equal_all_lags(parts):
    texts = [sum((unit * times + rest for unit, times, rest in text), []) for text in parts]
    for words, runs in zip(texts, periods.find_runs(texts), strict=True):
        want = _all_lags(words)
        assert [tuple(r) for r in runs.tolist()] == want
        assert periods.kept(words, runs) == _without_repeats(words, want)


def test_every_period_is_found_at_its_shortest():
    for period in [*range(1, 120), 257, 1000, 1023, 1024]:
        unit = [f"w{i}" for i in range(period)]
        size = max(6, 4 * period)
        words = ["a", *(unit * 6)[:size], "b"]
        assert periods.find_runs([words])[0].tolist() == [[1, size, period]]
        assert not len(periods.find_runs([["a", *(unit * 6)[: size - 1], "b"]])[0])


def test_every_period_has_a_scale():
    scales = periods.scales(100_000)
    for period in range(periods.SHORT + 1, 100_000, 7):
        assert any(least <= period <= w <= (3 * period + 1) // 2 for w, least in scales)
    assert len(scales) < 30


def test_minimizers_are_window_minima():
    values = np.random.default_rng(3).integers(0, 40, 300).astype(np.uint64)
    for window in (1, 2, 3, 7, 8, 100, 300):
        want = {i + int(np.argmin(values[i : i + window])) for i in range(300 - window + 1)}
        assert periods.minimizers(values, window).tolist() == sorted(want)
    assert not len(periods.minimizers(values, 301))


def test_self_similar_and_long_texts_take_near_linear_time():
    a, b = [0], [0, 1]
    while len(b) < 200_000:
        a, b = b, b + a
    turned = [0, 1]
    while len(turned) < 200_000:
        turned += [1 - v for v in turned]
    begin = time.monotonic()
    # neither has a fourth power
    assert [len(r) for r in periods.find_runs([b, turned])] == [0, 0]
    assert periods.find_runs([["x"] * 300_000])[0].tolist() == [[0, 300_000, 1]]
    assert time.monotonic() - begin < 20


def test_query_equals_its_contract(spark, folder):
    found = {r["doc_id"]: tuple(r)[1:] for r in catalog()["op12_scale_minimizers"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(docs) == len(found)
    some = 0
    for doc_id, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        hashed, n = zlib.crc32(str(doc_id).encode()), len(words)
        if hashed % 10 == 0 and n:
            a = hashed // 10 % n
            p = 1 + (n - a) // (3 + hashed // 10 % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
        if n > 3_000:
            runs = [tuple(r) for r in periods.find_runs([words])[0].tolist()]
        else:
            runs = _all_lags(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        left = " ".join(_without_repeats(words, runs))
        digests = [hashlib.sha256(t.encode()).hexdigest() for t in (listed, left)]
        assert found[doc_id] == (len(runs), *best, 1000 * best[1] // best[2] if runs else None, *digests)
        some += bool(runs)
    assert some > 5


def test_edges(spark, edge_docs, no_docs):
    rows = periods.runs_of(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    for empty in (1, 2, 3):
        assert by_id[empty]["runs"] == [] and by_id[empty]["collapsed"] == ""
    # 997 numbers with a word between them: one run over the whole text, cut to one period
    assert [tuple(r) for r in by_id[6]["runs"]] == [(0, 40_000, 1994)]
    assert by_id[6]["collapsed"].split() == [w for i in range(997) for w in (f"word{i}", "and")]
    assert by_id[7]["collapsed"] == "x" * 100_000
    assert periods.runs_of(no_docs).count() == 0
    assert with_planted_runs(no_docs).count() == 0
    assert with_planted_runs(edge_docs).count() == edge_docs.count()
