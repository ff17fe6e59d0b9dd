"""Periodic runs of words by multi-scale minimizers.

A run is a stretch of words with smallest period q and at least ``max(LEAST_WORDS, REPEATS * q)``
words that no neighbouring word extends with that period. The words of a batch of texts lie in
one array, separated by values that occur once.

- Periods up to ``SHORT`` come from direct scans: the words are compared with those q places on.
- A longer period has a scale w with q <= w <= (3q + 1) / 2. Hashes of all stretches of w words
  differ at the q places of a period, so every window of w places inside the run has its least
  hash at the same place of the period, and these places, the minimizers of the scale, follow
  each other at distance q. A window pair q apart fits into four periods, so each run gives at
  least one pair of neighbouring minimizers with equal hashes. Such pairs are extended in both
  directions by comparing blocks of 2^k words from the longest on.

Different periods of one stretch are multiples of the smallest, which is kept. Blocks are
compared by 64-bit hashes, mixed anew at each doubling, so equal hashes of different blocks are a
matter of chance (about 1e-7 for a text of a million words).

Nulls and edges: a null text, an empty one, and one of white space have no words and no runs;
texts of any length are processed whole, with memory and time proportional to their words times
the logarithm of them; equal rows stay equal rows; a null ``doc_id`` stays null; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import prepare_workers

#: The shortest run, and the least number of its periods.
LEAST_WORDS, REPEATS = 6, 4
#: Longest period found by direct comparison.
SHORT = 8
#: Bytes of texts in one array, if no text is longer.
SLAB = 1 << 20
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def scales(longest: int) -> list[tuple[int, int]]:
    """(w, least period) of the scales up to the period ``longest``: each period above ``SHORT``
    is at most w and at least (2w - 1) / 3 of one scale."""
    found, period = [], SHORT + 1
    while period <= longest:
        found.append(((3 * period + 1) // 2, period))
        period = found[-1][0] + 1
    return found


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of two hashes; products wrap around."""
    x = left * np.uint64(0x9E3779B97F4A7C15) + (right ^ (right >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


class Blocks:
    """Hashes of all stretches of 2^k words, made when first asked for."""

    def __init__(self, words: np.ndarray):
        self.words = words
        first = words.astype(np.uint64)
        self.levels = [_mixed(first, first)]

    def level(self, k: int) -> np.ndarray:
        while len(self.levels) <= k:
            half, last = 1 << (len(self.levels) - 1), self.levels[-1]
            self.levels.append(_mixed(last[:-half], last[half:]))
        return self.levels[k]

    def of(self, size: int) -> np.ndarray:
        """Hashes of all stretches of ``size`` words: of two stretches of 2^k that cover them."""
        k = size.bit_length() - 1
        part, count = self.level(k), len(self.words) - size + 1
        return _mixed(part[:count], part[size - (1 << k) :][:count])

    def extend(self, at: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first place, and the place behind the last, of the stretch around ``at`` where
        words equal those ``lag`` places on."""
        low, high = at.copy(), at.copy()
        for k in range(len(self.words).bit_length() - 1, -1, -1):
            block, step = self.level(k), 1 << k
            on = high + lag < len(block)
            on[on] = block[high[on]] == block[(high + lag)[on]]
            high[on] += step
            back = low >= step
            back[back] = block[low[back] - step] == block[(low + lag)[back] - step]
            low[back] -= step
        return low, high


def minimizers(hashes: np.ndarray, window: int) -> np.ndarray:
    """The places of the least hash of each window, the first of equal ones."""
    least, place, reach = hashes, np.arange(len(hashes)), 1
    while reach < window and len(least) > min(reach, window - reach):
        step = min(reach, window - reach)
        other = least[step:] < least[:-step]
        place = np.where(other, place[step:], place[:-step])
        least = np.minimum(least[step:], least[:-step])
        reach += step
    chosen = np.zeros(len(hashes), bool)
    if reach == window:
        chosen[place] = True
    return np.flatnonzero(chosen)


def _by_lag(words: np.ndarray, lag: int) -> np.ndarray:
    """(start, length, period) of the stretches of one period."""
    equal = np.zeros(len(words) + 2, np.int8)
    equal[1 : len(words) - lag + 1] = words[:-lag] == words[lag:]
    edges = np.diff(equal)
    start, stop = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    return _long_enough(start, stop, np.full(len(start), lag))


def _long_enough(start: np.ndarray, stop: np.ndarray, lag: np.ndarray) -> np.ndarray:
    length = stop - start + lag
    return np.column_stack([start, length, lag])[length >= np.maximum(LEAST_WORDS, REPEATS * lag)]


def _by_scale(blocks: Blocks, count: int, size: int) -> np.ndarray:
    """The stretches which neighbouring minimizers of one scale lead to, in the first words."""
    hashes = blocks.of(size)[: count - size + 1]
    chosen = minimizers(hashes, size)
    lag = np.diff(chosen)
    pair = np.flatnonzero(hashes[chosen[:-1]] == hashes[chosen[1:]])
    at, lag = chosen[pair], lag[pair]
    # a pair that goes on from the one before lies in the same stretch
    fresh = np.ones(len(at), bool)
    fresh[1:] = (at[1:] != at[:-1] + lag[:-1]) | (lag[1:] != lag[:-1])
    at, lag = at[fresh], lag[fresh]
    low, high = blocks.extend(at, lag)
    return _long_enough(low, high, lag)


def find_runs(texts: list[list]) -> list[np.ndarray]:
    """(start, length, period) of the runs of each list of words, by start, then period."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    numbers: dict = {}
    parts, ends = [], []
    for i in order:
        # long lists first, so that those which a scale concerns are a prefix
        parts += [numbers.setdefault(w, len(numbers)) for w in texts[i]]
        ends.append(len(parts) + 1)
        parts.append(-len(ends))
    words = np.array(parts, np.int64)
    sizes = np.array([len(texts[i]) for i in order], np.int64)
    found = [_by_lag(words, lag) for lag in range(1, min(SHORT, len(words) - 1) + 1)]
    blocks = Blocks(words)
    for size, least in scales(int(sizes[0]) // REPEATS if len(sizes) else 0):
        concerned = int(np.searchsorted(-sizes, -REPEATS * least, side="right"))
        found.append(_by_scale(blocks, ends[concerned - 1], size))
    runs = np.concatenate(found) if found else np.empty((0, 3), np.int64)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    again = np.zeros(len(runs), bool)
    again[1:] = (runs[1:, :2] == runs[:-1, :2]).all(axis=1)
    runs = runs[~again]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    out: list[np.ndarray] = [runs[:0]] * len(texts)
    bounds = np.searchsorted(runs[:, 0], [0, *ends])
    for k, i in enumerate(order):
        if bounds[k] < bounds[k + 1]:
            out[i] = runs[bounds[k] : bounds[k + 1]] - [ends[k - 1] if k else 0, 0, 0]
    return out


def kept(words: list, runs: np.ndarray) -> list:
    """The words that are in no run behind its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    inside = np.cumsum(change).tolist()
    return [w for w, n in zip(words, inside) if not n]


def _slabs(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[list[bytes]]]]:
    """Ids and words of rows, about ``SLAB`` bytes at a time."""
    part = (np.cumsum(np.asarray(batch.column(2))) // SLAB).tolist()
    start = 0
    for stop in range(1, len(part) + 1):
        if stop == len(part) or part[stop] != part[start]:
            # without arguments bytes are split at the six white-space bytes of ASCII
            yield batch.column(0)[start:stop], [t.split() for t in batch.column(1)[start:stop].to_pylist()]
            start = stop


def _run_lists(runs: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(runs)
    fields = [pa.array(np.ascontiguousarray(flat[:, k]), pa.int64()) for k in range(3)]
    ends = np.cumsum([0, *map(len, runs)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))


def runs_of(docs: DataFrame) -> DataFrame:
    """(doc_id, runs, collapsed): the runs of each text by start, then period, and its words
    without the repeats, joined by one space. No shuffle."""
    prepare_workers(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _slabs(batch):
                runs = find_runs(texts)
                left = [b" ".join(kept(w, r)).decode() for w, r in zip(texts, runs, strict=True)]
                yield pa.RecordBatch.from_arrays([ids, _run_lists(runs), pa.array(left, pa.string())], ["doc_id", "runs", "collapsed"])

    text = F.coalesce("text", F.lit("")).cast("binary")
    chosen = docs.select(F.col("doc_id").cast("bigint"), text.alias("text"), F.length(text).cast("bigint").alias("size"))
    return chosen.mapInArrow(scan, f"doc_id bigint, runs {RUNS}, collapsed string")
