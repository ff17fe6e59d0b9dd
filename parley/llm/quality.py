"""Quality scores from random Fourier features of document statistics.

Each text becomes a short vector of statistics (make-up of its characters, words and lines).
Random Fourier features approximate a Gaussian kernel over the standardized statistics, and
ridge regression on the labels is solved from normal equations which every partition sums for
itself. Isotonic regression on labelled rows which the ridge has not seen turns the ridge
score into a probability.

Nulls and edges: a null text is an empty one, whose statistics are zeros and which is scored
like any other; rows without a label or id train nothing, a label that occurs several times
counts several times; without both labels every score is the share of label 1 (0.5 without
labels); equal texts get equal scores; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import prepare_workers, stored

#: Features, width of the kernel in standard deviations, ridge penalty per row.
FEATURES, WIDTH, PENALTY, SEED = 256, 4.0, 1e-4, 7
#: Sums of partitions meet in so many groups; scores are calibrated on so many bins.
GROUPS, BINS = 8, 2000
STATISTICS = (
    "log_chars", "letters", "upper", "digits", "spaces", "points", "other", "beyond_ascii", "evenness",
    "word_length", "distinct_words", "top_word", "repeated_neighbours", "line_length", "distinct_lines",
    "word_ends", "capital_words", "upper_words",
)


def _classes() -> np.ndarray:
    """For each byte one of: letter, upper, digit, space, usual point, other sign, beyond ASCII."""
    kinds = np.full(256, 5)
    for byte in range(256):
        c = chr(byte)
        if byte > 127:
            kinds[byte] = 6
        elif c.islower():
            kinds[byte] = 0
        elif c.isupper():
            kinds[byte] = 1
        elif c.isdigit():
            kinds[byte] = 2
        elif c.isspace():
            kinds[byte] = 3
        elif c in ".,;:?'\"()-":
            kinds[byte] = 4
    return kinds


_CLASSES = _classes()


def statistics_of(text: str) -> list[float]:
    """The statistics of one whole text, in the order of ``STATISTICS``; zeros for no text."""
    if not text:
        return [0.0] * len(STATISTICS)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.bincount(data, minlength=256)
    kinds = np.bincount(_CLASSES, counts, 7) / len(data)
    used = counts[counts > 0] / len(data)
    evenness = float(-(used * np.log2(used)).sum()) / 8
    words = text.split()
    n = len(words)
    if n:
        tally: dict[str, int] = {}
        get = tally.get
        for word in words:
            tally[word] = get(word, 0) + 1
        repeated = sum(map(str.__eq__, words, words[1:])) / n
        ends = "".join([w[-1] for w in words])
        ended = sum(map(ends.count, ".,;:?")) / n
        starts = "".join([w[0] for w in words])
        capital = sum(map(str.isupper, starts)) / n
        upper = sum(map(str.isupper, words)) / n
        shares = [math.log1p(len(text) / n), len(tally) / n, max(tally.values()) / n, repeated]
    else:
        shares, ended, capital, upper = [math.log1p(len(text)), 0.0, 0.0, 0.0], 0.0, 0.0, 0.0
    lines = text.split("\n")
    return [
        math.log1p(len(text)), kinds[0] + kinds[1], kinds[1], kinds[2], kinds[3], kinds[4], kinds[5], kinds[6], evenness,
        *shares, math.log1p(len(text) / len(lines)), len(set(lines)) / len(lines), ended, capital, upper,
    ]


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of the whole text, an array."""
    prepare_workers(docs.sparkSession)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [statistics_of(t.as_py()) for t in batch.column(1)]
            flat = pa.array(values, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), flat], ["doc_id", "statistics"])

    chosen = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    return chosen.mapInArrow(measure, "doc_id bigint, statistics array<double>")


@dataclass
class Model:
    """Standardization, features, ridge weights, and the steps of the calibration."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray | None = None
    places: np.ndarray | None = None
    chances: np.ndarray | None = None

    def features(self, values: np.ndarray) -> np.ndarray:
        turned = (values - self.mean) / self.scale @ self.directions + self.phases
        return np.column_stack([np.cos(turned) * math.sqrt(2 / len(self.phases)), np.ones(len(values))])

    def raw(self, values: np.ndarray) -> np.ndarray:
        return self.features(values) @ self.weights

    def score(self, values: np.ndarray) -> np.ndarray:
        # rounded, as the last digits of a product depend on the rows around it
        return np.clip(np.interp(np.round(self.raw(values), 10), self.places, self.chances), 0, 1)


def _values(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.empty((0, len(STATISTICS)))


def normal_equations(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, int]:
    """Z'Z, Z'y and the rows over (statistics, label): one sum per partition, then per group."""
    size = len(model.phases) + 1
    shape = (size, size + 2)

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(shape)
        for frame in frames:
            z = model.features(_values(frame["statistics"]))
            total[:, :size] += z.T @ z
            total[:, size] += z.T @ frame["label"].to_numpy(float)
            total[0, size + 1] += len(frame)
        yield pd.DataFrame({"group": [TaskContext.get().partitionId() % GROUPS], "sums": [total.tobytes()]})

    def together(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(shape)
        for frame in frames:
            for part in frame["sums"]:
                total += np.frombuffer(part).reshape(shape)
        yield pd.DataFrame({"group": [key[0]], "sums": [total.tobytes()]})

    parts = rows.mapInPandas(sums, "group int, sums binary").groupBy("group").applyInPandas(together, "group int, sums binary")
    total = sum((np.frombuffer(r["sums"]).reshape(shape) for r in parts.collect()), np.zeros(shape))
    return total[:, :size], total[:, size], int(total[0, size + 1])


def isotonic(bins: list[tuple[float, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(score, chance) points by pooling neighbours that fall; bins are (score, rows, ones).

    A pooled block stands at its mean score, smoothed by half a row of each label.
    """
    blocks: list[list[float]] = []
    for place, rows, ones in sorted(bins):
        blocks.append([place * rows, rows, ones])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    points = np.array([b[0] / b[1] for b in blocks])
    chances = np.array([(b[2] + 0.5) / (b[1] + 1) for b in blocks])
    return points, np.maximum.accumulate(chances)


def train(rows: DataFrame, calibrate: Column) -> Model | float:
    """A model from stored (statistics, label, ...); rows of ``calibrate`` only calibrate.

    A number instead of a model is the share of label 1, where one label is missing.
    """
    k = len(STATISTICS)
    measures = [F.avg(F.col("statistics")[i]).alias(f"m{i}") for i in range(k)] + [F.stddev_pop(F.col("statistics")[i]).alias(f"s{i}") for i in range(k)]
    fit, held = rows.where(~calibrate), rows.where(calibrate)
    found = fit.agg(*measures, F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones")).first()
    if not found["n"] or found["ones"] in (0, found["n"]):
        share = rows.agg(F.avg("label")).first()[0]
        return 0.5 if share is None else float(share)
    mean = np.array([found[f"m{i}"] for i in range(k)])
    scale = np.array([found[f"s{i}"] for i in range(k)])
    random = np.random.default_rng(SEED)
    directions = random.normal(size=(k, FEATURES)) / WIDTH
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), directions, random.uniform(0, 2 * math.pi, FEATURES))
    squares, products, n = normal_equations(fit, model)
    model.weights = np.linalg.solve(squares + PENALTY * n * np.eye(len(squares)), products)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            raw = model.raw(_values(frame["statistics"]))
            yield pd.DataFrame({"bin": np.clip(np.floor(raw * BINS / 4), -BINS, BINS).astype("int64"), "raw": raw, "label": frame["label"].astype("int64")})

    binned = held.select("statistics", "label").mapInPandas(place, "bin long, raw double, label long")
    bins = binned.groupBy("bin").agg(F.avg("raw").alias("raw"), F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones")).collect()
    if not bins:
        model.places, model.chances = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    else:
        model.places, model.chances = isotonic([(r["raw"], r["n"], r["ones"]) for r in bins])
    return model


def score(docs: DataFrame, labels: DataFrame, learn: Column, calibrate: Column, threshold: float = 0.7) -> DataFrame:
    """doc_id, score and predicted for every row of ``docs``.

    ``learn`` and ``calibrate`` are conditions on ``doc_id``: labelled rows to use at all, and
    those of them kept from the ridge for calibration. The texts are measured once.
    """
    measured = stored(statistics(docs))
    labelled = labels.where(F.col("quality").isNotNull()).select(F.col("doc_id").cast("bigint"), F.col("quality").cast("double").alias("label"))
    rows = stored(measured.join(labelled, "doc_id").where(learn))
    model = train(rows, calibrate)

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = _values(frame["statistics"])
            scores = np.full(len(values), model) if isinstance(model, float) else model.score(values)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "score": scores, "predicted": (scores >= threshold).astype("int32")})

    return measured.mapInPandas(judge, "doc_id bigint, score double, predicted int")
