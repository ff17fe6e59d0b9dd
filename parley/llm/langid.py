"""Language identification by interpolated Kneser-Ney character models.

One model per language over the letters of single words, padded at both ends. Counts come from
all training rows: each task counts its words, turns them into n-grams, and sends one row per
language and n-gram, so what is shuffled follows the alphabet and not the text. The models
of all n-grams are made by aggregates and joins and lie in the shared folder; a worker reads
them as sorted arrays of hashes. A text goes to the language
of the lowest cross-entropy per symbol.

Rejection is calibrated on the training rows: a text is rejected if its cross-entropy lies
further above the mean of its language than ``deviations`` standard deviations, for its length,
and also above what texts of that language have under the next best model, so it looks as
foreign to its best language as other languages do. A text that mixes known languages stays.

Nulls and edges: a null text, or one without a letter, is ``und`` with score 0 and is rejected;
rows without a language, id or text train nothing; equal cross-entropies go to the smaller
name; without training rows all texts are ``und``; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.dataset
import pyarrow.fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import prepare_workers, shared_folder, stored

ORDER = 4
#: Words counted or remembered in a task before they are summed up or dropped.
MOST_WORDS = 300_000
#: New pieces, and texts, that are scored together: hashes of all their letters are held several times over.
TOGETHER, TEXTS = 20_000, 250
DEVIATIONS = 8.0
UNDETERMINED = "und"
#: Marks of the start and the end of a word; no letter has these code points.
_START, _END = "\x02", "\x03"
_FACTOR = 0x9E3779B97F4A7C15
_RUN = re.compile(r"[^\W\d_]+")


def letter_words(piece: str) -> list[str]:
    """The runs of letters of a text without white space."""
    if piece.isalpha():
        return [piece]
    runs = _RUN.findall(piece)
    return runs if all(map(str.isalpha, runs)) else ["".join(filter(str.isalpha, r)) for r in runs if any(map(str.isalpha, r))]


def _hashes(points: np.ndarray, order: int) -> list[np.ndarray]:
    """Hashes of the n-grams of orders 1 to ``order`` which end at each position."""
    out, total = [], np.zeros(len(points), np.uint64)
    power = 1
    for back in range(order):
        shifted = np.zeros(len(points), np.uint64)
        shifted[back:] = points[: len(points) - back] if back else points
        total = total + (shifted + np.uint64(1)) * np.uint64(power)
        power = power * _FACTOR % (1 << 64)
        out.append(total)
    return out


def _points(words: list[str]) -> np.ndarray:
    joined = "".join([_START * (ORDER - 1) + w + _END for w in words])
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")


def count_grams(words: Counter) -> tuple[list[str], np.ndarray]:
    """The n-grams of the highest order in weighted words."""
    names = list(words)
    points = _points(names)
    ends = np.flatnonzero(points != ord(_START))
    weights = np.repeat(np.fromiter(words.values(), np.int64, len(words)), [len(w) + 1 for w in names])
    codes = _hashes(points.astype(np.uint64), ORDER)[-1][ends]
    _, first, which = np.unique(codes, return_index=True, return_inverse=True)
    counts = np.bincount(which, weights).astype(np.int64)
    grams = [points[e - ORDER + 1 : e + 1].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass") for e in ends[first]]
    return grams, counts


def gram_counts(train: DataFrame) -> DataFrame:
    """(lang, gram, n) over all training rows (lang, text)."""
    prepare_workers(train.sparkSession)
    schema = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[str, Counter] = {}

        def flush(lang: str) -> pa.RecordBatch:
            words: Counter = Counter()
            for piece, n in pieces.pop(lang).items():
                for word in letter_words(piece):
                    words[word] += n
            grams, counts = count_grams(words) if words else ([], np.empty(0, np.int64))
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.string()), pa.array(counts, pa.int64())], schema=schema)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held = pieces.setdefault(lang, Counter())
                held.update(text.as_py().lower().split())
                if len(held) > MOST_WORDS // max(1, len(pieces)):
                    yield flush(lang)
        for lang in list(pieces):
            yield flush(lang)

    counted = train.select("lang", "text").mapInArrow(count, "lang string, gram string, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Table:
    """Sorted hashes; the values of each are those from its start on, with the place of a language."""

    codes: np.ndarray
    starts: np.ndarray
    places: np.ndarray
    values: np.ndarray

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of ``keys``, place, value) of everything under the keys."""
        at = np.searchsorted(self.codes, keys)
        rows = np.flatnonzero(np.append(self.codes, np.uint64(0))[at] == keys)
        rows = rows[at[rows] < len(self.codes)]
        first, many = self.starts[at[rows]], np.diff(self.starts)[at[rows]]
        index = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
        return np.repeat(rows, many), self.places[index], self.values[index]


#: Tables of the folder that this process read last.
_LOADED: dict[str, dict[int, Table]] = {}


def _load(folder: str) -> dict[int, Table]:
    """The tables in the shared folder by kind; a process reads them once."""
    if folder not in _LOADED:
        local = re.sub("^file:/+", "/", folder)
        source, path = (None, local) if local.startswith("/") else pa.fs.FileSystem.from_uri(local)
        read = pa.dataset.dataset(path, filesystem=source, format="parquet").to_table()
        kinds, codes, places, values = (read.column(i).to_numpy() for i in range(4))
        del read
        tables = {}
        for kind in range(2 * ORDER):
            chosen = np.flatnonzero(kinds == kind)
            chosen = chosen[np.argsort(codes[chosen].view(np.uint64), kind="stable")]
            unique, starts = np.unique(codes[chosen].view(np.uint64), return_index=True)
            tables[kind] = Table(unique, np.append(starts, len(chosen)), places[chosen], values[chosen])
        _LOADED.clear()
        _LOADED[folder] = tables
    return _LOADED[folder]


@dataclass
class Models:
    """The languages, the distinct symbols of all, and the folder with the tables.

    Of order ``o``, table ``2 o - 2`` has the chances of n-grams, ``2 o - 1`` the weights of contexts.
    """

    languages: list[str]
    symbols: int
    folder: str

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Negative log2 likelihood of each word by language, and its symbols at the end."""
        points = _points(words)
        ends = np.flatnonzero(points != ord(_START))
        hashes = _hashes(points.astype(np.uint64), ORDER)
        unique, which = np.unique(hashes[ORDER - 1][ends], return_inverse=True)
        sample = np.empty(len(unique), np.int64)
        sample[which] = ends
        logs = -np.log2(self._chances(sample, hashes))
        sizes = np.array([len(w) + 1 for w in words])
        starts = np.cumsum(sizes) - sizes
        return np.column_stack([np.add.reduceat(logs[which], starts, axis=0), sizes])

    def _chances(self, ends: np.ndarray, hashes: list[np.ndarray]) -> np.ndarray:
        """Known n-grams hold their interpolated chance; others take the shorter one's share."""
        tables = _load(self.folder)
        out = np.full((len(ends), len(self.languages)), 1e-6)
        out[tables[0].find(hashes[0][ends])[0]] = 1 / (self.symbols + 1)
        for order in range(1, ORDER + 1):
            contexts = hashes[order - 2][ends - 1] if order > 1 else np.zeros(len(ends), np.uint64)
            rows, places, weights = tables[2 * order - 1].find(contexts)
            out[rows, places] *= weights
            rows, places, chances = tables[2 * order - 2].find(hashes[order - 1][ends])
            out[rows, places] = chances
        return out


def kneser_ney(counts: DataFrame) -> Models:
    """Models from (lang, gram, n), all of them, by aggregates and joins.

    Shorter n-grams count the letters seen before them. Each order is discounted by
    n1 / (n1 + 2 n2) and interpolated with the next shorter one, the last one with an even
    share for each symbol of any language.
    """
    tables = [counts]
    for _ in range(ORDER - 1):
        shorter = tables[0].groupBy("lang", F.expr("substring(gram, 2)").alias("gram"))
        tables.insert(0, stored(shorter.agg(F.count(F.lit(1)).alias("n"))))
    languages = sorted(r["lang"] for r in tables[0].select("lang").distinct().collect())
    symbols = tables[0].select("gram").distinct().count()
    if not languages:
        return Models([], 0, "")
    parts = []
    chances = None
    for order, table in enumerate(tables, 1):
        once, twice = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
        # without such counts the usual 0.75
        discount = F.when(once > 0, once / (once + 2 * twice)).otherwise(0.75).alias("discount")
        table = table.withColumn("context", F.substring("gram", 1, order - 1))
        totals = table.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("many"))
        totals = totals.join(table.groupBy("lang").agg(discount), "lang")
        weight = F.least(F.col("discount") * F.col("many") / F.col("total"), F.lit(1.0)).alias("weight")
        weights = stored(totals.select("lang", "context", "total", "discount", weight))
        both = table.join(weights, ["lang", "context"])
        if chances is None:
            both = both.withColumn("below", F.lit(1 / (symbols + 1)))
        else:
            below = chances.select("lang", F.col("gram").alias("shorter"), F.col("chance").alias("below"))
            both = both.withColumn("shorter", F.expr("substring(gram, 2)")).join(below, ["lang", "shorter"])
        own = F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.col("total")
        chances = stored(both.select("lang", "gram", (own + F.col("weight") * F.col("below")).alias("chance")))
        parts.append(chances.select(F.lit(2 * order - 2).alias("kind"), "lang", "gram", F.col("chance").alias("value")))
        parts.append(weights.select(F.lit(2 * order - 1).alias("kind"), "lang", F.col("context").alias("gram"), F.col("weight").alias("value")))
    place = {lang: i for i, lang in enumerate(languages)}
    schema = pa.schema([("kind", pa.int32()), ("code", pa.int64()), ("place", pa.int32()), ("value", pa.float64())])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.array([_hash(g) for g in batch.column(2).to_pylist()], np.uint64).view(np.int64)
            places = [place[lang] for lang in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array(codes, pa.int64()), pa.array(places, pa.int32()), batch.column(3)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    folder = shared_folder(counts.sparkSession)
    rows = reduce(DataFrame.union, parts).mapInArrow(coded, "kind int, code bigint, place int, value double")
    rows.write.option("compression", "zstd").parquet(folder)
    return Models(languages, symbols, folder)


def _hash(gram: str) -> int:
    if not gram:
        return 0
    points = np.frombuffer(gram.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    return int(_hashes(points, len(points))[-1][-1])


class _Scorer:
    """Sums of word scores; words are remembered as rows of a matrix."""

    def __init__(self, models: Models):
        self.models = models
        self._forget()

    def _forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.matrix = np.zeros((1 << 12, len(self.models.languages) + 1), np.float32)

    def learn(self, pieces: set[str]) -> None:
        """Score the new pieces, some at a time."""
        if len(self.rows) > MOST_WORDS:
            self._forget()
        new = [p for p in pieces if p not in self.rows]
        for at in range(0, len(new), TOGETHER):
            self._add(new[at : at + TOGETHER])

    def _add(self, new: list[str]) -> None:
        words, owner = [], []
        for i, piece in enumerate(new):
            for word in letter_words(piece):
                words.append(word)
                owner.append(i)
        scores = np.zeros((len(new), self.matrix.shape[1]), np.float32)
        if words:
            np.add.at(scores, owner, self.models.word_scores(words).astype(np.float32))
        first = len(self.rows)
        while first + len(new) > len(self.matrix):
            self.matrix = np.concatenate([self.matrix, np.zeros_like(self.matrix)])
        self.matrix[first : first + len(new)] = scores
        self.rows.update(zip(new, range(first, first + len(new)), strict=True))

    def text(self, pieces: list[str]) -> np.ndarray:
        at = np.fromiter(map(self.rows.__getitem__, pieces), np.int64, len(pieces))
        return self.matrix[at].sum(axis=0, dtype=np.float64)


def entropies(docs: DataFrame, models: Models) -> DataFrame:
    """doc_id, the best language, its cross-entropy and that of the next, and the symbols.

    A text without a letter, or no model, gives nulls and no symbols.
    """
    prepare_workers(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(models)
    keep = [c for c in docs.columns if c != "text"]
    fields = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([f"`{c}` {fields[c]}" for c in keep] + ["best string, entropy double, following double, symbols bigint, share double"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        languages = shared.value.languages
        for batch in (whole.slice(at, TEXTS) for whole in batches for at in range(0, whole.num_rows, TEXTS)):
            texts = [(t or "").lower().split() for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            out: tuple[list, ...] = ([], [], [], [], [])
            if languages:
                scorer.learn(set().union(*texts) if texts else set())
            for pieces in texts:
                row = (None, None, None, 0, None)
                if languages and pieces:
                    *sums, symbols = scorer.text(pieces)
                    if symbols:
                        each = np.array(sums) / symbols
                        order = np.argsort(each, kind="stable")
                        # a posterior whose evidence grows with the root of the length
                        lead = np.exp2(np.minimum(0, (each[order[0]] - each) * np.sqrt(symbols)))
                        following = float(each[order[1]]) if len(order) > 1 else None
                        row = (languages[order[0]], float(each[order[0]]), following, int(symbols), float(1 / lead.sum()))
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            kinds = (pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.float64())
            columns = [batch.column(batch.schema.get_field_index(c)) for c in keep] + [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "best", "entropy", "following", "symbols", "share"])

    return docs.mapInArrow(score, schema)


def learn(train: DataFrame) -> Models:
    """The models of (lang, text) rows; only names of languages reach the driver."""
    return kneser_ney(stored(gram_counts(train.where("lang IS NOT NULL AND text IS NOT NULL"))))


def identify(docs: DataFrame, train: Column, deviations: float = DEVIATIONS) -> DataFrame:
    """doc_id, lang_pred, score, rejected, entropy, symbols for every row of ``docs``.

    ``train`` is a condition on ``doc_id`` for the rows to learn from. ``lang`` serves only to
    learn and to calibrate.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang")
    models = learn(rows.where(train))
    scored = stored(entropies(rows.withColumn("_train", F.coalesce(train, F.lit(False)) & F.col("lang").isNotNull()), models))
    own = scored.where(F.col("_train") & (F.col("best") == F.col("lang")))
    # the variance of a mean falls with the length, down to that between texts
    spread = own.groupBy(F.col("best").alias("_lang")).agg(
        F.avg("entropy").alias("_mean"),
        F.var_pop("entropy").alias("_between"),
        F.avg("symbols").alias("_symbols"),
        (F.avg("following") + F.stddev_pop("following")).alias("_foreign"),
    )
    # as many rows as languages
    limits = F.broadcast(spread)
    deviation = F.sqrt(F.col("_between") * (1 + F.col("_symbols") / F.greatest("symbols", F.lit(1))))
    beyond = F.col("entropy") > F.greatest(F.col("_mean") + deviations * deviation, F.col("_foreign"))
    found = scored.join(limits, F.col("best") == F.col("_lang"), "left")
    return found.select(
        "doc_id",
        F.coalesce("best", F.lit(UNDETERMINED)).alias("lang_pred"),
        F.coalesce("share", F.lit(0.0)).alias("score"),
        (F.col("best").isNull() | F.coalesce(beyond, F.lit(False))).alias("rejected"),
        "entropy",
        "symbols",
    )
