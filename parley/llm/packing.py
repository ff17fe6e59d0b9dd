"""Best-two-fit packing of documents into sequences of a fixed number of tokens.

A bin is filled greedily with the longest piece that fits, again and again; then its shortest
piece is replaced by two unpacked pieces which fit the expanded gap more tightly. Lengths are
whole numbers up to the capacity, so the packing is planned on the number of pieces of each
length: a table of at most ``capacity`` rows, whatever the input. A filling is repeated while
its lengths last, which makes the plan a short list of fillings with multiplicities. Each
piece then finds its place by its number among the pieces of its length.

Nulls and edges: a null text is an empty one, which is the end id alone; longer documents are
cut into full pieces and a rest; equal rows are separate documents; an empty table gives no
rows. A null ``doc_id`` is kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import numbered, prepare_workers, stored
from parley.llm.tokens import encoder

PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
BUCKETS = 1024
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
)


def cut_pieces(docs: DataFrame, path: str, end_id: int, capacity: int) -> DataFrame:
    """The pieces of all documents; a piece is shorter than the capacity only at the end."""
    prepare_workers(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = encoder(path)
        end = np.array([end_id], texts.dtype).tobytes()
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.frombuffer(texts.ids(text.as_py()) + end, texts.dtype).astype("<u4")
                for piece, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    for column, value in zip(rows, (doc_id.as_py(), piece, at, len(part), zlib.crc32(part.tobytes())), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, _ARROW, strict=True)], schema=_ARROW)

    chosen = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    return chosen.mapInArrow(cut, PIECE)


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """[(bins, [(length, pieces of it in each bin), ...]), ...] by best-two-fit."""
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    lengths = np.arange(capacity + 1)
    plan = []
    largest = np.maximum.accumulate(np.where(left > 0, lengths, 0))
    while largest[capacity]:
        filling: dict[int, int] = {}
        gap = capacity

        def available(length: int) -> int:
            return int(left[length]) - filling.get(length, 0)  # noqa: B023

        # greedily the longest that fits
        length = int(largest[gap])
        while length:
            if many := min(available(length), gap // length):
                filling[length] = filling.get(length, 0) + many
                gap -= many * length
            length = int(largest[min(gap, length - 1)])
        # then two for the smallest one
        if gap:
            small = min(filling)
            room = gap + small
            free = left.copy()
            for used, many in filling.items():
                free[used] -= many
            best = np.maximum.accumulate(np.where(free > 0, lengths, 0))
            first = np.flatnonzero(free[: room + 1] > 0)
            first = first[first > 0]
            if len(first):
                second = best[room - first]
                # the same length twice needs two pieces
                once = (second == first) & (free[first] < 2)
                second = np.where(once, best[np.minimum(room - first, np.maximum(first - 1, 0))], second)
                total = np.where(second > 0, first + second, 0)
                at = int(total.argmax())
                if total[at] > small:
                    filling[small] -= 1
                    for new in (int(first[at]), int(second[at])):
                        filling[new] = filling.get(new, 0) + 1
                    filling = {k: v for k, v in filling.items() if v}
        bins = min(int(left[k]) // v for k, v in filling.items())
        for k, v in filling.items():
            left[k] -= bins * v
        plan.append((bins, sorted(filling.items(), reverse=True)))
        largest = np.maximum.accumulate(np.where(left > 0, lengths, 0))
    return plan


def _slots(plan: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows (length, first number, first sequence, offset, pieces in a bin), sorted."""
    rows, taken, sequence = [], {}, 0
    for bins, filling in plan:
        offset = 0
        for length, many in filling:
            rows.append((length, taken.get(length, 0), sequence, offset, many))
            taken[length] = taken.get(length, 0) + bins * many
            offset += length * many
        sequence += bins
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, path: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """One row per piece: document, ids, and its place in a sequence.

    Texts are encoded once and only the pieces' numbers are stored and shuffled. The plan has
    at most one row per length and filling and goes to the tasks.
    """
    pieces = cut_pieces(docs, path, end_id, capacity)
    bucket = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(BUCKETS)).cast("int")
    pieces = stored(pieces.withColumn("_bucket", bucket))
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    slots = _slots(plan_bins(counts, capacity))
    # length and number in one sorted key; a length has fewer than 2 ** 50 pieces
    keys = (slots[:, 0] << 50) | slots[:, 1]

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            number, length = frame["_number"].to_numpy(), frame["length"].to_numpy()
            _, first, sequence, offset, many = slots[np.searchsorted(keys, (length << 50) | number, "right") - 1].T
            frame["sequence_id"] = sequence + (number - first) // many
            frame["offset"] = offset + (number - first) % many * length
            yield frame.drop(columns="_number")

    order = [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")]
    ranked = numbered(pieces, ["length"], "_bucket", order, "_number").drop("_bucket")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "_number"]
    return ranked.select(*columns).mapInPandas(place, f"{PIECE}, sequence_id bigint, offset bigint")
