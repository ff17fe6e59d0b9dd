"""Token ids in a chunked file format whose blocks are transposed into planes.

A file is a Parquet data set of segments. A segment holds whole documents in ascending order
of ``doc_id``: their ids, lengths, and the token ids in blocks of a fixed number of ids. Each
block is transposed into byte planes (or bit planes), each plane is compressed with zstandard
by itself, and ``sizes`` is the chunk index: the bytes of every plane of every block in order.
A reader takes any block from the index alone; segments need no other segment.

Nulls and edges: a null text is an empty one and yields the end id alone; a null ``doc_id``
stands before all others; rows with equal ``doc_id`` stay separate documents, in order of
their texts; an empty table gives an empty file. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parley.llm.common import prepare_workers
from parley.llm.tokens import encoder

BLOCK_IDS = 1 << 16
SEGMENT_IDS = 1 << 20
SEGMENT = (
    "part int, segment int, doc_ids array<bigint>, lengths array<bigint>, n_ids bigint,"
    " width int, bits boolean, block_ids int, sizes array<int>, planes binary"
)
_ARROW = pa.schema(
    [
        ("part", pa.int32()), ("segment", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("width", pa.int32()),
        ("bits", pa.bool_()), ("block_ids", pa.int32()), ("sizes", pa.list_(pa.int32())),
        ("planes", pa.binary()),
    ]
)
_DOCUMENT = pa.schema(
    [
        ("part", pa.int32()), ("segment", pa.int32()), ("place", pa.int32()), ("doc_id", pa.int64()),
        ("before", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
    ]
)


def to_planes(ids: np.ndarray, bits: bool) -> np.ndarray:
    """One row per plane. Byte plane k holds byte k of every id; bit planes hold single bits."""
    width = ids.dtype.itemsize
    if not bits:
        return np.ascontiguousarray(ids.view(np.uint8).reshape(-1, width).T)
    return np.packbits(np.unpackbits(ids.view(np.uint8).reshape(-1, width), axis=1, bitorder="little").T, axis=1)


def from_planes(planes: list[bytes], count: int, width: int, bits: bool) -> np.ndarray:
    rows = np.stack([np.frombuffer(p, np.uint8) for p in planes])
    if bits:
        rows = np.packbits(np.unpackbits(rows, axis=1, count=count).T, axis=1, bitorder="little")
        return np.ascontiguousarray(rows).view(f"<u{width}").ravel()
    return np.ascontiguousarray(rows.T).view(f"<u{width}").ravel()


class SegmentWriter:
    """Gathers documents and gives a segment once it is large enough."""

    def __init__(self, part: int, dtype: np.dtype, bits: bool, block_ids: int, segment_ids: int, level: int):
        self.part, self.dtype, self.bits = part, dtype, bits
        self.block_ids, self.segment_ids = block_ids, segment_ids
        self.compress = zstandard.ZstdCompressor(level=level).compress
        self.segment = 0
        self._clear()

    def _clear(self) -> None:
        self.doc_ids, self.lengths, self.ids, self.n_ids = [], [], [], 0

    def add(self, doc_id: int | None, ids: bytes) -> bool:
        """True if the segment is full and must be taken."""
        count = len(ids) // self.dtype.itemsize
        self.doc_ids.append(doc_id)
        self.lengths.append(count)
        self.ids.append(ids)
        self.n_ids += count
        return self.n_ids >= self.segment_ids

    def take(self) -> pa.RecordBatch:
        ids = np.frombuffer(b"".join(self.ids), self.dtype)
        planes = [
            self.compress(plane.tobytes())
            for at in range(0, len(ids), self.block_ids)
            for plane in to_planes(ids[at : at + self.block_ids], self.bits)
        ]
        row = {
            "part": self.part, "segment": self.segment, "doc_ids": self.doc_ids, "lengths": self.lengths,
            "n_ids": self.n_ids, "width": self.dtype.itemsize, "bits": self.bits, "block_ids": self.block_ids,
            "sizes": [len(p) for p in planes], "planes": b"".join(planes),
        }
        self._clear()
        self.segment += 1
        return pa.RecordBatch.from_pylist([row], schema=_ARROW)


def read_blocks(row: dict) -> Iterator[np.ndarray]:
    """The ids of a segment, block by block."""
    decompress = zstandard.ZstdDecompressor().decompress
    width, bits, left = row["width"], row["bits"], row["n_ids"]
    n_planes = width * 8 if bits else width
    ends = np.cumsum([0, *row["sizes"]])
    for first in range(0, len(row["sizes"]), n_planes):
        cuts = ends[first : first + n_planes + 1]
        planes = [decompress(row["planes"][a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        count = min(left, row["block_ids"])
        left -= count
        yield from_planes(planes, count, width, bits)


def segments(
    docs: DataFrame, path: str, end_id: int | None, bits: bool = False,
    block_ids: int = BLOCK_IDS, segment_ids: int = SEGMENT_IDS, level: int = 3,
) -> DataFrame:
    """The encoded documents as segments, in ascending order of ``doc_id`` over the parts.

    One shuffle by ranges of ``doc_id``; a task holds one segment and one batch of texts. A
    segment is full at ``segment_ids`` or more ids, as a document is never divided.
    """
    prepare_workers(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = encoder(path)
        end = b"" if end_id is None else np.array([end_id], texts.dtype).tobytes()
        writer = SegmentWriter(TaskContext.get().partitionId(), texts.dtype, bits, block_ids, segment_ids, level)
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                if writer.add(doc_id.as_py(), texts.ids(text.as_py()) + end):
                    yield writer.take()
        if writer.doc_ids:
            yield writer.take()

    chosen = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = chosen.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(encode, SEGMENT)


def write_ids(docs: DataFrame, folder: str, path: str, end_id: int | None = None, **options) -> None:
    """Encodes all texts and writes the file; ``options`` as in :func:`segments`."""
    frame = segments(docs, path, end_id, **options)
    # the planes are compressed already
    frame.write.option("compression", "uncompressed").parquet(folder)


def _segments_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """The segments of a batch, whose bytes Spark bounds, unpacked one at a time."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in _segments_of(batch):
            wide = b"".join([block.astype("<u4").tobytes() for block in read_blocks(row)])
            ends = np.cumsum([0, *row["lengths"]])
            view = memoryview(wide)
            yield pa.RecordBatch.from_pydict(
                {
                    "part": [row["part"]] * len(row["doc_ids"]), "segment": [row["segment"]] * len(row["doc_ids"]),
                    "place": range(len(row["doc_ids"])), "doc_id": row["doc_ids"], "before": ends[:-1], "n_tokens": row["lengths"],
                    "ids_crc32": [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(ends, ends[1:], strict=False)],
                },
                schema=_DOCUMENT,
            )


def _segment_starts(file: DataFrame) -> DataFrame:
    """(part, segment, first): the ids before each segment; sums by part come first."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = file.groupBy("part").agg(F.sum("n_ids").alias("_ids"))
    parts = parts.select("part", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    own = file.select("part", "segment", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("_first"))
    return own.join(parts, "part").select("part", "segment", (F.col("_start") + F.col("_first")).alias("first"))


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the file alone: its place, number of ids and their checksum.

    ``ids_crc32`` is over the ids as little-endian 32-bit integers. Planes are decoded where
    they are read; only rows of a few numbers are joined with the starts of the segments.
    """
    prepare_workers(spark)
    file = spark.read.schema(SEGMENT).parquet(folder)
    rows = file.mapInArrow(_documents, "part int, segment int, place int, doc_id bigint, before bigint, n_tokens bigint, ids_crc32 bigint")
    starts = _segment_starts(file.select("part", "segment", "n_ids"))
    start: Column = F.col("first") + F.col("before")
    return rows.join(starts, ["part", "segment"]).select("doc_id", start.alias("start"), "n_tokens", "ids_crc32", "part", "segment", "place")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, ids) of every document."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _segments_of(batch):
                ids, ends = np.concatenate([np.empty(0, "<u4"), *read_blocks(row)]).astype("i8"), np.cumsum(row["lengths"])
                values = pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), values], ["doc_id", "ids"])

    prepare_workers(spark)
    return spark.read.schema(SEGMENT).parquet(folder).mapInArrow(decode, "doc_id bigint, ids array<bigint>")
