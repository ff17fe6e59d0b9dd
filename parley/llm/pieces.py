"""SentencePiece BPE by vectorised merge rounds, and its decoder.

A text gets its dummy prefix, spaces become ``▁``, and it is cut before each run of ``▁`` if no
piece holds ``▁`` behind another character. All words of a batch that are not remembered lie in
one flat array of symbols, cut further where no piece holds the two neighbouring characters. A
round finds the best pair of each segment and merges all its places from the left, up to the
first one that makes a neighbouring pair at least as good, as that pair comes first; then the
array is compacted, and segments without a pair leave it. A segment which is not done after
``ROUNDS`` rounds (thousands of spaces, a word of many thousand letters) gets its remaining merges
one by one from a heap. Characters without a piece become byte pieces.

Only BPE models with byte fallback, without user-defined or unused pieces and without a
normalizing table are taken; others raise an error.

Nulls and edges: a null text is an empty one; an empty text has no ids and decodes to an empty
text; words of any length are merged whole; control pieces decode to nothing, unknown ones to
the model's surface, invalid bytes to U+FFFD each; equal rows stay equal rows; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import prepare_workers

#: Rounds before single merges take over.
ROUNDS = 256
#: Words in each of the two generations which a worker remembers, and the longest of them.
MEMO, LONGEST = 300_000, 64
_SPACE = "▁"
#: No rank, and a key behind all others.
_NONE, _END = np.int64(1 << 40), np.int64(1 << 62)


def _one_each(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("parley_one_each", _one_each)


class PieceModel:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as proto

        with open(path, "rb") as file:
            parsed = proto.ModelProto.FromString(file.read())
        library = SentencePieceProcessor(model_file=path)
        everything = range(library.get_piece_size())
        rules = parsed.normalizer_spec
        if parsed.trainer_spec.model_type != proto.TrainerSpec.BPE or not parsed.trainer_spec.byte_fallback:
            raise ValueError("only BPE models with byte fallback are supported")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only models whose normalizer keeps the text are supported")
        kinds = proto.ModelProto.SentencePiece
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in parsed.pieces) or parsed.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models with user-defined or unused pieces, or spaces as suffix, are not supported")
        self.prefix = _SPACE if rules.add_dummy_prefix else ""
        names = [library.id_to_piece(i) for i in everything]
        special = {i for i in everything if library.is_byte(i) or library.is_control(i) or library.is_unknown(i)}
        self.byte_ids = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self._surfaces(names, special, library, parsed.trainer_spec.unk_surface)

        vocabulary = {name: i for i, name in enumerate(names) if i not in special}
        best = sorted({library.get_score(i) for i in vocabulary.values()}, reverse=True)
        order = {score: rank for rank, score in enumerate(best)}
        # characters which occur in pieces only get numbers behind those of the pieces
        alone = sorted({c for name in vocabulary for c in name} - vocabulary.keys())
        symbols = vocabulary | {c: len(names) + k for k, c in enumerate(alone)}
        self.known, self.size = len(names), len(names) + len(alone)
        self.first_symbol = {ord(s): i for s, i in symbols.items() if len(s) == 1}
        self.last_point = max(self.first_symbol, default=0)
        self.by_point = np.full(self.last_point + 2, -1, np.int64)
        for point, symbol in self.first_symbol.items():
            self.by_point[point] = symbol
        pairs = {}
        for name, number in vocabulary.items():
            for cut in range(1, len(name)):
                left, right = symbols.get(name[:cut]), symbols.get(name[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = (order[library.get_score(number)], number)
        self.keys = np.array([*sorted(pairs), _END], np.int64)
        self._scatter()
        self.ranks = np.array([*(pairs[k][0] for k in sorted(pairs)), _NONE], np.int64)
        self.merged = np.array([*(pairs[k][1] for k in sorted(pairs)), -1], np.int64)
        near = {symbols[a] * self.size + symbols[b] for name in vocabulary for a, b in zip(name, name[1:])}
        self.near = np.array([*sorted(near), _END], np.int64)
        inner = any(a != _SPACE and b == _SPACE for name in vocabulary for a, b in zip(name, name[1:]))
        self.words = re.compile("(?s).+" if inner else f"{_SPACE}*[^{_SPACE}]+|{_SPACE}+")
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _surfaces(self, names: list[str], special: set[int], library, unknown: str) -> None:
        surface = [name.replace(_SPACE, " ").encode() for name in names]
        for i in special:
            surface[i] = b"" if library.is_control(i) else unknown.encode()
        for value, i in enumerate(self.byte_ids):
            surface[i] = bytes([value])
        self.surface, self.controls = surface, {i for i in special if not surface[i]}
        self.spaced = {i for i, name in enumerate(names) if i not in special and name.startswith(_SPACE)}

    # -- encoding -----------------------------------------------------------------------------

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        cut = [self.words.findall(self.prefix + t.replace(" ", _SPACE)) if t else [] for t in texts]
        if len(self.memo) > MEMO:
            self.memo, self.older = {}, self.memo
        new = set().union(*cut) - self.memo.keys()
        for word in new & self.older.keys():
            self.memo[word] = self.older[word]
        made = list(new - self.older.keys())
        self.memo.update(zip(made, self._encode_words(made), strict=True))
        found = [np.frombuffer(b"".join(map(self.memo.__getitem__, words)), "<i4") for words in cut]
        for word in made:
            if len(word) > LONGEST:
                del self.memo[word]
        return found

    def _encode_words(self, words: list[str]) -> list[bytes]:
        if not words:
            return []
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        symbols = self.by_point[np.minimum(points, self.last_point + 1)]
        starts = np.cumsum([0, *map(len, words)])
        first = np.zeros(len(points), bool)
        first[starts[:-1]] = True
        apart = np.ones(len(points), bool)
        apart[1:] = first[1:] | (symbols[1:] < 0) | (symbols[:-1] < 0)
        keys = symbols[:-1] * self.size + symbols[1:]
        apart[1:] |= self.near[np.searchsorted(self.near, keys)] != keys
        symbols, places = self._merge(symbols, np.cumsum(apart))
        bounds = np.searchsorted(places, starts)
        odd = np.flatnonzero((symbols < 0) | (symbols >= self.known))
        if len(odd):
            symbols, bounds = self._with_bytes(symbols, odd, points[places[odd]], bounds)
        ids = symbols.astype("<i4").tobytes()
        return [ids[4 * a : 4 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

    def _with_bytes(self, symbols: np.ndarray, odd: np.ndarray, points: np.ndarray, bounds: np.ndarray):
        """Byte pieces instead of the symbols at ``odd``."""
        spelled = [chr(p).encode() for p in points.tolist()]
        sizes = np.ones(len(symbols), np.int64)
        sizes[odd] = [len(s) for s in spelled]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        out = np.repeat(symbols, sizes)
        for at, letters in zip(ends[odd].tolist(), spelled):
            out[at : at + len(letters)] = [self.byte_ids[b] for b in letters]
        return out, ends[bounds]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.width)).astype(np.int64)

    def _scatter(self) -> None:
        """Places of the keys by hash; a taken slot leads to the next one."""
        none = len(self.keys) - 1
        self.width = max(4, (16 * len(self.keys)).bit_length())
        self.slots = np.full((1 << self.width) + len(self.keys), none, np.int32)
        for place, slot in enumerate(self._slot(self.keys[:-1]).tolist()):
            while self.slots[slot] != none:
                slot += 1
            self.slots[slot] = place

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Places of pairs in the table; the last one where there is none."""
        none = len(self.keys) - 1
        keys = np.where((left < 0) | (right < 0), -1, left * self.size + right)
        slot = self._slot(keys)
        at = self.slots[slot]
        other = np.flatnonzero((at != none) & (self.keys[at] != keys))
        while len(other):
            slot[other] += 1
            at[other] = self.slots[slot[other]]
            other = other[(at[other] != none) & (self.keys[at[other]] != keys[other])]
        return at

    def _merge(self, symbols: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols after all merges, and the places where they start."""
        places = np.arange(len(symbols))
        pair = self._neighbours(symbols, segment, np.arange(len(symbols)))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        for turn in range(ROUNDS + 1):
            ranks = self.ranks[pair]
            starts = np.flatnonzero(np.diff(segment, prepend=-1))
            sizes = np.diff(starts, append=len(segment))
            best = np.repeat(np.minimum.reduceat(ranks, starts), sizes)
            active = best < _NONE
            if not active.all():
                done.append((symbols[~active], places[~active]))
                symbols, places, segment, pair, ranks, best = (x[active] for x in (symbols, places, segment, pair, ranks, best))
            if not len(symbols):
                break
            if turn == ROUNDS:
                done.append(self._one_by_one(symbols, places, segment))
                break
            chosen = self._chosen(symbols, segment, pair, ranks, best)
            at = np.flatnonzero(chosen)
            symbols[at] = self.merged[pair[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            moved = np.cumsum(keep)[at] - 1
            symbols, places, segment, pair = symbols[keep], places[keep], segment[keep], pair[keep]
            pair[moved] = self._neighbours(symbols, segment, moved)
            before = moved[moved > 0] - 1
            pair[before] = self._neighbours(symbols, segment, before)
        symbols, places = (np.concatenate(parts) for parts in zip(*done))
        order = np.argsort(places, kind="stable")
        return symbols[order], places[order]

    def _neighbours(self, symbols: np.ndarray, segment: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The pair of each place with the next one of its segment."""
        following = np.minimum(at + 1, len(symbols) - 1)
        joined = (at + 1 < len(symbols)) & (segment[following] == segment[at])
        return self._pairs(symbols[at], np.where(joined, symbols[following], -1))

    def _chosen(self, symbols: np.ndarray, segment: np.ndarray, pair: np.ndarray, ranks: np.ndarray, best: np.ndarray) -> np.ndarray:
        """The places whose pairs are merged in this round."""
        at = np.flatnonzero(ranks == best)
        # of overlapping places every other one, from the left
        runs = np.flatnonzero(np.diff(at, prepend=-2) > 1)
        own = np.repeat(runs, np.diff(runs, append=len(at)))
        at = at[(np.arange(len(at)) - own) % 2 == 0]
        whole = self.merged[pair[at]]
        after = np.full(len(symbols) + 2, -1, np.int64)
        after[:-2] = symbols
        seg = np.full(len(symbols) + 2, -1, np.int64)
        seg[:-2] = segment
        right = np.where(seg[at + 2] == segment[at], after[at + 2], -1)
        left = np.where((at > 0) & (segment[at - 1] == segment[at]), symbols[at - 1], -1)
        beside = np.flatnonzero((np.diff(at, prepend=-3) == 2) & (left >= 0))
        left[beside] = whole[beside - 1]
        better = (self.ranks[self._pairs(left, whole)] <= best[at]) | (self.ranks[self._pairs(whole, right)] <= best[at])
        chosen = np.zeros(len(symbols), bool)
        if better.any():
            # nothing behind the first such place of a segment
            heads = np.flatnonzero(np.diff(segment[at], prepend=-1))
            last = np.minimum.reduceat(np.where(better, at, len(symbols)), heads)
            at = at[at <= np.repeat(last, np.diff(heads, append=len(at)))]
        chosen[at] = True
        return chosen

    def _one_by_one(self, symbols: np.ndarray, places: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All remaining merges in their order, from a heap."""
        table = {k: (r, m) for k, r, m in zip(self.keys[:-1].tolist(), self.ranks[:-1].tolist(), self.merged[:-1].tolist())}
        value, group, size = symbols.tolist(), segment.tolist(), len(symbols)
        following, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap: list[tuple[int, int, int, int, int, int]] = []

        def offer(left: int, right: int) -> None:
            if 0 <= left and right < size and group[left] == group[right] and value[left] >= 0 and value[right] >= 0:
                found = table.get(value[left] * self.size + value[right])
                if found:
                    heap.append((found[0], left, right, value[left], value[right], found[1]))

        for i in range(size - 1):
            offer(i, i + 1)
        heapq.heapify(heap)
        gone = np.zeros(size, bool)
        while heap:
            _, left, right, a, b, whole = heapq.heappop(heap)
            if gone[left] or gone[right] or value[left] != a or value[right] != b or following[left] != right:
                continue
            value[left], gone[right] = whole, True
            following[left] = following[right]
            if following[left] < size:
                before[following[left]] = left
            for x, y in ((before[left], left), (left, following[left])):
                count = len(heap)
                offer(x, y)
                if len(heap) > count:
                    heapq._siftdown(heap, 0, len(heap) - 1)
        return np.array(value, np.int64)[~gone], places[~gone]

    # -- decoding -----------------------------------------------------------------------------

    def decode(self, ids: np.ndarray) -> str:
        values = ids.tolist()
        pieces = list(map(self.surface.__getitem__, values))
        if self.prefix:
            # the space before the first text
            first = next((k for k, p in enumerate(pieces) if p), None)
            if first is not None and values[first] in self.spaced:
                pieces[first] = pieces[first][1:]
        # an empty piece ends a run of bytes
        gaps = [k for k, p in enumerate(pieces) if not p] if self.controls.intersection(values) else []
        parts = [b"".join(pieces[a:b]) for a, b in zip([0, *gaps], [*gaps, len(pieces)])]
        return "".join([p.decode("utf-8", "parley_one_each") for p in parts])


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    """One model for each file and Python worker."""
    return PieceModel(path)


_IDS = pa.list_(pa.int32())


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    values = np.concatenate(rows) if rows else np.empty(0, "<i4")
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32()))


def _slices(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts of rows, about ``most`` bytes at a time."""
    for batch in batches:
        sizes = np.asarray(batch.column(2))
        part = np.cumsum(sizes) // most
        for start, stop in zip(*(lambda s: (s, [*s[1:], len(sizes)]))(np.flatnonzero(np.diff(part, prepend=-1)).tolist())):
            yield batch.column(0)[start:stop], batch.column(1)[start:stop].to_pylist()


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint"), text.alias("text"), F.octet_length(text).cast("bigint").alias("size"))


def encode(docs: DataFrame, path: str, decoded: bool = False) -> DataFrame:
    """(doc_id, ids) of every document, with the text that the ids decode to if asked for.

    No shuffle; a worker holds about a megabyte of texts at a time, or one longer text.
    """
    prepare_workers(docs.sparkSession)

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for doc_ids, texts in _slices(batches):
            found = model.encode(texts)
            columns = {"doc_id": doc_ids, "ids": _lists(found)}
            if decoded:
                columns["decoded"] = pa.array([model.decode(f) for f in found], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return _texts(docs).mapInArrow(ids, "doc_id bigint, ids array<int>" + (", decoded string" if decoded else ""))


def decode(rows: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); no ids, null ones among them, give no text."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            out = [model.decode(np.array([i for i in v or [] if i is not None], np.int64)) for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc_id", "text"])

    prepare_workers(rows.sparkSession)
    return rows.select(F.col("doc_id").cast("bigint"), F.col("ids").cast("array<int>")).mapInArrow(texts, "doc_id bigint, text string")
