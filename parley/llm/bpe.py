"""BPE as a streaming transducer with a bounded lookahead, and its decoder.

A merge may be undone by symbols further to the right only through a chain of merges of ever
smaller rank, each of which takes the last part of the right half of the merge after it. The
longest chain of a merge list, in symbols, is its sufficient lookahead: a token is final once
that many symbols follow it. Long words are therefore encoded in a window of constant size,
and final tokens leave the window before more symbols enter. Short words are remembered.

The file decides everything else: its normalizer and splitting pattern (composition, one
space, lower case, a pattern whose matches are the words), byte letters, a suffix at the end
of a word, and added tokens, which are found in the raw text first.

Nulls and edges: a null text is an empty one; an empty text has no ids and decodes to an empty
text; a word without a gap of any length takes one window; equal rows stay equal rows; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import Memo, prepare_workers
from parley.llm.tokens import byte_letters, spell

#: Characters of a text that are encoded at once, up to the next gap.
SLICE = 1 << 16
_NONE = 1 << 60
#: A lower-case Latin word with a run of points: two words of any of the patterns.
_PLAIN = re.compile("([a-zß-öø-ÿ]+)([.,;:!?*&%$#|]*)")
DIGEST = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


class MergeTable:
    """Ranks of the merges, and the lookahead that follows from them."""

    def __init__(self, merges: list[tuple[str, str]], vocabulary: dict[str, int], suffix: str):
        self.vocabulary, self.suffix = vocabulary, suffix
        # one number for a pair, one for rank and result: plain integers are quick to compare
        self.ranks = {
            vocabulary[a] << 32 | vocabulary[b]: rank << 32 | vocabulary[a + b] for rank, (a, b) in enumerate(merges)
        }
        self.lookahead = sufficient_lookahead(merges, suffix)
        self.window = 2 * self.lookahead + 256

    def merge(self, symbols: list[int]) -> list[int]:
        """Merges the pair of the smallest rank, the leftmost first, until none is left."""
        get, tokens = self.ranks.get, list(symbols)
        pairs = [get(a << 32 | b, _NONE) for a, b in zip(tokens, tokens[1:], strict=False)]
        while pairs and (best := min(pairs)) != _NONE:
            at = pairs.index(best)
            tokens[at] = new = best & 0xFFFFFFFF
            del tokens[at + 1], pairs[at]
            if at:
                pairs[at - 1] = get(tokens[at - 1] << 32 | new, _NONE)
            if at < len(pairs):
                pairs[at] = get(new << 32 | tokens[at + 1], _NONE)
        return tokens


def sufficient_lookahead(merges: list[tuple[str, str]], suffix: str = "") -> int:
    """Symbols that must follow a token before nothing further can change it.

    ``reach`` of a merge: how far right of its inner boundary a symbol may lie which decides
    about it. The right half ends where an earlier merge may take its last part away, and
    that merge has a reach of its own. Ranks fall along the chain, so one pass in the order of
    the ranks finds the longest.
    """

    def width(token: str) -> int:
        return len(token.removesuffix(suffix) if suffix else token)

    # per token: its last parts, with the rank of the merge that binds each
    last_parts: dict[str, dict[str, int]] = {}
    # per left half: ranks in ascending order, and the largest reach up to each
    takers: dict[str, tuple[list[int], list[int]]] = {}
    longest = 0
    for rank, (left, right) in enumerate(merges):
        bound = {right: rank}
        for part, limit in last_parts.get(right, {}).items():
            bound[part] = max(limit, bound.get(part, 0))
        further = 0
        for part, limit in bound.items():
            if part in takers:
                ranks, reaches = takers[part]
                if earlier := bisect_left(ranks, limit):
                    further = max(further, reaches[earlier - 1])
        reach = width(right) + further
        ranks, reaches = takers.setdefault(left, ([], []))
        ranks.append(rank)
        reaches.append(max(reach, reaches[-1] if reaches else 0))
        parts = last_parts.setdefault(left + right, {})
        for part, limit in bound.items():
            parts[part] = max(limit, parts.get(part, 0))
        longest = max(longest, width(left) + reach)
    return longest


class Transducer:
    """Text to ids, slice by slice."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        model = parts["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.table = MergeTable(merges, model["vocab"], self.suffix)
        self.widths = {i: len(t.removesuffix(self.suffix) if self.suffix else t) for t, i in model["vocab"].items()}
        self.added = {t["content"]: t["id"] for t in parts["added_tokens"]}
        self.find_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        steps = [s["type"] for s in parts["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"unknown normalizer {steps}")
        pattern = parts["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.letters = byte_letters()
        self.pieces = Memo(self._piece)
        self.points = Memo(self._word)
        names = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.added.items()}
        self.names, self.byte_level = names, (parts["decoder"] or {}).get("type") == "ByteLevel"

    def word_ids(self, letters: Iterable[str]) -> Iterator[int]:
        """The ids of one word from its letters, which are read as the window has room."""
        table, vocabulary = self.table, self.table.vocabulary
        buffer: list[int] = []
        held = ""  # the last letter carries the suffix, so one letter is held back
        for letter in letters:
            if held and (symbol := vocabulary.get(held)) is not None:
                buffer.append(symbol)
            held = letter
            if len(buffer) >= table.window:
                final, used = [], 0
                for token in table.merge(buffer):
                    if used + self.widths[token] + table.lookahead > len(buffer):
                        break
                    used += self.widths[token]
                    final.append(token)
                yield from final
                del buffer[:used]
        if held and (symbol := vocabulary.get(held + self.suffix)) is not None:
            buffer.append(symbol)
        yield from table.merge(buffer)

    def _word(self, word: str) -> bytes:
        if len(word) < self.table.window // 4:
            letters = spell(word)
            vocabulary = self.table.vocabulary
            symbols = [vocabulary.get(c) for c in letters[:-1]] + [vocabulary.get(letters[-1] + self.suffix)]
            return array("I", self.table.merge([s for s in symbols if s is not None])).tobytes()
        return array("I", self.word_ids(self.letters[b] for c in word for b in c.encode())).tobytes()

    def _piece(self, piece: str) -> bytes:
        """The ids of text between two gaps."""
        if plain := _PLAIN.fullmatch(piece):
            ids = self._word(plain[1])
            return ids + self.points[plain[2]] if plain[2] else ids
        composed = unicodedata.normalize("NFC", piece)
        lowered = "".join([c.lower() for c in composed])
        return b"".join([self.points[m[0]] for m in self.words.finditer(lowered)])

    def encode(self, text: str) -> Iterator[bytes]:
        """Ids as little-endian 32-bit integers, for a slice of the text at a time."""
        parts = self.find_added.split(text) if self.added else [text]
        for part in parts:
            if part in self.added:
                yield array("I", [self.added[part]]).tobytes()
                continue
            for piece in slices(part):
                try:
                    piece.encode("latin-1")
                except UnicodeEncodeError:
                    pass
                else:
                    piece = piece.lower()
                yield b"".join(map(self.pieces.__getitem__, piece.replace("\n", " ").split(" ")))


def slices(text: str) -> Iterator[str]:
    """Parts of the text which end at a space or line feed, so no piece is cut."""
    at = 0
    while len(text) - at > SLICE:
        gap = re.compile("[ \n]").search(text, at + SLICE)
        if not gap:
            break
        yield text[at : gap.start()]
        at = gap.end()
    yield text[at:]


class Decoder:
    """Ids to text, as they come.

    With a byte-level decoder the state holds the bytes of an unfinished character. Without
    one the tokens are written with a space between them, and the state is whether one was.
    """

    def __init__(self, transducer: Transducer):
        self.byte_level = transducer.byte_level
        if self.byte_level:
            value = {letter: byte for byte, letter in enumerate(byte_letters())}
            added = set(transducer.added)
            spelled = {
                i: t.encode() if t in added else bytes([value[c] for c in t]) for i, t in transducer.names.items()
            }
            self.state = codecs.getincrementaldecoder("utf-8")("replace")
        else:
            spelled = {i: t.encode() for i, t in transducer.names.items()}
            self.started = False
        self.spelled = spelled

    def restart(self) -> Decoder:
        if self.byte_level:
            self.state.reset()
        else:
            self.started = False
        return self

    def push(self, ids: bytes) -> bytes:
        """The UTF-8 text which these ids complete."""
        tokens = map(self.spelled.__getitem__, array("I", ids))
        if self.byte_level:
            return self.state.decode(b"".join(tokens)).encode()
        text = b" ".join(tokens)
        if ids and self.started:
            text = b" " + text
        self.started = self.started or bool(ids)
        return text

    def end(self) -> bytes:
        return self.state.decode(b"", True).encode() if self.byte_level else b""


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """One transducer for each file and Python worker."""
    return Transducer(path)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: number of ids, and hashes of the ids and of the decoded text.

    No shuffle. Ids and decoded text go through as slices and are never held whole.
    """
    prepare_workers(docs.sparkSession)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = transducer(path)
        decoder = Decoder(encoder)
        for batch in batches:
            counts, ids_hashes, text_hashes = [], [], []
            for text in batch.column(1):
                count, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()
                decoder.restart()
                for ids in encoder.encode(text.as_py()):
                    count += len(ids) // 4
                    ids_hash.update(ids)
                    text_hash.update(decoder.push(ids))
                text_hash.update(decoder.end())
                counts.append(count)
                ids_hashes.append(ids_hash.hexdigest())
                text_hashes.append(text_hash.hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_hashes, pa.string()), pa.array(text_hashes, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    chosen = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    return chosen.mapInArrow(digest, DIGEST)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every document."""
    prepare_workers(docs.sparkSession)

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = transducer(path)
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                values = array("I", b"".join(encoder.encode(text.as_py()))).tolist()
                yield pa.RecordBatch.from_arrays([pa.array([doc_id.as_py()], pa.int64()), pa.array([values], pa.list_(pa.int32()))], ["doc_id", "ids"])

    chosen = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    return chosen.mapInArrow(ids, "doc_id bigint, ids array<int>")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(transducer(path))
        for batch in batches:
            out = [(decoder.restart().push(array("I", v or []).tobytes()) + decoder.end()).decode() for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("bigint"), F.col("ids").cast("array<int>")).mapInArrow(texts, "doc_id bigint, text string")
