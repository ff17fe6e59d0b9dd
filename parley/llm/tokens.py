"""Token ids of whole texts by a tokenizer file, remembered word by word.

The pre-tokenizers of both supported shapes never join characters across certain gaps, so a
text is cut there, each distinct piece is encoded once by the tokenizers library, and the ids
of the pieces are joined. Files of another shape are encoded text by text.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from struct import Struct

import numpy as np

from parley.llm.common import Memo

#: Letters whose case and composition are settled character by character.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_WORD = re.compile(f"([{_LETTERS}]+)([.,;:!?*&%$#|]*)")
_EVEN_GAP = re.compile(r"(?<=\S)(?=[ \n]\S)")


class _OddGap(Exception):
    """A gap of a text is more than one space or line feed."""


@lru_cache(maxsize=1)
def byte_letters() -> list[str]:
    """The letter which byte-level vocabularies write for each byte.

    Printable Latin-1 bytes stand for themselves, the others follow from code point 256 on.
    """
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, following = [], 256
    for byte in range(256):
        letters.append(chr(byte if byte in own else following))
        following += byte not in own
    return letters


def spell(text: str) -> str:
    letters = byte_letters()
    return "".join([letters[b] for b in text.encode()])


def _is_latin(text: str) -> bool:
    """Only characters below U+0100, which lower-case one by one and are composed."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class TextEncoder:
    """``ids(text)``: little-endian ids as bytes of ``dtype``, as ``encode(..., add_special_tokens=False)``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = Struct("<H" if self.dtype.itemsize == 2 else "<I").pack
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        self.special = [t["content"] for t in parts["added_tokens"]]
        pre, normalizer, model = parts["pre_tokenizer"] or {}, parts["normalizer"], parts["model"]
        plain = model["type"] == "BPE" and not model.get("dropout") and not parts["post_processor"]
        steps = [s["type"] for s in (normalizer or {}).get("normalizers", [])]
        if plain and not normalizer and pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]:
            self.ids = self._spaced
        elif plain and steps == ["NFC", "Replace", "Lowercase"] and pre.get("type") == "Sequence":
            self.ids = self._unspaced
        else:
            self.ids = self._whole
        self.first, self.spaced = Memo(self._first, 10_000), Memo(self._after_gap)
        self.unspaced, self.points = Memo(self._piece), Memo(self._run)

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def _whole(self, text: str) -> bytes:
        return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _run(self, run: str) -> bytes:
        """A run which the pre-tokenizer keeps whole."""
        letters = run if run.isascii() and run.isalpha() else spell(run)
        return b"".join([self.code(t.id) for t in self.model.tokenize(letters)])

    def _letters(self, word: str, point: str) -> bytes:
        return self._run(word) + self.points[point] if point else self._run(word)

    def _first(self, piece: str) -> bytes:
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise _OddGap
        return self._whole(piece)

    def _after_gap(self, piece: str) -> bytes:
        """A piece that followed a space; one that followed a line feed starts with it."""
        if word := _WORD.fullmatch(piece):
            return self._letters(" " + word[1], word[2])
        bare = piece.removeprefix("\n")
        if not bare or bare[0].isspace() or bare[-1].isspace():
            raise _OddGap
        if word := _WORD.fullmatch(bare):
            return self.points["\n"] + self._letters(word[1], word[2])
        return self._whole(piece if bare is not piece else " " + piece)

    def _spaced(self, text: str) -> bytes:
        """White space belongs to the following word: cut before lone spaces and line feeds."""
        if not text:
            return b""
        first, *rest = text.replace("\n", " \n").split(" ")
        try:
            return self.first[first] + b"".join(map(self.spaced.__getitem__, rest))
        except _OddGap:
            return b"".join(map(self._whole, _EVEN_GAP.split(text)))

    def _piece(self, piece: str) -> bytes:
        if not piece:
            return b""
        if word := _WORD.fullmatch(piece):
            return self._letters(word[1].lower(), word[2])
        return self._whole(piece)

    def _unspaced(self, text: str) -> bytes:
        """White space is dropped: cut at every space and line feed."""
        if not any(s in text.lower() for s in self.special) and _is_latin(text):
            text = text.lower()
        return b"".join(map(self.unspaced.__getitem__, text.replace("\n", " ").split(" ")))


@lru_cache(maxsize=2)
def encoder(path: str) -> TextEncoder:
    """One encoder for each file and Python worker."""
    return TextEncoder(path)
