"""Token ids of whole texts with a public tokenizer file, by remembered chunks.

Tokenizers split a text into pieces before any merge, and never merge across pieces. Between two visible
characters a single space always ends a piece, so a text may be cut there, each distinct chunk encoded
once in a task, and the ids put together: the same ids as from encoding the text in one go, at a tenth of
the time. The ids of a chunk come from the tokenizers library: from its model, piece by piece, where all
characters lie below ``PLAIN`` (there the piece pattern is the same in every Unicode version), else from
encoding the whole chunk. Strings of special tokens in a text are those tokens, as in a plain call of the library;
the text between them is encoded part by part.

Edge cases: NULL and empty texts have no ids. Texts whose spaces stand together are cut at single spaces
between visible characters only. Memory: ``MEMO`` chunks at most are remembered.
"""

from __future__ import annotations

import json
import os
import re
import struct

import regex

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
from tokenizers import Tokenizer  # noqa: E402

MEMO = 1_000_000
PLAIN = "ɐ"

_BETWEEN = re.compile(r"(?<=\S) (?=\S)")


def _byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


#: Marks that are a piece of their own after letters.
_MARKS = frozenset(".,;:!?)\"")


class _Odd(Exception):
    """A chunk that begins or ends with white space, so the text needs careful cutting."""


class _Memo(dict):
    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        value = self.make(key)
        if len(self) >= MEMO:
            self.clear()
        self[key] = value
        return value


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self._read_kind(spec)
        self._read_added(spec.get("added_tokens", []))
        self.translation = _byte_characters()
        self.shown_lead = {"": "", " ": self.translation[ord(" ")]}
        self.model = self.tokenizer.model
        self.pieces = _Memo(self._piece)
        self.first = _Memo(self._first)
        self.later = _Memo(self._later)

    def _read_kind(self, spec: dict) -> None:
        split = spec["pre_tokenizer"]
        if split["type"] == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]:
            from public_tokenizers import PATTERN

            self.spaces, self.lower, pattern = True, False, PATTERN
            known = not spec.get("normalizer")
        elif split["type"] == "Sequence" and split["pretokenizers"][0].get("invert"):
            self.spaces, self.lower = False, True
            pattern = split["pretokenizers"][0]["pattern"]["Regex"]
            kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
            known = kinds == ["NFC", "Replace", "Lowercase"]
        else:
            known = False
        if not known:
            raise ValueError("neither a byte-level nor a word-wise tokenizer file")
        self.pattern = regex.compile(pattern)

    def _read_added(self, added: list[dict]) -> None:
        """Strings that are cut out of the raw text before anything else."""
        if any(t[c] for t in added for c in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("only tokens that stand for exactly their string")
        self.added = {t["content"]: _pack([t["id"]]) for t in added}
        # Of strings that begin at one place the longest is taken.
        in_order = sorted(self.added, key=len, reverse=True)
        self.any_added = re.compile("(" + "|".join(map(re.escape, in_order)) + ")") if added else None

    def _piece(self, piece: str) -> bytes:
        return self._ids(piece.encode().decode("latin-1").translate(self.translation))

    def _ids(self, shown: str) -> bytes:
        return _pack([t.id for t in self.model.tokenize(shown)])

    def _chunk(self, chunk: str) -> bytes:
        if chunk and max(chunk) < PLAIN:
            text = chunk.lower() if self.lower else chunk
            return b"".join([self.pieces[p] for p in self.pattern.findall(text)])
        return _pack(self.tokenizer.encode(chunk, add_special_tokens=False).ids)

    def _word(self, word: str, lead: str) -> bytes | None:
        """Ids of letters alone, which are one piece; None for others."""
        text = word.lower() if self.lower else word
        if not text.isalpha():
            return None
        if text.isascii():  # these bytes stand for themselves
            return self._ids(self.shown_lead[lead] + text)
        return self._piece(lead + text) if max(text) < PLAIN else None

    def _marked(self, chunk: str, memo: _Memo) -> bytes | None:
        """Ids of letters and one mark after them, two pieces; None for others."""
        if chunk[-1:] not in _MARKS:
            return None
        word = chunk[:-1]
        plain = word.isascii() or max(word) < PLAIN
        if not plain or not (word.lower() if self.lower else word).isalpha():
            return None
        return memo[word] + self.pieces[chunk[-1]]

    def _first(self, chunk: str) -> bytes:
        """A chunk with nothing before it."""
        found = self._word(chunk, "")
        if found is None:
            found = self._marked(chunk, self.first)
        return self._chunk(chunk) if found is None else found

    def _later(self, chunk: str) -> bytes:
        """A chunk after a space, or after a line feed (then it begins with that)."""
        found = self._word(chunk, " ")
        if found is None:
            found = self._marked(chunk, self.later)
        if found is not None:
            return found
        if not chunk or chunk[-1].isspace() or chunk[0] != "\n" and chunk[0].isspace():
            raise _Odd
        if chunk[0] == "\n":
            return self.pieces["\n"] + self.first[chunk[1:]] if chunk[1].isalpha() else self._chunk(chunk)
        return self._chunk(" " + chunk)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(map(text.__contains__, self.added)):
            parts = self.any_added.split(text)
            return b"".join([self.added[p] if k % 2 else self._plain(p) for k, p in enumerate(parts)])
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.spaces:
            return b"".join(map(self.first.__getitem__, text.replace("\n", " ").split(" ")))
        head, *rest = text.replace("\n", " \n").split(" ")
        try:
            if head[:1].isspace() or head[-1:].isspace() or not head:
                raise _Odd
            return self.first[head] + b"".join(map(self.later.__getitem__, rest))
        except _Odd:
            head, *rest = _BETWEEN.split(text)
            return self._chunk(head) + b"".join([self._chunk(" " + c) for c in rest])


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per file in each worker process, kept between tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
