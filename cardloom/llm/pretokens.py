"""Pre-token encoding with a worker cache, for one public word-level BPE file.

A text is split into pre-tokens, and what the library makes of each pre-token
is kept in a dictionary, so that the merges run once for each distinct word of
a worker and not once for each word of the corpus.  Texts that hold a special
token's string or a character outside ``_PLAIN`` go to the library whole.
"""

from __future__ import annotations

import os
import re
import struct
import unicodedata
from collections.abc import Iterator

#: Longer pre-tokens aren't kept in a cache.
LONGEST = 256
#: Characters whose lower case and composed form need no tables of the library.
_PLAIN = re.compile("[\t-\r -~¡-¬®-įĲ-ňŊ-ſ‐-‧‰-⁞€]*")


def _members(kind: str) -> str:
    return "".join(re.escape(c) for c in map(chr, range(0x21, 0x180)) if unicodedata.category(c)[0] == kind)


def _pattern() -> re.Pattern:
    letters, numbers = _members("L"), _members("N")
    return re.compile(f"[{letters}]+|[{numbers}]|'(?:s|t|re|ve|m|ll|d)|[^\\s{letters}{numbers}]+")


def _byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class PreTokens(dict):
    """Maps a pre-token to its ids as little-endian 32-bit integers.

    Entries of over ``LONGEST`` characters aren't kept.

    ``fixed`` stays; of what is learned besides, at most ``capacity`` entries
    are held, so memory is bounded whatever the corpus is.
    """

    def __init__(self, path: str, fixed: dict | None = None, capacity: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.fixed, self.capacity = fixed or {}, capacity
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.pattern, self.table = _pattern(), str.maketrans({chr(b): c for b, c in _byte_characters().items()})
        self.update(self.fixed)

    def __missing__(self, token: str) -> bytes:
        if len(self) >= self.capacity + len(self.fixed):
            self.clear()
            self.update(self.fixed)
        units = token.encode().decode("latin-1").translate(self.table)
        out = self.of([t.id for t in self.model.tokenize(units)])
        if len(token) <= LONGEST:
            self[token] = out
        return out

    @classmethod
    def of(cls, ids: list[int]) -> bytes:
        """What is kept of a pre-token with these ids."""
        return cls.packed(ids)

    @staticmethod
    def packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def split(self, text: str) -> list[str] | None:
        """The pre-tokens, or None where only the library can tell them."""
        if not _PLAIN.fullmatch(text) or any(s in text for s in self.special):
            return None
        return self.pattern.findall(text.lower())

    def ids(self, text: str) -> bytes:
        """The ids of a whole text, packed."""
        tokens = self.split(text)
        if tokens is None:
            return self.packed(self.library.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self.__getitem__, tokens))


class Lengths(PreTokens):
    """Maps a pre-token to its number of tokens."""

    @classmethod
    def of(cls, ids: list[int]) -> int:
        return len(ids)

    def count(self, text: str) -> int:
        """The number of tokens of a whole text."""
        tokens = self.split(text)
        if tokens is None:
            return len(self.library.encode(text, add_special_tokens=False).ids)
        return sum(map(self.__getitem__, tokens))


_IN_WORKER: dict[tuple[str, type], PreTokens] = {}


def for_worker(path: str, kind: type = PreTokens, fixed: dict | None = None) -> PreTokens:
    """The cache of this Python worker; later tasks of the worker find it warm."""
    held = _IN_WORKER.get((path, kind))
    if held is None or held.fixed != (fixed or {}):
        _IN_WORKER[path, kind] = held = kind(path, fixed)
    return held


def texts(batch) -> Iterator[str]:
    """The text column of an Arrow batch; null is empty."""
    return (t or "" for t in batch.column("text").to_pylist())
