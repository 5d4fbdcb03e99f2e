"""Cutting texts for a word-level BPE vocabulary file (``tokenizers`` JSON with word ends).

Merges never cross white space, so a text is cut at white space and every
chunk's result is remembered in a bounded table.  That short cut is taken for texts of plain
Latin characters without special-token strings, whose normalisation is known to be
lower-casing alone; any other text goes through the library's own
normaliser and pre-tokeniser as a whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np

#: Chunks a Python worker remembers, and the longest it does.
CACHE_CHUNKS, CACHE_CHARS = 1 << 19, 40
#: Characters of a plain text that are cut at a time.
CHUNK_CHARS = 1 << 22

#: Characters that normalisation leaves alone but for case: ASCII and precomposed Latin letters.
_PLAIN = re.compile("[\t-\r -~À-ÖØ-öø-įĲ-ňŊ-ž]*")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def library(path: str):
    """The ``tokenizers`` object of a file, without truncation and padding, on one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def is_plain(text: str, special: list[str]) -> bool:
    """Whether white-space chunks of the lower-cased text can be cut one by one."""
    return _PLAIN.fullmatch(text) is not None and not any(s in text for s in special)


def plain_chunks(text: str) -> Iterator[list[str]]:
    """The lower-cased text's chunks between white space, in lists of bounded length."""
    if len(text) <= CHUNK_CHARS:
        yield text.lower().split()
        return
    at = 0
    while at < len(text):
        end = at + CHUNK_CHARS
        if end < len(text):  # back to white space, or on to it inside a longer chunk
            cut = max(text.rfind(c, at, end) for c in " \n\t")
            end = cut + 1 if cut > at else next((m.end() for m in _SPACE.finditer(text, end)), len(text))
        yield text[at:end].lower().split()
        at = end


_SPACE = re.compile(r"\s")

#: Cuts a lower-cased chunk of plain Latin characters as the vocabulary's pre-tokeniser does.
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿā-ž]+|[0-9]|[^a-z0-9ß-öø-ÿā-ž]+")


class ChunkCache(dict):
    """Results of chunks, computed on a miss; emptied when full."""

    def __init__(self, compute: Callable[[str], object]) -> None:
        super().__init__()
        self.compute = compute

    def __missing__(self, chunk: str) -> object:
        found = self.compute(chunk)
        if len(chunk) <= CACHE_CHARS:
            if len(self) >= CACHE_CHUNKS:
                self.clear()
            self[chunk] = found
        return found


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, extra = [""] * 256, 0x100
    for b in range(256):
        if b in plain:
            letters[b] = chr(b)
        else:
            letters[b], extra = chr(extra), extra + 1
    return letters


class LibraryIds:
    """Token ids by the ``tokenizers`` library, as packed little-endian numbers of ``width`` bytes."""

    _open: dict[str, LibraryIds] = {}

    def __init__(self, path: str) -> None:
        self.library = library(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.width = 2 if size <= 1 << 16 else 4
        self.model, self.letters = self.library.model, byte_letters()
        self.number = [i.to_bytes(self.width, "little") for i in range(size)]
        self.chunks = ChunkCache(self._chunk)

    @classmethod
    def of(cls, path: str) -> LibraryIds:
        """One per Python worker."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def packed(self, ids: Iterable[int]) -> bytes:
        return np.array(ids, dtype=f"<u{self.width}").tobytes()

    def _chunk(self, chunk: str) -> bytes:
        """A chunk of several pieces is put together from theirs, which other chunks share."""
        pieces = [chunk] if chunk.isalpha() else PIECES.findall(chunk)
        if len(pieces) > 1:
            return b"".join(map(self.chunks.__getitem__, pieces))
        letters = chunk if chunk.isascii() else "".join(map(self.letters.__getitem__, chunk.encode("utf-8")))
        return b"".join([self.number[t.id] for t in self.model.tokenize(letters)])

    def encode(self, text: str) -> bytes:
        if not is_plain(text, self.special):
            return self.packed(self.library.encode(text, add_special_tokens=False).ids)
        return b"".join([b"".join(map(self.chunks.__getitem__, chunks)) for chunks in plain_chunks(text)])
