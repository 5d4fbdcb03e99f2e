"""Exact BPE encoding by dynamic programming over prefixes, and decoding.

A BPE encoding is determined from the left: every prefix of a word has one
last token.  An automaton over the vocabulary reports, at each position, the
tokens that are suffixes of the prefix; a token is the last one if the pair of
it and the last token of what precedes it is compatible, that is, if BPE on
the two tokens' letters gives back the two tokens.  The last tokens are stored
per prefix and the ids follow from walking back.
"""

from __future__ import annotations

import hashlib
import json
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.llm.common import unpacked, with_text
from martline.llm.wordbpe import PIECES, ChunkCache, byte_letters, default_vocabulary, is_plain, library, plain_chunks

#: Pair tests a Python worker remembers.
CACHE_PAIRS = 1 << 19
#: Letters at the end of a word are units of their own, kept in a private range.
_END = 0xE000


class PrefixEncoder:
    """Encoder of one vocabulary file; words come as byte-level letters."""

    _open: dict[str, PrefixEncoder] = {}

    def __init__(self, path: str) -> None:
        import ahocorasick

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        self.suffix = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        vocabulary = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = {a + b for a, b in merges}
        if len(made) != len(merges):
            raise ValueError("two merges make the same token; its rank is not unique")
        # Order: single letters first, then merged tokens by rank.
        names = [t for t in vocabulary if t not in made] + [a + b for a, b in merges]
        order = {t: n for n, t in enumerate(names)}
        self.id = [vocabulary[t] for t in names]
        self.name = names
        singles = len(names) - len(merges)
        self.left = list(range(singles)) + [order[a] for a, _ in merges]
        self.right = list(range(singles)) + [order[b] for _, b in merges]
        self.merged = {(order[a], order[b]): singles + n for n, (a, b) in enumerate(merges)}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton()
        self.units = [0] * len(names)
        for token, name in enumerate(names):
            units = self.as_units(name)
            self.units[token] = len(units)
            # A token that BPE would not make from its own letters is never the last one.
            if token < singles or self._fits(self.left[token], self.right[token], token):
                self.automaton.add_word(units, (len(units), token))
        self.automaton.make_automaton()
        self.letters = byte_letters()
        self.library = library(path)
        self.chunks = ChunkCache(self._plain_chunk)

    @classmethod
    def of(cls, path: str) -> PrefixEncoder:
        """One per Python worker."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def as_units(self, name: str) -> str:
        if name.endswith(self.suffix) and len(name) > len(self.suffix):
            name = name[:-len(self.suffix)]
            return name[:-1] + chr(_END + ord(name[-1]))
        return name

    def _fits(self, a: int, b: int, limit: int) -> bool:
        """Whether no merge of an order below ``limit`` joins letters of ``a`` with letters of ``b``.

        Takes the two tokens apart from the latest merge back; at each step the
        pair that then meets at the border must not merge before what was
        taken apart.
        """
        while True:
            joined = self.merged.get((a, b))
            if joined is not None and joined < limit:
                return False
            split_a, split_b = self.right[a] != a, self.left[b] != b
            if split_a and (a > b or not split_b):
                limit, a = a, self.right[a]
            elif split_b:
                limit, b = b + 1, self.left[b]
            else:
                return True

    def compatible(self, a: int, b: int) -> bool:
        """Whether BPE on the letters of the two tokens gives the two tokens."""
        found = self.pairs.get((a, b))
        if found is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            found = self.pairs[a, b] = self._fits(a, b, len(self.id))
        return found

    def word(self, letters: str) -> list[int]:
        """Tokens (by order) of one pre-token in byte-level letters."""
        units = letters[:-1] + chr(_END + ord(letters[-1]))
        last = [-1] * len(units)
        pairs, compatible = self.pairs, self.compatible
        for end, (length, token) in self.automaton.iter(units):
            if last[end] < 0:
                before = end - length
                if before < 0:
                    last[end] = token
                else:
                    known = pairs.get((last[before], token))
                    if compatible(last[before], token) if known is None else known:
                        last[end] = token
        found, at = [], len(units) - 1
        while at >= 0:
            found.append(last[at])
            at -= self.units[last[at]]
        return found[::-1]

    def _bytes_as_letters(self, piece: str) -> str:
        return piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode("utf-8")))

    def _written(self, tokens: list[int]) -> tuple[bytes, bytes]:
        return (" ".join(str(self.id[t]) for t in tokens).encode(),
                " ".join(self.name[t] for t in tokens).encode("utf-8"))

    def _plain_chunk(self, chunk: str) -> tuple[bytes, bytes]:
        """A chunk of several pieces is put together from theirs, which other chunks share."""
        pieces = [chunk] if chunk.isalpha() else PIECES.findall(chunk)
        if len(pieces) > 1:
            found = list(map(self.chunks.__getitem__, pieces))
            return b" ".join([x[0] for x in found]), b" ".join([x[1] for x in found])
        return self._written(self.word(self._bytes_as_letters(chunk)))

    def encode(self, text: str) -> tuple[bytes, bytes]:
        """Decimal ids and the decoded text's UTF-8 bytes, both joined by one space.

        Without a decoder the library's ``decode`` joins the tokens' names by a space.
        """
        found: list[tuple[bytes, bytes]] = []
        if is_plain(text, list(self.special)):
            for chunks in plain_chunks(text):
                found += map(self.chunks.__getitem__, chunks)
        else:
            known = "|".join(map(re.escape, self.special))
            for part in re.split(f"({known})", text) if known else [text]:
                if part in self.special:
                    found.append((str(self.special[part]).encode(), part.encode("utf-8")))
                elif part:
                    clean = self.library.normalizer.normalize_str(part)
                    pieces = self.library.pre_tokenizer.pre_tokenize_str(clean)
                    found += [self._written(self.word(p)) for p, _ in pieces if p]
        return b" ".join([x[0] for x in found]), b" ".join([x[1] for x in found])


def bpe_round_trip(docs: DataFrame, text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Input columns plus ``n_tokens, ids`` (decimal, one space between) and ``decoded``.

    Null texts are encoded as empty: no ids, empty decoded text.  Special-token
    strings inside a text become their ids, as the library does.  Rows are
    independent of each other; an empty table gives an empty result.  Input
    columns with a result's name are replaced.
    """
    coded = _coded(docs, text_col, vocabulary, digests=False)
    return unpacked(coded, {n: F.col("_coded").getField(n) for n in ("n_tokens", "ids", "decoded")})


def bpe_digests(docs: DataFrame, text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """As ``bpe_round_trip``, with SHA-256 digests ``ids_sha256`` and ``decoded_sha256`` for the two texts."""
    coded = _coded(docs, text_col, vocabulary, digests=True)
    return unpacked(coded, {"n_tokens": F.col("_coded.n_tokens"), "ids_sha256": F.col("_coded.ids"),
                            "decoded_sha256": F.col("_coded.decoded")})


def _coded(docs: DataFrame, text_col: str, vocabulary: str | None, digests: bool) -> DataFrame:
    path = vocabulary or default_vocabulary()

    @F.pandas_udf("n_tokens long, ids string, decoded string")
    def code(texts: pd.Series) -> pd.DataFrame:
        encoder, rows = PrefixEncoder.of(path), []
        for text in texts:
            ids, decoded = encoder.encode(text)
            n = ids.count(b" ") + 1 if ids else 0
            rows.append((n, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()) if digests
                        else (n, ids.decode(), decoded.decode("utf-8")))
        return pd.DataFrame(rows, columns=["n_tokens", "ids", "decoded"])

    return with_text(docs, text_col, keep=True).withColumn("_coded", code("_text"))
