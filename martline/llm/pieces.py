"""SentencePiece BPE encoding by vectorised merge rounds, and decoding.

The symbols of many words lie in one flat array.  In every round each pair of
neighbours has the rank of the piece that it would make; the pairs of least
rank around merge at once, the leftmost first where they overlap, and the
arrays are compacted, until no pair is left.  In a short word *around* is the
whole word; in a long one it is as far as a piece can reach, since whatever
could take one of the pair's symbols would begin with a merge in there.  Merges
that may be followed at once by one of the same rank (runs of blanks, which
share one) are left to the end and made one after another.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.llm.common import unpacked, with_text

#: The character that stands for a blank.
BLANK = "▁"
#: Words that a Python worker remembers, and the longest it does.
CACHE_WORDS, CACHE_CHARS = 1 << 19, 40
#: Words of a text that are cut at a time.
CHUNK_WORDS = 1 << 18
#: Words of more symbols are merged around each pair instead of as a whole.
SHORT_WORD = 64

_NEVER = np.int64(1 << 40)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceEncoder:
    """Encoder of one model file."""

    _open: dict[str, PieceEncoder] = {}

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec, trained = model.normalizer_spec, model.trainer_spec
        if (trained.model_type != trained.BPE or not trained.byte_fallback or spec.precompiled_charsmap
                or spec.remove_extra_whitespaces or not spec.escape_whitespaces or trained.treat_whitespace_as_suffix):
            raise ValueError("only BPE models with byte fallback that leave texts as they are")
        kind = model.SentencePiece
        self.prefix = BLANK if spec.add_dummy_prefix else ""
        self.surface: list[bytes] = []
        self.byte = [0] * 256
        normal: dict[str, int] = {}
        for n, piece in enumerate(model.pieces):
            if piece.type == kind.BYTE:
                self.byte[int(piece.piece[3:5], 16)] = n
                self.surface.append(bytes([int(piece.piece[3:5], 16)]))
            elif piece.type == kind.NORMAL:
                normal[piece.piece] = n
                self.surface.append(piece.piece.replace(BLANK, " ").encode("utf-8"))
            elif piece.type in (kind.UNKNOWN, kind.CONTROL):
                self.surface.append(trained.unk_surface.encode("utf-8") if piece.type == kind.UNKNOWN else b"")
            else:
                raise ValueError(f"piece {n} is of a kind that is not handled")
        self.number = [str(n).encode() for n in range(len(self.surface))]
        # Ranks: pieces by falling score; pieces of one score share a rank.
        made = [p for p in normal if len(p) > 1]
        scores = sorted({model.pieces[normal[p]].score for p in made}, reverse=True)
        rank_of = {s: r for r, s in enumerate(scores)}
        # Symbols: single characters of the vocabulary (any other is made on the way), then pieces.
        inside = sorted({c for p in normal for c in p})
        self.chars = {c: n for n, c in enumerate(inside)}
        self.symbol = dict(self.chars)
        for p in made:
            self.symbol[p] = len(self.symbol)
        self.ids = np.full(len(self.symbol), -1, dtype=np.int64)
        for p, n in normal.items():
            self.ids[self.symbol[p]] = n
        self.rank = np.full(len(self.symbol), -1, dtype=np.int64)
        for p in made:
            self.rank[self.symbol[p]] = rank_of[model.pieces[normal[p]].score]
        pairs = [(self.symbol[p[:k]], self.symbol[p[k:]], self.symbol[p])
                 for p in made for k in range(1, len(p)) if p[:k] in self.symbol and p[k:] in self.symbol]
        self.pair = {(a, b): c for a, b, c in pairs}
        # Longest piece in characters: how far a merge can depend on what stands beside it.
        self.reach = max(map(len, made), default=1)
        keys = np.array([a * len(self.symbol) + b for a, b, _ in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.results = keys[order], np.array([c for _, _, c in pairs], dtype=np.int64)[order]
        self.in_turn = np.ones(len(self.symbol), dtype=bool)
        self.in_turn[list(self._out_of_turn(made))] = False
        # Words end where a blank follows another character, and around a line feed, if no piece spans that.
        spans = any(re.search(f"[^{BLANK}]{BLANK}", p) for p in made)
        lines = any("\n" in p for p in made)
        self.words = re.compile("(?s).+" if spans else f"{BLANK}*[^{BLANK}]+|{BLANK}+" if lines
                                else f"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n")
        self.known: dict[str, tuple[bytes, bytes]] = {}

    @classmethod
    def of(cls, path: str) -> PieceEncoder:
        """One per Python worker."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def _one_by_one(self, symbols: list[int]) -> tuple[list[int], list[int]]:
        """A word after all merges, best rank first, then leftmost; and what was made, in turn."""
        after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        heap: list[tuple[int, int, int, int]] = []
        turns: list[int] = []

        def offer(left: int) -> None:
            if left >= 0 and after[left] < len(symbols):
                a, b = symbols[left], symbols[after[left]]
                if (a, b) in self.pair:
                    heapq.heappush(heap, (int(self.rank[self.pair[a, b]]), left, a, b))

        for left in range(len(symbols)):
            offer(left)
        while heap:
            _, left, a, b = heapq.heappop(heap)
            right = after[left]
            if right >= len(symbols) or symbols[left] != a or symbols[right] != b:
                continue
            symbols[left], symbols[right] = self.pair[a, b], -1
            turns.append(symbols[left])
            after[left] = after[right]
            if after[left] < len(symbols):
                before[after[left]] = left
            offer(before[left])
            offer(left)
        return [s for s in symbols if s >= 0], turns

    def _out_of_turn(self, made: list[str]) -> set[int]:
        """Symbols whose merge may be followed at once by one of the same or a better rank.

        A piece is only ever made as in a word of its own letters, since its
        neighbours take no part in that; so it is enough to look at those.
        """
        found: set[int] = set()
        for p in made:
            symbols, turns = self._one_by_one([self.chars[c] for c in p])
            if symbols == [self.symbol[p]] and (self.rank[turns[:-1]] >= self.rank[turns[-1]]).any():
                found.update(turns)
        return found

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What pairs of symbols make (-1: nothing) and its rank."""
        known = len(self.symbol)
        key = np.where((left >= 0) & (right >= 0) & (left < known) & (right < known), left * known + right, -1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        made = np.where(self.keys[at] == key, self.results[at], -1)
        return made, np.where(made >= 0, self.rank[made], _NEVER)

    def _around(self, ranks: np.ndarray, starts: np.ndarray | None) -> np.ndarray:
        """Least rank around each pair: in its word, or, without words, as far as a piece reaches."""
        if starts is not None:
            return np.repeat(np.minimum.reduceat(ranks, starts), np.diff(starts, append=len(ranks)))
        beside = np.full(self.reach, _NEVER)
        least, width = np.concatenate([beside, ranks, beside]), 1
        while width < 2 * self.reach + 1:  # least ranks of windows of ever more pairs
            more = min(width, 2 * self.reach + 1 - width)
            least, width = np.minimum(least[:-more], least[more:]), width + more
        return least

    def merged(self, symbols: np.ndarray, sizes: np.ndarray, short: bool) -> tuple[np.ndarray, np.ndarray]:
        """The flat symbols of words of ``sizes`` after all rounds, and the words' new sizes."""
        word = np.repeat(np.arange(len(sizes)), sizes)
        made, ranks = self._ranks(symbols, np.append(symbols[1:], -1))
        last = np.append(word[1:] != word[:-1], True) if len(word) else np.zeros(0, dtype=bool)
        made[last], ranks[last] = -1, _NEVER
        while len(symbols):
            if short:
                starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
                least = self._around(ranks, starts)
            else:
                least = self._around(ranks, None)
            chosen = (ranks == least) & (made >= 0) & self.in_turn[made]
            at = np.flatnonzero(chosen)
            if not len(at):
                break
            # Of pairs that overlap, the first, third ... of a run merge.
            run = np.append(0, np.flatnonzero(np.diff(at) != 1) + 1)
            lengths, first = np.diff(run, append=len(at)), at[run]
            place = np.arange(len(at)) - np.repeat(run, lengths)
            # A run waits if a pair of its rank before it does, which would merge first.
            waits = (first > 0) & (ranks[first - 1] == ranks[first])
            at = at[(place % 2 == 0) & ~np.repeat(waits, lengths)]
            if not len(at):
                break
            symbols[at] = made[at]
            stay = np.ones(len(symbols), dtype=bool)
            stay[at + 1] = False
            moved = np.cumsum(stay) - 1
            symbols, word, made, ranks = symbols[stay], word[stay], made[stay], ranks[stay]
            # New neighbours: the pairs that begin with a new symbol or end in one.
            new = moved[at]
            redo = np.unique(np.concatenate([new, new[new > 0] - 1]))
            right = np.minimum(redo + 1, len(symbols) - 1)
            inner = (redo + 1 < len(symbols)) & (word[right] == word[redo])
            made[redo], ranks[redo] = self._ranks(symbols[redo], np.where(inner, symbols[right], -1))
        left = np.unique(word[made >= 0])  # words in which pairs of one rank are left
        counts = np.bincount(word, minlength=len(sizes))
        if not len(left):
            return symbols, counts
        ends = np.cumsum(counts)
        parts = np.split(symbols, ends[:-1])
        for n in left.tolist():
            parts[n] = np.array(self._one_by_one(parts[n].tolist())[0], dtype=np.int64)
        return np.concatenate(parts), np.array([len(p) for p in parts])

    def cut(self, words: list[str]) -> list[np.ndarray]:
        """Ids of words, each on its own."""
        if not words:
            return []
        sizes = np.array([len(w) for w in words])
        found: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(words)
        for short in (True, False):
            which = np.flatnonzero((sizes <= SHORT_WORD) == short)
            if len(which):
                for n, ids in zip(which.tolist(), self._cut([words[n] for n in which.tolist()], sizes[which], short)):
                    found[n] = ids
        return found

    def _cut(self, words: list[str], sizes: np.ndarray, short: bool) -> list[np.ndarray]:
        points = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
        letters, place = np.unique(points, return_inverse=True)
        # Characters outside the vocabulary get numbers behind all symbols.
        outside = len(self.symbol)
        own = np.array([self.chars.get(chr(c), outside + n) for n, c in enumerate(letters.tolist())], dtype=np.int64)
        symbols, counts = self.merged(own[place], sizes, short)
        known = symbols < outside
        ids = np.where(known, self.ids[np.where(known, symbols, 0)], -1)
        if (ids < 0).any():  # byte fallback: such a symbol is a single character
            name = {int(s): chr(c) for s, c in zip(own.tolist(), letters.tolist())}
            bytes_of = {s: [self.byte[b] for b in name[s].encode("utf-8")] for s in np.unique(symbols[ids < 0]).tolist()}
            width = np.ones(len(symbols), dtype=np.int64)
            width[ids < 0] = [len(bytes_of[s]) for s in symbols[ids < 0].tolist()]
            spread = np.repeat(ids, width)
            spread[np.repeat(ids < 0, width)] = list(itertools.chain.from_iterable(bytes_of[s] for s in symbols[ids < 0].tolist()))
            ends = np.cumsum(width)[np.cumsum(counts) - 1]
            return np.split(spread, ends[:-1])
        return np.split(ids, np.cumsum(counts)[:-1])

    def decoded(self, ids: list[int]) -> bytes:
        """The bytes of pieces one after another."""
        return b"".join(map(self.surface.__getitem__, ids))

    def _cut_new(self, words: Iterable[str]) -> None:
        """Puts the words among those known: decimal ids, commas between, and decoded bytes."""
        wanted = set(words)
        new = list(wanted.difference(self.known))
        if len(self.known) + len(new) > CACHE_WORDS:
            self.known = {w: self.known[w] for w in wanted.intersection(self.known)}
        for word, ids in zip(new, self.cut(new)):
            numbers = ids.tolist()
            self.known[word] = b",".join(map(self.number.__getitem__, numbers)), self.decoded(numbers)

    def _settle(self, held: list[tuple[list[tuple[bytes, bytes]], list[str]]]) -> None:
        """Words of several texts, cut together and added to their texts' parts; long ones are not kept."""
        self._cut_new(itertools.chain.from_iterable(words for _, words in held))
        for parts, words in held:
            own = list(map(self.known.__getitem__, words))
            parts.append((b",".join([x[0] for x in own]), b"".join([x[1] for x in own])))
        for _, words in held:
            for word in words:
                if len(word) > CACHE_CHARS:
                    self.known.pop(word, None)

    def _chunks(self, text: str) -> Iterator[list[str]]:
        """A text's words, in lists of bounded length."""
        text = self.prefix + text.replace(" ", BLANK) if text else ""
        if len(text) <= CHUNK_WORDS:
            yield self.words.findall(text)
            return
        matches = self.words.finditer(text)
        while words := [m.group() for m in itertools.islice(matches, CHUNK_WORDS)]:
            yield words

    def encode_all(self, texts: Iterable[str]) -> Iterator[tuple[bytes, bytes]]:
        """Per text its decimal ids, commas between, and the bytes that they decode to."""
        waiting: list[list[tuple[bytes, bytes]]] = []
        held: list[tuple[list[tuple[bytes, bytes]], list[str]]] = []
        size = 0
        for text in texts:
            waiting.append([])
            for words in self._chunks(text):
                if words:
                    held.append((waiting[-1], words))
                    size += len(words)
                if size >= CHUNK_WORDS:
                    self._settle(held)
                    held, size = [], 0
            if not held:
                yield from map(self._whole, waiting)
                waiting = []
        self._settle(held)
        yield from map(self._whole, waiting)

    def _whole(self, parts: list[tuple[bytes, bytes]]) -> tuple[bytes, bytes]:
        """A text's parts together, without the blank that was put before it."""
        decoded = b"".join([x[1] for x in parts])
        return b",".join([x[0] for x in parts]), decoded[1:] if self.prefix and decoded.startswith(b" ") else decoded


def piece_round_trip(docs: DataFrame, text_col: str = "text", model: str | None = None) -> DataFrame:
    """Input columns plus ``n_tokens, ids`` (decimal, commas between) and ``decoded``.

    No begin or end ids.  Null texts are encoded as empty: no ids, empty
    decoded text.  Names of control pieces inside a text are ordinary text, as
    in the library.  Rows are independent of each other and repeated ones are
    coded alike; an empty table gives an empty result.  Input columns with a
    result's name are replaced.
    """
    coded = _coded(docs, text_col, model, digests=False)
    return unpacked(coded, {n: F.col("_coded").getField(n) for n in ("n_tokens", "ids", "decoded")})


def piece_digests(docs: DataFrame, text_col: str = "text", model: str | None = None) -> DataFrame:
    """As ``piece_round_trip``, with SHA-256 digests ``ids_sha256`` and ``decoded_sha256`` for the two texts."""
    coded = _coded(docs, text_col, model, digests=True)
    return unpacked(coded, {"n_tokens": F.col("_coded.n_tokens"), "ids_sha256": F.col("_coded.ids"),
                            "decoded_sha256": F.col("_coded.decoded")})


def _coded(docs: DataFrame, text_col: str, model: str | None, digests: bool) -> DataFrame:
    path = model or default_model()

    @F.pandas_udf("n_tokens long, ids string, decoded string")
    def code(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for ids, decoded in PieceEncoder.of(path).encode_all(texts):
            n = ids.count(b",") + 1 if ids else 0
            rows.append((n, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()) if digests
                        else (n, ids.decode(), decoded.decode("utf-8")))
        return pd.DataFrame(rows, columns=["n_tokens", "ids", "decoded"])

    return with_text(docs, text_col, keep=True).withColumn("_coded", code("_text"))
