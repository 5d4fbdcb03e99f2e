"""Quality rules from tokeniser fertility.

Two public vocabularies cut every word of a text: one with byte fallback, made
mostly from Latin and Cyrillic text, and a byte-level one for many languages.
Characters per token under both, the share of byte-fallback tokens and the
entropy of the tokens say how well the text resembles the prose that the
vocabularies were made from; each script has its own fixed bands, outside of
which a document is rejected, whatever other documents there are.  Counts of words,
symbols, repeated lines and repeated windows stand beside them.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable
from dataclasses import asdict, dataclass
from struct import pack

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.llm.common import unpacked, with_text

#: A text needs this many words.
MIN_WORDS = 50
#: Largest share of words (per cent) in three-word windows that occur more than once.
MAX_REPEAT_PERCENT = 50
#: Words whose cut a Python worker remembers, and the longest it does.
CACHE_WORDS, CACHE_BYTES = 1 << 19, 48
#: Words cut at a time.
CHUNK_WORDS = 1 << 18

VERDICT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean,"
           " n_tokens long, chars_per_token double, byte_share double, entropy double, chars_per_piece double, script string,"
           " in_band boolean")


@dataclass(frozen=True)
class Band:
    """Bounds of a script.

    ``min_entropy`` is a share of the largest entropy that so many tokens can
    have; ``min_chars_per_piece`` is of characters per token of the byte-level vocabulary.
    """

    min_chars_per_token: float
    max_chars_per_token: float
    max_byte_share: float
    min_entropy: float
    min_chars_per_piece: float = 0.0


#: Scripts by the Unicode property of their letters; the first with most letters names the text.
SCRIPTS = ("Latin", "Cyrillic", "Greek", "Arabic", "Hebrew", "Han", "Hiragana", "Katakana", "Hangul", "Devanagari", "Thai")
#: Bands of the two vocabularies. The last bound lies between what random letters of the script give
#: and what prose does: Latin 1.4 and 2.3 or more, Cyrillic 1.2 and 3.0, Greek 1.1 and 1.8, Arabic
#: 0.9 and 1.5, Hebrew 1.1 and 1.7, Han 0.4 and 0.9, kana 0.8 and 1.2, Hangul 0.4 and 1.3,
#: Devanagari 0.5 and 0.8, Thai 0.6 and 1.1.
BANDS = {
    "Latin": Band(1.45, 12.0, 0.10, 0.35, 1.75),
    "Cyrillic": Band(1.2, 10.0, 0.15, 0.35, 1.6),
    "Greek": Band(0.8, 8.0, 0.30, 0.35, 1.35),
    "Arabic": Band(0.7, 8.0, 0.40, 0.35, 1.15),
    "Hebrew": Band(0.6, 8.0, 0.60, 0.35, 1.3),
    "Han": Band(0.3, 8.0, 0.85, 0.30, 0.6),
    "Hiragana": Band(0.3, 8.0, 0.85, 0.30, 0.95),
    "Katakana": Band(0.3, 8.0, 0.85, 0.30, 0.9),
    "Hangul": Band(0.3, 8.0, 0.95, 0.30, 0.75),
    "Devanagari": Band(0.3, 8.0, 0.95, 0.30, 0.64),
    "Thai": Band(0.3, 8.0, 0.95, 0.30, 0.85),
}
#: For texts in other scripts or without letters.
OTHER = Band(0.25, 16.0, 1.0, 0.20)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def quality_verdicts(docs: DataFrame, text_col: str = "text", model: str | None = None, pieces: str | None = None,
                     bands: dict[str, Band] | None = None, other: Band = OTHER) -> DataFrame:
    """Input columns but the text, then the counts, measures and ``kept``.

    A null text has no words and fails the base rules like any text of fewer
    than ``MIN_WORDS``; its measures are 0 and its script ``none``.  A text is
    judged by itself, so repeated rows are judged alike; an empty table gives
    an empty result.  Input columns with a result's name are replaced.
    """
    judged = _judged(docs, text_col, model, pieces, bands, other, keep_text=False)
    names = [n for n in _NAMES if n != "in_band"]
    return unpacked(judged, {n: F.col("_verdict").getField(n) for n in names} | {"kept": _kept()})


def keep_quality(docs: DataFrame, text_col: str = "text", model: str | None = None, pieces: str | None = None,
                 bands: dict[str, Band] | None = None, other: Band = OTHER) -> DataFrame:
    """The rows whose text is kept (see ``quality_verdicts``), with the input columns only."""
    return unpacked(_judged(docs, text_col, model, pieces, bands, other, keep_text=True).filter(_kept()))


def _kept() -> Column:
    return ~F.col("_verdict.base_failed") & F.col("_verdict.in_band")


def _judged(docs: DataFrame, text_col: str, model: str | None, pieces: str | None, bands: dict[str, Band] | None,
            other: Band, keep_text: bool) -> DataFrame:
    paths = model or default_model(), pieces or default_pieces()
    held, rest = {k: asdict(v) for k, v in (bands or BANDS).items()}, asdict(other)

    @F.pandas_udf(VERDICT)
    def verdict(texts: pd.Series) -> pd.DataFrame:
        cutter = Cutter.of(*paths)
        return pd.DataFrame([judge(t, cutter, held, rest) for t in texts], columns=_NAMES)

    return with_text(docs, text_col, keep_text).select("_row", verdict("_text").alias("_verdict"))


_NAMES = [x.split()[0] for x in VERDICT.split(",")]
_LETTERS = [(s, regex.compile(rf"\p{{Script={s}}}+")) for s in SCRIPTS]
_NOT_LATIN = regex.compile(r"[^\p{Script=Latin}\p{Common}\p{Inherited}]")


class Cutter:
    """Words under both vocabularies, with a bounded memory of common words."""

    _open: dict[tuple[str, str], Cutter] = {}

    def __init__(self, path: str, pieces: str) -> None:
        import public_tokenizers
        import sentencepiece
        import tiktoken

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(pieces, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.pieces = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        size = self.model.get_piece_size()
        self.is_byte = np.fromiter((self.model.is_byte(i) for i in range(size)), dtype=bool, count=size)
        self.known: dict[bytes, tuple[bytes, int]] = {}

    @classmethod
    def of(cls, path: str, pieces: str) -> Cutter:
        """One per Python worker."""
        if (path, pieces) not in cls._open:
            cls._open[path, pieces] = cls(path, pieces)
        return cls._open[path, pieces]

    def cut(self, words: list[bytes]) -> list[tuple[bytes, int]]:
        """Packed ids of each word, cut on its own, and its number of byte-level pieces."""
        found: list[tuple[bytes, int]] = []
        for at in range(0, len(words), CHUNK_WORDS):
            chunk = words[at:at + CHUNK_WORDS]
            held = list(map(self.known.get, chunk))
            new = list({w for w, x in zip(chunk, held) if x is None})
            if new:
                if len(self.known) + len(new) > CACHE_WORDS:
                    self.known = {w: x for w, x in zip(chunk, held) if x is not None}
                self.known.update(zip(new, self._cut(new)))
                held = list(map(self.known.__getitem__, chunk))
                for word in new:
                    if len(word) > CACHE_BYTES:
                        del self.known[word]
            found += held
        return found

    def _cut(self, words: list[bytes]) -> Iterable[tuple[bytes, int]]:
        texts = [w.decode("utf-8", "replace") for w in words]
        ids = self.model.encode(texts, out_type=int, num_threads=1)
        # Words stand behind a blank in prose, and the byte-level vocabulary has the blank in its pieces.
        for own, pieces in zip(ids, map(self.pieces.encode_ordinary, [f" {t}" for t in texts])):
            yield pack("<%dH" % len(own), *own), len(pieces)


def script_of(text: str) -> str:
    """The script with most letters; ``none`` without any of the known ones."""
    if text.isascii() or not _NOT_LATIN.search(text):
        return "Latin" if _LETTERS[0][1].search(text) else "none"
    most, name = 0, "none"
    for script, letters in _LETTERS:
        n = sum(m.end() - m.start() for m in letters.finditer(text))
        if n > most:
            most, name = n, script
    return name


def repeated_words(code: np.ndarray) -> int:
    """Words (by their number) inside three-word windows that occur at least twice, the first occurrence included."""
    if len(code) < 4:
        return 0
    most = int(code.max()) + 1
    pair = code[:-1] * most + code[1:]
    if most > 1 << 20:
        pair = np.unique(pair, return_inverse=True)[1].astype(np.int64)
    window = pair[:-1] * most + code[2:]
    ordered = np.sort(window)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    again = np.isin(window, twice)
    covered = np.zeros(len(code), dtype=bool)
    for shift in range(3):
        covered[shift:len(again) + shift] |= again
    return int(covered.sum())


def duplicate_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def judge(text: str | None, cutter: Cutter, bands: dict[str, dict], other: dict) -> tuple:
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    chars = len(text) - len(raw) + len(raw.translate(None, b" \t\n\x0b\x0c\r"))
    symbols = len(raw) - len(raw.translate(None, b"#*$%&|<>"))
    place = {w: i for i, w in enumerate(dict.fromkeys(words))}
    code = np.fromiter(map(place.__getitem__, words), dtype=np.int64, count=n)
    times = np.bincount(code, minlength=1)
    repeated = repeated_words(code)
    failed = n < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * n
    # Each distinct word is cut once and counts as often as it stands in the text.
    packed, sizes = zip(*cutter.cut(list(place))) if place else ((), ())
    times = times[:len(packed)]
    ids = np.frombuffer(b"".join(packed), dtype="<u2")
    used, at = np.unique(ids, return_inverse=True)
    counts = np.bincount(at, weights=np.repeat(times, np.fromiter(map(len, packed), dtype=np.int64, count=len(packed)) >> 1))
    pieces = int(times @ np.array(sizes, dtype=np.int64))
    tokens, per_token, share, entropy, script = int(counts.sum()), 0.0, 0.0, 0.0, script_of(text)
    per_piece = chars / pieces if pieces else 0.0
    if tokens:
        share = float(counts[cutter.is_byte[used]].sum()) / tokens
        per_token = chars / tokens
        counts = counts / tokens
        entropy = float(-(counts * np.log2(counts)).sum()) + 0.0
    band = bands.get(script, other)
    largest = np.log2(min(max(tokens, 2), len(cutter.is_byte)))
    within = (band["min_chars_per_token"] <= per_token <= band["max_chars_per_token"]
              and share <= band["max_byte_share"] and entropy >= band["min_entropy"] * largest
              and per_piece >= band["min_chars_per_piece"])
    return (n, chars, symbols, duplicate_lines(raw), repeated, failed, tokens, per_token, share, entropy, per_piece,
            script, bool(within))
