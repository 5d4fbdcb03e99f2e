"""Folding of disguised words, and a weighted lexicon matched by Aho-Corasick."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import regex

from martline.llm.wordbpe import ChunkCache

#: Letters of other scripts that look like Latin ones.
HOMOGLYPHS = dict(zip(
    "аеорсухіјѕԁһкмтвнԛԝαεικνορτυχωɑɡıⅼ",
    "aeopcyxijsdhkmtbhqwaeikvoptuxwagil"))
#: Digits and signs written for letters.
SUBSTITUTES = dict(zip("0134578@$!|+€", "oieastbasilte"))

_FOLD = str.maketrans(HOMOGLYPHS)
_SUBSTITUTE = str.maketrans(SUBSTITUTES)
_HIDDEN = re.compile("[­​-‏⁠﻿]")
_ENDS = re.compile(r"^[\W_]+|[\W_]+$")
_LETTER = re.compile(r"[^\W\d_]")

#: Lengths of word beginnings that can be terms of their own.
PREFIXES = range(3, 9)
#: Terms of so many letters also count inside a word, of whatever length, where words are written together.
MIN_INSIDE = 5
#: A token cut by signs into parts of so many letters at most is one word, and so are letters standing alone, from this many on.
MOST_JOINED, MIN_SPELLED = 3, 4
#: Lengths of terms in scripts written without spaces, in characters.
GRAMS = range(1, 6)

#: A character of a script written without spaces between words.
_UNSPACED = (r"[\p{Han}\p{Hiragana}\p{Katakana}ー\p{Bopomofo}\p{Yi}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Javanese}\p{Balinese}"
             r"\p{Tai_Tham}\p{Tai_Le}\p{New_Tai_Lue}\p{Tai_Viet}&&\p{L}]")
_RUN = regex.compile(rf"(?V1)(?:{_UNSPACED}\p{{M}}*)+")
#: What a folded word consists of: single characters without spaces, and runs of other letters.
_PIECE = regex.compile(rf"(?V1){_UNSPACED}\p{{M}}*|(?:(?!{_UNSPACED})\p{{L}}\p{{M}}*)+")
_IS_GRAM = regex.compile(rf"(?V1){_UNSPACED}")
#: A token that is a plain word between signs that stand for no letter there.
_SIMPLE = re.compile(r"[-.,;:?\"'()_]*([a-z]+)[-.,;:?!\"'()_]*")
_APOSTROPHE = re.compile("['’]")
_SPELLED = re.compile(rf"(?<= )(?:[a-z] ){{{MIN_SPELLED},}}")
#: The least of it, found faster.
_SOME_SPELLED = re.compile(" " + "[a-z] " * MIN_SPELLED)
_ACCENTS = regex.compile(r"(?<=\p{Latin}\p{Mn}*)\p{Mn}")
#: Where two words of different scripts meet. Single look-alikes inside a word are a disguise, so a
#: border needs three Latin letters on one side and a letter without a Latin twin on the other.
_TWINLESS = rf"[\p{{L}}--\p{{Latin}}--[{''.join(HOMOGLYPHS)}]]"
_BORDER = regex.compile(rf"(?V1)(?=\p{{Latin}}{{3}})(?<={_TWINLESS}[[\p{{L}}\p{{M}}]--\p{{Latin}}]*)"
                        rf"|(?<=\p{{Latin}}{{3}})(?=[\p{{L}}--\p{{Latin}}]*{_TWINLESS})")


def fold_word(word: str) -> str:
    """A word without disguise: compatibility forms, look-alikes, accents, hidden characters, digits for letters.

    Signs at either end are dropped first, so that ``word!!`` stays the word;
    digits and signs inside a word with letters become the letters they stand
    for, a word without letters folds to nothing.
    """
    if not word.isascii():
        word = unicodedata.normalize("NFD", _HIDDEN.sub("", unicodedata.normalize("NFKC", word)).lower().translate(_FOLD))
        word = unicodedata.normalize("NFC", _ACCENTS.sub("", word))
    if word.isalpha():
        return word
    if word[0] in SUBSTITUTES and not word[0].isdigit() and word[1:2].isalpha():
        word = SUBSTITUTES[word[0]] + word[1:] if word[0] in "@$€!" else word
    word = _ENDS.sub("", word)
    return word.translate(_SUBSTITUTE) if _LETTER.search(word) else ""


#: Accented Latin letters (Latin-1 and Extended-A) that fold to one plain letter each.
_PLAIN = {i: fold_word(chr(i)) for i in range(0xDF, 0x180)
          if unicodedata.normalize("NFKC", chr(i)) == chr(i) == chr(i).lower() and re.fullmatch("[a-z]", fold_word(chr(i)))}


def split_token(token: str) -> list[str]:
    """The folded words of a token between white space.

    It is cut where scripts meet and, once folded, at all that is no letter;
    if only parts of up to ``MOST_JOINED`` letters come of that, they are one
    word (not so around an apostrophe).  Scripts without spaces give their
    characters one by one.
    """
    simple = _SIMPLE.fullmatch(token if token.isascii() else token.translate(_PLAIN))
    if simple:
        return [simple[1]]
    if token.isascii():
        parts = [token]
    else:
        token = unicodedata.normalize("NFC", _HIDDEN.sub("", unicodedata.normalize("NFKC", token))).lower()
        parts = _RUN.sub(r" \g<0> ", _BORDER.sub(" ", token)).split()
    words = []
    for part in parts:
        word = part if _IS_GRAM.match(part) else fold_word(part)
        pieces = [word] if word.isalpha() and word.isascii() else _PIECE.findall(word)
        if len(pieces) > 1 and not _IS_GRAM.match(part) and not _APOSTROPHE.search(part) and max(map(len, pieces)) <= MOST_JOINED:
            pieces = ["".join(pieces)]
        words += pieces
    return words


_FOLDED = ChunkCache(lambda w: split_token(w))


def folded_words(text: str | None) -> list[str]:
    """The folded words of a text; tokens that fold to nothing are left out, letters that stand alone in a row are one word."""
    words = list(chain.from_iterable(map(_FOLDED.__getitem__, text.lower().split()))) if text else []
    line = f" {' '.join(words)} "
    if _SOME_SPELLED.search(line):
        words = _SPELLED.sub(lambda m: m[0].replace(" ", "") + " ", line).split()
    return words


def terms_of(word: str) -> list[str]:
    """Terms that a word contains: itself (``word$``) and its beginnings."""
    return [word + "$", *(word[:k] for k in PREFIXES if k <= len(word))]


def grams_of(words: list[str]) -> Iterator[str]:
    """Terms of neighbouring characters of scripts without spaces: ``a$``, ``a b$`` and so on."""
    run: list[str] = []
    for word in chain(words, [""]):
        if word and _IS_GRAM.match(word):
            run.append(word)
            continue
        for i in range(len(run)):
            for k in GRAMS:
                if i + k <= len(run):
                    yield " ".join(run[i:i + k]) + "$"
        run = []


class TermCounter:
    """Documents and occurrences of terms."""

    def __init__(self) -> None:
        self.docs: Counter = Counter()
        self.words: Counter = Counter()
        self.grams: Counter = Counter()
        self.terms = ChunkCache(self._terms)

    def _terms(self, word: str) -> list[str]:
        """None of a character of a script without spaces: its terms depend on its neighbours."""
        return [] if not word.isascii() and _IS_GRAM.match(word) else terms_of(word)

    def add(self, words: list[str]) -> None:
        lists = list(map(self.terms.__getitem__, set(words)))
        own = set(chain.from_iterable(lists))
        if not all(lists):
            grams = list(grams_of(words))
            own.update(grams)
            self.grams.update(grams)
        self.docs.update(own)
        self.words.update(words)

    def take(self) -> list[tuple[str, int, int]]:
        times = self.grams
        for word, n in self.words.items():
            for term in self.terms[word]:
                times[term] += n
        rows = [(t, n, times[t]) for t, n in self.docs.items()]
        self.docs, self.words, self.grams = Counter(), Counter(), Counter()
        return rows


class Lexicon:
    """Terms with weights, and phrases inside which no term counts."""

    def __init__(self, weights: dict[str, float], exceptions: Iterable[str] = (), at_start_only: Iterable[str] = ()) -> None:
        """``at_start_only``: letters of terms that do not count inside a word."""
        import ahocorasick

        at_start_only = frozenset(at_start_only)

        self.automaton = ahocorasick.Automaton()
        for term, weight in weights.items():
            whole = term.endswith("$")
            pattern = f" {term[:-1]} " if whole else f" {term}"
            self.automaton.add_word(pattern, (len(pattern), weight))
            letters = term[:-1] if whole else term
            if " " not in letters and len(letters) >= MIN_INSIDE and not _IS_GRAM.match(letters) and letters not in at_start_only:
                # Also within a longer word; at its beginning it meets the same place as the pattern above.
                self.automaton.add_word(letters, (len(letters) + 1, max(weight, weights.get(letters, weight), weights.get(letters + "$", weight))))
        for phrase in exceptions:
            pattern = f" {' '.join(folded_words(phrase))} "
            if pattern.strip():
                self.automaton.add_word(pattern, (len(pattern), None))
        self.empty = len(self.automaton) == 0
        if not self.empty:
            self.automaton.make_automaton()

    def inside(self, line: str) -> set[str]:
        """Letters of the terms that stand inside a word of a folded text (as ``hits`` gives it)."""
        found = set()
        for end, (length, weight) in () if self.empty else self.automaton.iter(line):
            start = end - length + 1
            if weight is not None and line[start] != " ":
                found.add(line[start + 1:end + 1])
        return found

    def hits(self, words: list[str]) -> tuple[str, dict[int, float]]:
        """The folded text, and the place before each match (a blank, or a letter inside a word) with its largest weight."""
        text = f" {' '.join(words)} "
        if self.empty or not words:
            return text, {}
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (length, weight) in self.automaton.iter(text):
            start = end - length + 1
            if weight is None:
                spared.append((start, end))
            elif weight > best.get(start, float("-inf")):
                best[start] = weight
        for start, end in spared:
            for at in [a for a in best if start <= a < end] if len(best) < end - start else range(start, end):
                best.pop(at, None)
        return text, best
