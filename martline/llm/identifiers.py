"""Identifiers in one text: base spans, looser candidates and their contexts.

Spans are ``(kind, start, end)`` in code points, end exclusive; kinds are numbered as in ``KINDS``.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections import Counter

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

#: Fixed definitions of the base kinds.  A look-behind or possessive quantifier only spares retries that cannot match.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)++")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]|\((?:at|AT)\)|\[(?:at|AT)\]")

#: What an identifier of a kind may look like where its context vouches for it.
_LOOSE = re.compile(
    r"(?P<email>(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:@|\(at\)|\[at\]|\(AT\)|\[AT\])\x20?[A-Za-z0-9-]++"
    r"(?:(?:\.|\x20?(?:\(dot\)|\[dot\]|\(DOT\)|\[DOT\])\x20?)[A-Za-z0-9-]++)*+)"
    r"|(?P<ip>(?<![0-9A-Za-z.:])(?:[0-9]{1,4}(?:\.[0-9]{1,4}){3}|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){3,7})(?![0-9A-Za-z:]))"
    r"|(?P<number>(?<![0-9A-Za-z])\(?[0-9](?:[\x20().-]{0,2}[0-9])++(?![0-9A-Za-z]))")
#: Characters from which on a context word is kept as its digest, so that contexts stay small.
LONG_WORD = 64

_WORD = re.compile(r"\S+")
_TRIM = ".,;:!?\"'()[]{}<>|*#$%&"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """The base kinds' spans, by kind and start."""
    found = []
    if "@" in text:
        at, free = text.find("@"), 0
        while at >= 0:
            local = _LOCAL.search(text[_local_floor(text, free, at):at])
            domain = _DOMAIN.match(text, at + 1) if local else None
            if domain:
                found.append((EMAIL, at - (local.end() - local.start()), domain.end()))
                free = domain.end()
            at = text.find("@", at + 1)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((IP, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((CARD, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                found.append((PHONE, m.start(), m.end()))
    return found


_IN_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _local_floor(text: str, free: int, at: int) -> int:
    """Where the run of local-part characters that ends before ``at`` begins, not before ``free``."""
    start = at
    while start > free and text[start - 1] in _IN_LOCAL:
        start -= 1
    return start


def luhn(digits: str) -> bool:
    total = 0
    for n, d in enumerate(map(int, reversed(digits))):
        total += d if n % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def loose_spans(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """``(kinds as a bit set, start, end)`` of candidates that touch no base span, by start."""
    borders = sorted((s, e) for _, s, e in taken)
    found, n = [], 0
    for m in _LOOSE.finditer(text):
        while n < len(borders) and borders[n][1] <= m.start():
            n += 1
        if n < len(borders) and borders[n][0] < m.end():
            continue
        if m["number"]:
            digits = sum(map(str.isdigit, m[0]))
            kinds = (1 << CARD) * (12 <= digits <= 19) | (1 << PHONE) * (7 <= digits <= 15)
        else:
            kinds = 1 << (EMAIL if m["email"] else IP)
        if kinds:
            found.append((kinds, m.start(), m.end()))
    return found


def _plain(word: str) -> str:
    """A context word: trimmed, lower case, any digit as 0; a long one by its digest."""
    word = re.sub("[0-9]", "0", word.strip(_TRIM).lower())
    return word if len(word) <= LONG_WORD else "#" + hashlib.sha1(word.encode("utf-8")).hexdigest()


class _Words:
    """A text's words between white space, and those around its spans."""

    def __init__(self, text: str, spots: list[tuple[int, int]]) -> None:
        self.text = text
        borders = [m.span() for m in _WORD.finditer(text)]
        self.starts, self.ends = [s for s, _ in borders], [e for _, e in borders]
        self.words = [_plain(text[s:e]) for s, e in borders]
        self.spot_starts, self.spot_ends = sorted(s for s, _ in spots), sorted(e for _, e in spots)

    def around(self, start: int, end: int) -> tuple[list[str], str]:
        """The two words before a span and the one behind it, however far they are.

        What is glued to the span is a word too; it reaches to the next identifier at most.
        """
        n = bisect_left(self.starts, start)  # words that begin before the span
        left = self.words[max(0, n - 2):n]
        if n and self.ends[n - 1] > start:
            left[-1] = _plain(self.text[max(self.starts[n - 1], _before(self.spot_ends, start)):start])
        m = bisect_right(self.ends, end)  # the first word that ends behind it
        if m == len(self.ends):
            right = "$"
        elif self.starts[m] >= end:
            right = self.words[m]
        else:
            right = _plain(self.text[end:min(self.ends[m], _behind(self.spot_starts, end, self.ends[m]))])
        return ["^"] * (2 - len(left)) + left, right


def _before(ends: list[int], start: int) -> int:
    n = bisect_right(ends, start)
    return ends[n - 1] if n else 0


def _behind(starts: list[int], end: int, most: int) -> int:
    n = bisect_left(starts, end)
    return starts[n] if n < len(starts) else most


def identifiers(text: str) -> tuple[list[tuple[int, int, int]], list[dict]]:
    """Base spans, and for each span or candidate its patterns: one dict a pattern.

    A pattern is the two words before, or the word before and the word after.
    ``seen`` is how often those context words occur so in the text, whatever
    stands between them, for each time that they enclose an identifier here.
    """
    if not _ANY.search(text):
        return [], []
    base = base_spans(text)
    spots = [(1 << k, s, e, k) for k, s, e in base] + [(k, s, e, -1) for k, s, e in loose_spans(text, base)]
    if not spots:
        return [], []
    around_of = _Words(text, [(s, e) for _, s, e, _ in spots])
    words = around_of.words
    before = Counter(zip(words, words[1:]))
    around = Counter(zip(words, words[2:]))
    found = []
    for kinds, start, end, seed in spots:
        left, right = around_of.around(start, end)
        for pattern, seen in ((f"{left[0]} {left[1]} _", before[left[0], left[1]]),
                              (f"{left[1]} _ {right}", around[left[1], right])):
            found.append({"start": start, "end": end, "kinds": kinds, "seed": seed,
                          "value": text[start:end].lower(), "pattern": pattern, "seen": seen})
    here = Counter(x["pattern"] for x in found)
    for x in found:
        x["seen"] = max(1.0, x["seen"] / here[x["pattern"]])
    return base, found
