"""WARC records as bytes: parsing archives, URL keys, loser-tree merging."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from urllib.parse import urlsplit

_LENGTH = re.compile(rb"(?mi)^Content-Length:[ \t]*([0-9]+)[ \t]*\r?$")


def records(archive: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """``(offset, length, headers, block)`` of each record, found by Content-Length alone.

    Raises ``ValueError`` where an archive is cut short or malformed.
    """
    at = 0
    while at < len(archive):
        head_end = archive.find(b"\r\n\r\n", at)
        if not archive.startswith(b"WARC/1.", at) or head_end < 0:
            raise ValueError(f"no WARC record at byte {at}")
        head = archive[at:head_end]
        size = _LENGTH.search(head)
        if not size:
            raise ValueError(f"record at byte {at} has no Content-Length")
        start = head_end + 4
        end = start + int(size[1])
        if archive[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} does not end after its length")
        fields = (line.partition(":") for line in head.decode("utf-8").split("\r\n")[1:])
        yield at, end + 4 - at, {k.strip().lower(): v.strip() for k, _, v in fields}, archive[start:end]
        at = end + 4


def payload_of(block: bytes) -> bytes:
    """What follows the HTTP headers of a response block."""
    return block.partition(b"\r\n\r\n")[2]


def sha1_hex(payload: bytes) -> str:
    return hashlib.sha1(payload).hexdigest()


def url_key(url: str | None) -> str:
    """Sort-friendly form of a URL: host labels reversed, then path and sorted query; no scheme, port 80/443, www or fragment."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:  # not a URL: its own text is the key
        return url.strip().lower()
    if not host:
        return url.strip().lower()
    host = re.sub(r"^www[0-9]*\.", "", host)
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port not in (None, 80, 443) else "") + ")"
    path = parts.path.lower().rstrip("/") or "/"
    query = "&".join(sorted(parts.query.lower().split("&"))) if parts.query else ""
    return key + path + (f"?{query}" if query else "")


class LoserTree:
    """Merges sorted runs: a tournament whose inner nodes keep the losers.

    ``runs`` are iterators over sorted items; ``key`` orders items.  Taking
    the winner replays only its path to the root, so each item costs the
    logarithm of the number of runs.  Equal keys come out by run number.
    """

    def __init__(self, runs: Sequence[Iterator], key: Callable) -> None:
        self.runs, self.key, self.n = runs, key, len(runs)
        self.heads: list = [None] * self.n
        self.losers = [-1] * max(1, self.n)
        for run in range(self.n):
            self._advance(run)
        for run in range(self.n):
            self._replay(run)

    def _advance(self, run: int) -> None:
        item = next(self.runs[run], None)
        # An empty run loses to all others.
        self.heads[run] = (1, None, run, None) if item is None else (0, self.key(item), run, item)

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x[0] != y[0]:
            return x[0] < y[0]
        if x[0] or x[1] == y[1]:
            return a < b
        return x[1] < y[1]

    def _replay(self, run: int) -> None:
        winner, node = run, (run + self.n) // 2
        while node > 0:
            held = self.losers[node]
            if held < 0:  # while the tree is being built: wait for the other side
                self.losers[node] = winner
                return
            if self._before(held, winner):
                self.losers[node], winner = winner, held
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator:
        if not self.n:
            return
        while True:
            winner = self.losers[0]
            empty, _, _, item = self.heads[winner]
            if empty:
                return
            yield item
            self._advance(winner)
            self._replay(winner)
