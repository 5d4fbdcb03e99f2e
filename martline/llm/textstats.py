"""Small per-text helpers shared by the operators: words, fingerprints.

Words are maximal runs of bytes outside space and 0x09-0x0D.  ``bytes.split``
without arguments cuts at exactly these six bytes, and none of them occurs
inside a multi-byte UTF-8 sequence, so splitting the UTF-8 bytes is the same
as splitting the code points.
"""

from __future__ import annotations

import numpy as np
import xxhash

#: Shingles hashed at once while a fingerprint is summed; bounds the memory of a very long text.
FINGERPRINT_CHUNK = 1 << 16


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8 bytes; null has none."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def shingle_hashes(words: list[bytes], size: int, seed: int) -> list[int]:
    """XXH64 of every shingle of ``size`` words (repeats included).

    Fewer words than ``size`` form one shingle of them all; no words, none.
    """
    if not words:
        return []
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return [digest(b" ".join(words), seed)]
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = np.concatenate(([0], ends[:-size])).tolist()
    stops = (ends[size - 1:] - 1).tolist()
    return [digest(joined[a:b], seed) for a, b in zip(starts, stops)]


def simhash(text: str | None, size: int, seed: int = 42) -> int:
    """64-bit fingerprint: a bit is 1 if set in over half of the shingle hashes."""
    hashes = shingle_hashes(words_of(text.translate(_ASCII_LOWER) if text else text), size, seed)
    if not hashes:
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), FINGERPRINT_CHUNK):
        part = np.array(hashes[at:at + FINGERPRINT_CHUNK], dtype=">u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


_ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
