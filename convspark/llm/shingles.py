"""Sets of hashed word shingles."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """For each text the ascending 64-bit hashes of its distinct shingles of ``width`` words.

    Words are runs without blanks, A-Z lower-cased. A text of fewer words is one shingle; a null text
    or one without words has none.
    """
    places: dict[bytes, int] = {}
    codes: list[int] = []
    counts = []
    for text in texts:
        words = text.encode().lower().split() if text else ()
        codes += [places.setdefault(w, len(places)) for w in words]
        counts.append(len(words))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, places), np.uint64, len(places))
    word = hashes[np.array(codes, np.int64)] if codes else hashes
    with np.errstate(over="ignore"):
        windows = max(0, len(word) - width + 1)
        shingle = word[:windows].copy()
        for k in range(1, width):
            shingle = mix(shingle * _ODD + word[k : k + windows])
        sets, at = [], 0
        for n in counts:
            if n >= width:
                sets.append(np.unique(shingle[at : at + n - width + 1]))
            elif n:
                short = np.array([n], np.uint64)
                for k in range(n):
                    short = mix(short * _ODD + word[at + k])
                sets.append(short)
            else:
                sets.append(np.empty(0, np.uint64))
            at += n
    return sets


def digest(shingles: np.ndarray) -> int:
    """64 bits, signed, that name a set."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)
