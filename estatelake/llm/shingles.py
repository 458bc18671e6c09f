"""Word shingles of texts as sorted sets of 64-bit hashes, by numpy over many texts at a time.

Words are maximal runs of bytes other than space and bytes 9 to 13; a shingle is five words in a
row, and a text of one to four words is one shingle. Word hashes are polynomial prefix sums modulo
2^64 followed by a mixer.
"""

from __future__ import annotations

import numpy as np

WIDTH = 5
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Texts are hashed in pieces of about so many bytes, cut between words.
PIECE = 1 << 20
_WHITE = np.zeros(256, bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and its inverse modulo 2^64, for i below n at least."""
    if not _powers or len(_powers["up"]) < n:
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        for key, b in (("up", BASE), ("down", inverse)):
            table = np.full(max(n, PIECE + (1 << 16)), b, np.uint64)
            table[0] = 1
            _powers[key] = np.cumprod(table)
    return _powers["up"], _powers["down"]


def _piece_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each word of some bytes."""
    white = np.ones(len(data) + 2, bool)
    white[1:-1] = _WHITE[data]
    edge = np.flatnonzero(white[1:] != white[:-1])
    starts, ends = edge[::2], edge[1::2]
    up, down = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some texts, and where each text's words start (one more entry at the end)."""
    joined = b" ".join(texts)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    begins = np.cumsum(sizes) - sizes
    data = np.frombuffer(joined, np.uint8)
    found, at = [], 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        while end < len(data) and not _WHITE[data[end]]:
            end += 1
        starts, hashes = _piece_hashes(data[at:end])
        found.append((starts + at, hashes))
        at = end
    starts = np.concatenate([s for s, _ in found]) if found else np.zeros(0, np.int64)
    hashes = np.concatenate([h for _, h in found]) if found else np.zeros(0, np.uint64)
    return hashes, np.append(np.searchsorted(starts, begins), len(starts))


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; null counts as empty."""
    with np.errstate(over="ignore"):
        words, at = word_hashes([(t or "").encode("utf-8", "surrogatepass") for t in texts])
        steps = [np.uint64(pow(int(BASE) ^ 0x5555, k, 1 << 64)) for k in range(WIDTH)]
        n = len(words) - WIDTH + 1
        rolled = mix(sum((words[k : k + n] * steps[k] for k in range(WIDTH)), np.zeros(n, np.uint64))) if n > 0 else np.zeros(0, np.uint64)
        out = []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if b - a >= WIDTH:
                out.append(np.unique(rolled[a : b - WIDTH + 1]))
            elif b > a:
                out.append(mix(np.array([sum(int(w) * pow(3, k + 1, 1 << 64) for k, w in enumerate(words[a:b])) + b - a & (1 << 64) - 1], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
        return out


def set_id(shingles: np.ndarray) -> bytes | None:
    """16 bytes that stand for the set; null for no shingles."""
    if not len(shingles):
        return None
    with np.errstate(over="ignore"):
        a, b = mix(shingles ^ np.uint64(0x1234567)).sum(dtype=np.uint64), mix(shingles + np.uint64(0x89ABCDEF)).sum(dtype=np.uint64)
    return np.array([a, b ^ np.uint64(len(shingles))], ">u8").tobytes()


class Sketcher:
    """MinHash values at a number of positions: position t holds the least of a_t * h + b_t, its upper 32 bits."""

    def __init__(self, positions: int) -> None:
        seeds = np.arange(1, 2 * positions + 1, dtype=np.uint64) * BASE
        mixed = mix(seeds)
        self.a, self.b = mixed[:positions] | np.uint64(1), mixed[positions:]

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        best = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(0, len(shingles), 512):
                np.minimum(best, (shingles[i : i + 512, None] * self.a + self.b).min(axis=0), out=best)
        return (best >> np.uint64(32)).astype(np.uint32)
