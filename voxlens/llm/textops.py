"""Vectorised word handling over code points (numpy, inside tasks).

A text becomes its code points; words are maximal runs of a character class;
a word's 64-bit hash is a polynomial over mixed code points, taken from one
prefix sum so that no Python loop runs per word. A window's hash combines the
hashes of its words. Memory is a few arrays of the text's length.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def _splitmix(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    with np.errstate(over="ignore"):
        z = (np.arange(1, n + 1, dtype=U64) + U64(seed)) * U64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> U64(27))) * U64(0x94D049BB133111EB)
        return z ^ (z >> U64(31))


_MIX = _splitmix(1 << 16, 17)
_PLACE = _splitmix(64, 91) | U64(1)
_POW: dict[str, np.ndarray] = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def finish(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> U64(33))) * U64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> U64(29))) * U64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> U64(32))


def _geometric(base: int, n: int) -> np.ndarray:
    """base ** 0, 1, ... n - 1 modulo 2 ** 64, by doubling."""
    out = np.empty(n, U64)
    out[0] = 1
    done = 1
    with np.errstate(over="ignore"):
        while done < n:
            k = min(done, n - done)
            out[done:done + k] = out[:k] * U64(pow(base, done, 1 << 64))
            done += k
    return out


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; kept for texts of up to a million characters."""
    inverse = pow(_BASE, -1, 1 << 64)
    if n > 1 << 20:
        return _geometric(_BASE, n), _geometric(inverse, n)
    if len(_POW["up"]) < n:
        size = max(1 << 17, 1 << (n - 1).bit_length())
        _POW["up"], _POW["down"] = _geometric(_BASE, size), _geometric(inverse, size)
    return _POW["up"][:n], _POW["down"][:n]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def lower_ascii(cp: np.ndarray) -> np.ndarray:
    """A-Z to a-z, everything else unchanged."""
    return cp + ((cp - 65 < 26).astype(np.uint32) << 5)  # unsigned: below 'A' wraps past 26


def byte_table(keep: bytes) -> bytes:
    """For ``bytes.translate`` on UTF-8: A-Z to a-z; ``keep`` and all of non-ASCII stay, the rest
    become blanks, so that ``split()`` gives the maximal runs."""
    low = bytes(range(256)).lower()
    return bytes(b if b in keep or b > 127 else 32 for b in low)


def spaced_mask(cp: np.ndarray) -> np.ndarray:
    """Characters of words ``[^\\x20\\x09-\\x0D]+``."""
    return (cp != 32) & (cp - 9 > 4)


def alnum_mask(cp: np.ndarray) -> np.ndarray:
    """Characters of words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``."""
    return (cp > 127) | (cp - 97 < 26) | (cp - 48 < 10)


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.zeros(len(mask) + 2, dtype=bool)
    edge[1:-1] = mask
    at = np.flatnonzero(edge[1:] != edge[:-1])
    return at[0::2], at[1::2]


def word_hashes(cp: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span, independent of where it stands."""
    if not len(starts):
        return np.empty(0, U64)
    up, down = _powers(len(cp))
    with np.errstate(over="ignore"):
        mixed = _MIX[cp & 0xFFFF]
        if cp.max() > 0xFFFF:
            mixed = mixed + (cp >> 16).astype(U64) * U64(0xD6E8FEB86659FD93)
        total = np.empty(len(cp) + 1, U64)
        total[0] = 0
        np.cumsum(mixed * up, out=total[1:])
        return finish((total[ends] - total[starts]) * down[starts])


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` consecutive words (order matters)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, U64)
    with np.errstate(over="ignore"):
        out = words[:n] * _PLACE[0]
        for k in range(1, size):
            out = (out ^ (out >> U64(31))) * _PLACE[32 + k % 32] + words[k:k + n] * _PLACE[k % 32]
    return finish(out + U64(size))


def covered(hit: np.ndarray, size: int) -> np.ndarray:
    """Which words lie in a window that starts at a True of ``hit``."""
    n = len(hit) + size - 1
    delta = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(hit)
    delta[at] += 1
    delta[at + size] -= 1
    return np.cumsum(delta[:-1]) > 0
