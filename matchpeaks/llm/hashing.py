"""64-bit hashes of all words of many texts at once."""

from __future__ import annotations

import numpy as np
import xxhash

#: Longer words are hashed one by one: a polynomial modulo 2**64 takes some unlike strings of 512 bytes and more for equal.
LONG_WORD = 64
#: Fixed odd multiplier of the polynomial hash, its inverse modulo 2**64, and one random number for each byte.
BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_BYTES = np.random.default_rng(20240131).integers(0, 1 << 64, 256, np.uint64)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(b" \t\n\x0b\x0c\r")] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, at least ``n`` of each."""
    size = max(1 << 16, 1 << (n - 1).bit_length())
    if size not in _POWERS:
        steps = np.empty((2, size), np.uint64)
        steps[:, 0] = 1
        steps[0, 1:], steps[1, 1:] = BASE, _INVERSE
        _POWERS.clear()
        _POWERS[size] = tuple(np.cumprod(steps, axis=1, dtype=np.uint64))
    return _POWERS[size]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all bits (a bijection)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of byte numbers times powers: any stretch's hash is a difference of two of them."""
    up, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[: len(data)], out=sums[1:])
    return sums


def stretch_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = powers(len(sums))
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of every white-space word, in order."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    space = _IS_SPACE[data]
    edges = np.flatnonzero(np.diff(space, prepend=True))
    starts, ends = edges[::2], edges[1::2]
    limits = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    hashes = stretch_hashes(prefix_sums(data), starts, ends)
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        hashes[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
    return np.searchsorted(limits, starts, "right"), hashes


def groups_of(texts: list[bytes], size: int = 1 << 18):
    """(first number, texts) of stretches of about ``size`` bytes, so that work arrays stay small."""
    at = held = 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= size or i == len(texts) - 1:
            yield at, texts[at : i + 1]
            at, held = i + 1, 0


def shingles(texts: list[bytes], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of each text's distinct word shingles, sorted by both.

    A text with fewer words has one shingle of all its words; a text without words has none.
    """
    docs, keys = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for first, group in groups_of(texts):
        doc, word = word_hashes(group)
        counts = np.bincount(doc, minlength=len(group))
        n = len(word)
        rolled = np.zeros(max(0, n - width + 1), np.uint64)
        for k in range(width):
            rolled = rolled * BASE + word[k : n - width + 1 + k] if len(rolled) else rolled
        whole = doc[: len(rolled)] == doc[width - 1 :] if len(rolled) else np.zeros(0, bool)
        at, key = doc[: len(rolled)][whole], mixed(rolled[whole])
        short = np.flatnonzero((counts > 0) & (counts < width))
        if len(short):
            begins = np.cumsum(counts) - counts
            made = []
            for d in short:
                value = np.uint64(0)
                with np.errstate(over="ignore"):
                    for w in word[begins[d] : begins[d] + counts[d]]:
                        value = value * BASE + w
                made.append(value + np.uint64(counts[d]))
            at, key = np.concatenate([at, short]), np.concatenate([key, mixed(np.array(made, np.uint64))])
        order = np.lexsort((key, at))
        at, key = at[order], key[order]
        new = np.ones(len(key), bool)
        new[1:] = (at[1:] != at[:-1]) | (key[1:] != key[:-1])
        docs.append(at[new] + first)
        keys.append(key[new])
    return np.concatenate(docs), np.concatenate(keys)
