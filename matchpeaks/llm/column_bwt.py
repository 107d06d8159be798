"""Burrows-Wheeler transform and common prefixes of many strings, built column by column.

Round ``j`` inserts one more symbol of each string from the right: the suffix it begins goes
to a place that follows from the place of the suffix behind it, by counting how often the symbol stands
before that place in the transform. A round reads the transform and the common prefixes once from the
beginning to the end and writes the next ones, so that both are sequential files; small ones
stay in memory, larger ones go to the task's own temporary files, which end with it.

Who looks for common strings of some length needs no shorter suffixes. The last ``tail`` symbols
of all strings can therefore be put in order at once, by sorting them; the rounds begin with
the symbol before them.
"""

from __future__ import annotations

import tempfile
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np

#: Elements per read, and bytes of a file that are kept in memory.
CHUNK, SPOOL = 1 << 22, 64 << 20
#: Common prefixes are told apart up to this length.
LONGEST = 255


def _file(array: np.ndarray) -> tempfile.SpooledTemporaryFile:
    out = tempfile.SpooledTemporaryFile(SPOOL)
    out.write(array.tobytes())
    return out


def _chunks(file: tempfile.SpooledTemporaryFile):
    file.seek(0)
    while data := file.read(CHUNK):
        yield np.frombuffer(data, np.uint8)


class _Ranges:
    """Least common prefix since the last, and until the next, occurrence of each symbol, carried from chunk to chunk."""

    def __init__(self, symbols: int):
        self.seen = np.zeros(symbols, np.int64)
        self.since = np.zeros(symbols, np.uint8)
        self.open = np.full(symbols, -1, np.int64)
        self.until = np.zeros(symbols, np.uint8)


class Collection(NamedTuple):
    """Of the suffixes in order: the symbol before each (0: none), the common prefix with the suffix before; places of the tails and their strings."""

    bwt: np.ndarray
    lcp: np.ndarray
    tails: np.ndarray
    owners: np.ndarray


class _Tails:
    """The strings' tails in order, equal ones in the order of their strings."""

    def __init__(self, text: np.ndarray, starts: np.ndarray, width: int):
        self.text, self.width = text, width
        rows = self.rows_at(starts)
        self.owners = np.argsort(self.keys(rows), kind="stable")
        self.rows = rows[self.owners]
        self.sorted = self.keys(self.rows)
        self.places = np.arange(len(starts))

    def rows_at(self, starts: np.ndarray) -> np.ndarray:
        return self.text[starts[:, None] + np.arange(self.width)]

    def keys(self, rows: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(rows).view(f"S{self.width}").ravel() if self.width else np.zeros(len(rows), np.int8)

    def below(self, rows: np.ndarray) -> np.ndarray:
        """How many tails stand before suffixes with these first symbols; a tail that begins one stands before it."""
        return np.searchsorted(self.sorted, self.keys(rows), "right")

    def common(self, rows: np.ndarray, tails: np.ndarray) -> np.ndarray:
        same = np.ones((len(rows), self.width + 1), bool)
        same[:, self.width] = False
        np.equal(rows, self.rows[tails], out=same[:, : self.width])
        return same.argmin(axis=1)


def collection(strings: Sequence[np.ndarray], symbols: int, tail: int = 0) -> Collection:
    """Transform of strings of numbers from 1 to ``symbols - 1``, at most 255, none shorter than ``tail``.

    It holds the suffixes of ``tail`` and more symbols; a suffix stands before those that it begins.
    """
    n = len(strings)
    lengths = np.fromiter(map(len, strings), np.int64, n)
    text = np.concatenate([*strings, np.zeros(1, np.uint8)]).astype(np.uint8)
    ends = np.cumsum(lengths)
    begins = ends - lengths
    tails = _Tails(text, ends - tail, tail)
    string, rest = tails.owners, lengths[tails.owners] - tail
    symbol = np.where(rest > 0, text[np.maximum(begins[string], ends[string] - tail - 1)], 0).astype(np.uint8)
    first = np.zeros(n, np.uint8)
    first[1:] = np.minimum(tails.common(tails.rows[1:], np.arange(n - 1)), LONGEST) if n else 0
    bwt, lcp = _file(symbol), _file(first)
    counts = np.bincount(symbol, minlength=symbols)
    place, string = np.flatnonzero(rest > 0), string[rest > 0]
    for j in range(tail + 1, int(lengths.max(initial=0)) + 1):
        rank, at, before, after = _ranked(bwt, lcp, place, counts, symbols)
        string = string[at]
        rows = tails.rows_at(ends[string] - j)
        below = tails.below(rows)
        place = rank + below
        tails.places = tails.places + np.searchsorted(place - np.arange(len(place)), tails.places, "right")
        left = np.flatnonzero(below)
        left = left[tails.places[below[left] - 1] == place[left] - 1]
        before[left] = tails.common(rows[left], below[left] - 1)
        right = np.flatnonzero(below < n)
        right = right[tails.places[below[right]] == place[right] + 1]
        after[right] = tails.common(rows[right], below[right])
        more = lengths[string] > j
        symbol = np.where(more, text[np.maximum(ends[string] - j - 1, begins[string])], 0).astype(np.uint8)
        bwt, lcp = _merged(bwt, lcp, place, symbol, before, after)
        counts += np.bincount(symbol, minlength=symbols)
        place, string = place[more], string[more]
    whole, prefixes = (np.concatenate([*_chunks(file), np.empty(0, np.uint8)]) for file in (bwt, lcp))
    bwt.close()
    lcp.close()
    return Collection(whole, prefixes, tails.places, tails.owners)


def _ranked(bwt, lcp, place: np.ndarray, counts: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The new suffixes' numbers among all that rounds have inserted, ascending; which of ``place`` each comes from; the common
    prefix with the one before, and with the one behind (0 and -1: none that begins with the same symbol)."""
    base = np.concatenate([[0, 0], np.cumsum(counts[1:])])[:symbols]
    r = _Ranges(symbols)
    single = bwt.seek(0, 2) <= CHUNK
    goes, froms, befores = [], [], []
    after = np.full(len(place), -1, np.int16)
    lo = 0
    for b, h in zip(_chunks(bwt), _chunks(lcp)):
        hi = lo + len(b)
        a, z = np.searchsorted(place, [lo, hi])
        mine = place[a:z] - lo
        order = np.argsort(b, kind="stable")
        count = np.bincount(b, minlength=symbols)
        end = np.cumsum(count)
        first = end - count
        here = np.flatnonzero(count)
        if not single:
            ahead, behind = np.minimum.accumulate(h), np.minimum.accumulate(h[::-1])[::-1]
            # Suffixes of earlier chunks that still wait for the next occurrence of their symbol.
            met = here[r.open[here] >= 0]
            after[r.open[met]] = 1 + np.minimum(r.until[met], ahead[order[first[met]]]).astype(np.int16)
            r.open[met] = -1
            r.until = np.minimum(r.until, ahead[-1])
        # New suffixes by symbol and place: their entries in the order of all.
        asked = np.zeros(len(b), bool)
        asked[mine] = True
        k = np.flatnonzero(asked[order])
        p = order[k]
        c = b[p].astype(np.int64)
        goes.append(base[c] + r.seen[c] + k - first[c])
        index = a + np.searchsorted(mine, p)
        froms.append(index)
        inside = k > first[c]
        before = np.zeros(len(p), np.int16) if single else np.where(r.seen[c] > 0, 1 + np.minimum(r.since[c], ahead[p]).astype(np.int16), 0)
        if inside.any():
            before[inside] = 1 + _least(h, order[k[inside] - 1] + 1, p[inside])
        befores.append(before)
        follows = k + 1 < end[c]
        if follows.any():
            after[index[follows]] = 1 + _least(h, p[follows] + 1, order[k[follows] + 1])
        if not single:
            alone = ~follows
            r.open[c[alone]] = index[alone]
            tail = np.append(behind, np.uint8(LONGEST))
            r.until[c[alone]] = tail[p[alone] + 1]
            r.since = np.minimum(r.since, ahead[-1])
            r.since[here] = tail[order[end[here] - 1] + 1]
        r.seen += count
        lo = hi
    goes_, at, before = (np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int64) for x in (goes, froms, befores))
    order = np.argsort(goes_, kind="stable")
    at = at[order]
    return goes_[order], at, before[order], after[at].astype(np.int64)


def _least(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Least value of each stretch, its end included."""
    edges = np.empty(2 * len(starts), np.int64)
    edges[::2], edges[1::2] = starts, ends + 1
    padded = np.append(values, np.uint8(LONGEST))
    return np.minimum.reduceat(padded, edges)[::2].astype(np.int16)


def _merged(bwt, lcp, place: np.ndarray, symbol: np.ndarray, before: np.ndarray, after: np.ndarray):
    """The next files: new suffixes at ``place``, and a new common prefix for the suffix behind each that has one in ``after``."""
    new_bwt, new_lcp = tempfile.SpooledTemporaryFile(SPOOL), tempfile.SpooledTemporaryFile(SPOOL)
    gap = place - np.arange(len(place))
    before = np.minimum(before, LONGEST).astype(np.uint8)
    behind, value = place[after >= 0] + 1, np.minimum(after[after >= 0], LONGEST).astype(np.uint8)
    lo, out = 0, 0
    size = bwt.seek(0, 2)
    for b, h in zip(_chunks(bwt), _chunks(lcp)):
        hi = lo + len(b)
        a, z = np.searchsorted(gap, [lo, hi if hi < size else hi + 1])
        spot = gap[a:z] - lo
        new_bwt.write(np.insert(b, spot, symbol[a:z]).tobytes())
        mixed = np.insert(h, spot, before[a:z])
        x, y = np.searchsorted(behind, [out, out + len(mixed)])
        mixed[behind[x:y] - out] = value[x:y]
        new_lcp.write(mixed.tobytes())
        lo, out = hi, out + len(mixed)
    bwt.close()
    lcp.close()
    return new_bwt, new_lcp


def suffixes(found: Collection, lengths: np.ndarray, tail: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(string, offset) of every suffix in order, by walking all strings backwards at once."""
    inserted = np.ones(len(found.bwt), bool)
    inserted[found.tails] = False
    order = np.argsort(found.bwt, kind="stable")
    begun = order[int((found.bwt == 0).sum()) :]
    # The suffix that the symbol at a place begins; a symbol 0 begins none.
    next_place = np.empty(len(found.bwt), np.int64)
    next_place[begun] = np.flatnonzero(inserted)
    string, offset = np.empty(len(found.bwt), np.int64), np.empty(len(found.bwt), np.int64)
    who, at = found.owners, found.tails
    left = lengths[who] - tail
    while len(who):
        string[at], offset[at] = who, left
        going = left > 0
        who, at, left = who[going], next_place[at[going]], left[going] - 1
    return string, offset
