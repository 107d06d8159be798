"""Benchmark passages in documents, found by the q-gram lemma and verified by banded alignment.

Texts and items are lower-cased and their white space is reduced to single spaces. An item is
cut into overlapping pieces of ``PIECE`` characters (a shorter item is one piece), so that an edited
passage of an item is found too. A piece of ``m`` characters may be edited in ``k = m // 10`` places.
Longer items are also cut into short pieces of ``SHORT`` characters at so small a stride that every passage of
``PASSAGE`` characters, wherever it begins, holds a whole one; these may be edited in ``m // 25`` places.
If it occurs, then piece and place share at least ``m - q + 1 - k * q`` of their q-grams, on
diagonals (place in the text less place in the piece) that lie within ``k`` of each other.
Diagonals are put into bands of twice that width which overlap by half, so one band holds
them all. Bands that reach the bound are aligned; an edit distance of at most ``k`` is a leak.

The items are a query set against all documents: they go to every task in parts of at most
``PART_CHARS`` characters, each a pass over the documents, so what is sent has a fixed bound.

Defined results: null or empty texts and items leak nothing; items shorter than ``q`` characters
must occur as they are; repeated rows of a document or an item give one row for each (doc_id, item_id);
null ids are kept as such; without documents or items there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_batch, arrow_schema, pairs, table, texts
from .hashing import mixed, powers

Q, PIECE, EDITS = 8, 100, 0.1
#: The shortest copied passage that must be caught, and the pieces and edits that catch it.
PASSAGE, SHORT, SHORT_EDITS = 60, 50, 0.04
#: A character of an item is in six or seven pieces.
PART_CHARS = 1_200_000
#: Characters of text per round of array work, which takes some 150 bytes for each.
GROUP = 1 << 18
#: Documents per round, as each takes a gap of its own.
ROWS = 512
LEAKS = "doc_id bigint, item_id bigint, start bigint, end bigint, distance bigint, length bigint"


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """Hash of the ``q`` code points from each place on."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mixed(codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)], out=sums[1:])
    return mixed((sums[q:] - sums[:-q]) * down[:n])


class Pieces(NamedTuple):
    """The pieces of all items and their q-grams, sorted."""

    items: list[int | None]
    codes: list[np.ndarray]
    budgets: np.ndarray
    least: np.ndarray
    grams: np.ndarray
    begins: np.ndarray
    piece: np.ndarray
    place: np.ndarray
    sieve: np.ndarray
    short: list[tuple[int | None, str]]


def pieces_of(items: list[tuple[int | None, str]], q: int = Q, size: int = PIECE, edits: float = EDITS) -> Pieces:
    names, codes, shares, short = [], [], [], []
    for item, text in items:
        text = normal(text or "")
        if len(text) < q:
            short += [(item, text)] if text else []
            continue
        whole = code_points(text)
        for start in sorted({*range(0, max(1, len(whole) - size + 1), size // 2), max(0, len(whole) - size)}):
            names.append(item)
            codes.append(whole[start : start + size])
            shares.append(edits)
        # Every passage of PASSAGE characters holds a whole one of these, also the last.
        for start in sorted({*range(0, len(whole) - SHORT, PASSAGE - SHORT + 1), len(whole) - SHORT}) if len(whole) > SHORT else ():
            names.append(item)
            codes.append(whole[start : start + SHORT])
            shares.append(min(edits, SHORT_EDITS))
    lengths = np.array([len(c) for c in codes], np.int64)
    # A budget that leaves the lemma at least one q-gram.
    budgets = np.minimum((lengths * np.array(shares)).astype(np.int64), (lengths - q) // q)
    least = lengths - q + 1 - budgets * q
    hashes = [gram_hashes(c, q) for c in codes] or [np.empty(0, np.uint64)]
    every = np.concatenate(hashes)
    piece = np.repeat(np.arange(len(codes)), [len(h) for h in hashes][: len(codes)]) if codes else np.empty(0, np.int64)
    place = np.concatenate([np.arange(len(h)) for h in hashes])
    order = np.argsort(every, kind="stable")
    grams, begins = np.unique(every[order], return_index=True)
    sieve = np.zeros(1 << 24, bool)
    sieve[(grams >> np.uint64(40)).astype(np.int64)] = True
    return Pieces(names, codes, budgets, least, grams, np.append(begins, len(every)), piece[order], place[order], sieve, short)


def candidates(codes: np.ndarray, p: Pieces, q: int) -> list[tuple[int, int]]:
    """(piece, first diagonal of a band) of every band that reaches the lemma's bound."""
    hashes = gram_hashes(codes, q)
    hit = np.flatnonzero(p.sieve[(hashes >> np.uint64(40)).astype(np.int64)])
    if not len(hit) or not len(p.grams):
        return []
    gram = np.minimum(np.searchsorted(p.grams, hashes[hit]), len(p.grams) - 1)
    real = p.grams[gram] == hashes[hit]
    hit, gram = hit[real], gram[real]
    # A leak brings its hits within one piece's length: places with fewer hits around can't be part of one.
    reach = 2 * max((len(c) for c in p.codes), default=0)
    dense = np.searchsorted(hit, hit + reach, "right") - np.searchsorted(hit, hit - reach) >= p.least.min(initial=1 << 40)
    hit, gram = hit[dense], gram[dense]
    many = p.begins[gram + 1] - p.begins[gram]
    if not many.sum():
        return []
    entry = np.repeat(p.begins[gram] - np.cumsum(many) + many, many) + np.arange(many.sum())
    piece, diagonal = p.piece[entry], np.repeat(hit, many) - p.place[entry]
    width = 2 * p.budgets[piece] + 1
    # Diagonals begin below zero where a text begins within a piece.
    band = (diagonal + (1 << 20)) // width
    key = np.concatenate([piece << 40 | band, piece << 40 | (band - 1)])
    found, count = np.unique(key, return_counts=True)
    which = found >> 40
    good = count >= p.least[which]
    return [(w, int(b) * (2 * int(p.budgets[w]) + 1) - (1 << 20)) for w, b in zip(which[good].tolist(), (found[good] & ((1 << 40) - 1)).tolist())]


def banded(rows: np.ndarray, lengths: np.ndarray, text: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(edit distance, end in the text) of the best place of each padded piece within its band of diagonals.

    ``first``: the band's first diagonal. Places outside the text hold 0, which no piece has.
    """
    n, longest = rows.shape
    at = first[:, None] + np.arange(width + longest)
    near = np.where((at >= 0) & (at < len(text)), text[np.clip(at, 0, len(text) - 1)], 0)
    # Column b is kept as cost less b: an added text character then costs nothing, a left out one 2.
    offsets = np.arange(width, dtype=np.int16)
    cost = np.tile(-offsets, (n, 1))
    best, end = np.full(n, 1 << 20, np.int64), np.zeros(n, np.int64)
    for i in range(longest):
        step = cost + (near[:, i : i + width] != rows[:, i : i + 1])
        np.minimum(step[:, :-1], cost[:, 1:] + np.int16(2), out=step[:, :-1])
        cost = np.minimum.accumulate(step, axis=1)
        done = lengths == i + 1
        if done.any():
            whole = cost[done] + offsets
            best[done] = whole.min(axis=1)
            end[done] = first[done] + i + 1 + whole.argmin(axis=1)
    return best, end


def leaks_in(ids: list[int | None], held: list[str], p: Pieces, q: int = Q) -> Iterator[tuple]:
    """Leaks in some documents: (doc_id, item_id, start, end, distance, length of the piece)."""
    for doc, text in zip(ids, held):
        for item, short in p.short:
            if (at := text.find(short)) >= 0:
                yield doc, item, at, at + len(short), 0, len(short)
    if not p.codes:
        return
    reach = max(len(c) for c in p.codes) * 2
    gap = "\0" * reach
    codes = code_points(gap.join(held) + gap)
    begins = np.cumsum([0] + [len(t) + reach for t in held])
    found = candidates(codes, p, q)
    for at in range(0, len(found), 256):
        part = found[at : at + 256]
        which = np.array([w for w, _ in part])
        lengths = np.array([len(p.codes[w]) for w in which])
        rows = np.full((len(part), lengths.max()), 1 << 30, np.uint32)
        for row, w in zip(rows, which):
            row[: len(p.codes[w])] = p.codes[w]
        budget = p.budgets[which]
        width = int(2 * (2 * budget.max() + 1) + 2 * budget.max())
        first = np.array([b for _, b in part]) - budget.max()
        distance, end = banded(rows, lengths, codes, first, width)
        for w, d, e, k, m in zip(which, distance, end, budget, lengths):
            if d <= k:
                doc = int(np.searchsorted(begins, e - 1, "right")) - 1
                stop = int(e - begins[doc])
                yield ids[doc], p.items[w], max(0, stop - int(m)), stop, int(d), int(m)


def groups(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch that end with the row that brings them to ``GROUP`` characters of column ``at``, or to ``ROWS`` rows."""
    start = size = 0
    for n, chars in enumerate(pc.utf8_length(batch.column(at)).to_pylist(), 1):
        size += chars or 0
        if size >= GROUP or n - start == ROWS or n == batch.num_rows:
            yield batch.slice(start, n - start)
            start, size = n, 0


def _scan(part, q: int):
    out = arrow_schema(LEAKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        held: list[str] = []
        size = 0
        for doc_id, text in pairs(batches):
            ids.append(doc_id)
            held.append(normal(text))
            size += len(text)
            if size >= GROUP or len(ids) == ROWS:
                yield as_batch(list(leaks_in(ids, held, part.value, q)), out)
                ids, held, size = [], [], 0
        yield as_batch(list(leaks_in(ids, held, part.value, q)), out)

    return run


def _parts(items: DataFrame, q: int, size: int, edits: float, part_chars: int) -> Iterator[Broadcast]:
    """The items' pieces in parts of bounded size, each sent to every executor."""
    items = texts(items, key="item_id").distinct()
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    parts = int(chars) // part_chars + 1
    for n in range(parts):
        mine = items.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)) == n)
        yield items.sparkSession.sparkContext.broadcast(pieces_of([tuple(r) for r in mine.toLocalIterator()], q, size, edits))


def keep_clean(docs: DataFrame, items: DataFrame, q: int = Q, size: int = PIECE, edits: float = EDITS, part_chars: int = PART_CHARS) -> DataFrame:
    """The documents without any leak, with all their columns; each row is judged where it is."""
    at = docs.columns.index("text")

    def without(part: Broadcast):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rows in groups(batch, at):
                    held = [normal(x or "") for x in rows.column(at).to_pylist()]
                    leaky = {i for i, *_ in leaks_in(list(range(len(held))), held, part.value, q)}
                    yield rows.filter(pa.array([i not in leaky for i in range(len(held))]))

        return run

    for known in _parts(items, q, size, edits, part_chars):
        docs = docs.mapInArrow(without(known), docs.schema)
    return docs


def find_leaks(docs: DataFrame, items: DataFrame, q: int = Q, size: int = PIECE, edits: float = EDITS, part_chars: int = PART_CHARS) -> DataFrame:
    """The best leak of each (doc_id, item_id): place in the normalised text, edit distance, and length of the piece."""
    rows, found = texts(docs), None
    for known in _parts(items, q, size, edits, part_chars):
        leaks = rows.mapInArrow(_scan(known, q), LEAKS)
        found = leaks if found is None else found.union(leaks)
    order = F.struct(F.col("distance"), F.col("start"), F.col("end"), F.col("length"))
    best = found.groupBy("doc_id", "item_id").agg(F.count("*").alias("n_pieces"), F.min(order).alias("best"))
    return best.select("doc_id", "item_id", "best.start", "best.end", "best.distance", "best.length", "n_pieces")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
