"""Removal of repeated word windows: a count-min sketch first, exact groups for what it leaves.

1. Every block of documents (``blocks``) sketches its distinct windows: the window's hash chooses a
   slice of the sketch, and in each of the slice's ``ROWS`` rows one cell. A cell counts the documents
   of the block that hold one of its windows.
2. A slice adds the sketches of all blocks cell by cell and tells each block which of its cells
   count two or more. A window's estimate is its least cell, never below the true
   number of documents, so that no repeated window is lost.
3. Only windows estimated repeated go on. A bucket groups them exactly, by 128-bit keys, and tells each
   block for which of them another block has a smaller document id.

Cells are ``CELLS`` times the windows a slice gets, and the number of slices follows the size of the
corpus and the cluster's partitions, so the share of windows let through by mistake is the same
at every size (about 5 %), and a slice stays small. A block sends a cell or window once, however many of its
documents hold it; a window that a third of all documents hold costs one entry a block.

Exact means equal 128-bit keys, made of 64-bit hashes of the words: two unlike windows that differ
in one word meet with a chance of 2**-64.

Words are split at white space and compared unchanged. A window never crosses documents.

Defined results: null text counts as empty, with no words and the empty string kept; a document of fewer words than a
window keeps all; rows of the same id don't remove each other's words; a row without id neither
removes nor loses words; white space between kept words becomes one space; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import BLOCK_BYTES, EXCHANGE, answered, bucket_count, by_bucket, exchange_batch, finished, in_blocks, key_row, numbered, own_row, pack_ids, squeeze, squeeze_bytes, squeeze_sorted, unpack_ids, unsqueeze, unsqueeze_bytes, unsqueeze_sorted
from .common import arrow_schema, as_batch, table, texts
from .hashing import BASE, groups_of, mixed, word_hashes

WINDOW = 13
#: Rows of the sketch, cells of a row for each expected window, and windows a slice should get at most.
ROWS, CELLS, SLICE_WINDOWS = 2, 4, 1 << 22
#: Expected bytes for each window; only the sketch's size, never a result, depends on it.
BYTES_PER_WINDOW = 6
KEPT = "doc_id bigint, n_words bigint, n_removed bigint, kept string"
_ROW_SEEDS = np.array([0x8BADF00D5EED0001, 0x5CA1AB1E5EED0002, 0x0DDBA11D5EED0003, 0x7E57AB1E5EED0004], np.uint64)
_OTHER_BASE, _OTHER_SALT = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
_NO_ID = np.iinfo(np.int64).max


class Windows:
    """All windows of a block's texts, and the distinct ones in ascending order of their keys."""

    def __init__(self, held: list[bytes], width: int):
        words, doc, at, one, two = [], [], [], [], []
        for first, group in groups_of(held):
            of, word = word_hashes(group)
            m = max(0, len(word) - width + 1)
            a, b, other = np.zeros(m, np.uint64), np.zeros(m, np.uint64), mixed(word ^ _OTHER_SALT)
            for k in range(width):
                a = a * BASE + word[k : k + m]
                b = b * _OTHER_BASE + other[k : k + m]
            inside = np.flatnonzero(of[:m] == of[len(of) - m :])
            doc.append(of[inside] + first)
            at.append(inside + sum(map(len, words)))
            one.append(mixed(a[inside]))
            two.append(b[inside])
            words.append(of + first)
        self.n_words = np.bincount(np.concatenate(words) if words else [], minlength=len(held)).astype(np.int64)
        self.doc, self.at, key, second = (np.concatenate(x) if x else np.empty(0, k) for x, k in ((doc, np.int64), (at, np.int64), (one, np.uint64), (two, np.uint64)))
        order = np.lexsort((second, key))
        key, second = key[order], second[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (second[1:] != second[:-1])
        self.starts = np.flatnonzero(new)
        self.keys, self.seconds = key[self.starts], second[self.starts]
        self.order = order
        #: Number of the distinct window at each place.
        self.which = np.empty(len(key), np.int64)
        self.which[order] = np.cumsum(new) - 1

    def documents(self) -> np.ndarray:
        """How many of the block's documents hold each distinct window; two stands for two and more."""
        doc = self.doc[self.order]
        least, most = (f.reduceat(doc, self.starts) if len(doc) else doc for f in (np.minimum, np.maximum))
        return np.where(least < most, 2, 1).astype(np.uint8)

    def least_ids(self, ids: np.ndarray) -> np.ndarray:
        return np.minimum.reduceat(ids[self.doc][self.order], self.starts) if len(self.doc) else np.empty(0, np.int64)


def cells_of(keys: np.ndarray, row: int, cells: int) -> np.ndarray:
    """Cell of each key in one row of its slice."""
    return (mixed(keys ^ _ROW_SEEDS[row]) % np.uint64(cells)).astype(np.int64)


def cell_lists(keys: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct cells that a slice's keys fall on, rows one after another, and where each key's cells stand in them."""
    every = np.concatenate([cells_of(keys, row, cells) + row * cells for row in range(ROWS)])
    distinct, where = np.unique(every, return_inverse=True)
    return distinct, where.reshape(ROWS, len(keys))


def _sketches(slices: int, cells: int, width: int, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, held in in_blocks(batches, block_bytes):
            found = Windows([t.encode() for t in held], width)
            documents = found.documents()
            rows = []
            ends = by_bucket(found.keys, slices)
            for n in np.flatnonzero(np.diff(ends)).tolist():
                mine = slice(ends[n], ends[n + 1])
                distinct, where = cell_lists(found.keys[mine], cells)
                counts = np.minimum(np.bincount(where.ravel(), np.tile(documents[mine], ROWS), len(distinct)), 2)
                rows.append(key_row(block, n, squeeze_sorted(distinct.astype(np.uint64)), zstandard.compress(counts.astype(np.uint8).tobytes())))
            if rows:
                yield exchange_batch(rows)

    return run


def _own(block_bytes: int):
    """The block's texts. They are read again instead of travelling with the requests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, held in in_blocks(batches, block_bytes):
            yield exchange_batch([own_row(block, squeeze_bytes([t.encode() for t in held]), squeeze_bytes([block.encode(), pack_ids(ids)]))])

    return run


def _merge(cells: int):
    """A slice's answer: for each cell of each request whether all blocks together count two or more there."""

    def run(data: list[bytes], more: list[bytes]) -> Iterator[bytes]:
        asked = [unsqueeze_sorted(x).astype(np.int64) for x in data]
        total = np.zeros(ROWS * cells, np.uint8)
        for at, counts in zip(asked, more):
            total[at] = np.minimum(total[at] + np.frombuffer(zstandard.decompress(counts), np.uint8), 2)
        for at in asked:
            yield zstandard.compress(np.packbits(total[at] >= 2).tobytes())

    return run


def _with_ids(ids: list[int | None]) -> np.ndarray:
    return np.array([_NO_ID if i is None else i for i in ids], np.int64)


def _estimated(slices: int, cells: int, width: int):
    """A block's second request: its windows estimated repeated, with the block's least document id for each."""

    def run(data: bytes, more: bytes, replies: list[bytes]) -> Iterator[pa.RecordBatch]:
        found = Windows(unsqueeze_bytes(data), width)
        name, packed = unsqueeze_bytes(more)
        least = found.least_ids(_with_ids(unpack_ids(packed)))
        ends = by_bucket(found.keys, slices)
        repeated = np.zeros(len(found.keys), bool)
        for n, reply in zip(np.flatnonzero(np.diff(ends)).tolist(), replies, strict=True):
            mine = slice(ends[n], ends[n + 1])
            distinct, where = cell_lists(found.keys[mine], cells)
            often = np.unpackbits(np.frombuffer(zstandard.decompress(reply), np.uint8), count=len(distinct)).astype(bool)
            repeated[mine] = often[where].all(axis=0)
        block = name.decode()
        # In front of the block's texts, which come again.
        rows = [(f"d{block}", block, -2, zstandard.compress(np.packbits(repeated).tobytes()), packed)]
        keys, seconds, least = found.keys[repeated], found.seconds[repeated], least[repeated]
        ends = by_bucket(keys, slices)
        for n in np.flatnonzero(np.diff(ends)).tolist():
            mine = slice(ends[n], ends[n + 1])
            rows.append(key_row(block, n, squeeze_sorted(keys[mine]), squeeze_bytes([squeeze(seconds[mine]), squeeze_ids(least[mine])])))
        yield exchange_batch(rows)

    return run


def squeeze_ids(ids: np.ndarray) -> bytes:
    """Ids as distances from the least one."""
    low = ids.min()
    return int(low).to_bytes(8, "little", signed=True) + squeeze((ids - low).view(np.uint64))


def unsqueeze_ids(data: bytes) -> np.ndarray:
    return unsqueeze(data[8:], np.uint64).view(np.int64) + int.from_bytes(data[:8], "little", signed=True)


def _group(data: list[bytes], more: list[bytes]) -> Iterator[bytes]:
    """A bucket's answer: for each window of each request whether another block has a smaller document id."""
    keys = [unsqueeze_sorted(x) for x in data]
    parts = [unsqueeze_bytes(x) for x in more]
    ids = np.concatenate([unsqueeze_ids(x[1]) for x in parts])
    key, second = np.concatenate(keys), np.concatenate([unsqueeze(x[0], np.uint64) for x in parts])
    order = np.lexsort((second, key))
    key, second = key[order], second[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (second[1:] != second[:-1])
    first = np.minimum.reduceat(ids[order], np.flatnonzero(new))
    later = np.empty(len(key), bool)
    later[order] = first[np.cumsum(new) - 1] < ids[order]
    for part in np.split(later, np.cumsum(list(map(len, keys)))[:-1]):
        yield zstandard.compress(np.packbits(part).tobytes())


def _remove(slices: int, width: int):
    out = arrow_schema(KEPT)

    def run(data: bytes, more: bytes, replies: list[bytes]) -> Iterator[pa.RecordBatch]:
        raw = unsqueeze_bytes(replies.pop(0))
        found = Windows(raw, width)
        given = unpack_ids(more)
        ids = _with_ids(given)
        repeated = np.unpackbits(np.frombuffer(zstandard.decompress(data), np.uint8), count=len(found.keys)).astype(bool)
        sizes = np.diff(by_bucket(found.keys[repeated], slices))
        bits = [np.unpackbits(np.frombuffer(zstandard.decompress(r), np.uint8), count=n) for r, n in zip(replies, sizes[sizes > 0], strict=True)]
        elsewhere = np.zeros(len(found.keys), bool)
        elsewhere[repeated] = np.concatenate(bits).astype(bool) if bits else False
        least = found.least_ids(ids)
        mine = ids[found.doc]
        gone = (elsewhere[found.which] | (least[found.which] < mine)) & (mine != _NO_ID)
        # A word goes if a removed window begins at it or up to width - 1 words before it.
        begun = np.zeros(found.n_words.sum() + width, np.int32)
        begun[found.at[gone]] += 1
        begun[found.at[gone] + width] -= 1
        removed = np.cumsum(begun) > 0
        rows, at = [], 0
        for doc_id, text, n in zip(given, raw, found.n_words.tolist()):
            flags = removed[at : at + n]
            at += n
            words = text.split()
            rows.append((doc_id, n, int(flags.sum()), b" ".join(compress(words, (~flags).tolist()) if flags.any() else words).decode()))
            if len(rows) == 1024:
                yield as_batch(rows, out)
                rows = []
        if rows:
            yield as_batch(rows, out)

    return run


def sketch_size(docs: DataFrame, cells: int = CELLS, slice_windows: int = SLICE_WINDOWS) -> tuple[int, int]:
    """Slices of the sketch, and cells in each of their rows, for the corpus's size."""
    size = texts(docs).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    windows = size // BYTES_PER_WINDOW + 1
    slices = max(bucket_count(docs.sparkSession), -(-windows // slice_windows))
    return slices, max(64, cells * -(-windows // slices))


def remove_repeated_windows(docs: DataFrame, width: int = WINDOW, block_bytes: int = BLOCK_BYTES, size: tuple[int, int] | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, and the kept words of every document.

    A word goes if it lies in a window of ``width`` words whose sequence also starts in a document of a
    smaller id. ``size`` overrides the sketch's slices and cells. ``docs`` is read three times and must come in
    the same order, as a stored table does; another order is an error, not another result.
    """
    slices, cells = size or sketch_size(docs)
    sketches = numbered(docs).mapInArrow(_sketches(slices, cells, width, block_bytes), EXCHANGE)
    own = numbered(docs).mapInArrow(_own(block_bytes), EXCHANGE)
    estimated = finished(answered(sketches, _merge(cells)).union(own), _estimated(slices, cells, width), EXCHANGE)
    return finished(answered(estimated, _group).union(own), _remove(slices, width), KEPT)


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated_windows(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
