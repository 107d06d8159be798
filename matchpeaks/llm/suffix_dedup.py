"""Removal of every repeated string of ``SPAN`` bytes but its first occurrence, exactly, over a whole corpus.

1. *Pieces.* Each window of ``SPAN`` bytes is anchored at the ``GRAM``-byte string of least hash
   inside it (the leftmost, if equal); windows in a row with one anchor make a piece. Equal windows have equal
   anchors at equal distances, so only pieces with equal anchors can share a window.
2. *Counting.* Blocks of documents send each different piece once to the bucket of its
   anchor's hash (``blocks``): hashes of anchor and content, and where it is first. The bucket
   tells each whether the same content starts earlier anywhere, and whether other contents
   have its anchor. All copies of a content but the first are removed as a whole.
3. *Suffixes.* First pieces whose anchor has other contents go to a bucket with their bytes.
   There the collection's Burrows-Wheeler transform and common prefixes are built column by column, one symbol of each
   piece a round (``column_bwt``); neighbours with a common prefix of ``SPAN`` hold the
   same window, and all but its earliest are removed.
4. The block puts a document's removed windows together.

A string that a third of all documents holds comes once per block in step 2, and once in
step 3 for each different surrounding. Blocks are stored once, so that steps can be run again after
a lost executor, and nothing is collected.

"Earlier" means a smaller doc_id, or the same doc_id and an earlier start. Defined results:
null text counts as empty; texts shorter than ``SPAN`` bytes lose nothing; rows that share an id
are compared by place only, so identical rows keep their bytes alike; a null id comes after
all others; overlapping occurrences count; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import EXCHANGE, answered, bucket_count, by_bucket, exchange_batch, finished, in_blocks, key_row, numbered, own_row, pack_ids, squeeze, squeeze_bytes, squeeze_sorted, unpack_ids, unsqueeze, unsqueeze_bytes, unsqueeze_sorted
from .column_bwt import collection, suffixes
from .common import arrow_schema, as_batch, stored, table
from .hashing import groups_of, mixed, powers, prefix_sums, stretch_hashes

SPAN, GRAM = 100, 24
#: Characters of a block: it is one row of several exchanges, and large rows cost much memory.
BLOCK = 4 << 20
LAST = np.iinfo(np.int64).max
KEPT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
DIGESTS = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
EARLIER, SHARED = 1, 2


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each window of ``width``: minima to both sides of every ``width``-th place."""
    n = len(values) - width + 1
    rows = np.append(values, np.full(-len(values) % width, np.iinfo(np.uint64).max, np.uint64)).reshape(-1, width)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.ascontiguousarray(np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1]).ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def pieces(docs: list[bytes], span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(anchor hash, content hash, document, start, length) of every piece, by document and start.

    Anchors have the least hashes of their windows; hashed once more, they spread over all buckets.
    """
    parts: list[list[np.ndarray]] = [[], [], [], [], []]
    for first, group in groups_of(docs):
        data = np.frombuffer(b"".join(group), np.uint8)
        if len(data) < span:
            continue
        lengths = np.fromiter(map(len, group), np.int64, len(group))
        ends = np.cumsum(lengths)
        sums = prefix_sums(data)
        n = len(data) - gram + 1
        grams = mixed((sums[gram:] - sums[:-gram]) * powers(len(sums))[1][:n])
        # The upper half of the hash decides, then the place: the leftmost of equal ones.
        least = window_minimum(grams >> np.uint64(32) << np.uint64(32) | np.arange(n, dtype=np.uint64), span - gram + 1)
        start = np.flatnonzero(np.repeat(ends, lengths)[: len(least)] - np.arange(len(least)) >= span)
        anchor = (least[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        new = np.ones(len(start), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
        at = np.flatnonzero(new)
        begin, end = start[at], (start[np.append(at[1:], len(start)) - 1] + span) if len(at) else start
        doc = np.searchsorted(ends, begin, "right")
        for part, values in zip(parts, (mixed(~grams[anchor[at]]), stretch_hashes(sums, begin, end), doc + first, begin - (ends - lengths)[doc], end - begin)):
            part.append(values)
    kinds = (np.uint64, np.uint64, np.int64, np.int64, np.int64)
    return tuple(np.concatenate([np.empty(0, k), *p]) for p, k in zip(parts, kinds))


def _changes(*columns: np.ndarray) -> np.ndarray:
    """True where a row differs from the one before in any column."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return new


def _ranked_pieces(docs: list[bytes], ids: list[int | None], span: int, gram: int):
    """Pieces sorted by anchor, content and place, and which begin a new content."""
    anchor, content, doc, start, length = pieces(docs, span, gram)
    key = np.array([LAST if i is None else i for i in ids], np.int64)[doc]
    order = np.lexsort((start, key, content, anchor))
    anchor, content, doc, start, length, key = (x[order] for x in (anchor, content, doc, start, length, key))
    return anchor, content, doc, start, length, key, _changes(anchor, content)


def _blocks(block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, held in in_blocks(batches, block_bytes):
            yield exchange_batch([own_row(block, squeeze_bytes([t.encode() for t in held]), pack_ids(ids))])

    return run


def _join(*parts: bytes) -> bytes:
    return b"".join(len(p).to_bytes(4, "little") + p for p in parts)


def _split(data: bytes) -> list[bytes]:
    parts, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 4], "little")
        parts.append(data[at + 4 : at + 4 + n])
        at += 4 + n
    return parts


def _requests(buckets: int, span: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data, more in zip(*(batch.column(c).to_pylist() for c in range(3))):
                anchor, content, _, start, _, key, new = _ranked_pieces(unsqueeze_bytes(data), unpack_ids(more), span, gram)
                anchor, content, start, key = anchor[new], content[new], start[new], key[new]
                rows = []
                for b, (x, y) in enumerate(pairwise(by_bucket(anchor, buckets))):
                    if y > x:
                        rows.append(key_row(block, b, squeeze_sorted(anchor[x:y]), _join(squeeze(content[x:y]), squeeze(key[x:y]), squeeze(start[x:y].astype(np.uint32)))))
                if rows:
                    yield exchange_batch(rows)

    return run


def judged(data: list[bytes], more: list[bytes]) -> Iterator[bytes]:
    """For each asked piece: does its content start earlier elsewhere, and is it a first one whose anchor has other contents?"""
    anchors = [unsqueeze_sorted(x) for x in data]
    rest = [_split(x) for x in more]
    anchor = np.concatenate(anchors)
    content, key = (np.concatenate([unsqueeze(r[i], kind) for r in rest]) for i, kind in ((0, np.uint64), (1, np.int64)))
    start = np.concatenate([unsqueeze(r[2], np.uint32) for r in rest]).astype(np.int64)
    order = np.lexsort((start, key, content, anchor))
    a, c, k, s = anchor[order], content[order], key[order], start[order]
    new_anchor, new_content = _changes(a), _changes(a, c)
    first = np.flatnonzero(new_content)[np.cumsum(new_content) - 1]
    earlier = (k != k[first]) | (s != s[first])
    contents = np.bincount(np.cumsum(new_anchor) - 1, new_content)[np.cumsum(new_anchor) - 1]
    flags = np.empty(len(order), np.uint8)
    flags[order] = np.where(earlier, EARLIER, np.where(contents > 1, SHARED, 0))
    return (squeeze(part) for part in np.split(flags, np.cumsum([len(x) for x in anchors])[:-1]))


def _spans(doc: np.ndarray, start: np.ndarray, length: np.ndarray) -> bytes:
    return _join(*(squeeze(x.astype(np.uint32)) for x in (doc, start, length)))


def _unspans(data: bytes) -> list[np.ndarray]:
    return [unsqueeze(x, np.uint32).astype(np.int64) for x in _split(data)]


def _shared_pieces(buckets: int, span: int, gram: int):
    """Known removals of the block (bucket -1), and the bytes of the pieces to compare."""

    def run(data: bytes, more: bytes, replies: list[bytes]) -> Iterator[pa.RecordBatch]:
        block, more = more[4 : 4 + more[0]].decode(), more[4 + more[0] :]
        docs, ids = unsqueeze_bytes(data), unpack_ids(more)
        anchor, _, doc, start, length, key, new = _ranked_pieces(docs, ids, span, gram)
        flags = np.concatenate([np.empty(0, np.uint8), *(unsqueeze(r, np.uint8) for r in replies)])
        which = np.cumsum(new) - 1
        head = np.flatnonzero(new)[which] if len(new) else which
        tied = (key == key[head]) & (start == start[head])
        gone = ~tied | (flags[which] == EARLIER)
        rows = [own_row(block, _spans(doc[gone], start[gone], length[gone]), b"")]
        asked = np.flatnonzero(tied & (flags[which] == SHARED))
        for b, (x, y) in enumerate(pairwise(by_bucket(anchor[asked], buckets))):
            if y > x:
                mine = asked[x:y]
                bytes_ = squeeze_bytes([docs[d][s : s + n] for d, s, n in zip(doc[mine].tolist(), start[mine].tolist(), length[mine].tolist())])
                rows.append(key_row(block, b, bytes_, _join(squeeze(doc[mine].astype(np.uint32)), squeeze(start[mine].astype(np.uint32)), squeeze(key[mine]))))
        yield exchange_batch(rows)

    return run


def repeated_windows(strings: list[bytes], key: np.ndarray, start: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(string, offset) of every window of ``span`` bytes that also occurs at an earlier (key, start + offset)."""
    data = np.frombuffer(b"".join(strings), np.uint8)
    used = np.unique(data)
    code = np.zeros(256, np.uint8)
    code[used] = np.arange(1, len(used) + 1)
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    # UTF-8 leaves some byte values unused, so the codes fit a byte with 0 to spare.
    found = collection(np.split(code[data], np.cumsum(lengths)[:-1]), len(used) + 1, span - 1)
    string, offset = suffixes(found, lengths, span - 1)
    long = lengths[string] - offset >= span
    run = np.cumsum(found.lcp < span) - 1
    rank = np.unique(key, return_inverse=True)[1]
    place = rank[string] << 32 | (start[string] + offset)
    place[~long] = LAST
    least = np.minimum.reduceat(place, np.flatnonzero(found.lcp < span)) if len(place) else place
    gone = long & (place > least[run])
    return string[gone], offset[gone]


def _compared(span: int):
    def run(data: list[bytes], more: list[bytes]) -> Iterator[bytes]:
        strings = [unsqueeze_bytes(x) for x in data]
        rest = [_split(x) for x in more]
        doc, start = (np.concatenate([unsqueeze(r[i], np.uint32) for r in rest]).astype(np.int64) for i in (0, 1))
        key = np.concatenate([unsqueeze(r[2], np.int64) for r in rest])
        string, offset = repeated_windows([s for part in strings for s in part], key, start, span)
        order = np.lexsort((offset, string))
        string, offset = string[order], offset[order]
        new = np.ones(len(string), bool)
        new[1:] = (string[1:] != string[:-1]) | (offset[1:] != offset[:-1] + 1)
        at = np.flatnonzero(new)
        length = np.diff(np.append(at, len(string))) + span - 1
        string, offset = string[at], offset[at]
        asker = np.searchsorted(np.cumsum([len(part) for part in strings]), string, "right")
        for i in range(len(strings)):
            mine = asker == i
            yield _spans(doc[string[mine]], start[string[mine]] + offset[mine], length[mine])

    return run


def _cut(span: int, schema: str, digests: bool):
    out = arrow_schema(schema)

    def run(data: bytes, more: bytes, replies: list[bytes]) -> Iterator[pa.RecordBatch]:
        docs, ids = unsqueeze_bytes(data), unpack_ids(more[4 + more[0] :])
        doc, start, length = (np.concatenate(x) for x in zip(*map(_unspans, replies)))
        order = np.argsort(doc, kind="stable")
        doc, start, end = doc[order], start[order], (start + length)[order]
        ends = np.searchsorted(doc, np.arange(len(docs) + 1))
        rows = []
        for i, text in enumerate(docs):
            a, z = ends[i], ends[i + 1]
            kept, n_spans = text, 0
            if z > a:
                change = np.bincount(start[a:z], minlength=len(text) + 1) - np.bincount(end[a:z], minlength=len(text) + 1)
                keep = np.cumsum(change[: len(text)]) == 0
                kept = np.frombuffer(text, np.uint8)[keep].tobytes()
                n_spans = int((np.diff(keep.astype(np.int8), prepend=1) == -1).sum())
            rows.append((ids[i], len(text), len(text) - len(kept), n_spans, hashlib.sha256(kept).hexdigest() if digests else kept))
        yield as_batch(rows, out)

    return run


def remove_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM, digests: bool = False, block_bytes: int = BLOCK) -> DataFrame:
    """What is left of every document, or its digest, with the numbers of removed bytes and runs."""
    buckets, schema = bucket_count(docs.sparkSession), DIGESTS if digests else KEPT
    blocks = stored(numbered(docs).mapInArrow(_blocks(block_bytes), EXCHANGE), "blocks")
    # A block's own row names its block to the steps that get no key.
    own = blocks.withColumn("more", F.concat(F.concat(F.expr("unhex(lpad(hex(length(block)), 2, '0'))"), F.unhex(F.lit("000000"))), F.encode("block", "UTF-8"), F.col("more")))
    requests = blocks.select("block", "data", "more").mapInArrow(_requests(buckets, span, gram), EXCHANGE)
    told = answered(requests, judged).union(own)
    shared = finished(told, _shared_pieces(buckets, span, gram), EXCHANGE)
    removed = answered(shared, _compared(span)).union(own.withColumn("bucket", F.lit(-2)))
    return finished(removed, _cut(span, schema, digests), schema)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), digests=True)
