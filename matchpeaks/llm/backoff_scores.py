"""Stupid-backoff scores of every document under the n-gram counts of all other documents.

Counts of all n-grams up to ``ORDER`` words are tables partitioned by hash: each block of
documents sends its distinct n-grams with their counts to the hash buckets, the buckets add
them up and answer, and the block joins the answers to the n-grams of its documents
(``blocks``). A document's own n-grams are taken off the counts, as else nothing would ever
back off.

At a place with ``k`` words of history in reach, the longest n-gram that other documents know
gives ``count / count of its history``, times ``DISCOUNT`` for each order dropped; a single word is
divided by all words of the other documents, and an unknown word counts one. The logarithms are summed over the document.

Words are split at white space, A-Z in lower case; n-grams don't cross documents.

Defined results: null text counts as empty; a document without words has sum 0 and a null mean;
repeated rows are documents of their own, each known to the other; a corpus of one document backs off to unknown words
everywhere; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .blocks import BLOCK_BYTES, EXCHANGE, answered, bucket_count, by_bucket, exchange_batch, finished, in_blocks, key_row, merged_counts, numbered, own_row, pack_ids, squeeze, squeeze_bytes, squeeze_sorted, unpack_ids, unsqueeze, unsqueeze_bytes
from .common import arrow_schema, as_batch, table
from .hashing import BASE, groups_of, mixed, word_hashes

ORDER, DISCOUNT = 3, 0.4
#: Under this key the number of all words is counted.
TOTAL = np.uint64(0)
SCORES = "doc_id bigint, n_words bigint, log_score double, mean_log_score double, n_known array<bigint>, n_unknown bigint"


def ngrams(texts_: list[bytes], order: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(document of each word, for each order the hash of the n-gram that ends at it).

    Where a document has too few words before a place, the key is 0.
    """
    docs, words = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for first, group in groups_of(texts_):
        doc, word = word_hashes(group)
        docs.append(doc + first)
        words.append(word)
    doc, word = np.concatenate(docs), np.concatenate(words)
    keys = []
    rolled = np.zeros(len(word), np.uint64)
    for k in range(order):
        # The n-gram ending at i: the words i-k .. i, the first taken in last.
        before = np.concatenate([np.zeros(min(k, len(word)), np.uint64), word[: len(word) - k]])
        inside = np.concatenate([np.zeros(min(k, len(word)), bool), doc[k:] == doc[: len(doc) - k]])
        rolled = rolled * BASE + before
        keys.append(np.where(inside, mixed(rolled + np.uint64(k + 1)) | np.uint64(1), TOTAL))
    return doc, keys


def _requests(buckets: int, block_bytes: int, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, held in in_blocks(batches, block_bytes):
            lowered = [text.encode().lower() for text in held]
            doc, grams = ngrams(lowered, order)
            every = np.concatenate([g[g != TOTAL] for g in grams])
            keys, counts = np.unique(every, return_counts=True)
            keys, counts = np.concatenate([[TOTAL], keys]), np.concatenate([[len(doc)], counts])
            rows = []
            for b, (start, end) in enumerate(pairwise(by_bucket(keys, buckets))):
                if end > start:
                    rows.append(key_row(block, b, squeeze_sorted(keys[start:end]), squeeze(counts[start:end].astype(np.uint32))))
            yield exchange_batch(rows)

    return run


def _blocks(block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, held in in_blocks(batches, block_bytes):
            yield exchange_batch([own_row(block, squeeze_bytes([text.encode().lower() for text in held]), pack_ids(ids))])

    return run


def _without_own(doc: np.ndarray, grams: list[np.ndarray], totals: np.ndarray) -> list[np.ndarray]:
    """For each order the counts of each place's n-gram in the other documents (0 where there is no n-gram).

    ``totals`` are those of the block's keys in ascending order, ``TOTAL`` first. One sort serves all orders: it is
    stable, so the places of a key come by document, and a document's own count is the length of its run.
    """
    every = np.concatenate([np.array([TOTAL]), *grams])
    order = np.argsort(every, kind="stable").astype(np.int32)
    key = every[order]
    new_key = np.concatenate([[True], key[1:] != key[:-1]])
    none = every == TOTAL
    del every, key
    short = doc.astype(np.int32)
    of = np.concatenate([np.array([-1], np.int32), *[short] * len(grams)])[order]
    new_run = new_key | np.concatenate([[True], of[1:] != of[:-1]])
    own = np.diff(np.flatnonzero(new_run), append=len(of))
    others = np.empty(len(of), np.int64)
    others[order] = totals[np.cumsum(new_key, dtype=np.int32) - 1] - np.repeat(own, own)
    others[none] = 0
    return np.split(others[1:], len(grams))


def place_scores(doc: np.ndarray, counts: list[np.ndarray], totals: np.ndarray, discount: float) -> tuple[np.ndarray, np.ndarray]:
    """(logarithm of the score, order used; 0 for unknown words) of each place. ``totals``: words of the other documents."""
    n = len(doc)
    reach = np.zeros(n, np.int64)
    begins = np.flatnonzero(np.diff(doc, prepend=-1))
    reach = np.minimum(np.arange(n) - np.repeat(begins, np.diff(np.append(begins, n))) + 1, len(counts))
    whole = np.maximum(totals, 1).astype(float)
    used = np.zeros(n, np.int64)
    score = 1.0 / whole
    for k, count in enumerate(counts, 1):
        history = np.concatenate([[0], counts[k - 2][:-1]]) if k > 1 else whole
        known = count > 0
        used[known] = k
        score[known] = count[known] / history[known]
    return np.log(score) + (reach - np.maximum(used, 1)) * np.log(discount), used


def _scored(order: int, discount: float):
    out = arrow_schema(SCORES)

    def run(data: bytes, more: bytes, replies: list[bytes]) -> Iterator[pa.RecordBatch]:
        lowered, ids = unsqueeze_bytes(data), unpack_ids(more)
        doc, grams = ngrams(lowered, order)
        totals = np.concatenate([unsqueeze(r, np.uint64) for r in replies]).astype(np.int64)
        n_words = np.bincount(doc, minlength=len(ids))
        counts = _without_own(doc, grams, totals)
        logs, used = place_scores(doc, counts, (totals[0] - n_words)[doc], discount)
        sums = np.bincount(doc, logs, len(ids))
        by_order = [np.bincount(doc, used == k, len(ids)).astype(np.int64).tolist() for k in range(order + 1)]
        rows = []
        for i, doc_id in enumerate(ids):
            n = int(n_words[i])
            rows.append((doc_id, n, float(sums[i]), float(sums[i]) / n if n else None, [x[i] for x in by_order[1:]], by_order[0][i]))
        yield as_batch(rows, out)

    return run


def backoff_scores(docs: DataFrame, order: int = ORDER, discount: float = DISCOUNT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Sum and mean of the log scores of every document, and how many places were scored at each order.

    The documents are read twice, for the requests and for the blocks that wait for the answers, and
    must come in the same order both times, as from a table of files; otherwise the job fails.
    """
    rows = numbered(docs)
    requests = rows.mapInArrow(_requests(bucket_count(docs.sparkSession), block_bytes, order), EXCHANGE)
    blocks = rows.mapInArrow(_blocks(block_bytes), EXCHANGE)
    return finished(answered(requests, merged_counts).union(blocks), _scored(order, discount), SCORES)


def op4_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_scores(table(spark, sf_dir, "documents"))
