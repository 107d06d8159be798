"""Documents drawn by importance weights towards the word statistics of a target.

Features of a text are its runs of one to three words; each falls into a bucket by its checksum. A
bucket's gain is the logarithm of how much more of the target than of the corpus falls into it, in
thousandths; a document's weight is the sum of its features' gains, looked up in one array. A
Gumbel number, drawn from the document's id, is added, so that the highest scores are a draw without replacement
with probabilities after the weights.

The cutoff is found by weighted median of medians: each partition gives the median of its remaining
keys, and the median of those, weighted by how many keys remain in each partition, is the pivot.
At least a quarter of the remaining keys lie on either side of it, so counting on both sides discards at least a
quarter for certain, until the pivot is the cutoff itself. Only one row a partition, of fixed size,
reaches the driver; remaining keys are written anew whenever they are a quarter of what is stored, so all rounds
together read a small multiple of the keys. Only the winners are sorted.

Words are letters, digits and anything beyond ASCII, A-Z in lower case.

Defined results: null text counts as empty, with no features and weight 0; fewer than ``LEAST_WORDS`` words are never drawn;
a missing id draws its number as the empty text and comes after all ids of the same score; repeated rows are rows of their own, each
of which can be drawn; an empty target or corpus only changes the gains; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchpeaks.operators.ranking import number_rows

from .common import arrow_schema, map_texts, pairs, stored, table, texts

BUCKETS, LONGEST_RUN, LEAST_WORDS, PERCENT, SEED = 10_000, 3, 20, 5, 42
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 0x80 or chr(c).isalnum() else 32 for c in range(256))
KEY = ["low", "late", "more"]
_MEDIANS = "before bigint, equal bigint, after bigint, " + ", ".join(f"{side}_{k} bigint" for side in ("b", "a") for k in KEY)

Key = tuple[int, int, int]


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_WORDS).split()


def buckets_of(words: list[bytes], buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> np.ndarray:
    """Bucket of every run of words; a run's checksum goes on from that of the run one word shorter."""
    spaced = [b" " + w for w in words]
    sums = list(map(crc32, words))
    every = list(sums)
    for more in range(1, min(longest, len(words))):
        sums = list(map(crc32, spaced[more:], sums))
        every += sums
    return np.array(every, np.int64) % buckets


def bucket_counts(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts; a task adds up its own before anything is shuffled."""
    schema = "bucket int, n bigint"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, text in pairs(batches):
            found = buckets_of(words_of(text), buckets)
            if len(found):
                total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], schema=out)

    return df.mapInArrow(run, schema).groupBy("bucket").agg(F.sum("n").alias("n"))


def _counted(df: DataFrame, key: str, buckets: int) -> np.ndarray:
    total = np.zeros(buckets, np.int64)
    for bucket, n in bucket_counts(texts(df, key), buckets).collect():  # one row a bucket at most
        total[bucket] = n
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket in thousandths of a logarithm, rounded down, with one imagined feature in every bucket."""
    n, (all_corpus, all_target) = len(corpus), (float(corpus.sum() + len(corpus)), float(target.sum() + len(target)))
    return np.array([math.floor(1000 * math.log((float(target[i]) + 1) * all_corpus / ((float(corpus[i]) + 1) * all_target))) for i in range(n)], np.int64)


def weights(docs: DataFrame, target: DataFrame, key: str = "item_id", buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_words, n_features, weight of every document."""
    gain = gains(_counted(docs, "doc_id", buckets), _counted(target, key, buckets))

    def row(doc_id: int | None, text: str) -> tuple:
        words = words_of(text)
        found = buckets_of(words, buckets)
        return doc_id, len(words), len(found), int(gain[found].sum())

    return map_texts(texts(docs), row, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def with_scores(weighted: DataFrame, seed: int = SEED) -> DataFrame:
    """Add ``score``: the weight and the id's Gumbel number in thousandths."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    drawn = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")
    return weighted.withColumn("score", F.col("weight") + drawn)


def with_keys(scored: DataFrame) -> DataFrame:
    """Add the columns that put rows in the order of drawing, least first: high scores, then small ids, none last."""
    missing = F.when(F.col("doc_id").isNull(), F.lit(1 << 62)).otherwise(F.lit(0))
    made = [-F.col("score"), F.coalesce("doc_id", F.lit((1 << 63) - 1)), missing + F.col("n_features")]
    return scored.select("*", *[c.cast("bigint").alias(name) for c, name in zip(made, KEY)])


def _before(key: Key, equal: bool):
    """Rows whose key comes before ``key``, or is it."""
    a, b, c = (F.col(name) for name in KEY)
    last = c <= key[2] if equal else c < key[2]
    return (a < key[0]) | ((a == key[0]) & ((b < key[1]) | ((b == key[1]) & last)))


def _medians(pivot: Key | None):
    out = arrow_schema(_MEDIANS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.stack([c.to_numpy() for c in b.columns]) for b in batches if b.num_rows]
        if not parts:
            return
        keys = np.concatenate(parts, axis=1)
        keys = keys[:, np.lexsort(keys[::-1])]
        low = high = 0
        if pivot is not None:
            a, b, c = keys
            less = (a < pivot[0]) | ((a == pivot[0]) & ((b < pivot[1]) | ((b == pivot[1]) & (c < pivot[2]))))
            low = int(less.sum())
            high = low + int(((a == pivot[0]) & (b == pivot[1]) & (c == pivot[2])).sum())
        n = keys.shape[1]
        middle = [keys[:, (at + to) // 2].tolist() if at < to else [0, 0, 0] for at, to in ((0, low), (high, n))]
        row = (low, high - low, n - high, *middle[0], *middle[1])
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in row], schema=out)

    return run


def weighted_median(found: list[tuple[Key, int]]) -> Key:
    """The key that has at most half of the weight before it and at most half after it."""
    total, seen = sum(n for _, n in found), 0
    for key, n in sorted(found):
        seen += n
        if 2 * seen >= total:
            return key
    raise ValueError("no keys")


def cutoff(keys: DataFrame, k: int) -> Key:
    """The ``k``-th key (``low, late, more``) in ascending order, repeats counted."""
    keys = stored(keys.select(*KEY), "keys")
    remaining, held, pivot = keys, None, None
    while True:
        rows = remaining.mapInArrow(_medians(pivot), _MEDIANS).collect()  # one row a partition
        before, equal, after = (sum(r[i] for r in rows) for i in range(3))
        if pivot is not None and before < k <= before + equal:
            return pivot
        low = pivot is not None and k <= before
        if not low:
            k -= before + equal
        if pivot is not None:
            remaining = remaining.where(_before(pivot, False) if low else ~_before(pivot, True))
        left = before if low else after
        held = held or left
        if 4 * left <= held:
            remaining, held = stored(remaining, "keys"), left
        side = 3 if low else 6
        pivot = weighted_median([(tuple(r[side : side + 3]), r[0] if low else r[2]) for r in rows if (r[0] if low else r[2])])


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score of every document, and the rank of those drawn.

    ``percent`` of the documents with at least ``least_words`` words are drawn, rounded down.
    """
    scored = stored(with_keys(with_scores(weights(docs, target, buckets=buckets), seed)), "scores")
    able = scored.where(F.col("n_words") >= least_words)
    k = percent * able.count() // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    undrawn = F.lit(None).cast("bigint").alias("rank")
    if k == 0:
        return scored.select(*columns, undrawn)
    last = cutoff(able, k)
    drawn = _before(last, True) & (F.col("n_words") >= least_words)
    winners = number_rows(scored.where(drawn).select(*columns, *KEY), [F.col(c) for c in KEY], "rank", "drawn")
    # Rows with the very key of the cutoff may be more than are still to draw.
    ranked = winners.select(*columns, F.when(F.col("rank") <= k, F.col("rank").cast("bigint")).alias("rank"))
    return ranked.union(scored.where(~drawn).select(*columns, undrawn))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
