"""Exact Jaccard join of word-shingle sets with adaptive multi-match prefixes.

1. Every distinct shingle's number of documents is counted over the corpus (``blocks``).
   Tokens are ordered by that number, rare ones first. A document that shares less than the
   threshold's part of its tokens with anything at all links to nothing and ends here.
2. Documents with the same set are one class; its least id stands for it.
3. Two linked sets share at least ``l`` of their first ``n - ceil(t * n) + l`` tokens, for any
   ``l``. Each set chooses the ``l`` of least estimated cost: the documents on its prefix tokens' lists,
   plus verification of those that may reach ``l`` matches. For a pair the smaller ``l`` counts.
4. Components: in a few rounds every set is compared with one set of another component that
   it shares prefix tokens with, drawn anew each round, which joins most near copies without
   all their pairs. Then *all* sets of different components that share enough prefix tokens are
   compared, so no link between components is lost: pair by pair where they meet on short
   lists, and part by part, as matrix products, where they meet on a long one. What a step joins is one
   component in the next; parts are compared with themselves before they are with each other,
   and of a comparison only a spanning forest of the components it joins comes out.

Hot shingles come once per block when counted, are last in the order, and so reach no prefix but of
sets that consist of them.

Defined results: null text counts as empty; a document without words has an empty set and is
its own component; identical rows link (same set); rows that share an id are one node for the texts that link; a
null id takes no part and has a null component; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import BLOCK_BYTES, EXCHANGE, answered, bucket_count, by_bucket, exchange_batch, finished, in_blocks, key_row, merged_counts, numbered, own_row, pack_ids, squeeze, squeeze_bytes, squeeze_sorted, unpack_ids, unsqueeze, unsqueeze_bytes, unsqueeze_sorted
from .common import arrow_schema, as_batch, stored, table
from .components import components, contracted
from .hashing import mixed, shingles

WORDS, PERCENT = 5, 75
#: Largest number of prefix matches asked for, and a verification's cost in list entries read.
MATCHES, VERIFY = 8, 50
#: Rounds with drawn partners; lists longer than this are compared in parts of so many sets.
ROUNDS, LONG_LIST, PART = 2, 32, 256
#: About so many sets of a list draw the same partner.
STRETCH = 32
SETS = "doc_id bigint, n_shingles bigint, fp_a bigint, fp_b bigint, may_link boolean, shared binary"


def needed(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Tokens that a set of ``n`` must share with any set it links to."""
    return -(-n * percent // 100)


def _requests(buckets: int, block_bytes: int, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, held in in_blocks(batches, block_bytes):
            lowered = [text.encode().lower() for text in held]
            keys, counts = np.unique(shingles(lowered, words)[1], return_counts=True)
            rows = [own_row(block, squeeze_bytes(lowered), pack_ids(ids))]
            for b, (start, end) in enumerate(pairwise(by_bucket(keys, buckets))):
                if end > start:
                    rows.append(key_row(block, b, squeeze_sorted(keys[start:end]), squeeze(counts[start:end].astype(np.uint32))))
            yield exchange_batch(rows)

    return run


def pack_set(keys: np.ndarray, df: np.ndarray) -> bytes:
    a = squeeze_sorted(keys)
    return len(a).to_bytes(4, "little") + a + squeeze(df.astype(np.uint32))


def unpack_set(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:4], "little")
    return unsqueeze_sorted(data[4 : 4 + n]), unsqueeze(data[4 + n :], np.uint32)


def _sets(words: int, percent: int):
    out = arrow_schema(SETS)

    def run(data: bytes, more: bytes, replies: list[bytes]) -> Iterator[pa.RecordBatch]:
        lowered, ids = unsqueeze_bytes(data), unpack_ids(more)
        doc, key = shingles(lowered, words)
        df = np.concatenate([np.empty(0, np.uint64), *(unsqueeze(r, np.uint64) for r in replies)])[np.searchsorted(np.unique(key), key)]
        ends = np.searchsorted(doc, np.arange(len(ids) + 1))
        sums = [np.concatenate([[np.uint64(0)], np.cumsum(mixed(key ^ np.uint64(seed)), dtype=np.uint64)]) for seed in (1, 2)]
        fp = [(s[ends[1:]] - s[ends[:-1]]).view(np.int64) for s in sums]
        seen: set[tuple] = set()
        rows = []
        for i, (start, end) in enumerate(pairwise(ends.tolist())):
            n, shared = end - start, None
            common = df[start:end] > 1
            may_link = n > 0 and ids[i] is not None and int(common.sum()) >= needed(n, percent)
            mark = (n, int(fp[0][i]), int(fp[1][i]))
            if may_link and mark not in seen:
                seen.add(mark)
                shared = pack_set(key[start:end][common], df[start:end][common])
            rows.append((ids[i], *mark, may_link, shared))
        yield as_batch(rows, out)

    return run


def document_sets(df: DataFrame, words: int = WORDS, percent: int = PERCENT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each document's set size and fingerprint; ``shared``: the tokens other documents have too, where a link is possible.

    Of equal sets in a block only one carries its tokens.
    """
    requests = numbered(df).mapInArrow(_requests(bucket_count(df.sparkSession), block_bytes, words), EXCHANGE)
    return finished(answered(requests, merged_counts), _sets(words, percent), SETS)


def adaptive_prefix(df: np.ndarray, n: int, percent: int) -> tuple[int, int]:
    """(matches to ask for, length of the prefix among the shared tokens), ``df`` ascending.

    ``n - len(df)`` tokens occur nowhere else; they come first in the order.
    """
    base = n - needed(n, percent) - (n - len(df))
    reach = np.minimum(base + np.arange(1, MATCHES + 1), len(df))
    listed = np.concatenate([[0], np.cumsum(df - 1)])[np.maximum(reach, 0)]
    cost = listed + VERIFY * listed / np.arange(1, MATCHES + 1)
    allowed = np.arange(1, MATCHES + 1) <= max(1, needed(n, percent))
    ell = 1 + int(np.argmin(np.where(allowed, cost, np.inf)))
    return ell, int(max(0, min(base + ell, len(df))))


def _in_order(data: bytes, n: int, percent: int) -> tuple[np.ndarray, int, np.ndarray]:
    """(ascending shared tokens, matches to ask for, prefix tokens)."""
    keys, df = unpack_set(data)
    order = np.lexsort((keys, df))
    ell, length = adaptive_prefix(df[order].astype(np.int64), n, percent)
    return keys, ell, keys[order[:length]]


def _prefixes(percent: int, schema: str):
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rep, n, data in zip(*(c.to_pylist() for c in batch.columns)):
                keys, ell, prefix = _in_order(data, n, percent)
                if len(prefix):
                    same = [pa.array(np.full(len(prefix), x, np.int32)) for x in (ell, n, len(keys))]
                    yield pa.RecordBatch.from_arrays([pa.array(prefix.view(np.int64)), pa.array(np.full(len(prefix), rep, np.int64)), *same], schema=out)

    return run


def _verify(percent: int):
    out = arrow_schema("a bigint, b bigint, linked boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for a, b, n, m, first, second in zip(*(c.to_pylist() for c in batch.columns)):
                linked = False
                if 100 * min(n, m) >= percent * max(n, m):
                    (one, ell, head), (two, other_ell, other_head) = _in_order(first, n, percent), _in_order(second, m, percent)
                    if len(np.intersect1d(head, other_head, True)) >= min(ell, other_ell):
                        both = len(np.intersect1d(one, two, True))
                        linked = 100 * both >= percent * (n + m - both)
                rows.append((a, b, linked))
            yield as_batch(rows, out)

    return run


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked) of each pair. The join, not a group, brings the sets together, so that a hot one can be split."""
    for side, other in (("a", "n"), ("b", "m")):
        pairs = pairs.join(sets.select(F.col("rep").alias(side), F.col("n_shingles").alias(other), F.col("shared").alias(f"set_{side}")), side)
    return pairs.select("a", "b", "n", "m", "set_a", "set_b").mapInArrow(_verify(percent), "a bigint, b bigint, linked boolean")


def _drawn(placed: DataFrame, turn: int) -> DataFrame:
    """For each set one set of another component, the one that stands on most of its prefix lists among those drawn.

    The sets of a list are put in a random order and cut into stretches; a stretch shares a partner, so that partners differ.
    """
    sizes = placed.groupBy("token").agg(F.count("*").alias("listed"))
    order = F.xxhash64("rep", F.lit(turn))
    stretches = F.ceil(F.col("listed") / F.lit(STRETCH))
    stretch = F.floor((F.col("o") / F.lit(2.0**64) + 0.5) * stretches).cast("int")
    placed = placed.join(sizes.where("listed > 1"), "token").withColumn("o", order).withColumn("stretch", stretch)
    place, drawn = ["token", "stretch"], F.struct("o", "rep", "component")
    lists = placed.groupBy(*place).agg(F.min(drawn).alias("one"), F.min("component").alias("low"), F.max("component").alias("high"))
    lists = lists.where("low <> high").select(*place, "one")
    mixed_lists = placed.join(lists, place)
    second = mixed_lists.where("component <> one.component").groupBy(*place).agg(F.min(drawn).alias("two"))
    pairs = mixed_lists.join(second, place).select("rep", F.when(F.expr("component <> one.component"), F.col("one.rep")).otherwise(F.col("two.rep")).alias("other"))
    counted = pairs.groupBy("rep", "other").agg(F.count("*").alias("n"))
    best = counted.groupBy("rep").agg(F.max(F.struct("n", "other"))["other"].alias("other"))
    return best.select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")).distinct()


def _crossing(placed: DataFrame) -> DataFrame:
    """Prefix lists that hold sets of several components, with their lengths."""
    lists = placed.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("listed"))
    return placed.join(lists.where("low <> high").select("token", "listed"), "token")


def _short_list_pairs(crossing: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components on short lists that share as many prefix tokens as asked for."""
    left = crossing.where(F.col("listed") <= LONG_LIST)
    right = left.select("token", *[F.col(c).alias(f"{c}_b") for c in ("rep", "ell", "component", "n_shingles", "n_shared")])
    # Both sets must have as many tokens in common with others as the link would need in common with each other.
    enough = (100 + percent) * F.least("n_shared", "n_shared_b") >= percent * (F.col("n_shingles") + F.col("n_shingles_b"))
    met = left.join(right, "token").where((F.col("rep") < F.col("rep_b")) & (F.col("component") != F.col("component_b")) & enough)
    met = met.groupBy(F.col("rep").alias("a"), F.col("rep_b").alias("b")).agg(F.count("*").alias("n"), F.min(F.least("ell", "ell_b")).alias("asked"))
    return met.where("n >= asked").select("a", "b")


def _packed(group: pa.Table) -> pa.Table:
    group = group.sort_by("rep")
    first = [group.column(c)[:1] for c in ("cluster", "part")]
    lists = [pa.array([group.column(c).to_pylist()], pa.list_(pa.int64())) for c in ("rep", "n_shingles", "component")]
    return pa.Table.from_arrays([*first, *lists, pa.array([squeeze_bytes(group.column("shared").to_pylist())], pa.binary())], ["cluster", "part", "reps", "sizes", "components", "sets"])


def _link_parts(percent: int):
    out = arrow_schema("a bigint, b bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for reps, sizes, labels, sets, *other in zip(*(c.to_pylist() for c in batch.columns)):
                rows += links_between((reps, sizes, labels, sets), tuple(other), percent)
            yield as_batch(rows, out)

    return run


def links_between(one: tuple, two: tuple, percent: int) -> list[tuple[int, int]]:
    """Links between two parts' sets of different components: a spanning forest of the components that they join."""
    sides = []
    for reps, sizes, labels, sets in (one, two):
        keys = [unpack_set(x)[0] for x in unsqueeze_bytes(sets)]
        sides.append((np.array(reps), np.array(sizes), np.array(labels), np.concatenate(keys), np.repeat(np.arange(len(keys)), list(map(len, keys)))))
    (r, n, c, k, d), (r2, n2, c2, k2, d2) = sides
    tokens = np.intersect1d(k, k2)
    both = np.zeros((len(r), len(r2)), np.int64)
    # Sets as rows of zeros and ones over some of the common tokens at a time: the product counts what they share.
    for at in range(0, len(tokens), 4096):
        part = tokens[at : at + 4096]
        rows = []
        for key, doc, size in ((k, d, len(r)), (k2, d2, len(r2))):
            place = np.minimum(np.searchsorted(part, key), len(part) - 1)
            hit = part[place] == key
            matrix = np.zeros((size, len(part)), np.float32)
            matrix[doc[hit], place[hit]] = 1
            rows.append(matrix)
        both += (rows[0] @ rows[1].T).round().astype(np.int64)
    linked = (100 * both >= percent * (n[:, None] + n2[None, :] - both)) & (c[:, None] != c2[None, :])
    above: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := above.setdefault(x, x)) != x:
            above[x] = x = above[y] if y in above else y
        return x

    forest = []
    rows, columns = np.nonzero(linked)
    for i, j in zip(rows.tolist(), columns.tolist()):
        x, y = root(int(c[i])), root(int(c2[j]))
        if x != y:
            above[max(x, y)] = min(x, y)
            forest.append((int(min(r[i], r2[j])), int(max(r[i], r2[j]))))
    return forest


def _long_list_links(crossing: DataFrame, sets: DataFrame, percent: int, inside: bool) -> DataFrame:
    """Links of different components between sets that meet on a long list.

    Sets that meet there are dealt to clusters by the longest list each is on, and clusters are cut
    into parts of about ``PART`` sets. Parts of clusters that meet are compared as wholes: pairs of sets are
    never rows, and no task holds more than two parts. ``inside``: only each part with itself.
    """
    long = crossing.where(F.col("listed") > LONG_LIST)
    homes = stored(long.groupBy("rep", "component").agg(F.max(F.struct("listed", "token"))["token"].alias("cluster")), "homes")
    parts = homes.groupBy("cluster").agg(F.ceil(F.count("*") / F.lit(PART)).cast("int").alias("parts"))
    dealt = homes.join(parts, "cluster").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    packed = dealt.join(sets, "rep").select("cluster", "part", "rep", F.col("n_shingles").cast("long").alias("n_shingles"), "component", "shared")
    packed = stored(packed.groupBy("cluster", "part").applyInArrow(_packed, "cluster bigint, part int, reps array<bigint>, sizes array<bigint>, components array<bigint>, sets binary"), "parts")
    columns = ("reps", "sizes", "components", "sets")
    if inside:
        return packed.select(*columns, *[F.col(c).alias(f"{c}_b") for c in columns]).mapInArrow(_link_parts(percent), "a bigint, b bigint")
    on = long.select("token", "rep").join(homes.select("rep", "cluster"), "rep").select("token", "cluster").distinct()
    met = on.join(on.withColumnRenamed("cluster", "cluster_b"), "token").where("cluster <= cluster_b").select("cluster", "cluster_b").distinct()
    met = met.join(parts, "cluster").join(parts.select(F.col("cluster").alias("cluster_b"), F.col("parts").alias("parts_b")), "cluster_b")
    met = met.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("part_b", F.explode(F.sequence(F.lit(0), F.col("parts_b") - 1)))
    met = met.where("cluster < cluster_b or part <= part_b").select("cluster", "part", "cluster_b", "part_b")
    other = packed.select(*[F.col(c).alias(f"{c}_b") for c in packed.columns])
    pairs = met.join(packed, ["cluster", "part"]).join(other, ["cluster_b", "part_b"])
    return pairs.select(*columns, *[f"{c}_b" for c in columns]).mapInArrow(_link_parts(percent), "a bigint, b bigint")


def joined_sets(sets: DataFrame, percent: int = PERCENT, rounds: int = ROUNDS) -> DataFrame:
    """(rep, component) of the sets (rep, n_shingles, shared) that link to another one."""
    schema = "token bigint, rep bigint, ell int, n_shingles int, n_shared int"
    prefixes = stored(sets.select("rep", "n_shingles", "shared").mapInArrow(_prefixes(percent, schema), schema), "prefixes")
    found = None

    def placed() -> DataFrame:
        if found is None:
            return prefixes.withColumn("component", F.col("rep"))
        named = found.withColumnRenamed("node", "rep")
        return prefixes.join(named, "rep", "left").withColumn("component", F.coalesce("component", "rep"))

    for turn in range(rounds):
        new = verified(_drawn(placed(), turn), sets, percent).where("linked").select("a", "b")
        found = contracted(found, stored(new, "links"))
    for inside in (True, False):
        crossing = stored(_crossing(placed()), "crossing")
        new = _long_list_links(crossing, sets, percent, inside)
        if not inside:
            new = new.union(verified(_short_list_pairs(crossing, percent), sets, percent).where("linked").select("a", "b"))
        found = contracted(found, stored(new, "links"))
    return found.withColumnRenamed("node", "rep")


def ngram_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, rounds: int = ROUNDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    rows = stored(document_sets(docs, words, percent, block_bytes), "sets")
    same = ["n_shingles", "fp_a", "fp_b"]
    classes = rows.where("may_link").groupBy(*same).agg(F.min("doc_id").alias("rep"), F.min(F.when(F.col("shared").isNotNull(), F.col("doc_id"))).alias("carrier"))
    classes = stored(classes, "classes")
    sets = rows.where("shared is not null").join(classes, same).where("doc_id = carrier").select("rep", "n_shingles", "shared")
    found = joined_sets(stored(sets, "reps"), percent, rounds)
    component = classes.join(found, "rep", "left").select(*same, F.coalesce("component", "rep").alias("component"))
    placed = rows.drop("shared").join(component, same, "left")
    linked = F.when(F.col("may_link"), F.col("component"))
    return placed.select("doc_id", "n_shingles", F.coalesce(linked, "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each component: the one with the least id. Rows without an id stay."""
    found = ngram_components(docs, words, percent)
    gone = found.where("component_id <> doc_id").select(F.col("doc_id").alias("gone")).distinct()
    stay = docs.join(gone, F.col("doc_id").cast("long") == F.col("gone"), "left_anti")
    return stay.where("doc_id is not null").dropDuplicates(["doc_id"]).union(docs.where("doc_id is null"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"))
