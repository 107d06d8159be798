"""How far the sources of each language differ in their words.

A shard is a stretch of an Arrow text buffer. Pointers to all word starts in it are put in order by
multikey quicksort, eight bytes a symbol; runs of equal words then give, for each language and
source, the number of occurrences and of documents. Shards add up in Spark.

A language keeps the words of at least ``LEAST_DOCUMENTS`` of its documents. In integer arithmetic,
``p = 1 + floor(10**9 * (count + 2) / (N + 2 * V))`` is a word's share in a group, and two shares differ by
``floor((p - q)**2 / (p + q))``. Part ``pair`` compares every two sources of a language, part ``term`` lists the
words that mark a source off from its whole language.

Pairs of sources are compared in tiles: some thousand words of a language by two blocks of its sources,
as matrices. Words that are in neither block are counted, not listed. So no row holds a pair of
sources for each word, and no task holds a whole language.

Words are letters and anything beyond ASCII, A-Z in lower case.

Defined results: null text, language or source counts as empty; every row is a document of its own, repeated or not;
a language without kept words has pairs of value 0 and no terms; ties go by the item's bytes; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_schema, stored, table, texts

LEAST_DOCUMENTS, SMOOTHING, SCALE, TOP_TERMS = 10, 2, 1_000_000_000, 10
#: Bytes of text in a shard; slices up to this size are finished by sorting their symbols.
SHARD_BYTES, SMALL_SLICE = 16 << 20, 1 << 16
#: About as many words and sources make a tile's side.
TILE_TERMS, TILE_SOURCES = 4096, 128
COUNTS = "lang string, source string, term string, n bigint, docs bigint"
TILE = "lang string, a string, b string, value bigint"

_IN_WORD = np.array([b >= 0x80 or chr(b).isalpha() for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_LEADING = np.array([(1 << 64) - (1 << (64 - 8 * n)) for n in range(9)], np.uint64)


def word_starts(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and document of every word of the texts that ``edges`` cut from ``data``."""
    inside = _IN_WORD[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[edges] = True
    before = np.concatenate([[False], inside[:-1]])
    after = np.concatenate([inside[1:], [False]])
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends - starts, np.searchsorted(edges, starts, "right") - 1


def symbols(eight: np.ndarray, starts: np.ndarray, lengths: np.ndarray, depth: int) -> np.ndarray:
    """Eight bytes of each word from ``depth`` on as a number; nothing follows a word's end."""
    return eight[starts + depth].view(">u8").ravel().astype(np.uint64) & _LEADING[np.minimum(np.maximum(lengths - depth, 0), 8)]


def sorted_pointers(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, small: int = SMALL_SLICE) -> tuple[np.ndarray, np.ndarray]:
    """Order of the words by their bytes, and the sizes of the runs of equal ones; equal words stay in their order.

    Multikey quicksort: a slice is parted into the words whose symbol is less than, equal to and greater
    than a pivot; the equal ones go on with their next symbol. A small slice is finished by sorting its symbols,
    all its undecided runs at once. ``data`` ends with eight spare bytes.
    """
    order, sizes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    eight = np.lib.stride_tricks.sliding_window_view(data, 8)
    # Slices to sort from a depth on, with their symbols there if known; the next one is the last.
    waiting: list[tuple] = [(np.arange(len(starts)), 0, None)]
    while waiting:
        part, depth, known = waiting.pop()
        if not len(part):
            continue
        if known is None:
            if len(part) == 1 or lengths[part].max() <= depth:
                order.append(part)
                sizes.append(np.array([len(part)]))
                continue
            known = symbols(eight, starts[part], lengths[part], depth)
        if len(part) > small:
            pivot = np.sort(known[:: len(part) // 9])[4]
            less, same = known < pivot, known == pivot
            more = ~(less | same)
            waiting += [(part[more], depth, known[more]), (part[same], depth + 8, None), (part[less], depth, known[less])]
        else:
            for found, into in zip(_finished(eight, starts, lengths, part, known, depth), (order, sizes)):
                into.append(found)
    return np.concatenate(order), np.concatenate(sizes)


def _finished(eight: np.ndarray, starts: np.ndarray, lengths: np.ndarray, part: np.ndarray, known: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """A small slice in order, and the sizes of its runs: each pass sorts the runs that go on by their next symbol."""
    by = np.argsort(known, kind="stable")
    part, known = part[by], known[by]
    begins = np.concatenate([[True], known[1:] != known[:-1]])
    while True:
        edges = np.flatnonzero(begins)
        runs = np.diff(edges, append=len(part))
        go_on = (runs > 1) & (np.maximum.reduceat(lengths[part], edges) > depth + 8)
        if not go_on.any():
            return part, runs
        depth += 8
        at = np.flatnonzero(np.repeat(go_on, runs))
        key = symbols(eight, starts[part[at]], lengths[part[at]], depth)
        by = np.lexsort((key, np.cumsum(begins)[at]))
        part[at], key = part[at][by], key[by]
        begins[at[1:]] |= key[1:] != key[:-1]


def shard_counts(data: np.ndarray, edges: np.ndarray, group: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, then for each word and group: word number, group, occurrences, documents) of one shard."""
    lower = np.concatenate([_LOWER[data], np.zeros(8, np.uint8)])
    starts, lengths, doc = word_starts(data, edges)
    order, sizes = sorted_pointers(lower, starts, lengths)
    run = np.repeat(np.arange(len(sizes)), sizes)
    doc = doc[order]
    # Within a run documents ascend, so a document's first place is where the run or the document changes.
    first = np.ones(len(run), bool)
    first[1:] = (run[1:] != run[:-1]) | (doc[1:] != doc[:-1])
    groups = int(group.max()) + 1 if len(group) else 1
    key = run * groups + group[doc]
    found, n = np.unique(key, return_counts=True)
    _, documents = np.unique(key[first], return_counts=True)
    heads = order[np.cumsum(sizes) - sizes]
    raw = lower.tobytes()
    words = [raw[a : a + k].decode() for a, k in zip(starts[heads].tolist(), lengths[heads].tolist())]
    return words, found // groups, found % groups, n, documents


def _count(shard_bytes: int):
    out = arrow_schema(COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
            _, offsets, data = column.buffers()
            edges = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
            text = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
            pairs = pa.StructArray.from_arrays([batch.column("lang"), batch.column("source")], ["lang", "source"]).to_pylist()
            numbers: dict[tuple, int] = {}
            group = np.array([numbers.setdefault((p["lang"], p["source"]), len(numbers)) for p in pairs], np.int64)
            named = list(numbers)
            at = 0
            while at < len(column):
                to = max(at + 1, int(np.searchsorted(edges, edges[at] + shard_bytes, "right")) - 1)
                part = text[edges[at] : edges[to]]
                words, word, of, n, documents = shard_counts(part, edges[at : to + 1] - edges[at], group[at:to])
                at = to
                languages, sources = (pa.array([pair[i] for pair in named], pa.string()) for i in (0, 1))
                spelled = pa.array(words, pa.string())
                for begin in range(0, len(word), 1 << 16):
                    piece = slice(begin, begin + (1 << 16))
                    group_of, word_of = pa.array(of[piece]), pa.array(word[piece])
                    columns = [languages.take(group_of), sources.take(group_of), spelled.take(word_of), pa.array(n[piece]), pa.array(documents[piece])]
                    yield pa.RecordBatch.from_arrays(columns, schema=out)

    return run


def term_counts(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Occurrences and documents of every word in every (lang, source)."""
    shards = _named(docs).mapInArrow(_count(shard_bytes), COUNTS)
    return shards.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _named(docs: DataFrame) -> DataFrame:
    also = {name: F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("lang", "source")}
    return texts(docs, also=also).select("text", "lang", "source")


def share(n: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (n + SMOOTHING) / (total + SMOOTHING * terms))``, exactly; 1 if there are no terms."""
    big = F.lit(SCALE).cast("decimal(10,0)") * (n + SMOOTHING).cast("decimal(19,0)")
    return F.coalesce(F.call_function("div", big, F.nullif((total + SMOOTHING * terms).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))), F.lit(0)) + 1


def divergence(p: Column, q: Column) -> Column:
    """``floor((p - q)**2 / (p + q))``; both are up to 10**9 + 1, so squares fit 64 bits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _tile(group: pa.Table) -> pa.Table:
    """Values of all pairs of a block ``i`` source and a later, or block ``j``, source over the tile's words."""
    rows = group.to_pydict()
    lang, i, j, n_terms = rows["lang"][0], rows["i"][0], rows["j"][0], rows["n_terms"][0]
    sources = {s: (b, p) for s, b, p, t in zip(rows["source"], rows["block"], rows["p"], rows["term"]) if t is None}
    left, right = (sorted(s for s, (b, _) in sources.items() if b == block) for block in (i, j))
    number = {s: at for at, s in enumerate(left + (right if i != j else []))}
    columns: dict[str, int] = {}
    at = [(number[s], columns.setdefault(t, len(columns)), p) for s, t, p in zip(rows["source"], rows["term"], rows["p"]) if t is not None]
    base = np.array([sources[s][1] for s in number], np.int64)
    shares = np.repeat(base[:, None], len(columns), axis=1)
    if at:
        y, x, p = (np.array(v, np.int64) for v in zip(*at))
        shares[y, x] = p
    names = list(number)
    a, b, value = [], [], []
    for y in range(len(left)):
        others = np.arange(y + 1, len(names)) if i == j else np.arange(len(left), len(names))
        gap, both = shares[others] - shares[y], shares[others] + shares[y]
        # Words of the language that none of the tile's sources has.
        rest = (base[others] - base[y]) ** 2 // (base[others] + base[y]) * (n_terms - len(columns))
        a += [names[y]] * len(others)
        b += [names[o] for o in others]
        value += ((gap * gap // both).sum(axis=1) + rest).tolist()
    return pa.Table.from_arrays([pa.array([lang] * len(a), pa.string()), pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(value, pa.int64())], schema=arrow_schema(TILE))


def pair_values(shares: DataFrame, sources: DataFrame, languages: DataFrame, tile_terms: int = TILE_TERMS, tile_sources: int = TILE_SOURCES) -> DataFrame:
    """(lang, a, b, value) of every two sources of a language, both ways.

    ``shares``: lang, source, term, p where the term occurs; ``sources``: lang, source, p of a word that doesn't
    occur; ``languages``: lang, n_terms, n_sources.
    """
    sides = languages.select(
        "lang",
        F.ceil(F.greatest("n_terms", F.lit(1)) / F.lit(tile_terms)).cast("int").alias("strips"),
        F.ceil(F.col("n_sources") / F.lit(tile_sources)).cast("int").alias("blocks"),
    )
    strip = F.pmod(F.xxhash64("term"), F.col("strips")).cast("int")
    block = F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int")
    shared = shares.join(sides, "lang").withColumn("strip", strip)
    blank = sources.join(sides, "lang").withColumn("term", F.lit(None).cast("string")).withColumn("strip", F.explode(F.sequence(F.lit(0), F.col("strips") - 1)))
    listed = shared.select("lang", "strip", "blocks", "source", "term", "p").unionByName(blank.select("lang", "strip", "blocks", "source", "term", "p"))
    per_strip = shares.select("lang", "term").distinct().join(sides, "lang").withColumn("strip", strip).groupBy("lang", "strip").agg(F.count("*").alias("n_terms"))
    listed = listed.join(per_strip, ["lang", "strip"], "left").withColumn("n_terms", F.coalesce("n_terms", F.lit(0)))
    met = listed.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("lang", "strip", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "source", "term", "p", "n_terms")
    values = met.groupBy("lang", "strip", "i", "j").applyInArrow(_tile, TILE).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    values = stored(values, "pairs")
    return values.union(values.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))


def source_divergence(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top: int = TOP_TERMS, shard_bytes: int = SHARD_BYTES, tile_terms: int = TILE_TERMS, tile_sources: int = TILE_SOURCES) -> DataFrame:
    """lang, source, part, item, value, rank: other sources by distance, and the terms that mark a source off."""
    counts = stored(term_counts(docs, shard_bytes), "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_documents)
    kept = stored(kept.select("lang", "term", "n_lang"), "kept-terms")
    mine = stored(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "n_lang"), "group-terms")
    groups = _named(docs).select("lang", "source").distinct()
    terms = kept.groupBy("lang").agg(F.count("*").alias("n_terms"), F.sum("n_lang").alias("total_lang"))
    languages = groups.groupBy("lang").agg(F.count("*").alias("n_sources")).join(terms, "lang", "left")
    languages = stored(languages.select("lang", "n_sources", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_terms", "total_lang")]), "languages")
    totals = mine.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sources = groups.join(totals, ["lang", "source"], "left").join(languages, "lang")
    sources = stored(sources.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), "n_terms", "total_lang"), "sources")
    whole = mine.join(sources, ["lang", "source"]).select(
        "lang", "source", "term",
        share(F.col("n"), F.col("total"), F.col("n_terms")).alias("p"),
        share(F.col("n_lang"), F.col("total_lang"), F.col("n_terms")).alias("q"),
    )
    whole = stored(whole, "shares")
    absent = sources.select("lang", "source", share(F.lit(0).cast("bigint"), F.col("total"), F.col("n_terms")).alias("p"))
    pairs = pair_values(whole.select("lang", "source", "term", "p"), absent, languages.select("lang", "n_terms", "n_sources"), tile_terms, tile_sources)
    pairs = pairs.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value")
    marks = whole.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")).alias("rank")
    return pairs.select("*", place).union(marks.select("*", place).where(F.col("rank") <= top))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))
