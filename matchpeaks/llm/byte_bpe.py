"""Byte-level BPE over a corpus by a shuffle of distinct words.

Each block of documents is cut into pre-tokens; a document is the sequence of its words'
positions in the block's list of distinct words. The distinct words are exploded to hash
buckets, where each different word of the whole corpus is encoded once; the ids go back
to the blocks, and documents are put together again by position. Decoding looks every id
up in the table of token bytes.

Defined results: null text counts as empty (no ids, digests of the empty string); repeated
rows and repeated or null ids give one row each; an empty table gives none; columns other
than the two read are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from .blocks import EXCHANGE, answered, bucket_count, by_frequency, exchange_batch, finished, in_blocks, key_row, numbered, own_row, squeeze, squeeze_bytes, squeeze_codes, unsqueeze, unsqueeze_bytes, unsqueeze_codes
from .common import arrow_schema, as_batch, table

#: Characters of a block; a larger one repeats fewer words, and its list of distinct words still takes little memory.
BLOCK = 16 << 20
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
ENCODED = "doc_id bigint, ids array<int>, decoded binary"
DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


@functools.cache
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@functools.cache
def encoding(path: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(path), special_tokens={})


def _requests(buckets: int, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = regex.compile(public_tokenizers.PATTERN).findall
        for block, ids, held in in_blocks(batches, block_bytes):
            place: defaultdict[str, int] = defaultdict()
            place.default_factory = place.__len__
            codes, counts = [], []
            for text in held:
                words = cut(text)
                counts.append(len(words))
                codes.append(np.fromiter(map(place.__getitem__, words), np.uint32, len(words)))
            words = [w.encode() for w in place]
            order, code = by_frequency(np.concatenate(codes), len(words))
            words = [words[i] for i in order]
            bucket = np.fromiter((xxhash.xxh3_64_intdigest(w) % buckets for w in words), np.int64, len(words))
            rows = [own_row(block, squeeze_codes(code), _pack_docs(ids, counts))]
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(ends)):
                mine = order[ends[b] : ends[b + 1]]
                rows.append(key_row(block, int(b), squeeze_bytes([words[i] for i in mine]), squeeze(np.diff(mine, prepend=0).astype(np.uint32))))
            yield exchange_batch(rows)

    return run


def _pack_docs(ids: list, counts: list[int]) -> bytes:
    """Ids (null as such) and word counts of a block's documents."""
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(counts, pa.int64())], ["id", "n"])
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack_docs(data: bytes) -> tuple[list, list[int]]:
    batch = pa.ipc.open_stream(data).read_all()
    return batch.column(0).to_pylist(), batch.column(1).to_pylist()


def _encode_once(path: str):
    """A bucket's reply: each distinct word is encoded a single time, whatever the number of blocks that ask."""

    def run(data: list[bytes], more: list[bytes]) -> Iterator[bytes]:
        encode = encoding(path)._encode_single_piece
        known: dict[bytes, bytes] = {}
        for words in data:
            for word in (asked := unsqueeze_bytes(words)):
                if word not in known:
                    known[word] = np.array(encode(word), np.uint32).tobytes()
        for words, places in zip(data, more):
            asked = unsqueeze_bytes(words)
            yield len(places).to_bytes(4, "little") + places + squeeze_bytes([known[w] for w in asked])

    return run


def _words_of(replies: list[bytes]) -> dict[int, np.ndarray]:
    ids: dict[int, np.ndarray] = {}
    for reply in replies:
        n = int.from_bytes(reply[:4], "little")
        places = np.cumsum(unsqueeze(reply[4 : 4 + n], np.uint32))
        ids.update(zip(places.tolist(), unsqueeze_bytes(reply[4 + n :])))
    return ids


def _rebuilt(path: str, schema: str, digests: bool):
    out = arrow_schema(schema)

    def run(data: bytes, more: bytes, replies: list[bytes]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in ranks(path).items()}
        found = _words_of(replies)
        spelled = [found.pop(i) for i in range(len(found))]
        lengths = np.fromiter(map(len, spelled), np.int64, len(spelled)) // 4
        flat, begins = np.frombuffer(b"".join(spelled), np.uint32), np.cumsum(lengths) - lengths
        lists = [np.frombuffer(x, np.uint32).tolist() for x in spelled]
        decoded = [b"".join([tokens[i] for i in x]) for x in lists]
        numbers = [("," + ",".join(map(str, x))).encode() for x in lists] if digests else []
        del spelled, lists
        codes, at, rows = unsqueeze_codes(data), 0, []
        for doc_id, n in zip(*_unpack_docs(more)):
            mine = codes[at : at + n]
            at += n
            back = b"".join(map(decoded.__getitem__, mine.tolist()))
            if digests:
                listed = b"".join(map(numbers.__getitem__, mine.tolist()))[1:]
                rows.append((doc_id, listed.count(b",") + 1 if listed else 0, hashlib.sha256(listed).hexdigest(), hashlib.sha256(back).hexdigest()))
            else:
                rows.append((doc_id, _spelled(mine, flat, begins, lengths), back))
        yield as_batch(rows, out)

    return run


def _spelled(codes: np.ndarray, flat: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Token ids of one document: the ids of its words, one after another."""
    each = lengths[codes]
    ends = np.cumsum(each)
    return flat[np.repeat(begins[codes] - ends + each, each) + np.arange(each.sum())].astype(np.int32)


def encode(df: DataFrame, path: str | None = None, block_bytes: int = BLOCK, digests: bool = False) -> DataFrame:
    """Token ids and decoded bytes of every document, or their digests.

    ``path``: file of base64 token and rank per line; every executor has it.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    schema = DIGESTS if digests else ENCODED
    requests = numbered(df).mapInArrow(_requests(bucket_count(df.sparkSession), block_bytes), EXCHANGE)
    return finished(answered(requests, _encode_once(path)), _rebuilt(path, schema, digests), schema)


def decode(df: DataFrame, path: str | None = None) -> DataFrame:
    """Text of ``doc_id, ids`` rows: ids are exploded with positions, joined to the table of token bytes, and concatenated.

    The table has as many rows as the vocabulary file, so it is small enough to broadcast. A null
    or empty list of ids gives the empty text; bytes that aren't UTF-8 are replaced.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    token_bytes = df.sparkSession.createDataFrame([(i, t) for t, i in ranks(path).items()], "id int, token binary")
    rows = df.select(F.monotonically_increasing_id().alias("row"), "doc_id", "ids")
    exploded = rows.select("row", "doc_id", F.posexplode_outer("ids").alias("at", "id"))
    joined = exploded.join(F.broadcast(token_bytes), "id", "left")
    pieces = F.sort_array(F.collect_list(F.struct("at", F.hex("token").alias("token"))))
    whole = F.array_join(F.transform(pieces, lambda p: p["token"]), "")
    return joined.groupBy("row", "doc_id").agg(whole.alias("hexed")).select("doc_id", F.decode(F.unhex("hexed"), "UTF-8").alias("text"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), digests=True)
