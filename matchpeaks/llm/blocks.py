"""Look-ups of very many keys against tables counted over the whole corpus.

Documents are taken in *blocks* of a few MB, as they come from the scan. A block sends
each distinct key it holds once, with its local count, to the bucket of that key, so a key
that a third of all rows holds arrives once per block. A bucket merges its keys and answers
every block in the order of the request; the block's own packed rows travel with the
requests and meet the answers again. Nothing is collected, and no group is larger than a
block or one bucket's share of the distinct keys.

Rows of the exchange: ``key`` (where the row goes next), ``block``, ``bucket`` (-1: the block's
own row), ``data`` and ``more`` (packed bytes).
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_schema, pairs, texts

BLOCK_BYTES = 8 << 20
EXCHANGE = "key string, block string, bucket int, data binary, more binary"
_ARROW = arrow_schema(EXCHANGE)


def bucket_count(spark: SparkSession) -> int:
    """Buckets of keys: several for each shuffle partition, so they follow the cluster's setting."""
    return 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[tuple[str, list, list[str]]]:
    """(block id, doc ids, texts) of rows from ``numbered``; the id is the same when the same rows are read again."""
    task, n, size = 0, 0, 0
    ids: list = []
    held: list[str] = []

    def name() -> str:
        return f"{task}-{n}-{zlib.crc32(repr([(i, len(t)) for i, t in zip(ids, held)]).encode()):08x}"
    for doc_id, text, task in pairs(batches):
        ids.append(doc_id)
        held.append(text)
        size += len(text)
        if size >= block_bytes:
            yield name(), ids, held
            ids, held, size, n = [], [], 0, n + 1
    if ids:
        yield name(), ids, held


def numbered(df: DataFrame) -> DataFrame:
    """doc_id and text with the number of the input partition; it doesn't change where the rows become part of a union."""
    return texts(df).withColumn("task", F.spark_partition_id())


def own_row(block: str, data: bytes, more: bytes) -> tuple:
    return f"d{block}", block, -1, data, more


def key_row(block: str, bucket: int, data: bytes, more: bytes) -> tuple:
    return f"b{bucket}", block, bucket, data, more


def exchange_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def answered(requests: DataFrame, answer: Callable[[list[bytes], list[bytes]], Iterable[bytes]]) -> DataFrame:
    """Send requests to their buckets; ``answer(data, more)`` gives each request's reply.

    A bucket's requests are sorted by block, so replies don't depend on arrival order.
    """

    def run(group: pa.Table) -> pa.Table:
        if group.column("bucket")[0].as_py() < 0:
            return group
        group = group.sort_by("block")
        replies = list(answer(group.column("data").to_pylist(), group.column("more").to_pylist()))
        blank = pa.array([b""] * group.num_rows, pa.binary())
        return group.set_column(3, "data", pa.array(replies, pa.binary())).set_column(4, "more", blank)

    return requests.groupBy("key").applyInArrow(run, EXCHANGE)


def finished(answers: DataFrame, finish: Callable[[bytes, bytes, list[bytes]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Bring a block's own row and its replies, in bucket order, together."""
    out = arrow_schema(schema)

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("bucket")
        if group.column("bucket")[0].as_py() >= 0:
            raise RuntimeError("the documents came in another order the second time; store them first")
        data, more = group.column("data").to_pylist(), group.column("more").to_pylist()
        return pa.Table.from_batches(list(finish(data[0], more[0], data[1:])), schema=out)

    return answers.select("block", "bucket", "data", "more").groupBy("block").applyInArrow(run, schema)


# Packing of arrays. Byte planes put the bytes of one significance together, which is what the compressor needs.


def squeeze(array: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(array.view(np.uint8).reshape(len(array), array.itemsize).T)
    return zstandard.compress(planes.tobytes(), 3)


def unsqueeze(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, len(raw) // width).T).view(kind).ravel()


def squeeze_codes(codes: np.ndarray) -> bytes:
    """Codes numbered from the most frequent on: one byte for the first 255, the others apart."""
    first = zstandard.compress(np.minimum(codes, 255).astype(np.uint8).tobytes(), 3)
    return len(first).to_bytes(4, "little") + first + squeeze((codes[codes >= 255] - 255).astype(np.uint32))


def unsqueeze_codes(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    codes = np.frombuffer(zstandard.decompress(data[4 : 4 + n]), np.uint8).astype(np.uint32)
    codes[codes == 255] += unsqueeze(data[4 + n :], np.uint32)
    return codes


def by_frequency(codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` codes from the most frequent on, and ``codes`` in that numbering."""
    order = np.argsort(-np.bincount(codes, minlength=n), kind="stable")
    rank = np.empty(n, np.uint32)
    rank[order] = np.arange(n, dtype=np.uint32)
    return order, rank[codes]


def squeeze_sorted(keys: np.ndarray) -> bytes:
    """Ascending unsigned keys as differences: a 64-bit hash then takes five to six bytes."""
    return squeeze(np.diff(keys, prepend=keys.dtype.type(0)))


def unsqueeze_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(data, np.uint64), dtype=np.uint64)


def squeeze_bytes(items: list[bytes]) -> bytes:
    lengths = np.fromiter(map(len, items), np.uint32, len(items))
    return zstandard.compress(len(items).to_bytes(4, "little") + lengths.tobytes() + b"".join(items), 3)


def unsqueeze_bytes(data: bytes) -> list[bytes]:
    raw = zstandard.decompress(data)
    n = int.from_bytes(raw[:4], "little")
    ends = np.cumsum(np.frombuffer(raw, np.uint32, n, 4), dtype=np.int64) + 4 + 4 * n
    starts = np.concatenate([[4 + 4 * n], ends[:-1]]) if n else ends
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


def pack_ids(ids: list[int | None]) -> bytes:
    """Ids with their nulls."""
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64())], ["id"])
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack_ids(data: bytes) -> list[int | None]:
    return pa.ipc.open_stream(data).read_all().column(0).to_pylist()


def by_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Ends of the buckets in ascending 64-bit keys: a bucket is a range of hash values."""
    edges = [(b << 64) // buckets for b in range(1, buckets)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(edges, np.uint64)), [len(keys)]])


def merged_counts(data: list[bytes], more: list[bytes]) -> list[bytes]:
    """The ``answer`` of count tables: each key's count over all blocks, in the order of the request."""
    keys, counts = [unsqueeze_sorted(x) for x in data], [unsqueeze(x, np.uint32) for x in more]
    every = np.concatenate(keys)
    distinct, where = np.unique(every, return_inverse=True)
    total = np.zeros(len(distinct), np.uint64)
    np.add.at(total, where, np.concatenate(counts).astype(np.uint64))
    return [squeeze(part) for part in np.split(total[where], np.cumsum([len(k) for k in keys])[:-1])]
