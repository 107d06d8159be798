import hashlib
import random

import public_tokenizers
import pytest

from matchpeaks.llm import byte_bpe as b

ODD = ["it's we'll I'd 'S", "tabs\t\t x  \n\n  y \r\n", "12 345 6७8 ½ ²", "😀👍🏽 é ß ſ   x　", "\x00\x1c\x1f\x85 ​", "<|endoftext|>", "a" * 5000, " " * 300, "汉字かな漢", "x y"]


@pytest.mark.parametrize("block", [200, 1 << 20])
def test_as_the_tiktoken_library(spark, documents, block):
    rng = random.Random(8)
    noise = ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2FFF), rng.randrange(0x1F300, 0x1F9FF)])) for _ in range(60)) for _ in range(40)]
    docs = [(d, t) for d, t in documents[:60]] + list(enumerate(ODD + noise, 10_000))
    encoding = b.encoding(public_tokenizers.path(b.VOCABULARY))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    ids = {r["doc_id"]: r for r in b.encode(df, block_bytes=block).collect()}
    digests = {r["doc_id"]: r for r in b.encode(df, block_bytes=block, digests=True).collect()}
    for doc_id, text in docs:
        expected = encoding.encode_ordinary(text)
        assert list(ids[doc_id]["ids"]) == expected
        assert bytes(ids[doc_id]["decoded"]).decode() == text
        assert digests[doc_id]["n_tokens"] == len(expected)
        assert digests[doc_id]["ids_sha256"] == hashlib.sha256(",".join(map(str, expected)).encode()).hexdigest()
        assert digests[doc_id]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_decoding_joins_the_token_table(spark):
    docs = list(enumerate([*ODD, ""]))
    encoded = b.encode(spark.createDataFrame(docs, "doc_id bigint, text string")).select("doc_id", "ids")
    assert {r["doc_id"]: r["text"] for r in b.decode(encoded).collect()} == dict(docs)
