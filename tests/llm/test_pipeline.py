import hashlib

import public_tokenizers

import corpus_pipeline as c
from matchpeaks.llm import byte_bpe, decontaminate, ngram_join, quality_rules, secret_scan
from matchpeaks.llm.common import stored

SF = "/root/testdata/sf0.01"


def test_stages_against_their_operators(spark):
    """Each stage keeps what its operator, itself held against plain Python, says about the stage's own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    kept = [stored(c.STAGES[0][1](spark, docs, SF), "t")]
    good = {r["doc_id"] for r in quality_rules.quality_rules(docs, labels).where("kept").collect()}
    assert {r["doc_id"] for r in kept[0].collect()} == good
    assert kept[0].join(labels.where("quality = 1"), "doc_id").count() >= 0.95 * docs.join(labels.where("quality = 1"), "doc_id").where("text rlike '(\\\\S+\\\\s+){30}'").count()

    kept.append(stored(c.STAGES[1][1](spark, kept[0], SF), "t"))
    classes = {r["component_id"] for r in ngram_join.ngram_components(kept[0]).collect()}
    assert sorted(r["doc_id"] for r in kept[1].collect()) == sorted(classes)

    kept.append(stored(c.STAGES[2][1](spark, kept[1], SF), "t"))
    passages = [decontaminate.normal(r["text"]) for r in items.collect()]
    texts = {r["doc_id"]: decontaminate.normal(r["text"]) for r in kept[1].collect()}
    leaky = {d for d, t in texts.items() if any(p in t for p in passages)}
    assert leaky and {r["doc_id"] for r in kept[2].collect()} == texts.keys() - leaky

    kept.append(stored(c.STAGES[3][1](spark, kept[2], SF), "t"))
    before, after = ({r["doc_id"]: r["text"] for r in k.collect()} for k in kept[2:])
    assert before.keys() == after.keys() and before != after
    assert not any(secret_scan.base_spans(t) for t in after.values())
    assert all(after[d] == t for d, t in before.items() if not secret_scan.base_spans(t))
    assert all(k.schema == docs.schema for k in kept)

    encoding = byte_bpe.encoding(public_tokenizers.path(byte_bpe.VOCABULARY))
    rows = c.STAGES[4][1](spark, kept[3], SF).collect()
    assert {r["doc_id"]: list(r["ids"]) for r in rows} == {d: encoding.encode_ordinary(t) for d, t in after.items()}
    assert all(r["decoded_sha256"] == hashlib.sha256(after[r["doc_id"]].encode()).hexdigest() for r in rows)


def test_run_is_the_stages_in_order(spark):
    rows = c.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and [name for name, _ in c.STAGES] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "byte-level BPE"]
