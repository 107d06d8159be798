import pytest

SF = "/root/testdata/sf0.001"
WORDS = "the of anthe oner sted inges hathe er wasthe only forti shnd reble eanor thin ouan tionly".split()


@pytest.fixture(scope="session")
def documents(spark):
    """(doc_id, text) of the smallest shared table."""
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in any column, empty and long texts, repeated rows and ids, and columns whose names operators use too."""
    long = " ".join(WORDS[i % 16] + str(i * 7919 % 60_013) for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, long), (5, "same text here for both"), (5, "same text here for both"), (None, "no id"), (None, None), (6, "é ß \x00   😀 one"), (7, "a")]
    extra = [(*r, None, None, 7, "x", None) for r in rows]
    return spark.createDataFrame(extra, "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, component_id bigint")


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
