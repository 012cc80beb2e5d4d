import pytest

from tests.conftest import SF_SMALL

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, key string,"
          " path string, target double, fp long, batch int, label double, shard int, word string")


def padded(rows):
    """Documents with columns of clashing names."""
    return [(*r, len(r[1] or ""), -1, "k", "p", 0.5, 7, 3, 1.0, 99, "w") for r in rows]


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark, small):
    """Real documents among nulls, blanks, repeated rows, ties and a very long text."""
    rows = [tuple(r) for r in small.select("doc_id", "text", "lang", "source").orderBy("doc_id").limit(60).collect()]
    long = " ".join(f"{w}{i % 977}" for i, w in enumerate(["the", "of", "and", "thing"] * 30_000))
    rows += [(9000, None, "en", "src1"), (9001, "", "en", None), (9002, " \n\t ", None, "src2"),
             (9003, "one two", "en", "src0"), (None, "a text without any id at all here", "en", "src0"),
             (9004, long, "en", "src0"), (9005, "word " * 50, "en", None), (9006, "\x0b\x0c", None, None),
             (9007, "😀 ünïcode ﬀ 漢字 text", "xx", "é")]
    rows += [(9010, "the very same row again and again", "en", "src0")] * 5
    rows += [(9020 + i, "equal texts under many ids are copies of one another", "en", "src0") for i in range(20)]
    return spark.createDataFrame(padded(rows), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
