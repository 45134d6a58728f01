import os
import random

import pytest

SF = "/root/testdata/sf0.001"

#: Columns that operators use as names of their own results.
CLASHING = ("score", "lang_pred", "mixture", "fp", "shard", "slot", "size", "key", "place", "target", "digest", "license", "kind", "n_tokens",
            "ids", "rank", "__quality", "u", "v")


def words(n, seed=0):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(1, 7))) for _ in range(n))


def edge_rows():
    same = (7, "the same row of words twice over", "en", "s1", 1)
    return [(1, None, "en", "s1", None), (2, "", "en", "s1", 0), (3, " \t\n ", None, "s2", 4), (4, "12345 !!! ###", "fr", None, 9),
            (None, "no id but the words of it are here", "en", "s2", 5), (None, "no id either", None, None, None),
            (5, words(150_000, 5), "en", "s1", 1), (6, "x" * 60_000, "fr", "s3", 1), same, same, same,
            (8, "the same row of words twice over", "en", "s2", 1), (9, "日本語のテキスト ▁ ümlaut   \x1c <|endoftext|> 🙂", "ja", "s4", 3),
            (10, words(400, 1) + " " + words(400, 1), "de", "s4", 3), (11, "one", "de", "", 1)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edge(spark):
    from pyspark.sql import functions as F

    return spark.createDataFrame(edge_rows(), SCHEMA).select("*", *[F.lit("extra").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def tables():
    if not os.path.isdir(SF):
        pytest.skip("supplied tables not present")
    return SF


@pytest.fixture(scope="session")
def documents(spark, tables):
    return spark.read.parquet(f"{tables}/documents.parquet")
