import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from fundlake.llm.common import make_importable  # noqa: E402
from fundlake.session import build_session  # noqa: E402

#: Nulls, empty and long texts, ties and repeated rows, extra columns with clashing names.
HARD = [
    (1, "the cat sat on the mat and the dog ran", "en"), (1, "the cat sat on the mat and the dog ran", "en"),
    (2, None, None), (3, "", "en"), (4, "   \n\t ", "en"), (None, "a text without an id", "de"), (None, None, None),
    (5, "Ein  Satz mit Umlauten äöü und 日本語 <|endoftext|> end", "de"), (6, "x" * 20_000, "en"),
    (7, "word " * 30_000, "en"), (8, "it's we'll 're '", "en"), (9, "the cat sat on the mat and the dog ran", "fr"),
]
SCHEMA = "doc_id long, text string, lang string"


@pytest.fixture(scope="session")
def spark():
    s = build_session(4, app="fundlake-llm-tests", shuffle_partitions=5)
    make_importable(s)
    yield s


@pytest.fixture(scope="session")
def hard(spark):
    """Documents with every hard case, and extra columns that clash with the operators' own."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(HARD, SCHEMA).repartition(3)
    for name in ("score", "id", "fp", "component_id", "tie", "_range", "ids", "sample", "n_tokens", "part"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    """A small slice of real documents for brute-force comparisons."""
    path = "/root/testdata/sf0.001/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("test data not present")
    return spark.read.parquet(path)
