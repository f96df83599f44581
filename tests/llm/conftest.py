import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
ODD_ROWS = [
    (None, None), (None, "null id"), (1, None), (2, ""), (3, " \n\t\n"), (4, "one two three four five six"),
    (4, "one two three four five six"), (5, "ONE two three four five  six"), (6, "x" * 3000), (7, "word " * 4000),
    (8, "naïve café 日本語 déjà vu !   end \n"), (9, "a\r\nb\x1c c\n\n d "), (-3, "negative id"),
]


@pytest.fixture(scope="session")
def spark():
    from wiremap.session import get_session
    s = get_session("local[4]", app_name="wiremap-llm-tests", shuffle_partitions=4,
                    spark__ui__enabled="false", spark__driver__memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def odd(spark):
    """Rows of every awkward kind, beside columns named like the operators' own."""
    from pyspark.sql import functions as F
    docs = spark.createDataFrame(ODD_ROWS, "doc_id long, text string")
    clash = ["key", "node", "rep", "part", "ids", "kept", "line_dedup", "n_tokens", "v", "y", "a", "size", "notices"]
    return docs.select("*", *[F.lit("clash").alias(c) for c in clash])


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")
