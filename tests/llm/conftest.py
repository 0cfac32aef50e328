import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from gridcast.session import get_spark
    s = get_spark("local[4]", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def odd(spark):
    """Null columns, empty and blank texts, repeated rows, a long text, clashing column names."""
    long_text = " ".join(f"w{i % 977} v{i % 13}" for i in range(60_000))
    rows = [(1, None, "en", "s0"), (2, "", None, None), (3, " \n\t ", "de", "s1"), (4, "one two", "en", "s0"),
            (5, "a b c d e f g h i j k l m n o p q r s t u v w x y z", "en", None),
            (5, "a b c d e f g h i j k l m n o p q r s t u v w x y z", "en", None),
            (6, "A B c d e f g h i j k l m n o p q r s t u v w x y z", None, "s0"), (None, "no id but words enough to count here", "fr", "s2"),
            (None, None, None, None), (7, long_text, "en", "s0"), (8, "é ß 😀 <|im_end|>  x\x00y", "de", "s1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    extra = {c: c for c in ("n", "node", "bucket", "epoch", "mix_epoch", "quality_signals", "score", "span", "key", "token", "row")}
    from pyspark.sql import functions as F
    return df.select("*", *(F.lit(v).alias(k) for k, v in extra.items()))
