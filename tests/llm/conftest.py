from __future__ import annotations

import pytest

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

TEXT = "The quick brown fox jumps over the lazy dog while seven wizards brew coffee near a quiet harbour under bright northern stars tonight"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return [(row.doc_id, row.text) for row in documents.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{DATA}/labels.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, columns with names used inside."""
    long_text = " ".join(f"word{k}" for k in range(60_000))
    rows = [
        (1, TEXT, "en", "a", 1),
        (2, TEXT, "en", "a", 1),
        (2, TEXT, "en", "a", 1),
        (3, None, "en", "b", None),
        (4, "", None, None, 0),
        (5, " \n\t ", "de", "b", 3),
        (None, TEXT + " and more", "de", None, 7),
        (6, long_text, "en", "c", 9),
        (7, "x " * 50, "en", "c", 9),
        (7, "y " * 50, "en", "c", 9),
        (8, "Ünïcode ЖЖЖ 漢字   idiot\x00 <|endoftext|>   ok", "fr", "d", 9),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F

    names = "size block row key rank place shard vector n fp kept source_size score".split()
    return df.select("*", *(F.lit(k).alias(name) for k, name in enumerate(names)))


@pytest.fixture(scope="session")
def strange(odd):
    """The same rows with columns whose names hold signs and whose types are maps, also inside others."""
    from pyspark.sql import functions as F

    held = F.create_map(F.lit("k"), F.col("n_chars"))
    return odd.withColumns({"my.col": F.lit(1), "a map": held, "`deep`": F.struct(F.array(held).alias("x.y"))})


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
