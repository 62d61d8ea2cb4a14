from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = (
    "kept", "score", "shard", "size", "row", "ref", "text_key", "class_id", "item", "key", "range", "spans",
    "entities", "pattern", "language", "curve", "piece", "length", "held_out", "word", "n", "label", "signature",
)

LINE = "The {0} walked over the old bridge, counted {1} boats and went home before the rain. "
LONG = "".join(LINE.format(w, k) for k, w in enumerate(["farmer", "doctor", "sailor", "writer"] * 900))

ODD = [
    (0, None, "en", "a", None),
    (1, "", None, None, 0),
    (2, " \n\t ", "en", "a", 4),
    (3, "Same words in the same order, every time they are read.", "en", "b", 55),
    (3, "Same words in the same order, every time they are read.", "en", "b", 55),
    (4, "Same words in the same order, every time they are read.", None, "b", None),
    (5, LONG, "en", "a", len(LONG)),
    (6, "12345 !!! ###", None, "c", 13),
    (None, "A text whose row has lost its number on the way to us.", "en", None, 54),
    (None, None, None, None, None),
    (7, "écoutez l'été, 😀 ﬁn de ẛ̣ straße ΑΣ", "fr", "d", 40),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in all columns, empty and long texts, repeats, and columns named like results."""
    from pyspark.sql import functions as F

    return spark.createDataFrame(ODD, SCHEMA).withColumns({c: F.lit("x") for c in CLASHING})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
