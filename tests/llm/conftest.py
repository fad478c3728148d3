import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

ODD = [(1, "alpha beta gamma delta epsilon", "en", "a"), (1, "alpha beta gamma delta epsilon", "en", "a"), (2, None, None, None),
       (3, "", "en", "b"), (None, "one two three", "fr", None), (4, "\n \t\n", "de", "b"), (5, "é" * 50_000 + " x\\y " * 20_000, "fr", "c")]
SCHEMA = "doc_id bigint, text string, lang string, source string"


@pytest.fixture
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns whose names clash with inner ones."""
    from pyspark.sql import functions as F
    return spark.createDataFrame(ODD, SCHEMA).withColumns({c: F.lit("clash") for c in ("n", "key", "point", "_id", "n_lines", "size", "first", "spans")})


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
