from __future__ import annotations

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                       # columns whose names clash with ones used inside
                       *(T.StructField(c, T.StringType()) for c in ("id", "key", "n", "pack", "token", "kept", "start", "_o", "score"))])
EXTRA = ["x"] * 9


@pytest.fixture(scope="session")
def documents(spark):
    """Rows (doc_id, text[, lang]) -> a documents table with extra clashing columns."""
    def make(rows):
        return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1] or ""), *EXTRA) for r in rows], SCHEMA)
    return make


LONG = " ".join(f"word{i % 997} wörd{i % 13}" for i in range(15_000))
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (6, "One, two; three!"), (7, LONG), (8, LONG), (9, "#### 123 ..."),
       (10, "Ünïcode ÀÉ Ω ﬁ é 日本語 " * 30), (11, "a " * 400)]
