import pytest
from pyspark.sql import types as T

#: Columns that clash with names the operators use inside.
EXTRA = ["size", "kept", "fp", "id", "root", "component_id", "group_size", "m", "Target",
         "__id", "__text", "n", "symbol_rate_fence"]


@pytest.fixture
def documents(spark):
    """documents(rows, extra=False): a documents table of (doc_id, text, lang, source)."""
    def make(rows, extra=False):
        fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                  T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                  T.StructField("n_chars", T.LongType())]
        data = [(i, t, g, s, None if t is None else len(t)) for i, t, g, s in rows]
        if extra:
            fields += [T.StructField(c, T.StringType()) for c in EXTRA]
            data = [(*r, *(f"{c}-{r[0]}" for c in EXTRA)) for r in data]
        return spark.createDataFrame(data, T.StructType(fields))
    return make


LONG = " ".join(f"w{i % 977}" for i in range(60_000))

#: Nulls in every column, empty and long texts, ties, repeated rows.
ODD_ROWS = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, None, None, None), (None, "x y", "en", None),
    (None, None, None, None), (4, "same text here", "en", "a"), (5, "same text here", "de", "b"),
    (5, "same text here", "de", "b"), (5, "same text here", "aa", "c"), (6, LONG, "en", "b"),
    (7, LONG, "en", None), (8, " \t\n ", "fr", "a"), (9, "same text her", None, "b"),
    (9, "other words entirely now", None, "b"), (9, "other words entirely now", None, "b"),
]
