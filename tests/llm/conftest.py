import pytest
from pyspark.sql import types as T

#: Other columns, some named like what the operators make or use inside; all are to be ignored or passed through.
CLASHES = ("score", "lang_pred", "kept", "_text", "words", "th", "m", "node", "n_words", "rule", "bucket", "a.b")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows and clashing columns."""
    long_text = " ".join(f"word{i % 977} and{i}" for i in range(12_000))
    base = "the quick brown fox jumps over the lazy dog while seven wizards mix strange potions in an old copper pot near the river"
    rows = [
        (1, None, "en"), (2, "", "en"), (3, "  \n\t ", None), (4, base, "en"), (5, base, "en"), (5, base, "en"),
        (6, base + " tonight", "en"), (7, long_text, "de"), (8, "\u00e9t\u00e9 \u00e0 la plage, \u540d\u524d \U0001f600", "fr"), (9, "12 34 +-", "fr"),
        (None, base, None), (None, None, None), (10, "x" * 300, "es"), (11, "ana@mail.example.com and +1 (269) 555-3296 4524132264652876 on 10.0.0.1", "es"),
        (12, "short", "en"), (13, "short", None), (14, "a a a a a a a a a a a a", "en"),
    ]
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), *(T.StructField(c, T.StringType()) for c in CLASHES),
    ])
    full = [(i, t, lang, "s", len(t or ""), *("?" for _ in CLASHES)) for i, t, lang in rows]
    return spark.createDataFrame(full, schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
