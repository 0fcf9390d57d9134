"""Small tables with the awkward cases, for all operators of the subpackage."""

from __future__ import annotations

DOC = "doc_id long, text string, lang string, source string, n_chars long"
# Columns whose names operators might use themselves.
CLASHING = ("row", "keys", "id", "hash", "kept", "shard", "_row", "_part", "ids", "words", "size", "n", "key")


def docs_of(spark, texts, clash=False):
    """Documents from texts, or (doc_id, text, lang, source) tuples."""
    rows = []
    for i, t in enumerate(texts):
        doc_id, text, lang, source = t if isinstance(t, tuple) else (i, t, "en", f"src{i % 3}")
        rows.append((doc_id, text, lang, source, len(text) if text is not None else None))
    df = spark.createDataFrame(rows, DOC).repartition(3)
    if clash:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("clash") for c in CLASHING})
    return df


def awkward(long_words=3000):
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    return [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, "the the the", None, None),
        (3, "the the the", None, None),
        (4, "the the the", "en", "b"),
        (None, "no id here", "en", "b"),
        (None, None, None, None),
        (5, " \n\t ", "fr", "b"),
        (6, "wörter und mehr " * long_words, "de", "c"),
        (7, "x", "de", "c"),
    ]


def rows(df, *columns):
    return sorted(
        (tuple(r) for r in df.select(*columns).collect()), key=lambda r: tuple((v is not None, str(type(v)), v) for v in r)
    )
