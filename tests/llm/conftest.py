from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows."""
    words = " ".join(f"word{i % 97} other{i}" for i in range(60_000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog. It runs.", "en", "a", 53),
        (1, "The quick brown fox jumps over the lazy dog. It runs.", "en", "a", 53),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, " \n\t ", "xx", None, 4),
        (None, "A row without an id. It has text.", "en", "b", None),
        (None, None, None, "b", None),
        (5, words, "en", "a", len(words)),
        (5, words, "en", "a", len(words)),
        (6, "x" * 50_000, None, "a", 50_000),
        (7, "ä🙂漢字\u0000<s>\u2581 \ufeff end", "de", "c", 14),
        (8, "The quick brown fox jumps over the lazy dog. It runs.", "de", "c", 53),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(odd):
    """Extra columns named like those that operators make."""
    from pyspark.sql import functions as F

    extra = "n_words n_hit hit_spans found_items n_tokens ids begin end score predicted fingerprint shard slot size order id print n set node comp language accepted kept_text n_sentences n_removed rule host path verdict"
    return odd.withColumns({c: F.lit("clash") for c in extra.split()})
