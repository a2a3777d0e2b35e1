import re

import pytest

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="session")
def words():
    return lambda text: WORD.findall((text or "").translate(LOW))


@pytest.fixture(scope="session")
def docs(spark):
    """Rows (doc_id, text) as documents with all columns and some that clash with names used inside."""

    def build(rows, schema="doc_id long, text string, lang string, source string, n_chars long, n bigint, name string, key string, size long, _text string"):
        return spark.createDataFrame([(i, t, lang, src, len(t or ""), 1, "x", "y", 3, "z") for i, t, lang, src in rows], schema)

    return build
