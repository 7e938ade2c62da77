import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents table from (doc_id, text) or (doc_id, text, lang, source)."""
    def make(rows):
        full = [(r[0], r[1], *(r[2:] or ("en", "s")), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA)
    return make


#: Texts that every operator must take: null, empty, blank, odd characters.
ODD = [None, "", " \n\t ", "x", "\x0b\x0c", "é" * 10, "日本語 テキスト", "a\x00b", "ñ́ ß İ", "word " * 3]
