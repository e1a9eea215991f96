import pytest
from llm_texts import prose

#: More columns than an operator asks for, some named like its own results.
DOCS = ("doc_id long, text string, lang string, source string, n_chars long, size long, tag string, "
        "fingerprint string, score double, words string, own string, places string, kept string, hits string, key string, "
        "text_key string, owner string, `__dropped` string, `__own` string, `__key` string, `_score` double")


def document_rows(rows):
    return [(doc_id, text, "en", source, len(text) if text is not None else None, 7, "t", "f", 0.5, "w", "o", "p", "k", "h",
             "key", "tk", "ow", "d", "oo", "kk", 0.25)
            for doc_id, text, source in rows]


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        return spark.createDataFrame(document_rows(rows), DOCS)
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """NULL in every column, empty and long texts, copies, repeated rows, ties."""
    long_text = prose(1, 6000)
    shared = prose(2, 70)
    rows = [
        (1, prose(3, 40), "a"), (2, prose(3, 40), "b"), (2, prose(3, 40), "b"), (3, None, "a"), (4, "", None),
        (5, " \t\n ", "c"), (None, prose(4, 12), None), (None, prose(4, 12), None), (None, "x", "c"), (6, long_text, "a"),
        (7, prose(5, 30) + "\n" + shared + "\n" + prose(6, 30), "b"),
        (8, prose(7, 20) + " " + shared + " " + prose(8, 5), "c"), (9, "One", "é"), (10, "one two", "a"),
        (11, "Mail me: a.b@c.org or +1 (555) 010-9999", "a"), (11, "other text", "a"), (12, "same same same " * 40, "b"),
    ]
    return rows


@pytest.fixture(scope="session")
def odd_docs(make_docs, odd_rows):
    return make_docs(odd_rows)
