import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, id long, row long"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents with columns whose names the operators use themselves."""

    def make(texts, ids=None, source="s", langs=None):
        ids = list(range(len(texts))) if ids is None else ids
        langs = langs or ["en"] * len(texts)
        rows = [
            (key, text, lang, source, None, "d", 9, 9)
            for key, text, lang in zip(ids, texts, langs, strict=True)
        ]
        return spark.createDataFrame(rows, SCHEMA)

    return make
