import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents from (doc_id, text) pairs, with further columns and one whose name the operators use themselves."""

    def make(pairs, lang=None):
        rows = [(i, t, (lang or {}).get(i, "en"), "src", len(t) if t else 0, "x") for i, t in pairs]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, rep string")

    return make
