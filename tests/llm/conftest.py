import pytest

CLASH = ["rest", "key", "size", "tag", "score", "node", "component", "count", "fp", "h"]


@pytest.fixture()
def docs(spark):
    """Documents from (doc_id, text) pairs, with columns whose names the operators use too."""
    def make(rows, lang=None, source=None):
        full = [(i, t, lang[n] if lang else "en", source[n] if source else "a", -1, *["x"] * len(CLASH))
                for n, (i, t) in enumerate(rows)]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, "
                  + ", ".join(f"{c} string" for c in CLASH))
    return make

