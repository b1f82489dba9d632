import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, k1 string, n int, set_id string, words string"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with extra
    columns whose names the operators use for themselves."""
    def run(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or ""),
                 "x", 7, "y", "z") for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)
    return run


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "one two three four five six"), (5, "é日 " * 20)]
