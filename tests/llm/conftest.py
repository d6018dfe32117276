import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, sequence_id string, score string, _d string, lang_pred long"


@pytest.fixture
def docs_of(spark):
    """Documents with clashing extra columns from (doc_id, text) or (doc_id, text, lang) rows."""
    def make(rows):
        return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1]), "x", "y", "z", "d", 7) for r in rows], SCHEMA)

    return make


LONG = " ".join(f"word{i % 997} and{i % 13}" for i in range(30_000))
EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (5, "ONE"), (6, "Ünïcode ß ☃ text\n\nwith lines\0end"), (7, LONG), (8, LONG), (None, "no id here at all"), (None, None), (9, "$$$ 123")]


@pytest.fixture
def edge(docs_of):
    return docs_of(EDGE)


@pytest.fixture
def nothing(docs_of):
    return docs_of([])
