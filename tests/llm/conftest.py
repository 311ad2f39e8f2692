import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, in several partitions, with columns
    whose names clash with those the operators work with."""
    def make(pairs, parts=3):
        from reelrank.llm.common import ship
        ship(spark)
        rows = [(i, t, "en", "s", None if t is None else len(t), i, "k", 7, 1.5, None) for i, t in pairs]
        return spark.createDataFrame(rows, SCHEMA + ", id long, key string, rep int, score double, row string").repartition(parts)
    return make
