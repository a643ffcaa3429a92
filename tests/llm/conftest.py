import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes documents of (doc_id, text) or (doc_id, text, lang), in several partitions."""

    def make(rows, **more):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, COLUMNS).repartition(3)

    return make


@pytest.fixture(scope="session")
def clashing(spark):
    """Extra columns named like those the operators use inside."""
    from pyspark.sql import functions as F

    def add(df):
        names = ["text_hash", "_hash", "_ranges", "ranges", "fp", "k", "row", "kept", "count", "component", "held_out", "pattern", "fill"]
        return df.withColumns({n: F.lit(n) for n in names})

    return add
