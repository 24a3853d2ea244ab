import pytest

DOC = "doc_id long, text string, lang string, source string, fp long, uid string, component_id string"


@pytest.fixture
def docs(spark):
    """Make a documents table from texts (or (id, text) pairs), with extra columns whose names the operators use inside."""

    def make(rows, partitions=3):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame([(i, t, "en", "s", 7, "u", "c") for i, t in rows], DOC).repartition(partitions)

    return make
