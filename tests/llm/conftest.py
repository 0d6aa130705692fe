import pytest

from martloom.session import ship_package


@pytest.fixture(autouse=True)
def _package_on_executors(spark):
    ship_package(spark)


DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, size string, part string"


@pytest.fixture
def make_docs(spark):
    """Documents with NULLs and extra columns whose names operators use inside."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", s, None if t is None else len(t), "x", "y", "z") for i, t, s in
             ((*r, "a") if len(r) == 2 else r for r in rows)], DOCS)
    return make
