import pytest

from ledgerloom.session import get_spark


@pytest.fixture(scope="session")
def spark():
    return get_spark("local[*]", shuffle_partitions=8)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


def documents(spark, rows, extra=""):
    """A documents table from (doc_id, text[, lang, source]) rows."""
    full = [(*r, *[None] * (4 - len(r)), len(r[1]) if r[1] else 0) for r in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
