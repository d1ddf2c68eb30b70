import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarry.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", "quarry-tests", shuffle_partitions=4)
    yield s
    s.stop()


def docs_df(spark, texts):
    """A small documents table from a list of texts (ids 0..n-1)."""
    rows = [(i, t, "en", f"src{i % 20}", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
