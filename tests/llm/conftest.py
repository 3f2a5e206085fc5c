import os
import sys

import pytest

sys.path.append(os.path.dirname(os.path.abspath(__file__)))   # behind the suite's own folders

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, kept string"


@pytest.fixture
def documents(spark):
    """Make a documents table, with extra columns whose names clash with the operators'."""
    def make(rows):
        return spark.createDataFrame([(i, t, l, s, None if t is None else len(t), "x", "y") for i, t, l, s in rows], DOCS)
    return make
