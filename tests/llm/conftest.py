import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text[, lang]) with extra columns whose names clash with results."""

    def make(rows, lang="en"):
        data = [(r[0], r[1], r[2] if len(r) > 2 else lang, "s", 0 if r[1] is None else len(r[1]), 7, "x", "y") for r in rows]
        return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, "
                                           "component int, id string, bucket string")

    return make
