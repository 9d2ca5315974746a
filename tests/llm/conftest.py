import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(os.path.dirname(HERE)), os.path.dirname(HERE), HERE]

from shopweave.llm.common import bounded  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents of texts; ids count from 0."""
    bounded(spark)

    def make(texts, langs=None):
        rows = [(i, t, langs[i] if langs else None, "s", len(t or "")) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOCS)

    return make


@pytest.fixture(scope="session")
def texts(sf_dir):
    """The driver's documents as (doc_id, text) rows."""
    import pyarrow.parquet as pq

    rows = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    return [(r["doc_id"], r["text"]) for r in rows]
