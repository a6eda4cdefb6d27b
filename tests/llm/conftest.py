import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    """``(doc_id, text)`` in the order of ids, on the driver for brute force."""
    return sorted((r.doc_id, r.text) for r in documents.select("doc_id", "text").collect())
