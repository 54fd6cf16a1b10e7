import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make(spark, tmp_path):
    """A stored table of documents; extra columns bear names that operators use."""

    def store(rows, schema=DOCS + ", kept boolean, label int", name="docs"):
        width = len(schema.split(","))
        full = [(*r, *[None] * (width - len(r))) for r in rows]
        path = str(tmp_path / name)
        spark.createDataFrame(full, schema).repartition(3).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    return store


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def texts(small):
    import pyarrow.parquet as pq

    rows = pq.read_table(f"{small}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    return {r["doc_id"]: r["text"] for r in rows}
