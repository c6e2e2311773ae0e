import pyarrow.parquet as pq
import pytest
from cases import EXTRA, SCHEMA, SF, odd_texts


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [(i, t, None if k % 3 == 0 else "en", "src0", None if t is None else len(t), *["clash"] * len(EXTRA))
            for k, (i, t) in enumerate(odd_texts())]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def given_docs():
    """Documents of the smallest tables as a list of dicts."""
    return pq.read_table(f"{SF}/documents.parquet").to_pylist()
