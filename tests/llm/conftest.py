import pytest
from edge_cases import SCHEMAS, conversations, documents, embeddings


@pytest.fixture(scope="session")
def edge(spark, tmp_path_factory):
    return _write(spark, tmp_path_factory.mktemp("edge"), {"documents": documents(), "embeddings": embeddings(), "conversations": conversations()})


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    return _write(spark, tmp_path_factory.mktemp("empty"), dict.fromkeys(SCHEMAS, []))


def _write(spark, path, tables):
    for name, rows in tables.items():
        spark.createDataFrame(rows, SCHEMAS[name]).repartition(3).write.parquet(f"{path}/{name}.parquet")
    return str(path)
