import random

import pytest

pytest.importorskip("quire.llm")


@pytest.fixture()
def rng():
    return random.Random(7)


@pytest.fixture(scope="session")
def folder(spark, tmp_path_factory):
    """Write tables given as {name: (rows, schema)} to a folder of Parquet."""

    def write(**tables):
        d = tmp_path_factory.mktemp("tables")
        for name, (rows, schema) in tables.items():
            spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")
        return str(d)

    return write
