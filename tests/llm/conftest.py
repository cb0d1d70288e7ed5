import pytest


@pytest.fixture
def frame(spark):
    """Small frame from rows and a schema string, dealt over three partitions."""
    return lambda rows, schema: spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture
def folder(spark, tmp_path):
    """Write named frames as the Parquet tables of a data folder."""

    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
