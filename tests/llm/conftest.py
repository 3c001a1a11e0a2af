import pytest


@pytest.fixture
def frame(spark, tmp_path):
    """Rows as a frame read from Parquet in a few partitions, as tables are."""

    def made(rows, schema, parts=3):
        path = str(tmp_path / f"t{len(list(tmp_path.iterdir()))}")
        spark.createDataFrame(rows, schema).repartition(parts).write.parquet(path)
        return spark.read.schema(schema).parquet(path)

    return made

