import pytest


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    """Small tables: few partitions keep the tests short."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
