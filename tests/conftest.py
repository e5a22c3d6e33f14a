import pytest

from mattercat.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
           "spark.sql.sources.parallelPartitionDiscovery.parallelism": "4"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """The value of an expression on one row."""
    def value(column, **cells):
        types = {str: "string", float: "double", int: "int", bool: "boolean", type(None): "string"}
        schema = ", ".join(f"{k} {types[type(v)]}" for k, v in cells.items()) or "x int"
        row = tuple(cells.values()) or (0,)
        return spark.createDataFrame([row], schema).select(column).first()[0]

    return value
