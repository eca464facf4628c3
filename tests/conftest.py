import pytest

from gleanery.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "3g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def one(spark):
    """Evaluate a column on the given values: ``one(fn, value, ...)``."""

    def evaluate(expression, *values, schema=None):
        names = [f"c{i}" for i in range(len(values))]
        schema = schema or ", ".join(f"{n} string" for n in names)
        from pyspark.sql import functions as F

        df = spark.createDataFrame([values], schema)
        return df.select(expression(*[F.col(c) for c in df.columns]).alias("out")).first()["out"]

    return evaluate
