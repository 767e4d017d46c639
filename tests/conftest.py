import pytest

from tallyframe.session import builder


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = (
        builder("tests", "local[8]")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(root / "warehouse"))
        .config("spark.checkpoint.dir", str(root / "checkpoints"))
        .config("spark.sql.shuffle.partitions", "4")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df) -> str:
    """The physical plan before adaptive execution changes it."""
    return df._jdf.queryExecution().executedPlan().toString()
