import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.append(str(Path(__file__).resolve().parent))  # tests that share rows with another file


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from voltmart.session import tune

    session = (
        SparkSession.builder.master("local[4]")
        .appName("voltmart-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture
def make(spark):
    """make("id string, n int", [("a", 1)]) -> DataFrame; texts become timestamps where declared."""
    from pyspark.sql import functions as F

    def build(schema: str, rows: list[tuple]):
        kinds = dict(part.strip().split(" ", 1) for part in schema.split(", "))
        loose = ", ".join(
            f"{name} {'string' if kind == 'timestamp' or kind.startswith('decimal') else kind}"
            for name, kind in kinds.items()
        )
        df = spark.createDataFrame(rows, loose)
        return df.select(*[F.col(name).cast(kind) for name, kind in kinds.items()])

    return build
