import pytest
from pyspark.sql import SparkSession

from perplexis.session import configured


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        configured(SparkSession.builder.master("local[4]").appName("tests"))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
