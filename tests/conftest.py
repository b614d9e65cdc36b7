import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from ratecraft.session import configure

    session = (SparkSession.builder.master("local[4]").appName("ratecraft-tests")
               .config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g")
               .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()
