import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from authledger.session import get_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sample():
    return SMALL


@pytest.fixture(scope="session")
def sample_lake(spark, sample):
    """All tables of the sample as the batch jobs store them."""
    import __spark_entry__ as registry

    return registry.Model(spark, sample).lake


@pytest.fixture
def shared_lake(sample_lake, monkeypatch):
    """Queries read the lake that is there instead of storing one each."""
    import __spark_entry__ as registry

    monkeypatch.setattr(registry.Model, "lake", sample_lake)
