import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from sessionlens.session import DEFAULT_CONF, checkpoint_dir
    builder = (SparkSession.builder.master("local[*]").appName("sessionlens-tests")
               .config("spark.sql.shuffle.partitions", "8"))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    # Tests run without a cluster setting, so they install their own folder.
    checkpoint_dir(session, str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture()
def scratch(spark):
    """A new folder under the shared checkpoint folder for each test run."""
    import uuid

    from sessionlens.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/sessionlens-test-{uuid.uuid4().hex}"
