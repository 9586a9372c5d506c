import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ebbtide.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "ebbtide-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.maxMetadataStringLength": "4000",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def gold(spark, tmp_path_factory):
    """The feature table of the smallest test set, stored once."""
    from ebbtide.plans import jobs
    from ebbtide.sources.files import read_table, write_table
    from ebbtide.sources.star_schema import shop_tables

    path = str(tmp_path_factory.mktemp("features") / "gold")
    write_table(jobs.gold(shop_tables(spark, DATA)).drop("snapshot_date"), path)
    return read_table(spark, path)
