import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from emberlog.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sample(spark, small):
    """The adapted sample events, written once and read back."""
    from emberlog.session import materialise
    from emberlog.sources.sample_events import encounter_events

    return materialise(encounter_events(spark, small), "sample")


@pytest.fixture
def make_events(spark):
    """Frame of typed events from dicts; absent fields are null."""
    from pyspark.sql import types as T

    from emberlog.schemas import EVENT_SCHEMA

    schema = T.StructType(EVENT_SCHEMA.fields + [
        T.StructField("event_date", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("idx", T.LongType()),
    ])

    def make(*rows):
        return spark.createDataFrame(
            [tuple(row.get(f.name) for f in schema.fields) for row in rows], schema
        )

    return make
