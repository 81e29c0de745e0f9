import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reelgauge.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def videos(spark):
    """Builds a niche view from short rows; absent fields get plain defaults."""
    from pyspark.sql import functions as F

    from reelgauge import schemas
    from reelgauge.plans.niches import length_class
    from reelgauge.plans.silver import silver_videos

    def build(*rows):
        full = []
        for number, row in enumerate(rows):
            values = {
                "video_id": f"v{number:03d}",
                "title": "plain title",
                "channel_id": "c1",
                "channel_name": "one",
                "published_at": "2024-01-01 10:00:00",
                "duration": "PT10M",
                "definition": "hd",
                "view_count": 100,
                "like_count": 10,
                "comment_count": 1,
                "thumbnail_url": None,
                "extraction_date": "2024-05-01",
                "like_count_missing": False,
                "comment_count_missing": False,
                "niche": "Fitness",
                **row,
            }
            full.append(tuple(values.values()))
        names = [field.name for field in schemas.BRONZE_VIDEO] + ["niche"]
        kinds = {
            field.name: "string" if field.name == "published_at" else field.dataType.simpleString()
            for field in schemas.BRONZE_VIDEO
        }
        frame = spark.createDataFrame(
            full, ", ".join(f"{name} {kinds.get(name, 'string')}" for name in names)
        ).withColumn("published_at", F.to_timestamp("published_at"))
        return silver_videos(frame).withColumn(
            "length_class", length_class(F.col("duration"), F.col("niche"))
        )

    return build


@pytest.fixture(scope="module", autouse=True)
def uncached():
    """What a module has cached would stand in the plans of the next one."""
    yield
    from pyspark.sql import SparkSession

    session = SparkSession.getActiveSession()
    if session is not None:
        session.catalog.clearCache()
