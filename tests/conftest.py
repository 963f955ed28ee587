import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from feedmetrics.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def write_json():
    def write(path, value, **options):
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(value, ensure_ascii=False, **options), encoding="utf-8")

    return write


@pytest.fixture
def items(spark):
    """Python objects -> (seq, item_type, item) rows."""
    from pyspark.sql import functions as F

    def build(values, item_type="story"):
        rows = [(i, json.dumps(v), item_type) for i, v in enumerate(values)]
        return (spark.createDataFrame(rows, "pos bigint, text string, item_type string")
                .select(F.struct("pos").alias("seq"), "item_type", F.parse_json("text").alias("item")))

    return build
