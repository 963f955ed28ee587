import datetime as dt
import json

from pyspark.sql import functions as F

from feedmetrics.plans.alerts import alert_messages, alert_text
from feedmetrics.streaming.alarms import error_alarms


def messages(spark, event):
    df = spark.createDataFrame([(json.dumps(event),)], "e string").select(F.parse_json("e").alias("event"))
    return [json.loads(r.m) for r in alert_messages(df).orderBy("record_pos").select(F.to_json("message").alias("m")).collect()]


def test_parse(spark):
    records = [{"Sns": {"Message": '{"AlarmName": "a"}'}}, {"Sns": {"Message": "plain \"text\""}}, {"Sns": {}}, {"Sns": 5}, {},
               {"Sns": {"Message": ""}}, {"Sns": {"Message": "5"}}]
    assert messages(spark, {"Records": records}) == [{"AlarmName": "a"}, {"raw_message": 'plain "text"'}, {"raw_message": "5"}]
    assert messages(spark, {"Records": "x"}) == [] and messages(spark, {}) == []


def text(spark, message):
    df = spark.createDataFrame([(json.dumps(message),)], "m string").select(alert_text(F.parse_json("m")).alias("t"))
    return df.first().t


def test_text(spark):
    full = text(spark, {"AlarmName": "n", "NewStateValue": "ALARM", "NewStateReason": "r", "Region": "eu",
                        "StateChangeTime": "t", "Trigger": {"MetricName": "Errors", "Namespace": "L"}})
    assert full == ("**AWS Pipeline Alert**\n\n**Alarm:** n\n**State:** ALARM\n**Metric:** L/Errors\n**Region:** eu\n"
                    "**Time:** t\n\n**Reason:** r")
    bare = text(spark, {"Trigger": "x", "Region": None})
    assert "**Alarm:** Unknown alarm\n" in bare and "**Metric:** Unknown namespace/Unknown metric\n" in bare
    assert "**Region:** None\n" in bare and bare.endswith("**Reason:** No reason provided")


def test_alarms_batch_and_stream_agree(spark, tmp_path):
    start = dt.datetime(2026, 5, 20, 8, 0)
    rows = [(start + dt.timedelta(minutes=m), fn, n) for m, fn, n in
            ((0, "a", 1), (4, "a", 2), (5, "a", 1), (1, "b", 0), (7, "b", 3), (40, "a", 1), (41, "c", 0))]
    spark.createDataFrame(rows, "ts timestamp, function_name string, errors bigint").write.parquet(str(tmp_path / "in"))
    batch = spark.read.parquet(str(tmp_path / "in"))
    expected = {("a", 0, 3), ("a", 5, 1), ("b", 5, 3), ("a", 40, 1)}

    def result(df):
        return {(r.function_name, int((r.period_start - start).total_seconds() // 60), r.error_count) for r in df.collect()}

    assert result(error_alarms(batch)) == expected
    assert result(error_alarms(batch, threshold=3)) == {("a", 0, 3), ("b", 5, 3)}
    stream = error_alarms(spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in")))
    run = (stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
           .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start())
    run.awaitTermination()
    closed = spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))
    assert result(closed) == expected - {("a", 40, 1)}
