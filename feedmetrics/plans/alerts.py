"""Alert records: parsing and message text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedmetrics.functions import casts


def alert_messages(events: DataFrame) -> DataFrame:
    """``event`` VARIANT -> one row per alert, with ``message`` VARIANT.

    Other columns are kept. A message that is no JSON object is carried as
    ``{"raw_message": text}``; empty ones and malformed records are skipped.
    """
    records = casts.elements_of(F.col("event"), "$.Records")
    others = [name for name in events.columns if name != "event"]
    raw = casts.truthy_text(F.col("record"), "$.Sns.Message")
    parsed = F.try_parse_json("raw")
    plain = F.parse_json(F.to_json(F.struct(F.col("raw").alias("raw_message"))))
    return (events.select(*others, F.posexplode(records).alias("record_pos", "record"))
            .select(*others, "record_pos", raw.alias("raw")).where(F.col("raw").isNotNull())
            .select(*others, "record_pos", F.when(casts.is_object(parsed), parsed).otherwise(plain).alias("message")))


def alert_text(message: Column) -> Column:
    """The text of an alert, with a stand-in for every absent field (not for a null one)."""

    def of(path: str, default: str) -> Column:
        return F.when(casts.kind(message, path) == "VOID", F.lit("None")).otherwise(
            F.coalesce(casts.text_of(message, path), F.lit(default)))

    # The message format and its stand-ins.
    return F.format_string(
        "**AWS Pipeline Alert**\n\n**Alarm:** %s\n**State:** %s\n**Metric:** %s/%s\n"
        "**Region:** %s\n**Time:** %s\n\n**Reason:** %s",
        of("$.AlarmName", "Unknown alarm"), of("$.NewStateValue", "UNKNOWN"),
        of("$.Trigger.Namespace", "Unknown namespace"), of("$.Trigger.MetricName", "Unknown metric"),
        of("$.Region", "Unknown region"), of("$.StateChangeTime", "Unknown time"),
        of("$.NewStateReason", "No reason provided"))
