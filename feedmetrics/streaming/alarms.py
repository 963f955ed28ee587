"""Error alarms."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PERIOD = "5 minutes"
LATENESS = "10 minutes"


def _breaches(errors: DataFrame, threshold: int, period: str, lateness: str) -> DataFrame:
    """window, function_name, error_count of the periods that reach the threshold."""
    if errors.isStreaming:
        errors = errors.withWatermark("ts", lateness)
    return (errors.groupBy(F.window("ts", period), "function_name")
            .agg(F.sum("errors").alias("error_count"))
            .where(F.col("error_count") >= threshold))


def error_alarms(errors: DataFrame, threshold: int = 1, period: str = PERIOD,
                 lateness: str = LATENESS) -> DataFrame:
    """Periods in which a function's errors reach the threshold.

    Takes (ts timestamp, function_name, errors bigint). A period without data
    raises nothing. On a stream the watermark bounds the state: a period is
    emitted once, when no more rows within the lateness can reach it.
    """
    return _breaches(errors, threshold, period, lateness).select(
        "function_name", F.col("window.start").alias("period_start"), F.col("window.end").alias("period_end"),
        "error_count")


CHANGES = "function_name string, state string, changed_at timestamp"


def alarm_changes(errors: DataFrame, threshold: int = 1, period: str = PERIOD, lateness: str = LATENESS,
                  closed_until: Column | None = None) -> DataFrame:
    """One row for each change of a function's alarm: function_name, state (ALARM or OK), changed_at.

    A function begins OK. The first period that reaches the threshold raises
    the alarm at its start; the first period after it that does not, missing
    ones included, takes it back at that period's start. A period counts once it
    is closed. A table's periods are closed up to ``closed_until``, all of them
    without it. A stream's are closed by the watermark; a timer per function in
    alarm takes the alarm back when the next period closes without a breach. So
    a stream's changes are those of its rows as a table, closed at its watermark.
    """
    breaches = _breaches(errors, threshold, period, lateness)
    if errors.isStreaming:
        return _stream_changes(breaches, int(pd.Timedelta(period).total_seconds() * 1000))
    length = F.expr(f"INTERVAL {period}")
    rows = breaches.select("function_name", F.col("window.start").alias("start"), F.col("window.end").alias("end"))
    if closed_until is not None:
        rows = rows.where(F.col("end") <= closed_until)
    # One row for each period of a function, however many errors there are.
    order = Window.partitionBy("function_name").orderBy("start")
    rows = rows.withColumns({"before": F.lag("end").over(order), "after": F.lead("start").over(order)})
    raised = F.when(F.col("before").isNull() | (F.col("before") < F.col("start")),
                    F.struct(F.lit("ALARM").alias("state"), F.col("start").alias("changed_at")))
    closed = F.lit(True) if closed_until is None else F.col("end") + length <= closed_until
    over = F.when((F.col("after").isNull() | (F.col("after") > F.col("end"))) & closed,
                  F.struct(F.lit("OK").alias("state"), F.col("end").alias("changed_at")))
    return rows.select("function_name", F.inline(F.array_compact(F.array(raised, over))))


class _Changes(StatefulProcessor):
    """Holds the start of the last breach of each function in alarm, in milliseconds, and a timer for what follows."""

    def __init__(self, length: int):
        self.length = length

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.last = handle, handle.getValueState("last", "last bigint")

    def _rows(self, key: tuple, found: list[tuple[str, int]]) -> pd.DataFrame:
        return pd.DataFrame({"function_name": [key[0]] * len(found), "state": [to for to, _ in found],
                             "changed_at": pd.to_datetime([at for _, at in found], unit="ms")})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found, last = [], self.last.get()[0] if self.last.exists() else None
        for start in sorted(int(at) for frame in rows for at in frame["start_ms"]):
            if last is not None and start > last + self.length:
                found.append(("OK", last + self.length))
                last = None
            if last is None:
                found.append(("ALARM", start))
            last = start
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        closes = last + 2 * self.length  # the end of the next period
        if closes <= timerValues.getCurrentWatermarkInMs():
            found.append(("OK", last + self.length))
            self.last.clear()
        else:
            self.last.update((last,))
            self.handle.registerTimer(closes - 1)  # expires once the watermark is beyond it
        yield self._rows(key, found)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last = self.last.get()[0]
        self.last.clear()
        yield self._rows(key, [("OK", last + self.length)])

    def close(self) -> None:
        pass


def _stream_changes(breaches: DataFrame, length: int) -> DataFrame:
    rows = breaches.select("function_name", F.unix_millis("window.start").alias("start_ms"),
                           F.window_time("window").alias("at"))
    return rows.groupBy("function_name").transformWithStateInPandas(
        _Changes(length), outputStructType=CHANGES, outputMode="append", timeMode="eventTime")
