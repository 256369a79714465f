"""Events that aren't published yet: a stream that remembers each and asks again when its time comes.

The state of an event is a few numbers under its id; it goes when the event is there, or in error.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ladderworks.sources import events

#: What an event's rows in a table of matches say: it has rows, it has none, it isn't published, it can't be read.
ROWS, NONE, PENDING, ERROR = "rows", "none", "pending", "error"


def match_table(documents: DataFrame, size: int = events.SIZE) -> DataFrame:
    """The bracket matches of scanned events with the state of each event in one table, so that both are committed together.

    An event with matches has a row for each (state `rows`); one without a bracket, one that isn't published yet and one that
    can't be read have a row without a match. An event that isn't here was never scanned.
    """
    rows = events.judged_matches(documents, size)
    state = F.when(F.col("matched"), ROWS).when(F.col("status") == "PENDING", PENDING).when(F.col("status") == "ERROR", ERROR).otherwise(NONE)
    return rows.withColumns({"State": state, "Reason": F.when(~F.col("matched"), F.col("reason"))}).drop("status", "matched")


def event_states(table: DataFrame, registry: DataFrame) -> DataFrame:
    """EventID and State of each event of a registry; `missing` for one that was never scanned."""
    known = table.groupBy("EventID").agg(F.first("State").alias("State"))
    return registry.select("EventID").distinct().join(known, "EventID", "left").withColumn("State", F.coalesce("State", F.lit("missing")))


def asked_again(statuses: DataFrame, wait_seconds: int = 3600, tries: int = 24, late: str = "10 minutes") -> DataFrame:
    """A stream of EventID, what (found, failed, ask, given up) and tried, from a stream of EventID, status and ts.

    A pending event is asked for again `wait_seconds` after its last answer, `tries` times at most; then it is given up. An
    answer that is OK or an error ends it. Answers to an event that has ended begin anew.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tried, out = (state.get[0] if state.exists else 0), []
        if state.hasTimedOut:
            tried += 1
            if tried > tries:
                out.append("given up")
                state.remove()
            else:
                out.append("ask")
                state.update((tried,))
                state.setTimeoutTimestamp(state.getCurrentWatermarkMs() + 1000 * wait_seconds)
        else:
            rows = pd.concat(list(frames)).sort_values("ts", kind="stable")
            last = rows.iloc[-1]
            if last["status"] == "PENDING":
                state.update((tried,))
                due = int(last["ts"].timestamp() * 1000) + 1000 * wait_seconds
                state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))
            else:
                out.append("found" if last["status"] == "OK" else "failed")
                if state.exists:
                    state.remove()
        yield pd.DataFrame({"EventID": [key[0]] * len(out), "what": out, "tried": [tried] * len(out)})

    rows = statuses.select("EventID", "status", "ts").withWatermark("ts", late)
    return rows.groupBy("EventID").applyInPandasWithState(step, "EventID string, what string, tried int", "tried int", "append", GroupStateTimeout.EventTimeTimeout)
