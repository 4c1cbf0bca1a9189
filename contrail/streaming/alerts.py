"""Stale-feed alerts from a stream: a timer for each source.

A source that sends nothing for more than ``silence`` raises one alert, at
the moment the silence has lasted so long, and its next row clears it. Rows
come out of order within the watermark's delay, so a source's state is the
stretches of time it has been heard in, merged where the gap is no silence:
at most delay / silence of them, and no rows. A stretch is judged when the
watermark has passed its end by the silence; an event-time timer wakes the
source up for that even if it never sends again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from contrail.functions.timefns import instant_of, ntz_of_instant
from contrail.streaming.bounded import DELAY, TIME

SILENCE_MINUTES = 30
ALERTS = "data_source string, alert string, at_us long, since_us long"
_STATE = "starts array<long>, ends array<long>, silent_since long"


def merged(stretches: list[tuple[int, int]], silence: int) -> list[tuple[int, int]]:
    """Stretches in order, joined where the gap between them is at most `silence`."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(stretches):
        if out and begin - out[-1][1] <= silence:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def judged(stretches: list[tuple[int, int]], silent_since: int | None, now: int, silence: int
           ) -> tuple[list[tuple], list[tuple[int, int]], int | None]:
    """(alerts, stretches left, start of an open silence) when all rows up to `now` are in; microseconds."""
    alerts, left = [], list(stretches)
    while left:
        begin, end = left[0]
        if silent_since is not None:
            if now < begin:
                break  # an earlier row may still come
            alerts.append(("cleared", begin, silent_since))
            silent_since = None
        if now <= end + silence:
            break
        alerts.append(("stale", end + silence, end))
        silent_since = end
        left.pop(0)
    return alerts, left, silent_since


def stale_alerts(stream: DataFrame, delay: str = DELAY, silence_minutes: int = SILENCE_MINUTES) -> DataFrame:
    """(data_source, alert, at, silent_since): 'stale' and 'cleared' in append mode, in the order of time per source."""
    silence = silence_minutes * 60_000_000

    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        starts, ends, silent_since = state.get if state.exists else ([], [], None)
        known = list(zip(starts, ends, strict=True))
        for rows in frames:
            known += [(t, t) for t in rows["us"].dropna().astype("int64").unique().tolist()]
        now = state.getCurrentWatermarkMs() * 1000
        alerts, left, silent_since = judged(merged(known, silence), silent_since, now, silence)
        state.update(([b for b, _ in left], [e for _, e in left], silent_since))
        if left:
            wake = left[0][0] if silent_since is not None else left[0][1] + silence
            state.setTimeoutTimestamp(max(wake, now) // 1000 + 1)
        yield pd.DataFrame([(key[0], *a) for a in alerts], columns=["data_source", "alert", "at_us", "since_us"])

    timed = (stream.withColumn("event_time", instant_of(TIME)).withWatermark("event_time", delay)
             .withColumn("us", F.unix_micros("event_time")))
    out = (timed.select("data_source", "event_time", "us").groupBy("data_source")
           .applyInPandasWithState(step, ALERTS, _STATE, "append", GroupStateTimeout.EventTimeTimeout))
    return out.filter("data_source IS NOT NULL").select(  # a heartbeat has no source
        "data_source", "alert", ntz_of_instant(F.timestamp_micros("at_us")).alias("at"),
        ntz_of_instant(F.timestamp_micros("since_us")).alias("silent_since"))
