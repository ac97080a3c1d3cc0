"""Early firing: every window hands out what arrived since its last pane, at the latest a fixed processing
time after the pane's first row.

State is keyed by platform, channel and slice and lists the sums, per window, that no pane has brought
yet. A firing clears the list, so state is bounded by what arrives within one delay. A hot key is cut
into slices by a hash of its rows: panes are discarding sums, so those of all slices add up to the window
whatever the number of slices. What fires depends on the batch's logged time alone, so a batch that is run
again after a failure brings the same panes. No row is too late: it opens a pane of its own
(``PaneSink`` closes windows).
"""

from __future__ import annotations

import time
from collections import defaultdict
from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from coinslot.functions.expr import MONEY
from coinslot.streaming.windows import KEYS, SIZE, SLIDE

#: Milliseconds of processing time from the first row of a pane to its firing.
DELAY_MS = 5000
SLICES = 8
#: Money as whole units of the last decimal place, so Python sums exactly.
UNITS = 10_000
_FIRED = "platform string, channel_code string, slice int, start_us bigint, units decimal(38,0), events bigint, fired_ms bigint"


class EarlyFiring(StatefulProcessor):
    """Per key, the sums by window since the last pane; one timer hands them out together."""

    def __init__(self, delay_ms: int = DELAY_MS):
        self.delay_ms = delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", "start_us bigint, units decimal(38,0), events bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        waiting = self.pending.exists()
        for batch in rows:
            units: dict[int, int] = defaultdict(int)
            for start, amount in zip(batch["start_us"].tolist(), batch["units"].tolist()):
                units[start] += int(amount)
            events = batch.groupby("start_us").size()
            self.pending.appendList([(s, Decimal(u), int(events[s])) for s, u in units.items()])
        if not waiting:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.delay_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        units: dict[int, int] = defaultdict(int)
        events: dict[int, int] = defaultdict(int)
        for start, amount, n in self.pending.get():
            units[start] += int(amount)
            events[start] += n
        self.pending.clear()
        platform, channel, part = key
        starts = sorted(units)
        yield pd.DataFrame(
            {
                "platform": [platform] * len(starts), "channel_code": [channel] * len(starts), "slice": [part] * len(starts),
                "start_us": starts, "units": [Decimal(units[s]) for s in starts], "events": [events[s] for s in starts],
                "fired_ms": [expiredTimerInfo.getExpiryTimeInMs()] * len(starts),
            }
        )

    def close(self) -> None:
        pass


def early_panes(
    events: DataFrame, delay_ms: int = DELAY_MS, slices: int = SLICES, size: str = SIZE, slide: str = SLIDE,
    at: str = "occurred_at",
) -> DataFrame:
    """Discarding panes of a stream of events: window, platform, channel, slice, sum, rows, time of firing.

    A null time falls into no window; a null amount counts as a row and adds nothing.
    """
    part = F.pmod(F.xxhash64(*events.columns), F.lit(slices)).cast("int")
    units = F.coalesce(F.col("net_revenue").cast(MONEY) * UNITS, F.lit(0)).cast("decimal(38,0)")
    window = F.window(at, size, slide)
    cells = events.withColumn("slice", part).select(*KEYS, "slice", F.unix_micros(window["start"]).alias("start_us"), units.alias("units"))
    fired = cells.groupBy(*KEYS, "slice").transformWithStateInPandas(
        EarlyFiring(delay_ms), outputStructType=_FIRED, outputMode="append", timeMode="processingTime"
    )
    start = F.timestamp_micros("start_us")
    return fired.select(
        start.alias("window_start"), (start + F.expr(f"INTERVAL {size}")).alias("window_end"), *KEYS, "slice",
        (F.col("units") / UNITS).cast("decimal(38,4)").alias("pane"), "events", F.timestamp_millis("fired_ms").alias("fired_at"),
    )


def finish_when_drained(query: StreamingQuery, timeout: float = 3600.0, poll: float = 0.2) -> StreamingQuery:
    """Ends a stream over stored files once a batch found no new file and left nothing in state.

    A stream with processing-time timers always has another batch to run, so it does not end by itself, also
    under ``availableNow``. Where batches take longer than the trigger interval there is no pause between two of
    them; the batch that is stopped then has neither rows nor state, so nothing is lost with it. A file without
    rows moves the source's offset and is no end.
    """
    until = time.monotonic() + timeout
    while query.isActive:
        seen = query.lastProgress
        at_end = seen is not None and seen["numInputRows"] == 0 and all(s["startOffset"] == s["endOffset"] for s in seen["sources"])
        if at_end and not any(s["numRowsTotal"] for s in seen["stateOperators"]):
            query.stop()
            return query
        if time.monotonic() > until:
            query.stop()
            raise TimeoutError("the stream still has input or state")
        time.sleep(poll)
    if query.exception() is not None:
        raise query.exception()
    return query
