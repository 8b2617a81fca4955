"""Gap sessions of a stream, split on days, kept as state with timers.

Sessions come out as they change: a row gives a session's end and count so far, one with no events takes back a session
that has become part of another, and the last row, when the watermark has passed the session's end by the gap, says that
it is closed. What a reader holds after taking the newest row of every (key, started) equals the batch query over the
same events, in whatever order files arrived within the watermark. State holds open sessions only, never events.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructType

from annoforge.functions.workers import reachable

#: The state store that timers need.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_OPEN = StructType().add("started", LongType()).add("ended", LongType()).add("n_events", LongType()).add("day", LongType())

#: A session: first and last microsecond, events, and the day it began on.
Session = tuple[int, int, int, int]


def joined(sessions: list[Session], gap: int, split_days: bool) -> list[Session]:
    """Sessions in order of time, those within the gap (and on one day) made one."""
    out: list[Session] = []
    for start, end, n, day in sorted(sessions):
        if out and start - out[-1][1] <= gap and not (split_days and day != out[-1][3]):
            was = out[-1]
            out[-1] = (was[0], max(was[1], end), was[2] + n, was[3])
        else:
            out.append((start, end, n, day))
    return out


class Sessions(StatefulProcessor):
    def __init__(self, key: str, gap_seconds: int, split_days: bool):
        self.key, self.gap, self.split_days = key, gap_seconds * 1_000_000, split_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", _OPEN)

    def held(self) -> list[Session]:
        return [tuple(r) for r in self.open.get()]

    def row(self, key: tuple, session: Session, closed: bool) -> Row:
        return Row(**{self.key: key[0], "started": session[0], "ended": session[1], "n_events": session[2], "closed": closed})

    def over_at(self, session: Session) -> int:
        """The first millisecond at which nothing can join a session any more."""
        return (session[1] + self.gap) // 1000 + 1

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        before = self.held()
        after = joined(before + [(r["micros"], r["micros"], 1, r["day"]) for r in rows], self.gap, self.split_days)
        self.open.put(after)
        starts = {s[0] for s in after}
        for s in sorted(set(before) - set(after)):
            if s[0] not in starts:
                yield self.row(key, (s[0], s[1], 0, s[3]), False)
        for s in sorted(set(after) - set(before)):
            self.handle.registerTimer(self.over_at(s))
            yield self.row(key, s, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        at, held = expiredTimerInfo.getExpiryTimeInMs(), self.held()
        over = [s for s in held if self.over_at(s) <= at]
        if over:
            self.open.put([s for s in held if s not in over])
            for s in over:
                yield self.row(key, s, True)

    def close(self) -> None:
        pass


def gap_sessions(events: DataFrame, key: str, at: str, gap_seconds: int, split_days: bool = False, late: str = "1 hour") -> DataFrame:
    """(key, started, ended, n_events, closed) of a stream of events, for update mode; the session must have PROVIDER
    as its state store. Events later than the watermark, `late` behind the newest, are left out. Days are those of the
    session's time zone."""
    reachable(events.sparkSession)
    timed = events.select(F.col(key), F.col(at).cast("timestamp").alias("at")).withWatermark("at", late)
    marked = timed.select(key, "at", F.unix_micros("at").alias("micros"), F.unix_date(F.to_date("at")).cast("bigint").alias("day"))
    schema = StructType().add(events.schema[key]).add("started", LongType()).add("ended", LongType()).add("n_events", LongType()).add("closed", "boolean")
    out = marked.groupBy(key).transformWithState(Sessions(key, gap_seconds, split_days), schema, "Update", "EventTime")
    return out.withColumns({c: F.timestamp_micros(c) for c in ("started", "ended")})


def newest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The sessions as they stand: the newest row of every (key, started), without those taken back."""
    last = rows.groupBy(key, "started").agg(F.max_by(F.struct("ended", "n_events", "closed"), order).alias("r"))
    return last.select(key, "started", "r.*").where("n_events > 0")
