"""Keyed-state operators that built-in streaming operators cannot express.

Each keeps a small state per patient in the state store. Readings wait there until the
watermark has passed them, so they are handled in event-time order however they arrive. They wait
in parts, one per chunk of input and minute of event time, under keys that tell their minute and
first instant: arriving rows are only written, and only parts that are due are read, one minute at
a time. Readings that are alone in their minute share parts of ``LONE`` at most. What a task holds
is a chunk or a minute of one patient and the rest of its shared parts, not the patient's batch.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from bedside_spark.functions.rules import SUSTAINED_RULE, SUSTAINED_SECONDS
from bedside_spark.functions.timekit import micros
from bedside_spark.operators.alerts import alert_id
from bedside_spark.streaming.jobs import DELAY, watermarked

SECOND = 1_000_000
#: Event time whose readings wait, and are read, together.
BUCKET = 60 * SECOND
#: Readings without another one in their minute that wait, and are read, together.
LONE = 128
#: Rows of a result that go out together.
FRAME = 10_000


def _timer_ms(at: float) -> int:
    """First whole millisecond after an instant in microseconds."""
    return int(at // 1000) + 1


def _parts(at: np.ndarray) -> list[np.ndarray]:
    """Positions of ascending instants by the part they wait in.

    A part is a minute. Minutes with a single reading that follow each other share one, of
    ``LONE`` readings at most, as every part costs calls of the state store.
    """
    if not len(at):
        return []
    starts = np.r_[0, np.flatnonzero(np.diff(at // BUCKET)) + 1]
    lone = np.diff(np.r_[starts, len(at)]) == 1
    minute = np.arange(len(starts))
    joined = np.r_[False, lone[1:] & lone[:-1]]
    nth = minute - np.maximum.accumulate(np.where(joined, 0, minute))
    return np.split(np.arange(len(at)), starts[~joined | (nth % LONE == 0)][1:])


class _InOrder(StatefulProcessor):
    """Holds readings back until the watermark passes them, then visits them in order."""

    #: Columns of the result and their types.
    columns: dict[str, str]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState(
            "waiting",
            "bucket bigint, first bigint, part bigint",
            "at array<bigint>, trace array<string>, heart_rate array<double>",
        )
        self.begin(handle)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        held = self._held()
        for chunk in rows:
            at = chunk["at"].to_numpy(np.int64)
            trace = chunk["trace_id"].astype(str).to_numpy(object)
            rate = chunk["heart_rate"].to_numpy(np.float64)
            order = np.argsort(at, kind="stable")
            self._wait(held, at[order], trace[order], rate[order])
        yield from self._release(key, held, passed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._release(key, self._held(), timerValues.getCurrentWatermarkInMs() * 1000)
        yield from self._frames(key, [self.tick(expiredTimerInfo.getExpiryTimeInMs())])

    def _held(self) -> list[tuple]:
        return [tuple(k) for k in self.waiting.keys()]

    def _wait(self, held: list[tuple], at: np.ndarray, trace: np.ndarray, rate: np.ndarray) -> None:
        """Keep readings, in ascending order of time, in parts whose keys join ``held``."""
        number = max((k[2] for k in held), default=0)
        for own in _parts(at):
            number += 1
            first = int(at[own[0]])
            held.append((first // BUCKET, first, number))
            self.waiting.updateValue(held[-1], (at[own].tolist(), trace[own].tolist(), rate[own].tolist()))

    def _release(self, key, held: list[tuple], passed: int) -> Iterator[pd.DataFrame]:
        due = sorted(k for k in held if k[1] <= passed)
        held = [k for k in held if k[1] > passed]
        if due:
            self.load()
            yield from self._frames(key, self._visits(due, held, passed))
        if held:
            self.handle.registerTimer(_timer_ms(min(first for _, first, _ in held)))

    def _visits(self, due: list[tuple], held: list[tuple], passed: int) -> Iterator[list[tuple]]:
        """Results of the due readings; what is left of due parts waits on and joins ``held``."""
        groups = [list(keys) for _, keys in groupby(due, key=lambda k: k[0])]
        at, trace, rate = np.zeros(0, np.int64), np.zeros(0, object), np.zeros(0)
        for keys, after in zip(groups, [*groups[1:], None]):
            parts = [self.waiting.getValue(k) for k in keys]
            at = np.concatenate([at, *(np.array(p[0], np.int64) for p in parts)])
            trace = np.concatenate([trace, *(np.array(p[1], object) for p in parts)])
            rate = np.concatenate([rate, *(np.array(p[2], np.float64) for p in parts)])
            for k in keys:
                self.waiting.removeKey(k)
            order = np.lexsort((trace.astype(str), at))
            at, trace, rate = at[order], trace[order], rate[order]
            # A part may reach beyond the first reading of the next one.
            now = int(np.searchsorted(at, after[0][1], "left") if after else np.searchsorted(at, passed, "right"))
            if now:
                yield self.visit(at[:now], rate[:now])
            at, trace, rate = at[now:], trace[now:], rate[now:]
        self._wait(held, at, trace, rate)
        yield self.store(passed)

    def _frames(self, key, results: Iterable[list[tuple]]) -> Iterator[pd.DataFrame]:
        """Results as frames of some ``FRAME`` rows, as every frame costs an Arrow batch."""
        rows = []
        for found in results:
            rows += found
            if len(rows) >= FRAME:
                yield self._frame(key, rows)
                rows = []
        if rows:
            yield self._frame(key, rows)

    def _frame(self, key, rows: list[tuple]) -> pd.DataFrame:
        columns = {
            name: pd.array(list(values), kind)
            for (name, kind), values in zip(self.columns.items(), zip(*rows))
        }
        return pd.DataFrame({"patient_id": key[0], **columns})

    def load(self) -> None:
        """Take over what earlier readings left."""

    def visit(self, at: np.ndarray, rate: np.ndarray) -> list[tuple]:
        """Results of readings that follow the earlier ones in time."""
        raise NotImplementedError

    def store(self, passed: int) -> list[tuple]:
        """Leave it to later ones."""
        return []

    def tick(self, expired: int) -> list[tuple]:
        return []

    def close(self) -> None:
        pass


class SustainedHigh(_InOrder):
    """Emits the first reading of each run that is ``hold`` after the run's start."""

    columns = {"value": "float64", "at": "int64", "start": "int64"}

    def __init__(self, max_gap_seconds: float, hold_seconds: float) -> None:
        self.max_gap, self.hold = max_gap_seconds * SECOND, hold_seconds * SECOND

    def begin(self, handle: StatefulProcessorHandle) -> None:
        self.run = handle.getValueState("run", "last bigint, start bigint, alerted boolean")

    def load(self) -> None:
        kept = self.run.get() if self.run.exists() else (None, None, False)
        self.last, self.start, self.alerted = kept

    def visit(self, at: np.ndarray, rate: np.ndarray) -> list[tuple]:
        high = rate >= SUSTAINED_RULE.threshold
        before = np.r_[at[0] if self.last is None else self.last, at[:-1]]
        going_on = np.r_[self.start is not None, high[:-1]] & (at - before <= self.max_gap)
        begins = high & ~going_on
        run = np.cumsum(begins)
        # Run 0 is the one that earlier readings left.
        starts = np.r_[0 if self.start is None else self.start, at[begins]][run]
        ripe = np.flatnonzero(high & (at - starts >= self.hold))
        runs, first = np.unique(run[ripe], return_index=True)
        fired = ripe[first][(runs > 0) | (not self.alerted)]
        last_run = int(run[-1])
        self.alerted = last_run in runs or (last_run == 0 and bool(self.alerted))
        self.last, self.start = int(at[-1]), int(starts[-1]) if high[-1] else None
        return list(zip(rate[fired].tolist(), at[fired].tolist(), starts[fired].tolist()))

    def store(self, passed: int) -> list[tuple]:
        self.run.update((self.last, self.start, self.alerted))
        return []


class Silence(_InOrder):
    """Emits a gap when the next reading ends it, and an open gap when event time passes it."""

    columns = {"start": "Int64", "stop": "Int64"}

    def __init__(self, threshold_seconds: float) -> None:
        self.threshold = threshold_seconds * SECOND

    def begin(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "last bigint")

    def load(self) -> None:
        self.last = self.seen.get()[0] if self.seen.exists() else None

    def visit(self, at: np.ndarray, rate: np.ndarray) -> list[tuple]:
        before = np.r_[at[0] if self.last is None else self.last, at[:-1]]
        ends = at - before > self.threshold
        self.last = int(at[-1])
        return list(zip(before[ends].tolist(), at[ends].tolist()))

    def store(self, passed: int) -> list[tuple]:
        self.seen.update((self.last,))
        due = _timer_ms(self.last + self.threshold)
        if due * 1000 <= passed:
            return [(self.last, None)]
        self.handle.registerTimer(due)
        return []

    def tick(self, expired: int) -> list[tuple]:
        if self.seen.exists():
            last = self.seen.get()[0]
            if expired == _timer_ms(last + self.threshold):
                return [(last, None)]
        return []


def _keyed(stream: DataFrame, delay: str):
    return (
        watermarked(stream, delay)
        .select("patient_id", "event_time", "trace_id", "heart_rate")
        .withColumn("at", micros("event_time"))
        .groupBy("patient_id")
    )


def stream_sustained_alerts(
    stream: DataFrame,
    max_gap_seconds: float = 60.0,
    hold_seconds: float = SUSTAINED_SECONDS,
    delay: str = DELAY,
) -> DataFrame:
    """Sustained high heart rate on a stream; same definition as the batch operator."""
    runs = _keyed(stream, delay).transformWithStateInPandas(
        statefulProcessor=SustainedHigh(max_gap_seconds, hold_seconds),
        outputStructType="patient_id string, value double, at bigint, start bigint",
        outputMode="Append",
        timeMode="EventTime",
    )
    event_ts = F.timestamp_micros("at")
    return runs.select(
        "patient_id",
        alert_id(event_ts, F.lit(SUSTAINED_RULE.name)).alias("alert_id"),
        F.lit(SUSTAINED_RULE.name).alias("rule"),
        F.lit(SUSTAINED_RULE.severity).alias("severity"),
        "value",
        F.lit(SUSTAINED_RULE.threshold).alias("threshold"),
        event_ts.alias("event_ts"),
        F.timestamp_micros("start").alias("run_start"),
    )


def stream_data_gaps(stream: DataFrame, threshold_seconds: float, delay: str = DELAY) -> DataFrame:
    """Silences longer than the threshold. A still open one has a NULL ``gap_end``."""
    gaps = _keyed(stream, delay).transformWithStateInPandas(
        statefulProcessor=Silence(threshold_seconds),
        outputStructType="patient_id string, start bigint, stop bigint",
        outputMode="Append",
        timeMode="EventTime",
    )
    return gaps.select(
        "patient_id",
        F.timestamp_micros("start").alias("gap_start"),
        F.timestamp_micros("stop").alias("gap_end"),
    )
