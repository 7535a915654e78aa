"""Keyed processors against plain loops, with a state store that counts what is read."""

from __future__ import annotations

import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest

from bedside_spark.functions.rules import SUSTAINED_RULE
from bedside_spark.streaming import keyed

SECOND = keyed.SECOND


class Value:
    def __init__(self):
        self.held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value


class Parts:
    """Map state in memory; packed, as a state store keeps it outside the process."""

    def __init__(self):
        self.held, self.read = {}, 0

    def keys(self):
        return iter(list(self.held))

    def updateValue(self, key, value):
        at, trace, rate = value
        self.held[key] = (np.array(at), "\n".join(trace), np.array(rate))

    def getValue(self, key):
        at, trace, rate = self.held[key]
        self.read = max(self.read, len(at))
        return at.tolist(), trace.split("\n"), rate.tolist()

    def removeKey(self, key):
        del self.held[key]


class Handle:
    def __init__(self):
        self.timers = set()

    def getMapState(self, *_):
        return Parts()

    def getValueState(self, *_):
        return Value()

    def registerTimer(self, ms):
        self.timers.add(ms)


class Run:
    """One patient's stream: batches, watermarks and timers as Spark drives them."""

    def __init__(self, processor):
        self.processor, self.handle, self.out = processor, Handle(), []
        processor.init(self.handle)
        self.mark = 0

    def _times(self):
        return SimpleNamespace(getCurrentWatermarkInMs=lambda: self.mark)

    def batch(self, chunks):
        frames = (pd.DataFrame(c, columns=["at", "trace_id", "heart_rate"]) for c in chunks)
        self.out += list(self.processor.handleInputRows(("P1",), frames, self._times()))
        return self

    def watermark(self, micros):
        self.mark = micros // 1000
        for ms in sorted(t for t in self.handle.timers if t <= self.mark):
            self.handle.timers.discard(ms)
            info = SimpleNamespace(getExpiryTimeInMs=lambda ms=ms: ms)
            self.out += list(self.processor.handleExpiredTimer(("P1",), self._times(), info))

    def rows(self):
        found = [tuple(r) for f in self.out for r in f.itertuples(index=False)]
        return [tuple(None if v is pd.NA else v for v in r) for r in found]


def sustained(readings, gap, hold):
    found, last, start, alerted = [], None, None, False
    for at, _, rate in sorted(readings):
        if not rate >= SUSTAINED_RULE.threshold:
            start = None
        elif start is None or at - last > gap:
            start, alerted = at, False
        if start is not None and not alerted and at - start >= hold:
            alerted = True
            found.append(("P1", rate, at, start))
        last = at
    return found


def silences(readings, threshold):
    times = sorted(at for at, _, _ in readings)
    return [("P1", a, b) for a, b in zip(times, times[1:]) if b - a > threshold]


def noise(rng, n):
    high, low = SUSTAINED_RULE.threshold + 5, SUSTAINED_RULE.threshold - 5
    at, rows = 1_700_000_000 * SECOND, []
    for i in range(n):
        at += rng.choice((0, SECOND, SECOND, 7 * SECOND, 70 * SECOND, 400 * SECOND))
        rate = rng.choice((high, high, high, high, low, float("nan")))
        rows.append((at, f"{rng.randrange(10**6)}", rate))
    return rows


@pytest.mark.parametrize("seed", range(12))
def test_batches_in_any_order_give_what_a_loop_gives(seed):
    rng = random.Random(seed)
    rows = noise(rng, 300)
    runs = [Run(keyed.SustainedHigh(60, 15)), Run(keyed.Silence(60))]
    left, done = list(rows), rows[0][0]
    while left:
        take = rng.randrange(1, 80)
        early, left = left[:take], left[take:]
        rng.shuffle(early)
        cut = rng.randrange(len(early) + 1)
        for run in runs:
            run.batch([early[:cut], early[cut:]])
        # The watermark stays behind whatever is still to come.
        done = rng.randrange(done, (left[0][0] if left else rows[-1][0]) + 1)
        for run in runs:
            run.watermark(done)
    for run in runs:
        run.watermark(rows[-1][0] + SECOND)
    assert runs[0].rows() == sustained(rows, 60 * SECOND, 15 * SECOND)
    assert [r for r in runs[1].rows() if r[2] is not None] == silences(rows, 60 * SECOND)
    assert not runs[0].processor.waiting.held


def test_a_million_readings_in_one_batch_stay_in_the_store():
    n, step, size = 1_000_000, SECOND // 10, 10_000
    start = 1_700_000_000 * SECOND
    order = np.random.default_rng(1).permutation(n // size)

    def chunks():
        for c in order.tolist():
            at = start + (np.arange(size) + c * size) * step
            yield {"at": at, "trace_id": "t", "heart_rate": SUSTAINED_RULE.threshold + 1}

    run = Run(keyed.SustainedHigh(60, 15)).batch(chunks())
    waiting = run.processor.waiting
    assert sum(len(v[0]) for v in waiting.held.values()) == n and not run.out
    tracemalloc.start()
    held = tracemalloc.get_traced_memory()[0]
    run.watermark(start + n * step)
    peak = tracemalloc.get_traced_memory()[1] - held
    tracemalloc.stop()
    assert run.rows() == [("P1", SUSTAINED_RULE.threshold + 1, start + 15 * SECOND, start)]
    assert waiting.read <= 60 * SECOND // step and not waiting.held
    assert peak < 20 << 20


def test_only_due_parts_are_read():
    start = 1_700_000_040 * SECOND
    rows = [(start + i * 30 * SECOND, f"{i}", 80.0) for i in range(100)]
    run = Run(keyed.Silence(600)).batch([rows])
    seen = []
    read = run.processor.waiting.getValue
    run.processor.waiting.getValue = lambda k: seen.append(k) or read(k)
    run.watermark(start + 45 * SECOND)
    assert {k[0] for k in seen} == {start // keyed.BUCKET}
    assert len(run.processor.waiting.held) == 49


def test_lone_readings_share_parts_and_results_share_frames():
    start, hour = 1_700_000_040 * SECOND, 3600 * SECOND
    sparse = [(start + i * hour, f"{i:04}", 80.0) for i in range(1000)]
    calls = []
    run = Run(keyed.Silence(600))
    waiting = run.processor.waiting
    for name in ("updateValue", "getValue", "removeKey"):
        own = getattr(waiting, name)
        setattr(waiting, name, lambda *a, own=own: calls.append(a[0]) or own(*a))
    # Shared parts of two chunks reach into each other and over a crowded minute.
    dense = [(start + 77 * hour + i * SECOND, f"d{i}", 80.0) for i in range(1, 40)]
    run.batch([sparse[::2], sparse[1::2], dense])
    assert len(waiting.held) <= 2 * (500 // keyed.LONE + 1) + 1
    run.watermark(start + 100 * hour + 5 * SECOND)
    run.watermark(start + 2000 * hour)
    rows = sorted(sparse + dense)
    assert [r for r in run.rows() if r[2] is not None] == silences(rows, 600 * SECOND)
    assert len(calls) < 60 and len(run.out) < 6 and not waiting.held
