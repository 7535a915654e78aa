"""Changes of day tables that fail between any two steps leave every row once."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from bedside_spark.schemas import READING
from bedside_spark.sinks import files, manifest, tables
from tests.conftest import at, rows


class Crash(Exception):
    pass


@pytest.fixture
def crash_at(monkeypatch):
    """Lets every change of the file system but the first ``n`` fail."""

    def arm(n):
        left = [n]
        for name in ("delete", "move", "write_text"):
            real = getattr(real_files, name)

            def step(*args, _real=real):
                if not left[0]:
                    raise Crash
                left[0] -= 1
                return _real(*args)

            monkeypatch.setattr(files, name, step)

    real_files = type("Real", (), {n: staticmethod(getattr(files, n)) for n in ("delete", "move", "write_text")})
    yield arm
    for name in ("delete", "move", "write_text"):
        monkeypatch.setattr(files, name, getattr(real_files, name))


def readings(spark, days, shift=0.0):
    data = [
        (f"P{p}", "b", at(86_400 * d + 60 * p), None, 80.0 + p + shift, 1.0, 1.0, 95.0, 1.0, 1.0, f"{d}-{p}")
        for d in days
        for p in range(3)
    ]
    return spark.createDataFrame(data, READING).coalesce(1)


def table(spark, path):
    for n, days in enumerate(((0, 1), (1,), (0, 2))):
        tables.write_days(readings(spark, days, n), "event_time", path, "overwrite", n)


def content(spark, path):
    return rows(tables.read_days(spark, path))


def until_it_ends(change, crash_at, check):
    """Run ``change`` with ever later crashes, ``check`` what is left each time."""
    for n in range(60):
        crash_at(n)
        try:
            change()
        except Crash:
            check(n)
        else:
            crash_at(10**9)
            check(None)
            return n
    raise AssertionError("never ended")


def test_compaction(spark, tmp_path, crash_at):
    path = str(tmp_path / "t")
    table(spark, path)
    before = content(spark, path)

    def check(n):
        assert content(spark, path) == before, n

    steps = until_it_ends(lambda: tables.compact_table(spark, path), crash_at, check)
    assert steps > 8 and rows(spark.read.parquet(path), *READING.fieldNames()) == before
    assert all(len(files.folders(spark, f"{path}/{d}")) == 1 for d in tables._days(spark, path))
    # A batch that arrives later is another row set, and the next run takes it in.
    tables.write_days(readings(spark, (1,), 9), "event_time", path, "overwrite", 7)
    more = content(spark, path)
    assert len(more) == len(before) + 3
    tables.compact_table(spark, path)
    assert content(spark, path) == more


def test_replay(spark, tmp_path, crash_at):
    vitals, summary = str(tmp_path / "v"), str(tmp_path / "s")
    table(spark, vitals)
    first, last = (at(86_400 * d).date() for d in (0, 2))
    tables.replay_windows(spark, vitals, summary, first, last)
    old = content(spark, summary)
    tables.write_days(readings(spark, (0, 1), 40), "event_time", vitals, "overwrite", 5)
    fresh = str(tmp_path / "fresh")
    tables.replay_windows(spark, vitals, fresh, first, last)
    new = content(spark, fresh)
    seen = set()

    def check(n):
        now = content(spark, summary)
        assert now in (old, new), n
        seen.add(now == new)

    until_it_ends(lambda: tables.replay_windows(spark, vitals, summary, first, last), crash_at, check)
    assert seen == {True, False} and content(spark, summary) == new != old


def test_retention(spark, tmp_path, crash_at):
    path = str(tmp_path / "t")
    table(spark, path)
    as_of = at(2 * 86_400).date()
    old, new = content(spark, path), rows(tables.read_days(spark, path).where(F.to_date("event_time") >= as_of))

    def check(n):
        assert content(spark, path) in (old, new), n

    until_it_ends(lambda: tables.drop_old_days(spark, path, as_of, 0), crash_at, check)
    assert content(spark, path) == new


def test_manifests_are_numbered_and_few(spark, tmp_path):
    root = str(tmp_path)
    assert manifest.newest(spark, root) == (-1, {})
    for n in range(6):
        manifest.put(spark, root, n, {"n": n})
    assert manifest.newest(spark, root) == (5, {"n": 5})
    assert manifest.newest(spark, root, below=5) == (4, {"n": 4})
    assert len(files.names(spark, f"{root}/{manifest.FOLDER}")) <= 5
