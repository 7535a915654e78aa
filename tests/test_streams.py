from __future__ import annotations

import json
import os
from datetime import timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from bedside_spark.operators import alerts, timeseries, windows
from bedside_spark.schemas import READING
from bedside_spark.sinks import manifest, outbox, streams, tables
from bedside_spark.sources import derived, readings
from bedside_spark.streaming import jobs, keyed
from tests.conftest import SMALL, START, at, rows

FIELDS = [f.name for f in READING]


@pytest.fixture(scope="module")
def arrivals(spark, tmp_path_factory):
    """Readings in arrival order over four files, read one file per batch."""
    path = str(tmp_path_factory.mktemp("arrivals"))
    source = derived.declared(READING, derived.readings(spark, SMALL))
    bounds = source.agg(F.percentile_approx("ingestion_time", [0.25, 0.5, 0.75])).first()[0]
    edges = [None, *bounds, None]
    for n, (low, high) in enumerate(zip(edges, edges[1:])):
        part = source
        if low is not None:
            part = part.where(F.col("ingestion_time") > F.lit(low))
        if high is not None:
            part = part.where(F.col("ingestion_time") <= F.lit(high))
        part.coalesce(1).write.parquet(f"{path}/n={n}")
    return path, source


def stream_of(spark, path):
    stream = spark.readStream.schema(READING).option("maxFilesPerTrigger", 1)
    return stream.parquet(f"{path}/n=*")


def collected(spark, stream, tmp_path):
    path = str(tmp_path / "out")
    writer = stream.writeStream.format("parquet").option("path", path)
    writer = writer.option("checkpointLocation", str(tmp_path / "c")).outputMode("append")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def closed(df, source, column="window_end"):
    passed = source.agg(F.max("event_time")).first()[0] - timedelta(seconds=10)
    return df.where(F.col(column) <= F.lit(passed))


@pytest.mark.parametrize("kind", ["tumble", "hop"])
def test_windows_equal_batch(spark, arrivals, tmp_path, kind):
    path, source = arrivals
    delay = "1 hour"  # arrivals are at most 599 s late, so nothing is dropped
    live = {"tumble": jobs.stream_tumble, "hop": jobs.stream_hop}[kind]
    batch = {"tumble": windows.tumble, "hop": windows.hop}[kind]
    got = collected(spark, live(stream_of(spark, path), delay=delay), tmp_path)
    end = source.agg(F.max("event_time")).first()[0] - timedelta(hours=1)
    expected = batch(source).where(F.col("window_end") <= F.lit(end))
    assert rows(got) == rows(expected)


def test_late_rows_are_dropped(spark, tmp_path):
    """Late input is judged by the watermark of the batch before, hence the reading at 201 s."""
    values = ((5, 80.0), (200, 80.0), (201, 80.0), (6, 190.0))
    for n, (second, rate) in enumerate(values):
        data = [("P1", "b", at(second), None, rate, 1.0, 1.0, 95.0, 1.0, 1.0, f"{n}")]
        spark.createDataFrame(data, READING).coalesce(1).write.parquet(str(tmp_path / f"in/n={n}"))
    got = collected(spark, jobs.stream_tumble(stream_of(spark, str(tmp_path / "in"))), tmp_path)
    assert rows(got, "max_heart_rate", "reading_count") == [(80.0, 1)]


def test_three_sinks(spark, arrivals, tmp_path):
    path, source = arrivals
    for query in jobs.start_vitals_job(stream_of(spark, path), str(tmp_path), every=None):
        query.awaitTermination()
    vitals = spark.read.parquet(str(tmp_path / "vitals"))
    assert rows(vitals, *FIELDS) == rows(source, *FIELDS)
    tumbled = spark.read.parquet(str(tmp_path / "vitals_1m"))
    assert tumbled.groupBy("patient_id", "window_start").count().where("count > 1").count() == 0


def test_restart_adds_nothing(spark, arrivals, tmp_path):
    path, source = arrivals
    for _ in range(2):
        streams.append_days(
            jobs.stream_events(stream_of(spark, path)), "event_time",
            str(tmp_path / "t"), str(tmp_path / "c"), None,
        ).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "t")).count() == source.count()


def test_latest_over_batches(spark, arrivals, tmp_path):
    path, source = arrivals
    root = str(tmp_path / "latest")
    stream = jobs.stream_events(stream_of(spark, path))
    streams.keep_latest(stream, root, str(tmp_path / "c"), None).awaitTermination()
    expected = alerts.latest_state(jobs.stream_events(source))
    assert rows(streams.latest_table(spark, root), *expected.columns) == rows(expected)


def test_sustained_over_batches(spark, arrivals, tmp_path):
    path, source = arrivals
    stream = keyed.stream_sustained_alerts(stream_of(spark, path), 86_400, delay="1 hour")
    end = source.agg(F.max("event_time")).first()[0] - timedelta(hours=1)
    expected = alerts.sustained_alerts(source, 86_400).where(F.col("event_ts") <= F.lit(end))
    got = collected(spark, stream, tmp_path)
    columns = ("patient_id", "alert_id", "value", "event_ts", "run_start")
    assert expected.count() and rows(got, *columns) == rows(expected, *columns)


def test_gaps_over_batches(spark, arrivals, tmp_path):
    path, source = arrivals
    stream = keyed.stream_data_gaps(stream_of(spark, path), 86_400, delay="1 hour")
    end = source.agg(F.max("event_time")).first()[0] - timedelta(hours=1)
    expected = timeseries.data_gaps(source, 86_400).where(F.col("gap_end") <= F.lit(end))
    got = collected(spark, stream, tmp_path).where("gap_end is not null")
    columns = ("patient_id", "gap_start", "gap_end")
    assert expected.count() and rows(got, *columns) == rows(expected, *columns)


def test_dedup_over_batches(spark, arrivals, tmp_path):
    path, source = arrivals
    source.coalesce(1).write.parquet(f"{tmp_path}/in/n=0")
    source.where("trace_id < '8'").coalesce(1).write.parquet(f"{tmp_path}/in/n=1")
    both = spark.readStream.schema(READING).parquet(f"{tmp_path}/in/n=*")
    got = collected(spark, jobs.stream_dedup(both, "1 hour"), tmp_path)
    assert rows(got, "trace_id") == rows(source, "trace_id")


@pytest.mark.parametrize("salts", [1, 4])
def test_enrich(spark, arrivals, tmp_path, salts):
    path, source = arrivals
    people = derived.listed_patients(spark, SMALL).select("patient_id", "gender")
    got = collected(spark, jobs.stream_enrich(stream_of(spark, path), people, salts), tmp_path)
    expected = source.join(people, "patient_id", "left")
    assert rows(got, *expected.columns) == rows(expected)


def test_json_source_and_start(spark, tmp_path):
    lines = "\n".join(
        f'{{"patient_id": "P{i}", "event_time": "2026-09-15T12:00:0{i}.000{zone}", "heart_rate": 8{i}}}'
        for i, zone in enumerate(("Z", "+00:00", "Z"))
    )
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(lines)
    source = str(tmp_path / "in")

    def ids(name, start):
        folder = tmp_path / name
        (folder / "q").mkdir(parents=True)
        got = collected(spark, readings.read_vitals_stream(spark, source, start=start, mark=f"{folder}/mark"), folder / "q")
        assert got.where("ingestion_time is null").count() == 0
        return [r[0] for r in rows(got, "patient_id")]

    assert ids("all", "earliest") == ["P0", "P1", "P2"]
    assert ids("instant", at(1)) == ["P1", "P2"]
    assert ids("new", "latest") == []


def test_delivery_isolates_failures_and_sends_once(spark, tmp_path):
    from tests.test_alerts import change

    def send(message):
        if message["alert_id"] == "A-bad":
            raise ValueError("refused")

    folder = tmp_path / "feed"
    days = [
        [change("INSERT"), change("MODIFY"), change("INSERT", alert="A-bad")],
        [change("MODIFY"), change("MODIFY", alert="A-bad"), change("INSERT", alert="A-new")],
    ]
    ledger, seen = str(tmp_path / "ledger"), []
    for n, day in enumerate(days):
        spark.createDataFrame(day, "op string, image string").coalesce(1).write.parquet(f"{folder}/n={n}")
        stream = spark.readStream.schema("op string, image string").parquet(f"{folder}/n=*")
        stream = stream.withColumn("image", F.parse_json("image"))
        streams.deliver_alerts(stream, send, ledger, str(tmp_path / "c"), None).awaitTermination()
        got = spark.read.parquet(ledger).where(F.col("batch_id") == n)
        seen.append({(r.alert_id, r.delivered, r.error) for r in got.collect()})
    assert seen[0] == {("A-1", True, None), ("A-bad", False, "ValueError: refused")}
    assert seen[1] == {("A-new", True, None), ("A-bad", False, "ValueError: refused")}


def test_alert_repeats_are_dropped(spark, arrivals, tmp_path):
    path, source = arrivals
    for n in range(2):
        source.coalesce(1).write.parquet(f"{tmp_path}/in/n={n}")
    twice = spark.readStream.schema(READING).parquet(f"{tmp_path}/in/n=*")
    got = collected(spark, jobs.stream_threshold_alerts(twice), tmp_path)
    expected = alerts.threshold_alerts(source)
    assert rows(got, *expected.columns) == rows(expected)


def test_late_report(spark, arrivals, tmp_path):
    _, source = arrivals
    path, out, marks = (str(tmp_path / n) for n in ("in", "late", "marks"))
    for n in range(4):
        mixed = source.where(F.pmod(F.xxhash64("trace_id"), F.lit(4)) == n)
        mixed.coalesce(1).write.parquet(f"{path}/n={n}")
    for _ in range(2):
        streams.report_late(
            stream_of(spark, path), out, marks, str(tmp_path / "c"), every=None
        ).awaitTermination()
    expected, newest = set(), None
    for n in range(4):
        batch = spark.read.schema(READING).parquet(f"{path}/n={n}").collect()
        for row in batch:
            closes = row.event_time.replace(second=0, microsecond=0) + timedelta(minutes=1)
            if newest is not None and closes <= newest - timedelta(seconds=10):
                expected.add(row.trace_id)
        newest = max([r.event_time for r in batch] + ([newest] if newest else []))
    got = spark.read.schema(READING).parquet(f"{out}/*").select("trace_id").collect()
    assert sorted(r[0] for r in got) == sorted(expected)
    assert expected


def test_late_side_output(spark, arrivals, tmp_path):
    """Rows of batches in order of arrival are split as a loop over all of them splits them."""
    path, source = arrivals
    out = [str(tmp_path / n) for n in ("t", "late", "marks", "c")]
    for _ in range(2):
        streams.split_late(stream_of(spark, path), *out, every=None).awaitTermination()
    expected, newest = {}, None
    for row in sorted(source.collect(), key=lambda r: (r.ingestion_time, r.trace_id)):
        closes = row.event_time.replace(second=0, microsecond=0) + timedelta(minutes=1)
        late = newest is not None and closes <= newest - timedelta(seconds=10)
        expected[row.trace_id] = (newest - timedelta(seconds=10) - closes).total_seconds() if late else None
        newest = max(newest, row.event_time) if newest else row.event_time
    late = dict(rows(spark.read.parquet(out[1]), "trace_id", "seconds_late"))
    assert late == {k: v for k, v in expected.items() if v is not None} and late
    in_time = [r[0] for r in rows(tables.read_days(spark, out[0]), "trace_id")]
    assert in_time == sorted(k for k, v in expected.items() if v is None)


def test_a_restart_keeps_what_arrived_meanwhile(spark, tmp_path):
    (tmp_path / "in").mkdir()
    source, mark = str(tmp_path / "in"), str(tmp_path / "mark")

    def line(n):
        return f'{{"patient_id": "P{n}", "event_time": "2026-09-15T12:00:00Z", "heart_rate": 80}}'

    def run():
        stream = readings.read_vitals_stream(spark, source, start="latest", mark=mark)
        streams.append_days(
            stream, "event_time", str(tmp_path / "t"), str(tmp_path / "c"), None
        ).awaitTermination()

    run()
    (tmp_path / "in" / "late.json").write_text(line(1))
    run()
    table = tables.read_days(spark, str(tmp_path / "t"))
    assert [r[0] for r in rows(table, "patient_id")] == ["P1"]
    with pytest.raises(ValueError):
        readings.read_vitals_stream(spark, source, start="latest")


def test_upkeep_between_runs_of_a_stream(spark, arrivals, tmp_path):
    """Stream, compact, replay and drop days, stream on: nothing is lost or read twice."""
    path, source = arrivals
    vitals, summary = str(tmp_path / "v"), str(tmp_path / "s")
    (tmp_path / "in").mkdir()

    def run(part):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(READING).parquet(str(tmp_path / "in"))
        for df, time, to in (
            (stream, "event_time", vitals), (windows.tumble(stream.withWatermark("event_time", "0 seconds")), "window_start", summary),
        ):
            streams.append_days(df, time, to, f"{to}.c", None).awaitTermination()

    halfway = source.agg(F.percentile_approx("event_time", 0.5)).first()[0]
    run(source.where(F.col("event_time") <= F.lit(halfway)))
    day = halfway.date() - timedelta(days=2)
    tables.compact_table(spark, vitals)
    tables.replay_windows(spark, vitals, summary, day, day)
    gone = tables.drop_old_days(spark, vitals, day, 5)
    run(source.where(F.col("event_time") > F.lit(halfway)))
    tables.compact_table(spark, vitals)
    left = source.where(F.to_date("event_time") >= F.lit(day - timedelta(days=5)))
    assert gone and rows(tables.read_days(spark, vitals), *source.columns) == rows(left)
    replayed = windows.tumble(source.where(F.to_date("event_time") == F.lit(day)))
    found = tables.read_days(spark, summary).where(F.to_date("window_start") == F.lit(day))
    assert rows(found, *replayed.columns) == rows(replayed)


def test_latest_state_rewrites_only_touched_buckets(spark, tmp_path):
    root, source = str(tmp_path / "latest"), str(tmp_path / "in")

    def run(patients, second):
        data = [(f"P{p}", "b", at(second), None, 80.0 + second, 1.0, 1.0, 95.0, 1.0, 1.0, f"{second}-{p}") for p in patients]
        spark.createDataFrame(data, READING).coalesce(1).write.mode("append").parquet(source)
        stream = jobs.stream_events(spark.readStream.schema(READING).parquet(source))
        streams.keep_latest(stream, root, str(tmp_path / "c"), None, buckets=8).awaitTermination()
        return manifest.newest(spark, root)

    first, folders = run(range(40), 1)
    assert len(folders) == 8
    second, after = run([3], 2)
    assert second > first and sum(folders[b] != after[b] for b in after) == 1
    got = dict(rows(streams.latest_table(spark, root), "patient_id", "heart_rate"))
    assert got == {f"P{p}": 82.0 if p == 3 else 81.0 for p in range(40)}
    # A batch that broke off leaves folders that no manifest names; it is made again as it was.
    (tmp_path / "latest" / f"batch={second + 1}" / "bucket=0").mkdir(parents=True)
    assert dict(rows(streams.latest_table(spark, root), "patient_id", "heart_rate")) == got
    run([3, 4], 3)
    run([5], 4)
    assert not (tmp_path / "latest" / after["0"]).exists() or after["0"] in manifest.newest(spark, root)[1].values()
    got = dict(rows(streams.latest_table(spark, root), "patient_id", "heart_rate"))
    assert (got["P3"], got["P4"], got["P5"], len(got)) == (83.0, 83.0, 84.0, 40)


def test_a_task_that_fails_after_sending_sends_nothing_twice(spark, tmp_path):
    """The worker dies behind its third message; the batch is made again by the next run."""
    box, feed = tmp_path / "box", tmp_path / "feed"
    box.mkdir()

    def send(message):
        with open(box / message["alert_id"], "a") as file:
            file.write("x")
        if message["alert_id"] == "A-2" and not (box / "died").exists():
            (box / "died").touch()
            os._exit(1)

    def image(n):
        fields = {"patient_id": {"S": "P1"}, "alert_id": {"S": f"A-{n}"}, "rule": {"S": "r"},
                  "event_ts": {"S": "2026-09-15T12:00:00Z"}, "sent": {"BOOL": "false"}}
        return ("INSERT", json.dumps(fields))

    given = spark.createDataFrame([image(n) for n in range(6)], "op string, image string")
    given.coalesce(1).write.parquet(str(feed / "n=0"))

    def run():
        stream = spark.readStream.schema("op string, image string").parquet(f"{feed}/n=*")
        claims = outbox.FolderClaims(str(tmp_path / "claims"), patience=0.1)
        streams.deliver_alerts(
            stream.withColumn("image", F.parse_json("image")), send, str(tmp_path / "ledger"),
            str(tmp_path / "c"), None, claims,
        ).awaitTermination()

    with pytest.raises(Exception):
        run()
    assert (box / "died").exists()
    run()
    ledger = spark.read.parquet(str(tmp_path / "ledger")).collect()
    assert {p.name: p.read_text() for p in box.iterdir() if p.name != "died"} == {f"A-{n}": "x" for n in range(6)}
    told = {r.alert_id: (r.delivered, r.error) for r in ledger}
    assert told.pop("A-2") == (False, outbox.UNCONFIRMED)
    assert told == {f"A-{n}": (True, None) for n in (0, 1, 3, 4, 5)}


def test_claims(tmp_path):
    claims = outbox.FolderClaims(f"file://{tmp_path}/c", patience=0.0)
    assert [claims.claim("a"), claims.claim("a")] == [outbox.FREE, outbox.OPEN]
    claims.sent("a")
    assert claims.claim("a") == outbox.SENT
    assert claims.claim("b") == outbox.FREE
    claims.release("b")
    assert claims.claim("b") == outbox.FREE
    with pytest.raises(ValueError):
        outbox.FolderClaims("s3://bucket/c")


def test_a_claim_is_one_file_and_its_folder_is_made_once(tmp_path, monkeypatch):
    claims, made = outbox.FolderClaims(str(tmp_path / "c"), patience=0.0), []
    claims.claim("a")
    monkeypatch.setattr(os, "replace", lambda *_: pytest.fail("a second file"))
    own = outbox.Path.mkdir
    monkeypatch.setattr(outbox.Path, "mkdir", lambda self, *a, **k: made.append(self) or own(self, *a, **k))
    claims.sent("a")
    assert claims.claim("a") == outbox.SENT and not made
    # A note that was cut short is an open claim.
    claims._path("a").write_text("se")
    assert claims.claim("a") == outbox.OPEN


def test_packed_claims(tmp_path, monkeypatch):
    monkeypatch.setattr(outbox.PackedClaims, "MOST", 2)
    folder = str(tmp_path / "c")
    mine, other = (outbox.PackedClaims(f, patience=0.0) for f in (folder, f"file://{folder}"))
    keys = [f"P{n}\nA-{n}" for n in range(3000)]
    assert {mine.claim(k) for k in keys} == {outbox.FREE}
    assert {other.claim(k) for k in keys} == {mine.claim(keys[0])} == {outbox.OPEN}
    for n, key in enumerate(keys):
        (mine.sent if n % 3 else mine.release)(key)
    # What was given back can be had once more, in its old place.
    size = sum(p.stat().st_size for p in tmp_path.rglob("*") if p.is_file())
    assert size == 17 * len(keys)
    assert [other.claim(k) for k in keys] == [outbox.SENT if n % 3 else outbox.FREE for n in range(len(keys))]
    assert [mine.claim(k) for k in keys] == [outbox.SENT if n % 3 else outbox.OPEN for n in range(len(keys))]
    assert size == sum(p.stat().st_size for p in tmp_path.rglob("*") if p.is_file())
    with pytest.raises(ValueError):
        outbox.PackedClaims("s3://bucket/c")


def test_packed_claims_after_a_run_that_broke_off(tmp_path):
    folder = tmp_path / "c"
    claims = outbox.PackedClaims(str(folder), patience=0.0)
    claims.claim("a")
    (file,) = (p for p in folder.rglob("*") if p.is_file())
    whole = file.read_bytes()
    for short in range(len(whole)):
        file.write_bytes(whole[:short])
        assert claims.claim("a") == outbox.FREE and file.read_bytes() == whole
    # Claims of the form before hold.
    before = outbox.FolderClaims(str(folder), patience=0.0)
    before.claim("b")
    before.claim("c")
    before.sent("c")
    assert [claims.claim(k) for k in "bc"] == [outbox.OPEN, outbox.SENT]
    before.release("b")
    assert [claims.claim(k) for k in "bb"] == [outbox.FREE, outbox.OPEN]

    sent, dead = [], []

    def send(message):
        sent.append(message["alert_id"])
        if message["alert_id"] == "A-2" and not dead:
            dead.append(1)
            raise KeyboardInterrupt

    chunk = pd.DataFrame([("P1", f"A-{n}", "s", "b") for n in range(5)], columns=["patient_id", "alert_id", "subject", "body"])
    with pytest.raises(KeyboardInterrupt):
        next(outbox.sender(send, claims)(iter([chunk])))
    got = next(outbox.sender(send, outbox.PackedClaims(str(folder), patience=0.0))(iter([chunk])))
    assert sent == [f"A-{n}" for n in range(5)]
    assert list(got["delivered"]) == [True, True, False, True, True] and got["error"][2] == outbox.UNCONFIRMED


def test_a_packed_claim_is_won_once(spark, tmp_path):
    class Small(outbox.PackedClaims):
        MOST = 3

    claims = Small(str(tmp_path / "c"), patience=0.0)

    def race(task):
        for n in range(2000):
            if claims.claim(f"k{n}") == outbox.FREE:
                claims.sent(f"k{n}")
                yield n

    won = spark.sparkContext.parallelize(range(8), 8).flatMap(race).collect()
    assert sorted(won) == list(range(2000))


def test_claims_of_many_deliveries_take_few_files(spark, tmp_path):
    from tests.test_alerts import change

    feed, ledger = str(tmp_path / "feed"), str(tmp_path / "ledger")
    given = [change("INSERT", alert=f"A-{n}") for n in range(3000)]
    spark.createDataFrame(given, "op string, image string").write.parquet(f"{feed}/n=0")
    stream = spark.readStream.schema("op string, image string").parquet(f"{feed}/n=*")
    streams.deliver_alerts(
        stream.withColumn("image", F.parse_json("image")), lambda message: None, ledger,
        str(tmp_path / "c"), None,
    ).awaitTermination()
    assert spark.read.parquet(ledger).where("delivered").count() == 3000
    files = [p for p in (tmp_path / "ledger.claims").rglob("*") if p.is_file()]
    assert len(files) <= 256
    assert sum(p.stat().st_blocks for p in files) * 512 <= 256 * 4096
