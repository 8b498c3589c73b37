"""Log metrics in batch, and streams against the batch result."""

import itertools
import json
import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from corploom.sources import readers
from corploom.streaming import follow, metrics, rolling_state

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def line(run, batch, tokens=100, seconds=None, device=0, **more):
    at = T0 + timedelta(seconds=batch if seconds is None else seconds)
    stamp = at.strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    body = dict(run_id=run, batch=batch, ts=stamp, device=device, tokens=tokens, loss=1.5, lr=0.1, mem_bytes=10)
    return json.dumps(body | more)


_clock = itertools.count(1_700_000_000)


def write(folder, name, lines):
    """Each file a second younger than the one before, as a stream takes them by age."""
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
    at = next(_clock)
    os.utime(folder / name, (at, at))


def metric_rows(spark, folder):
    return metrics.metric_rows(readers.scan_logs(spark, str(folder)))


def brute_speed(points, window=10):
    """points: (batch, seconds, tokens) of one run."""
    points = sorted(points)
    out = {}
    for i, (batch, at, _) in enumerate(points):
        rate = None
        if i + 1 >= window:
            first = points[i + 1 - window]
            if at > first[1]:
                rate = sum(p[2] for p in points[i + 2 - window : i + 1]) / (at - first[1])
        out[batch] = rate
    return out


def speeds(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.run_id, {})[r.batch] = r.tokens_per_sec
    return out


RUNS = {
    "hot": [(b, b * 3 % 7 + b * 10, 50 + b % 9) for b in range(200) if b % 17 and not 60 < b < 110],
    "short": [(b, b, 5) for b in range(4)],
    "gaps": [(b * 40, b * 5, b + 1) for b in range(25)],
    "still": [(b, 7, 5) for b in range(12)],
}


def all_lines():
    return [line(run, b, tok, sec) for run, points in RUNS.items() for b, sec, tok in points]


@pytest.mark.parametrize("block", [3, 10, 16, 4096])
def test_rolling_speed(spark, tmp_path, block):
    write(tmp_path / "logs", "a.log", all_lines())
    got = speeds(metrics.rolling_speed(metric_rows(spark, tmp_path / "logs"), block=block))
    for run, points in RUNS.items():
        want = brute_speed(points)
        assert got[run].keys() == want.keys()
        for batch, rate in want.items():
            assert got[run][batch] == (rate if rate is None else pytest.approx(rate)), (run, batch)


def test_parse_keeps_other_lines(spark, tmp_path):
    write(tmp_path / "logs", "a.log", [line("r", 0), "starting up", '{"run_id": "r"}', "{oops"])
    rows = metrics.parse_metrics(readers.scan_logs(spark, str(tmp_path / "logs"))).collect()
    assert sorted(r.text for r in rows if r.text) == sorted(["starting up", '{"run_id": "r"}', "{oops"])
    assert [r.batch for r in rows if r.text is None] == [0]


def test_devices_fold(spark, tmp_path):
    lines = [line("r", b, 10, device=d, mem_bytes=100 * d + b, lr=0.5 / (b + 1)) for b in range(12) for d in range(4)]
    write(tmp_path / "logs", "a.log", lines)
    rows = metric_rows(spark, tmp_path / "logs")
    assert {(r.batch, r.peak_bytes) for r in metrics.memory_peak(rows).collect()} == {
        (b, 300 + b) for b in range(12)
    }
    assert {r.batch: r.lr for r in metrics.lr_series(rows).collect()} == {b: 0.5 / (b + 1) for b in range(12)}
    left = {r.batch: r.eta_sec for r in metrics.eta(rows, 21).collect()}
    assert left[8] is None and left[11] == pytest.approx(9.0)


def test_followed_log_equals_batch_and_restarts_clean(spark, tmp_path):
    logs, out, state = tmp_path / "logs", str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        stream = metrics.metric_rows(readers.follow_logs(spark, str(logs)))
        follow.follow_rolling(stream, out, state, str(tmp_path / "cp"), available_now=True).awaitTermination()

    points = [(run_, p) for run_, ps in RUNS.items() for p in ps]
    # a log grows: each file brings later batches of every run
    for lo, hi in ((0, 5), (5, 40), (40, 41), (41, 2000)):
        write(logs, f"{lo:04d}.log", [line(r, b, t, s) for r, (b, s, t) in points if lo <= b < hi])
        run()
    follow.finish_rolling(spark, out, state)
    done = spark.read.parquet(out)
    want = metrics.rolling_speed(metric_rows(spark, logs))
    assert done.count() == want.count() == len(points)
    assert speeds(done) == speeds(want)
    run()
    assert spark.read.parquet(out).count() == len(points)


def test_followed_lines_arrive_once(spark, tmp_path):
    logs, out, cp = tmp_path / "logs", str(tmp_path / "out"), str(tmp_path / "cp")
    write(logs, "a.log", ["one", "two"])

    def run():
        lines = readers.follow_logs(spark, str(logs), files_per_trigger=1)
        follow.follow_to(lines.select("line"), out, cp, available_now=True).awaitTermination()
        return sorted(r.line for r in spark.read.parquet(out).collect())

    assert run() == ["one", "two"]
    assert run() == ["one", "two"]
    write(logs, "b.log", ["three"])
    assert run() == ["one", "three", "two"]


def test_stop(spark, tmp_path):
    write(tmp_path / "logs", "a.log", ["x"])
    lines = readers.follow_logs(spark, str(tmp_path / "logs")).select("line")
    query = follow.follow_to(lines, str(tmp_path / "out"), str(tmp_path / "cp"))
    query.processAllAvailable()
    assert query.isActive
    follow.stop(query)
    assert not query.isActive


def test_windows_agree_with_a_table(spark, tmp_path):
    """Open windows included, over several triggers."""
    for k in range(4):
        write(tmp_path / "logs", f"{k}.log", [line("r", b, 10, b * 60) for b in range(25 * k, 25 * k + 25)])
    rows = metrics.metric_rows(readers.follow_logs(spark, str(tmp_path / "logs"), files_per_trigger=1))
    out = str(tmp_path / "out")
    follow.follow_windows(rows, out, str(tmp_path / "cp"), "10 minutes", available_now=True).awaitTermination()
    table = metrics.windowed_metrics(metric_rows(spark, tmp_path / "logs"), "10 minutes")
    got = follow.read_windows(spark, out).select(*table.columns)
    assert got.count() == table.count() == 10
    assert got.exceptAll(table).count() == 0


def test_batches_cut_by_triggers(spark, tmp_path):
    """Each batch once, whole, wherever files end; old state goes; late lines are kept."""
    logs, out, state = tmp_path / "logs", str(tmp_path / "out"), str(tmp_path / "state")
    lines = [line("r", b, 10 + d, b * 60 + d, device=d) for b in range(30) for d in range(4)]
    for k, (lo, hi) in enumerate(((0, 2), (2, 51), (51, 53), (53, 90), (90, 120))):
        write(logs, f"{k}.log", lines[lo:hi])

    def run():
        rows = metrics.metric_rows(readers.follow_logs(spark, str(logs), files_per_trigger=1))
        follow.follow_rolling(rows, out, state, str(tmp_path / "cp"), available_now=True).awaitTermination()
        follow.finish_rolling(spark, out, state)

    run()
    want = speeds(metrics.rolling_speed(metric_rows(spark, logs)))
    assert spark.read.parquet(out).count() == 30 and speeds(spark.read.parquet(out)) == want
    assert len([p for p in (tmp_path / "state").iterdir() if p.name.startswith("trigger")]) <= 2
    write(logs, "5.log", [line("r", 3, 99, 9999), line("r", 29, 5, 29 * 60 + 9), line("r", 30, 7, 30 * 60)])
    run()
    done = spark.read.parquet(out)
    assert done.count() == 31 and {r.batch: r.tokens for r in done.collect()}[29] == 10 + 11 + 12 + 13 + 5
    assert spark.read.parquet(f"{state}-late").count() == 1


def test_finished_runs_are_forgotten(spark, tmp_path):
    logs, out, state = tmp_path / "logs", str(tmp_path / "out"), str(tmp_path / "state")
    write(logs, "0.log", [line("old", b, 10, b) for b in range(5)])
    write(logs, "1.log", [line("new", b, 10, 100_000 + b) for b in range(5)])
    write(logs, "2.log", [line("new", b, 10, 100_000 + b) for b in range(5, 9)])
    rows = metrics.metric_rows(readers.follow_logs(spark, str(logs), files_per_trigger=1))
    query = follow.follow_rolling(rows, out, state, str(tmp_path / "cp"), available_now=True, expire=3600)
    query.awaitTermination()
    last = spark.read.parquet(state)
    newest = last.agg(F.max("trigger")).first()[0]
    assert {r.run_id for r in last.where(F.col("trigger") == newest).collect()} == {"new"}
    follow.finish_rolling(spark, out, state)
    assert spark.read.parquet(out).count() == 14


def test_last_rows(spark):
    rows = spark.createDataFrame([("a", b) for b in range(50)] + [("b", 3)], "run_id string, batch bigint")
    got = sorted(map(tuple, follow.last_rows(rows, 9, block=8).collect()))
    assert got == [("a", b) for b in range(41, 50)] + [("b", 3)]


def follow_state(spark, tmp_path, **more):
    rows = metrics.metric_rows(readers.follow_logs(spark, str(tmp_path / "logs"), files_per_trigger=1))
    out = str(tmp_path / "out")
    rolling_state.follow_rolling_state(rows, out, str(tmp_path / "cp"), available_now=True, **more).awaitTermination()
    return rolling_state.read_rolling(spark, out)


def test_rates_in_the_state_store(spark, tmp_path):
    """Batches cut by triggers, a restart, a late line, lines without time or tokens, two runs."""
    lines = [line("r", b, 10 + d, b * 60 + d, device=d) for b in range(30) for d in range(4)]
    lines += [line("s", b, 5, b) for b in range(0, 40, 3)] + [line("t", b, None if b == 2 else 1, b, ts=None if b == 4 else "2024-01-01T00:00:00.000000Z") for b in range(14)]
    lines.sort(key=lambda x: json.loads(x)["batch"])
    for k, (lo, hi) in enumerate(((0, 2), (2, 51), (51, 53), (53, 90))):
        write(tmp_path / "logs", f"{k}.log", lines[lo:hi])
    follow_state(spark, tmp_path)
    write(tmp_path / "logs", "4.log", lines[90:])
    done = follow_state(spark, tmp_path)
    table = metrics.rolling_speed(metric_rows(spark, tmp_path / "logs"))
    names = table.columns
    key = lambda r: (r.run_id, r.batch)
    want = sorted(table.collect(), key=key)
    assert sorted(done.select(*names).collect(), key=key) == want and len(want) == 58
    write(tmp_path / "logs", "5.log", [line("r", 3, 99, 9999), line("r", 29, 5, 29 * 60 + 9), line("r", 30, 7, 30 * 60)])
    done = follow_state(spark, tmp_path)
    tokens = {r.batch: r.tokens for r in done.where("run_id = 'r'").collect()}
    assert len(tokens) == 31 and tokens[29] == 10 + 11 + 12 + 13 + 5 and tokens[3] == 46
    late = spark.read.parquet(str(tmp_path / "out")).where("late").collect()
    assert [(r.batch, r.tokens) for r in late] == [(3, 99)]
    assert not [p for p in (tmp_path / "out").iterdir() if p.name.startswith("trigger")]


def test_runs_expire_from_the_state_store(spark, tmp_path):
    write(tmp_path / "logs", "0.log", [line("old", b, 10, b) for b in range(5)])
    for k in range(1, 4):
        write(tmp_path / "logs", f"{k}.log", [line("new", b, 10, 100_000 * k + b) for b in range(5 * k, 5 * k + 4)])
    done = follow_state(spark, tmp_path, expire=3600)
    closed = {(r.run_id, r.batch) for r in done.where("closed").collect()}
    assert ("old", 4) in closed and done.where("run_id = 'old'").count() == 5
