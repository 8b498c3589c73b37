"""Exact rolling rates of a followed log, kept in the state store.

For every run the store holds the last ``window - 1`` batches that are closed, as a list, and the open one,
as a value. A trigger adds its lines to the open batch, closes what a later batch follows, and appends a row for
every batch it changed to one table, also for the open one as far as it is known; a batch's row with the
most lines is the newest, which :func:`read_rolling` takes. So triggers may cut batches anywhere,
a restart goes on from the checkpoint, and no folder is made for a trigger.

Lines are folded to a row for each run and batch by every task before they are shuffled, so a run
that holds most of the log sends few rows. A line of a batch that was closed before changes no rate: it is
written with ``late`` set.

With ``expire`` a run whose newest line is that many seconds behind the newest of all is closed and its state
is dropped by a timer; the watermark this needs leaves out lines that are still older.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
KEPT = "batch bigint, ts_us bigint, tokens bigint, known bigint, lines bigint"
FOLDED = f"run_id string, {KEPT}"
OUT = (
    "run_id string, batch bigint, ts timestamp, tokens bigint, tokens_per_sec double, batches_per_sec double, "
    "lines bigint, closed boolean, late boolean"
)
NO_TIME = -(1 << 63)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each run and batch of an Arrow batch; times and tokens may be missing."""
    for batch in batches:
        table = pa.Table.from_batches([batch]).group_by(["run_id", "batch"])
        sums = table.aggregate([("ts_us", "max"), ("tokens", "sum"), ("tokens", "count"), ("batch", "count")])
        columns = {c: sums.column(c).combine_chunks() for c in sums.column_names}
        yield pa.RecordBatch.from_arrays(
            [
                columns["run_id"],
                columns["batch"],
                columns["ts_us_max"].fill_null(NO_TIME),
                columns["tokens_sum"].fill_null(0),
                columns["tokens_count"],
                columns["batch_count"],
            ],
            ["run_id", "batch", "ts_us", "tokens", "known", "lines"],
        )


def _both(a: tuple | None, b: tuple) -> tuple:
    """Sums of the same batch from two places."""
    return b if a is None else (a[0], max(a[1], b[1]), *(x + y for x, y in zip(a[2:], b[2:])))


class Rolling(StatefulProcessor):
    """The state of a run and its rows, as the module says."""

    def __init__(self, window: int, expires: bool):
        self.window, self.expires = window, expires

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.closed = handle.getListState("closed", KEPT)
        self.open = handle.getValueState("open", KEPT)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        run = key[0]
        found: dict[int, tuple] = {}
        for frame in rows:
            for row in frame[["batch", "ts_us", "tokens", "known", "lines"]].itertuples(index=False):
                row = tuple(map(int, row))
                found[row[0]] = _both(found.get(row[0]), row)
        before = [tuple(r) for r in self.closed.get()]
        held = tuple(self.open.get()) if self.open.exists() else None
        done = before[-1][0] if before else None
        late = [found.pop(b) for b in sorted(found) if done is not None and b <= done]
        changed = set(found)
        if held is not None:
            found[held[0]] = _both(held, found[held[0]]) if held[0] in found else held
        order = [found[b] for b in sorted(found)]
        out = [self.row(run, r, None, False, True) for r in late]
        for k, row in enumerate(order):
            is_open = k == len(order) - 1
            if row[0] in changed or not is_open:
                out.append(self.row(run, row, before, not is_open, False))
            if not is_open:
                before = (before + [row])[-(self.window - 1) :] if self.window > 1 else [row]
        if order:
            if before:  # the store takes no empty list
                self.closed.put(before)
            self.open.update(order[-1])
        if self.expires and order:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if (newest := max(r[1] for r in order)) != NO_TIME:
                self.handle.registerTimer(newest // 1000)
        yield self.frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        before = [tuple(r) for r in self.closed.get()]
        out = [self.row(key[0], tuple(self.open.get()), before, True, False)] if self.open.exists() else []
        self.closed.clear()
        self.open.clear()
        yield self.frame(out)

    def close(self) -> None:
        pass

    def row(self, run: str, row: tuple, before: list[tuple] | None, closed: bool, late: bool) -> tuple:
        batch, at, tokens, known, lines = row
        rates = (None, None)
        back = self.window - 1
        if before is not None and len(before) >= back and back:
            first = before[-back]
            span = at - first[1]
            if at != NO_TIME and first[1] != NO_TIME and span > 0:
                inside = [r for r in (*before[-back:], row) if r[3]]
                seconds = span / 1e6
                speed = (sum(r[2] for r in inside) - first[2]) / seconds if first[3] else None
                rates = (speed, back / seconds)
        time = None if at == NO_TIME else pd.Timestamp(at, unit="us")
        return (run, batch, time, tokens if known else None, *rates, lines, closed, late)

    @staticmethod
    def frame(rows: list[tuple]) -> pd.DataFrame:
        names = [c.split()[0] for c in OUT.split(", ")]
        frame = pd.DataFrame(rows, columns=names)
        kinds = {"batch": "Int64", "tokens": "Int64", "lines": "Int64", "ts": "datetime64[us]", "tokens_per_sec": "float64", "batches_per_sec": "float64"}
        return frame.astype(kinds | {"closed": bool, "late": bool})


def follow_rolling_state(
    metrics: DataFrame,
    out: str,
    checkpoint: str,
    window: int = 10,
    available_now: bool = False,
    expire: float | None = None,
) -> StreamingQuery:
    """Append exact last-``window`` rates of a followed log to the table ``out``."""
    if window < 2:
        raise ValueError("a rate spans two batches at least")
    spark = metrics.sparkSession
    lines = metrics.select(F.col("run_id").cast("string"), F.col("batch").cast("bigint"), F.unix_micros("ts").alias("ts_us"), F.col("tokens").cast("bigint"))
    folded = lines.mapInArrow(_fold, FOLDED)
    if expire is not None:
        time = F.timestamp_micros(F.when(F.col("ts_us") > NO_TIME, F.col("ts_us")))
        folded = folded.withColumn("at", time).withWatermark("at", f"{expire} seconds")
    rates = folded.groupBy("run_id").transformWithStateInPandas(
        Rolling(window, expire is not None), OUT, "Append", "None" if expire is None else "EventTime"
    )
    held = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)  # list and value state, timers
    try:
        writer = rates.writeStream.format("parquet").outputMode("append")
        writer = writer.option("path", out).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer).start()
    finally:
        spark.conf.set(PROVIDER, held) if held else spark.conf.unset(PROVIDER)


def read_rolling(spark: SparkSession, out: str) -> DataFrame:
    """One row per run and batch, as of its last line."""
    rows = spark.read.parquet(out).where("not late")
    values = [c for c in rows.columns if c not in ("run_id", "batch", "late")]
    newest = F.max_by(F.struct(*values), F.struct("lines", "closed")).alias("v")
    return rows.groupBy("run_id", "batch").agg(newest).select("run_id", "batch", "v.*")
