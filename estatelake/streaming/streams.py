"""Streaming forms: exactly-once log tailing, first-wins ingest, reconciliation and keyed run state."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator
from heapq import merge
from itertools import islice
from operator import itemgetter

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from estatelake.operators import reconcile, runlog, staging
from estatelake.sources.shared import exists, remove, staged

IDLE_LIMIT_S = 300


def tail_logs(spark: SparkSession, path: str) -> DataFrame:
    """Lines of growing log files, each once; the query's checkpoint is the resume point."""
    return spark.readStream.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_name").alias("log"))


def log_events(lines: DataFrame) -> DataFrame:
    return runlog.full_events(runlog.parse_lines(lines))


class FirstSightings:
    """A foreachBatch writer that keeps the first row of each id over a whole run, however long it lasts: nothing expires.

    The table is bucketed by the id and partitioned by the micro-batch. A batch is reduced to its first row of each id and held against the ids of
    earlier batches, whose buckets need no shuffle; what is new becomes the batch's partition. A replayed batch replaces its own partition by the same rows, so
    that data come before the checkpoint and never twice. ``schema`` names the columns, source_id among them."""

    def __init__(self, spark: SparkSession, table: str, path: str, schema: str, order: list[str], buckets: int = 64) -> None:
        self.table, self.order, self.columns = table, order, [c.split()[0] for c in schema.split(", ")]
        if not spark.catalog.tableExists(table):
            spark.sql(f"CREATE TABLE {table} ({schema}, batch_id BIGINT) USING parquet PARTITIONED BY (batch_id) CLUSTERED BY (source_id) INTO {buckets} BUCKETS LOCATION '{path}'")
            if exists(spark, path):  # of a run that goes on
                spark.catalog.recoverPartitions(table)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        firsts = staging.first_wins(staging.keyed(batch.select(*self.columns)), ["source_id"], F.struct(*self.order))
        known = spark.table(self.table).where(F.col("batch_id") < batch_id).select("source_id")
        new = staged(firsts.join(known, "source_id", "left_anti"), "new-sightings")
        new.createOrReplaceTempView("_new_sightings")
        spark.sql(f"INSERT OVERWRITE {self.table} PARTITION (batch_id = {batch_id}) SELECT {', '.join(self.columns)} FROM _new_sightings")
        remove(spark, *new.inputFiles())


def classify_stream(scan: DataFrame, state: DataFrame) -> DataFrame:
    """Stream-static reconciliation."""
    return reconcile.classify(scan, state)


def idempotent_sink(path: str, run_id: str):
    """A foreachBatch writer: a replayed batch replaces its own folder, so that data come before the checkpoint and
    never twice."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/run_id={run_id}/batch_id={batch_id}")

    return write


REPORT = "log string, session long, region string, listings long, errors long, kind string"
#: A block of lines in the order of time, by columns.
BLOCK = "us array<long>, event_id array<long>, kind array<string>, region array<string>, rows array<long>, label array<string>"
#: The runs of blocks that are held: their numbers, their first blocks and the ends of their blocks.
RUNS = "run array<long>, at array<long>, upto array<long>"
OPEN = "session long, region string, listings long, last long, told boolean"
#: The state of the processor needs a store that knows values, maps and timers.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
_BY_TIME = itemgetter(0, 1)


class RegionReports(StatefulProcessor):
    """Reports of the regions of a log, and a notice when it falls silent.

    Lines that came are held until the watermark has passed their time, so that no earlier line can come any more, and are then read in the order of their time and number, however
    they were spread over micro-batches. A log keeps: the lines held (a map), the open region with its counters and the time of the last line read (a value), and the
    region's distinct labels (a map). Two timers: one for the first line held, one for the moment at which the log will have been silent for too long. A line that comes
    after that moment finds it told, once for each silence.

    A log's lines are never in memory together: each ``run`` lines that come are sorted and held as blocks of ``block`` lines, and runs are merged as they are read, a block
    of each at a time."""

    def __init__(self, idle_s: int | None, by_event_time: bool, run: int = 50_000, block: int = 1_000) -> None:
        self.idle_s, self.by_event_time, self.run, self.block = idle_s, by_event_time, run, block

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getMapState("held", "run long, block long", BLOCK)
        self.runs = handle.getValueState("runs", RUNS)
        self.open = handle.getValueState("open", OPEN)
        self.labels = handle.getMapState("labels", "label string", "n long")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        came = ((r["us"], r["event_id"], r["kind"], r["region"], r["rows"], r["label"]) for r in rows)
        if not self.by_event_time:
            yield from self._read(key[0], sorted(came, key=_BY_TIME), 0 if self.idle_s is None else timerValues.getCurrentProcessingTimeInMs())
            return
        runs, firsts = self._held_runs(), []
        while lines := sorted(islice(came, self.run), key=_BY_TIME):
            run = runs[-1][0] + 1 if runs else 0
            for i in range(0, len(lines), self.block):
                self._put(run, i // self.block, lines[i : i + self.block])
            runs.append((run, 0, -(-len(lines) // self.block)))
            firsts.append(lines[0][0] // 1000)
        if firsts:
            self._hold_runs(runs)
            self.handle.registerTimer(min(firsts))

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        if not self.by_event_time:
            yield from self._read(key[0], [], timerValues.getCurrentProcessingTimeInMs())
            return
        now, runs, left, firsts = timerValues.getCurrentWatermarkInMs(), self._held_runs(), [], []
        yield from self._read(key[0], merge(*(self._until(now, r, left, firsts) for r in runs), key=_BY_TIME), now)
        if runs:
            self._hold_runs(sorted(left))
        if firsts:
            self.handle.registerTimer(min(firsts))

    def _put(self, run: int, block: int, lines: list[tuple]) -> None:
        self.held.updateValue((run, block), tuple(map(list, zip(*lines, strict=True))))

    def _held_runs(self) -> list[tuple[int, int, int]]:
        return list(zip(*self.runs.get(), strict=True)) if self.runs.exists() else []

    def _hold_runs(self, runs: list[tuple[int, int, int]]) -> None:
        if runs:
            self.runs.update(tuple(map(list, zip(*runs, strict=True))))
        else:
            self.runs.clear()

    def _until(self, now: int, of: tuple[int, int, int], left: list[tuple], firsts: list[int]) -> Iterator[tuple]:
        """The lines of a run up to now, which are held no longer. What is left of the run goes to left, and the time of its first line to firsts."""
        run, at, upto = of
        for b in range(at, upto):
            lines = list(zip(*self.held.getValue((run, b)), strict=True))
            n = bisect_right(lines, now, key=lambda r: r[0] // 1000)
            yield from lines[:n]
            if n < len(lines):
                if n:
                    self._put(run, b, lines[n:])
                left.append((run, b, upto))
                firsts.append(lines[n][0] // 1000)
                return
            self.held.removeKey((run, b))

    def _read(self, log: str, lines: Iterable[tuple], now: int) -> Iterator[Row]:
        """Reads lines, which come in order, and looks at the silence up to now (milliseconds of the clock in use)."""
        session, region, listings, last, told = self.open.get() if self.open.exists() else (0, None, 0, None, True)
        known = {k[0] for k in self.labels.keys()} if self.labels.exists() else set()
        labels = set(known)
        out = lambda kind: Row(log=log, session=session, region=region, listings=listings, errors=len(labels), kind=kind)
        silent = lambda until: self.idle_s is not None and not told and last is not None and until - last // 1000 > self.idle_s * 1000
        some = False
        for us, _, kind, where, rows, label in lines:
            some = True
            if self.by_event_time and silent(us // 1000):
                yield out("idle")
            if kind in ("region_start", "run_end"):
                if session and region is not None:
                    yield out("report")
                session, region = (session + 1, where) if kind == "region_start" else (session, None)
                listings = 0
                labels.clear()
            elif kind == "page_saved" and rows is not None:
                listings += rows
            if label is not None:
                labels.add(label)
            last, told = us, False
        if some and not self.by_event_time:
            last = now * 1000
        if silent(now):
            yield out("idle")
            told = True
        self.open.update((session, region, listings, last, told))
        for label in known - labels:
            self.labels.removeKey((label,))
        for label in labels - known:
            self.labels.updateValue((label,), (1,))
        if self.idle_s is not None and not told and last is not None:
            self.handle.registerTimer(last // 1000 + self.idle_s * 1000 + 1)

    def close(self) -> None:
        pass


def region_reports(events: DataFrame, ts: str | None = None, delay: str = "10 minutes", idle_s: int | None = IDLE_LIMIT_S) -> DataFrame:
    """Reports and, unless idle_s is None, idle notices of each log (columns log, event_id, kind, region, rows, label).

    With ts, the time of a line, the watermark is the clock: lines may be late by ``delay``, later ones are dropped, as are lines without a time, and a log is silent when the lines of others have gone on. Without
    it the clock is the machine's, and lines are read as they come."""
    events.sparkSession.conf.set(*STORE)
    at = F.col(ts).cast("timestamp") if ts else F.timestamp_seconds(F.lit(0))
    held = events.select("log", at.alias("at"), F.unix_micros(at).alias("us"), "event_id", "kind", "region", F.col("rows").cast("long").alias("rows"), "label")
    if ts:
        held = held.where(F.col("at").isNotNull()).withWatermark("at", delay)
    if idle_s is None:
        # What changes no region. Every line moves the clock, though: Spark moves a filter in front of the watermark unless it looks at the time, so this one does
        never = F.col("at") < F.lit("0001-01-01 00:00:00").cast("timestamp")
        held = held.where(F.col("kind").isin("region_start", "run_end", "page_saved") | F.col("label").isNotNull() | never)
    # a stream with timers of the machine's clock never ends by itself
    clock = "eventTime" if ts else "none" if idle_s is None else "processingTime"
    return held.groupBy("log").transformWithState(RegionReports(idle_s, ts is not None), REPORT, "append", clock)


def notifications(events: DataFrame) -> DataFrame:
    """Rows that a messenger would send: starts, regions, warnings and ends."""
    text = F.when(F.col("kind") == "region_start", F.concat(F.lit("region "), F.coalesce("region", F.lit("?")))).when(F.col("kind") == "error", F.col("label")).otherwise(F.col("kind"))
    return events.where(F.col("kind").isin("run_start", "run_end", "region_start") | F.col("label").isNotNull()).select("log", "event_id", "kind", text.alias("notice"))


def event_counts(events: DataFrame, ts: str = "ts", window: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """Counts by event-time window, late rows within the delay included; works on streams and tables."""
    return events.withColumn("_t", F.col(ts).cast("timestamp")).withWatermark("_t", delay).groupBy(F.window("_t", window), "event_type").agg(F.count(F.lit(1)).alias("n"))
