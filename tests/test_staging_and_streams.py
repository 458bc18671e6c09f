"""Staging files by line, published versions, mixed bytes, and streams whose lines come late and in parts."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from estatelake.operators import runlog
from estatelake.sources import tables
from estatelake.sources.shared import names
from estatelake.streaming import streams

RECORD = "source_id string, listing struct<price:int>"


def test_rejects_name_their_line_over_many_splits(spark, tmp_path):
    rng = random.Random(3)
    want, good = [], []
    for f in ("a.jsonl", "b.jsonl"):
        lines = []
        for n in range(1, 3001):
            kind = rng.choice(["ok", "ok", "ok", "blank", "bad json", "no id", "no payload", "list"])
            lines.append({"ok": json.dumps({"source_id": f" {f}{n}", "listing": {"price": n}}), "blank": "  ", "bad json": '{"source_id": 1', "no id": '{"source_id": " ", "listing": {"price": 1}}', "no payload": '{"source_id": "x"}', "list": "[1]"}[kind])
            if kind == "ok":
                good.append(n)
            elif kind != "blank":
                want.append((f, n, "bad json" if kind == "list" else kind))
        (tmp_path / f).write_bytes("\r\n".join(lines).encode() + b"\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        records, bad = tables.read_jsonl_files(spark, str(tmp_path), RECORD, "listing")
        assert sorted((r.file.rsplit("/", 1)[1], r.line, r.reason) for r in bad.collect()) == sorted(want)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r.listing.price for r in records.collect()) == sorted(good)
    with pytest.raises(Exception, match=rf"bad record in \S+a\.jsonl line {want[0][1]} {want[0][2]}"):
        tables.read_jsonl_files(spark, str(tmp_path), RECORD, "listing", strict=True)[0].collect()


def test_strict_reading_of_good_files(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"source_id": "1", "listing": {"price": 1}}\n\n')
    assert tables.read_jsonl_files(spark, str(tmp_path), RECORD, "listing", strict=True)[0].count() == 1


def test_versions_are_published_as_a_whole(spark, tmp_path):
    root = str(tmp_path)
    rows = lambda *ids: spark.createDataFrame([(i, "x", 1) for i in ids], "source_id string, name string, more int")
    with pytest.raises(FileNotFoundError):
        tables.current(spark, root)
    assert tables.publish(rows("b", "a"), root, ["source_id", "name"]) == 1
    reader = tables.current(spark, root)
    assert tables.publish(rows("c"), root, ["source_id", "name"]) == 2
    broken = rows("d").withColumn("name", F.raise_error(F.lit("full")).cast("string"))
    with pytest.raises(Exception, match="full"):
        tables.publish(broken, root, ["source_id", "name"])
    assert [tuple(r) for r in tables.current(spark, root).collect()] == [("c", "x")]
    assert sorted(r.source_id for r in reader.collect()) == ["a", "b"]  # who began goes on
    assert tables.publish(rows("e"), root, ["source_id", "name"]) == 3
    left = [n for n in names(spark, root) if n.startswith("v")]
    gone = tables.expire(spark, root, keep=2)
    assert {n.split("-")[0] for n in gone} >= {"v1"} and len(left) - len(gone) == 2
    assert [r.source_id for r in tables.current(spark, root).collect()] == ["e"]


def test_a_file_with_one_odd_byte_is_latin_throughout(spark, tmp_path):
    (tmp_path / "good.log").write_bytes("ред é\n".encode() * 2000)
    (tmp_path / "odd.log").write_bytes("ред é\n".encode() * 1000 + b"caf\xe9\n" + "é\n".encode() * 1000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        lines = tables.read_log_bytes(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() >= 1
        got = {(r.log, r.line, r.is_utf8): r["count"] for r in lines.groupBy("log", "line", "is_utf8").count().collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    as_latin = lambda x: x.encode().decode("latin-1")
    assert got == {("good.log", "ред é", True): 2000, ("odd.log", as_latin("ред é"), False): 1000, ("odd.log", "café", False): 1, ("odd.log", as_latin("é"), False): 1000}


EVENTS = "log string, event_id long, at timestamp_ntz, kind string, region string, rows int, label string"


def run_events(seed, logs=3, n=60):
    rng = random.Random(seed)
    rows = []
    for log in range(logs):
        at = dt.datetime(2024, 1, 1)
        for i in range(n):
            at += dt.timedelta(seconds=rng.choice([0, 1, 20, 60, 300]))
            kind = rng.choice(["region_start", "page_saved", "page_saved", "error", None])
            rows.append((f"log{log}", i, at, kind, f"r{i}" if kind == "region_start" else None, rng.randrange(40) if kind == "page_saved" else None, rng.choice(["x", "y", None]) if kind == "error" else None))
    return rows


def expected(rows, idle_s, now):
    out = []
    for log in {r[0] for r in rows}:
        session, region, listings, labels, last = 0, None, 0, set(), None
        for _, _, at, kind, where, n, label in sorted((r for r in rows if r[0] == log), key=lambda r: (r[2], r[1])):
            if last is not None and (at - last).total_seconds() > idle_s:
                out.append((log, session, region, listings, len(labels), "idle"))
            if kind == "region_start":
                if session:
                    out.append((log, session, region, listings, len(labels), "report"))
                session, region, listings, labels = session + 1, where, 0, set()
            listings += n or 0
            labels |= {label} - {None}
            last = at
        if (now - last).total_seconds() > idle_s:
            out.append((log, session, region, listings, len(labels), "idle"))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_late_and_split_lines_give_the_reports_of_the_whole_log(spark, tmp_path, seed):
    rows = run_events(seed)
    now = max(r[2] for r in rows) + dt.timedelta(seconds=1)
    rng = random.Random(seed)
    # lines come up to nine minutes late, a log's lines in several batches, the clock's line last
    by_arrival = sorted(rows, key=lambda r: r[2] + dt.timedelta(seconds=rng.randrange(540)))
    parts = [by_arrival[i::1][k : k + 60] for i in (0,) for k in range(0, len(by_arrival), 60)] + [[("clock", 0, now + dt.timedelta(minutes=10), None, None, None, None)]]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for part in parts:
            spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(source)
            stream = streams.region_reports(spark.readStream.schema(EVENTS).parquet(source), "at", "10 minutes", 290)
            stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((tuple(r) for r in spark.read.parquet(out).collect()), key=repr) == expected(rows, 290, now)


def test_first_sightings_hold_over_a_whole_run(spark, tmp_path):
    schema = "source_id string, region string, seq string, observed_at timestamp_ntz"
    table = f"seen_{random.randrange(10**9)}"
    sink = streams.FirstSightings(spark, table, str(tmp_path / "t"), schema, ["seq"], 4)
    batch = lambda *rows: spark.createDataFrame([(i, r, s, dt.datetime(2024, 1, d)) for i, r, s, d in rows], schema)
    first, second, third = batch(("a", "r1", "2", 1), (" a ", "r0", "1", 1), ("b", "r1", "3", 1), (" ", "r", "1", 1), (None, "r", "1", 1)), batch(("a", "r9", "0", 20), ("c", "r2", "4", 20)), batch(("b", "r9", "0", 28), ("c", "r9", "0", 28), ("d", "r3", "5", 28))
    for i, b in enumerate((first, second, third)):
        sink(b, i)
    want = [("a", "r0", "1", 0), ("b", "r1", "3", 0), ("c", "r2", "4", 1), ("d", "r3", "5", 2)]
    told = lambda: sorted((r.source_id, r.region, r.seq, r.batch_id) for r in spark.table(table).collect())
    assert told() == want
    for i, b in ((1, second), (2, third)):  # replayed
        sink(b, i)
        assert told() == want
    # a run goes on where the table's definition is gone, as after a restart
    other = f"{table}_again"
    again = streams.FirstSightings(spark, other, str(tmp_path / "t"), schema, ["seq"], 4)
    again(batch(("a", "r7", "9", 29), ("e", "r7", "9", 29)), 3)
    assert sorted(r.source_id for r in spark.table(other).collect()) == ["a", "b", "c", "d", "e"]


@pytest.mark.parametrize(
    ("line", "kind", "rest"),
    [
        ("2024-01-01 00:00:00 [ERROR] main — Region 3/54: София (grad-sofiya)", "region_number", "3/54: София (grad-sofiya)"),
        ("x [ERROR] y — saved Saved 5 things", "error", " y — saved Saved 5 things"),
        ("===== region: A (b) | c", "region_start", " A (b) | c"),
        ("Transaction type: ", None, None),
        ("Transaction type: naemi", "transaction", " naemi"),
        ("--- Scraping: x y/z | a", None, None),
        ("Run finished", "run_end", ""),
        ("", None, None),
        (None, None, None),
    ],
)
def test_the_first_rule_that_holds_names_a_line(spark, line, kind, rest):
    got = runlog.FULL.told(spark.createDataFrame([(line,)], "line string"), "line").first()
    assert (got.kind, got.rest) == (kind, rest)


def test_lines_that_change_no_region_move_the_clock(spark, tmp_path):
    """The last reports come, too, when only another log's line of no kind is later."""
    day = dt.datetime(2024, 1, 1)
    rows = [("a", 1, day, "region_start", "r1", None, None), ("a", 2, day + dt.timedelta(seconds=5), "page_saved", None, 7, None), ("a", 3, day + dt.timedelta(seconds=9), "region_start", "r2", None, None)]
    spark.createDataFrame([*rows, ("clock", 0, day + dt.timedelta(minutes=11), None, None, None, None)], EVENTS).write.parquet(str(tmp_path / "in"))
    stream = streams.region_reports(spark.readStream.schema(EVENTS).parquet(str(tmp_path / "in")), "at", "10 minutes", None)
    stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert [tuple(r) for r in spark.read.schema(streams.REPORT).parquet(str(tmp_path / "out")).collect()] == [("a", 1, "r1", 7, 0, "report")]


class _State(dict):
    """What the processor needs of a state, in memory; counts the lines it gives out."""

    def __init__(self):
        super().__init__()
        self.read = 0

    exists, get, keys, clear = (lambda self: () in self or len(self) > 0), (lambda self: self[()]), (lambda self: iter(list(dict.keys(self)))), (lambda self: dict.clear(self))

    def update(self, value):
        self[()] = value

    def updateValue(self, key, value):
        self[key] = value

    def getValue(self, key):
        self.read += len(self[key][0])
        return self[key]

    def removeKey(self, key):
        del self[key]


def test_held_lines_are_merged_by_blocks():
    """Runs of lines in any order are read in the order of time, a block of each at a time, and what is later than the clock stays."""
    processor = streams.RegionReports(None, True, run=40, block=8)
    processor.held, processor.runs, processor.open, processor.labels = (_State() for _ in range(4))
    processor.handle = type("Handle", (), {"registerTimer": staticmethod(lambda at: None)})
    clock = lambda at: type("Clock", (), {"getCurrentWatermarkInMs": lambda self: at})()
    came = [{"us": i * 1_000_000, "event_id": i, "kind": "region_start", "region": f"r{i}", "rows": None, "label": None} for i in range(200)]
    random.Random(3).shuffle(came)
    list(processor.handleInputRows(("a",), iter(came), clock(0)))
    assert max(len(v[0]) for v in processor.held.values()) == 8 and len(processor.runs[()][0]) == 5
    reports = processor.handleExpiredTimer(("a",), clock(99_500), None)
    assert next(reports).region == "r0" and processor.held.read <= 5 * 8 + 8
    assert [r.region for r in reports] == [f"r{i}" for i in range(1, 99)]
    assert sum(len(v[0]) for v in processor.held.values()) == 100
    assert [r.region for r in processor.handleExpiredTimer(("a",), clock(10**9), None)] == [f"r{i}" for i in range(99, 199)]
    assert not processor.held and not processor.runs
