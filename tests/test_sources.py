"""Sources, sinks, character sets and the idle timer."""

import random
import time
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from estatelake.operators import denorm, markup, runlog
from estatelake.schema import LISTING
from estatelake.sources import tables
from estatelake.streaming import streams


def test_csv_starts_with_a_mark_and_keeps_types(spark, tmp_path):
    rows = tables.listing_columns(spark.createDataFrame([("a", 'x "y",\nz', True, 61.5, 1999)], "source_id string, region string, has_photos boolean, area_m2 double, year_built int").coalesce(1))
    assert rows.schema == LISTING
    tables.write_csv(rows, str(tmp_path / "csv"))
    tables.write_csv(rows, str(tmp_path / "csv"))
    files = sorted((tmp_path / "csv").glob("*.csv"))
    assert len(files) == 2
    for f in files:
        data = f.read_bytes()
        assert data.startswith(b"\xef\xbb\xbfregion,locality,")
        assert data.count(b"source_id") == 1
    got = tables.read_csv(spark, str(tmp_path / "csv"), LISTING).collect()
    assert got == [rows.first()] * 2
    assert (got[0].region, got[0].has_photos, got[0].area_m2, got[0].year_built, got[0].gas) == ('x "y",\nz', True, 61.5, 1999, None)


def test_partitions_by_run_date(spark, tmp_path):
    rows = spark.createDataFrame([("sale", "2024-01-02 23:00:00", 1), ("sale", "2024-01-03 01:00:00", 2), ("rental", "2024-01-03 01:00:00", 3)], "transaction_type string, ts string, n int")
    tables.write_partitioned(rows.withColumn("ts", F.col("ts").cast("timestamp_ntz")), "ts", str(tmp_path / "p"))
    assert sorted(str(f.relative_to(tmp_path / "p")) for f in (tmp_path / "p").glob("*/*") if f.is_dir()) == ["transaction_type=rental/run_date=2024-01-03", "transaction_type=sale/run_date=2024-01-02", "transaction_type=sale/run_date=2024-01-03"]


def test_state_over_jdbc_with_pushed_predicates(spark):
    url, driver = "jdbc:derby:memory:state;create=true", "org.apache.derby.jdbc.EmbeddedDriver"
    d = Decimal
    rows = [("a", 1, d("1.5"), "active", "sale"), ("b", 2, None, "inactive", "sale"), ("c", 3, d(2), "active", "rental")]
    state = spark.createDataFrame(rows, "source_id string, listing_id long, price decimal(20,4), status string, transaction_type string")
    state.write.format("jdbc").mode("overwrite").options(url=url, dbtable="state", driver=driver, createTableColumnTypes="source_id varchar(64), status varchar(16), transaction_type varchar(16)").save()
    got = tables.read_state(spark, url, "state", "active", "sale", driver=driver)
    assert [tuple(r) for r in got.collect()] == [("a", 1, d("1.5000"))]
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    plan = tables.read_state(spark, url, "state", "active", "sale", driver=driver)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert all(f"*EqualTo({c})" in plan for c in ("status,active", "transaction_type,sale"))
    many = state.unionByName(spark.range(10, 200).selectExpr("CAST(id AS STRING) AS source_id", "id AS listing_id", "CAST(NULL AS DECIMAL(20,4)) AS price", "'active' AS status", "'sale' AS transaction_type"))
    many.write.format("jdbc").mode("overwrite").options(url=url, dbtable="many", driver=driver, createTableColumnTypes="source_id varchar(64), status varchar(16), transaction_type varchar(16)").save()
    parts = tables.read_state(spark, url, "many", "active", "sale", partitions=4, driver=driver)
    assert (parts.rdd.getNumPartitions(), parts.count()) == (4, 191)


def test_one_byte_pages_and_logs(spark, tmp_path):
    text = "Цена 5 € — «Тухла» №1 ёЁ"
    folder = tmp_path / "html"
    folder.mkdir()
    (folder / "a.html").write_bytes(text.encode("cp1251"))
    assert tables.read_html_files(spark, str(folder)).first().html == text
    df = spark.createDataFrame([(text,), ("日本 x",), (None,)], "t string").select(tables.to_windows_1251(F.col("t")).alias("b"))
    assert [bytes(r.b) if r.b is not None else None for r in df.collect()] == [text.encode("cp1251"), b"?? x", None]
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "new.log").write_text("ред 1\nред 2\n", encoding="utf-8")
    (logs / "old.log").write_bytes("caf\xe9".encode("latin-1"))
    assert sorted((r.log, r.line) for r in tables.read_log_bytes(spark, str(logs)).collect()) == [("new.log", "ред 1"), ("new.log", "ред 2"), ("old.log", "café")]
    assert sorted((r.log, r.line) for r in tables.read_log(spark, str(logs / "new.log")).collect()) == [("new.log", "ред 1"), ("new.log", "ред 2")]


def test_a_selection_is_written_once_and_checked(spark, tmp_path):
    path = str(tmp_path / "s")
    good = spark.createDataFrame([("a", 1), ("b", 2)], "source_id string, position long")
    tables.write_selection(good, path)
    with pytest.raises(AnalysisException):
        tables.write_selection(good, path)
    assert sorted(tuple(r) for r in tables.load_selection(spark, path).collect()) == [("a", 1), ("b", 2)]
    for k, rows in enumerate(([("a", 1), ("a", 2)], [(" ", 1), ("b", 2)])):
        bad = f"{path}{k}"
        tables.write_selection(spark.createDataFrame(rows, good.schema), bad)
        with pytest.raises(Exception, match="blank or repeated"):
            tables.load_selection(spark, bad).collect()


@pytest.mark.parametrize(("html", "want"), [("5 &#8364;", "5 €"), ("&#x20AC;&#x1F600;!", "€😀!"), ("&amp;#65; &lt;", "&#65; <"), ("&#0;&#xD800;", "��"), ("&#;a &#x;", "&#;a &#x;"), ("&#65", "A"), (None, None)])
def test_character_references(spark, html, want):
    assert spark.createDataFrame([(html,)], "h string").select(F.expr(markup.decode("h")).alias("v")).first().v == want


def test_ranks_over_ranges_are_places(spark):
    rows = [(f"s{i:03d}", None if i % 50 == 0 else f"2024-01-{1 + i * 7 % 28:02d}") for i in range(400)]
    df = spark.createDataFrame(rows, "source_id string, date_last_checked string").repartition(5)
    got = [(r.source_id, r.position) for r in denorm.stalest(df, share=2).orderBy("position").collect()]
    want = sorted(rows, key=lambda r: (r[1] is None, r[1] or "", r[0]))[:200]
    assert got == [(s, i) for i, (s, _) in enumerate(want, 1)]
    assert denorm.stalest(df.limit(0)).count() == 0


def test_the_idle_timer_fires_in_a_running_stream(spark, tmp_path):
    source = tmp_path / "events"
    rows = spark.createDataFrame([("a.log", 1, "region_start", "r1", None, None), ("a.log", 2, "page_saved", None, 7, None)], "log string, event_id long, kind string, region string, rows int, label string")
    rows.write.parquet(str(source))
    stream = streams.region_reports(spark.readStream.schema(rows.schema).parquet(str(source)), idle_s=1)
    q = stream.writeStream.format("memory").queryName("idle_rows").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="1 second").start()
    try:
        for _ in range(60):
            time.sleep(1)
            if got := [r for r in spark.table("idle_rows").collect() if r.kind == "idle"]:
                break
            # a micro-batch is needed for a timer to be looked at
            rows.limit(0).write.mode("append").parquet(str(source))
    finally:
        q.stop()
    assert (got[0].log, got[0].region, got[0].listings) == ("a.log", "r1", 7)


def test_context_and_gaps_across_ranges(spark):
    rng = random.Random(8)
    rows = []
    for log in ("a", "b", "c"):
        for i in range(200 if log == "a" else 5):
            kind = rng.choice(["region_start", "page_saved", "transaction", None])
            rows.append((log, i, rng.randrange(10**6), kind, f"r{i}" if kind == "region_start" and rng.random() < 0.8 else None, f"t{i}" if kind == "transaction" else None))
    rows.append((None, 1, 1, "region_start", "r", None))
    df = spark.createDataFrame(rows, "log string, i int, s long, kind string, region string, transaction string").withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz")).repartition(3)
    want, state = {}, {}
    for log, i, _, kind, region, transaction in rows[:-1]:
        r, t, n = state.get(log, (None, None, 0))
        state[log] = (region or r, transaction or t, n + (kind == "region_start"))
        want[log, i] = state[log]
    want[None, 1] = (None, None, 0)  # a line of no log is under nothing
    got = {(r.log, r.i): (r.in_region, r.in_transaction, r.session) for r in runlog.with_context(df, "log", ["i"]).collect()}
    assert got == want
    gaps = {(r.log, r.i): r.idle_s for r in runlog.idle_gaps(df, "log", "ts", ["i"], 1000).collect()}
    steps = {(a[0], a[1]): b[2] - a[2] for a, b in zip(rows, rows[1:], strict=False) if a[0] == b[0]}
    assert gaps == {k: v for k, v in steps.items() if v > 1000}
