"""Merge laws, reconciliation, gates and planner on small inputs."""

import random
from decimal import Decimal

from pyspark.sql import functions as F

from estatelake.operators import planner, reconcile, runstate, staging
from estatelake.sources import tables
from estatelake.streaming import streams


def test_first_and_last_win_in_any_order(spark):
    rows = [("a", i, f"r{i}") for i in range(5)] + [("b", 9, "x"), (None, 1, "n"), ("  ", 2, "m")]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = staging.keyed(spark.createDataFrame(rows, "source_id string, seq int, region string").repartition(3))
        assert {tuple(r) for r in staging.first_wins(df, ["source_id"], F.col("seq")).collect()} == {("a", 0, "r0"), ("b", 9, "x")}
        assert {tuple(r) for r in staging.last_wins(df, ["source_id"], F.col("seq")).collect()} == {("a", 4, "r4"), ("b", 9, "x")}


def test_primary_beats_refreshed(spark):
    df = spark.createDataFrame([("a", "changed", 1), ("a", "refreshed", 2), ("b", "refreshed", 1), ("b", "refreshed", 5), ("c", "odd", 1)], "source_id string, action string, seq int")
    assert {tuple(r) for r in staging.effective_actions(df).collect()} == {("a", "changed", 1), ("b", "refreshed", 5)}
    assert staging.invalid_actions(df).count() == 1


def test_classify(spark):
    d = Decimal
    state = spark.createDataFrame([("back", 42, d(100), "inactive"), ("same", 1, d("44993.69"), "active"), ("moved", 2, d(5), "active"), ("gone", 3, d(5), "active"), ("both", 4, d(1), "inactive"), ("both", 5, d(1), "active"), (None, 6, d(1), "active")], "source_id string, listing_id long, price decimal(20,4), status string")
    scan = spark.createDataFrame([("back", d(90)), ("same", d("44993.69")), ("moved", None), ("fresh", d(1)), ("both", d(1)), (" ", d(1))], "source_id string, price decimal(20,4)")
    got = {r.source_id: (r.action, r.listing_id, r.old_price) for r in reconcile.classify(scan, state).collect()}
    assert got == {"back": ("reappeared", 42, d(100)), "same": ("unchanged", None, None), "moved": ("changed", 2, d(5)), "fresh": ("new", None, None), "both": ("unchanged", None, None)}
    assert [r.source_id for r in reconcile.missing(state, scan).collect()] == ["gone"]


def test_gate_and_cleared_failures(spark):
    expected = spark.createDataFrame([("sale", "r1"), ("sale", "r2")], "transaction_type string, region string")
    def gate(events):
        df = spark.createDataFrame(events, "transaction_type string, unit string, region string, kind string, reason string, seq int")
        return runstate.completeness(expected, df).first()
    done = [("sale", "r1", "r1", "region_complete", None, 1), ("sale", "r2", "r2", "region_complete", None, 2)]
    assert gate(done).missing_allowed
    assert not gate(done[:1]).missing_allowed
    failed = [*done, ("sale", "r1:p2", "r1", "failed", "fetch_failed", 3)]
    assert not gate(failed).missing_allowed
    assert gate([*failed, ("sale", "r1:p2", "r1", "cleared", None, 4)]).missing_allowed


def test_fetch_outcomes(spark):
    base = {"failure": None, "page_type": "detail", "status": 200, "url": "https://x/obiava-1", "final_url": "https://x/obiava-1", "chars": 9000, "content_ok": True, "after_partial": False}
    cases = [({}, "ok"), ({"failure": "timeout"}, "retry"), ({"failure": "request"}, "failed"), ({"status": 403}, "hard_block"), ({"status": 404}, "not_found"), ({"status": 404, "page_type": "listings"}, "empty"), ({"status": 503}, "retry"), ({"final_url": "https://x/obiavi/sofia"}, "unavailable"), ({"chars": 10}, "too_small"), ({"content_ok": False, "after_partial": True}, "end_of_results"), ({"content_ok": False}, "soft_block")]
    schema = "failure string, page_type string, status int, url string, final_url string, chars int, content_ok boolean, after_partial boolean"
    for change, want in cases:
        assert spark.createDataFrame([base | change], schema).select(runstate.fetch_outcome()).first()[0] == want


def test_price_buckets_under_the_cap(spark):
    prices = [random.Random(7).randrange(0, 200) for _ in range(400)] + [50] * 30 + [None] * 3
    df = spark.createDataFrame([("u", p) for p in prices], "unit string, price long")
    out = planner.price_buckets(df, ["unit"], 0, 255, 20).collect()
    assert sum(r.n for r in out) == len(prices)
    assert [r.n for r in out if r.lo is None] == [3]
    spans = sorted((r.lo, r.hi, r.n) for r in out if r.lo is not None)
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert all(n < 20 or lo == hi or (lo + hi) // 2 == lo for lo, hi, n in spans)
    assert all(n == sum(p is not None and lo <= p <= hi for p in prices) for lo, hi, n in spans)


def test_region_reports_over_several_frames(spark, tmp_path):
    rows, want = [], []
    for s in range(60):
        rows.append(("a", 10 * s, "region_start", f"r{s}", None, None))
        rows += [("a", 10 * s + k, "page_saved", None, k, f"e{k % 3}" if k % 2 else None) for k in range(1, 10)]
        want.append(("a", s + 1, f"r{s}", 45, 3))
    random.Random(4).shuffle(rows)
    spark.createDataFrame(rows, "log string, event_id long, kind string, region string, rows long, label string").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{tmp_path}/in").schema).parquet(f"{tmp_path}/in")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "7")
    try:
        streams.region_reports(stream, idle_s=None).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/at").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(name, before)
    got = spark.read.parquet(f"{tmp_path}/out").select("log", "session", "region", "listings", "errors").collect()
    assert sorted(map(tuple, got)) == want[:-1]


def test_jsonl_rejects(spark):
    lines = spark.createDataFrame([('{"source_id":"1","listing":{"price":1}}',), ("",), ("{bad",), ("[1]",), ('{"source_id":" ","listing":{}}',), ('{"source_id":"2"}',)], "value string")
    good, bad = tables.read_jsonl(lines, "source_id string, listing struct<price:int>", "listing")
    assert [r.source_id for r in good.collect()] == ["1"]
    assert sorted(r.reason for r in bad.collect()) == ["bad json", "bad json", "no id", "no payload"]
