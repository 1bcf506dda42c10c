from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import types as T

from lattica.operators import telemetry as M
from lattica.sources.catalogs import current_catalog
from lattica.streaming import incremental as I

SCHEMA = T.StructType([T.StructField("sha256", T.StringType()), T.StructField("n", T.LongType()), T.StructField("s", T.StringType())])


def test_merge_reads_each_part_once(spark, tmp_path):
    parts, folder, state = str(tmp_path / "parts"), str(tmp_path / "cat"), str(tmp_path / "state")
    write = lambda rows, name: spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{parts}/{name}")
    write([("a", 1, None), ("b", 2, "x")], "part_0")
    I.merge_stream(spark, parts, SCHEMA, folder, state)
    write([("a", 5, "new"), ("c", None, "z")], "part_1")
    I.merge_stream(spark, parts, SCHEMA, folder, state)
    want = {("a", 5, "new"), ("b", 2, "x"), ("c", None, "z")}
    assert {tuple(r) for r in current_catalog(spark, folder).select("sha256", "n", "s").collect()} == want
    I.merge_stream(spark, parts, SCHEMA, folder, state)
    assert {tuple(r) for r in current_catalog(spark, folder).select("sha256", "n", "s").collect()} == want


def test_event_windows_on_a_stream(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").select("ts", "event_type", "value")
    events.write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "e"))
    q = I.event_windows(stream, "ts", "event_type", "value", "1 hour").writeStream.outputMode("complete").format("memory").queryName("hours").start()
    q.processAllAvailable()
    q.stop()
    got = {(r.start, r.event_type): r.n for r in spark.table("hours").collect()}
    assert got == {(r.start, r.event_type): r.n for r in I.event_windows(events, "ts", "event_type", "value", "1 hour").collect()}


def test_rolling_percentile_needs_a_full_ring(spark):
    values = [5.0, 1.0, float("nan"), 9.0, 3.0, float("inf"), 7.0]
    df = spark.createDataFrame([("r", i, v) for i, v in enumerate(values)], "run string, step long, value double")
    got = {r.step: r.clip for r in M.rolling_percentile(df, "value", ["step"], 3, 0.5, 6.0, ["run"]).collect()}
    assert got == {0: None, 1: None, 3: 5.0, 4: 3.0, 6: 6.0}


def test_moving_average(spark):
    df = spark.createDataFrame([("r", i, float(i)) for i in range(4)], "run string, step long, value double")
    assert M.ema(df, "value", ["step"], 0.5, ["run"]).first().ema == pytest.approx(2.125)


def test_metrics_by_leaf(spark):
    df = spark.createDataFrame([({"loss/a": 1.0, "t/min": 3.0},), ({"loss/a": 2.0, "t/min": 1.0, "t/max": 5.0},)], "m map<string,double>")
    assert {r.key: (r.value, r.n) for r in M.reduce_metrics(df, "m").collect()} == {"loss/a": (1.5, 2), "t/min": (1.0, 2), "t/max": (5.0, 1)}
    with pytest.raises(Exception, match="duplicate key"):
        a = spark.createDataFrame([("k", 1)], "k string, v int")
        M.merge_disjoint(a, a, "k", "v").collect()


def test_ssim_of_equal_images(spark):
    rng = np.random.default_rng(1)
    px = spark.createDataFrame([(i, j, float(v), float(v)) for i in range(12) for j, v in enumerate(rng.random(12))], "px int, py int, a double, b double")
    assert M.ssim(px, "a", "b").first().ssim == pytest.approx(1.0)


def test_stateful_stream_equals_batch(spark, tmp_path):
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = [(f"r{i % 2}", i, float(i * 7 % 11)) for i in range(24)]
    schema = "run string, step long, value double"
    for k in range(2):  # two files, one micro-batch each
        spark.createDataFrame(rows[12 * k : 12 * k + 12], schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"part={k}"))
    for name, make, want in (
        ("clip", lambda s: I.rolling_percentile_stream(s, 4, 0.5, 8.0), lambda d: M.rolling_percentile(d, "value", ["step"], 4, 0.5, 8.0, ["run"])),
        ("ema", lambda s: I.moving_average_stream(s, 0.5), None),
    ):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
        q = make(stream).writeStream.outputMode("append").format("memory").queryName(f"state_{name}").option("checkpointLocation", str(tmp_path / name)).start()
        q.processAllAvailable()
        q.stop()
        got = {(r.run, r.step): r[name] for r in spark.table(f"state_{name}").collect()}
        assert len(got) == 24
        if want:
            assert got == {(r.run, r.step): r.clip for r in want(spark.createDataFrame(rows, schema)).collect()}
    last = {r.run: r.ema for r in M.ema(spark.createDataFrame(rows, schema), "value", ["step"], 0.5, ["run"]).collect()}
    assert {k: pytest.approx(v) for k, v in last.items()} == {"r0": got[("r0", 22)], "r1": got[("r1", 23)]}
    spark.conf.unset(key)


def test_progress_upsert(spark, tmp_path):
    schema = "key string, status string, n int"
    spark.createDataFrame([("a", "error", 1), ("b", "success", 2)], schema).coalesce(1).write.parquet(str(tmp_path / "in" / "p=0"))
    for _ in range(2):
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
        I.upsert_progress(stream, str(tmp_path / "cat"), str(tmp_path / "state"))
        spark.createDataFrame([("a", "success", 3)], schema).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "in" / "p=1"))
    assert {(r.key, r.status) for r in current_catalog(spark, str(tmp_path / "cat")).collect()} == {("a", "success"), ("b", "success")}


def test_progress_upserts_keep_whole_records(spark, tmp_path):
    """A later record replaces an earlier one cell for cell, nulls included; with an order, also if it arrives first."""
    schema = "key string, status string, error string, at long"
    for name, order, want in (("plain", None, ("a", "success", None)), ("ordered", "at", ("a", "done", "late"))):
        for i, row in enumerate([("a", "error", "boom", 1), ("a", "done", "late", 3), ("a", "success", None, 2)]):
            spark.createDataFrame([row], schema).write.parquet(str(tmp_path / name / "parts" / f"p{i}"))
            stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(tmp_path / name / "parts"))
            I.upsert_progress(stream, str(tmp_path / name / "cat"), str(tmp_path / name / "state"), order=order)
        r = I.current_catalog(spark, str(tmp_path / name / "cat")).collect()
        assert [(x.key, x.status, x.error) for x in r] == [want]
