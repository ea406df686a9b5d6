"""Structured Streaming hourly rollup equals the batch aggregate."""

from pyspark.sql import functions as F

from daycast.functions.time import hour_floor
from daycast.sources.io import read_table
from daycast.streaming.hourly import run_hourly_rollup

SF = "/root/testdata/sf0.001"


def test_stream_rollup_equals_batch(spark):
    schema = read_table(spark, f"{SF}/events.parquet").schema
    got = run_hourly_rollup(spark, SF, "events.parquet", schema, "ts", "value", ["event_type"])
    e = read_table(spark, f"{SF}/events.parquet")
    want = e.groupBy("event_type", hour_floor("ts").alias("hour_start")).agg(
        F.avg("value").alias("mean_value"), F.count(F.lit(1)).alias("n"))
    r = lambda df: df.select("event_type", "hour_start", F.round("mean_value", 9).alias("m"), "n")
    assert r(got).exceptAll(r(want)).count() == 0 and r(want).exceptAll(r(got)).count() == 0


def test_stream_restart_resumes_from_checkpoint(spark):
    """A restarted run on the same output folder resumes from its checkpoint: no file
    is processed twice and the upserted table is unchanged."""
    import os
    import uuid
    from daycast.session import ensure_checkpoint_dir
    out = os.path.join(ensure_checkpoint_dir(spark), f"restart-{uuid.uuid4().hex}")
    schema = read_table(spark, f"{SF}/events.parquet").schema
    first = run_hourly_rollup(spark, SF, "events.parquet", schema, "ts", "value", ["event_type"], out_dir=out)
    a = sorted(first.collect())
    n_batches = spark.read.parquet(os.path.join(out, "data")).select("batch_id").distinct().count()
    again = run_hourly_rollup(spark, SF, "events.parquet", schema, "ts", "value", ["event_type"], out_dir=out)
    assert sorted(again.collect()) == a
    assert spark.read.parquet(os.path.join(out, "data")).select("batch_id").distinct().count() == n_batches


def test_late_files_correct_closed_hours(spark, tmp_path):
    """Three files in three runs, the last four days older than the first."""
    schema = "k string, t timestamp_ntz, v double"
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    files = [[("a", "2024-01-05 10:10:00", 1.0), ("a", "2024-01-05 10:20:00", 2.0)], [("a", "2024-01-06 10:10:00", 5.0), ("a", "2024-01-05 10:59:59", 9.0)],
             [("a", "2024-01-01 03:00:00", 7.0), ("a", "2024-01-05 10:00:00", None)]]
    typed = spark.createDataFrame([], schema).schema
    for k, rows in enumerate(files):
        spark.createDataFrame(rows, "k string, t string, v double").withColumn("t", F.col("t").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(source)
        table = run_hourly_rollup(spark, source, "*.parquet", typed, "t", "v", ["k"], out_dir=out, files_per_batch=1, compact_after=2)
        got = {r.hour_start.isoformat(): (r.mean_value, r.n) for r in table.collect()}
    assert got == {"2024-01-05T10:00:00": (4.0, 4), "2024-01-06T10:00:00": (5.0, 1), "2024-01-01T03:00:00": (7.0, 1)}
    assert spark.read.parquet(f"{out}/compact").count() >= 2


def test_checkpoint_folder_is_demanded_off_local():
    from types import SimpleNamespace

    import pytest

    from daycast.session import ensure_checkpoint_dir
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: {}, master="spark://host:7077")
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc))


def _arrivals(spark, folder, n):
    """``n`` files, one record version each; every third is older than what came before."""
    for k in range(n):
        rows = [("a", k if k % 3 else max(k - 7, 0), f"a{k}"), (f"k{k % 5}", k, f"x{k}")]
        spark.createDataFrame(rows, "key string, version int, v string").coalesce(1).write.mode("append").parquet(folder)
        yield rows


def test_versions_after_many_batches_are_one_table(spark, tmp_path):
    """A read after the last compaction scans that table alone; late lower versions lose; a restart goes on."""
    from daycast.streaming.versions import run_latest_versions, version_table
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    schema = spark.createDataFrame([], "key string, version int, v string").schema
    want: dict = {}
    arrivals = _arrivals(spark, source, 12)
    for stop in (5, 12):
        for rows in [next(arrivals) for _ in range(stop - (0 if stop == 5 else 5))]:
            for key, version, v in rows:
                if version >= want.get(key, (-1, ""))[0]:
                    want[key] = max(want.get(key, (-1, "")), (version, v))
        got = run_latest_versions(spark, source, "*.parquet", schema, ["key"], "version", out_dir=out, files_per_batch=1, compact_after=4)
        assert {r.key: r.version for r in got.collect()} == {k: w[0] for k, w in want.items()}
    table = version_table(spark, out, ["key"], "version", 4)
    assert table.covered() == 11 and all("/compact/batch_id=11/" in f for f in table.current().inputFiles())
    assert "Window" not in table.current()._jdf.queryExecution().executedPlan().toString()


def test_a_compaction_that_was_cut_short_is_not_read(spark, tmp_path):
    import os

    from daycast.streaming.batches import BatchTable
    table = BatchTable(spark, f"{tmp_path}/t", lambda rows: rows.groupBy("k").agg(F.sum("n").alias("n")), compact_after=100)
    for b in range(3):
        table.write(spark.createDataFrame([("x", 1), ("y", b)], "k string, n long"), b)
    assert table.compact(min_batches=4) is False and table.compact() is True and table.covered() == 2
    table.write(spark.createDataFrame([("x", 5)], "k string, n long"), 3)
    spark.createDataFrame([("x", 1000)], "k string, n long").write.parquet(f"{tmp_path}/t/compact/batch_id=3")
    os.remove(f"{tmp_path}/t/compact/batch_id=3/_SUCCESS")
    assert table.covered() == 2 and sorted(map(tuple, table.current().collect())) == [("x", 8), ("y", 3)]
    table.write(spark.createDataFrame([("x", 6)], "k string, n long"), 3)  # a replayed batch takes its own place
    assert sorted(map(tuple, table.current().collect())) == [("x", 9), ("y", 3)]
    assert table.compact() and table.covered() == 3 and sorted(map(tuple, table.current().collect())) == [("x", 9), ("y", 3)]
