"""Sources and sinks: payloads, CSV / parquet round trips, month landing."""

import datetime as dt
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daycast.session import ensure_checkpoint_dir
from daycast.sources.io import read_predictions, read_table, write_csv, write_table
from daycast.sources.landing import extract, land_months, landed_rows, missing_months, month_calendar
from daycast.sources.payloads import explode_inferred, explode_rows, infer_row_type, malformed_pages, parse_parallel


def _dir(spark, kind):
    return os.path.join(ensure_checkpoint_dir(spark), f"{kind}-{uuid.uuid4().hex}")


def test_row_array_and_nested_payloads(spark):
    row = T.StructType([T.StructField("datetime_beginning_ept", T.StringType()),
                        T.StructField("fuel_type", T.StringType()),
                        T.StructField("fuel_percentage_of_total", T.DoubleType())])
    items = [{"datetime_beginning_ept": "2024-01-01T00:00:00", "fuel_type": "Gas", "fuel_percentage_of_total": 0.4},
             {"datetime_beginning_ept": "2024-01-01T00:00:00", "fuel_type": "Wind", "fuel_percentage_of_total": 0.1}]
    df = spark.createDataFrame([(json.dumps({"items": items}),), (json.dumps({"items": []}),)], "payload string")
    out = explode_rows(df, "payload", ["items"], row).collect()
    assert [r.fuel_type for r in out] == ["Gas", "Wind"]
    eia = spark.createDataFrame([(json.dumps({"response": {"data": [{"period": "2024-01-02", "value": "2.5"}]}}),)],
                                "payload string")
    r = explode_rows(eia, "payload", ["response", "data"],
                     T.StructType([T.StructField("period", T.StringType()), T.StructField("value", T.StringType())])).first()
    assert (r.period, r.value) == ("2024-01-02", "2.5")


def test_rows_of_unknown_schema(spark):
    """Types merge over all pages, odd names and nesting included; unreadable pages are set aside whole."""
    pages = [
        '{"response": {"data": [{"a": 1, "b x": 0.5, "none": null, "mixed": "s"}, {"a": 2, "b x": 1e-7, "in": {"q": [1, 2.5]}}]}}',
        '{"response": {"data": [{"a": 3000000000, "mixed": 7, "OBJECT<": true, "VOID": "v"}, null]}}',
        '{"response": {"data": []}}', None,
        '{"response": {"data": [{"a": "cut"', '{"response": {"data": {"a": 1}}}', '{"response": {}}', '{"response": {"data": [{"a": 1, "a": 2}]}}', ""]
    df = spark.createDataFrame(list(enumerate(pages)), "page int, payload string").repartition(3)
    path = ["response", "data"]
    rows = {(r.page, r.a): r for r in explode_inferred(df, "payload", path, keep=["page"]).collect()}
    assert set(rows) == {(0, 1), (0, 2), (1, 3000000000), (1, None)}
    assert dict(explode_inferred(df, "payload", path).dtypes) == {
        "a": "bigint", "b x": "double", "none": "string", "mixed": "string", "in": "struct<q:array<double>>", "OBJECT<": "boolean", "VOID": "string"}
    assert rows[0, 1]["b x"] == 0.5 and rows[0, 2]["b x"] == 1e-7 and rows[0, 2]["in"].q == [1.0, 2.5]
    assert (rows[0, 1].mixed, rows[1, 3000000000].mixed, rows[1, 3000000000]["OBJECT<"], rows[1, 3000000000].VOID) == ("s", "7", True, "v")
    assert {r.page: r.payload for r in malformed_pages(df, "payload", path).collect()} == {i: pages[i] for i in range(4, 9)}


def test_rows_of_unknown_schema_edges(spark):
    def pages(*texts):
        return spark.createDataFrame([(t,) for t in texts], "payload string")

    for none in (pages(), pages('{"items": []}', "x"), pages('{"items": [null]}')):
        assert infer_row_type(none, "payload", ["items"]) is None
    assert explode_inferred(pages('{"items": [{}, {}]}').withColumn("k", F.lit(1)), "payload", ["items"], keep=["k"]).collect() == [(1,), (1,)]
    with pytest.raises(ValueError, match="no objects"):
        infer_row_type(pages('{"items": [1, 2]}'), "payload", ["items"])
    with pytest.raises(ValueError, match="quotes"):
        infer_row_type(pages("{}"), "payload", ["it'ems"])


def test_parallel_arrays(spark):
    doc = {"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m_previous_day1": [1.5, None]}}
    df = spark.createDataFrame([(json.dumps(doc),)], "payload string")
    out = parse_parallel(df, "payload", "hourly", {"time": T.StringType(), "temperature_2m_previous_day1": T.DoubleType()})
    assert [(r.time, r.temperature_2m_previous_day1) for r in out.collect()] == [
        ("2024-01-01T00:00", 1.5), ("2024-01-01T01:00", None)]


def test_csv_round_trip_keeps_naive_time(new_york):
    df = new_york.createDataFrame([("2024-03-10 02:00:00", 1.5, 2.5)], "d string, a double, p double").select(
        F.col("d").cast("timestamp_ntz").alias("datetime_ept"), F.col("a").alias("actual_rt"),
        F.col("p").alias("prediction"))
    path = _dir(new_york, "csv")
    write_csv(df, path)
    back = read_predictions(new_york, path).first()
    assert back.datetime_ept == dt.datetime(2024, 3, 10, 2) and back.prediction == 2.5


def test_partitioned_parquet_and_pruned_read(spark):
    df = spark.range(48).select((F.lit("2024-01-31").cast("timestamp_ntz") +
                                 F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("t"), "id")
    path = _dir(spark, "pq")
    write_table(df.withColumn("month", F.date_format("t", "yyyy-MM")), path, ["month"])
    feb = read_table(spark, path).filter(F.col("month") == "2024-02")
    assert feb.count() == 24
    assert "PartitionFilters" in feb._jdf.queryExecution().executedPlan().toString()


def test_month_calendar_and_missing_months(spark):
    b = spark.createDataFrame([(dt.date(2024, 1, 15), dt.date(2024, 4, 2))], "first date, last date")
    cal = month_calendar(b)
    rows = cal.orderBy("month").collect()
    assert [r.month_label for r in rows] == ["2024_01", "2024_02", "2024_03", "2024_04"]
    assert rows[1].range_text == "02-01-2024 00:00 to 02-29-2024 23:59"
    landed = spark.createDataFrame([(dt.date(2024, 2, 1),), (dt.date(2024, 3, 1),)], "month date")
    assert [r.month_label for r in missing_months(cal, landed).orderBy("month").collect()] == ["2024_01", "2024_04"]


def _hours(spark, n):
    return spark.range(n).select((F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("t"), "id")


def test_land_months_resumes_without_rewriting(spark):
    path = _dir(spark, "landing")
    df = _hours(spark, 24 * 40)
    land_months(df.filter(F.col("t") < F.lit("2024-02-01").cast("timestamp_ntz")), "t", path)
    land_months(df, "t", path)       # January already landed: only February is appended
    land_months(df, "t", path)       # nothing new
    assert landed_rows(spark, path).count() == 24 * 40


def test_cut_short_batch_is_not_read_and_lands_again(spark):
    path = _dir(spark, "landing-cut")
    df = _hours(spark, 24 * 40)
    df.withColumn("month", F.trunc("t", "month")).limit(5).write.partitionBy("month").parquet(f"{path}/rows/batch=cut")
    land_months(df, "t", path)
    assert landed_rows(spark, path).count() == 24 * 40


def test_unreadable_marks_raise_and_add_nothing(spark, tmp_path):
    path = str(tmp_path)
    df = _hours(spark, 24 * 40)
    land_months(df, "t", path)
    before = spark.read.parquet(f"{path}/rows").count()
    mark = next(p for p in (tmp_path / "landed").iterdir() if p.name.startswith("part-"))
    mark.write_bytes(b"not a parquet file")
    (tmp_path / "landed" / f".{mark.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception):
        land_months(df, "t", path)
    assert spark.read.parquet(f"{path}/rows").count() == before


def test_csv_keeps_microseconds_and_reads_nan_as_null(spark):
    path = _dir(spark, "csvmicro")
    df = spark.createDataFrame([("2024-03-10 05:00:00.123456", float("nan"), 2.5)], "d string, actual_rt double, prediction double").select(
        F.col("d").cast("timestamp_ntz").alias("datetime_ept"), "actual_rt", "prediction")
    write_csv(df, path)
    back = read_predictions(spark, path).first()
    assert back.datetime_ept == dt.datetime(2024, 3, 10, 5, 0, 0, 123456) and back.actual_rt is None and back.prediction == 2.5


def test_extract_pushes_filters(spark):
    path = _dir(spark, "ext")
    spark.range(100).select(F.col("id"), (F.col("id") % 3).cast("string").alias("k"),
                            (F.lit("2024-01-01").cast("timestamp_ntz") +
                             F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("t")).write.parquet(path)
    out = extract(spark.read.parquet(path), "t", "2024-01-02 00:00:00", "2024-01-02 23:59:59", key="k", values=["1"])
    assert out.count() == 8
    assert "PushedFilters: [IsNotNull(k), IsNotNull(t), In(k" in out._jdf.queryExecution().executedPlan().toString() or \
        "PushedFilters" in out._jdf.queryExecution().executedPlan().toString()


def test_land_months_only_within_calendar(spark):
    path = _dir(spark, "landing-cal")
    df = spark.range(24 * 60).select((F.lit("2024-01-01").cast("timestamp_ntz") +
                                      F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("t"), "id")
    cal = month_calendar(spark.createDataFrame([(dt.date(2024, 2, 1), dt.date(2024, 2, 29))], "first date, last date"))
    land_months(df, "t", path, calendar=cal)
    got = landed_rows(spark, path)
    assert got.count() == 24 * 29 and got.select("month").distinct().count() == 1


def test_read_table_over_a_file_glob_with_schema(spark):
    base = _dir(spark, "glob")
    for m in ["2024_01", "2024_02"]:
        spark.range(5).select(F.lit(f"{m[:4]}-{m[5:]}-01 00:00:00").alias("datetime_beginning_ept"),
                              F.col("id").cast("double").alias("total_lmp_rt"),
                              F.lit(1.0).alias("unused")).write.parquet(f"{base}/rt_da_{m}.parquet")
    df = read_table(spark, f"{base}/rt_da_*.parquet", "datetime_beginning_ept string, total_lmp_rt double")
    assert df.count() == 10 and df.columns == ["datetime_beginning_ept", "total_lmp_rt"]
    assert "ReadSchema: struct<datetime_beginning_ept:string,total_lmp_rt:double>" in \
        df._jdf.queryExecution().executedPlan().toString()


def test_csv_reads_fractional_and_whole_second_stamps(spark):
    path = _dir(spark, "csvfrac")
    spark.createDataFrame([("2024-03-10 02:00:00", "1.5", "2.5"), ("2024-03-10 03:00:00.250000", "3", "4")],
                          "datetime_ept string, actual_rt string, prediction string").write.option(
        "header", True).csv(path)
    rows = sorted(read_predictions(spark, path).collect())
    assert rows[0].datetime_ept == dt.datetime(2024, 3, 10, 2)
    assert rows[1].datetime_ept == dt.datetime(2024, 3, 10, 3, 0, 0, 250000)


def test_malformed_payload_fails_instead_of_dropping_rows(spark):
    row = T.StructType([T.StructField("a", T.LongType())])
    df = spark.createDataFrame([('{"items": [{"a": 1}]}',), ('{"items": [{"a": 1}',)], "payload string")
    with pytest.raises(Exception):
        explode_rows(df, "payload", ["items"], row).collect()


def test_parallel_arrays_of_unequal_length_fail(spark):
    doc = {"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "x": [1.0]}}
    df = spark.createDataFrame([(json.dumps(doc),)], "payload string")
    with pytest.raises(Exception):
        parse_parallel(df, "payload", "hourly", {"time": T.StringType(), "x": T.DoubleType()}).collect()
