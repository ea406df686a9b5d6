"""Registered source / sink queries: CSV and parquet round trips, JSON payloads,
month calendars, resumable landing and the streaming hourly rollup."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from daycast.functions.time import hour_floor, week_label
from daycast.operators.sets import union_all
from daycast.plans import views as V
from daycast.plans.oracle import with_views
from daycast.plans.registry import register
from daycast.session import ensure_checkpoint_dir, write_stage
from daycast.sources.io import file_order, read_predictions, read_table, write_csv, write_sorted, write_table
from daycast.sources.landing import land_months, landed_rows, missing_months, month_calendar
from daycast.sources.payloads import explode_inferred, explode_rows, malformed_pages, parse_parallel
from daycast.streaming.hourly import run_hourly_rollup

_TSFMT = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def scratch(spark, kind: str) -> str:
    """A fresh folder under the session's (shared) checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), f"{kind}-{uuid.uuid4().hex}")


@register("csv_roundtrip", with_views("SELECT datetime_ept, actual_rt, prediction FROM v_pred", "v_pred"),
          ["actual_rt", "prediction"])
def q_csv_roundtrip(spark, sf):
    """Predictions to CSV and back, the timestamp re-parsed as naive local time."""
    path = scratch(spark, "predictions-csv")
    write_csv(V.v_pred(spark, sf).select("datetime_ept", "actual_rt", "prediction"), path)
    return read_predictions(spark, path)


@register("parquet_roundtrip", with_views("SELECT * FROM v_pred", "v_pred"),
          ["actual_rt", "prediction", "benchmark"])
def q_parquet_roundtrip(spark, sf):
    """Predictions to parquet partitioned by week and back (partition column dropped)."""
    path = scratch(spark, "predictions-parquet")
    p = V.v_pred(spark, sf)
    write_table(p.withColumn("week", week_label("datetime_ept")), path, ["week"])
    return read_table(spark, path).select(*p.columns)


_ROW = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("value", T.DoubleType()),
])


PAGE_ROWS = 500


def _pages(spark, sf, wrap):
    """API-style pages: JSON documents of at most ``PAGE_ROWS`` rows of one event type,
    however many events an hour has."""
    e = V.events(spark, sf)
    rows = F.collect_list(F.struct("event_id", "ts", "user_id", "value"))
    page = e.groupBy("event_type", F.floor(F.col("event_id") / PAGE_ROWS).alias("page")).agg(rows.alias("rows"))
    return page.select("event_type", F.to_json(wrap(F.col("rows")), _TSFMT).alias("payload"))


@register("ingest_row_array", "SELECT event_type, event_id, ts, user_id, value FROM events", ["value"])
def q_ingest_row_array(spark, sf):
    """``{"items": [{...}]}`` pages to rows."""
    pages = _pages(spark, sf, lambda r: F.struct(r.alias("items")))
    return explode_rows(pages, "payload", ["items"], _ROW, keep=["event_type"])


@register("ingest_nested_rows", "SELECT event_type, event_id, ts, user_id, value FROM events", ["value"])
def q_ingest_nested_rows(spark, sf):
    """``{"response": {"data": [{...}]}}`` pages to rows."""
    pages = _pages(spark, sf, lambda r: F.struct(F.struct(r.alias("data")).alias("response")))
    return explode_rows(pages, "payload", ["response", "data"], _ROW, keep=["event_type"])


@register("ingest_parallel_arrays", with_views("SELECT ts AS time, v FROM v_all", "v_all"), ["v"])
def q_ingest_parallel_arrays(spark, sf):
    """``{"hourly": {"time": [...], "v": [...]}}`` daily documents to hourly rows."""
    a = V.v_all(spark, sf)
    day = a.groupBy(F.to_date("ts").alias("day")).agg(F.sort_array(F.collect_list(F.struct("ts", "v"))).alias("s"))
    doc = day.select(F.to_json(F.struct(F.struct(
        F.transform("s", lambda x: x["ts"]).alias("time"),
        F.transform("s", lambda x: x["v"]).alias("v")).alias("hourly")), _TSFMT).alias("payload"))
    return parse_parallel(doc, "payload", "hourly", {"time": T.TimestampNTZType(), "v": T.DoubleType()})


def _mixed_pages(spark, sf):
    """Every page twice: whole, and cut short."""
    pages = _pages(spark, sf, lambda r: F.struct(r.alias("items")))
    return pages.select("event_type", F.explode(F.array("payload", F.expr("left(payload, length(payload) - 2)"))).alias("payload"))


@register("ingest_unknown_schema", "SELECT event_type, event_id, ts, user_id, value FROM events", ["value"])
def q_ingest_unknown_schema(spark, sf):
    """Pages to rows with the row type inferred from all of them; pages cut short add none."""
    rows = explode_inferred(_mixed_pages(spark, sf), "payload", ["items"], keep=["event_type"])
    return rows.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("ingest_set_aside", f"SELECT event_type, count(DISTINCT event_id // {PAGE_ROWS}) AS n_pages FROM events GROUP BY event_type")
def q_ingest_set_aside(spark, sf):
    """The unreadable pages by event type."""
    bad = malformed_pages(_mixed_pages(spark, sf), "payload", ["items"])
    return bad.groupBy("event_type").agg(F.count("payload").alias("n_pages"))


_CAL_SQL = """SELECT CAST(m AS DATE) AS month, last_day(m) AS month_end, strftime(m, '%Y_%m') AS month_label,
  strftime(m, '%m-%d-%Y') || ' 00:00 to ' || strftime(last_day(m), '%m-%d-%Y') || ' 23:59' AS range_text
FROM (SELECT unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi), INTERVAL 1 MONTH)) AS m
      FROM ({bounds}))"""
_ORD_BOUNDS = "SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders"


@register("month_calendar", _CAL_SQL.format(bounds=_ORD_BOUNDS), dates=["month", "month_end"])
def q_month_calendar(spark, sf):
    """Months spanned by the orders, with first / last day and the feed's range text."""
    b = V.orders(spark, sf).agg(F.to_date(F.min("o_orderdate")).alias("first"),
                                F.to_date(F.max("o_orderdate")).alias("last"))
    return month_calendar(b)


_SPAN = """SELECT min(d) AS lo, max(d) AS hi FROM (
  SELECT CAST(min(o_orderdate) AS DATE) AS d FROM orders UNION ALL SELECT CAST(max(l_shipdate) AS DATE) FROM lineitem)"""


@register("missing_months", f"""SELECT c.* FROM ({_CAL_SQL.format(bounds=_SPAN)}) c
WHERE c.month NOT IN (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) FROM orders)""",
          dates=["month", "month_end"])
def q_missing_months(spark, sf):
    """Months between the first order and the last shipment with no orders landed."""
    o, li = V.orders(spark, sf), V.lineitem(spark, sf)
    ends = union_all([o.agg(F.to_date(F.min("o_orderdate")).alias("d")),
                      li.agg(F.to_date(F.max("l_shipdate")).alias("d"))])
    cal = month_calendar(ends.agg(F.min("d").alias("first"), F.max("d").alias("last")))
    landed = o.select(F.trunc(F.to_date("o_orderdate"), "month").alias("month"))
    return missing_months(cal, landed)


@register("land_months", """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_orders
FROM orders GROUP BY 1""", dates=["month"])
def q_land_months(spark, sf):
    """A backfill in two runs, the first of which stops half-way through the months: every
    month is landed once."""
    o = V.orders(spark, sf).select("o_orderkey", "o_orderdate", "o_totalprice")
    path = scratch(spark, "landing")
    half = o.agg(F.expr("timestampadd(SECOND, cast(timestampdiff(SECOND, min(o_orderdate), max(o_orderdate)) / 2 as int), min(o_orderdate))").alias("h"))
    months = month_calendar(half.select(F.lit("1900-01-01").cast("date").alias("first"), F.to_date("h").alias("last")))
    land_months(o, "o_orderdate", path, months)
    land_months(o, "o_orderdate", path)
    return landed_rows(spark, path).groupBy("month").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("o_orderkey").alias("n_orders"))


@register("stage_table", with_views("SELECT event_type, ts, v, n FROM v_hourly WHERE n > 1", "v_hourly"), ["v"])
def q_stage_table(spark, sf):
    """A stage written to the shared checkpoint folder; what follows reads its files."""
    return write_stage(V.v_hourly(spark, sf)).filter("n > 1").select("event_type", "ts", "v", "n")


@register("hourly_stream", """SELECT event_type, date_trunc('hour', ts) AS hour_start, avg(value) AS mean_value,
  count(*) AS n FROM events GROUP BY 1, 2""", ["mean_value"])
def q_hourly_stream(spark, sf):
    """Structured Streaming: hourly mean per event type, merged per micro-batch. The events are
    written once, each task dealing its rows to four folders by hash, and come in about four
    micro-batches, so every hour is corrected by later ones."""
    folder = scratch(spark, "readings")
    e = V.events(spark, sf).select("event_type", "ts", "value", "event_id")
    e.withColumn("delivery", F.pmod(F.xxhash64("event_id"), F.lit(4))).write.partitionBy("delivery").parquet(folder)
    files = len(spark.read.parquet(folder).inputFiles())
    return run_hourly_rollup(spark, f"{folder}/*", "*.parquet", e.schema, "ts", "value", ["event_type"], files_per_batch=max(1, -(-files // 4)))


@register("latest_version_stream", """SELECT event_type, ts, event_id, value FROM (
  SELECT event_type, date_trunc('hour', ts) AS ts, event_id, value FROM events)
QUALIFY event_id = max(event_id) OVER (PARTITION BY event_type, ts)""", ["value"])
def q_latest_version_stream(spark, sf):
    """Streaming keyed upsert: the current (highest) version per (event type, hour)."""
    from daycast.streaming.versions import run_latest_versions
    schema = read_table(spark, f"{sf}/events.parquet").schema
    prep = lambda b: b.select("event_type", hour_floor("ts").alias("ts"), "event_id", "value")
    out = run_latest_versions(spark, sf, "events.parquet", schema, ["event_type", "ts"], "event_id", prepare=prep)
    return out.select("event_type", "ts", "event_id", "value")


@register("sorted_output", with_views("""SELECT count(*) AS n_rows, count(*) FILTER (event_type IS NOT NULL) AS n_typed, min(ts) AS first_ts, max(ts) AS last_ts,
  CAST(0 AS BIGINT) AS n_out_of_order, CAST(0 AS BIGINT) AS n_overlaps, sum(v) AS total FROM v_hourly""", "v_hourly"), ["total"])
def q_sorted_output(spark, sf):
    """The hourly rows written in chronological order and read back: files sorted in
    themselves, and none that overlaps another in time."""
    from pyspark.sql import Window
    path = scratch(spark, "sorted")
    write_sorted(V.v_hourly(spark, sf), path, ["ts", "event_type"], files=6)
    files = file_order(spark, path, "ts")
    # one row per file; a stamp that two files share is no overlap
    ends = files.withColumn("overlaps", F.coalesce(F.max("last").over(Window.orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)) > F.col("first"), F.lit(False)))
    checks = ends.agg(F.sum("n_out_of_order").alias("n_out_of_order"), F.count_if("overlaps").alias("n_overlaps"))
    rows = read_table(spark, path).agg(F.count(F.lit(1)).alias("n_rows"), F.count("event_type").alias("n_typed"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
                                       F.sum("v").alias("total"))
    names = ["n_rows", "n_typed", "first_ts", "last_ts", "n_out_of_order", "n_overlaps", "total"]
    return rows.unionByName(checks, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in names])  # one row of each
