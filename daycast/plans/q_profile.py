"""Registered profiling, projection and filter queries over the raw tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from daycast.functions.time import to_ntz
from daycast.functions.transforms import clip
from daycast.operators.normalize import normalize
from daycast.operators.profile import (
    coverage, describe_columns, finite, has_nulls, histogram, latest_rows, null_audit, preview, schema_profile,
    top_correlations,
)
from daycast.operators.sketches import merge_sketches, quantile_sketches, sketch_quantiles
from daycast.plans import views as V
from daycast.plans.oracle import with_views
from daycast.plans.q_features import SOURCE_JOIN_SQL, SOURCE_JOIN_VIEWS, source_join
from daycast.plans.registry import register
from daycast.session import write_stage
from daycast.sources.landing import extract


_SIDES = {"has_click": "click_v", "has_view": "view_v", "has_daily": "daily_value"}
_SJ = SOURCE_JOIN_SQL


@register("null_audit", with_views(
    "SELECT count(*) AS total_rows, " + ", ".join(
        f"count({c}) AS {n}, count(*) - count({c}) AS {n}_nulls, count(*) FILTER (isnan({c})) AS {n}_nans" for n, c in _SIDES.items())
    + f" FROM (SELECT * REPLACE (CASE WHEN hour(ts) = 3 THEN 'NaN'::DOUBLE ELSE view_v END AS view_v) FROM ({_SJ}))", *SOURCE_JOIN_VIEWS))
def q_null_audit(spark, sf):
    """Row count, and values, NULLs and NaNs per joined source (which sources leave gaps);
    one source's value is NaN at 3 o'clock."""
    joined = source_join(spark, sf).withColumn("view_v", F.when(F.hour("ts") == 3, F.lit(float("nan"))).otherwise(F.col("view_v")))
    return null_audit(joined, _SIDES)


@register("has_nulls", with_views(
    f"SELECT count(*) FILTER (len([x FOR x IN [v, click_v, error_v, purchase_v, signup_v, view_v, daily_value] IF x IS NULL]) > 0) > 0 AS has_nulls FROM ({_SJ})",
    *SOURCE_JOIN_VIEWS))
def q_has_nulls(spark, sf):
    return has_nulls(source_join(spark, sf))


@register("coverage", "SELECT event_type, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n_rows "
                      "FROM events GROUP BY event_type")
def q_coverage(spark, sf):
    return coverage(V.events(spark, sf), "ts", ["event_type"])


_DESC_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "odd_tax"]
# a column with every kind of value that is none
_ODD_SQL = "CASE l_linenumber WHEN 7 THEN 'NaN'::DOUBLE WHEN 6 THEN 'Infinity'::DOUBLE WHEN 5 THEN NULL ELSE l_tax END"


def _odd(li):
    n = F.col("l_linenumber")
    return li.withColumn("odd_tax", F.when(n == 7, float("nan")).when(n == 6, float("inf")).when(n != 5, F.col("l_tax")))


_desc_sql = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(x) AS count, avg(x) AS mean, stddev_samp(x) AS std, min(x) AS min, quantile_cont(x, 0.25) AS q25, "
    f"quantile_cont(x, 0.5) AS q50, quantile_cont(x, 0.75) AS q75, max(x) AS max, count(*) - count(y) AS n_null, count(y) - count(x) AS n_nonfinite "
    f"FROM (SELECT CAST({c} AS DOUBLE) AS y, CASE WHEN isfinite(CAST({c} AS DOUBLE)) THEN CAST({c} AS DOUBLE) END AS x FROM odd)" for c in _DESC_COLS)


@register("describe_columns", f"WITH odd AS (SELECT *, {_ODD_SQL} AS odd_tax FROM lineitem) {_desc_sql}", ["mean", "std", "min", "q25", "q50", "q75", "max"])
def q_describe_columns(spark, sf):
    """count, mean, std, min, quartiles, max of the finite values per numeric column, and
    the counts of what is none."""
    return describe_columns(_odd(V.lineitem(spark, sf)), _DESC_COLS)


def _histogram_sql(value: str, bins: int) -> str:
    return f"""WITH x AS (SELECT v FROM (SELECT CAST({value} AS DOUBLE) AS v FROM lineitem) WHERE isfinite(v)),
s AS (SELECT min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / {bins} AS width FROM x)
SELECT CAST(g.bin AS INTEGER) AS bin, lo + g.bin * width AS bin_lo, lo + (g.bin + 1) * width AS bin_hi,
  (SELECT count(*) FROM x WHERE least(floor((v - lo) / width), {bins - 1}) = g.bin) AS n FROM range({bins}) g(bin), s"""


@register("histogram", _histogram_sql("l_extendedprice", 100), ["bin_lo", "bin_hi"])
def q_histogram(spark, sf):
    """100 equal-width bins of the extended price, empty bins included."""
    return histogram(V.lineitem(spark, sf), "l_extendedprice", 100)


@register("histogram_finite", _histogram_sql(_ODD_SQL, 7), ["bin_lo", "bin_hi"])
def q_histogram_finite(spark, sf):
    """A histogram of a column that also holds NaN, infinite and NULL values."""
    return histogram(_odd(V.lineitem(spark, sf)), "odd_tax", 7)


_CORR_COLS = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_partkey", "l_suppkey", "l_orderkey"]
_corr_sql = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, corr(CAST({c} AS DOUBLE), l_extendedprice) AS corr FROM lineitem" for c in _CORR_COLS)


@register("top_correlations", f"""SELECT feature, corr, abs(corr) AS abs_corr FROM ({_corr_sql})
WHERE corr IS NOT NULL ORDER BY abs(corr) DESC, feature LIMIT 5""", ["corr", "abs_corr"])
def q_top_correlations(spark, sf):
    """Columns most correlated (|Pearson|) with the extended price, top 5."""
    return top_correlations(V.lineitem(spark, sf), "l_extendedprice", _CORR_COLS, k=5)


@register("profile_flags", """SELECT count(*) AS n_rows,
  CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS n_returned,
  CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS n_open FROM lineitem""")
def q_profile_flags(spark, sf):
    li = V.lineitem(spark, sf)
    return li.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).cast("long").alias("n_returned"),
                  F.sum(F.when(F.col("l_linestatus") == "O", 1).otherwise(0)).cast("long").alias("n_open"))


@register("latest_rows", """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10""", {"o_totalprice": 2})
def q_latest_rows(spark, sf):
    o = V.orders(spark, sf).select("o_orderkey", "o_orderdate", "o_totalprice")
    return latest_rows(o, "o_orderdate", 10, tiebreak=["o_orderkey"])


@register("preview", "SELECT least(count(*), 5) AS n_rows, least(count(*), 5) AS n_found FROM orders")
def q_preview(spark, sf):
    """Unordered peek at a table: which rows is not defined, so they are looked up in it."""
    o = V.orders(spark, sf)
    keys = preview(o, 5).select("o_orderkey", F.lit(1).alias("seen"))
    n = keys.agg(F.count("seen").alias("n_rows"))
    found = o.select("o_orderkey").distinct().join(keys, "o_orderkey").agg(F.sum("seen").alias("n_found"))
    return n.select("n_rows", found.select(F.coalesce("n_found", F.lit(0)).cast("long")).scalar().alias("n_found"))


@register("schema_profile", """SELECT CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
    WHEN 'VARCHAR' THEN 'string' WHEN 'DATE' THEN 'date' ELSE 'timestamp_ntz' END AS dtype,
  CAST(count(*) AS INTEGER) AS n_columns, (SELECT count(*) FROM lineitem) AS n_rows, CAST(sum(count(*)) OVER () AS INTEGER) AS total_columns
FROM (DESCRIBE lineitem) GROUP BY 1""")
def q_schema_profile(spark, sf):
    """Type counts, column count and row count of a table."""
    return schema_profile(V.lineitem(spark, sf))


@register("scan_project", """SELECT l_orderkey AS order_key, l_linenumber AS line_number, l_quantity AS quantity,
  l_extendedprice AS extended_price, l_shipdate AS ship_ts FROM lineitem""", {"extended_price": 2})
def q_scan_project(spark, sf):
    """Projection and rename straight off the parquet scan (only five columns are read)."""
    return normalize(V.lineitem(spark, sf), {
        "order_key": "l_orderkey", "line_number": "l_linenumber", "quantity": "l_quantity",
        "extended_price": "l_extendedprice", "ship_ts": "l_shipdate"})


@register("normalize_casts", """SELECT o_orderkey,
  CAST(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS order_ts,
  CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS order_date,
  CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE) AS total_price FROM orders""", {"total_price": 2},
          dates=["order_date"])
def q_normalize_casts(spark, sf):
    """Text feeds to typed columns: timestamp (naive), date and double from strings."""
    o = V.orders(spark, sf).select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("ts_text"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_text"),
        F.col("o_totalprice").cast("string").alias("price_text"))
    return normalize(o, {"o_orderkey": "o_orderkey", "order_ts": to_ntz("ts_text"),
                         "order_date": ("date_text", "date"), "total_price": ("price_text", "double")})


@register("clip_range", """SELECT l_orderkey, l_linenumber,
  CASE WHEN l_discount < 0.02 THEN 0.02 WHEN l_discount > 0.08 THEN 0.08 ELSE l_discount END AS discount_clipped
FROM lineitem""", ["discount_clipped"])
def q_clip_range(spark, sf):
    li = V.lineitem(spark, sf)
    return li.select("l_orderkey", "l_linenumber", clip("l_discount", 0.02, 0.08).alias("discount_clipped"))


@register("filtered_extract", """SELECT event_id, event_type, ts, value FROM events
WHERE event_type IN ('click', 'view') AND ts >= TIMESTAMP '2024-01-05 00:00:00'
  AND ts <= TIMESTAMP '2024-01-20 23:59:59'""", ["value"])
def q_filtered_extract(spark, sf):
    """Series and time-range extract; both predicates are pushed into the parquet scan."""
    e = V.events(spark, sf)
    return extract(e, "ts", "2024-01-05 00:00:00", "2024-01-20 23:59:59", key="event_type",
                   values=["click", "view"]).select("event_id", "event_type", "ts", "value")


_SKETCHED = ["l_extendedprice", "odd_tax"]
_QUARTILES = [0.25, 0.5, 0.75]


@register("sketch_quartiles", f"WITH odd AS (SELECT *, {_ODD_SQL} AS odd_tax FROM lineitem), " + """x AS (
  SELECT CAST(year(l_shipdate) AS BIGINT) AS year, u.column, u.x FROM odd, (SELECT unnest([{'column': 'l_extendedprice', 'x': CAST(l_extendedprice AS DOUBLE)}, {'column': 'odd_tax', 'x': CAST(odd_tax AS DOUBLE)}]) AS u))
SELECT year, "column", count(*) AS n, min(x) AS smallest, max(x) AS largest, CAST(3 AS BIGINT) AS n_close FROM x WHERE isfinite(x) GROUP BY ALL""",
          ["smallest", "largest"])
def q_sketch_quartiles(spark, sf):
    """Monthly sketches, written and merged by year: values, extremes, and how many of the three
    quartiles have a true rank within 2 % of theirs."""
    rows = _odd(V.lineitem(spark, sf)).select("l_shipdate", *_SKETCHED)
    monthly = write_stage(quantile_sketches(rows.withColumn("month", F.date_format("l_shipdate", "yyyy-MM")), ["month"], _SKETCHED))
    yearly = merge_sketches(monthly.withColumn("year", F.left("month", F.lit(4)).cast("long")), ["year"], _SKETCHED)
    found = write_stage(sketch_quantiles(yearly, ["year"], _SKETCHED, [0.0, *_QUARTILES, 1.0]).where("n > 0"))
    values = rows.select(F.year("l_shipdate").cast("long").alias("year"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), finite(c).alias("x")) for c in _SKETCHED])).alias("s")).select("year", "s.*").where("x IS NOT NULL")
    met = values.join(F.broadcast(found), ["year", "column"])  # a row per calendar year and column
    q = [F.col("quantiles")[i] for i in range(5)]
    ranks = met.groupBy("year", "column", "n", q[0].alias("smallest"), q[4].alias("largest")).agg(
        *[F.avg((F.col("x") < q[i]).cast("int")).alias(f"below{i}") for i in (1, 2, 3)],
        *[F.avg((F.col("x") <= q[i]).cast("int")).alias(f"up_to{i}") for i in (1, 2, 3)])
    close = sum((F.lit(r).between(F.col(f"below{i}") - 0.02, F.col(f"up_to{i}") + 0.02).cast("long") for i, r in enumerate(_QUARTILES, 1)), F.lit(0).cast("long"))
    return ranks.select("year", "column", "n", "smallest", "largest", close.alias("n_close"))
