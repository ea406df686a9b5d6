"""Physical-plan properties that matter at scale: rows reduced before shuffles, broadcasts
of calendar tables only, one exchange for the feature window, no cartesian or
nested-loop joins and no Python evaluation in any registered query."""

import threading

import pytest
from pyspark.sql import functions as F

from daycast.operators.dedupe import dedupe_hours, latest_before_cutoff
from daycast.plans import views as V
from daycast.plans.folds import tag_periods

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_limits_each_key_before_the_shuffle(spark):
    # one key holds a third of the rows
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                  F.lit("2024-01-01").cast("timestamp_ntz").alias("t"), F.col("id").alias("v"))
    p = plan(dedupe_hours(df, "t", ["k"], order_by=["v"]))
    assert p.count("WindowGroupLimit") >= 2 and p.rindex("WindowGroupLimit") > p.index("Exchange")  # one below the exchange
    assert dedupe_hours(df, "t", ["k"], order_by=["v"]).filter("k = 0").first().v == 0


def test_latest_before_cutoff_limits_before_the_shuffle(spark):
    p = plan(latest_before_cutoff(V.v_versioned(spark, SF), "target", "issued", ["series"], tiebreak=["event_id"]))
    assert p.count("WindowGroupLimit") >= 2 and p.rindex("WindowGroupLimit") > p.index("Exchange")


def test_period_tagging_broadcasts_the_period_table(spark):
    p = plan(tag_periods(V.v_orders_daily(spark, SF), "ts", "month"))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_daily_fill_broadcasts_its_dates(spark):
    from __spark_entry__ import queries
    assert "BroadcastHashJoin" in plan(queries()["fill_from_daily"](spark, SF))


def test_no_query_leaves_cached_blocks(spark):
    from __spark_entry__ import queries
    for name in ["fill_from_daily", "source_join", "walk_forward_baseline", "fold_summary", "training_table"]:
        queries()[name](spark, SF).count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_rewritten_input_is_read_anew(spark, tmp_path):
    """A query over a file that was rewritten in one session sees its new rows."""
    from daycast.operators.fill import fill_from_daily
    from daycast.operators.joins import join_sources
    base = spark.sql("SELECT timestamp_ntz '2024-01-01 05:00:00' + make_dt_interval(cast(id as int)) AS t FROM range(5)")
    path = f"{tmp_path}/daily"
    for days in (2, 5):
        spark.sql(f"SELECT date_add(date '2024-01-01', cast(id as int)) AS d, cast(id + 1 as double) AS x FROM range({days})").coalesce(1).write.mode("overwrite").parquet(path)
        daily = spark.read.parquet(path)
        filled = [r.x for r in fill_from_daily(base, "t", daily, "d", ["x"]).orderBy("t").collect()]
        joined = [r.x for r in join_sources(base, [(daily, (F.to_date("t"), "d"))]).orderBy("t").collect()]
        assert filled == [float(min(i, days)) for i in range(1, 6)]
        assert joined == [float(i) if i <= days else None for i in range(1, 6)]


def _names():
    from __spark_entry__ import queries
    skip = {"grid_search_small", "walk_forward_gbt", "land_months", "final_fit", "importances", "split_importances",
            "model_roundtrip", "weighted_fit", "hourly_stream", "stage_table", "csv_roundtrip", "parquet_roundtrip",
            "latest_version_stream"}
    return sorted(n for n in queries() if n not in skip and not n.startswith("op") and n != "pipeline")


def planned_within(df, seconds):
    """The executed plan's text, or a failure if the optimizer takes longer than ``seconds``."""
    out = []
    worker = threading.Thread(target=lambda: out.append(plan(df)), daemon=True)
    worker.start()
    worker.join(seconds)
    assert out, f"no plan after {seconds} s"
    return out[0]


@pytest.mark.parametrize("name", _names())
def test_no_cartesian_and_no_python_in_registered_queries(spark, name):
    from __spark_entry__ import queries
    p = planned_within(queries()[name](spark, SF), 60)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_renamed_columns_of_complete_rows_plan_in_seconds(spark):
    """500 renamed struct fields, filtered for completeness, correlated with a target and joined."""
    from daycast.operators.filters import complete_rows
    from daycast.operators.profile import correlations, top_correlations
    n = 500
    packed = spark.range(100).select("id", F.struct(*[(F.col("id") * i % 7).cast("double").alias(f"f{i}") for i in range(n)]).alias("p"))
    wide = complete_rows(packed.select("id", *[F.col(f"p.f{i}").alias(f"x{i}") for i in range(n)]), ["id"])
    with_target = wide.withColumn("y", F.asinh(F.col("id").cast("double")))
    planned_within(correlations(with_target, "y", [f"x{i}" for i in range(n)]), 60)
    few = wide.select("id", *[f"x{i}" for i in range(100)])
    planned_within(few.join(spark.range(10), "id"), 60)
    best = top_correlations(with_target, "y", [f"x{i}" for i in range(100)], 5)
    assert best.count() == 5 and best.filter("feature = 'x0'").count() == 0  # x0 is constant


def test_correlations_equal_sql_where_the_tables_are_not_empty(spark):
    """At 0.001 the training table has no complete row; these two are compared at 0.01 too."""
    from __spark_entry__ import oracle_sql, queries
    from tools.oracle_check import duck, rows
    con = duck("/root/testdata/sf0.01")
    for name in ("training_table", "training_correlations"):
        got, want = queries()[name](spark, "/root/testdata/sf0.01").toArrow(), con.sql(oracle_sql()[name]).fetch_arrow_table()
        assert got.num_rows > 0 and rows(got) == rows(want)


def test_correlation_aggregate_sends_one_row_per_feature(spark):
    from daycast.operators.profile import correlations
    df = spark.range(0, 100_000, 1, 4).select(F.col("id").cast("double").alias("y"), (F.col("id") % 10).cast("double").alias("a.b"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("b"))
    p = plan(correlations(df, "y", ["a.b", "b"]))
    assert p.index("Generate") > p.index("partial_") > p.index("Exchange")  # rows are generated below the partial aggregate
    got = {r.feature: r for r in correlations(df, "y", ["a.b", "b"]).collect()}
    assert got["b"].n == 50_000 and abs(got["b"].corr - 1) < 1e-12 and got["a.b"].n == 100_000
