"""Calendar features and a rule-generated US federal holiday dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.functions.time import day_of_week0
from daycast.operators.joins import flag_in_dim

# ---------------------------------------------------------------------------
# US federal holidays.
# Fixed-date holidays: (name, month, day, first year observed or None).
# A fixed date on a Saturday is also observed on the Friday before, on a Sunday on
# the Monday after; both the date and the observed date count as holidays.
FIXED_DATE_HOLIDAYS = [
    ("New Year's Day", 1, 1, None),
    ("Juneteenth National Independence Day", 6, 19, 2021),
    ("Independence Day", 7, 4, None),
    ("Veterans Day", 11, 11, None),
    ("Christmas Day", 12, 25, None),
]
# Weekday-rule holidays: (name, month, weekday, n); n = -1 means the last one.
NTH_WEEKDAY_HOLIDAYS = [
    ("Martin Luther King Jr. Day", 1, "Mon", 3),
    ("Washington's Birthday", 2, "Mon", 3),
    ("Memorial Day", 5, "Mon", -1),
    ("Labor Day", 9, "Mon", 1),
    ("Columbus Day", 10, "Mon", 2),
    ("Thanksgiving", 11, "Thu", 4),
]
# ---------------------------------------------------------------------------


def calendar_features(df: DataFrame, ts: str) -> DataFrame:
    """month, day_of_week (Sunday = 0), hour_of_day and is_weekend (0/1), all INT."""
    c = F.col(ts)
    dow = F.dayofweek(c)
    return df.select(
        "*",
        F.month(c).cast("int").alias("month"),
        day_of_week0(c).alias("day_of_week"),
        F.hour(c).cast("int").alias("hour_of_day"),
        F.when(dow.isin(1, 7), 1).otherwise(0).cast("int").alias("is_weekend"),
    )


def _nth_weekday(year, month: int, weekday: str, n: int):
    first = F.make_date(year, F.lit(month), F.lit(1))
    if n < 0:
        return F.next_day(F.date_sub(F.last_day(first), 7), weekday)
    return F.date_add(F.next_day(F.date_sub(first, 1), weekday), 7 * (n - 1))


def holiday_dim(years: DataFrame, year_col: str = "year") -> DataFrame:
    """(holiday_date DATE, holiday_name STRING) for every year in ``years``, including
    observed days that fall inside those years (a Saturday New Year's Day of the next
    year is observed on 31 December). The result has at most ~16 rows per year."""
    y = F.col(year_col).cast("int")
    gen = years.select(y.alias("__y"), F.explode(F.sequence(y, y + 1)).alias("__hy"))
    hy = F.col("__hy")
    items = []
    for name, month, day, since in FIXED_DATE_HOLIDAYS:
        d = F.make_date(hy, F.lit(month), F.lit(day))
        ok = F.lit(True) if since is None else hy >= since
        dow = F.dayofweek(d)
        observed = F.when(dow == 7, F.date_sub(d, 1)).when(dow == 1, F.date_add(d, 1))
        items.append(F.when(ok, F.struct(d.alias("d"), F.lit(name).alias("n"))))
        items.append(F.when(ok & observed.isNotNull(),
                            F.struct(observed.alias("d"), F.lit(f"{name} (observed)").alias("n"))))
    for name, month, weekday, n in NTH_WEEKDAY_HOLIDAYS:
        items.append(F.struct(_nth_weekday(hy, month, weekday, n).alias("d"), F.lit(name).alias("n")))
    rows = gen.select("__y", F.explode(F.array(*items)).alias("__h")).filter(F.col("__h").isNotNull())
    return rows.filter(F.year(F.col("__h.d")) == F.col("__y")).select(
        F.col("__h.d").alias("holiday_date"), F.col("__h.n").alias("holiday_name"))


def holiday_dim_range(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    return holiday_dim(spark.range(first_year, last_year + 1).withColumnRenamed("id", "year"))


def holiday_flag(df: DataFrame, ts: str, dim: DataFrame, flag: str = "is_holiday") -> DataFrame:
    """0/1 flag for rows whose local date is a holiday (broadcast of the bounded dim)."""
    return flag_in_dim(df, F.to_date(F.col(ts)), dim, "holiday_date", flag)


def holidays_for(df: DataFrame, ts: str) -> DataFrame:
    """Holiday dimension for exactly the years present in ``df`` (distinct years only)."""
    return holiday_dim(df.select(F.year(F.col(ts)).alias("year")).distinct())


def holiday_expr(date_sql: str) -> "F.Column":
    """The same holiday rules as a per-row 0/1 INT predicate over a DATE, given as SQL
    text (a column name or an expression such as ``to_date(ts)``). No dimension and no
    join, so it stays inside whole-stage codegen; built as one SQL expression. Agrees
    with ``holiday_dim`` (tested over 2019-2030)."""
    if not isinstance(date_sql, str):
        raise TypeError("holiday_expr takes SQL text for a DATE, e.g. 'd' or 'to_date(ts)'")
    d = f"({date_sql})"
    wd = {"Sun": 1, "Mon": 2, "Tue": 3, "Wed": 4, "Thu": 5, "Fri": 6, "Sat": 7}
    terms = []
    for _, month, day, since in FIXED_DATE_HOLIDAYS:
        # the date itself; the Friday before a Saturday date; the Monday after a Sunday date
        for shift, dow in [(0, None), (1, 6), (-1, 2)]:
            t = d if shift == 0 else f"date_add({d}, {shift})"
            cond = [f"month({t}) = {month}", f"dayofmonth({t}) = {day}"]
            if dow is not None:
                cond.append(f"dayofweek({d}) = {dow}")
            if since is not None:
                cond.append(f"year({t}) >= {since}")
            terms.append("(" + " AND ".join(cond) + ")")
    for _, month, weekday, n in NTH_WEEKDAY_HOLIDAYS:
        base = f"month({d}) = {month} AND dayofweek({d}) = {wd[weekday]}"
        if n < 0:
            terms.append(f"({base} AND month(date_add({d}, 7)) != {month})")
        else:
            terms.append(f"({base} AND dayofmonth({d}) BETWEEN {7 * (n - 1) + 1} AND {7 * n})")
    return F.expr("CAST(CASE WHEN " + " OR ".join(terms) + " THEN 1 ELSE 0 END AS INT)")
