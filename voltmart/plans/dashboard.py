"""Dashboard panels over the marts. A mart of days holds at most one row per calendar day, so the
unpartitioned windows below run over tens of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from voltmart.functions.scalar import as_day, date_id, day_type, days_before, exact_mean, in_last, mean_of, ratio

GOOD_CONVERSION, FAIR_CONVERSION = 70, 50
DAILY_RENTAL_GOAL = 100
REVENUE_ALERT_SHARE = "0.80"


def day_change(df: DataFrame, column: str, out: str) -> DataFrame:
    """Difference to the previous day present."""
    previous = F.lag(column).over(Window.orderBy("date_actual"))
    return df.withColumn(out, F.col(column) - previous)


def latest_day(df: DataFrame, column: str = "date_actual") -> DataFrame:
    return df.orderBy(F.desc(column)).limit(1)


def trailing_avg(df: DataFrame, column: str, days: int, out: str) -> DataFrame:
    """Mean of the `days` rows before this one on a gap-free day series."""
    before = Window.orderBy("date_actual").rowsBetween(-days, -1)
    return df.withColumn(
        out, mean_of(F.sum(column).over(before), F.count(column).over(before))
    )


def revenue_today(daily: DataFrame, as_of: str) -> DataFrame:
    """Revenue of the newest day, change and percent change against the day before."""
    totals = (
        daily.filter(in_last("date_actual", 1, as_of))
        .groupBy("date_actual")
        .agg(F.sum("total_revenue").alias("today_revenue"))
    )
    changed = day_change(totals, "today_revenue", "revenue_change")
    before = F.col("today_revenue") - F.col("revenue_change")
    return latest_day(
        changed.withColumn("change_percent", ratio(F.col("revenue_change"), before))
    )


def completed_today(rentals: DataFrame, dim_date: DataFrame, as_of: str) -> DataFrame:
    """Completed rentals that started on as_of, against the daily goal.

    The day's key is a literal, so the fact scan reads that day (and its month partition) only.
    """
    day = date_id(as_day(as_of))
    rows = rentals.filter((F.col("start_date_id") == day) & F.col("is_completed"))
    days = dim_date.filter(F.col("date_actual") == as_day(as_of)).select("date_id")
    return (
        rows.join(F.broadcast(days), rows["start_date_id"] == days["date_id"])
        .agg(F.count("rental_id").alias("completed_rentals_today"))
        .withColumn("goal_met", F.col("completed_rentals_today") > DAILY_RENTAL_GOAL)
    )


def conversion_7d(daily: DataFrame, as_of: str) -> DataFrame:
    return (
        daily.filter(in_last("date_actual", 7, as_of))
        .agg(exact_mean("offer_to_rental_conversion_rate").alias("avg_conversion_rate"))
        .withColumn(
            "band",
            F.when(F.col("avg_conversion_rate") > GOOD_CONVERSION, "good")
            .when(F.col("avg_conversion_rate") >= FAIR_CONVERSION, "fair")
            .when(F.col("avg_conversion_rate").isNotNull(), "problem"),
        )
    )


def revenue_series(
    daily: DataFrame, as_of: str, days: int = 30, kind: str | None = None
) -> DataFrame:
    return (
        daily.filter(in_last("date_actual", days, as_of) & day_type("is_weekend", kind))
        .select("date_actual", "total_revenue", "completed_rentals", "avg_rental_cost")
        .orderBy("date_actual")
    )


def top_stations(stats: DataFrame, k: int = 5) -> DataFrame:
    """The k best stations by revenue; stations without revenue come first, as in PostgreSQL."""
    return (
        stats.select(
            "station_id", "station_name", "city", "total_revenue_30d", "total_rentals_30d",
            "avg_rental_cost", "popularity_rank",
        )
        .orderBy(F.desc_nulls_first("total_revenue_30d"), "station_id")
        .limit(k)
    )


def station_detail(stats: DataFrame, chosen: DataFrame) -> DataFrame:
    """All figures of the stations picked in another panel."""
    return stats.join(chosen.select("station_id"), "station_id", "left_semi")


def demand_heatmap(hourly: DataFrame) -> DataFrame:
    return hourly.select("hour", "is_weekend", "total_rentals", "avg_duration").orderBy(
        "is_weekend", "hour"
    )


def demand_matrix(hourly: DataFrame) -> DataFrame:
    """The heat map as one row per hour with a column for each kind of day."""
    return (
        hourly.withColumn("kind", F.when(F.col("is_weekend"), "weekend").otherwise("weekday"))
        .groupBy("hour")
        .pivot("kind", ["weekday", "weekend"])
        .agg(F.sum("total_rentals"))
        .orderBy("hour")
    )


def cohort_retention(cohorts: DataFrame) -> DataFrame:
    return cohorts.select(
        "cohort_month",
        "cohort_size",
        ratio(F.col("active_month_1"), F.col("active_month_0")).alias("retention_rate"),
        "avg_revenue_per_user",
    ).orderBy(F.desc("cohort_month"))


def revenue_by_city_tariff(breakdown: DataFrame, as_of: str) -> DataFrame:
    return (
        breakdown.filter((F.col("date") >= days_before(as_of, 7)) & (F.col("date") <= as_day(as_of)))
        .groupBy("city", "tariff_type")
        .agg(
            F.sum("revenue").alias("total_revenue"),
            F.sum("rentals_count").alias("total_rentals"),
        )
        .orderBy(F.desc_nulls_first("total_revenue"), "city", "tariff_type")
    )


def revenue_alert(daily: DataFrame) -> DataFrame:
    """Each day's revenue against 80 % of the mean of the seven days before."""
    series = trailing_avg(
        daily.select("date_actual", "total_revenue"), "total_revenue", 7, "trailing_mean"
    )
    floor = F.col("trailing_mean") * F.lit(REVENUE_ALERT_SHARE).cast("decimal(4,2)")
    return series.withColumn("alert", F.coalesce(F.col("total_revenue") < floor, F.lit(False)))


def rental_sparkline(daily: DataFrame) -> DataFrame:
    """Completed rentals with their trailing seven-day mean."""
    return trailing_avg(
        daily.select("date_actual", "completed_rentals"), "completed_rentals", 7, "trailing_mean"
    )
