"""Marts, dashboard panels, windows, sorting, set operations and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltmart.functions import scalar as S
from voltmart.operators import aggregates, dims
from voltmart.operators.keys import close_intervals
from voltmart.plans import dashboard, marts
from voltmart.plans.warehouse import user_dimension
from voltmart.sources import extracts, standins as src
from voltmart.suite.registry import day, mean, moment, num, percent, query

AS_OF = src.ORDERS_AS_OF
COHORT_AS_OF = "1996-06-15"


def calendar(spark):
    return dims.dim_date(spark, src.FIRST_DAY, "2001-12-31")


def event_calendar(spark):
    return dims.dim_date(spark, "2023-12-01", "2024-02-29")


def daily(spark, sf):
    return marts.dm_daily_metrics(
        calendar(spark), src.rental_facts(spark, sf), src.offer_facts(spark, sf), AS_OF
    )


def station_stats(spark, sf):
    return marts.dm_station_stats(src.stations(spark, sf), src.rental_facts(spark, sf), AS_OF)


def tariff_dimension(spark, sf):
    from voltmart.operators.ods import parse_tariff

    return dims.dim_tariff(parse_tariff(src.offers(spark, sf)))


def breakdown(spark, sf):
    return marts.dm_revenue_breakdown(
        src.rental_facts(spark, sf), calendar(spark), tariff_dimension(spark, sf),
        src.stations(spark, sf), AS_OF,
    )


def hourly(spark, sf, keep_empty=False):
    return marts.dm_hourly_demand(
        src.event_facts(spark, sf), event_calendar(spark), dims.dim_time(spark),
        src.EVENTS_AS_OF, keep_empty,
    )


def cohorts(spark, sf):
    return marts.dm_user_cohorts(
        user_dimension(src.users(spark, sf)), src.rental_facts(spark, sf), COHORT_AS_OF
    )


DAILY_SQL = f"""
SELECT {day('date_actual')} AS date_actual, year, month_num, day_of_week, is_weekend,
       total_rentals, completed_rentals, cancelled_rentals, active_users,
       {num('total_revenue')} AS total_revenue, avg_rental_cost, median_rental_cost,
       avg_duration_minutes, CAST(total_duration_minutes AS BIGINT) AS total_duration_minutes,
       total_offers_created, offers_used, offers_expired, offer_to_rental_conversion_rate
FROM daily"""


@query("dm_daily_metrics", DAILY_SQL, "daily")
def _(spark, sf):
    return daily(spark, sf)


STATION_COLUMNS = f"""station_id, station_name, city, total_rentals_30d, unique_users_30d,
       {num('total_revenue_30d')} AS total_revenue_30d, avg_rental_cost, avg_duration_minutes,
       CAST(total_usage_minutes_30d AS BIGINT) AS total_usage_minutes_30d, rentals_last_7d,
       popularity_rank"""


@query("dm_station_stats", f"SELECT {STATION_COLUMNS} FROM station_stats", "station_stats")
def _(spark, sf):
    return station_stats(spark, sf)


@query("dm_station_stats_keep_empty", f"""
SELECT s.station_id, s.station_name, s.city, count(r.rental_id) AS total_rentals_30d,
       count(DISTINCT r.user_id) AS unique_users_30d, {num('sum(final_cost)')} AS total_revenue_30d,
       {mean('final_cost')} AS avg_rental_cost, {mean('minutes')} AS avg_duration_minutes,
       CAST(sum(minutes) AS BIGINT) AS total_usage_minutes_30d,
       count(r.rental_id) FILTER (started_at >= TIMESTAMP '1994-12-29') AS rentals_last_7d,
       rank() OVER (ORDER BY count(r.rental_id) DESC) AS popularity_rank
FROM stations s LEFT JOIN rentals r ON s.station_id = r.station_id
 AND started_at >= TIMESTAMP '1994-12-06' AND started_at < TIMESTAMP '1995-01-06'
GROUP BY 1, 2, 3""", "stations rentals")
def _(spark, sf):
    # In the first days of the data many stations have no rental yet.
    return marts.dm_station_stats(
        src.stations(spark, sf), src.rental_facts(spark, sf), "1995-01-05", keep_empty=True
    )


COHORTS_SQL = f"""
SELECT {day('cohort_month')} AS cohort_month, cohort_size, active_month_0, active_month_1,
       avg_rentals_per_user, avg_revenue_per_user FROM cohorts"""


@query("dm_user_cohorts", COHORTS_SQL, "cohorts")
def _(spark, sf):
    return cohorts(spark, sf)


@query("dm_user_cohorts_versions", COHORTS_SQL, "cohorts")
def _(spark, sf):
    # Every user has a second version; the facts still point at the first one.
    users = src.users(spark, sf)
    first = dims.new_user_versions(users, src.FIRST_DAY)
    versions = dims.scd2_merge(first, users.withColumn("phone", F.lit("+7")), "1998-07-01")
    old = first.select("user_id", F.col("user_dwh_id").alias("_version"))
    rentals = (
        src.rental_facts(spark, sf)
        .withColumnRenamed("user_dwh_id", "user_id")
        .join(old, "user_id")
        .withColumnRenamed("_version", "user_dwh_id")
    )
    return marts.dm_user_cohorts(versions, rentals, COHORT_AS_OF)


@query("dm_hourly_demand", "SELECT * FROM hourly", "hourly")
def _(spark, sf):
    return hourly(spark, sf)


@query("dm_hourly_demand_keep_empty", """
SELECT g.hour, g.hour_of_day, g.is_weekend, coalesce(h.total_rentals, 0) AS total_rentals,
       h.avg_cost, h.avg_duration
FROM (SELECT CAST(x AS INTEGER) AS hour, CASE WHEN x < 6 THEN '00-06' WHEN x < 12 THEN '06-12'
             WHEN x < 18 THEN '12-18' ELSE '18-24' END AS hour_of_day, w AS is_weekend
      FROM range(24) AS t(x) CROSS JOIN (VALUES (true), (false)) AS k(w)) g
LEFT JOIN hourly h ON h.hour = g.hour AND h.is_weekend = g.is_weekend""", "hourly")
def _(spark, sf):
    return hourly(spark, sf, keep_empty=True)


@query("dm_revenue_breakdown", f"""
SELECT {day('date')} AS date, tariff_type, city, rentals_count, {num('revenue')} AS revenue,
       avg_revenue_per_rental, CAST(total_minutes AS BIGINT) AS total_minutes
FROM breakdown""", "breakdown")
def _(spark, sf):
    return breakdown(spark, sf)


@query("user_rental_counts", f"""
SELECT user_id AS user_dwh_id, count(*) AS total_rentals, {num('sum(final_cost)')} AS total_spent
FROM rentals WHERE status = 'FINISHED' GROUP BY 1""", "rentals")
def _(spark, sf):
    return marts.user_rental_counts(src.rental_facts(spark, sf))


@query("distinct_counts", """
SELECT month(started_at) AS month_num, count(DISTINCT user_id) AS users,
       count(DISTINCT user_id) FILTER (status = 'FINISHED') AS paying_users
FROM rentals GROUP BY 1""", "rentals")
def _(spark, sf):
    facts = src.rental_facts(spark, sf).withColumn("month_num", F.month("started_at"))
    return aggregates.distinct_counts(
        facts, ["month_num"], "user_dwh_id", {"paying_users": F.col("is_completed")}, "users"
    )


@query("distinct_if", """
SELECT year(started_at) AS year, count(DISTINCT station_id) FILTER (status = 'FINISHED') AS stations
FROM rentals GROUP BY 1""", "rentals")
def _(spark, sf):
    facts = src.rental_facts(spark, sf)
    return facts.groupBy(F.year("started_at").alias("year")).agg(
        aggregates.distinct_if("station_dwh_id", F.col("is_completed")).alias("stations")
    )


@query("exact_median", """
SELECT CAST(year(started_at) AS INTEGER) AS year,
       round(quantile_cont(CAST(final_cost AS DOUBLE), 0.5), 3) AS median_cost
FROM rentals WHERE final_cost IS NOT NULL GROUP BY 1""", "rentals")
def _(spark, sf):
    facts = src.rental_facts(spark, sf).select(F.year("started_at").alias("year"), "final_cost")
    return aggregates.exact_median(facts, ["year"], "final_cost", "median_cost")


@query("zero_safe_ratio", f"""
SELECT user_id, {percent("done", "settled")} AS completion_rate
FROM (SELECT user_id, count(*) FILTER (status = 'FINISHED') AS done,
             count(*) FILTER (status <> 'ACTIVE') AS settled FROM rentals GROUP BY 1)""", "rentals")
def _(spark, sf):
    facts = src.rental_facts(spark, sf)
    return facts.groupBy(F.col("user_dwh_id").alias("user_id")).agg(
        S.ratio(F.count_if("is_completed"), F.count_if(F.col("status") != "ACTIVE")).alias(
            "completion_rate"
        )
    )


# --- dashboard panels -------------------------------------------------------------------------


@query("revenue_today", f"""
SELECT {day('date_actual')} AS date_actual, {num('total_revenue')} AS today_revenue,
       {num('change')} AS revenue_change,
       round(CAST(100 * change AS DOUBLE) / CAST(total_revenue - change AS DOUBLE), 2)
           AS change_percent
FROM (SELECT date_actual, total_revenue,
             total_revenue - lag(total_revenue) OVER (ORDER BY date_actual) AS change
      FROM daily WHERE date_actual >= DATE '2001-07-31') ORDER BY date_actual DESC LIMIT 1""", "daily")
def _(spark, sf):
    return dashboard.revenue_today(daily(spark, sf), AS_OF)


@query("completed_today", """
SELECT count(DISTINCT rental_id) AS completed_rentals_today,
       count(DISTINCT rental_id) > 100 AS goal_met
FROM rentals WHERE CAST(started_at AS DATE) = DATE '2001-08-01' AND status = 'FINISHED'""", "rentals")
def _(spark, sf):
    return dashboard.completed_today(src.rental_facts(spark, sf), calendar(spark), AS_OF)


@query("conversion_7d", f"""
SELECT {mean('CAST(offer_to_rental_conversion_rate AS DECIMAL(10,2))')} AS avg_conversion_rate,
       CASE WHEN avg(offer_to_rental_conversion_rate) > 70 THEN 'good'
            WHEN avg(offer_to_rental_conversion_rate) >= 50 THEN 'fair'
            WHEN avg(offer_to_rental_conversion_rate) < 50 THEN 'problem' END AS band
FROM daily WHERE date_actual >= DATE '2001-07-25'""", "daily")
def _(spark, sf):
    return dashboard.conversion_7d(daily(spark, sf), AS_OF)


SERIES = f"""
SELECT {day('date_actual')} AS date_actual, {num('total_revenue')} AS total_revenue,
       completed_rentals, avg_rental_cost
FROM daily WHERE date_actual >= DATE '2001-07-02'"""


@query("revenue_series", SERIES, "daily")
def _(spark, sf):
    return dashboard.revenue_series(daily(spark, sf), AS_OF)


@query("revenue_series_weekend", SERIES + " AND is_weekend", "daily")
def _(spark, sf):
    return dashboard.revenue_series(daily(spark, sf), AS_OF, kind="weekend")


@query("top_stations", f"""
SELECT station_id, station_name, city, {num('total_revenue_30d')} AS total_revenue_30d,
       total_rentals_30d, avg_rental_cost, popularity_rank
FROM station_stats ORDER BY station_stats.total_revenue_30d DESC NULLS FIRST, station_id LIMIT 5""",
    "station_stats")
def _(spark, sf):
    return dashboard.top_stations(station_stats(spark, sf))


@query("station_detail", f"""
SELECT {STATION_COLUMNS} FROM station_stats WHERE station_id IN (
  SELECT station_id FROM station_stats ORDER BY total_revenue_30d DESC NULLS FIRST, station_id LIMIT 1)""",
    "station_stats")
def _(spark, sf):
    stats = station_stats(spark, sf)
    return dashboard.station_detail(stats, dashboard.top_stations(stats, 1))


@query("demand_heatmap", "SELECT hour, is_weekend, total_rentals, avg_duration FROM hourly", "hourly")
def _(spark, sf):
    return dashboard.demand_heatmap(hourly(spark, sf))


@query("demand_matrix", """
SELECT hour, CAST(sum(total_rentals) FILTER (NOT is_weekend) AS BIGINT) AS weekday,
       CAST(sum(total_rentals) FILTER (is_weekend) AS BIGINT) AS weekend
FROM hourly GROUP BY 1""", "hourly")
def _(spark, sf):
    return dashboard.demand_matrix(hourly(spark, sf))


@query("cohort_retention", f"""
SELECT {day('cohort_month')} AS cohort_month, cohort_size,
       {percent("active_month_1", "active_month_0")} AS retention_rate,
       avg_revenue_per_user FROM cohorts""", "cohorts")
def _(spark, sf):
    return dashboard.cohort_retention(cohorts(spark, sf))


@query("revenue_by_city_tariff", f"""
SELECT city, tariff_type, {num('sum(revenue)')} AS total_revenue,
       CAST(sum(rentals_count) AS BIGINT) AS total_rentals
FROM breakdown WHERE date >= DATE '2001-07-25' GROUP BY 1, 2""", "breakdown")
def _(spark, sf):
    return dashboard.revenue_by_city_tariff(breakdown(spark, sf), AS_OF)


TRAIL = """ORDER BY date_actual ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING"""


@query("revenue_alert", f"""
SELECT {day('date_actual')} AS date_actual, {num('total_revenue')} AS total_revenue,
       trailing_mean, coalesce(total_revenue < 0.8 * trailing_mean, false) AS alert
FROM (SELECT date_actual, total_revenue,
             round(CAST(sum(total_revenue) OVER ({TRAIL}) AS DOUBLE)
                   / count(total_revenue) OVER ({TRAIL}), 4) AS trailing_mean FROM daily)""", "daily")
def _(spark, sf):
    return dashboard.revenue_alert(daily(spark, sf))


@query("trailing_avg", f"""
SELECT {day('date_actual')} AS date_actual, completed_rentals,
       round(avg(completed_rentals) OVER ({TRAIL}), 4) AS trailing_mean FROM daily""", "daily")
def _(spark, sf):
    return dashboard.rental_sparkline(daily(spark, sf))


# --- windows, sorting, sets -------------------------------------------------------------------


@query("popularity_rank", """
SELECT user_id, count(*) AS rentals, rank() OVER (ORDER BY count(*) DESC) AS popularity_rank
FROM rentals GROUP BY 1""", "rentals")
def _(spark, sf):
    counts = src.rentals(spark, sf).groupBy("user_id").agg(F.count(F.lit(1)).alias("rentals"))
    return marts.popularity_rank(counts, "rentals")


@query("day_change", f"""
SELECT {day('date_actual')} AS date_actual, total_rentals,
       total_rentals - lag(total_rentals) OVER (ORDER BY date_actual) AS rentals_change FROM daily""",
    "daily")
def _(spark, sf):
    counts = daily(spark, sf).select("date_actual", "total_rentals")
    return dashboard.day_change(counts, "total_rentals", "rentals_change")


@query("latest_per_key", f"""
SELECT user_id, offer_id, {moment('created_at')} AS created_at FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY created_at DESC, offer_id DESC) AS place
  FROM offers) WHERE place = 1""", "offers")
def _(spark, sf):
    from voltmart.operators.keys import latest_per_key

    offers = src.offers(spark, sf).select("user_id", "offer_id", "created_at")
    return latest_per_key(offers, ["user_id"], ["created_at", "offer_id"])


@query("close_intervals", f"""
SELECT tariff_version, {num('rate')} AS rate, {moment('valid_from')} AS valid_from,
       {moment('valid_to')} AS valid_to FROM tariff_dim""", "tariff_dim")
def _(spark, sf):
    from voltmart.operators.ods import parse_tariff

    pairs = parse_tariff(src.offers(spark, sf)).groupBy(
        "tariff_version", F.col("tariff_rate_per_minute").alias("rate")
    ).agg(F.min("created_at").alias("valid_from"))
    return close_intervals(pairs, ["tariff_version"], ["rate"])


@query("order_by", f"""
SELECT rental_id, {num('final_cost')} AS final_cost, {moment('started_at')} AS started_at
FROM rentals ORDER BY rentals.final_cost DESC NULLS FIRST, rentals.started_at ASC NULLS LAST, rental_id""",
    "rentals")
def _(spark, sf):
    return src.rentals(spark, sf).select("rental_id", "final_cost", "started_at").orderBy(
        F.desc_nulls_first("final_cost"), F.asc_nulls_last("started_at"), "rental_id"
    )


@query("latest_day", DAILY_SQL + " ORDER BY daily.date_actual DESC LIMIT 1", "daily")
def _(spark, sf):
    return dashboard.latest_day(daily(spark, sf))


@query("select_distinct", """
SELECT DISTINCT user_id, station_id FROM rentals""", "rentals")
def _(spark, sf):
    return src.rentals(spark, sf).select("user_id", "station_id").distinct()


@query("union_shards", """
SELECT CAST(o_orderkey AS VARCHAR) AS offer_id, CAST(o_custkey % 2 AS INTEGER) AS shard_id
FROM orders""")
def _(spark, sf):
    offers = src.offers(spark, sf).select("offer_id", "user_id")
    even = F.col("user_id").cast("bigint") % 2
    shards = {n: offers.filter(even == n).select("offer_id") for n in (0, 1)}
    return extracts.union_shards(shards)


# --- join kinds -------------------------------------------------------------------------------


@query("join_inner", """
SELECT r.rental_id, s.city FROM rentals r JOIN stations s USING (station_id)""", "rentals stations")
def _(spark, sf):
    stations = src.stations(spark, sf).select("station_id", "city")
    return src.rentals(spark, sf).join(stations, "station_id").select("rental_id", "city")


@query("join_left_outer", """
SELECT o.offer_id, r.rental_id FROM offers o LEFT JOIN rentals r USING (offer_id)""", "offers rentals")
def _(spark, sf):
    rentals = src.rentals(spark, sf).select("offer_id", "rental_id")
    return src.offers(spark, sf).select("offer_id").join(rentals, "offer_id", "left")


@query("join_anti", """
SELECT offer_id, status FROM offers o
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o.o_orderkey)""", "offers")
def _(spark, sf):
    used = src.raw_rentals(spark, sf).select("offer_id")
    return src.offers(spark, sf).select("offer_id", "status").join(used, "offer_id", "left_anti")


@query("join_semi", """
SELECT user_id FROM users u WHERE EXISTS (
  SELECT 1 FROM offers o WHERE o.user_id = u.user_id AND o.status = 'USED'
    AND o.created_at > u.created_at)""", "users offers")
def _(spark, sf):
    offers = src.offers(spark, sf).filter("status = 'USED'").alias("o")
    users = src.users(spark, sf).alias("u")
    again = (F.col("o.user_id") == F.col("u.user_id")) & (
        F.col("o.created_at") > F.col("u.created_at")
    )
    return users.join(offers, again, "left_semi").select("user_id")


# --- scalar functions -------------------------------------------------------------------------


@query("date_keys", """
SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_id,
       CAST(strftime(ts, '%H%M%S') AS INTEGER) AS time_id FROM events""")
def _(spark, sf):
    return src.table(spark, sf, "events").select(
        "event_id", S.date_id("ts").alias("date_id"), S.time_id("ts").alias("time_id")
    )


@query("truncate_dates", f"""
SELECT event_id, {moment("date_trunc('month', ts)")} AS month_start,
       {moment("date_trunc('day', ts)")} AS day_start FROM events""")
def _(spark, sf):
    return src.table(spark, sf, "events").select(
        "event_id", F.date_trunc("month", "ts").alias("month_start"),
        F.date_trunc("day", "ts").alias("day_start"),
    )


@query("in_last", f"""
SELECT rental_id, {moment('started_at')} AS started_at FROM rentals
WHERE CAST(started_at AS DATE) BETWEEN DATE '2001-07-25' AND DATE '2001-08-01'""", "rentals")
def _(spark, sf):
    rentals = src.rentals(spark, sf).withColumn("day", F.to_date("started_at"))
    return rentals.filter(S.in_last("day", 7, AS_OF)).select("rental_id", "started_at")


@query("months_before", f"""
SELECT rental_id, {moment('started_at')} AS started_at,
       {day("date_trunc('month', started_at) - INTERVAL 3 MONTH")} AS three_months_earlier
FROM rentals WHERE started_at >= TIMESTAMP '2000-08-01'""", "rentals")
def _(spark, sf):
    recent = F.to_date("started_at") >= S.months_before(AS_OF, 12)
    earlier = F.add_months(F.trunc("started_at", "month"), -3)
    return src.rentals(spark, sf).filter(recent).select(
        "rental_id", "started_at", earlier.alias("three_months_earlier")
    )


@query("conditional_values", f"""
SELECT rental_id, CASE WHEN status = 'FINISHED' THEN 'paid' WHEN status = 'CANCELLED' THEN 'void'
       ELSE 'open' END AS state, {num('coalesce(final_cost, 0)')} AS cost,
       CAST((2 * CAST(final_cost * 100 AS HUGEINT) + minutes) // (2 * minutes) AS DOUBLE) / 100
           AS cost_per_minute FROM rentals""", "rentals")
def _(spark, sf):
    status = F.col("status")
    per_minute = F.col("final_cost") / F.nullif(F.col("duration_minutes"), F.lit(0))
    return src.rentals(spark, sf).select(
        "rental_id",
        F.when(status == "FINISHED", "paid").when(status == "CANCELLED", "void").otherwise("open")
        .alias("state"),
        F.coalesce("final_cost", F.lit(0)).alias("cost"),
        F.round(per_minute, 2).alias("cost_per_minute"),
    )


@query("calendar_cols", """
SELECT e.event_id, c.date_id, c.day_of_week, c.day_name, c.day_of_month, c.week_of_year,
       c.month_num, c.month_name, c.quarter, c.year, c.is_weekend
FROM events e JOIN calendar c ON c.date_actual = CAST(e.ts AS DATE)""", "calendar")
def _(spark, sf):
    parts = S.calendar_cols(F.to_date("ts"))
    return src.table(spark, sf, "events").select(
        "event_id", *[part.alias(name) for name, part in parts.items()]
    )


@query("json_field", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def _(spark, sf):
    return src.table(spark, sf, "events").select(
        "event_id", S.json_field("props", "$.k").alias("k")
    )


@query("lower_concat", """
SELECT l_orderkey || ':' || lower(l_returnflag) AS key_text, count(*) AS n FROM lineitem GROUP BY 1""")
def _(spark, sf):
    text = F.concat(F.col("l_orderkey").cast("string"), F.lit(":"), F.lower("l_returnflag"))
    return src.table(spark, sf, "lineitem").groupBy(text.alias("key_text")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("to_money", f"""
SELECT event_id, {num('CAST(value AS DECIMAL(10,4)) * 3')} AS cost FROM events""")
def _(spark, sf):
    return src.table(spark, sf, "events").select(
        "event_id", (S.to_money("value") * 3).alias("cost")
    )


@query("minutes_between", """
SELECT event_id, CAST(ceil(epoch_us(ts - TIMESTAMP '2024-01-01') / 60000000.0) AS INTEGER) AS minutes
FROM events""")
def _(spark, sf):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return src.table(spark, sf, "events").select(
        "event_id", S.minutes_between(start, F.col("ts")).alias("minutes")
    )


@query("norm_email", """
SELECT CAST(c_custkey AS VARCHAR) AS user_id, lower(trim(' ' || c_name || '@Example.COM ')) AS email
FROM customer""")
def _(spark, sf):
    written = F.concat(F.lit(" "), "c_name", F.lit("@Example.COM "))
    return src.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("user_id"), S.norm_email(written).alias("email")
    )
