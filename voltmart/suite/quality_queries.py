"""Data-quality checks over tables that break some of the rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltmart import schemas
from voltmart.operators import digests, quality
from voltmart.plans import dashboard, marts
from voltmart.session import cut_lineage
from voltmart.sources import standins as src
from voltmart.suite.mart_queries import calendar, daily
from voltmart.suite.registry import day, query


def shape(check: str, table: str, key: str, observed: str, expected: str, passed: str = "false") -> str:
    return (
        f"SELECT '{check}' AS check_name, '{table}' AS table_name, CAST({key} AS VARCHAR) AS key, "
        f"CAST({observed} AS VARCHAR) AS observed, CAST({expected} AS VARCHAR) AS expected, "
        f"{passed} AS passed"
    )


@query("check_complete", shape("complete", "rentals", "rental_id", "'missing'", "'present'") + """
FROM (SELECT DISTINCT rental_id FROM lines l WHERE NOT EXISTS (
        SELECT 1 FROM lines r WHERE r.rental_id = l.rental_id
        AND r.started_at <= TIMESTAMP '2001-07-01'))""", "lines")
def _(spark, sf):
    source = src.raw_rentals(spark, sf)
    loaded = source.filter(F.col("loaded_at") <= F.lit("2001-07-01").cast("timestamp"))
    return quality.check_complete(source, loaded, ["rental_id"], "rentals")


@query("check_timely", shape("timely", "events", "event_id", "event_id % 30 * 60", "900") + """
FROM events WHERE event_id % 30 > 15""")
def _(spark, sf):
    # Each event waits between 0 and 29 minutes for its load.
    wait = (F.col("event_id") % 30) * 60_000_000
    raw = src.rental_events(spark, sf).withColumn(
        "loaded_at", F.timestamp_micros(F.unix_micros("ts") + wait)
    )
    return quality.check_timely(raw, "ts", ["event_id"], "events")


@query("check_schema", """
SELECT 'schema' AS check_name, 'offers' AS table_name, f.name AS key, f.kind AS observed,
       f.declared AS expected, f.kind = f.declared AS passed, (SELECT count(*) FROM orders) AS row_count
FROM (VALUES ('offer_id', 'string', 'string'), ('user_id', 'string', 'string'),
             ('station_id', 'string', 'string'), ('tariff_snapshot', 'string', 'string'),
             ('created_at', 'timestamp', 'timestamp'), ('expires_at', 'bigint', 'timestamp'),
             ('status', 'string', 'string'), ('tariff_version', 'absent', 'string'))
     AS f(name, kind, declared)""")
def _(spark, sf):
    # An extract that lost one column and changed the type of another.
    offers = src.offers(spark, sf).drop("tariff_version").withColumn(
        "expires_at", F.unix_seconds("expires_at")
    )
    rows = offers.agg(F.count("offer_id").alias("row_count"))
    checked = quality.check_schema(offers, schemas.OFFERS, "offers")
    return checked.crossJoin(F.broadcast(rows))


@query("check_fk", shape("fk_station_dwh_id", "fact_rentals", "md5(r.station_id)", "count(*)", "0") + """
FROM rentals r WHERE NOT EXISTS (
  SELECT 1 FROM stations s WHERE s.station_id = r.station_id AND s.region <> 'ASIA')
GROUP BY r.station_id""", "rentals stations")
def _(spark, sf):
    stations = src.stations(spark, sf).filter("region <> 'ASIA'")
    return quality.check_fk(
        src.rental_facts(spark, sf), stations, "station_dwh_id", "fact_rentals"
    )


@query("check_rules", shape("rules", "fact_rentals", "rule", "n", "0", "n = 0") + """
FROM (SELECT 'duration_not_negative' AS rule, count(*) FILTER (minutes - 2 < 0) AS n FROM rentals
      UNION ALL SELECT 'cost_not_negative', count(*) FILTER (final_cost < 10000) FROM rentals
      UNION ALL SELECT 'finished_after_started', 0)""", "rentals")
def _(spark, sf):
    # A careless correction: two minutes and a fixed rebate taken off every rental.
    facts = src.rental_facts(spark, sf).withColumn(
        "duration_minutes", F.col("duration_minutes") - 2
    ).withColumn("final_cost", F.col("final_cost") - 10_000)
    return quality.check_rules(facts)


@query("check_unique", shape("unique", "rentals", "rental_id", "count(*)", "1") + """
FROM lines GROUP BY rental_id HAVING count(*) > 1""", "lines")
def _(spark, sf):
    return quality.check_unique(src.raw_rentals(spark, sf), ["rental_id"], "rentals")


PERIOD = "started_at >= TIMESTAMP '2001-05-03' AND started_at < TIMESTAMP '2001-08-02'"


@query("check_totals", shape("totals", "dm_daily_metrics", "measure", "total", "total", "true") + f"""
FROM (SELECT 'total_revenue' AS measure, CAST(sum(final_cost) AS DECIMAL(38,2)) AS total
      FROM rentals WHERE {PERIOD}
      UNION ALL SELECT 'total_rentals', CAST(count(*) AS DECIMAL(38,2)) FROM rentals WHERE {PERIOD}
      UNION ALL SELECT 'total_duration_minutes', CAST(sum(minutes) AS DECIMAL(38,2))
      FROM rentals WHERE {PERIOD})""", "rentals")
def _(spark, sf):
    facts = src.rental_facts(spark, sf).filter("start_date_id between 20010503 and 20010801")
    measures = {
        "total_revenue": F.sum("final_cost"),
        "total_rentals": F.count("rental_id"),
        "total_duration_minutes": F.sum("duration_minutes"),
    }
    return quality.check_totals(daily(spark, sf), facts, measures, "dm_daily_metrics")


@query("check_dates", shape("dates", "rentals_by_day", day("date_actual"), "'missing'", "'present'") + """
FROM calendar WHERE date_actual BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'
AND date_actual NOT IN (SELECT CAST(started_at AS DATE) FROM rentals)""", "calendar rentals")
def _(spark, sf):
    days = src.rentals(spark, sf).select(F.to_date("started_at").alias("date_actual")).distinct()
    whole = marts.spine(calendar(spark), 2_556, "2001-12-31")
    return quality.check_dates(days, whole, "rentals_by_day")


@query("check_growth", """
SELECT 'growth' AS check_name, table_name, """ + day("d") + """ AS key,
       CAST(n AS VARCHAR) AS observed, CAST(before AS VARCHAR) AS expected, false AS passed
FROM (SELECT *, lag(size) OVER (PARTITION BY table_name ORDER BY d) AS before
      FROM (SELECT *, sum(n) OVER (PARTITION BY table_name ORDER BY d) AS size
            FROM (SELECT 'offers' AS table_name, CAST(o_orderdate AS DATE) AS d, count(*) AS n
                  FROM orders GROUP BY 2
                  UNION ALL SELECT 'rentals', CAST(l_shipdate AS DATE), count(*) FROM lineitem GROUP BY 2)))
WHERE n * 100 > before * 50""")
def _(spark, sf):
    tables = {
        "offers": src.raw_offers(spark, sf).select(F.to_date("loaded_at").alias("load_date")),
        "rentals": src.table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("load_date")),
    }
    return quality.check_growth(quality.row_counts(tables))


@query("row_counts", f"""
SELECT 'events' AS table_name, {day('ts')} AS load_date, count(*) AS row_count FROM events GROUP BY 2
UNION ALL SELECT 'offers', {day('o_orderdate')}, count(*) FROM orders GROUP BY 2
UNION ALL SELECT 'rentals', {day('l_shipdate')}, count(*) FROM lineitem GROUP BY 2
UNION ALL SELECT 'users', {day('created_at')}, count(*) FROM users GROUP BY 2
UNION ALL SELECT 'cost_snapshots', {day('ts')}, count(*) FROM snapshots GROUP BY 2
UNION ALL SELECT 'offer_audit', {day('ts')}, count(*) FROM audit GROUP BY 2
UNION ALL SELECT 'stations', NULL, count(*) FROM stations""", "users snapshots audit stations")
def _(spark, sf):
    days = lambda df, column: df.select(F.to_date(column).alias("load_date"))
    table = lambda name: src.table(spark, sf, name)
    return quality.row_counts({
        "events": days(table("events"), "ts"),
        "offers": days(table("orders"), "o_orderdate"),
        "rentals": days(table("lineitem"), "l_shipdate"),
        "users": days(src.users(spark, sf), "created_at"),
        "cost_snapshots": days(src.cost_snapshots(spark, sf), "ts"),
        "offer_audit": days(src.offer_audit(spark, sf), "ts"),
        # The directory of stations has no load date.
        "stations": src.stations(spark, sf).select(F.lit(None).cast("date").alias("load_date")),
    })


@query("check_fresh", shape(
    "fresh", "events", "'loaded_at'", "epoch_us(TIMESTAMP '2024-01-31') // 1000000 - epoch_us(max(ts)) // 1000000",
    "3600", "epoch_us(TIMESTAMP '2024-01-31') // 1000000 - epoch_us(max(ts)) // 1000000 <= 3600") + " FROM events")
def _(spark, sf):
    raw = src.rental_events(spark, sf).withColumnRenamed("ts", "loaded_at")
    return quality.check_fresh(raw, "2024-01-31", "events")


@query("check_revenue_drop", shape(
    "revenue_drop", "dm_daily_metrics", day("date_actual"), "CAST(total_revenue AS DECIMAL(38,2))",
    "CAST(usual AS DECIMAL(18,4))") + """
FROM (SELECT date_actual, total_revenue, round(CAST(sum(total_revenue) OVER w AS DOUBLE)
             / count(total_revenue) OVER w, 4) AS usual FROM daily
      WINDOW w AS (ORDER BY date_actual ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
WHERE total_revenue < 0.8 * usual""", "daily")
def _(spark, sf):
    return quality.check_revenue_drop(dashboard.revenue_alert(daily(spark, sf)))


@query("check_copy", """
SELECT 'copy' AS check_name, 'fact_rentals' AS table_name, key, problem AS observed, 'same' AS expected, false AS passed
FROM (SELECT CASE WHEN month = '199905' THEN 'new-' || rental_id ELSE rental_id END AS key,
             CASE WHEN month = '199603' AND l_orderkey % 5 = 0 THEN 'lost'
                  WHEN month = '199704' AND l_orderkey % 7 = 0 THEN 'changed'
                  WHEN month = '199805' AND l_orderkey % 9 = 0 THEN 'doubled'
                  WHEN month = '199905' AND l_orderkey % 11 = 0 THEN 'added' END AS problem
      FROM (SELECT *, strftime(started_at, '%Y%m') AS month FROM rentals))
WHERE problem IS NOT NULL""", "rentals")
def _(spark, sf):
    # A copy that lost rows in one month, has other values in another, doubles and strangers in two more.
    # Every level reads both sides; without the cut each reading derives the facts anew.
    facts = cut_lineage(src.rental_facts(spark, sf), "facts")
    number = F.split("rental_id", "-")[0].cast("long")
    hit = lambda month, n: (F.col("month_id") == month) & (number % n == 0)
    copy = facts.filter(~hit(199603, 5)).withColumn(
        "duration_minutes",
        F.when(hit(199704, 7), F.coalesce("duration_minutes", F.lit(0)) + 1).otherwise(F.col("duration_minutes")),
    )
    strangers = facts.filter(hit(199905, 11)).withColumn("rental_id", F.concat(F.lit("new-"), "rental_id"))
    copy = copy.unionByName(copy.filter(hit(199805, 9))).unionByName(strangers)
    return digests.check_copy(facts, copy, ["rental_id"], ["month_id", "start_date_id"], "fact_rentals")
