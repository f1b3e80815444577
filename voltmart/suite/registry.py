"""Registration of queries and the SQL views their checks share."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from voltmart.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Plain types for comparing engines: decimals as doubles, dates and times as text."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None, views: str = ""):
    """Register a query; `views` names the shared views its SQL uses."""

    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(tune(spark), sf_dir))

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(views.split(), sql)
        return build

    return register


def once_per_session(build):
    """Several queries look at one load; a session runs it once for each folder of tables."""
    done: dict[tuple, object] = {}

    @wraps(build)
    def run(spark: SparkSession, *arguments):
        key = (spark.sparkContext.applicationId, *arguments)
        if key not in done:
            done[key] = build(spark, *arguments)
        return done[key]

    return run


def num(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def day(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d')"


def moment(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"


def mean(expression: str) -> str:
    """Mean of non-negative exact numbers, rounded half up at four digits in whole numbers."""
    total, count = f"CAST(sum({expression}) * 10000 AS HUGEINT)", f"count({expression})"
    return f"CAST((2 * {total} + {count}) // (2 * {count}) AS DOUBLE) / 10000"


def percent(part: str, whole: str) -> str:
    """100 * part / whole for counts, rounded half up at two digits in whole numbers."""
    doubled = f"(20000 * CAST({part} AS HUGEINT) + {whole})"
    return f"CAST({doubled} // nullif(2 * {whole}, 0) AS DOUBLE) / 100"


VIEWS = {
    "offers": """
        SELECT CAST(o_orderkey AS VARCHAR) AS offer_id, CAST(o_custkey AS VARCHAR) AS user_id,
               CAST(o_orderkey % 100 AS VARCHAR) AS station_id, o_orderdate AS created_at,
               o_orderdate + INTERVAL 300 SECOND AS expires_at,
               CASE o_orderstatus WHEN 'F' THEN 'USED' WHEN 'O' THEN 'ACTIVE' ELSE 'EXPIRED' END
                   AS status,
               o_orderpriority AS tariff_version,
               CAST(CAST(left(o_orderpriority, 1) AS INTEGER) + (o_custkey % 3) * 0.25
                   AS DECIMAL(10,4)) AS rate,
               CAST(1 + (o_custkey % 3) * 0.25 AS DECIMAL(10,4)) AS multiplier,
               CASE WHEN o_orderkey % 50 = 0 THEN 'GREEDY' WHEN o_custkey % 3 = 0 THEN 'STANDARD'
                    WHEN o_custkey % 3 = 1 THEN 'PREMIUM' ELSE 'VIP' END AS segment,
               o_orderkey % 50 = 0 AS is_greedy,
               o_orderkey
        FROM orders""",
    "lines": """
        SELECT l_orderkey || '-' || l_linenumber AS rental_id, l_orderkey,
               CAST(l_orderkey AS VARCHAR) AS offer_id, CAST(l_suppkey AS VARCHAR) AS station_id,
               l_shipdate AS started_at,
               CASE WHEN l_returnflag = 'A'
                    THEN l_shipdate + CAST(l_quantity AS INTEGER) * INTERVAL 1 MINUTE END
                   AS finished_at,
               CASE l_returnflag WHEN 'A' THEN 'FINISHED' WHEN 'R' THEN 'CANCELLED' ELSE 'ACTIVE' END
                   AS status,
               CASE WHEN l_returnflag = 'A' THEN
                    CAST(round(CAST(l_extendedprice AS DECIMAL(12,2))
                               * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(12,2)) END
                   AS final_cost,
               CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS INTEGER) END AS minutes
        FROM lineitem""",
    "rentals": """
        SELECT r.* EXCLUDE (place), o.user_id, o.tariff_version, o.rate, o.multiplier
        FROM (SELECT *, row_number() OVER (PARTITION BY rental_id ORDER BY started_at DESC,
                     finished_at DESC NULLS LAST, status DESC, station_id DESC,
                     final_cost DESC NULLS LAST) AS place FROM lines) r
        JOIN offers o ON o.o_orderkey = r.l_orderkey
        WHERE place = 1""",
    "users": """
        SELECT CAST(c_custkey AS VARCHAR) AS user_id, lower(c_name) || '@example.com' AS email,
               CAST(NULL AS VARCHAR) AS phone, 'ACTIVE' AS status, c_mktsegment,
               (SELECT min(o_orderdate) FROM orders WHERE o_custkey = c_custkey) AS created_at
        FROM customer""",
    "stations": """
        SELECT CAST(s_suppkey AS VARCHAR) AS station_id, s_name AS station_name, n_name AS city,
               r_name AS region
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "audit": """
        SELECT offer_id, offer_id || '-1' AS id, created_at AS ts, 'ACTIVE' AS status FROM offers
        UNION ALL
        SELECT offer_id, offer_id || '-2', created_at + CASE status WHEN 'USED'
               THEN INTERVAL 120 SECOND ELSE INTERVAL 300 SECOND END, status
        FROM offers WHERE status <> 'ACTIVE'""",
    "visits": """
        SELECT CAST(event_id AS VARCHAR) AS rental_id, CAST(user_id AS VARCHAR) AS user_id,
               json_extract_string(props, '$.k') AS station_id, ts AS started_at,
               CAST(event_id % 60 + 1 AS INTEGER) AS minutes,
               CAST(value AS DECIMAL(10,2)) AS final_cost,
               CASE event_type WHEN 'purchase' THEN 'FINISHED' WHEN 'error' THEN 'CANCELLED'
                    ELSE 'ACTIVE' END AS status,
               event_id, event_type
        FROM events""",
    "snapshots": """
        SELECT l_partkey || '-' || l_suppkey || '-' || CAST(l_quantity AS INTEGER) AS id,
               l_orderkey || '-' || l_linenumber AS rental_id, l_shipdate AS ts,
               CAST(round(CAST(l_extendedprice AS DECIMAL(12,2))
                          * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(12,2))
                   AS cost_amount
        FROM lineitem WHERE l_returnflag = 'A'""",
    "last_snapshot": """
        SELECT rental_id, cost_amount FROM (SELECT *, row_number() OVER (PARTITION BY rental_id
               ORDER BY ts DESC, id DESC) AS place FROM snapshots) WHERE place = 1""",
    "attempts": """
        SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
                   || strftime(l_shipdate, '%Y%m%d') || '-' || CAST(l_quantity AS INTEGER)
                   AS attempt_id,
               CASE WHEN o_orderkey % 17 = 0 THEN 'x' || o_orderkey
                    ELSE CAST(o_orderkey AS VARCHAR) END AS offer_id,
               CAST(CASE WHEN l_linenumber = 7 THEN o_custkey + 1 ELSE o_custkey END AS VARCHAR)
                   AS user_id,
               o_orderdate + CAST(l_quantity * 7 AS INTEGER) * INTERVAL 1 SECOND AS ts
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "open_offers": """
        SELECT offer_id, user_id, expires_at,
               CASE WHEN o_orderkey % 13 <> 0 THEN station_id END AS station_id,
               CASE WHEN o_orderkey % 11 = 0 THEN 'USED' WHEN status = 'USED' THEN 'ACTIVE'
                    ELSE status END AS status
        FROM offers""",
    # The first passing attempt of each offer turns it USED; everything after it finds it so.
    "tried": """
        SELECT a.*, o.user_id AS owner, o.station_id, o.status, o.expires_at,
               coalesce(o.user_id = a.user_id, false) AS owned,
               coalesce(o.user_id = a.user_id AND o.status = 'ACTIVE' AND a.ts < o.expires_at, false)
                   AS usable
        FROM attempts a LEFT JOIN open_offers o USING (offer_id)""",
    "judged": """
        SELECT *, CASE WHEN NOT owned THEN 'NOT_FOUND'
                       WHEN status = 'USED' THEN 'ALREADY_USED'
                       WHEN status <> 'ACTIVE' THEN 'EXPIRED'
                       WHEN usable AND place = 1 THEN 'USED'
                       WHEN passed_before > 0 THEN 'ALREADY_USED'
                       ELSE 'EXPIRED' END AS outcome
        FROM (SELECT *,
                     sum(CAST(usable AS INTEGER)) OVER (PARTITION BY offer_id ORDER BY ts, attempt_id
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS place,
                     coalesce(sum(CAST(usable AS INTEGER)) OVER (PARTITION BY offer_id
                         ORDER BY ts, attempt_id
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS passed_before
              FROM tried)""",
    "tariff_pairs": """
        SELECT tariff_version, rate, min(created_at) AS valid_from,
               arg_min(tariff_type, (created_at, tariff_type)) AS tariff_type
        FROM (SELECT *, CASE WHEN is_greedy THEN 'greedy' WHEN segment IN ('STANDARD', 'PREMIUM')
                             THEN lower(segment) ELSE 'promo' END AS tariff_type FROM offers)
        GROUP BY tariff_version, rate""",
    "tariff_dim": """
        SELECT md5(tariff_version || '|' || CAST(rate AS VARCHAR)) AS tariff_dwh_id, tariff_version,
               rate, valid_from,
               coalesce(lead(valid_from) OVER (PARTITION BY tariff_version ORDER BY valid_from, rate),
                        TIMESTAMP '9999-12-31 00:00:00') AS valid_to, tariff_type
        FROM tariff_pairs""",
    "calendar": """
        SELECT CAST(d AS DATE) AS date_actual,
               CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id,
               CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name,
               CAST(day(d) AS INTEGER) AS day_of_month, CAST(week(d) AS INTEGER) AS week_of_year,
               CAST(month(d) AS INTEGER) AS month_num, monthname(d) AS month_name,
               CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
               isodow(d) >= 6 AS is_weekend
        FROM range(TIMESTAMP '1995-01-01', TIMESTAMP '2025-01-01', INTERVAL 1 DAY) AS c(d)""",
    "daily": """
        SELECT c.date_actual, c.year, c.month_num, c.day_of_week, c.is_weekend,
               coalesce(total_rentals, 0) AS total_rentals,
               coalesce(completed_rentals, 0) AS completed_rentals,
               coalesce(cancelled_rentals, 0) AS cancelled_rentals,
               coalesce(active_users, 0) AS active_users, total_revenue, avg_rental_cost,
               median_rental_cost, avg_duration_minutes, total_duration_minutes,
               coalesce(total_offers_created, 0) AS total_offers_created,
               coalesce(offers_used, 0) AS offers_used,
               coalesce(offers_expired, 0) AS offers_expired,
               """ + percent("offers_used", "total_offers_created") + """
                   AS offer_to_rental_conversion_rate
        FROM calendar c
        LEFT JOIN (
            SELECT CAST(started_at AS DATE) AS d, count(DISTINCT rental_id) AS total_rentals,
                   count(DISTINCT rental_id) FILTER (status = 'FINISHED') AS completed_rentals,
                   count(DISTINCT rental_id) FILTER (status = 'CANCELLED') AS cancelled_rentals,
                   count(DISTINCT user_id) AS active_users, sum(final_cost) AS total_revenue,
                   """ + mean("final_cost") + """ AS avg_rental_cost,
                   round(quantile_cont(CAST(final_cost AS DOUBLE), 0.5), 3) AS median_rental_cost,
                   """ + mean("minutes") + """ AS avg_duration_minutes,
                   sum(minutes) AS total_duration_minutes
            FROM rentals GROUP BY 1) r ON r.d = c.date_actual
        LEFT JOIN (
            SELECT CAST(created_at AS DATE) AS d, count(DISTINCT offer_id) AS total_offers_created,
                   count(DISTINCT offer_id) FILTER (status = 'USED') AS offers_used,
                   count(DISTINCT offer_id) FILTER (status = 'EXPIRED') AS offers_expired
            FROM offers GROUP BY 1) f ON f.d = c.date_actual
        WHERE c.date_actual BETWEEN DATE '2001-05-03' AND DATE '2001-08-01'""",
    "station_stats": """
        SELECT s.station_id, s.station_name, s.city, count(*) AS total_rentals_30d,
               count(DISTINCT r.user_id) AS unique_users_30d, sum(final_cost) AS total_revenue_30d,
               """ + mean("final_cost") + """ AS avg_rental_cost,
               """ + mean("minutes") + """ AS avg_duration_minutes,
               sum(minutes) AS total_usage_minutes_30d,
               count(*) FILTER (started_at >= TIMESTAMP '2001-07-25') AS rentals_last_7d,
               rank() OVER (ORDER BY count(*) DESC) AS popularity_rank
        FROM stations s JOIN rentals r USING (station_id)
        WHERE started_at >= TIMESTAMP '2001-07-02' AND started_at < TIMESTAMP '2001-08-02'
        GROUP BY 1, 2, 3""",
    "breakdown": """
        SELECT CAST(started_at AS DATE) AS date, tariff_type, city, count(*) AS rentals_count,
               sum(final_cost) AS revenue, """ + mean("final_cost") + """ AS avg_revenue_per_rental,
               sum(minutes) AS total_minutes
        FROM rentals r JOIN stations s USING (station_id)
        JOIN tariff_dim t ON t.tariff_version = r.tariff_version AND t.rate = r.rate
        WHERE r.status = 'FINISHED' AND started_at >= TIMESTAMP '2001-05-03'
          AND started_at < TIMESTAMP '2001-08-02'
        GROUP BY 1, 2, 3""",
    "hourly": """
        SELECT CAST(hour(started_at) AS INTEGER) AS hour,
               CASE WHEN hour(started_at) < 6 THEN '00-06' WHEN hour(started_at) < 12 THEN '06-12'
                    WHEN hour(started_at) < 18 THEN '12-18' ELSE '18-24' END AS hour_of_day,
               isodow(started_at) >= 6 AS is_weekend, count(*) AS total_rentals,
               """ + mean("final_cost") + """ AS avg_cost, """ + mean("minutes") + """ AS avg_duration
        FROM visits
        WHERE started_at >= TIMESTAMP '2023-12-31' AND started_at < TIMESTAMP '2024-01-31'
        GROUP BY 1, 2, 3""",
    "cohorts": """
        SELECT CAST(date_trunc('month', u.created_at) AS DATE) AS cohort_month,
               count(*) AS cohort_size,
               count(*) FILTER (EXISTS (SELECT 1 FROM rentals r WHERE r.user_id = u.user_id
                   AND r.started_at >= date_trunc('month', u.created_at)
                   AND r.started_at < least(date_trunc('month', u.created_at) + INTERVAL 1 MONTH,
                                            TIMESTAMP '1996-06-16')))
                   AS active_month_0,
               count(*) FILTER (EXISTS (SELECT 1 FROM rentals r WHERE r.user_id = u.user_id
                   AND r.started_at >= date_trunc('month', u.created_at) + INTERVAL 1 MONTH
                   AND r.started_at < least(date_trunc('month', u.created_at) + INTERVAL 2 MONTH,
                                            TIMESTAMP '1996-06-16')))
                   AS active_month_1,
               """ + mean("c.total_rentals") + """ AS avg_rentals_per_user,
               """ + mean("c.total_spent") + """ AS avg_revenue_per_user
        FROM users u
        LEFT JOIN (SELECT user_id, count(*) AS total_rentals, sum(final_cost) AS total_spent
                   FROM rentals WHERE status = 'FINISHED' AND started_at < TIMESTAMP '1996-06-16'
                     AND started_at >= TIMESTAMP '1995-06-01' GROUP BY 1) c USING (user_id)
        WHERE u.created_at >= TIMESTAMP '1995-06-01' AND u.created_at < TIMESTAMP '1996-06-16'
        GROUP BY 1""",
}

NEEDS = {
    "rentals": ["lines", "offers"],
    "audit": ["offers"],
    "last_snapshot": ["snapshots"],
    "open_offers": ["offers"],
    "tried": ["attempts", "open_offers"],
    "judged": ["tried"],
    "tariff_pairs": ["offers"],
    "tariff_dim": ["tariff_pairs"],
    "daily": ["calendar", "rentals", "offers"],
    "station_stats": ["stations", "rentals"],
    "breakdown": ["rentals", "stations", "tariff_dim"],
    "hourly": ["visits"],
    "cohorts": ["users", "rentals"],
}


def with_views(names: list[str], sql: str) -> str:
    """The SQL behind the views it uses, each after those it builds on."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return sql
    listed = ",\n".join(f"{name} AS ({VIEWS[name]}\n)" for name in ordered)
    for word in ("WITH RECURSIVE", "WITH"):
        if sql.lstrip().startswith(word + " "):
            return f"{word} {listed},\n{sql.lstrip()[len(word):]}"
    return f"WITH {listed}\n{sql}"
