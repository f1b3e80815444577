"""Pricing, offer and rental rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltmart.operators import audit, pricing, rentals as rules
from voltmart.operators.ods import parse_tariff
from voltmart.sources import standins as src
from voltmart.suite.registry import moment, num, query

PRICED = """
WITH requests AS (
  SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS offer_id,
         CASE WHEN o_orderkey % 8 = 0 THEN 'u' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END AS user_id,
         CAST(o_orderkey % 120 AS VARCHAR) AS station_id,
         CASE WHEN o_orderkey % 5 = 0 THEN 'MACHINERY' END AS asked, o_orderdate AS created_at
  FROM orders),
tariffs AS (
  SELECT CAST(s_suppkey AS VARCHAR) || '-' || seg AS tariff_id, CAST(s_suppkey AS VARCHAR) AS station_id,
         seg AS segment, 2.0 + (s_suppkey % 7) * 0.5 + length(seg) * 0.25 AS base_rate,
         1.0 + length(seg) * 0.125 AS multiplier, 'v' || (s_suppkey % 3) AS version
  FROM supplier, (VALUES ('AUTOMOBILE'), ('BUILDING'), ('FURNITURE'), ('HOUSEHOLD'), ('MACHINERY'),
                         ('STANDARD')) AS k(seg)
  WHERE s_acctbal >= 0 AND (seg <> 'MACHINERY' OR s_acctbal > 2000)),
dearest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station_id
                        ORDER BY base_rate DESC, tariff_id DESC) AS place FROM tariffs) WHERE place = 1),
priced AS (
  SELECT r.k, r.offer_id, r.user_id, r.station_id, r.created_at,
         coalesce(r.asked, CASE WHEN c_custkey IS NULL THEN NULL WHEN c_mktsegment = 'HOUSEHOLD'
                  THEN 'STANDARD' ELSE c_mktsegment END) AS segment
  FROM requests r LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = r.user_id),
found AS (
  SELECT p.*, p.segment IS NULL AS greedy,
         CASE WHEN p.segment IS NULL THEN coalesce(d.tariff_id, 'greedy-' || p.station_id)
              ELSE t.tariff_id END AS tariff_id,
         CASE WHEN p.segment IS NULL THEN coalesce(d.base_rate, 15.0) ELSE t.base_rate END AS base_rate,
         CASE WHEN p.segment IS NULL THEN coalesce(d.multiplier, 1.5) ELSE t.multiplier END AS multiplier,
         CASE WHEN p.segment IS NULL THEN coalesce(d.version, 'greedy-v1') ELSE t.version END AS version
  FROM priced p LEFT JOIN tariffs t ON t.station_id = p.station_id AND t.segment = p.segment
  LEFT JOIN dearest d ON d.station_id = p.station_id)
"""


def _request_inputs(spark, sf):
    return src.offer_requests(spark, sf), src.known_users(spark, sf), src.tariffs(spark, sf)


@query("price_offers", PRICED + f"""
SELECT offer_id, user_id, station_id, {moment('created_at')} AS created_at,
       {moment('created_at + INTERVAL 300 SECOND')} AS expires_at, 'ACTIVE' AS status,
       version AS tariff_version, {num('base_rate * multiplier')} AS estimated_rate_per_minute,
       'RUB' AS currency, tariff_id, {num('base_rate')} AS base_rate,
       coalesce(segment, 'GREEDY') AS segment, greedy AS is_greedy
FROM found WHERE tariff_id IS NOT NULL""")
def _(spark, sf):
    offers = pricing.price_offers(*_request_inputs(spark, sf), ttl_seconds=0)
    field = lambda name: F.get_json_object("tariff_snapshot", f"$.{name}")
    return offers.select(
        *[c for c in offers.columns if c != "tariff_snapshot"],
        field("tariff_id").alias("tariff_id"),
        field("base_rate").cast("double").alias("base_rate"),
        field("segment").alias("segment"),
        field("is_greedy").cast("boolean").alias("is_greedy"),
    )


@query("price_rejects", PRICED + """
SELECT offer_id, user_id, station_id, segment, 'TARIFF_NOT_FOUND' AS reason
FROM found WHERE tariff_id IS NULL""")
def _(spark, sf):
    return pricing.price_rejects(*_request_inputs(spark, sf))


@query("classify_offer_use", f"""
SELECT attempt_id, offer_id, user_id, {moment('ts')} AS ts, station_id, outcome FROM judged""", "judged")
def _(spark, sf):
    return pricing.classify_offer_use(src.open_offers(spark, sf), src.use_attempts(spark, sf))


# Walks every user's claims in order; `free` is when the device in hand comes back.
REPLAY = f"""
WITH RECURSIVE claims AS (
  SELECT j.attempt_id, j.user_id, j.ts, j.station_id,
         CASE WHEN j.station_id IS NULL THEN j.ts
              ELSE greatest(coalesce(f.finished_at, TIMESTAMP '9999-12-31'), j.ts) END AS ends_at,
         row_number() OVER (PARTITION BY j.user_id ORDER BY j.ts, j.attempt_id) AS place
  FROM judged j LEFT JOIN (
      SELECT CAST(o_orderkey AS VARCHAR) AS offer_id,
             o_orderdate + CAST((o_orderkey % 200 + 1) * 864000 AS INTEGER) * INTERVAL 1 SECOND
                 AS finished_at
      FROM orders WHERE o_orderstatus <> 'P') f USING (offer_id)
  WHERE outcome = 'USED'),
walk AS (
  SELECT user_id, attempt_id, place, true AS granted, ends_at AS free FROM claims WHERE place = 1
  UNION ALL
  SELECT c.user_id, c.attempt_id, c.place, c.ts >= w.free,
         CASE WHEN c.ts >= w.free THEN c.ends_at ELSE w.free END
  FROM walk w JOIN claims c ON c.user_id = w.user_id AND c.place = w.place + 1)
SELECT j.attempt_id, j.offer_id, j.user_id, {moment('j.ts')} AS ts,
       CASE WHEN j.outcome <> 'USED' THEN j.outcome WHEN NOT w.granted THEN 'USER_ALREADY_RENT'
            WHEN j.station_id IS NULL THEN 'STATION_MISSING' ELSE 'STARTED' END AS outcome,
       j.outcome = 'USED' AS offer_burnt,
       {moment("CASE WHEN w.granted AND c.station_id IS NOT NULL AND c.ends_at < TIMESTAMP '9999-12-31' THEN c.ends_at END")}
           AS finished_at
FROM judged j LEFT JOIN walk w ON w.attempt_id = j.attempt_id
LEFT JOIN claims c ON c.attempt_id = j.attempt_id"""


@query("replay_rentals", REPLAY, "judged")
def _(spark, sf):
    return rules.replay_rentals(
        src.use_attempts(spark, sf), src.open_offers(spark, sf), src.finishes(spark, sf)
    )


@query("classify_finish", f"""
WITH requests AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
             || strftime(l_shipdate, '%Y%m%d') || '-' || CAST(l_quantity AS INTEGER) AS request_id,
         CASE WHEN o_orderkey % 19 = 0 THEN 'x' ELSE '' END || l_orderkey || '-' || l_linenumber
             AS rental_id,
         CAST(CASE WHEN l_linenumber = 6 THEN o_custkey + 1 ELSE o_custkey END AS VARCHAR) AS user_id,
         l_shipdate + CAST(l_quantity AS INTEGER) * INTERVAL 1 MINUTE AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
asked AS (
  SELECT q.*, r.user_id AS owner, r.rental_id IS NOT NULL AS known, r.status,
         coalesce(r.rental_id IS NOT NULL AND r.user_id IS NOT DISTINCT FROM q.user_id
                  AND r.status <> 'FINISHED', false) AS passing
  FROM requests q LEFT JOIN rentals r ON r.rental_id = q.rental_id),
placed AS (
  SELECT *, sum(CAST(passing AS INTEGER)) OVER (PARTITION BY rental_id ORDER BY ts, request_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS place FROM asked)
SELECT request_id, rental_id, user_id, {moment('ts')} AS ts,
       CASE WHEN NOT known THEN 'NOT_FOUND'
            WHEN owner IS DISTINCT FROM user_id THEN 'USER_MISMATCH'
            WHEN passing AND place = 1 THEN 'OK' ELSE 'ALREADY_FINISHED' END AS outcome
FROM placed""", "rentals")
def _(spark, sf):
    return rules.classify_finish(
        src.rentals(spark, sf), src.finish_requests(spark, sf)
    )


def _with_snapshot(spark, sf):
    offers = src.offers(spark, sf).select("offer_id", "tariff_snapshot")
    return src.rentals(spark, sf).drop("final_cost").join(offers, "offer_id")


@query("rental_cost", f"""
SELECT rental_id, minutes AS calculated_minutes, {num('50 + rate * minutes')} AS final_cost
FROM rentals""", "rentals")
def _(spark, sf):
    return rules.rental_cost(_with_snapshot(spark, sf)).select(
        "rental_id", "calculated_minutes", "final_cost"
    )


@query("current_cost", f"""
SELECT rental_id, status, {num('''50 + rate * CAST(coalesce(minutes,
       epoch(TIMESTAMP '2001-12-01' - started_at) / 60) AS BIGINT)''')} AS current_cost
FROM rentals""", "rentals")
def _(spark, sf):
    return rules.current_cost(_with_snapshot(spark, sf), "2001-12-01").select(
        "rental_id", "status", "current_cost"
    )


@query("quote_gap", f"""
SELECT rental_id, {num('rate * multiplier * minutes')} AS quoted_cost,
       {num('50 + rate * minutes')} AS charged_cost,
       {num('50 + rate * minutes - rate * multiplier * minutes')} AS gap
FROM rentals WHERE finished_at IS NOT NULL""", "rentals")
def _(spark, sf):
    return rules.quote_gap(_with_snapshot(spark, sf))


@query("outbox_pending", f"""
SELECT 'pay-' || r.rental_id AS id, r.rental_id,
       {num('r.final_cost + CASE WHEN l_orderkey % 5 = 0 THEN 0.25 ELSE 0 END')} AS amount,
       CAST(epoch(TIMESTAMP '2001-12-01' - finished_at - INTERVAL 1 HOUR) AS BIGINT) AS age_seconds,
       {num('s.cost_amount')} AS snapshot_cost,
       {num('r.final_cost + CASE WHEN l_orderkey % 5 = 0 THEN 0.25 ELSE 0 END - s.cost_amount')}
           AS difference
FROM rentals r LEFT JOIN last_snapshot s USING (rental_id)
WHERE status = 'FINISHED' AND l_orderkey % 2 = 1""", "rentals last_snapshot")
def _(spark, sf):
    return rules.outbox_pending(
        src.outbox(spark, sf), src.cost_snapshots(spark, sf), "2001-12-01"
    )


@query("offer_status_asof", f"""
SELECT offer_id, status, {moment('ts')} AS status_since FROM (
  SELECT *, row_number() OVER (PARTITION BY offer_id ORDER BY ts DESC, id DESC) AS place
  FROM audit WHERE ts <= TIMESTAMP '1999-05-31 00:03:00') WHERE place = 1""", "audit")
def _(spark, sf):
    return audit.offer_status_asof(src.offer_audit(spark, sf), "1999-05-31 00:03:00")


@query("status_durations", f"""
SELECT offer_id, id, status, {moment('ts')} AS entered_at, {moment('left_at')} AS left_at,
       CAST(epoch(left_at - ts) AS BIGINT) AS seconds_in_status
FROM (SELECT *, lead(ts) OVER (PARTITION BY offer_id ORDER BY ts, id) AS left_at FROM audit)""", "audit")
def _(spark, sf):
    return audit.status_durations(src.offer_audit(spark, sf))


@query("effective_rates", f"""
SELECT tariff_version, {num('rate')} AS tariff_rate_per_minute,
       {num('CAST(rate * multiplier AS DECIMAL(10,4))')} AS effective_rate, count(*) AS offers
FROM offers GROUP BY ALL""", "offers")
def _(spark, sf):
    return (
        parse_tariff(src.offers(spark, sf))
        .groupBy("tariff_version", "tariff_rate_per_minute", "effective_rate")
        .agg(F.count(F.lit(1)).alias("offers"))
    )
