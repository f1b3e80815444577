"""Extracts, RAW, ODS, dimensions and facts."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F, types as T

from voltmart import schemas
from voltmart.functions import scalar as S
from voltmart.operators import access, balance, bitemporal, dims, facts, keys, ods, pricing
from voltmart.plans import warehouse
from voltmart.session import cut_lineage, work_dir
from voltmart.sources import extracts, shards, sinks, standins as src
from voltmart.suite.mart_queries import (
    COHORTS_SQL, DAILY_SQL, STATION_COLUMNS, calendar, tariff_dimension,
)
from voltmart.suite.registry import VIEWS, day, moment, num, once_per_session, query

AS_OF = src.ORDERS_AS_OF
EARLIER = "2001-07-01"


def ts(text: str):
    return F.lit(text).cast("timestamp")


# --- sources and sinks ------------------------------------------------------------------------


@query("extract_users", f"""
SELECT user_id, email, phone, status, {moment('created_at')} AS created_at,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'STANDARD' ELSE c_mktsegment END AS segment
FROM users""", "users")
def _(spark, sf):
    return extracts.extract_users(src.users(spark, sf), src.segments(spark, sf))


@query("extract_incremental", f"""
SELECT offer_id, status, {moment('created_at')} AS created_at, 0 AS shard_id FROM offers o
WHERE created_at > (SELECT coalesce(max(created_at), TIMESTAMP '1970-01-01') FROM offers
                    WHERE created_at <= TIMESTAMP '{EARLIER}')""", "offers")
def _(spark, sf):
    offers = src.offers(spark, sf).select("offer_id", "status", "created_at")
    loaded = offers.filter(F.col("created_at") <= ts(EARLIER)).withColumn("shard_id", F.lit(0))
    return extracts.extract_incremental(offers, loaded, "created_at", 0)


@query("extract_incremental_first_run", f"""
SELECT offer_id, {moment('created_at')} AS created_at, 1 AS shard_id FROM offers""", "offers")
def _(spark, sf):
    offers = src.offers(spark, sf).select("offer_id", "created_at")
    other_shard = offers.withColumn("shard_id", F.lit(0))
    return extracts.extract_incremental(offers, other_shard, "created_at", 1)


@query("load_raw", f"""
SELECT offer_id, station_id, status, 'offer_service' AS source_system,
       '{AS_OF} 00:00:00.000000' AS loaded_at, '{AS_OF}' AS load_date FROM offers""", "offers")
def _(spark, sf):
    offers = src.offers(spark, sf).select("offer_id", "station_id", "status")
    path = work_dir(spark, "raw")
    sinks.append_raw(extracts.load_raw(offers, "offer_service", AS_OF), path)
    return spark.read.parquet(path)


@query("insert_ignore", f"""
SELECT rental_id, {moment('started_at')} AS started_at FROM (
  SELECT *, row_number() OVER (PARTITION BY rental_id ORDER BY old DESC, started_at DESC) AS place
  FROM (SELECT rental_id, started_at, 1 AS old FROM rentals WHERE started_at < TIMESTAMP '{EARLIER}'
        UNION ALL SELECT rental_id, started_at, 0 FROM lines)) WHERE place = 1""", "rentals")
def _(spark, sf):
    loaded = src.rentals(spark, sf).select("rental_id", "started_at").filter(
        F.col("started_at") < ts(EARLIER)
    )
    new = src.raw_rentals(spark, sf).select("rental_id", "started_at")
    return keys.insert_ignore(loaded, new, ["rental_id"])


@query("extract_rentals", f"""
SELECT r.rental_id, r.offer_id, r.user_id, r.status, {num('s.cost_amount')} AS final_cost
FROM rentals r LEFT JOIN last_snapshot s USING (rental_id)""", "rentals last_snapshot")
def _(spark, sf):
    rentals = src.rentals(spark, sf).select("rental_id", "offer_id", "user_id", "status")
    return extracts.extract_rentals(rentals, src.cost_snapshots(spark, sf))


@query("extract_events", f"""
SELECT event_id, {moment('ts')} AS ts, event_type, {day('ts')} AS event_date FROM events""")
def _(spark, sf):
    log = src.rental_events(spark, sf).select(
        "event_id", "ts", F.col("event_type").alias("type")
    )
    return extracts.extract_events(log)


# Facts loaded a month ago: rentals started before, those still running shown as ACTIVE.
def _facts_then(spark, sf):
    running = F.col("loaded_at") >= ts("2001-06-01")
    return (
        src.rentals(spark, sf)
        .filter(F.col("started_at") < ts(EARLIER))
        .select(
            "rental_id", "station_id", "started_at",
            F.when(running, F.lit("ACTIVE")).otherwise(F.col("status")).alias("status"),
            F.when(~running, F.col("final_cost")).alias("final_cost"),
        )
    )


def _facts_now(spark, sf):
    return (
        src.rentals(spark, sf)
        .filter(F.col("started_at") >= ts("2001-06-01"))
        .select("rental_id", F.lit("moved").alias("station_id"), "started_at", "status", "final_cost")
    )


UPSERTED = f"""
SELECT rental_id, CASE WHEN started_at >= TIMESTAMP '{EARLIER}' THEN 'moved' ELSE station_id END
           AS station_id,
       {moment('started_at')} AS started_at, status, {num('final_cost')} AS final_cost FROM rentals"""


@query("upsert", UPSERTED, "rentals")
def _(spark, sf):
    return keys.upsert(
        _facts_then(spark, sf), _facts_now(spark, sf), ["rental_id"], ["status", "final_cost"]
    )


@query("upsert_partitions", UPSERTED.replace(" FROM rentals", """,
       CAST(strftime(started_at, '%Y%m') AS INTEGER) AS month_id FROM rentals"""), "rentals")
def _(spark, sf):
    path = work_dir(spark, "facts")
    month = S.month_id("started_at")
    sinks.write_fact(_facts_then(spark, sf).withColumn("month_id", month), path, "station_id")
    sinks.upsert_partitions(
        spark, path, _facts_now(spark, sf).withColumn("month_id", month), ["rental_id"],
        ["status", "final_cost"],
    )
    return spark.read.parquet(path)


@query("refresh_mart", """
SELECT station_id, count(*) AS rentals FROM rentals GROUP BY 1""", "rentals")
def _(spark, sf):
    path = work_dir(spark, "mart")
    counts = src.rentals(spark, sf).groupBy("station_id").agg(F.count(F.lit(1)).alias("rentals"))
    sinks.refresh_mart("station_counts", counts.filter("rentals < 0"), path)
    sinks.refresh_mart("station_counts", counts, path)
    return sinks.read_mart(spark, "station_counts", path)


@query("write_fact", """
SELECT CAST(strftime(started_at, '%Y%m') AS INTEGER) AS month_id, count(*) AS rentals,
       count(DISTINCT station_id) AS stations FROM rentals GROUP BY 1""", "rentals")
def _(spark, sf):
    path = work_dir(spark, "facts")
    rows = src.rentals(spark, sf).withColumn("month_id", S.month_id("started_at"))
    sinks.write_fact(rows, path, "station_id")
    return spark.read.parquet(path).groupBy("month_id").agg(
        F.count(F.lit(1)).alias("rentals"), F.count_distinct("station_id").alias("stations")
    )


@query("apply_retention", """
SELECT rental_id, CASE WHEN started_at < TIMESTAMP '1998-08-02' THEN 'archive' ELSE 'keep' END
       AS disposition FROM rentals""", "rentals")
def _(spark, sf):
    rows = src.rentals(spark, sf).select("rental_id", "started_at")
    keep, archive = sinks.apply_retention(rows, "started_at", 1095, AS_OF)
    tagged = keep.withColumn("disposition", F.lit("keep")).unionByName(
        archive.withColumn("disposition", F.lit("archive"))
    )
    return tagged.select("rental_id", "disposition")


def _uuid(column: str):
    """The numeric key as the 16 bytes of a UUID."""
    return S.canonical_uuid(F.lpad(F.hex(F.col(column).cast("bigint")), 32, "0"))


SHARD = """
SELECT CAST(c_custkey AS VARCHAR) AS user_id,
       CAST((('0x' || left(digest, 16))::UBIGINT::UHUGEINT * 18446744073709551616::UHUGEINT
             + ('0x' || right(digest, 16))::UBIGINT::UHUGEINT) % 7 AS INTEGER) AS shard_id
FROM (SELECT c_custkey, md5(unhex(lpad(hex(c_custkey), 32, '0'))) AS digest FROM customer)"""


@query("with_shard", SHARD)
def _(spark, sf):
    users = src.users(spark, sf).select("user_id", _uuid("user_id").alias("_uuid"))
    return extracts.with_shard(users, "_uuid", 7).drop("_uuid")


@query("shard_balance", f"""
SELECT shard_id, count(*) AS row_count, CAST(count(*) * 100000 AS BIGINT) AS estimated_bytes,
       round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM orders), 4) AS share,
       count(*) * 100000 > 200000000 AS over_limit
FROM offers JOIN ({SHARD}) USING (user_id) GROUP BY 1""", "offers")
def _(spark, sf):
    offers = src.offers(spark, sf).select(_uuid("user_id").alias("user_id"))
    return extracts.shard_balance(offers, 7, row_bytes=100_000, limit_bytes=200_000_000)


LOADS = """
loads AS (
  SELECT shard_id, user_id, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(count(*) AS BIGINT) AS n
  FROM (SELECT CASE WHEN CAST(user_id AS BIGINT) % 10 < 5 THEN 0 ELSE CAST(user_id AS BIGINT) % 4 END AS shard_id, *
        FROM (SELECT user_id, strlen(offer_id) + strlen(user_id) + strlen(station_id) + strlen(status) AS bytes FROM offers
              UNION ALL SELECT user_id, strlen(rental_id) + strlen(offer_id) + strlen(user_id) + strlen(status) FROM rentals))
  GROUP BY 1, 2)"""


def loads_by_shard(spark, sf):
    """Real bytes per user; a placement by hand has put half of all users on the first of four shards."""
    number = F.col("user_id").cast("long")
    shard = F.when(number % 10 < 5, F.lit(0)).otherwise(number % 4).cast("int")
    tables = [
        src.offers(spark, sf).select("offer_id", "user_id", "station_id", "status"),
        src.rentals(spark, sf).select("rental_id", "offer_id", "user_id", "status"),
    ]
    sized = [t.withColumn("_bytes", balance.row_bytes(t)).withColumn("shard_id", shard) for t in tables]
    parts = [
        t.groupBy("shard_id", "user_id").agg(F.sum("_bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        for t in sized
    ]
    return balance.merge_loads(parts[0].unionByName(parts[1]))


@query("heavy_users", f"""
WITH {LOADS}
SELECT CAST(shard_id AS INTEGER) AS shard_id, CAST(place AS INTEGER) AS rank, user_id, bytes, n AS rows,
       round(CAST(bytes AS DOUBLE) / total, 6) AS share
FROM (SELECT *, row_number() OVER (PARTITION BY shard_id ORDER BY bytes DESC, user_id) AS place,
             sum(bytes) OVER (PARTITION BY shard_id) AS total FROM loads)
WHERE place <= 20""", "offers rentals")
def _(spark, sf):
    return balance.heavy_hitters(loads_by_shard(spark, sf), 20)


@query("shard_moves", f"""
WITH {LOADS},
sizes AS (SELECT shard_id, CAST(sum(bytes) AS BIGINT) AS size FROM loads GROUP BY 1),
mean AS (SELECT CAST(sum(size) AS BIGINT) // 4 AS mean FROM sizes),
moved AS (
  SELECT * FROM (SELECT l.*, size - mean AS over_mean,
                        sum(bytes) OVER (PARTITION BY l.shard_id ORDER BY bytes DESC, user_id) AS upto
                 FROM loads l JOIN sizes USING (shard_id), mean WHERE size > mean AND bytes <= size - mean)
  WHERE upto <= over_mean),
line AS (SELECT *, 2 * sum(bytes) OVER (ORDER BY bytes DESC, user_id, shard_id) - bytes AS middle FROM moved),
rooms AS (SELECT shard_id AS to_shard, sum(mean - size) OVER (ORDER BY mean - size DESC, shard_id) AS room_end
          FROM sizes, mean WHERE size < mean)
SELECT user_id, CAST(shard_id AS INTEGER) AS from_shard, bytes, CAST(coalesce(
         (SELECT to_shard FROM rooms WHERE middle <= 2 * room_end ORDER BY room_end LIMIT 1),
         (SELECT to_shard FROM rooms ORDER BY room_end DESC LIMIT 1)) AS INTEGER) AS to_shard
FROM line""", "offers rentals")
def _(spark, sf):
    return balance.move_plan(cut_lineage(loads_by_shard(spark, sf), "loads"), 4)


def sharded(spark, sf, table: str, df) -> str:
    """A table as two shards of files, by user."""
    path = f"{work_dir(spark, 'shards')}/{table}"
    key = "user_id" if "user_id" in df.columns else df.columns[0]
    df.withColumn("shard", F.pmod(F.xxhash64(key), F.lit(2))).write.partitionBy("shard").parquet(path)
    return path


@query("read_shards", f"""
SELECT offer_id, user_id, status, {moment('created_at')} AS created_at FROM offers
WHERE created_at > TIMESTAMP '{EARLIER}' AND created_at <= TIMESTAMP '{AS_OF}'""", "offers")
def _(spark, sf):
    # The second of two loads: what came after the first one's mark.
    path, root = sharded(spark, sf, "offers", src.offers(spark, sf)), work_dir(spark, "marks")
    for upto in (EARLIER, AS_OF):
        since = shards.last_mark(spark, root)
        rows = shards.read_shards(spark, path, schemas.OFFERS, "created_at", since, upto)
        sinks.append_raw(extracts.load_raw(rows, "offer_service", upto), f"{root}/raw")
        shards.commit_mark(spark, root, upto)
    loaded = spark.read.parquet(f"{root}/raw").filter(F.col("load_date") == AS_OF)
    return loaded.select("offer_id", "user_id", "status", "created_at")


# --- projections and predicates ---------------------------------------------------------------


@query("parse_tariff", f"""
SELECT offer_id, {num('rate')} AS tariff_rate_per_minute, 'RUB' AS tariff_currency,
       {num('multiplier')} AS segment_multiplier,
       {num('CAST(rate * multiplier AS DECIMAL(10,4))')} AS effective_rate,
       segment AS tariff_segment, is_greedy FROM offers""", "offers")
def _(spark, sf):
    offers = src.offers(spark, sf).select("offer_id", "tariff_snapshot")
    return ods.parse_tariff(offers).drop("tariff_snapshot")


QUANTITY = T.StructType(
    [
        T.StructField("station_id", T.IntegerType(), False),
        T.StructField("priority", T.IntegerType(), False),
        T.StructField("status", T.StringType(), False),
    ]
)


@query("validate_types", """
SELECT offer_id, CASE WHEN try_cast(text AS INTEGER) IS NULL OR status = 'EXPIRED'
       THEN 'quarantine' ELSE 'ok' END AS verdict
FROM (SELECT *, CASE WHEN left(tariff_version, 1) = '4' THEN tariff_version
             WHEN left(tariff_version, 1) <> '5' THEN left(tariff_version, 1) END AS text
      FROM offers)""", "offers")
def _(spark, sf):
    first = F.substring("tariff_version", 1, 1)
    text = F.when(first == "4", F.col("tariff_version")).when(first != "5", first)
    rows = src.offers(spark, sf).select(
        "offer_id", "station_id", text.alias("priority"), "status"
    )
    ok, bad = ods.validate_types(rows, QUANTITY, {"status": ["ACTIVE", "USED", "CANCELLED"]})
    verdict = lambda df, word: df.select("offer_id", F.lit(word).alias("verdict"))
    return verdict(ok, "ok").unionByName(verdict(bad, "quarantine"))


@query("split_status", "SELECT event_id, event_type IN ('purchase', 'error') AS known FROM events")
def _(spark, sf):
    events = src.rental_events(spark, sf)
    renamed = F.when(F.col("event_type") == "purchase", "FINISHED").when(
        F.col("event_type") == "error", "CANCELLED"
    ).otherwise(F.col("event_type"))
    known, unknown = ods.split_status(events.withColumn("status", renamed), "rentals")
    flag = lambda df, value: df.select("event_id", F.lit(value).alias("known"))
    return flag(known, True).unionByName(flag(unknown, False))


@query("add_flags", """
SELECT r.rental_id, r.status = 'FINISHED' AS is_completed, r.status = 'CANCELLED' AS is_cancelled,
       o.status = 'USED' AS is_used, o.status = 'EXPIRED' AS is_expired_unused
FROM rentals r JOIN offers o USING (offer_id)""", "rentals offers")
def _(spark, sf):
    rentals = facts.add_rental_flags(src.rentals(spark, sf)).drop("status")
    offers = facts.add_offer_flags(src.offers(spark, sf))
    return rentals.join(offers.select("offer_id", "is_used", "is_expired_unused"), "offer_id").select(
        "rental_id", "is_completed", "is_cancelled", "is_used", "is_expired_unused"
    )


@query("add_ttl", "SELECT offer_id, 300 AS ttl_seconds FROM offers", "offers")
def _(spark, sf):
    return facts.add_ttl(src.offers(spark, sf)).select("offer_id", "ttl_seconds")


@query("offer_validity", """
SELECT offer_id, status = 'ACTIVE' AND created_at >= TIMESTAMP '1999-06-01' AS is_valid
FROM offers""", "offers")
def _(spark, sf):
    # An offer made at midnight expires exactly at as_of when as_of is five past: no longer valid.
    offers = src.offers(spark, sf).select("offer_id", "status", "expires_at")
    return pricing.offer_validity(offers, "1999-05-31 00:05:00").select("offer_id", "is_valid")


@query("active_offers", f"""
SELECT user_id, offer_id, {moment('created_at')} AS created_at FROM offers
WHERE status = 'ACTIVE' AND expires_at > TIMESTAMP '1999-05-31 00:02:00'""", "offers")
def _(spark, sf):
    return pricing.active_offers(src.offers(spark, sf), "1999-05-31 00:02:00").select(
        "user_id", "offer_id", "created_at"
    )


@query("mask_pii_analyst", """
SELECT user_id, sha256(email) AS email, sha256(phone) AS phone, status FROM users""", "users")
def _(spark, sf):
    users = src.users(spark, sf).select("user_id", "email", "phone", "status")
    return access.mask_pii(users, "analyst")


@query("mask_pii_dashboard", "SELECT user_id, status FROM users", "users")
def _(spark, sf):
    users = src.users(spark, sf).select("user_id", "email", "phone", "status")
    return access.mask_pii(users, "dashboard")


@query("mask_pii_admin", "SELECT user_id, email, phone, status FROM users", "users")
def _(spark, sf):
    users = src.users(spark, sf).select("user_id", "email", "phone", "status")
    return access.mask_pii(users, "admin")


# --- ODS --------------------------------------------------------------------------------------


@query("dedup_latest", f"""
SELECT rental_id, status, {moment('started_at')} AS started_at, {moment('finished_at')} AS finished_at,
       {num('final_cost')} AS final_cost FROM rentals""", "rentals")
def _(spark, sf):
    rows = src.raw_rentals(spark, sf).select(
        "rental_id", "started_at", "finished_at", "status", "station_id", "final_cost", "loaded_at"
    )
    return keys.dedup_latest(rows, ["rental_id"], src.RENTAL_ORDER).select(
        "rental_id", "status", "started_at", "finished_at", "final_cost"
    )


def _user_snapshots(spark, sf):
    """Two full snapshots: everybody at first, then the customers with a positive balance, some of
    them blocked."""
    balance = src.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("user_id"), F.col("c_acctbal").alias("_balance")
    )
    users = src.users(spark, sf).join(balance, "user_id")
    first = users.withColumn("loaded_at", ts(EARLIER))
    second = (
        users.filter("_balance > 0")
        .withColumn(
            "status", F.when(F.col("_balance") > 5000, F.lit("BLOCKED")).otherwise(F.col("status"))
        )
        .withColumn("loaded_at", ts(AS_OF))
    )
    return first.drop("_balance"), second.drop("_balance")


@query("ods_users", f"""
SELECT user_id, email, phone, CASE WHEN c_acctbal > 5000 THEN 'BLOCKED' ELSE 'ACTIVE' END AS status,
       {moment('created_at')} AS created_at, c_acctbal <= 0 AS is_deleted,
       CASE WHEN c_acctbal > 5000 OR c_acctbal <= 0 THEN '{AS_OF} 00:00:00.000000'
            ELSE '{EARLIER} 00:00:00.000000' END AS updated_at
FROM users JOIN customer ON user_id = CAST(c_custkey AS VARCHAR)""", "users")
def _(spark, sf):
    first, second = _user_snapshots(spark, sf)
    prev = ods.ods_users(first, None, EARLIER)
    return ods.ods_users(first.unionByName(second), prev, AS_OF)


@query("ods_offers", f"""
SELECT offer_id, user_id, station_id, {num('rate')} AS tariff_rate_per_minute,
       'RUB' AS tariff_currency, CASE WHEN created_at > TIMESTAMP '2001-07-31 12:00:00' THEN 'ACTIVE'
       ELSE status END AS status, {moment('created_at')} AS created_at FROM offers""", "offers")
def _(spark, sf):
    # Extracted while still ACTIVE; what happened since is only in the audit log.
    raw = src.raw_offers(spark, sf).withColumn("status", F.lit("ACTIVE"))
    return ods.ods_offers(raw, src.offer_audit(spark, sf), "2001-07-31 12:00:00").select(
        "offer_id", "user_id", "station_id", "tariff_rate_per_minute", "tariff_currency", "status",
        "created_at",
    )


@query("ods_rentals", f"""
SELECT rental_id, offer_id, user_id, station_id, status, tariff_version,
       minutes AS duration_minutes, {num('final_cost')} AS final_cost FROM rentals""", "rentals")
def _(spark, sf):
    raw = src.raw_rentals(spark, sf).select(
        "rental_id", "offer_id", "user_id", "started_at", "finished_at", "status", "station_id",
        "final_cost", "tariff_version", "loaded_at",
    )
    return ods.ods_rentals(raw, src.offers(spark, sf)).select(
        "rental_id", "offer_id", "user_id", "station_id", "status", "tariff_version",
        "duration_minutes", "final_cost",
    )


@query("incremental", f"""
SELECT rental_id, station_id, {moment('started_at')} AS started_at FROM lines
WHERE started_at > TIMESTAMP '{EARLIER}'""", "lines")
def _(spark, sf):
    raw = src.raw_rentals(spark, sf).select("rental_id", "station_id", "started_at", "loaded_at")
    return ods.incremental(raw, EARLIER).drop("loaded_at")


# --- dimensions -------------------------------------------------------------------------------


def _user_key(at: str) -> str:
    return f"md5(user_id || '|' || epoch_us(TIMESTAMP '{at}'))"


@query("scd2_merge", f"""
WITH src AS (SELECT u.*, c_acctbal FROM users u JOIN customer ON user_id = CAST(c_custkey AS VARCHAR)),
old AS (SELECT *, c_acctbal > 5000 AS changed FROM src WHERE c_acctbal > -500)
SELECT {_user_key(EARLIER)} AS user_dwh_id, user_id, email, phone, status,
       {moment('created_at')} AS user_created_at, '{EARLIER} 00:00:00.000000' AS valid_from,
       CASE WHEN changed THEN '{AS_OF} 00:00:00.000000' ELSE '9999-12-31 00:00:00.000000' END
           AS valid_to, NOT changed AS is_current FROM old
UNION ALL
SELECT {_user_key(AS_OF)}, user_id, email, CASE WHEN c_acctbal > 5000 THEN '+7' || user_id END,
       CASE WHEN c_acctbal > 8000 THEN 'BLOCKED' ELSE status END, {moment('created_at')},
       '{AS_OF} 00:00:00.000000', '9999-12-31 00:00:00.000000', true
FROM src WHERE c_acctbal > 5000 OR c_acctbal <= -500""", "users")
def _(spark, sf):
    balance = src.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("user_id"), F.col("c_acctbal").alias("_balance")
    )
    users = src.users(spark, sf).join(balance, "user_id")
    before = dims.new_user_versions(users.filter("_balance > -500"), EARLIER)
    rich = F.col("_balance") > 5000
    now = users.withColumn(
        "phone", F.when(rich, F.concat(F.lit("+7"), "user_id"))
    ).withColumn(
        "status",
        F.when(F.col("_balance") > 8000, F.lit("BLOCKED")).otherwise(F.col("status")),
    )
    return dims.scd2_merge(before, now, AS_OF)


@query("dim_stations", """
SELECT md5(i.station_id) AS station_dwh_id, i.station_id, s.station_name, s.city, s.region
FROM (SELECT station_id FROM offers UNION SELECT station_id FROM lines) i
LEFT JOIN stations s USING (station_id)""", "offers lines stations")
def _(spark, sf):
    return dims.dim_stations(
        src.offers(spark, sf), src.raw_rentals(spark, sf), src.station_directory(spark, sf)
    ).drop("latitude", "longitude")


@query("dim_date", f"""
SELECT {day('c.date_actual')} AS date_actual, c.date_id, c.day_of_week, c.day_name, c.day_of_month,
       c.week_of_year, c.month_num, c.month_name, c.quarter, c.year, c.is_weekend,
       c.month_num = 1 AND c.day_of_month = 1 AS is_holiday, count(r.rental_id) AS rentals
FROM calendar c LEFT JOIN rentals r ON CAST(r.started_at AS DATE) = c.date_actual
WHERE c.date_actual <= DATE '2001-12-31' GROUP BY ALL""", "calendar rentals")
def _(spark, sf):
    # Every first of January with an order in its month counts as a holiday.
    january = src.offers(spark, sf).filter(F.month("created_at") == 1)
    holidays = january.select(F.to_date(F.date_trunc("year", "created_at")).alias("date_actual"))
    days = dims.dim_date(spark, src.FIRST_DAY, "2001-12-31", holidays.distinct())
    rentals = src.rentals(spark, sf).groupBy(F.to_date("started_at").alias("date_actual")).agg(
        F.count(F.lit(1)).alias("rentals")
    )
    return days.join(rentals, "date_actual", "left").fillna(0, ["rentals"])


@query("dim_time", """
SELECT rental_id, CAST(strftime(started_at, '%H%M%S') AS INTEGER) AS time_id,
       strftime(started_at, '%H:%M:%S') AS time_actual, CAST(hour(started_at) AS INTEGER) AS hour,
       CAST(minute(started_at) AS INTEGER) AS minute,
       ['00-06', '06-12', '12-18', '18-24'][hour(started_at) // 6 + 1] AS hour_of_day,
       hour(started_at) BETWEEN 9 AND 17 AS is_business_hours FROM visits""", "visits")
def _(spark, sf):
    events = src.event_facts(spark, sf).select("rental_id", F.col("start_time_id").alias("time_id"))
    return events.join(F.broadcast(dims.dim_time(spark)), "time_id")


@query("dim_tariff", f"""
SELECT tariff_dwh_id, tariff_version, {num('rate')} AS rate_per_minute, tariff_type,
       'RUB' AS currency, {moment('valid_from')} AS valid_from, {moment('valid_to')} AS valid_to
FROM tariff_dim""", "tariff_dim")
def _(spark, sf):
    return tariff_dimension(spark, sf).drop("tariff_snapshot")


def _asof_users(spark, sf):
    """User versions: a phone-less one until mid 1998, blocked from then on."""
    first = dims.new_user_versions(src.users(spark, sf), src.FIRST_DAY)
    blocked = src.users(spark, sf).withColumn("status", F.lit("BLOCKED"))
    return dims.scd2_merge(first, blocked, "1998-07-01")


@query("asof_dim", """
SELECT rental_id, user_id, CASE WHEN started_at < TIMESTAMP '1998-07-01' THEN 'ACTIVE'
       ELSE 'BLOCKED' END AS user_status FROM rentals""", "rentals")
def _(spark, sf):
    rentals = src.rentals(spark, sf).select("rental_id", "user_id", "started_at")
    versions = _asof_users(spark, sf).withColumnRenamed("status", "user_status")
    return dims.asof_dim(rentals, versions, "user_id", "started_at", ["user_status"]).drop("started_at")


@query("asof_tariff", """
SELECT o.offer_id, t.tariff_dwh_id FROM offers o LEFT JOIN tariff_dim t
  ON t.tariff_version = o.tariff_version AND t.valid_from <= o.created_at
 AND o.created_at < t.valid_to""", "offers tariff_dim")
def _(spark, sf):
    offers = src.offers(spark, sf).select("offer_id", "tariff_version", "created_at")
    return dims.asof_dim(
        offers, tariff_dimension(spark, sf), "tariff_version", "created_at", ["tariff_dwh_id"]
    ).select("offer_id", "tariff_dwh_id")


# --- facts ------------------------------------------------------------------------------------


def _user_dim(spark, sf):
    return dims.new_user_versions(src.users(spark, sf), EARLIER)


def _station_dim(spark, sf):
    return src.stations(spark, sf)


def _known_stations(spark, sf):
    """Stations outside Asia, so that some look-ups miss."""
    return src.stations(spark, sf).filter("region <> 'ASIA'")


FACT_SQL = f"""
SELECT r.rental_id, {_user_key(EARLIER)} AS user_dwh_id, md5(r.station_id) AS station_dwh_id,
       CAST(strftime(started_at, '%Y%m%d') AS INTEGER) AS start_date_id,
       CAST(strftime(started_at, '%H%M%S') AS INTEGER) AS start_time_id,
       CAST(strftime(finished_at, '%Y%m%d') AS INTEGER) AS end_date_id,
       CAST(strftime(finished_at, '%H%M%S') AS INTEGER) AS end_time_id,
       t.tariff_dwh_id, offer_id, minutes AS duration_minutes, {num('final_cost')} AS final_cost,
       status, status = 'FINISHED' AS is_completed, status = 'CANCELLED' AS is_cancelled
FROM rentals r JOIN stations s ON s.station_id = r.station_id
LEFT JOIN tariff_dim t ON t.tariff_version = r.tariff_version AND t.rate = r.rate"""
FACT_COLUMNS = [
    "rental_id", "user_dwh_id", "station_dwh_id", "start_date_id", "start_time_id", "end_date_id",
    "end_time_id", "tariff_dwh_id", "offer_id", "duration_minutes", "final_cost", "status",
    "is_completed", "is_cancelled",
]


def _fact_rentals(spark, sf, rows, as_of, prev=None):
    return facts.fact_rentals(
        rows, _user_dim(spark, sf), _station_dim(spark, sf), tariff_dimension(spark, sf), as_of,
        prev,
    )


@query("fact_rentals", FACT_SQL, "rentals stations tariff_dim")
def _(spark, sf):
    return _fact_rentals(spark, sf, src.rentals(spark, sf), AS_OF).select(*FACT_COLUMNS)


@query("fact_rentals_reload", FACT_SQL, "rentals stations tariff_dim")
def _(spark, sf):
    # Loaded once while every rental was still running, then again with the outcome.
    rows = src.rentals(spark, sf)
    running = (
        rows.filter(F.col("started_at") < ts(EARLIER))
        .withColumn("status", F.lit("ACTIVE"))
        .withColumn("finished_at", F.lit(None).cast("timestamp"))
        .withColumn("final_cost", F.lit(None).cast("decimal(12,2)"))
        .withColumn("duration_minutes", F.lit(None).cast("int"))
    )
    prev = _fact_rentals(spark, sf, running, EARLIER)
    return _fact_rentals(spark, sf, rows, AS_OF, prev).select(*FACT_COLUMNS)


@query("fact_offers", f"""
SELECT o.offer_id, {_user_key(EARLIER)} AS user_dwh_id, md5(o.station_id) AS station_dwh_id,
       CAST(strftime(created_at, '%Y%m%d') AS INTEGER) AS created_date_id,
       CAST(strftime(created_at, '%H%M%S') AS INTEGER) AS created_time_id, t.tariff_dwh_id,
       CASE WHEN status = 'ACTIVE' AND expires_at <= TIMESTAMP '{EARLIER}' THEN 'EXPIRED' ELSE status
       END AS status, 300 AS ttl_seconds, status = 'USED' AS is_used,
       status = 'EXPIRED' OR (status = 'ACTIVE' AND expires_at <= TIMESTAMP '{EARLIER}')
           AS is_expired_unused
FROM offers o JOIN stations s ON s.station_id = o.station_id
LEFT JOIN tariff_dim t ON t.tariff_version = o.tariff_version AND t.rate = o.rate""",
    "offers stations tariff_dim")
def _(spark, sf):
    offers = ods.parse_tariff(src.offers(spark, sf))
    return facts.fact_offers(
        offers, _user_dim(spark, sf), _station_dim(spark, sf), tariff_dimension(spark, sf), EARLIER
    ).select(
        "offer_id", "user_dwh_id", "station_dwh_id", "created_date_id", "created_time_id",
        "tariff_dwh_id", "status", "ttl_seconds", "is_used", "is_expired_unused",
    )


@query("fact_rejects", """
SELECT rental_id, user_id, r.station_id, 'station' AS missing FROM rentals r
WHERE NOT EXISTS (SELECT 1 FROM stations s WHERE s.station_id = r.station_id AND region <> 'ASIA')""",
    "rentals stations")
def _(spark, sf):
    return facts.fact_rejects(
        src.rentals(spark, sf), _user_dim(spark, sf), _known_stations(spark, sf)
    )


# --- the whole refresh ------------------------------------------------------------------------


# Same figures as the mart on its own, but for what the longer way changes: the cost comes from the
# latest cost snapshot, the audit log is read up to as_of, and open offers past their time expired.
WAREHOUSE_SQL = f"""
WITH paid AS (SELECT r.* EXCLUDE (final_cost), s.cost_amount AS final_cost
              FROM rentals r LEFT JOIN last_snapshot s USING (rental_id)),
lapsed AS (SELECT * REPLACE (CASE WHEN created_at >= TIMESTAMP '{AS_OF}' THEN 'ACTIVE'
                WHEN status = 'ACTIVE' THEN 'EXPIRED' ELSE status END AS status) FROM offers),
daily AS ({VIEWS['daily'].replace('FROM rentals', 'FROM paid').replace('FROM offers', 'FROM lapsed')})
{DAILY_SQL}"""


@query("refresh_warehouse", WAREHOUSE_SQL, "calendar rentals last_snapshot")
def _(spark, sf):
    root = work_dir(spark, "warehouse")
    paths = warehouse.refresh_warehouse(spark, sources(spark, sf), root, src.FIRST_DAY, AS_OF)
    return spark.read.parquet(paths["dm_daily_metrics"])


@query("refresh_warehouse_twice", WAREHOUSE_SQL, "calendar rentals last_snapshot")
def _(spark, sf):
    # The same warehouse in two runs. Rentals started in the last month before the first run were
    # still running then, and the later part of the audit log was not there yet.
    whole, root = sources(spark, sf), work_dir(spark, "warehouse")
    cut, still = ts(EARLIER), ts("2001-06-01")
    early = lambda df, column, at=cut: df.filter(F.col(column) < at)
    late = lambda df, column, at=cut: df.filter(F.col(column) >= at)
    running = late(early(whole.rentals, "started_at"), "started_at", still)
    first = replace(
        whole,
        offers=early(whole.offers, "created_at").withColumn("status", F.lit("ACTIVE")),
        rentals=early(whole.rentals, "started_at", still).unionByName(
            running.withColumn("status", F.lit("ACTIVE")).withColumn(
                "finished_at", F.lit(None).cast("timestamp")
            )
        ),
        cost_snapshots=early(whole.cost_snapshots, "ts", still),
        offer_audit=early(whole.offer_audit, "ts", still),
    )
    second = replace(
        whole,
        offers=late(whole.offers, "created_at").withColumn("status", F.lit("ACTIVE")),
        rentals=late(whole.rentals, "started_at", still),
        cost_snapshots=late(whole.cost_snapshots, "ts", still),
        offer_audit=late(whole.offer_audit, "ts", still),
    )
    warehouse.refresh_warehouse(spark, first, root, src.FIRST_DAY, EARLIER)
    paths = warehouse.refresh_warehouse(spark, second, root, src.FIRST_DAY, AS_OF, since=EARLIER)
    return spark.read.parquet(paths["dm_daily_metrics"])


def in_two_parts(whole: warehouse.Sources) -> tuple[warehouse.Sources, warehouse.Sources]:
    """The same sources in two disjoint parts without regard to time: users, descriptions of stations,
    offers, costs and audit rows come late or before what they belong to. Users are a full snapshot
    each time, the first one incomplete."""
    bucket = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n))
    part = lambda df, key, n, keep: df.filter(bucket(key, n).isin(keep))
    first = replace(
        whole,
        users=part(whole.users, "user_id", 3, [0, 1]),
        stations=part(whole.stations, "station_id", 2, [0]),
        offers=part(whole.offers, "offer_id", 5, [0, 1, 2]),
        rentals=part(whole.rentals, "rental_id", 4, [0, 1, 2]),
        cost_snapshots=part(whole.cost_snapshots, "id", 3, [0]),
        offer_audit=part(whole.offer_audit, "id", 2, [0]),
    )
    second = replace(
        whole,
        offers=part(whole.offers, "offer_id", 5, [3, 4]),
        rentals=part(whole.rentals, "rental_id", 4, [3]),
        cost_snapshots=part(whole.cost_snapshots, "id", 3, [1, 2]),
        offer_audit=part(whole.offer_audit, "id", 2, [1]),
    )
    return first, second


@once_per_session
def late_run(spark, sf) -> str:
    """A warehouse after two runs over disjoint parts of the sources."""
    root = work_dir(spark, "warehouse")
    first, second = in_two_parts(sources(spark, sf))
    warehouse.refresh_warehouse(spark, first, root, src.FIRST_DAY, EARLIER)
    warehouse.refresh_warehouse(spark, second, root, src.FIRST_DAY, AS_OF, since=EARLIER)
    return root


def late_mart(name: str):
    return lambda spark, sf: sinks.read_mart(spark, name, f"{late_run(spark, sf)}/mart")


PAID = "paid AS (SELECT r.* EXCLUDE (final_cost), s.cost_amount AS final_cost FROM rentals r LEFT JOIN last_snapshot s USING (rental_id))"


def over_paid(view: str, *changes: tuple[str, str]) -> str:
    """A mart's view over rentals whose cost is that of the last snapshot."""
    text = VIEWS[view]
    for old, new in (("JOIN rentals r", "JOIN paid r"), ("FROM rentals", "FROM paid"), ("FROM visits", "FROM paid"), *changes):
        text = text.replace(old, new)
    return f"WITH {PAID}, {view} AS ({text})"


query("refresh_warehouse_late", WAREHOUSE_SQL, "calendar rentals last_snapshot")(late_mart("dm_daily_metrics"))
query(
    "refresh_late_station_stats", f"{over_paid('station_stats')} SELECT {STATION_COLUMNS} FROM station_stats",
    "stations rentals last_snapshot",
)(late_mart("dm_station_stats"))
query(
    "refresh_late_revenue_breakdown", f"""{over_paid('breakdown')}
    SELECT {day('date')} AS date, tariff_type, city, rentals_count, {num('revenue')} AS revenue,
           avg_revenue_per_rental, CAST(total_minutes AS BIGINT) AS total_minutes FROM breakdown""",
    "stations rentals last_snapshot tariff_dim",
)(late_mart("dm_revenue_breakdown"))
query(
    "refresh_late_hourly_demand",
    over_paid("hourly", ("2023-12-31", "2001-07-02"), ("2024-01-31", "2001-08-02")) + " SELECT * FROM hourly",
    "rentals last_snapshot",
)(late_mart("dm_hourly_demand"))
query(
    "refresh_late_user_cohorts",
    over_paid("cohorts", ("1996-06-16", "2001-08-02"), ("1995-06-01", "2000-08-01")) + COHORTS_SQL,
    "users rentals last_snapshot",
)(late_mart("dm_user_cohorts"))


@query("refresh_late_fact_rentals", f"""
WITH {PAID}
SELECT rental_id, user_id, md5(station_id) AS station_dwh_id, CAST(strftime(started_at, '%Y%m%d') AS INTEGER) AS start_date_id,
       CAST(strftime(started_at, '%H%M%S') AS INTEGER) AS start_time_id,
       CAST(strftime(finished_at, '%Y%m%d') AS INTEGER) AS end_date_id, minutes AS duration_minutes,
       {num('final_cost')} AS final_cost, status, status = 'FINISHED' AS is_completed, status = 'CANCELLED' AS is_cancelled
FROM paid""", "rentals last_snapshot")
def _(spark, sf):
    return spark.read.parquet(f"{late_run(spark, sf)}/dds/fact_rentals").select(
        "rental_id", "user_id", "station_dwh_id", "start_date_id", "start_time_id", "end_date_id",
        "duration_minutes", "final_cost", "status", "is_completed", "is_cancelled",
    )


@query("refresh_late_fact_offers", f"""
SELECT offer_id, user_id, md5(station_id) AS station_dwh_id, CAST(strftime(created_at, '%Y%m%d') AS INTEGER) AS created_date_id,
       CASE WHEN created_at >= TIMESTAMP '{AS_OF}' THEN 'ACTIVE' WHEN status = 'ACTIVE' THEN 'EXPIRED' ELSE status END AS status
FROM offers""", "offers")
def _(spark, sf):
    stored = spark.read.parquet(f"{late_run(spark, sf)}/dds/fact_offers")
    return warehouse.expire_open_offers(stored, AS_OF).select(
        "offer_id", "user_id", "station_dwh_id", "created_date_id", "status"
    )


SNAPSHOT_DAYS = ["1995-06-01", "1997-01-01", "1998-07-01", "2000-02-01"]
ARRIVALS = [1, 3, 0, 2]  # the order in which the snapshots come


def user_snapshots(spark, sf) -> list:
    """Four snapshots of all users: phones appear and disappear, some are blocked for a while, and a user is in no
    snapshot before the number of their key allows."""
    users, number = src.users(spark, sf), F.col("user_id").cast("long")
    return [
        users.filter(number % 4 <= n).withColumn(
            "phone", F.when((number + n) % 3 == 0, F.concat(F.lit("+7"), F.col("user_id")))
        ).withColumn("status", F.when((number + 2 * n) % 5 == 0, "BLOCKED").otherwise("ACTIVE"))
        for n in range(len(SNAPSHOT_DAYS))
    ]


def versions_sql(*known: int) -> str:
    """What the given snapshots say about every user, equal neighbours merged."""
    days = ", ".join(f"({n}, TIMESTAMP '{SNAPSHOT_DAYS[n]}')" for n in known)
    return f"""
SELECT user_id, phone, status, {moment('seen_at')} AS valid_from,
       {moment("coalesce(lead(seen_at) OVER (PARTITION BY user_id ORDER BY seen_at), TIMESTAMP '9999-12-31')")} AS valid_to
FROM (SELECT *, lag(said) OVER (PARTITION BY user_id ORDER BY seen_at) AS before
      FROM (SELECT *, coalesce(phone, '') || status AS said
            FROM (SELECT CAST(c_custkey AS VARCHAR) AS user_id, seen_at,
                         CASE WHEN (c_custkey + n) % 3 = 0 THEN '+7' || c_custkey END AS phone,
                         CASE WHEN (c_custkey + 2 * n) % 5 = 0 THEN 'BLOCKED' ELSE 'ACTIVE' END AS status
                  FROM customer, (VALUES {days}) AS d(n, seen_at) WHERE c_custkey % 4 <= n)))
WHERE before IS NULL OR before <> said"""


@once_per_session
def user_history(spark, sf) -> str:
    """Snapshots loaded out of order, each a day after the other from 2001-01-01 on."""
    path, made = work_dir(spark, "bitemporal"), user_snapshots(spark, sf)
    for place, n in enumerate(ARRIVALS):
        seen = [
            made[m].select("user_id", ts(SNAPSHOT_DAYS[m]).alias("seen_at")) for m in ARRIVALS[:place]
        ]
        earlier = None
        for more in seen:
            earlier = more if earlier is None else earlier.unionByName(more)
        bitemporal.load_snapshot(spark, path, made[n], SNAPSHOT_DAYS[n], f"2001-01-{place + 1:02d}", earlier)
    return path


USER_VERSION = ["user_id", "phone", "status", "valid_from", "valid_to"]


@query("bitemporal_users", versions_sql(0, 1, 2, 3))
def _(spark, sf):
    return bitemporal.known_at(spark.read.parquet(user_history(spark, sf))).select(*USER_VERSION)


@query("bitemporal_users_known_before", versions_sql(1, 3))
def _(spark, sf):
    # What was known when two of the four snapshots had come.
    dim = spark.read.parquet(user_history(spark, sf))
    return bitemporal.known_at(dim, "2001-01-02 12:00:00").select(*USER_VERSION)


@query("refresh_checks", """
SELECT check_name, table_name, 'rows' AS key, CAST(n AS VARCHAR) AS observed, '0' AS expected,
       n = 0 AS passed
FROM (SELECT 'quarantine' AS check_name, 'rentals' AS table_name, count(*) AS n FROM rentals
      WHERE split_part(rental_id, '-', 2) = '6'
      UNION ALL SELECT 'waiting', 'fact_rentals', count(*) FROM rentals
      WHERE split_part(rental_id, '-', 2) <> '6' AND CAST(user_id AS INTEGER) % 10 = 0
      UNION ALL SELECT 'waiting', 'fact_offers', count(*) FROM offers
      WHERE CAST(user_id AS INTEGER) % 10 = 0)""", "rentals")
def _(spark, sf):
    # Planted faults: rentals with an odd status, and users that never come.
    root, whole = work_dir(spark, "warehouse"), sources(spark, sf)
    odd = F.element_at(F.split("rental_id", "-"), 2) == "6"
    faulty = replace(
        whole,
        users=whole.users.filter(F.col("user_id").cast("int") % 10 != 0),
        rentals=whole.rentals.withColumn("status", F.when(odd, "LOST").otherwise(F.col("status"))),
    )
    warehouse.refresh_warehouse(spark, faulty, root, src.FIRST_DAY, AS_OF, checked=True)
    found = spark.read.parquet(f"{root}/dq").filter(
        F.col("check_name").isin("quarantine", "waiting")
        & F.col("table_name").isin("rentals", "fact_rentals", "fact_offers")
    )
    return found.drop("checked_at")


def sources(spark, sf) -> warehouse.Sources:
    rentals = src.rentals(spark, sf).select(
        "rental_id", "offer_id", "user_id", "station_id", "started_at", "finished_at", "status",
        F.lit(None).cast("string").alias("tariff_version"),
    )
    return warehouse.Sources(
        users=src.users(spark, sf),
        segments=src.segments(spark, sf),
        offers=src.offers(spark, sf),
        rentals=rentals,
        cost_snapshots=src.cost_snapshots(spark, sf),
        offer_audit=src.offer_audit(spark, sf),
        stations=src.station_directory(spark, sf),
    )


@query("refresh_from_shards", WAREHOUSE_SQL, "calendar rentals last_snapshot")
def _(spark, sf):
    # Two runs, neither of which is told what the other has loaded.
    whole, root = sources(spark, sf), work_dir(spark, "warehouse")
    path = work_dir(spark, "shards")
    snapshot = F.lit(None).cast("string")
    tables = {
        "offers": whole.offers, "rentals": whole.rentals.withColumn("tariff_snapshot", snapshot),
        "cost_snapshots": whole.cost_snapshots.withColumn("details", snapshot), "offer_audit": whole.offer_audit,
    }
    for name, df in tables.items():
        key = "offer_id" if "offer_id" in df.columns else "rental_id"
        df.withColumn("shard", F.pmod(F.xxhash64(key), F.lit(2))).write.partitionBy("shard").parquet(f"{path}/{name}")
    for as_of in (EARLIER, AS_OF):
        paths = warehouse.refresh_from_shards(
            spark, path, whole.users, whole.segments, whole.stations, root, src.FIRST_DAY, as_of
        )
    return spark.read.parquet(paths["dm_daily_metrics"])
