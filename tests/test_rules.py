"""Hand-made edge cases of the business rules."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from voltmart.functions import scalar
from voltmart.operators import pricing, rentals
from pyspark.sql import functions as F

OFFER = "offer_id string, user_id string, station_id string, status string, expires_at timestamp"
ATTEMPT = "attempt_id string, offer_id string, user_id string, ts timestamp"


def as_dict(df, key, value):
    return {row[key]: row[value] for row in df.collect()}


def test_active_offers_keeps_only_the_valid_one(make):
    offers = make(
        "offer_id string, user_id string, created_at timestamp, expires_at timestamp, status string",
        [
            ("valid", "u", "2024-01-01 12:00:00", "2024-01-01 12:05:00", "ACTIVE"),
            ("lapsed", "u", "2024-01-01 11:00:00", "2024-01-01 11:05:00", "ACTIVE"),
            ("used", "u", "2024-01-01 12:00:00", "2024-01-01 12:05:00", "USED"),
            ("edge", "u", "2024-01-01 11:56:00", "2024-01-01 12:01:00", "ACTIVE"),
        ],
    )
    found = pricing.active_offers(offers, "2024-01-01 12:01:00")
    assert [row.offer_id for row in found.collect()] == ["valid"]


def test_active_offers_newest_first(make):
    rows = [(f"o{i}", "u", f"2024-01-01 12:0{i}:00", "2024-01-01 13:00:00", "ACTIVE") for i in range(4)]
    offers = make(
        "offer_id string, user_id string, created_at timestamp, expires_at timestamp, status string", rows
    )
    found = pricing.active_offers(offers, "2024-01-01 12:30:00")
    assert [row.offer_id for row in found.collect()] == ["o3", "o2", "o1", "o0"]


REQUEST = ("offer_id string, user_id string, station_id string, user_segment string, "
           "requested_at timestamp")
TARIFF = ("tariff_id string, station_id string, segment string, base_rate double, "
          "segment_multiplier double, currency string, version string")


@pytest.fixture
def tariffs(make):
    return make(
        TARIFF,
        [
            ("t1", "station-001", "STANDARD", 5.0, 1.0, "RUB", "v1"),
            ("t2", "station-001", "VIP", 4.0, 0.5, "RUB", "v1"),
            ("t3", "station-002", "VIP", 6.0, 0.5, "RUB", "v1"),
        ],
    ).withColumn("rules", F.create_map(F.lit("type"), F.lit("regular")))


def test_pricing(make, tariffs):
    users = make("user_id string, segment string", [("plain", None), ("vip", "VIP")])
    at = "2024-01-01 12:00:00"
    requests = make(
        REQUEST,
        [
            ("default", "plain", "station-001", None, at),
            ("own", "vip", "station-001", None, at),
            ("asked", "vip", "station-001", "STANDARD", at),
            ("stranger", "nobody", "station-001", None, at),
            ("stranger-asked", "nobody", "station-001", "VIP", at),
            ("bare", "nobody", "station-009", None, at),
            ("no-tariff", "plain", "station-002", None, at),
        ],
    )
    offers = {r.offer_id: r for r in pricing.price_offers(requests, users, tariffs).collect()}
    rates = {k: r.estimated_rate_per_minute for k, r in offers.items()}
    assert rates == {
        "default": 5.0, "own": 2.0, "asked": 5.0, "stranger": 5.0, "stranger-asked": 2.0, "bare": 22.5
    }
    assert offers["bare"].tariff_version == "greedy-v1"
    assert '"is_greedy":true' in offers["bare"].tariff_snapshot
    assert '"segment":"GREEDY"' in offers["stranger"].tariff_snapshot
    assert '"segment":"STANDARD"' in offers["default"].tariff_snapshot
    assert offers["own"].expires_at - offers["own"].created_at == timedelta(seconds=300)
    rejects = pricing.price_rejects(requests, users, tariffs).collect()
    assert [(r.offer_id, r.reason) for r in rejects] == [("no-tariff", "TARIFF_NOT_FOUND")]


def test_ttl_is_configurable(make, tariffs):
    users = make("user_id string, segment string", [("vip", "VIP")])
    requests = make(REQUEST, [("o", "vip", "station-001", None, "2024-01-01 12:00:00")])
    offer = pricing.price_offers(requests, users, tariffs, ttl_seconds=60).first()
    assert offer.expires_at == datetime(2024, 1, 1, 12, 1)


def test_offer_use_order_of_checks(make):
    end = "2024-01-01 12:05:00"
    offers = make(
        OFFER,
        [
            ("used", "u", "s", "USED", end), ("open", "u", "s", "ACTIVE", end),
            ("gone", "u", "s", "CANCELLED", end), ("late", "u", "s", "ACTIVE", end),
        ],
    )
    attempts = make(
        ATTEMPT,
        [
            ("1", "used", "stranger", "2024-01-01 12:01:00"),
            ("2", "used", "u", "2024-01-01 12:01:00"),
            ("3", "open", "stranger", "2024-01-01 12:00:30"),
            ("4", "open", "u", "2024-01-01 12:01:00"),
            ("5", "open", "u", "2024-01-01 12:01:00"),
            ("6", "open", "u", "2024-01-01 12:09:00"),
            ("7", "gone", "u", "2024-01-01 12:01:00"),
            ("8", "late", "u", "2024-01-01 12:05:00"),
            ("9", "none", "u", "2024-01-01 12:01:00"),
        ],
    )
    assert as_dict(pricing.classify_offer_use(offers, attempts), "attempt_id", "outcome") == {
        "1": "NOT_FOUND", "2": "ALREADY_USED", "3": "NOT_FOUND", "4": "USED", "5": "ALREADY_USED",
        "6": "ALREADY_USED", "7": "EXPIRED", "8": "EXPIRED", "9": "NOT_FOUND",
    }


def test_billing_minutes(make):
    start = "2024-01-01 12:00:00"
    rows = make(
        "seconds int, started_at timestamp, finished_at timestamp",
        [(0, start, start), (1, start, "2024-01-01 12:00:01"), (60, start, "2024-01-01 12:01:00"),
         (61, start, "2024-01-01 12:01:01"), (-1, start, None)],
    )
    minutes = rows.withColumn("m", scalar.minutes_between("started_at", "finished_at"))
    assert as_dict(minutes, "seconds", "m") == {0: 0, 1: 1, 60: 1, 61: 2, -1: None}


def test_cost(make):
    rows = make(
        "rental_id string, started_at timestamp, finished_at timestamp, tariff_snapshot string",
        [
            ("five", "2024-01-01 12:00:00", "2024-01-01 12:10:00", '{"base_rate": 5.0}'),
            ("other keys", "2024-01-01 12:00:00", "2024-01-01 12:10:00",
             '{"initial_fee": 10, "per_minute": 1}'),
            ("running", "2024-01-01 12:00:00", None, '{"base_rate": 0.1}'),
        ],
    )
    cost = as_dict(rentals.rental_cost(rows), "rental_id", "final_cost")
    assert cost == {"five": Decimal(100), "other keys": Decimal(50), "running": None}
    now = as_dict(rentals.current_cost(rows, "2024-01-01 12:03:00"), "rental_id", "current_cost")
    assert now == {"five": Decimal(100), "other keys": Decimal(50), "running": Decimal("50.3")}


def test_finish_order_of_checks(make):
    known = make(
        "rental_id string, user_id string, status string",
        [("r", "u", "ACTIVE"), ("done", "u", "FINISHED")],
    )
    requests = make(
        "request_id string, rental_id string, user_id string, ts timestamp",
        [
            ("1", "none", "u", "2024-01-01 12:00:00"), ("2", "r", "x", "2024-01-01 12:00:00"),
            ("3", "done", "x", "2024-01-01 12:00:00"), ("4", "done", "u", "2024-01-01 12:00:00"),
            ("5", "r", "u", "2024-01-01 12:01:00"), ("6", "r", "u", "2024-01-01 12:02:00"),
            ("7", "r", None, "2024-01-01 12:00:00"), ("8", "done", None, "2024-01-01 12:00:00"),
        ],
    )
    assert as_dict(rentals.classify_finish(known, requests), "request_id", "outcome") == {
        "1": "NOT_FOUND", "2": "USER_MISMATCH", "3": "USER_MISMATCH", "4": "ALREADY_FINISHED",
        "5": "OK", "6": "ALREADY_FINISHED", "7": "USER_MISMATCH", "8": "USER_MISMATCH",
    }


def test_finish_requests_are_read_once(spark, tmp_path):
    """Winners and outcomes come from one join of requests and rentals, not from one each."""
    spark.range(400).selectExpr(
        "cast(id as string) as request_id", "cast(id % 90 as string) as rental_id", "cast(id % 7 as string) as user_id",
        "timestamp_seconds(id) as ts",
    ).write.parquet(f"{tmp_path}/requests")
    spark.range(80).selectExpr(
        "cast(id as string) as rental_id", "cast(id % 7 as string) as user_id", "'ACTIVE' as status"
    ).write.parquet(f"{tmp_path}/rentals")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    found = rentals.classify_finish(spark.read.parquet(f"{tmp_path}/rentals"), spark.read.parquet(f"{tmp_path}/requests"))
    assert len(found.collect()) == 400
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # One of them for requests without a rental, which are not shuffled.
    assert plan.count("FileScan parquet [request_id") == 2, plan
    assert plan.count("ReusedExchange") == 2, plan


def test_attempts_are_shuffled_once(spark, tmp_path):
    """Winners and outcomes come from one shuffle of the attempts, and only burnt offers meet the claims granted."""
    spark.range(400).selectExpr(
        "cast(id as string) as attempt_id", "if(id % 50 = 0, null, cast(id % 90 as string)) as offer_id",
        "cast(id % 7 as string) as user_id", "timestamp_seconds(id) as ts",
    ).write.parquet(f"{tmp_path}/attempts")
    spark.range(80).selectExpr(
        "cast(id as string) as offer_id", "cast(id % 7 as string) as user_id", "'s' as station_id", "'ACTIVE' as status",
        "timestamp_seconds(1000) as expires_at",
    ).write.parquet(f"{tmp_path}/offers")
    offers, attempts = spark.read.parquet(f"{tmp_path}/offers"), spark.read.parquet(f"{tmp_path}/attempts")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    used = pricing.classify_offer_use(offers, attempts)
    outcomes = {r.attempt_id: r.outcome for r in used.collect()}
    plan = used._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finishes = offers.selectExpr("offer_id", "timestamp_seconds(2000) as finished_at")
    played = rentals.replay_rentals(attempts, offers, finishes)
    counted = len(played.collect())
    final = played._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(outcomes) == counted == 400 and outcomes["0"] == outcomes["50"] == "NOT_FOUND"
    # Once for attempts with an offer and once for those without, which are not shuffled.
    assert plan.count("FileScan parquet [attempt_id") == 2 and plan.count("ReusedExchange") >= 1, plan
    # The last join reads burnt offers only.
    assert "EqualTo(outcome,USED)" in final, final


def test_double_start_burns_the_offer(make):
    offers = make(OFFER, [(f"o{i}", "u", "s", "ACTIVE", "2024-01-02 00:00:00") for i in range(3)])
    attempts = make(
        ATTEMPT, [(f"a{i}", f"o{i}", "u", f"2024-01-01 12:0{i}:00") for i in range(3)]
    )
    finishes = make("offer_id string, finished_at timestamp", [("o0", "2024-01-01 12:02:00")])
    played = rentals.replay_rentals(attempts, offers, finishes)
    assert as_dict(played, "attempt_id", "outcome") == {
        "a0": "STARTED", "a1": "USER_ALREADY_RENT", "a2": "STARTED"
    }
    assert as_dict(played, "attempt_id", "offer_burnt") == {"a0": True, "a1": True, "a2": True}


def walk(claims):
    """One at a time per user, in order: what the replay must give."""
    granted, free = set(), {}
    for claim, user, ts, ends in sorted(claims, key=lambda c: (c[2], c[0])):
        if user not in free or ts >= free[user]:
            granted.add(claim)
            free[user] = ends
    return granted


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_replay_of_a_hot_user_matches_a_walk(spark, seed):
    """One user holds most attempts, some instant, many at the same second."""
    dice = random.Random(seed)
    start = datetime(2024, 1, 1)
    claims = []
    for i in range(900):
        user = "hot" if dice.random() < 0.7 else f"u{dice.randrange(20)}"
        ts = start + timedelta(seconds=dice.randrange(0, 200_000, 500))
        claims.append((f"c{i:04d}", user, ts, ts + timedelta(seconds=dice.choice([0, 400, 2_000, 30_000]))))
    df = spark.createDataFrame(claims, "claim_id string, user_id string, ts timestamp, ends_at timestamp")
    got = {row.claim_id for row in rentals._accepted_ids(df).collect()}
    assert got == walk(claims)


def test_shard_of_the_sample_user(make):
    user = "550e8400-e29b-41d4-a716-446655440000"
    digest = int("ae93f97d9e521ceb42bf450c3ac7dd7a", 16)
    df = make("user_id string", [(user,)])
    for shards in (2, 3, 7, 1000, 2**30 - 1):
        assert df.select(scalar.shard_of(F.col("user_id"), shards)).first()[0] == digest % shards


def test_canonical_uuid(make):
    df = make("u string", [("550E8400E29B41D4A716446655440000",), ("550e8400-e29b-41d4-a716-446655440000",)])
    assert {r[0] for r in df.select(scalar.canonical_uuid("u")).collect()} == {
        "550e8400-e29b-41d4-a716-446655440000"
    }
