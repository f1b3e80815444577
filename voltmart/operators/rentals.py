"""Rental life cycle over whole tables: replay, finish checks, cost, payments."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from voltmart.functions.scalar import json_field, minutes_between, rental_charge, to_money
from voltmart.operators.pricing import classify_offer_use
from voltmart.operators.timeline import first_following, with_prior_max
from voltmart.schemas import OPEN_END
from voltmart.session import cut_lineage


def _base_rate():
    return json_field("tariff_snapshot", "$.base_rate").cast("double")


def rental_cost(df: DataFrame) -> DataFrame:
    """Final cost of finished rentals: fee plus base rate per billing minute, NULL before."""
    minutes = minutes_between("started_at", "finished_at")
    return df.withColumn("calculated_minutes", minutes).withColumn(
        "final_cost", rental_charge(_base_rate(), minutes)
    )


def current_cost(df: DataFrame, as_of: str) -> DataFrame:
    """What the rental costs at as_of; finished rentals keep their final minutes."""
    until = F.coalesce(F.col("finished_at"), F.lit(as_of).cast("timestamp"))
    return df.withColumn(
        "current_cost", rental_charge(_base_rate(), minutes_between("started_at", until))
    )


def quote_gap(df: DataFrame) -> DataFrame:
    """Per rental: what the quoted rate (with multiplier) implies against what is charged.

    The quote has no fixed fee and the charge no multiplier, so both differ.
    """
    minutes = minutes_between("started_at", "finished_at")
    base = to_money(_base_rate())
    multiplier = to_money(json_field("tariff_snapshot", "$.segment_multiplier").cast("double"))
    quoted = (base * multiplier * minutes).cast("decimal(18,4)")
    charged = rental_charge(_base_rate(), minutes)
    return df.filter(F.col("finished_at").isNotNull()).select(
        "rental_id",
        quoted.alias("quoted_cost"),
        charged.alias("charged_cost"),
        (charged - quoted).cast("decimal(18,4)").alias("gap"),
    )


def classify_finish(rentals: DataFrame, requests: DataFrame) -> DataFrame:
    """Outcome of each finish request (request_id, rental_id, user_id, ts).

    Missing rental, foreign rental, already finished, else OK; the earliest passing request
    finishes the rental. A request without a user is foreign to a rental that has one.
    """
    known = rentals.select(
        "rental_id", F.col("user_id").alias("_owner"), "status", F.lit(True).alias("_known")
    )
    named = F.col("rental_id").isNotNull()
    asked = requests.filter(named).join(known, "rental_id", "left")
    own = F.col("_owner").eqNullSafe(F.col("user_id"))
    passing = F.col("_known") & own & ~F.col("status").eqNullSafe("FINISHED")
    order = F.struct("ts", "request_id")
    # `asked` has no NULL keys and winners are not filtered before: both its readers then have the same plan,
    # and it is shuffled once.
    winners = asked.groupBy("rental_id").agg(F.min(F.when(passing, order)).alias("_winner"))
    outcome = (
        F.when(F.col("_known").isNull(), "NOT_FOUND")
        .when(~own, "USER_MISMATCH")
        .when(F.col("status") == "FINISHED", "ALREADY_FINISHED")
        .when(order == F.col("_winner"), "OK")
        .otherwise("ALREADY_FINISHED")
    )
    columns = ["request_id", "rental_id", "user_id", "ts"]
    nameless = requests.filter(~named).select(*columns, F.lit("NOT_FOUND").alias("outcome"))
    return asked.join(winners, "rental_id", "left").select(*columns, outcome.alias("outcome")).union(nameless)


def outbox_pending(outbox: DataFrame, snapshots: DataFrame, as_of: str) -> DataFrame:
    """Unprocessed payments with age, against the rental's latest cost snapshot."""
    latest = snapshots.groupBy("rental_id").agg(
        F.max_by("cost_amount", F.struct("ts", "id")).alias("snapshot_cost")
    )
    age = F.unix_seconds(F.lit(as_of).cast("timestamp")) - F.unix_seconds("created_at")
    return (
        outbox.filter(~F.col("processed"))
        .join(latest, "rental_id", "left")
        .select(
            "id", "rental_id", "amount", age.alias("age_seconds"), "snapshot_cost",
            (F.col("amount") - F.col("snapshot_cost")).cast("decimal(18,4)").alias("difference"),
        )
    )


def _accepted_ids(claims: DataFrame) -> DataFrame:
    """Claims (claim_id, user_id, ts, ends_at) granted when taken in order, one at a time.

    A claim is granted when its user holds nothing at its time. Where every earlier claim of the
    user has ended, it is granted whatever happened before: a root. Only claims in between depend
    on their predecessors. Each claim points to the first claim it does not block; the granted ones
    are the roots and what can be reached from them. Reachability is found by doubling the pointers
    among dependent claims, so its rounds grow with the logarithm of the longest chain between two
    roots, they touch dependent claims only, and no user's history is ever walked by one task.
    """
    claims = with_prior_max(claims, "user_id", "ts", "claim_id", "ends_at", "_busy_until")
    free_before = F.col("_busy_until").isNull() | (F.col("_busy_until") <= F.col("ts"))
    claims = cut_lineage(claims.withColumn("root", free_before).drop("_busy_until"))
    # An instant claim blocks nobody: the next one in order follows it.
    ends = claims.select(
        "claim_id", "user_id", "ends_at", "root",
        F.when(F.col("ends_at") == F.col("ts"), F.col("claim_id")).alias("_after"),
    )
    pointers = first_following(
        ends, claims, "user_id", "ends_at", "_after", "ts", "claim_id", ["claim_id", "root"]
    )
    to_dependent = cut_lineage(
        pointers.filter(~F.col("next_root")).select("claim_id", "root", "next_claim_id")
    )
    target = F.col("next_claim_id").alias("claim_id")
    reached = to_dependent.filter("root").select(target).distinct()
    edges = to_dependent.filter(~F.col("root")).drop("root")
    while not edges.isEmpty():
        step = edges.join(reached, "claim_id", "left_semi").select(target)
        reached = cut_lineage(reached.union(step).distinct())
        onward = edges.select(
            F.col("claim_id").alias("next_claim_id"), F.col("next_claim_id").alias("_far")
        )
        edges = cut_lineage(
            edges.join(onward, "next_claim_id").select(
                "claim_id", F.col("_far").alias("next_claim_id")
            )
        )
    return claims.filter("root").select("claim_id").union(reached)


def replay_rentals(attempts: DataFrame, offers: DataFrame, finishes: DataFrame) -> DataFrame:
    """Outcome of each start attempt when a user may hold one rental at a time.

    attempts (attempt_id, offer_id, user_id, ts), finishes (offer_id, finished_at): when the rental
    made from that offer is handed back, if it is made. Using the offer happens first and is not
    undone, so an attempt refused later has still burnt it.
    """
    used = classify_offer_use(offers, attempts)
    ends = finishes.groupBy("offer_id").agg(F.min("finished_at").alias("finished_at"))
    attempted = cut_lineage(used.join(ends, "offer_id", "left"))
    burnt = F.col("outcome") == "USED"
    has_station = F.coalesce(F.col("station_id") != "", F.lit(False))
    # Without a station nothing is rented: the claim is instant and blocks nobody.
    claims = attempted.filter(burnt).select(
        F.col("attempt_id").alias("claim_id"),
        "user_id",
        "ts",
        F.when(has_station, F.greatest(
            F.coalesce("finished_at", F.lit(OPEN_END).cast("timestamp")), F.col("ts")
        )).otherwise(F.col("ts")).alias("ends_at"),
    )
    granted = _accepted_ids(claims).select(
        F.col("claim_id").alias("attempt_id"), F.lit(True).alias("_granted")
    )
    result = (
        F.when(F.col("_granted").isNull(), "USER_ALREADY_RENT")
        .when(~has_station, "STATION_MISSING")
        .otherwise("STARTED")
    )
    columns = ["attempt_id", "offer_id", "user_id", "ts"]
    # Only attempts that burnt their offer, one per offer, meet the claims; the others are judged already.
    refused = attempted.filter(~burnt).select(
        *columns, "outcome", F.lit(False).alias("offer_burnt"),
        F.lit(None).cast(attempted.schema["finished_at"].dataType).alias("finished_at"),
    )
    started = attempted.filter(burnt).join(granted, "attempt_id", "left").select(
        *columns, result.alias("outcome"), F.lit(True).alias("offer_burnt"),
        F.when(result == "STARTED", F.col("finished_at")).alias("finished_at"),
    )
    return started.union(refused)
