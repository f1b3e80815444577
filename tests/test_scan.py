"""Running values: ranges of busy keys give what one window gives."""

import random
import time

import pytest
from pyspark.sql import functions as F

from voltmart.operators import aggregates, rentals, timeline
from voltmart.operators.scan import last_known, running_count, running_max, running_sum, running_xor, scan
from voltmart.session import cut_lineage


def all_folds():
    return {
        "n": running_count(), "total": running_sum(F.col("v")), "top": running_max(F.col("v")),
        "known": last_known(F.col("v")), "mix": running_xor(F.xxhash64("id")),
    }


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.collect())


def lines(spark, count=600):
    dice = random.Random(3)
    rows = [(dice.choice(["hot", "hot", "hot", "x", None, "y"]), dice.randrange(40), i,
             dice.choice([None, dice.randrange(-50, 50)])) for i in range(count)]
    return spark.createDataFrame(rows, "k string, at int, id int, v int")


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("keys", [["k"], ["k", "at"], []])
def test_ranges_equal_one_window(spark, inclusive, keys):
    df = lines(spark)
    order = [F.desc("at"), F.asc("id")]
    plain = scan(df, keys, order, all_folds(), inclusive)
    cut = scan(df, keys, order, all_folds(), inclusive, most=9)
    assert "_range" not in str(plain.columns) and plain.columns == cut.columns
    assert rows_of(plain) == rows_of(cut)


def test_empty_table(spark):
    df = lines(spark).limit(0)
    assert scan(df, ["k"], [F.asc("id")], all_folds()).collect() == []
    assert scan(df, [], [F.asc("id")], all_folds()).collect() == []


def test_timelines_of_busy_keys(spark):
    df = lines(spark).withColumn("id", F.format_string("%05d", "id"))
    for call in (timeline.with_next, timeline.with_prior_max):
        slim, wide = [call(df, "k", "at", "id", "v", "out", most=most) for most in (7, 10_000)]
        assert rows_of(slim) == rows_of(wide)
    probes = df.selectExpr("id as p", "k", "at", "if(v > 0, id, null) as after")
    slim, wide = [
        timeline.first_following(probes, df, "k", "at", "after", "at", "id", ["id", "v"], most=most)
        for most in (7, 10_000)
    ]
    assert rows_of(slim) == rows_of(wide)


def test_rank_over_many_values(spark):
    df = spark.range(500).select("id", F.when(F.col("id") % 50 > 0, F.pmod(F.xxhash64("id"), F.lit(200))).alias("v"))
    got = {r.id: (r.v, r["rank"]) for r in aggregates.rank_desc(df, "v", "rank", most=10).collect()}
    values = [v for v, _ in got.values()]
    place = lambda v: 1 + sum(w is not None and (v is None or w > v) for w in values)
    assert all(rank == place(v) for v, rank in got.values())


def test_every_range_holds_a_bounded_share_of_a_busy_key(spark):
    """A key whose rows share one instant is still cut evenly: the ranges follow the order, not the clock."""
    df = spark.range(40_000).select(F.lit("hot").alias("k"), F.lit(0).alias("at"), F.col("id"))
    dealt = df.repartitionByRange(20, "k", "at", "id").groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in dealt.collect()) < 3 * 40_000 / 20
    out = scan(df, ["k"], [F.asc("at"), F.asc("id")], {"n": running_count()}, most=4_000)
    assert out.filter(F.col("n") != F.col("id") + 1).isEmpty()


def test_a_third_of_the_rows_in_one_hour_costs_little_more(spark):
    count = 300_000
    flat = cut_lineage(spark.range(count).selectExpr("cast(id % 5000 as string) k", "cast(id as int) at", "id", "id v"))
    hot = cut_lineage(flat.withColumn("k", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("k"))))

    def seconds(df):
        started = time.time()
        timeline.with_next(df, "k", "at", "id", "v", "out", most=25_000).write.format("noop").mode("overwrite").save()
        return time.time() - started

    seconds(flat)
    assert seconds(hot) < 2 * seconds(flat) + 4  # the fixed cost of a few small jobs


def test_replay_with_busy_users_equals_plain(spark):
    dice = random.Random(9)
    claims = [(f"c{i:04d}", dice.choice(["u", "u", "v", "w"]), dice.randrange(600), dice.randrange(1, 40)) for i in range(400)]
    df = spark.createDataFrame(claims, "claim_id string, user_id string, s int, d int").selectExpr(
        "claim_id", "user_id", "timestamp_seconds(s) ts", "timestamp_seconds(s + d) ends_at")
    got = {r[0] for r in rentals._accepted_ids(df).collect()}
    expected, busy = set(), {}
    for name, user, start, lasts in sorted(claims, key=lambda c: (c[2], c[0])):
        if busy.get(user, -1) <= start:
            expected.add(name)
            busy[user] = start + lasts
    assert got == expected
