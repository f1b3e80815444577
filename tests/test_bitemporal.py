"""Versions in two times: any order of arrival ends in one dimension, and every load stays readable."""

import random

import pytest
from pyspark.sql import functions as F

from voltmart.operators import bitemporal, dims
from voltmart.session import cut_lineage, work_dir

USER = "user_id string, email string, phone string, status string"
END = "9999-12-31 00:00:00"


def at(day):
    return f"2024-01-{day:02d} 00:00:00"


SNAPSHOTS = {
    1: [("a", "e", None, "ACTIVE"), ("b", "e", "1", "ACTIVE"), ("c", "e", "1", "ACTIVE")],
    2: [("a", "e", "7", "ACTIVE"), ("b", "e", "1", "ACTIVE"), ("c", "e", "2", "ACTIVE"), ("late", "x", None, None)],
    3: [("a", "e", None, "ACTIVE"), ("b", "e", "1", "BLOCKED"), ("late", "x", None, None)],
    4: [("a", "e", None, "BLOCKED"), ("b", "e", "1", "ACTIVE"), ("c", "e", "1", "ACTIVE"), ("late", "y", None, None), (None, "n", "n", "n")],
}


def timeline(snapshots):
    """What snapshots say in order of their time, equal neighbours merged."""
    out = set()
    for key in {r[0] for rows in snapshots.values() for r in rows if r[0] is not None}:
        seen = sorted((day, r[1:]) for day, rows in snapshots.items() for r in rows if r[0] == key)
        kept = [o for i, o in enumerate(seen) if not i or o[1] != seen[i - 1][1]]
        for i, (day, said) in enumerate(kept):
            out.add((key, *said, at(day), at(kept[i + 1][0]) if i + 1 < len(kept) else END))
    return out


def seen_by(spark, days):
    rows = [(r[0], at(day)) for day in days for r in SNAPSHOTS[day] if r[0] is not None]
    return spark.createDataFrame(rows, "user_id string, t string").select("user_id", F.to_timestamp("t").alias("seen_at"))


def plain(df):
    text = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("valid_from", "valid_to")]
    return [tuple(r) for r in df.select("user_id", "email", "phone", "status", *text).collect()]


def arrive(spark, make, order, path):
    for number, day in enumerate(order):
        bitemporal.load_snapshot(
            spark, path, make(USER, SNAPSHOTS[day]), at(day), at(10 + number), seen_by(spark, order[:number] or [day]))
    return spark.read.parquet(path)


@pytest.mark.parametrize("order", [(4, 3, 2, 1), (2, 4, 1, 3)])
def test_any_order_of_arrival_gives_one_dimension(spark, make, order):
    path = work_dir(spark, "test")
    dim = arrive(spark, make, order, path)
    got = plain(bitemporal.known_at(dim))
    assert len(got) == len(set(got)) and set(got) == timeline(SNAPSHOTS)
    times = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in bitemporal.PERIOD]
    rows = [tuple(r) for r in dim.select("user_id", "email", "phone", "status", *times).collect()]
    for number in range(len(order)):
        # What was known after each load is what the snapshots so far say.
        known = [r[:6] for r in rows if r[6] <= at(10 + number) < r[7]]
        assert sorted(known, key=str) == sorted(timeline({day: SNAPSHOTS[day] for day in order[: number + 1]}), key=str)
        # No overlap and no gap: the versions of a key follow each other.
        for key in {r[0] for r in known}:
            spans = sorted(r[4:6] for r in known if r[0] == key)
            assert all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and spans[-1][1] == END
    first = bitemporal.valid_at(bitemporal.known_at(dim, at(10)), at(order[0]))
    assert first.count() == len([r for r in SNAPSHOTS[order[0]] if r[0] is not None])


def test_loading_a_snapshot_again_changes_nothing(spark, make):
    path = work_dir(spark, "test")
    before = sorted(map(str, arrive(spark, make, (1, 3, 2), path).collect()))
    for day in (1, 2, 3):
        bitemporal.load_snapshot(spark, path, make(USER, SNAPSHOTS[day]), at(day), at(20), seen_by(spark, (1, 2, 3)))
    assert sorted(map(str, spark.read.parquet(path).collect())) == before


def test_a_corrected_snapshot_replaces_what_it_said(spark, make):
    path = work_dir(spark, "test")
    dim = arrive(spark, make, (1, 2, 3), path)
    fixed = {1: SNAPSHOTS[1], 2: [("a", "e", None, "ACTIVE"), ("c", "e", "9", "ACTIVE")] + SNAPSHOTS[2][1:2] + SNAPSHOTS[2][3:], 3: SNAPSHOTS[3]}
    dim = bitemporal.load_snapshot(spark, path, make(USER, fixed[2]), at(2), at(15), seen_by(spark, (1, 2, 3)))
    assert set(plain(bitemporal.known_at(dim))) == timeline(fixed)
    assert set(plain(bitemporal.known_at(dim, at(14)))) == timeline({d: SNAPSHOTS[d] for d in (1, 2, 3)})


def test_random_snapshots_in_random_order(spark, make, monkeypatch):
    dice = random.Random(12)
    days = list(range(1, 6))
    made = {d: [(f"u{k}", dice.choice("xy"), None, "ACTIVE") for k in range(25) if dice.random() < 0.8] for d in days}
    monkeypatch.setitem(globals(), "SNAPSHOTS", made)
    order = days[:]
    dice.shuffle(order)
    dim = bitemporal.empty_dimension(make(USER, made[1]))
    for number, day in enumerate(order):
        changes = bitemporal.snapshot_changes(dim, make(USER, made[day]), at(day), at(10 + number), seen_by(spark, order[:number] or [day]))
        closed = changes.filter(F.col("loaded_from") < at(10 + number)).select("user_id", "valid_from", "valid_to", "loaded_from")
        dim = cut_lineage(dim.join(closed, closed.columns, "left_anti").unionByName(changes))
    assert set(plain(bitemporal.known_at(dim))) == timeline(made)


def test_only_buckets_of_changed_users_are_rewritten(spark, make):
    import glob
    import os

    path = work_dir(spark, "test")
    users = [(f"u{i}", "e", None, "ACTIVE") for i in range(300)]
    bitemporal.load_snapshot(spark, path, make(USER, users), at(1), at(10))
    files = lambda: {f: os.path.getmtime(f) for f in glob.glob(f"{path}/bucket=*/*.parquet")}
    before = files()
    assert len({os.path.dirname(f) for f in before}) > 40
    users[7] = ("u7", "new", None, "ACTIVE")
    bitemporal.load_snapshot(spark, path, make(USER, users), at(2), at(11))
    assert 1 <= len(set(files()) - set(before)) <= 2
    assert spark.read.parquet(path).count() == 302


def test_users_do_not_pass_through_the_driver(spark, make, monkeypatch):
    """Small files are no reason to broadcast a row per user: at size they would be collected in the driver."""
    dim = arrive(spark, make, (1, 3), work_dir(spark, "test"))
    plans = []
    look = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(bitemporal, "cut_lineage", lambda df, *label: look(df) or cut_lineage(df, *label))
    look(bitemporal.snapshot_changes(dim, make(USER, SNAPSHOTS[2]), at(2), at(12), seen_by(spark, (1, 3))))
    assert len(plans) == 3 and not any("Broadcast" in plan for plan in plans)
    assert all("SortMergeJoin" in plan for plan in plans)


def test_sweep_finds_the_version_of_a_key_with_most_versions(spark):
    count = 20_000
    versions = spark.range(count).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id % 50 as string)) k", "timestamp_seconds(id * 60) valid_from",
        "timestamp_seconds(id * 60 + 60) valid_to", "id version")
    facts = spark.range(count).selectExpr("if(id % 2 = 0, 'hot', cast(id % 60 as string)) k", "id fact", "timestamp_seconds(id * 61) ts")
    facts = facts.unionByName(spark.createDataFrame([(None, -1, None), ("hot", -2, None)], "k string, fact long, ts string").selectExpr("k", "fact", "cast(ts as timestamp) ts"))
    for most in (1_000, 10**6):
        got = {r.fact: r.version for r in dims.asof_dim(facts, versions, "k", "ts", ["version"], most=most).collect()}
        assert len(got) == count + 2 and got[-1] is None and got[-2] is None
        for fact in range(0, count, 997):
            key = "hot" if fact % 2 == 0 else str(fact % 60)
            v = fact * 61 // 60
            theirs = "hot" if v % 3 == 0 else str(v % 50)
            assert got[fact] == (v if v < count and theirs == key else None)
