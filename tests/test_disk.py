"""What runs leave on disk, and how often they move their rows."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from check import rows_of
from voltmart import session
from voltmart.operators import keys
from voltmart.plans import state, warehouse
from voltmart.session import cut_lineage, scratch, shared_root, together, work_dir
from voltmart.sources import sinks, standins as src
from voltmart.streaming import events as live

ROW = "id string, v int, w string, month_id int"


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, -1)
    yield
    spark.conf.set(name, before)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_shuffle_files_go_with_their_query(spark):
    blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    shuffled = lambda: {f.getName() for f in map(blocks.getAllFiles().apply, range(blocks.getAllFiles().size()))
                        if f.getName().startswith("shuffle_")}
    before = shuffled()
    df = spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count()
    df.write.parquet(work_dir(spark, "test"))
    assert len(df.collect()) == len(df.collect()) == 7  # a plan may run again
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before


def test_a_step_removes_its_scratch_tables(spark):
    paths = []
    keep = lambda n: paths.append(cut_lineage(spark.range(n), "kept").inputFiles()[0].split(":", 1)[1])
    with pytest.raises(ValueError, match="late"):
        with scratch(spark, "step"):
            together(spark, lambda: keep(3), lambda: keep(4))
            keep(5)
            assert all(Path("/" + p.lstrip("/")).exists() for p in paths) and len(paths) == 3
            raise ValueError("late")
    assert not any(Path("/" + p.lstrip("/")).exists() for p in paths)
    assert work_dir(spark, "after").startswith(f"{shared_root(spark)}/after-")


def test_upsert_without_a_stage(spark, make, monkeypatch):
    """Rows whose keys stay are written once; a key that moves still brings the stage, which goes."""
    labels, path = [], work_dir(spark, "test")
    monkeypatch.setattr(sinks, "work_dir", lambda s, label: labels.append(label) or work_dir(s, label))
    put = lambda rows, **more: sinks.upsert_partitions(
        spark, path, make(ROW, rows), ["id"], ["v", "month_id"], written=True, staged=False, **more)
    put([("a", 1, "x", 1), ("b", 1, "x", 2), (None, 1, "x", None)])
    put([("a", 2, "y", 1), (None, 2, "y", None), ("c", 2, "y", 2)])
    assert labels == []
    stored = lambda: sorted(map(tuple, spark.read.parquet(path).collect()), key=str)
    assert stored() == sorted([("a", 2, "x", 1), ("b", 1, "x", 2), (None, 2, "x", None), ("c", 2, "y", 2)], key=str)
    put([("a", 3, "z", 2)])
    assert labels == ["stage"] and not list(Path(shared_root(spark)).glob("stage-*"))
    assert stored() == sorted([("a", 3, "x", 2), ("b", 1, "x", 2), (None, 2, "x", None), ("c", 2, "y", 2)], key=str)


def test_a_source_says_where_its_keys_are(spark, make, monkeypatch):
    path = work_dir(spark, "test")
    put = lambda df, **more: sinks.upsert_partitions(
        spark, path, df, ["id"], ["v", "w", "month_id"], written=True, staged=False, **more)
    held = lambda part: F.when(F.col("id") != "new", F.struct(part.cast("int").alias("month_id"))).alias("_held")
    first = make(ROW, [("a", 1, "x", 1), ("b", 1, "x", 2)])
    put(first.select("*", F.lit(None).cast("struct<month_id:int>").alias("_held")), held_col="_held")
    rows = make(ROW, [("a", 2, "y", 3), ("new", 2, "y", 2)])
    put(rows.select("*", held(F.lit(1))), held_col="_held")
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {("a", 2, "y", 3), ("b", 1, "x", 2), ("new", 2, "y", 2)}


@pytest.mark.parametrize("moves", [False, True])
@pytest.mark.parametrize("repeated", [False, True])
def test_changes_are_read_from_the_stage(spark, make, monkeypatch, moves, repeated):
    """They are those that old and new rows of the source's keys give; only repeated keys are joined again."""
    path, joined = work_dir(spark, "test"), []
    old = [("a", 1, "x", 1), ("same", 1, "x", 1), (None, 1, "n", 2), ("rest", 1, "x", 2)]
    old += [("twice", 1, "x", 2)] * 2 if repeated else []
    new = [("a", 2, "x", 3 if moves else 1), ("same", 1, "x", 1), (None, 2, "n", 2), ("new", None, None, 1)]
    new += [("twice", 2, "x", 2)] * 2 if repeated else []
    sinks.upsert_partitions(spark, path, make(ROW, old), ["id"], ["v", "w", "month_id"])
    target = spark.read.parquet(path).select("id", "v", "w", "month_id")
    merged = keys.upsert(target, make(ROW, new), ["id"], ["v", "w", "month_id"])
    of_source = lambda df: df.alias("t").join(
        make(ROW, new).select("id").alias("s"), F.col("t.id").eqNullSafe(F.col("s.id")), "left_semi").select("id", "v", "month_id")
    changes = sinks.signed_changes(of_source(target), of_source(merged), ["id"])
    expected = rows_of(changes.columns, changes.collect())
    monkeypatch.setattr(sinks, "signed_changes", lambda *a, of=sinks.signed_changes: joined.append(1) or of(*a))
    sinks.upsert_partitions(
        spark, path, make(ROW, new), ["id"], ["v", "w", "month_id"], log=("run", f"{path}-log"), log_columns=["id", "v", "month_id"]
    )
    found = sinks.changes_of(spark, ("run", f"{path}-log"))
    assert rows_of(found.columns, found.collect()) == expected and len(joined) == repeated


def test_rentals_are_shuffled_once(spark, make, no_broadcast):
    """By their order, before repeats go; ids that lack a part meet as they did."""
    path = work_dir(spark, "tables")
    lines = "l_orderkey long, l_linenumber int, l_suppkey long, l_shipdate string, l_returnflag string"
    rows = [(1, 1, 5, "2001-01-01", "A"), (1, 1, 6, "2001-01-02", "R"), (1, 2, 7, "2001-01-01", "N"), (3, None, 8, "2001-01-01", "A"),
            (None, 3, 9, "2001-01-05", "A"), (4, None, 8, "2001-01-06", "A"), (None, 4, 9, "2001-01-05", "A"), (None, None, 1, "2001-01-01", "A")]
    spark.createDataFrame(rows, lines).selectExpr(
        "l_orderkey", "l_orderkey l_partkey", "l_suppkey", "l_linenumber", "2d l_quantity", "10d l_extendedprice", "0d l_discount",
        "0d l_tax", "l_returnflag", "'O' l_linestatus", "cast(l_shipdate as timestamp_ntz) l_shipdate",
    ).write.parquet(f"{path}/lineitem.parquet")
    spark.range(1, 5).selectExpr(
        "id o_orderkey", "id o_custkey", "'F' o_orderstatus", "1d o_totalprice",
        "timestamp_ntz'2001-01-01 00:00:00' o_orderdate", "'1-URGENT' o_orderpriority",
    ).write.parquet(f"{path}/orders.parquet")
    found = src.rentals(spark, path)
    assert {(r.rental_id, r.station_id) for r in found.collect()} == {("1-1", "6"), ("1-2", "7"), ("4", "8")}
    assert plan_of(found).split("Initial Plan")[-1].count("Exchange ") == 2


def test_state_of_rentals_is_shuffled_once(spark):
    changes = spark.range(10).selectExpr(
        "cast(20010101 + id % 3 as int) start_date_id", "0 start_time_id", "'s' station_dwh_id", "'t' tariff_dwh_id",
        "cast(1 as decimal(12,2)) final_cost", "1 duration_minutes", "true is_completed", "false is_cancelled",
        "cast(id as string) user_dwh_id", "1 _sign",
    )
    for name, rows in state.rental_deltas(changes).items():
        plan = plan_of(rows)
        assert plan.count("Exchange ") == plan.count("Exchange rangepartitioning(start_date_id") == 1, (name, plan)


def test_rows_reach_the_stateful_processor_without_ballast(spark):
    """Each cell costs Python time: what only deals the rows to groups stays behind."""
    rates = spark.readStream.format("rate").load().selectExpr("cast(value as string) id", "'u' user_id", "'U' dwh")
    plan = live.stream_resolved(rates.select("id", "user_id"), rates.select("user_id", "dwh"), "user_id", "id")
    text = plan._jdf.queryExecution().analyzed().toString()
    below = text.split("TransformWithState")[1].splitlines()[1]
    assert "kind#" in below and "arrived" not in below and "salt" not in below, text


def test_facts_are_looked_up_with_what_they_need(spark, make, monkeypatch):
    """Snapshots and change marks of offers and rentals are not shuffled to the dimensions."""
    found = []
    monkeypatch.setattr(warehouse, "_load_fact", lambda s, rows, name, *a: found.append((name, set(rows.columns))))
    monkeypatch.setattr(warehouse, "together", lambda s, *jobs: [job() for job in jobs] if len(jobs) == 2 else [])
    monkeypatch.setattr(sinks, "read_version", lambda *a: None)
    for dim in ("new_user_versions", "dim_stations", "dim_tariff"):
        monkeypatch.setattr(warehouse, dim, lambda *a: None)
    columns = {"tariff_snapshot", "cost_since", "status_since", "updated_at", *warehouse.facts.RENTAL_SOURCE, *warehouse.facts.OFFER_SOURCE}
    rows = spark.range(1).select(*[F.lit("x").alias(c) for c in columns])
    warehouse.load_star(spark, {"rentals": rows, "offers": rows}, rows, "root", "2024-01-01")
    assert dict(found) == {"fact_rentals": set(warehouse.facts.RENTAL_SOURCE), "fact_offers": set(warehouse.facts.OFFER_SOURCE)}
    assert session.SETTINGS["spark.sql.classic.shuffleDependency.fileCleanup.enabled"] == "true"
