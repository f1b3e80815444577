"""User versions in two times: when they were valid, and when the warehouse knew them.

A snapshot says what each key's columns were at its time; they hold until the next snapshot that has the
key. Snapshots may arrive in any order and arrive again with corrections: one that falls inside a version splits it, one
that says what its neighbour says extends the neighbour, and what it replaces stays readable as of the
load before. Whatever the order of arrival, the versions known at the end are the same.

Snapshots and versions both have a row per key, so they always meet by shuffle (the hint "merge"): a side whose files look
small enough to broadcast would pass through the driver, several times its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from voltmart.functions.scalar import surrogate_key
from voltmart.operators.dims import TRACKED_USER_COLUMNS, asof_dim
from voltmart.schemas import OPEN_END
from voltmart.session import cut_lineage
from voltmart.sources import sinks

BUCKETS = 64  # folders of a stored dimension, by hash of the key; a load rewrites those of changed keys
PERIOD = ["valid_from", "valid_to", "loaded_from", "loaded_to"]


def _open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp")


def _at(moment: str) -> Column:
    return F.lit(moment).cast("timestamp")


def known_at(dim: DataFrame, moment: str | None = None) -> DataFrame:
    """The versions that were known at a load time; those known now by default."""
    if moment is None:
        return dim.filter(F.col("loaded_to") == _open_end())
    return dim.filter((F.col("loaded_from") <= _at(moment)) & (F.col("loaded_to") > _at(moment)))


def valid_at(dim: DataFrame, moment: str) -> DataFrame:
    return dim.filter((F.col("valid_from") <= _at(moment)) & (F.col("valid_to") > _at(moment)))


def _same(left: str, right: str, columns: list[str]) -> Column:
    equal = F.lit(True)
    for name in columns:
        equal = equal & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return equal


def snapshot_changes(
    dim: DataFrame, snapshot: DataFrame, at: str, loaded: str, seen: DataFrame | None = None,
    key: str = "user_id", tracked: list[str] | None = None,
) -> DataFrame:
    """Rows of the bitemporal dimension that a snapshot changes or adds.

    dim: key, tracked columns, valid_from, valid_to, loaded_from, loaded_to. snapshot: one row per key with the
    tracked columns, true at `at`, loaded at `loaded`. seen (key, seen_at): when keys were seen by other
    snapshots, of which those after `at` matter; needed only when snapshots arrive out of order. Returned rows keep the
    columns of dim: superseded versions with their loaded_to, and the versions that take their place. Keys that the snapshot
    lacks are not touched, nor are keys whose version at that time says the same. Rows without a key are ignored.
    """
    tracked = tracked or TRACKED_USER_COLUMNS
    moment, end = _at(at), _open_end()
    says = F.struct(*tracked)
    new = snapshot.filter(F.col(key).isNotNull()).select(key, says.alias("says"), moment.alias("_at"))
    live = known_at(dim).join(new.select(key).hint("merge"), key, "left_semi")
    live = cut_lineage(live.select(key, says.alias("said"), *PERIOD), "versions")
    # The version around the snapshot's time, found by a sweep; most keys end here, as nothing changed.
    around = live.withColumn("version", F.struct("said", *PERIOD))
    found = asof_dim(new, around.hint("merge"), key, "_at", ["version"])
    changed = cut_lineage(
        found.filter(F.col("version").isNull() | ~_same("says", "version.said", tracked)), "changed"
    )
    after = live.filter(F.col("valid_from") > moment).groupBy(key).agg(F.min("valid_from").alias("_next_from"))
    rows = changed.join(after.hint("merge"), key, "left")
    # What the snapshot says ends where the key is seen next, or where the next version begins.
    if seen is None:
        rows = rows.withColumn("_seen", F.lit(None).cast("timestamp"))
    else:
        again = seen.filter(F.col("seen_at") > moment).join(changed.select(key).hint("merge"), key, "left_semi")
        rows = rows.join(again.groupBy(key).agg(F.min("seen_at").alias("_seen")).hint("merge"), key, "left")
    until = F.least(F.coalesce("_seen", end), F.coalesce("version.valid_to", "_next_from", end))
    rows = rows.withColumn("_until", until)
    # Neighbours that say the same: the one that ends where this begins, and the one that begins where it ends.
    neighbour = lambda name, edge: live.select(
        F.col(key).alias(f"_key_{name}"), F.col(edge).alias(f"_edge_{name}"), F.struct("said", *PERIOD).alias(name)
    ).hint("merge")
    rows = rows.join(
        neighbour("before", "valid_to"),
        (F.col(key) == F.col("_key_before")) & (F.col("_edge_before") == moment), "left",
    ).join(
        neighbour("behind", "valid_from"),
        (F.col(key) == F.col("_key_behind")) & (F.col("_edge_behind") == F.col("_until")), "left",
    )
    for name in ("before", "behind"):
        rows = rows.withColumn(name, F.when(_same("says", f"{name}.said", tracked), F.col(name)))
    now = _at(loaded)

    def version(said: Column, start: Column, stop: Column, known: Column, gone: Column) -> Column:
        return F.struct(
            *[said[c].alias(c) for c in tracked], start.alias("valid_from"), stop.alias("valid_to"),
            known.alias("loaded_from"), gone.alias("loaded_to"),
        )

    def closed(name: str) -> Column:
        old = F.col(name)
        return F.when(old.isNotNull(), version(old["said"], old["valid_from"], old["valid_to"], old["loaded_from"], now))

    old = F.col("version")
    left = F.when(old["valid_from"] < moment, version(old["said"], old["valid_from"], moment, now, end))
    right = F.when(F.col("_until") < old["valid_to"], version(old["said"], F.col("_until"), old["valid_to"], now, end))
    middle = version(
        F.col("says"), F.coalesce(F.col("before.valid_from"), moment), F.coalesce(F.col("behind.valid_to"), F.col("_until")), now, end
    )
    pieces = F.array_compact(F.array(closed("version"), closed("before"), closed("behind"), left, middle, right))
    columns = [key, *tracked, *PERIOD]
    return rows.select(key, F.inline(pieces)).select(*columns)


def empty_dimension(snapshot: DataFrame, key: str = "user_id", tracked: list[str] | None = None) -> DataFrame:
    tracked = tracked or TRACKED_USER_COLUMNS
    times = [F.lit(None).cast("timestamp").alias(c) for c in PERIOD]
    return snapshot.select(key, *tracked, *times).limit(0)


def load_snapshot(
    spark: SparkSession, path: str, snapshot: DataFrame, at: str, loaded: str, seen: DataFrame | None = None,
    key: str = "user_id", tracked: list[str] | None = None,
) -> DataFrame:
    """Merge a snapshot into the stored dimension, rewriting only the buckets of keys that change. Loading
    it again changes nothing. Returns the dimension."""
    tracked = tracked or TRACKED_USER_COLUMNS
    stored = sinks.read_if_present(spark, path)
    columns = [key, *tracked, *PERIOD]
    dim = empty_dimension(snapshot, key, tracked) if stored is None else stored.select(*columns)
    changes = snapshot_changes(dim, snapshot, at, loaded, seen, key, tracked)
    # A version that was made by this very load and replaced by it again was never known to anybody.
    changes = changes.filter(F.col("loaded_from") < F.col("loaded_to"))
    version = surrogate_key(key, F.unix_micros("valid_from"), F.unix_micros("loaded_from"), F.unix_micros("valid_to"))
    rows = changes.withColumn("version_id", version).withColumn(
        "bucket", F.expr(f"cast(pmod(xxhash64(`{key}`), {BUCKETS}) as int)")
    )
    sinks.upsert_partitions(spark, path, rows, ["version_id"], ["loaded_to"], "bucket", key)
    return spark.read.parquet(path).select(*columns)
