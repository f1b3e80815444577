"""Which users make a shard heavy, and which of them should move."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from voltmart.operators.scan import running_sum, scan
from voltmart.session import cut_lineage


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values as text, NULL taking none; what a row costs in a dump."""
    total = F.lit(0).cast("bigint")
    for name in df.columns:
        total = total + F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(0))
    return total


def user_loads(tables: list[DataFrame], user: str = "user_id", shard: str = "shard_id") -> DataFrame:
    """(shard, user, bytes, rows) over all tables: a state that merges by adding, see merge_loads. Rows of
    a user are summed before they are shuffled."""
    parts = [
        df.withColumn("_bytes", row_bytes(df)).groupBy(shard, user).agg(
            F.sum("_bytes").alias("bytes"), F.count(F.lit(1)).alias("rows")
        )
        for df in tables
    ]
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    return merge_loads(both, user, shard)


def merge_loads(loads: DataFrame, user: str = "user_id", shard: str = "shard_id") -> DataFrame:
    """Add up the loads of several tables, days or runs."""
    return loads.groupBy(shard, user).agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))


def heavy_hitters(loads: DataFrame, k: int, user: str = "user_id", shard: str = "shard_id") -> DataFrame:
    """The k users of most bytes in each shard, with their share of it. A rank up to k is cut in every task
    before the shuffle."""
    sizes = loads.groupBy(shard).agg(F.sum("bytes").alias("_shard_bytes"))
    heaviest = Window.partitionBy(shard).orderBy(F.desc("bytes"), user)
    ranked = loads.withColumn("rank", F.row_number().over(heaviest)).filter(F.col("rank") <= k)
    return ranked.join(sizes, shard).select(
        shard, "rank", user, "bytes", "rows", F.round(F.col("bytes") / F.col("_shard_bytes"), 6).alias("share")
    )


def shard_sizes(loads: DataFrame, shards: int, shard: str = "shard_id") -> list[int]:
    """Bytes per shard, those without any rows included; as many numbers as shards."""
    found = {r[0]: int(r[1]) for r in loads.groupBy(shard).agg(F.sum("bytes")).collect()}
    return [found.get(n, 0) for n in range(shards)]


def move_plan(
    loads: DataFrame, shards: int, user: str = "user_id", shard: str = "shard_id"
) -> DataFrame:
    """(user, from_shard, to_shard, bytes): users that leave shards above the mean, heaviest first.

    A shard above the mean gives users, from the heaviest on that fits, as long as what they add up to does
    not pass its excess. What leaves is laid end to end on a line, heaviest first, and what other shards
    lack likewise: a user goes to the shard at whose place its middle lies. No shard ends
    further from the mean than a few of its heaviest users weigh. Shards are few and their sizes pass through
    the driver; users do not, running sums hold for shards of any size (see scan.py). A user whose rows lie in several
    shards is several users here.
    """
    sizes = shard_sizes(loads, shards, shard)
    mean = sum(sizes) // shards
    excess = {n: size - mean for n, size in enumerate(sizes) if size > mean}
    lack = {n: mean - size for n, size in enumerate(sizes) if size < mean}
    schema = loads.select(F.col(user), F.col(shard).alias("from_shard"), F.col(shard).alias("to_shard"), "bytes")
    if not excess or not lack:
        return schema.limit(0)
    limits = F.create_map(*[F.lit(x) for n, over in excess.items() for x in (n, over)])
    over = F.element_at(limits, F.col(shard))
    leaving = loads.filter(F.col(shard).isin(list(excess)) & (F.col("bytes") <= over)).select(user, shard, "bytes")
    heaviest = [F.desc("bytes"), F.asc(user)]
    upto = scan(leaving, [shard], heaviest, {"_upto": running_sum(F.col("bytes"))})
    moved = cut_lineage(upto.filter(F.col("_upto") <= over).select(user, shard, "bytes"), "leaving")
    line = scan(moved, [], [*heaviest, F.asc(shard)], {"_end": running_sum(F.col("bytes"))})
    middle = F.col("_end") * 2 - F.col("bytes")  # twice the middle
    place, at = F.lit(None).cast("int"), 0
    for n, room in sorted(lack.items(), key=lambda pair: (-pair[1], pair[0])):
        at += room
        place = F.coalesce(place, F.when(middle <= 2 * at, F.lit(n)))
    last = sorted(lack.items(), key=lambda pair: (-pair[1], pair[0]))[-1][0]
    return line.select(
        user, F.col(shard).alias("from_shard"), F.coalesce(place, F.lit(last)).alias("to_shard"), "bytes"
    )


def after_moves(loads: DataFrame, moves: DataFrame, user: str = "user_id", shard: str = "shard_id") -> DataFrame:
    """The loads with every moved user at its new shard."""
    to = moves.select(F.col(user).alias("_user"), F.col("from_shard").alias("_from"), "to_shard")
    same = loads[user].eqNullSafe(F.col("_user")) & loads[shard].eqNullSafe(F.col("_from"))
    placed = loads.join(to, same, "left").withColumn(shard, F.coalesce("to_shard", F.col(shard)))
    return merge_loads(placed.select(*loads.columns), user, shard)
