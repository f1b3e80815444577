"""Running values along a key, in two passes where a key is too busy for one task.

A window per key sorts all rows of the key in one task. Keys of more than `most` rows are therefore cut
into ranges of (key, order): Spark samples the splitters, so that ranges are even however the rows of a
key crowd together. Each range runs its own window; its last row is its summary; the summaries are
carried across the ranges of their key, of which there are few; and every row adds what was carried to
its range. Other keys keep the plain window. Both give the same values.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from voltmart.session import cut_lineage

MOST = 500_000  # rows of a key that one task may sort


@dataclass(frozen=True)
class Fold:
    """A value folded over rows in order. `of` aggregates rows, `over` the named summaries of ranges, and
    `join` puts the carried value and the one inside the range together; either may be NULL."""

    of: Column
    over: Callable[[str], Column]
    join: Callable[[Column, Column], Column]


def running_count() -> Fold:
    return running_sum(F.lit(1).cast("bigint"))


def _either(both: Callable[[Column, Column], Column]) -> Callable[[Column, Column], Column]:
    return lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(both(a, b))


def running_sum(value: Column) -> Fold:
    return Fold(F.sum(value), lambda c: F.sum(c), _either(lambda a, b: a + b))


def running_max(value: Column) -> Fold:
    return Fold(F.max(value), lambda c: F.max(c), lambda a, b: F.greatest(a, b))


def running_xor(value: Column) -> Fold:
    return Fold(F.bit_xor(value), lambda c: F.bit_xor(c), _either(lambda a, b: a.bitwiseXOR(b)))


def last_known(value: Column) -> Fold:
    """The last value that is not NULL."""
    return Fold(
        F.last(value, ignorenulls=True), lambda c: F.last(c, ignorenulls=True), lambda a, b: F.coalesce(b, a)
    )


def scan(
    df: DataFrame, keys: list[str], order: list[Column], folds: dict[str, Fold], inclusive: bool = True,
    most: int = MOST,
) -> DataFrame:
    """df with one column per fold, over the rows of its key up to the row itself, or before it.

    NULL is a key like any other; no keys at all make one key of the whole table. The order has to tell
    rows apart where the value depends on it. df is read to count its keys before the result is read, and
    twice more where busy keys are found: cut its lineage first where it is costly.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    busy = cut_lineage(sizes.filter(F.col("_rows") > most), "busy")
    rows = busy.agg(F.sum("_rows")).first()[0]
    if not rows:
        return _plain(df, keys, order, folds, inclusive)
    ranges = max(2, -(-2 * rows // most))
    if not keys:
        return _ranged(df, keys, order, folds, inclusive, ranges)
    marked = busy.select(*[F.col(k).alias(f"_busy_{k}") for k in keys])
    same = _same(keys, lambda k: F.col(k), lambda k: F.col(f"_busy_{k}"))
    return _plain(df.join(marked, same, "left_anti"), keys, order, folds, inclusive).unionByName(
        _ranged(df.join(marked, same, "left_semi"), keys, order, folds, inclusive, ranges)
    )


def _same(keys: list[str], left: Callable[[str], Column], right: Callable[[str], Column]) -> Column:
    joined = F.lit(True)
    for key in keys:
        joined = joined & left(key).eqNullSafe(right(key))
    return joined


def _plain(df: DataFrame, keys, order, folds: dict[str, Fold], inclusive: bool) -> DataFrame:
    frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1
    )
    return df.select("*", *[fold.of.over(frame).alias(name) for name, fold in folds.items()])


def _ranged(
    df: DataFrame, keys, order, folds: dict[str, Fold], inclusive: bool, ranges: int
) -> DataFrame:
    names = df.columns
    dealt = df.repartitionByRange(int(ranges), *keys, *order).withColumn("_range", F.spark_partition_id())
    inside = Window.partitionBy(*keys, "_range").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = cut_lineage(
        dealt.select(
            "*",
            *[fold.of.over(upto).alias(f"_upto_{n}") for n, fold in folds.items()],
            *[] if inclusive else [fold.of.over(before).alias(f"_before_{n}") for n, fold in folds.items()],
            F.lead(F.lit(True)).over(inside).isNull().alias("_ends"),
        ),
        "ranges",
    )
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = cut_lineage(
        local.filter("_ends").select(
            *[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_range").alias("_of_range"),
            *[fold.over(f"_upto_{n}").over(earlier).alias(f"_carried_{n}") for n, fold in folds.items()],
        ),
        "carried",
    )
    near = "_upto" if inclusive else "_before"
    same = _same(keys, lambda k: F.col(k), lambda k: F.col(f"_of_{k}")) & (F.col("_range") == F.col("_of_range"))
    return local.join(carried, same).select(
        *names,
        *[fold.join(F.col(f"_carried_{n}"), F.col(f"{near}_{n}")).alias(n) for n, fold in folds.items()],
    )
