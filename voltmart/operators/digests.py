"""Two copies of a table compared by a tree of digests.

A digest of a range of rows is its count, the exclusive or of its rows' hashes and their sum: the order of
rows does not matter, digests of disjoint rows add up, and a row that occurs twice shows in the count and
the sum. Levels are columns from coarse to fine (month, day): only ranges whose digests differ are looked
into at the next level, and only rows of the last level's differing ranges meet by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from voltmart.operators.quality import _key, _result
from voltmart.session import cut_lineage

MOST = 1000  # differing values of a level that are passed on as a literal list, which prunes the scan


def row_hashes(columns: list[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row. NULL is told apart from every value."""
    parts = [part for c in columns for part in (F.col(c), F.col(c).isNull())]
    return F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)


def digests(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """(*by, rows, mixed, total) per range, combined before the shuffle."""
    first, second = row_hashes(columns)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor(first).alias("mixed"),
        F.sum(second.cast("decimal(38,0)")).alias("total"),
    )


def _met(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Full outer join of two tables of digests, NULL being a range like any other."""
    name = lambda df, side: df.select(
        *[F.col(c).alias(f"_{side}_{c}") for c in by], F.struct("rows", "mixed", "total").alias(side)
    )
    same = F.lit(True)
    for c in by:
        same = same & F.col(f"_left_{c}").eqNullSafe(F.col(f"_right_{c}"))
    both = name(left, "left").join(name(right, "right"), same, "full_outer")
    # A NULL value of one side stays NULL whichever side it is taken from.
    return both.select(
        *[F.when(F.col("left").isNotNull(), F.col(f"_left_{c}")).otherwise(F.col(f"_right_{c}")).alias(c) for c in by],
        "left", "right",
    )


def differing_ranges(left: DataFrame, right: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """The ranges whose rows are not the same on both sides."""
    met = _met(digests(left, by, columns), digests(right, by, columns), by)
    return met.filter(~F.col("left").eqNullSafe(F.col("right"))).select(*by)


def _inside(df: DataFrame, ranges: DataFrame, by: list[str]) -> DataFrame:
    """Rows of the given ranges. Their last column's values reach the scan as literals where they are few."""
    level = by[-1]
    values = [r[0] for r in ranges.select(level).distinct().limit(MOST + 1).collect()]
    if len(values) <= MOST:
        wanted = F.col(level).isin([v for v in values if v is not None])
        if None in values:
            wanted = F.coalesce(wanted, F.lit(False)) | F.col(level).isNull()
        df = df.filter(wanted)
    named = ranges.select(*[F.col(c).alias(f"_range_{c}") for c in by])
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_range_{c}"))
    return df.join(named, same, "left_semi")


def differences(
    left: DataFrame, right: DataFrame, keys: list[str], levels: list[str], columns: list[str] | None = None
) -> DataFrame:
    """(*keys, problem, left_rows, right_rows): what `right`, the copy, does not have as `left` has it.

    lost: a key that the copy lacks; added: one that only the copy has; doubled: more rows of a key in the copy;
    thinned: fewer; changed: as many rows, other values. Both sides have the columns compared (default: all of `left`)
    in the same types. A row that moved to another range is changed, as its range is a column too.
    """
    columns = columns or left.columns
    mine, theirs = left.select(*columns), right.select(*columns)
    for depth in range(1, len(levels) + 1):
        by = levels[:depth]
        ranges = cut_lineage(differing_ranges(mine, theirs, by, columns), "ranges")
        mine, theirs = _inside(mine, ranges, by), _inside(theirs, ranges, by)
    met = _met(digests(mine, keys, columns), digests(theirs, keys, columns), keys)
    here, there = F.coalesce("left.rows", F.lit(0)), F.coalesce("right.rows", F.lit(0))
    problem = (
        F.when(there == 0, "lost").when(here == 0, "added").when(there > here, "doubled")
        .when(there < here, "thinned").otherwise("changed")
    )
    return met.filter(~F.col("left").eqNullSafe(F.col("right"))).select(
        *keys, problem.alias("problem"), here.alias("left_rows"), there.alias("right_rows")
    )


def check_copy(left: DataFrame, right: DataFrame, keys: list[str], levels: list[str], table: str) -> DataFrame:
    """The differences as rows of a data-quality check."""
    found = differences(left, right, keys, levels)
    return _result(found, "copy", table, _key(keys), F.col("problem"), F.lit("same"), F.lit(False))
