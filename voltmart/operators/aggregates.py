"""Aggregates whose built-in form would gather one group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from voltmart.operators.scan import MOST, running_sum, scan
from voltmart.session import cut_lineage

CELL_CENTS = 100_000


def distinct_if(column: str, condition: Column | None = None) -> Column:
    """Exact distinct count, optionally of the rows meeting a condition."""
    counted = F.col(column) if condition is None else F.when(condition, F.col(column))
    return F.count_distinct(counted)


def distinct_counts(
    df: DataFrame, by: list[str], column: str, conditions: dict[str, Column], out: str
) -> DataFrame:
    """Distinct values of a column per group, in all and among the rows meeting each condition.

    Several distinct counts in one GROUP BY make Spark copy every row once per count. Here rows are
    reduced to one per value first, which then says which conditions it ever met.
    """
    met = [F.max(F.coalesce(c, F.lit(False))).alias(name) for name, c in conditions.items()]
    values = df.groupBy(*by, column).agg(F.count(F.lit(1)).alias("_rows"), *met)
    return values.groupBy(*by).agg(
        F.count(column).alias(out),
        *[F.count_if(F.col(column).isNotNull() & F.col(n)).alias(n) for n in conditions],
    )


def exact_median(
    df: DataFrame, by: list[str], value: str, out: str, scale: int = 2, weight: str | None = None
) -> DataFrame:
    """Exact continuous median of a decimal column per group, for groups of any size. With `weight` a row
    stands for that many equal values, as in a stored histogram.

    Equal values are counted before the shuffle. The counts are summed into coarse cells of the
    value's integer form, the cells holding the two middle ranks are found, and only those cells
    are looked into. A cell holds at most CELL_CENTS distinct values and a decimal(10,2) has at
    most 10**5 cells, which bounds every window whatever the group's size.
    """
    units = F.round(F.col(value) * 10**scale, 0).cast("bigint")
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, units.alias("_units"))
        .agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_n"))
        .withColumn("_cell", F.floor(F.col("_units") / CELL_CENTS))
    )
    group = Window.partitionBy(*by)
    cells = (
        counts.groupBy(*by, "_cell")
        .agg(F.sum("_n").alias("_cell_n"))
        .withColumn("_total", F.sum("_cell_n").over(group))
        .withColumn("_upto", F.sum("_cell_n").over(group.orderBy("_cell")))
        .withColumn("_low", F.floor((F.col("_total") + 1) / 2))
        .withColumn("_high", F.floor((F.col("_total") + 2) / 2))
        .withColumn("_before", F.col("_upto") - F.col("_cell_n"))
        .filter((F.col("_before") < F.col("_high")) & (F.col("_upto") >= F.col("_low")))
        .select(*by, "_cell", "_before", "_low", "_high")
    )
    in_cell = Window.partitionBy(*by, "_cell").orderBy("_units")
    ranked = (
        counts.join(cells, [*by, "_cell"])
        .withColumn("_last", F.col("_before") + F.sum("_n").over(in_cell))
        .withColumn("_first", F.col("_last") - F.col("_n") + 1)
    )
    holds = lambda rank: (F.col("_first") <= F.col(rank)) & (F.col("_last") >= F.col(rank))
    middle = F.max(F.when(holds("_low"), F.col("_units"))) + F.max(
        F.when(holds("_high"), F.col("_units"))
    )
    halves = middle.cast("decimal(20,0)") * 5
    return ranked.groupBy(*by).agg(
        (halves / F.lit(10 ** (scale + 1))).cast(f"decimal(18,{scale + 1})").alias(out)
    )


def rank_desc(df: DataFrame, column: str, out: str, most: int = MOST) -> DataFrame:
    """RANK() OVER (ORDER BY column DESC) without sorting all rows in one task.

    The rank depends only on the value: one plus the rows with a larger value. Rows are counted per
    value, the counts run over the distinct values (in ranges where these are many), and the ranks
    are joined back. NULL ranks last.
    """
    values = cut_lineage(df.groupBy(F.col(column).alias("_value")).agg(F.count(F.lit(1)).alias("_n")), "values")
    above = scan(
        values, [], [F.desc("_value")], {out: running_sum(F.col("_n"))}, inclusive=False, most=most
    )
    ranks = above.select("_value", (F.coalesce(out, F.lit(0)) + 1).cast("bigint").alias(out))
    return df.join(ranks, df[column].eqNullSafe(ranks["_value"])).drop("_value")
