"""What several of the text operators need: connected components, neighbours in a sorted table."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from functools import wraps

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltmart.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """Connected components of (a, b) long pairs -> (node, root), root being the smallest node reached.

    Each round every node points at its smallest neighbour, pointers are doubled until they reach their
    root, and the edges are contracted to roots. Every step is a partial aggregation or an equi-join that
    AQE can split at a hot node; nothing is gathered per component. Nodes without an edge are left out,
    as are loops and edges with a null end.
    """
    edges = cut_lineage(
        edges.where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    found = None
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select("b", "a"))
        roots = cut_lineage(
            both.groupBy(F.col("a").alias("node"))
            .agg(F.min("b").alias("low"))
            .select("node", F.least("node", "low").alias("root")),
            "roots",
        )
        while True:
            up = roots.select(F.col("node").alias("root"), F.col("root").alias("up"))
            jumped = cut_lineage(
                roots.join(up, "root").select(
                    "node", F.col("up").alias("root"), (F.col("up") < F.col("root")).alias("moved")
                ),
                "roots",
            )
            roots = jumped.select("node", "root")
            if jumped.where("moved").isEmpty():
                break
        if found is None:
            found = roots
        else:
            later = roots.select(F.col("node").alias("root"), F.col("root").alias("last"))
            found = cut_lineage(
                found.join(later, "root", "left").select(
                    "node", F.coalesce("last", "root").alias("root")
                ),
                "components",
            )
        of = lambda end: roots.select(
            F.col("node").alias(end), F.col("root").alias(f"{end}_root")
        )
        edges = cut_lineage(
            edges.join(of("a"), "a")
            .join(of("b"), "b")
            .where("a_root <> b_root")
            .select(
                F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b")
            )
            .distinct(),
            "edges",
        )
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found


def repeated_neighbours(
    rows: DataFrame, core: str, whole: str, unique: list[str], partitions: int | None = None
) -> DataFrame:
    """Find equal keys by sorting: sampled splitters, local sorts, comparison across the borders.

    `core` and `whole` are long keys, `unique` the columns that tell rows apart. The rows are dealt to
    ranges of (core, whole, *unique) by splitters that Spark samples, each range is sorted in its task,
    and each row is compared with the rows before and after it. A frequent key may run over many ranges:
    the first and last row of each range are compared with those of the next one in a second pass over
    two rows per range. Added columns: same_core (another row has its core), same_whole (another row has
    its core and whole), edge (the row begins or ends its run of equal (core, whole) and the row beyond
    has the same core, so the core has several wholes).
    """
    keys = [core, whole]
    schema = rows.schema
    names = rows.columns
    flags = "pc boolean, pw boolean, nc boolean, nw boolean, border int"
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # the last row so far, with its view of the row before
        first = True
        for batch in batches:
            if not len(batch):
                continue
            c, w = batch[core].to_numpy(), batch[whole].to_numpy()
            pc, pw = np.zeros(len(c), bool), np.zeros(len(c), bool)
            pc[1:] = c[1:] == c[:-1]
            pw[1:] = pc[1:] & (w[1:] == w[:-1])
            place = np.zeros(len(c), np.int32)
            if held is None:
                place[0] = 1
            else:
                pc[0] = held[core].iloc[0] == c[0]
                pw[0] = pc[0] and held[whole].iloc[0] == w[0]
                yield held.assign(nc=pc[0], nw=pw[0])
            batch = batch.assign(
                pc=pc, pw=pw, nc=np.append(pc[1:], False), nw=np.append(pw[1:], False), border=place
            )
            held = batch.iloc[-1:]
            first = False
            if len(batch) > 1:
                yield batch.iloc[:-1]
        if not first:
            yield held.assign(border=held["border"] | 2)

    dealt = (
        rows.repartitionByRange(partitions, *keys, *unique)
        if partitions
        else rows.repartitionByRange(*keys, *unique)
    )
    compared = cut_lineage(
        dealt.sortWithinPartitions(*keys, *unique).mapInPandas(returns_memory(compare), f"{fields}, {flags}"),
        "sorted",
    )
    # border: 1 the first row of its range, 2 the last one, 3 both. Two rows per range at most.
    order = Window.orderBy(*keys, *unique)
    border = compared.where("border > 0")
    for step, side in ((F.lag, "p"), (F.lead, "n")):
        mine = F.col("border").bitwiseAND(1 if side == "p" else 2) > 0
        near = lambda key, step=step: step(key).over(order).eqNullSafe(F.col(key))
        border = border.withColumn("same_c", near(core)).withColumn(
            "same_w", F.col("same_c") & near(whole)
        )
        border = border.withColumn(
            f"{side}c", F.when(mine, F.col("same_c")).otherwise(F.col(f"{side}c"))
        ).withColumn(f"{side}w", F.when(mine, F.col("same_w")).otherwise(F.col(f"{side}w")))
    columns = [*names, "pc", "pw", "nc", "nw"]
    return (
        compared.where("border = 0")
        .select(*columns)
        .unionByName(border.select(*columns))
        .select(
            *names,
            F.expr("pc or nc").alias("same_core"),
            F.expr("pw or nw").alias("same_whole"),
            F.expr("(pc and not pw) or (nc and not nw)").alias("edge"),
        )
    )


def map_documents(docs: DataFrame, run, columns: str, text: str = "text") -> DataFrame:
    """mapInPandas over (doc_id, text) -> (doc_id, *columns). Ids travel as text, so that null ids and
    ids beyond 2^53 survive pandas; they come back with their own type."""
    kind = docs.schema["doc_id"].dataType
    found = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col(text).alias("text"))
    out = found.mapInPandas(returns_memory(run), f"doc_id string, {columns}")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def returns_memory(run):
    """Wrap a function over batches: at its end the worker, which stays for later tasks, hands what it
    has freed back to the system. Allocators keep it otherwise, and it adds up over stages."""

    @wraps(run)
    def wrapped(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim is not None:
            trim(0)

    return wrapped


def task_number() -> int:
    """The number of the running task's partition; the same one when a lost task runs again."""
    context = TaskContext.get()
    return context.partitionId() if context else 0
