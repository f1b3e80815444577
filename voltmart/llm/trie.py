"""The prefix trie of conversations, built as a burst trie over shards.

A conversation is a path of turns; conversations that begin alike share nodes. A container holds the
suffixes below one head, the sequence of turns that all of them have behind them. At the start every
first turn is the head of a container. A container of more than CONTAINER turns bursts: its head
becomes a node of the trie, and the next turn id of each suffix names the container it moves to. A round
bursts several levels at once, twice as many as the round before, so that conversations which share a
thousand turns take ten rounds. What is left is dealt to shards by head; a shard sorts the suffixes of
its containers and sweeps over them once, opening and closing nodes by what neighbours share. Burst
heads are few; their figures are aggregated from the containers below them.

Heads are named by the turns on their path: every (turn id, depth) has two random words, and a path is the
exclusive or of its turns' words, 128 bits, which a running fold computes. Turn ids are 120 bits of
a digest of role and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltmart.llm.common import returns_memory
from voltmart.operators.scan import running_count, running_xor, scan
from voltmart.session import cut_lineage

FAMILY = 5  # conversations that begin with turns of the first one of them
SHARED = 9  # the turns a conversation takes over are fewer than this
CONTAINER = 50_000  # turns of a container that is not burst
SHARD = 50_000  # turns of a shard, on average

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()
KEY = ["d", "k1", "k2"]


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) -> (conv_id, pos, t1, t2, bytes), pos counting a conversation's rows by
    turn (null first) from 1. Rows of one conversation with the same turn follow each other by the
    MD5 digest of role and text. Null role and text are empty; rows without a conv_id are in no conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    word = lambda start: F.conv(F.substring("digest", start, 15), 16, 10).cast("long")
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    ).select("conv_id", "turn", word(1).alias("t1"), word(16).alias("t2"), "bytes")
    order = [F.asc_nulls_first("turn"), F.asc("t1"), F.asc("t2")]
    found = scan(rows, ["conv_id"], order, {"pos": running_count()})
    return cut_lineage(found.select("conv_id", "pos", "t1", "t2", "bytes"), "turns")


def _words(t1: Column, t2: Column, depth: Column) -> tuple[Column, Column]:
    return F.xxhash64(t1, t2, depth), F.xxhash64(F.lit("second"), t2, t1, depth)


def _oversized(most: int) -> Column:
    return (F.col("turns") > most) & (F.col("members") > 1)


def rebuilt(turns: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, len, k1, k2, burst, chain) and their paths (conv_id, d, t1, t2, bytes, len, k1,
    k2, burst, chain): the first h turns of the family's first conversation, then the own ones after h.

    k1, k2 name the container of the first turn; burst says that it is oversized, chain that it
    is one conversation that is too long for a container, whose nodes need no sweep.
    """
    h = F.crc32(F.col("conv_id").cast("string")) % SHARED
    own = turns.groupBy("conv_id").agg(
        F.max("pos").alias("own"),
        F.max(F.when(F.col("pos") == 1, F.struct("t1", "t2"))).alias("first"),
        F.max(F.when(F.col("pos") == h + 1, F.struct("t1", "t2"))).alias("after"),
    )
    own = cut_lineage(own.withColumn("h", h).withColumn("base", F.expr(f"conv_id - conv_id % {FAMILY}")), "own")
    bases = own.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"), F.col("first").alias("base_first"))
    kept = F.least(F.col("h"), F.coalesce("base_own", F.lit(0).cast("long")))
    convs = (
        own.join(bases, "base", "left")
        .withColumn("kept", kept)
        .withColumn("len", F.col("kept") + F.greatest(F.col("own") - F.col("h"), F.lit(0).cast("long")))
        .withColumn("head", F.when(F.col("kept") > 0, F.col("base_first")).otherwise(F.col("after")))
    )
    k1, k2 = _words(F.col("head.t1"), F.col("head.t2"), F.lit(1).cast("long"))
    convs = convs.select("conv_id", "base", "h", "kept", "len", k1.alias("k1"), k2.alias("k2"))
    convs = cut_lineage(convs, "rebuilt")
    sizes = convs.where("len > 0").groupBy("k1", "k2").agg(
        F.sum("len").alias("turns"), F.count(F.lit(1)).alias("members")
    )
    alone = (F.col("turns") > most) & (F.col("members") == 1)
    no = lambda c: F.coalesce(c, F.lit(False))
    convs = cut_lineage(
        convs.join(sizes, ["k1", "k2"], "left").select(
            *convs.columns, no(_oversized(most)).alias("burst"), no(alone).alias("chain")
        ),
        "conversations",
    )
    carried = ["len", "k1", "k2", "burst", "chain"]
    later = turns.join(convs.select("conv_id", "h", "kept", *carried), "conv_id").where("pos > h")
    later = later.withColumn("d", F.col("kept") + F.col("pos") - F.col("h"))
    shared = turns.where(F.col("pos") < SHARED).select(F.col("conv_id").alias("base"), "pos", "t1", "t2", "bytes")
    shared = shared.join(convs.select("conv_id", "base", "h", *carried), "base").where("pos <= h")
    columns = ["conv_id", "d", "t1", "t2", "bytes", *carried]
    paths = shared.withColumn("d", F.col("pos")).select(*columns).unionByName(later.select(*columns))
    return convs, cut_lineage(paths, "paths")


def burst(convs: DataFrame, paths: DataFrame, most: int) -> tuple[DataFrame, DataFrame | None]:
    """Burst every oversized container. Returns the heads on each conversation's path (conv_id, d, k1, k2,
    bytes, len), the root among them, and the containers that suffixes of burst ones ended in (conv_id, hl, k1, k2,
    chain), hl being the depth at which the container's suffixes begin; none if nothing was burst."""
    zero = F.lit(0).cast("long")
    heads = convs.select("conv_id", zero.alias("d"), zero.alias("k1"), zero.alias("k2"), zero.alias("bytes"), "len")
    big = paths.where("burst")
    active = convs.where("burst").select("conv_id", "k1", "k2")
    placed = None
    if active.isEmpty():
        return heads, placed
    heads = heads.unionByName(big.where("d = 1").select(*heads.columns))
    level, step = 1, 1
    while not active.isEmpty():
        near = big.where((F.col("d") > level) & (F.col("d") <= level + step)).select(
            "conv_id", "d", "t1", "t2", "bytes", "len"
        )
        near = near.join(active, "conv_id")
        words = _words(F.col("t1"), F.col("t2"), F.col("d"))
        folds = {"x1": running_xor(words[0]), "x2": running_xor(words[1])}
        named = scan(near, ["conv_id"], [F.asc("d")], folds).select(
            "conv_id", "d", "bytes", "len",
            F.col("k1").bitwiseXOR(F.col("x1")).alias("k1"), F.col("k2").bitwiseXOR(F.col("x2")).alias("k2"),
        )
        named = cut_lineage(named, "levels")
        sizes = named.groupBy(*KEY).agg(
            F.sum(F.col("len") - F.col("d") + 1).alias("turns"), F.count(F.lit(1)).alias("members")
        )
        sized = cut_lineage(
            named.join(sizes, KEY).select(
                *named.columns, _oversized(most).alias("over"),
                ((F.col("turns") > most) & (F.col("members") == 1)).alias("chain"),
            ),
            "sized",
        )
        heads = heads.unionByName(sized.where("over").select(*heads.columns))
        # Sizes shrink along a path, so the first container that is not oversized is the place.
        found = (
            sized.where("not over").groupBy("conv_id")
            .agg(F.min(F.struct(F.col("d").alias("hl"), "k1", "k2", "chain")).alias("at"))
            .select("conv_id", "at.*")
        )
        placed = found if placed is None else placed.unionByName(found)
        level += step
        step *= 2
        active = cut_lineage(sized.where("over").where(F.col("d") == level).select("conv_id", "k1", "k2"), "active")
    return heads, cut_lineage(placed, "containers")


def sweep(frame: pd.DataFrame) -> pd.DataFrame:
    """All nodes of a shard's containers, from rows (k1, k2, hl, conv_id, d, t1, t2, bytes).

    Suffixes are sorted by container and turns; each opens the nodes that it does not share with the one
    before. Figures are summed from the leaves up. Members of a node that end there come in
    ascending order, as equal suffixes are sorted by conv_id.
    """
    column = lambda name: frame[name].to_numpy(np.int64)
    t1, t2 = column("t1"), column("t2")
    by_turn = np.lexsort((t2, t1))
    fresh = np.append(False, (np.diff(t1[by_turn]) != 0) | (np.diff(t2[by_turn]) != 0))
    ids = np.empty(len(frame), np.int64)
    ids[by_turn] = np.cumsum(fresh)
    order = np.lexsort((column("d"), column("conv_id"), column("k2"), column("k1")))
    k1, k2, conv = column("k1")[order], column("k2")[order], column("conv_id")[order]
    ids, depths, sizes = ids[order].tolist(), column("d")[order], column("bytes")[order].tolist()
    new_container = np.append(True, (np.diff(k1) != 0) | (np.diff(k2) != 0))
    starts = np.flatnonzero(new_container | np.append(True, np.diff(conv) != 0))
    ends = np.append(starts[1:], len(ids))
    container = np.cumsum(new_container)[starts].tolist()
    suffixes = sorted(
        (c, tuple(ids[a:b]), int(conv[a]), int(a)) for c, a, b in zip(container, starts.tolist(), ends.tolist())
    )
    parent, node_conv, depth, members, weight = [], [], [], [], []
    ending: dict[int, list[str]] = {}
    open_nodes: list[int] = []  # the nodes of the suffix before, from its container's top
    last_container, last = None, ()
    for place, turns, conv_id, row in suffixes:
        shared = 0
        if place == last_container:
            for a, b in zip(last, turns):
                if a != b:
                    break
                shared += 1
        del open_nodes[shared:]
        top = int(depths[row])
        for step in range(shared, len(turns)):
            open_nodes.append(len(parent))
            parent.append(open_nodes[-2] if step else -1)
            node_conv.append(conv_id)
            depth.append(top + step)
            members.append(0)
            weight.append(sizes[row + step])
        members[open_nodes[-1]] += 1
        ending.setdefault(open_nodes[-1], []).append(str(conv_id))
        last_container, last = place, turns
    children, leaves, saved = [0] * len(parent), [0] * len(parent), [0] * len(parent)
    for node in range(len(parent) - 1, -1, -1):  # children were opened after their parents
        leaves[node] = leaves[node] or 1
        saved[node] += (members[node] - 1) * weight[node]
        above = parent[node]
        if above >= 0:
            members[above] += members[node]
            node_conv[above] = min(node_conv[above], node_conv[node])
            children[above] += 1
            leaves[above] += leaves[node]
            saved[above] += saved[node]
    digests = [EMPTY_DIGEST] * len(parent)
    for node, found in ending.items():
        digests[node] = hashlib.sha256(",".join(found).encode()).hexdigest()
    return pd.DataFrame(
        {
            "conv_id": node_conv, "depth": depth,
            "parent_conv_id": [node_conv[p] if p >= 0 else None for p in parent],
            "n_convs": members, "n_children": children, "n_leaves": leaves, "saved_tokens": saved,
            "ends_sha256": digests, "top": [p < 0 for p in parent],
        }
    )


def _swept(paths: DataFrame, placed: DataFrame | None, turns: int) -> DataFrame:
    """Nodes of all containers; `top` marks those whose parent is a head."""
    columns = ["k1", "k2", "conv_id", "d", "t1", "t2", "bytes"]
    rows = paths.where("not burst and not chain").select(*columns)
    chains = paths.where("not burst and chain").select("conv_id", "d", "len", F.lit(1).cast("long").alias("hl"))
    if placed is not None:
        below = paths.where("burst").drop("k1", "k2", "chain").join(placed, "conv_id").where("d >= hl")
        rows = rows.unionByName(below.where("not chain").select(*columns))
        chains = chains.unionByName(below.where("chain").select("conv_id", "d", "len", "hl"))
    shards = max(1, -(-turns // SHARD))
    swept = (
        rows.withColumn("shard", F.expr(f"pmod(xxhash64(k1, k2), {shards}L)"))
        .groupBy("shard")
        .applyInPandas(lambda frame: sweep(frame), f"{NODE}, ends_sha256 string, top boolean")
    )
    one, top = F.lit(1).cast("long"), F.col("d") == F.col("hl")
    last = F.col("d") == F.col("len")
    alone = chains.select(
        "conv_id", F.col("d").alias("depth"), F.when(~top, F.col("conv_id")).alias("parent_conv_id"),
        one.alias("n_convs"), F.when(last, 0).otherwise(1).cast("long").alias("n_children"), one.alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(EMPTY_DIGEST)).alias("ends_sha256"),
        top.alias("top"),
    )
    return cut_lineage(swept.unionByName(alone), "nodes")


def _end_digests(heads: DataFrame) -> DataFrame:
    """(d, k1, k2, ends_sha256) of the heads where conversations end. A digest over ids in order cannot be split, so
    the ids of one head pass through one task, in sorted batches of which it keeps the digest's state only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        done: list[tuple] = []
        for batch in batches:
            values = [batch.column(name).to_numpy() for name in (*KEY, "conv_id")]
            if not len(values[0]):
                continue
            same = np.ones(len(values[0]) - 1, bool)
            for column in values[:3]:
                same &= column[1:] == column[:-1]
            starts = np.append(0, np.flatnonzero(~same) + 1)
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(values[0])]):
                mine = tuple(int(column[a]) for column in values[:3])
                text = ",".join(map(str, values[3][a:b].tolist()))
                if mine == key:
                    text = "," + text
                else:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = mine, hashlib.sha256()
                state.update(text.encode())
        if key is not None:
            done.append((*key, state.hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([row[i] for row in done], pa.int64() if i < 3 else pa.string()) for i in range(4)],
            names=[*KEY, "ends_sha256"],
        )

    ending = heads.where("d = len").select(*KEY, "conv_id")
    dealt = ending.repartition(*KEY).sortWithinPartitions(*KEY, "conv_id")
    return dealt.mapInArrow(returns_memory(run), "d long, k1 long, k2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, most: int = CONTAINER) -> DataFrame:
    """(conv_id whole number, turn, role, text, ...) -> one row per node of the trie of rebuilt conversations: conv_id
    (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversation c begins with the first h turns of conversation c - c % 5, all if there are fewer and none
    if it is absent, h being crc32 of c's decimal digits modulo 9, and goes on with its own turns after its first h. % is
    that of SQL: negative ids belong to the family of the multiple of five nearer to zero. Equal conversations are
    members of the same nodes; a row that repeats another one is one more turn. See numbered_turns for ties and nulls.
    An empty table has no nodes, not even a root. Other columns are not looked at. Containers of up to `most`
    turns are not burst.
    """
    convs, paths = rebuilt(numbered_turns(conversations), most)
    turns = convs.agg(F.sum("len")).first()[0] or 0
    heads, placed = burst(convs, paths, most)
    nodes = _swept(paths, placed, turns)
    heads = cut_lineage(heads, "heads")
    owned = cut_lineage(
        heads.groupBy(*KEY).agg(
            F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes")
        ),
        "owned",
    )
    # What hangs below heads: containers, and other heads. Its smallest member's path leads to all heads above it.
    hanging = nodes.where("top").select("conv_id", "depth").unionByName(
        owned.where("d > 0").select("conv_id", F.col("d").alias("depth"))
    )
    links = hanging.join(heads.select("conv_id", *KEY), "conv_id").where("d = depth - 1").drop("conv_id", "depth")
    children = cut_lineage(links.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_children")), "children")
    owned = owned.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    own = owned.select(
        "conv_id", F.col("d").alias("upto"), (F.col("n_children") == 0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
    )
    given = nodes.where("top").select(
        "conv_id", (F.col("depth") - 1).alias("upto"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved")
    )
    sums = (
        given.unionByName(own).join(heads.select("conv_id", *KEY), "conv_id").where("d <= upto")
        .groupBy(*KEY).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    )
    # The parent's smallest member, for every node below a head.
    names = owned.select(*KEY, F.col("conv_id").alias("parent_conv_id"))
    above = cut_lineage(
        hanging.join(heads.select("conv_id", *KEY), "conv_id").where("d = depth - 1")
        .join(names, KEY).select("conv_id", "depth", "parent_conv_id"),
        "above",
    )
    columns = [part.split(" ")[0] for part in NODE.split(", ")] + ["ends_sha256"]
    tops = nodes.where("top").drop("parent_conv_id").join(above, ["conv_id", "depth"])
    top_heads = (
        owned.join(sums, KEY).join(_end_digests(heads), KEY, "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_DIGEST)))
        .withColumnRenamed("d", "depth").join(above, ["conv_id", "depth"], "left")
    )
    return (
        nodes.where("not top").select(*columns)
        .unionByName(tops.select(*columns))
        .unionByName(top_heads.select(*columns))
    )


# ---- the same in DuckDB's SQL --------------------------------------------------------------------


def oracle() -> str:
    """SQL for prefix_trie(conversations)."""
    bits = ", ".join(["-1"] * 8)
    crc = f"""xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
      string_split(conv_id::VARCHAR, ''), lambda ch: [ord(ch)::BIGINT, {bits}]))),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))"""
    return f"""
    WITH own AS (
      SELECT conv_id, md, octets, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md) AS pos
      FROM (SELECT conv_id, turn, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS md,
        strlen(coalesce(text, '')) AS octets FROM conversations WHERE conv_id IS NOT NULL)
    ), ids AS (
      SELECT conv_id, conv_id - conv_id % {FAMILY} AS base, {crc} % {SHARED} AS h FROM own GROUP BY conv_id
    ), sized AS (
      SELECT ids.*, least(h, (SELECT count(*) FROM own WHERE own.conv_id = ids.base)) AS kept FROM ids
    ), turns AS (
      SELECT s.conv_id, pos AS d, md, octets FROM sized s JOIN own ON own.conv_id = s.base AND pos <= h
      UNION ALL
      SELECT s.conv_id, kept + pos - h, md, octets FROM sized s JOIN own ON own.conv_id = s.conv_id AND pos > h
    ), p AS (
      SELECT conv_id, d, octets, md5(string_agg(md, '' ORDER BY d) OVER (PARTITION BY conv_id ORDER BY d)) AS k FROM turns
      UNION ALL SELECT conv_id, 0, 0, '' FROM ids
    ), n AS (
      SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, max(octets) AS octets FROM p GROUP BY d, k
    ), c AS (
      SELECT up.d, up.k, count(*) AS n_children
      FROM n JOIN p up ON up.conv_id = n.conv_id AND up.d = n.d - 1 GROUP BY up.d, up.k
    ), s AS (
      SELECT p.d, p.k, count(*) FILTER (c.k IS NULL) AS n_leaves, sum((n_convs - 1) * n.octets) AS saved
      FROM n LEFT JOIN c ON c.d = n.d AND c.k = n.k JOIN p ON p.conv_id = n.conv_id AND p.d <= n.d GROUP BY p.d, p.k
    ), e AS (
      SELECT d, k, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ends
      FROM p WHERE d = (SELECT max(q.d) FROM p q WHERE q.conv_id = p.conv_id) GROUP BY d, k
    )
    SELECT n.conv_id::BIGINT AS conv_id, n.d::BIGINT AS depth, up.conv_id::BIGINT AS parent_conv_id,
      n.n_convs::BIGINT AS n_convs, coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
      saved::BIGINT AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
    FROM n LEFT JOIN c ON c.d = n.d AND c.k = n.k JOIN s ON s.d = n.d AND s.k = n.k
    LEFT JOIN e ON e.d = n.d AND e.k = n.k
    LEFT JOIN p pp ON pp.conv_id = n.conv_id AND pp.d = n.d - 1 LEFT JOIN n up ON up.d = pp.d AND up.k = pp.k
    """
