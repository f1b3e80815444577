"""The burst trie against a plain prefix tree."""

import hashlib
import random
import zlib

import duckdb
import pytest

from voltmart.llm import trie


def plain(rows):
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, digest, (role, text)))
    own = {c: [t[3] for t in sorted(v)] for c, v in own.items()}
    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        paths[c] = own.get(base, [])[:h] + own[c][h:]
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    kids, leaves, saved = {}, {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = leaves.get(node, 0) or 1
        if node:
            saved[node] = saved.get(node, 0) + (len(members[node]) - 1) * len(node[-1][1].encode())
            up = node[:-1]
            kids[up] = kids.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[node]
            saved[up] = saved.get(up, 0) + saved[node]
    out = []
    for node, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(paths[c]) == len(node))
        out.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), kids.get(node, 0),
                    leaves[node], saved.get(node, 0), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(str, out))


SCHEMA = "conv_id long, turn long, role string, text string"


def found(spark, rows, schema=SCHEMA, **kw):
    df = trie.prefix_trie(spark.createDataFrame(rows, schema), **kw)
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(str(tuple(r)) for r in df.collect())


def talk():
    """Common openings, copies, conversations cut short at every depth, and odd rows."""
    dice = random.Random(4)
    rows = []
    for c in range(120):
        opening = [("system", "be brief"), ("user", f"q{c % 3}")]
        rest = [(dice.choice(["user", "assistant"]), dice.choice(["yes", "nö", "", None])) for _ in range(dice.randrange(6))]
        rows += [(c, i, *turn) for i, turn in enumerate(opening + rest)]
    for c in range(1000, 1040):  # a comb: one long talk, left at every depth
        rows += [(5 * c, i, "user", f"step {i}") for i in range(c - 990)]
    for c in range(2000, 2030):  # copies
        rows += [(c, i, "user", "same " * i) for i in range(12)]
    rows += [(-c, i, None, f"neg{i}") for c in range(1, 12) for i in range(10)]
    rows += [(3001, None, "user", "first"), (3001, 0, "user", "second"), (3001, 0, "user", "also second"), (3001, 0, None, None),
             (3001, 0, None, None), (None, 1, "user", "nobody"), (3333, 1, "a", "bc"), (3334, 1, "ab", "c")]
    rows += [(4002, i, "user", f"alone {i}") for i in range(300)]
    dice.shuffle(rows)
    return rows


@pytest.mark.parametrize("most", [trie.CONTAINER, 40, 3])
def test_nodes_against_a_plain_tree(spark, most):
    rows = talk()
    assert found(spark, rows, most=most) == plain(rows)


def test_sql_says_the_same(spark, tmp_path):
    rows = talk()
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "c"))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/c/*.parquet'")
    result = connection.execute(
        f"SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 FROM ({trie.oracle()})")
    assert sorted(str(tuple(r)) for r in result.fetchall()) == plain(rows)


def test_one_conversation_with_most_rows_and_few_shards(spark, monkeypatch):
    from voltmart.operators import scan

    monkeypatch.setattr(trie, "SHARD", 50)
    rows = talk() + [(7777, i, "user", f"t{i % 7}") for i in range(900)] + [(7778, i, "user", f"t{i % 7}") for i in range(900)]
    plain_scan = scan.scan
    monkeypatch.setattr(trie, "scan", lambda df, keys, order, folds: plain_scan(df, keys, order, folds, most=200))
    assert found(spark, rows, most=60) == plain(rows)


def test_small_tables_and_clashing_names(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "x")]) == []
    turnless = next(c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    rows = [(turnless, 0, "user", "gone")]
    assert found(spark, rows) == plain(rows) and len(plain(rows)) == 1
    rows = [(0, 1, "user", "x", 5, "k", 7), (0, 2, "user", "y" * 100_000, 6, "k", 8), (0, 2, "user", "y" * 100_000, 6, "k", 8)]
    assert found(spark, rows, SCHEMA + ", len long, digest string, depth int") == plain(rows)
    assert found(spark, [(5, 1, "u", "x")], "conv_id int, turn int, role string, text string") == plain([(5, 1, "u", "x")])
