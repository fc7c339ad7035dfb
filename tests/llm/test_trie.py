import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

from accessgrid.llm import queries, trie

SCHEMA = "conv_id long, turn int, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mixed = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, mixed, (role, text)))
    own = {c: [x[-1] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rest = abs(c) % 20
        out[c] = own.get(c - rest if c >= 0 else c + rest, [])[:h] + mine[h:]
    return out


def brute(rows):
    convs = rebuilt(rows)
    members, ended = {}, {}
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
        ended.setdefault(tuple(seq), []).append(c)
    children, leaves, saved = {}, {}, {}
    for node in sorted(members, key=len, reverse=True):
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
        own = (len(members[node]) - 1) * len(WORDS.findall(node[-1][1])) if node else 0
        leaves[node] = leaves.get(node, 0) or 1
        saved[node] = saved.get(node, 0) + own
        if node:
            leaves[node[:-1]] = leaves.get(node[:-1], 0) + leaves[node]
            saved[node[:-1]] = saved.get(node[:-1], 0) + saved[node]
    return sorted(
        (
            (
                min(m), len(node), min(members[node[:-1]]) if node else None, len(m), children.get(node, 0), leaves[node], saved[node],
                hashlib.sha256(",".join(map(str, sorted(ended.get(node, [])))).encode()).hexdigest(),
            )
            for node, m in members.items()
        ),
        key=str,
    )


def got(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=str)


def rows_of(df):
    return [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in df.collect()]


def made_up(spark):
    """Copies, shared beginnings, a long conversation, ties, nulls, turnless ones."""
    rows = []
    for c in range(400):
        kind = c % 5
        turns = [("user", f"hello {c % 3}")] + [("bot", f"answer {(c // (7 ** d)) % 2} {d}") for d in range(c % 9)]
        turns = [("system", "the same words")] * 3 + [("user", "bye")] if kind < 2 else turns
        rows += [(c, n, role, text) for n, (role, text) in enumerate(turns)]
    rows += [(500, n, "user", f"turn {n % 3}") for n in range(41)] + [(520, n, "user", f"turn {n % 3}") for n in range(40)] + [(540, n, "user", f"turn {n % 3}") for n in range(41)]
    rows += [(None, 1, "user", "nobody"), (601, 1, None, None), (601, None, "user", "first"), (601, 1, "user", "tie"), (601, 1, "user", "tie"), (602, 3, "user", ""), (-7, 0, "user", "minus"), (-7, 1, None, "x\x0by\x1cz \t" * 3000), (2003, 0, "u", "x")]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("block", [256, 2, 3])
def test_made_up_conversations(spark, monkeypatch, block):
    monkeypatch.setattr(trie, "CELLS", 60)
    monkeypatch.setattr(trie, "CHUNK", 20)
    df = made_up(spark)
    clash = df.withColumn("place", F.lit(1)).withColumn("key", F.lit("k")).withColumn("ID", F.lit(1))
    assert got(trie.prefix_trie(clash, block)) == brute(rows_of(df))


def test_only_turnless_conversations(spark):
    lone = [c for c in range(1, 60) if c % 20 and zlib.crc32(str(c).encode()) % 4 >= 1][:3]
    df = spark.createDataFrame([(c, 0, "user", "x") for c in lone], SCHEMA)
    want = brute(rows_of(df))
    assert len(want) == 1 and want[0][5] == 1
    assert got(trie.prefix_trie(df)) == want


def test_query(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    assert got(queries.QUERIES["op12_trie"](spark, sf_dir)) == brute(rows_of(df))


def test_empty_table(spark):
    for rows in ([], [(None, 1, "user", "x")]):
        out = trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))
        assert out.columns == COLUMNS and out.count() == 0
