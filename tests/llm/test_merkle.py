import hashlib
import zlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from accessgrid.llm import merkle, queries

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, add=0):
    out = []
    for name in FIELDS:
        v = row[name]
        v = v + add if name == "n_chars" and v is not None else v
        out.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return h(*out)


def tree(digests, k):
    """Levels from the lowest up; the last has one node."""
    levels = [digests]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([h(*low[i : i + k]) for i in range(0, len(low), k)])
    return levels


def steps(levels, at, k):
    out = []
    for low in levels[:-1]:
        start = at - at % k
        out.append((at % k, [d for i, d in enumerate(low[start : start + k]) if i != at % k]))
        at //= k
    return out


def null_first(v):
    return (v is not None, v if not isinstance(v, str) else v.encode()) if v is not None else (False, 0)


def brute(rows, k=2):
    rows = sorted(rows, key=lambda r: (null_first(r["lang"]), null_first(r["doc_id"]), leaf(r)))
    groups = [list(g) for _, g in groupby(rows, key=lambda r: r["lang"])]
    low = [tree([leaf(r) for r in g], k) for g in groups]
    top = tree([t[-1][0] for t in low], k)
    out = []
    for n, (g, t) in enumerate(zip(groups, low)):
        for at, r in enumerate(g):
            path = steps(t, at, k) + steps(top, n, k)
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            d = leaf(r, int(hit))
            for slot, others in path:
                d = h(*others[:slot], d, *others[slot:])
            root = top[-1][0]
            out.append((r["doc_id"], leaf(r), t[-1][0], root, h(*[x for _, o in path for x in o]), d, d == root))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_equals_brute_force(spark, sf_dir, docs):
    out = queries.QUERIES["op13_merkle"](spark, sf_dir)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = brute(docs.collect())
    assert got(out) == want
    assert 0 < sum(not r[-1] for r in want) < len(want)


@pytest.mark.parametrize("k", [2, 3, 5])
def test_odd_rows_and_runs_of_any_length(odd, k):
    clash = odd.withColumn("tree", F.lit(1)).withColumn("at", F.lit("x")).withColumn("leaf", F.lit(2)).withColumn("LEVEL", F.lit(2))
    assert got(merkle.verified_manifest(clash, siblings=k)) == brute(odd.collect(), k)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 9])
def test_small_trees(spark, n):
    rows = spark.range(n).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.when(F.col("id") > 5, "é").otherwise("en").alias("lang"),
        F.col("id").alias("n_chars"), F.lit("t").alias("text"),
    )
    assert got(merkle.verified_manifest(rows)) == brute(rows.collect())


def test_repeated_rows(spark):
    """A third of all rows being one row."""
    rows = spark.range(300).select(
        F.when(F.col("id") < 100, 7).otherwise(F.col("id")).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("source"),
        F.lit("en").alias("lang"), F.lit(9223372036854775806).alias("n_chars"), F.lit("").alias("text"),
    )
    assert got(merkle.verified_manifest(rows)) == brute(rows.collect())


def test_empty_table(none):
    out = merkle.verified_manifest(none)
    assert out.count() == 0 and out.columns[-1] == "verified"


def test_manifest_keeps_columns(odd):
    made = merkle.manifest(odd, merkle.hashed(merkle.field(F.col("text"))), "lang", [F.col("doc_id")])
    assert set(odd.columns) < set(made.proofs.columns) and made.proofs.count() == odd.count()
    again = made.proofs.select(merkle.as_hex(merkle.folded(F.col("digest"), F.col("path"))).alias("r")).distinct().collect()
    assert [r["r"] for r in again] == [made.root]
