from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from accessgrid.llm import jaccard_join as jj


def shingles(text):
    w = (text or "").encode().lower().split()
    n = min(5, len(w))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if n else frozenset()


def brute(rows, threshold=0.8):
    """[(id, text)] -> sorted (id, class_id, n_links, n_copies)."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))
    links, copies = [0] * len(rows), [0] * len(rows)

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    held = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s or [None]:
            held[x].append(i)
    pairs = {p for own in held.values() for p in combinations(own, 2)}
    for i, j in pairs:
        same = sets[i] == sets[j]
        if same or len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9:
            links[i] += 1
            links[j] += 1
            copies[i] += same
            copies[j] += same
            parent[max(top(i), top(j))] = min(top(i), top(j))
    low = defaultdict(list)
    for i, (own, _) in enumerate(rows):
        low[top(i)].append(own)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in low.items()}
    return sorted(((rows[i][0], least[top(i)], links[i], copies[i]) for i in range(len(rows))), key=str)


def rows_of(df):
    return sorted((tuple(r[c] for c in ("doc_id", "class_id", "n_links", "n_copies")) for r in df.collect()), key=str)


def test_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert rows_of(jj.jaccard_join(docs)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_odd_rows(odd, none):
    assert rows_of(jj.jaccard_join(odd)) == brute([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert rows_of(jj.jaccard_join(none)) == []


def test_large_group_of_near_copies(spark, monkeypatch):
    """Buckets of more than one tile, pairs that meet in several buckets."""
    monkeypatch.setattr(jj, "TILE", 16)
    rng = np.random.default_rng(3)
    words = [f"w{n}" for n in range(120)]
    rows = []
    for n in range(90):
        own = list(words)
        for at in rng.choice(120, n % 4, replace=False):
            own[at] = f"x{n}"
        rows.append((n, " ".join(own)))
    rows += [(200 + n, f"quite another text number {n} of some words") for n in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(jj.jaccard_join(df)) == brute(rows)


def test_one_of_each(odd, spark):
    kept = jj.one_of_each(odd)
    assert kept.columns == odd.columns
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    assert max(got.values()) == 1
    assert {i for i, _ in got} == {1, 3, 4, 6}  # 2 and 5 hold no words, as 1; the row without id is a copy of 4
    assert sum(i == 4 for i, _ in got) == 2


def test_word_hashes_depend_on_the_word_alone():
    words = ["a", "bb", "x" * 64, "x" * 65, "x" * 200, "y" * 64 + "z"]
    alone = [int(jj._word_hashes(pa.array([w]))[0]) for w in words]
    assert jj._word_hashes(pa.array(words)).tolist() == alone
    assert len(set(alone)) == len(words)


def test_runs():
    assert jj.runs_needed(0.8, 0.999, 3) == 10
    with pytest.raises((ValueError, ZeroDivisionError)):
        jj.runs_needed(0.8, 1.0, 3)
