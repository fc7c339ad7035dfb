import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from accessgrid.llm import mixing as mx
from accessgrid.llm.queries import WEIGHTS


def deal(budget, children):
    """{name: (capacity, weight)} -> {name: share}, by giving the rest to those that have room, again and again."""
    share = dict.fromkeys(children, 0.0)
    open_ = {n for n, (c, _) in children.items() if c > 0}
    left = budget
    while left > 1e-9 and open_:
        w = sum(children[n][1] for n in open_)
        given = 0.0
        for n in list(open_):
            part = min(left * children[n][1] / w, children[n][0] - share[n])
            share[n] += part
            given += part
        open_ = {n for n in open_ if children[n][0] - share[n] > 1e-9}
        left -= given
    return share


def tree_budgets(leaves, total, epochs, weights):
    out = {}

    def down(path, budget):
        depth = len(path)
        if depth == 3:
            out[path] = budget
            return
        caps = defaultdict(float)
        for leaf, tokens in leaves.items():
            if leaf[:depth] == path:
                caps[leaf[: depth + 1]] += tokens * epochs
        own = {p: (c, weights.get(mx.LEVELS[depth], {}).get(p[-1], 1.0)) for p, c in caps.items()}
        for p, share in deal(budget, own).items():
            down(p, share)

    down((), total)
    return out


@pytest.mark.parametrize("share", [0.05, 0.6, 1.3, 5.0])
def test_budgets_and_prefixes(docs, share):
    rows = mx.mix(docs, WEIGHTS, budget_share=share).collect()
    supply = docs.select(mx.domain_of("source").alias("d"), "lang", "source", mx.n_tokens("text").alias("n")).collect()
    leaves = Counter()
    for r in supply:
        leaves[r["d"], r["lang"], r["source"]] += r["n"]
    total = sum(leaves.values())
    want = tree_budgets(leaves, total * share, 2, WEIGHTS)
    by_leaf = defaultdict(list)
    for r in rows:
        by_leaf[r["domain"], r["language"], r["source"]].append(r)
    for leaf, budget in want.items():
        own = by_leaf.pop(leaf, [])
        drawn, tokens = sum(r["n_tokens"] for r in own), leaves[leaf]
        if own:
            assert abs(own[0]["leaf_budget"] - budget) <= 1.001
            budget = own[0]["leaf_budget"]
            ids = Counter(r["doc_id"] for r in own)
            assert max(ids.values()) <= 2
            last = budget // tokens
            part = sorted((r["start"], r["n_tokens"]) for r in own)
            at = 0
            for start, n in part:  # whole epochs, and a prefix of the last one, without gaps
                assert start == at
                at += n
            assert at >= budget and all(s < budget for s, _ in part)
            assert all(r["epoch"] == r["start"] // tokens for r in own) and max(r["epoch"] for r in own) <= last
            assert drawn >= budget
        else:
            assert budget < 1.001
    assert not by_leaf
    if share >= 2:
        assert sum(r["n_tokens"] for r in rows) == 2 * total


def test_order_is_seeded(docs):
    pick = lambda seed: sorted((r["doc_id"], r["epoch"]) for r in mx.mix(docs, WEIGHTS, budget_share=0.2, seed=seed).collect())
    assert pick(1) == pick(1) != pick(2)


def test_each_epoch_has_an_order_of_its_own(docs):
    rows = mx.mix(docs, {}, budget_share=2.0, domain=F.lit("d")).collect()
    orders = [[r["doc_id"] for r in sorted(rows, key=lambda r: r["start"]) if r["epoch"] == e] for e in (0, 1)]
    assert sorted(orders[0]) == sorted(orders[1]) and orders[0] != orders[1]


def test_repeated_rows_are_drawn_as_often_as_the_budget_says(spark):
    rows = spark.createDataFrame([(1, "a b", "en", "s", "x"), (1, "a b", "en", "s", "y")] * 3 + [(2, "c d", "en", "s", "z")], "doc_id int, text string, lang string, source string, extra string")
    for share in (0.2, 0.5, 0.9, 1.4, 2.0):
        drawn = Counter(r["doc_id"] for r in mx.mix(rows, {}, budget_share=share).collect())
        out = mx.mixed(rows, {}, budget_share=share).collect()
        assert Counter(r["doc_id"] for r in out) == drawn, share
        assert max(Counter(map(tuple, out)).values()) <= 3 * 2  # three rows of a kind, two epochs


def test_clashing_names(docs):
    clash = docs.withColumns({n: F.lit(n) for n in ("_key", "times", "_time", "one", "rows", "Place")})
    out = mx.mixed(clash, WEIGHTS)
    assert out.columns == clash.columns
    assert {tuple(r[len(docs.columns):]) for r in out.collect()} == {("_key", "times", "_time", "one", "rows", "Place")}


def test_small_ranges_give_the_same_order(docs, monkeypatch):
    key = lambda: sorted((r["doc_id"], r["epoch"], r["start"]) for r in mx.mix(docs, {}, budget_share=0.4, domain=F.lit("d")).collect())
    one = key()
    monkeypatch.setattr(mx, "RANGE_ROWS", 2)
    assert key() == one


def test_odd_rows(odd, none):
    got = Counter((r["doc_id"], r["n_tokens"]) for r in mx.mix(odd, WEIGHTS, budget_share=9.0).collect())
    n = sum(len((r["text"] or "").encode().split()) > 0 for r in odd.collect())
    assert sum(got.values()) == 2 * n and got[4, 4] == 4 and got[None, 4] == 2
    assert mx.mix(none, WEIGHTS).count() == 0
    rows = mx.mixed(odd, WEIGHTS, budget_share=9.0)
    assert rows.columns == odd.columns and rows.count() == 2 * n


def test_token_counts(odd):
    for r in odd.select("text", mx.n_tokens("text").alias("n")).collect():
        assert r["n"] == len((r["text"] or "").encode().split())


def test_deal():
    assert deal(10, {"a": (2, 1), "b": (100, 1), "c": (100, 3)}) == {"a": 2, "b": pytest.approx(2), "c": pytest.approx(6)}
    assert math.isclose(sum(deal(10, {"a": (2, 1), "b": (3, 1)}).values()), 5)
