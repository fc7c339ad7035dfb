import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from accessgrid.llm import lm


def symbols(text):
    return [w.decode() for w in (text or "").encode().lower().split()] + [lm.END]


def is_held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


class Brute:
    """The same model with dictionaries."""

    def __init__(self, texts, share):
        all_ = [symbols(t) for t in texts]
        self.c = Counter(s for t in all_ for s in t)
        self.n, self.v = sum(self.c.values()), len(self.c)
        least = max(2, math.ceil(share * self.n))
        self.head = {w for w, c in self.c.items() if c >= least} | {lm.END}
        self.p, self.factor = [], []
        before = {(w,): c for w, c in self.c.items()}
        for length in (1, 2):
            grams = Counter(tuple(t[i - length : i + 1]) for t in all_ for i in range(length, len(t)))
            grams = {g: c for g, c in grams.items() if c >= least and set(g) <= self.head and (length == 1 or (g[:-1] in before and g[1:] in before))}
            by = defaultdict(list)
            for g, c in grams.items():
                by[g[:-1]].append((g, c))
            p, factor = {}, {}
            for context, own in by.items():
                n = before[context]
                below = [10 ** self.log(g[1:]) for g, _ in own]
                rest, rest_below = n - sum(c for _, c in own), max(1 - sum(below), 1e-12)
                gain = sum(c * math.log(c / n / b) for (_, c), b in zip(own, below))
                gain += rest * math.log(rest / n / rest_below) if rest > 0 else 0
                if 2 * gain > lm.MIN_RATIO * len(own) and sum(below) < 1:
                    for g, c in own:
                        p[g] = math.log10((c - lm.DISCOUNT) / n)
                    factor[context] = math.log10((1 - sum((c - lm.DISCOUNT) / n for _, c in own)) / (1 - sum(below)))
            self.p.append(p), self.factor.append(factor)
            before = grams

    def root(self, w):
        return math.log10((self.c.get(w, 0) + 1) / (self.n + self.v + 1))

    def log(self, gram):
        """Of the last symbol after the rest."""
        if len(gram) == 1 or len(self.p) < len(gram) - 1:
            return self.root(gram[-1]) if len(gram) == 1 else self.log(gram[1:])
        if gram in self.p[len(gram) - 2]:
            return self.p[len(gram) - 2][gram]
        return self.log(gram[1:]) + self.factor[len(gram) - 2].get(gram[:-1], 0.0)

    def score(self, text):
        s = symbols(text)
        return sum(self.root(w) for w in s), sum(self.log(tuple(s[max(0, i - 2) : i + 1])) for i in range(len(s)))


def check(df, monkeypatch, share):
    monkeypatch.setattr(lm.train, "__defaults__", (share,))
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    model = Brute([t for i, t in rows if not is_held(i)], share)
    want = sorted(((i, not is_held(i), len(symbols(t)), sum(model.c.get(w, 0) > 0 for w in symbols(t)), model.n, *model.score(t)) for i, t in rows), key=str)
    got = sorted((tuple(r) for r in lm.score(df, ~lm.held_out("doc_id")).collect()), key=str)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)


@pytest.mark.parametrize("share", [4e-6, 1e-3])
def test_against_dictionaries(docs, monkeypatch, share):
    check(docs, monkeypatch, share)


def test_odd_rows(odd, monkeypatch):
    check(odd, monkeypatch, 1e-3)


def test_empty(none):
    assert lm.score(none, ~lm.held_out("doc_id")).count() == 0


def test_probabilities_sum_to_one(docs):
    texts = docs.select(F.coalesce("text", F.lit("")).alias("t"))
    tree, counts = lm.train(texts, 1e-3)
    everything = sum(10 ** lm._log_p(tree, np.arange(1, tree.size), 0))
    rare = sum((r["c"] + 1) / (tree.total + tree.distinct + 1) for r in counts.collect() if r["word"] not in set(tree.words.to_pylist()))
    unseen = 1 / (tree.total + tree.distinct + 1)
    assert math.isclose(everything + rare + unseen, 1)
    for length in (1, 2):
        context, factor = tree.other[length - 1]
        assert len(context)
        for c, f in list(zip(context, factor))[:20]:
            symbols_ = c * tree.size + np.arange(1, tree.size)
            below = lm._log_p(tree, symbols_, length - 1)
            own = 10 ** lm._log_p(tree, symbols_, length)
            assert math.isclose(own.sum() + 10**f * (1 - (10**below).sum()), 1, rel_tol=1e-6)


def test_held_out_texts_are_likelier_than_under_single_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    row = lm.score(docs, ~lm.held_out("doc_id")).filter("NOT training").agg(F.sum("base_score"), F.sum("score")).first()
    assert row[1] > row[0]


def test_rarer_sequences_meet_the_texts_in_a_join(docs, odd, monkeypatch):
    monkeypatch.setattr(lm, "HEAD_SHARE", 2e-3)
    monkeypatch.setattr(lm, "PART_PLACES", 5000)
    check(docs, monkeypatch, 0.0)
    check(odd, monkeypatch, 0.0)
    monkeypatch.setattr(lm, "HEAD_SHARE", 2.0)
    check(odd, monkeypatch, 0.0)


def test_what_stands_twice_is_in_the_tree_whatever_else_there_is(spark):
    rng = np.random.default_rng(1)
    rows = [(7 * n + 1_000_000, " ".join(f"w{x}" for x in rng.integers(0, 5000, 10_000))) for n in range(70)]
    rows += [(i, "alpha beta gamma delta epsilon zeta") for i in (0, 2)]  # neither is held out
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert not any(is_held(i) for i in (0, 2))
    for row in lm.score(df, ~lm.held_out("doc_id")).filter("doc_id <= 2").collect():
        assert row["train_tokens"] > 550_000
        assert row["score"] > row["base_score"] + 5


def test_words_without_a_number(docs, odd, monkeypatch):
    monkeypatch.setattr(lm, "MAX_WORDS", 300)
    monkeypatch.setattr(lm, "PART_PLACES", 5000)
    monkeypatch.setattr(lm, "CUT", 70)
    check(docs, monkeypatch, 0.0)
    check(odd, monkeypatch, 0.0)


def test_what_is_shuffled_to_count_pairs_is_small(spark):
    texts = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text")
    tree, _ = lm.train(texts)
    cuts = lm.coded(texts.select(F.lit(0).alias("id"), "text", F.lit(True).alias("t")), "id", "text", "t")
    packed = F.length("keys") + F.length("counts") + F.coalesce(F.length("contexts"), F.lit(0)) + F.coalesce(F.length("suffixes"), F.lit(0))
    for length, most in ((1, 8), (2, 12)):  # bytes for each place; a key of 8 bytes with context, suffix and number has up to 32
        assert lm.sequence_blocks(cuts, tree, length).agg(F.sum(packed)).first()[0] < most * tree.total


@pytest.mark.parametrize("values", [[], [0], [0, 0, 5], [3, 1 << 63, (1 << 64) - 1], list(range(1000)) * 9])
def test_packed_values_come_back(values):
    values = np.array(values, np.uint64)
    assert lm._unpacked([lm._packed(values), lm._packed(values)], np.uint64).tolist() == [*values, *values]
    if len(values):
        assert lm._walked([lm._steps(np.sort(values))]).tolist() == sorted(values)
