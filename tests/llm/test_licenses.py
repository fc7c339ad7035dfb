import math
import random
import re
import textwrap
from collections import Counter

from accessgrid.llm import licenses as lc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def brute(rows):
    blocks = [set(WORD.findall(low(x))) for _, t in rows for x in (t or "").split("\n")]
    out = []
    templates = [(label, set(WORD.findall(low(t)))) for label, t in lc.TEMPLATES]
    for i, t in rows:
        w = WORD.findall(low(t or ""))
        places, labels = [], set()
        for phrase, label in lc.PHRASES.items():
            p = phrase.split()
            own = [n for n in range(len(w) - len(p) + 1) if w[n : n + len(p)] == p]
            places += own
            labels |= {label} if own else set()
        score, more = 0.0, set(labels)
        for x in (t or "").split("\n"):
            have = set(WORD.findall(low(x)))
            for label, own in templates:
                share = len(own & have) / len(own)
                if len(own & have) >= math.ceil(lc.CONTAINMENT * len(own) - 1e-9):
                    score, more = max(score, share), more | {label}
        score = 1.0 if places else score
        out.append((i, len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(more)), round(score, 9)))
    assert blocks or not rows
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((*tuple(r)[:7], round(r["score"], 9)) for r in df.collect()), key=str)


def test_against_all_blocks(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for df in (docs, odd):
        want = brute([(r["doc_id"], r["text"]) for r in df.collect()])
        assert rows_of(lc.license_scan(df)) == want
    assert rows_of(lc.license_scan(none)) == []


def test_phrases_and_templates(spark):
    rows = [
        (1, "ALL rights, reserved! all rights\nreserved. (cc) BY\x00cc-by 4.0; general public licence"),
        (2, "reserved all rights reserved reserved"),
        (3, "x\nPermission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies\ny"),
        (4, "permission is granted"),
        (5, "cc BY K cc İby"),
        (6, "all"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'t' AS tokens", "1 AS n_words")
    got = rows_of(lc.license_scan(df))
    assert got == brute(rows)
    by_id = {r[0]: r for r in got}
    assert by_id[1][2:6] == (4, 0, 8, "cc-by,reserved") and by_id[3][6] == "mit" and by_id[4][6] == ""


def test_prefix_order_follows_the_corpus(spark):
    df = spark.createDataFrame([(n, "common rare" if n == 0 else "common") for n in range(9)], "doc_id long, text string")
    tokens = lc.blocks(df, "doc_id", "text")
    (t,) = lc.ordered_templates(tokens, [("x", "common rare never")], 0.6)
    assert t["words"] == ["never", "rare", "common"] and t["need"] == 2 and t["prefix"] == ["never", "rare"]
    assert Counter(r["label"] for r in lc.matches(tokens, [t]).collect()) == {"x": 1}


def test_wrapped_templates(spark):
    """Every template of more than a few words, hard-wrapped as in files, alone and amid other text."""
    long = [(label, x) for label, x in lc.TEMPLATES if len(x) > 60]
    texts = [(label, "\n".join(f" * {line}" for line in textwrap.wrap(x, 40))) for label, x in long]
    texts += [(label, "own words before\nit and after\n" + x + "\nmore of them\n\nother paragraph") for label, x in texts]
    rows = list(enumerate(x for _, x in texts))
    got = {r["doc_id"]: r for r in lc.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for n, (label, _) in enumerate(texts):
        assert label in got[n]["labels"].split(",") and got[n]["score"] == 1.0


def test_windows(spark):
    """Words of a template count together within its length and a paragraph, not from all over a text."""
    mit = lc.TEMPLATES[2][1].split()
    apart = "\n".join(f"{w} {' '.join(f'x{n}y{k}' for k in range(9))}" for n, w in enumerate(mit))
    blank = "\n".join(mit[:25]) + "\n \t\n\n" + "\n".join(mit[25:])
    some = "\n".join(mit[: int(0.9 * len(mit))])
    rows = [(1, apart), (2, blank), (3, some), (4, "\n".join(mit)), (5, apart.replace("\n", " "))]
    got = {r["doc_id"]: r for r in lc.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: r["labels"] for i, r in got.items()} == {1: "", 2: "", 3: "mit", 4: "mit", 5: "mit"}
    assert got[4]["score"] == 1.0 and lc.CONTAINMENT <= got[3]["score"] < 1.0


def test_windows_against_all_windows(spark):
    """Each paragraph, window by window."""
    rng = random.Random(3)
    templates = [("x", "under the mit license now"), ("y", "you may not use this file except in compliance"), ("z", "a b a b c")]
    feeds = [" "] * 6 + ["\n"] * 6 + ["\n\n", "\n \n"]

    def run():
        own = rng.choice(templates)[1].split()
        return [w if rng.random() < 0.85 else rng.choice(["a", "other", "the"]) for w in own[rng.randrange(3) :]]

    rows = [(n, "".join(w + rng.choice(feeds) for _ in range(rng.randrange(1, 5)) for w in run())) for n in range(300)]
    want = {}
    for i, text in rows:
        best = {}
        for p in re.split(r"\n\s*\n", text):
            w = WORD.findall(low(p))
            for label, t in templates:
                own, long = set(t.split()), len(t.split())
                sets = [set(w[k : k + long]) for k in range(len(w))] + [set(WORD.findall(x)) for x in p.split("\n")]
                most = max((len(own & s) for s in sets), default=0)
                if most >= math.ceil(lc.CONTAINMENT * len(own) - 1e-9):
                    best[label] = max(best.get(label, 0), most / len(own))
        want[i] = (",".join(sorted(best)), round(max(best.values(), default=0.0), 9))
    assert len({x for x, _ in want.values()}) > 3
    got = lc.license_scan(spark.createDataFrame(rows, "doc_id long, text string"), templates=templates).collect()
    assert {r["doc_id"]: (r["labels"], round(r["score"], 9)) for r in got} == want
