import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry
import corpus_pipeline as pipe
from accessgrid.llm.common import written
from test_jaccard_join import brute as near_brute
from test_lines import brute as lines_brute
from test_quality import base


@pytest.fixture(scope="module")
def steps(spark, docs, sf_dir):
    out = [docs]
    for _, stage in pipe.STAGES:
        out.append(written(stage(spark, out[-1], sf_dir)))
    return out


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_columns(steps):
    for df in steps[:-1]:
        assert df.columns == steps[0].columns


def test_quality_stage(steps):
    before, after = pairs(steps[0]), pairs(steps[1])
    assert set(after) <= {p for p in before if not base(p[1])[5]}
    assert len(after) > 0.8 * sum(not base(t)[5] for _, t in before)


def test_line_stage(steps):
    before = pairs(steps[1])
    gone = {(i, n): removed for (i, n, removed) in lines_brute(before)}
    assert len(gone) == len(before)
    after = dict(pairs(steps[2]))
    for i, t in before:
        n = sum(bool(x.strip()) for x in t.split("\n"))
        assert after[i] == "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i, n])


def test_near_copies_stage(steps):
    before = pairs(steps[2])
    classes = {c for _, c, _, _ in near_brute(before)}
    assert sorted(i for i, _ in pairs(steps[3])) == sorted(classes)


def test_mixing_stage(steps):
    before, after = set(pairs(steps[3])), Counter(pairs(steps[4]))
    assert set(after) <= before and max(after.values()) <= 2


def test_tokens_stage(steps):
    assert Counter(r["doc_id"] for r in steps[5].collect()) == Counter(i for i, _ in pairs(steps[4]))


def test_odd_rows(spark, odd, none, sf_dir):
    for df in (odd, none):
        for _, stage in pipe.STAGES:
            df = written(stage(spark, df, sf_dir))
        assert "n_tokens" in df.columns


def test_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {x.split("_")[0] for x in names} and "pipeline" in names


def test_clashing_names_stay(spark, docs, sf_dir):
    """Extra columns with names that steps once used go through all stages but the last as they are."""
    names = ("_key", "_removed", "times", "part", "_Time")
    out = docs.withColumns({n: F.lit(n) for n in names})
    columns = out.columns
    for _, stage in pipe.STAGES[:-1]:
        out = stage(spark, out, sf_dir)
        assert out.columns == columns
    assert out.select(*names).distinct().collect() == [names]
