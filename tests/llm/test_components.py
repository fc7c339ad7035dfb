import random
from collections import defaultdict

from accessgrid.llm.components import components


def brute(edges):
    near = defaultdict(set)
    for u, v in edges:
        if u is not None and v is not None and u != v:
            near[u].add(v), near[v].add(u)
    out, seen = [], set()
    for start in sorted(near):
        if start not in seen:
            stack, own = [start], {start}
            while stack:
                for x in near[stack.pop()] - own:
                    own.add(x), stack.append(x)
            seen |= own
            out += [(x, min(own)) for x in own]
    return sorted(out)


def test_components(spark):
    rng = random.Random(1)
    edges = [(n, n + 1) for n in range(60)] + [(100, n) for n in range(101, 160)] + [(300, 300), (None, 4)]
    edges += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)] + [(-5, 60), (60, -5)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = components(df)
    assert sorted(map(tuple, got.collect())) == brute(edges)
    assert components(df.limit(0)).count() == 0
