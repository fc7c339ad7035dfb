"""Mixing sources to target weights by hierarchical budgets.

A token budget goes down a tree of domain, language and source.  At each node it is dealt to the
children by weight; a child whose subtree cannot take its share (its tokens times the epochs allowed)
takes what it can, and the rest goes to its siblings by weight.  Only what all siblings together
cannot take is left to the ancestor's other children, because a subtree's capacity is known before
the ancestor deals.  A leaf's budget is filled from seeded epochs: whole permutations of its documents,
and a token-prefix of the last one.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accessgrid.llm.common import KEY, numbered, row_key, written

LEVELS = ["domain", "language", "source"]
#: Documents of a leaf whose order is settled in one group, on average.
RANGE_ROWS = 4096

#: Not names that a table has.
_ROWS, _DRAWS, _EPOCH, _PLACE, _FIRST = (f"{x} of this step" for x in ("rows", "draws", "epoch", "place", "first"))


def n_tokens(text: str) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+`; null texts have none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def domain_of(source: str, domains: int = 4) -> Column:
    """The tables name no domain: sources are dealt to a few by hash."""
    return F.concat(F.lit("d"), F.pmod(F.crc32(F.coalesce(F.col(source), F.lit("")).cast("binary")), F.lit(domains)).cast("string"))


def _weight(level: str, weights: dict[str, dict[str, float]]) -> Column:
    out = F.lit(1.0)
    for name, weight in weights.get(level, {}).items():
        out = F.when(F.col(level) == name, F.lit(float(weight))).otherwise(out)
    return out


def _deal(nodes: DataFrame, parent: list[str], level: str, weights: dict) -> DataFrame:
    """Adds `share` to each child: its part of the parent's `budget`.

    Children are taken in the order of capacity / weight.  As long as the budget left, dealt by the
    weights left, exceeds a child's capacity, the child is full; all that follow get their weight's part.
    """
    w = nodes.withColumn("w", _weight(level, weights))
    order = Window.partitionBy(*parent).orderBy(F.col("capacity") / F.col("w"), level)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    w = w.withColumn("cap_before", F.coalesce(F.sum("capacity").over(before), F.lit(0.0)))
    w = w.withColumn("w_left", F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    w = w.withColumn("full", (F.col("budget") - F.col("cap_before")) * F.col("w") >= F.col("capacity") * F.col("w_left"))
    # The first child that isn't full fixes the part of each unit of weight for the rest.
    rest = F.min(F.when(~F.col("full"), F.struct("cap_before", "w_left"))).over(Window.partitionBy(*parent))
    w = w.withColumn("rest", rest)
    part = (F.col("budget") - F.col("rest.cap_before")) * F.col("w") / F.col("rest.w_left")
    share = F.when(F.col("full") | F.col("rest").isNull(), F.col("capacity")).otherwise(F.greatest(F.lit(0.0), F.least("capacity", part)))
    return w.withColumn("share", share).drop("w", "cap_before", "w_left", "full", "rest")


def budgets(supply: DataFrame, total: Column, epochs: int, weights: dict[str, dict[str, float]]) -> DataFrame:
    """(domain, language, source, tokens, docs, leaf_budget) for supply (the same without budget)."""
    leaves = supply.withColumn("capacity", F.col("tokens").cast("double") * epochs)
    nodes = leaves.groupBy("domain").agg(F.sum("capacity").alias("capacity"))
    given = _deal(nodes.withColumn("budget", total).withColumn("all", F.lit(1)), ["all"], "domain", weights).drop("all")
    for depth in (1, 2):
        path = LEVELS[: depth + 1]
        nodes = leaves.groupBy(*path).agg(F.sum("capacity").alias("capacity"))
        nodes = nodes.join(given.select(*LEVELS[:depth], F.col("share").alias("budget")), LEVELS[:depth])
        given = _deal(nodes, LEVELS[:depth], path[-1], weights)
    shares = given.select(*LEVELS, F.floor(F.col("share") + 1e-6).cast("long").alias("leaf_budget"))
    return leaves.join(shares, LEVELS).drop("capacity")


def mix(
    df: DataFrame,
    weights: dict[str, dict[str, float]],
    budget_share: float = 0.6,
    epochs: int = 2,
    seed: int = 1,
    id_col: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    domain: Column | None = None,
) -> DataFrame:
    """(key, id, domain, language, source, n_tokens, epoch, start, leaf_budget): the documents drawn.

    The budget is budget_share of all tokens, weights are by level and name (1 if not given), no document
    is drawn more than `epochs` times.  A document is drawn in an epoch if it starts before the leaf's budget
    ends.  Null languages and sources are leaves named `none`.  Texts without words are not drawn.
    Repeated rows are drawn each.  An empty table gives no rows.
    """
    named = df.select(
        row_key(id_col, text).alias("key"),
        (domain_of(source) if domain is None else domain).alias("domain"),
        F.coalesce(F.col(lang).cast("string"), F.lit("none")).alias("language"),
        F.coalesce(F.col(source).cast("string"), F.lit("none")).alias("source"),
        n_tokens(text).alias("n_tokens"),
    )
    docs = written(named.filter("n_tokens > 0"))
    supply = written(docs.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")))
    total = supply.agg(F.sum("tokens")).first()[0] or 0
    leaf = written(budgets(supply, F.lit(float(total) * budget_share), epochs, weights))
    leaf = leaf.withColumn("whole", F.expr("cast(leaf_budget div tokens AS int)"))
    # Each epoch has an order of its own: a hash, cut in ranges so that no leaf is sorted as one.
    met = docs.join(leaf, LEVELS).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("whole"))))
    met = met.withColumn("order", F.shiftrightunsigned(F.xxhash64(F.lit(seed), "epoch", "key"), 11))
    ranges = F.ceil(F.col("docs") / RANGE_ROWS)
    spot = F.col("order").cast("double") / F.lit(float(2**53))
    met = written(met.withColumn("range", F.floor(spot * ranges).cast("int")))
    sums = met.groupBy(*LEVELS, "epoch", "range").agg(F.sum("n_tokens").alias("in_range"))
    past = Window.partitionBy(*LEVELS, "epoch").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("in_range").over(past), F.lit(0))).drop("in_range")
    inside = Window.partitionBy(*LEVELS, "epoch", "range").orderBy("order", "key").rowsBetween(Window.unboundedPreceding, -1)
    placed = met.join(sums, [*LEVELS, "epoch", "range"])
    at = F.col("before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    drawn = placed.withColumn("start", F.col("epoch") * F.col("tokens") + at).filter(F.col("start") < F.col("leaf_budget"))
    return drawn.select("key", F.col("key.id").alias(id_col), *LEVELS, "n_tokens", "epoch", "start", "leaf_budget")


def mixed(df: DataFrame, weights: dict[str, dict[str, float]], id_col: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of df as drawn, with all columns of df; a document drawn twice is there twice.

    Rows that agree in id and text are drawn each: where an epoch takes some of them only, as many of
    them stay.
    """
    drawn = mix(df, weights, id_col=id_col, text=text, **how).select(F.col("key").alias(KEY), "epoch")
    keyed = df.withColumn(KEY, row_key(id_col, text))
    repeated = keyed.groupBy(KEY).agg(F.count("*").alias(_ROWS)).filter(F.col(_ROWS) > 1)
    draws = drawn.groupBy(KEY, "epoch").agg(F.count("*").alias("n")).groupBy(KEY).agg(F.collect_list("n").alias(_DRAWS))
    draws = written(draws.join(repeated, KEY, "left"))
    partly = F.exists(_DRAWS, lambda n: n < F.coalesce(_ROWS, F.lit(1)))
    whole = keyed.join(draws.filter(~partly), KEY).withColumn(_EPOCH, F.explode(_DRAWS)).select(*df.columns)
    some = draws.filter(partly).drop(_ROWS)
    if some.isEmpty():
        return whole
    # Copies by number, which ranges give, so that no key is gathered.
    copies = numbered(keyed.join(some.select(KEY), KEY, "left_semi"), [F.col(KEY)], _PLACE)
    first = copies.groupBy(KEY).agg(F.min(_PLACE).alias(_FIRST))
    met = copies.join(first.join(some, KEY), KEY).withColumn(_EPOCH, F.explode(_DRAWS))
    return whole.union(met.filter(F.col(_PLACE) - F.col(_FIRST) < F.col(_EPOCH)).select(*df.columns))
