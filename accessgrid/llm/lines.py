"""Fuzzy line deduplication by MinHash, in DataFrame operations alone.

A line is the set of its character shingles: SHINGLE characters from each word's start on, and from
every character of runs that are longer, so that all characters are covered, of text without spaces
too.  For each of POINTS random points the shingle nearest to it (smallest XOR distance of hashes) is
kept: two sets agree there with the probability of their Jaccard similarity.  Points form bands;
lines that agree in a whole band are candidates, their similarity is computed exactly on whole
shingle sets, and of each component of similar lines the first in order of documents stays.

Equal lines are one from the start.  The lines of a band's bucket are compared with its centre, the
most frequent of them; those that are similar to it are linked, so pairs among them need no look.
Lines that differ from their centre meet the others of that centre: what two sets have in common with
it, and what they share besides, bounds their similarity, and few pairs reach the threshold.
Components come out as if all pairs had been looked at, and a group of near copies makes no pairs.
"""
from __future__ import annotations

import random
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accessgrid.llm.common import KEY, row_key, written
from accessgrid.llm.components import components

SHINGLE = 12
THRESHOLD = 0.8
#: 8 bands of 3 points: a pair at 0.8 is met with a probability of 0.997.
BANDS, ROWS = 8, 3
POINTS = BANDS * ROWS
#: Numbers of 64 bits in the filters that thin rows out before a join; rows that pass by chance go in
#: the join, so this is a matter of speed alone.
FILTER_WORDS = 1 << 18
#: Not a name that a table has.
_REMOVED = "removed lines of this step"


def _points() -> list[int]:
    draw = random.Random(7)
    return [draw.getrandbits(63) - (1 << 62) for _ in range(POINTS)]


def normal(line: Column) -> Column:
    """Lines that differ in white space around them alone are equal."""
    blanks = " \t\r\x0b\x0c"
    # Looking for the end of a line costs a pass over it; few lines need it.
    ragged = reduce(Column.__or__, [F.endswith(line, F.lit(blank)) for blank in blanks])
    return F.when(ragged, F.btrim(line, F.lit(blanks))).otherwise(F.ltrim(line, F.lit(blanks)))


def shingles(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit(rf"(?s)(?=(.{{1,{SHINGLE}}}+))(?:\S{{1,{SHINGLE}}}+(?!\S)|\S)\s*+"), F.lit(1))


def _lines(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """(key, line_no, line, h) of all lines with something else than white space, h its hash."""
    each = df.select(row_key(id_col, text).alias("key"), F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "raw"))
    return each.select("key", "line_no", normal(F.col("raw")).alias("line")).filter("line <> ''").withColumn("h", F.xxhash64("line"))


def thinned(df: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose column may be among the keys: all that are, and few others.

    The keys are folded to a bit field of fixed size, the only thing that is broadcast.
    """
    word = lambda c: F.pmod(F.col(c), F.lit(FILTER_WORDS))
    bit = lambda c: F.expr(f"shiftleft(1L, cast(pmod(shiftright({c}, 40), 64) AS int))")
    field = keys.groupBy(word(key).alias("_word")).agg(F.bit_or(bit(key)).alias("_bits"))
    met = df.withColumn("_at", word(column)).join(F.broadcast(field), F.col("_at") == F.col("_word"))
    return met.filter(F.col("_bits").bitwiseAND(bit(column)) != 0).select(*df.columns)


def signatures(lines: DataFrame) -> DataFrame:
    """(h, bands): a hash for each band; one row for each distinct line."""
    each = lines.select("h", F.explode(shingles(F.col("line"))).alias("s")).select("h", F.xxhash64("s").alias("s"))
    nearest = [F.min(F.col("s").bitwiseXOR(F.lit(p))).alias(f"p{n}") for n, p in enumerate(_points())]
    found = each.groupBy("h").agg(*nearest)
    bands = [F.xxhash64(F.lit(b), *[F.col(f"p{b * ROWS + r}") for r in range(ROWS)]) for b in range(BANDS)]
    return found.select("h", F.array(*bands).alias("bands"))


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    met = pairs.join(sets.select(F.col("h").alias("u"), F.col("shingles").alias("su")), "u")
    return met.join(sets.select(F.col("h").alias("v"), F.col("shingles").alias("sv")), "v")


def _alike(threshold: float) -> Column:
    both = F.size(F.array_intersect("su", "sv"))
    return both >= threshold * (F.size("su") + F.size("sv") - both) - 1e-9


def linked(lines: DataFrame, counts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(node, root) for lines that are similar to another: hashes of lines and of their component.

    counts: (h, n) of lines that occur more than once.
    """
    bands = written(signatures(lines)).select("h", F.explode("bands").alias("bucket"))
    several = written(bands.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket"))
    members = written(thinned(bands, "bucket", several, "bucket").join(several, "bucket").distinct())
    weighed = members.join(counts, "h", "left").withColumn("rank", F.struct(-F.coalesce("n", F.lit(1)), "h"))
    centre = weighed.groupBy("bucket").agg(F.min("rank")["h"].alias("u"))
    pairs = members.join(centre, "bucket").select("u", F.col("h").alias("v")).filter("u <> v").distinct()
    needed = written(members.select("h").distinct())
    sets = thinned(lines.select("h", "line"), "h", needed, "h").join(needed, "h").dropDuplicates(["h"])
    sets = sets.select("h", F.array_distinct(F.transform(shingles(F.col("line")), lambda s: F.xxhash64(s))).alias("shingles"))
    sets = written(sets)
    own, common = F.array_except("sv", "su"), F.size(F.array_intersect("sv", "su"))
    stars = _with_sets(pairs, sets).select(F.col("u").alias("centre"), "v", own.alias("own"), common.alias("common"), _alike(threshold).alias("alike"))
    stars = written(stars)
    # Of two lines of one centre, what both have from elsewhere, and the smaller part of it, bounds what
    # they share; few pairs stay that way, each once.
    side = lambda name: (F.col("v").alias(name), F.col("own").alias(f"own_{name}"), F.col("common").alias(f"common_{name}"))
    met = stars.filter("NOT alike").select("centre", *side("a")).join(stars.select("centre", *side("b")), "centre")
    total = F.size("own_a") + F.size("own_b") + F.col("common_a") + F.col("common_b")
    reach = lambda shared: (shared + F.least("common_a", "common_b")) * (1 + threshold) >= threshold * total - 1e-9
    near = reach(F.least(F.size("own_a"), F.size("own_b"))) & reach(F.size(F.array_intersect("own_a", "own_b")))
    rest = met.filter((F.col("a") != F.col("b")) & near).select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()
    found = stars.filter("alike").select(F.col("centre").alias("u"), "v")
    return components(found.union(_with_sets(rest, sets).filter(_alike(threshold)).select("u", "v")))


def duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(key, line_no) of all lines that aren't blank, and (key, removed): for row keys that lose lines
    their numbers, from 0."""
    lines = _lines(df, id_col, text)
    places = written(lines.select("key", "line_no", "h").distinct())  # repeated rows are one document
    order = F.struct(F.col("key.id").isNull().alias("none"), "key", "line_no")
    first = written(places.groupBy("h").agg(F.min(order).alias("first"), F.count("*").alias("n")))
    roots = linked(lines.select("h", "line"), first.filter("n > 1").select("h", "n"), threshold)
    first = first.join(roots.withColumnRenamed("node", "h"), "h", "left").filter("n > 1 OR root IS NOT NULL")
    first = written(first.select("h", F.coalesce("root", "h").alias("root"), "first"))
    kept = first.groupBy("root").agg(F.min("first").alias("kept"))
    repeated = first.join(kept, "root").select("h", "kept")
    gone = places.join(repeated, "h").filter(F.col("kept") != order).groupBy("key")
    return places.select("key", "line_no"), gone.agg(F.array_sort(F.collect_list("line_no")).alias("removed"))  # at most the lines of one text


def line_dedup(df: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_lines, n_removed, removed), a row for each row of df.

    Of lines that are equal or similar, through others too, the first in order of id and line stays;
    rows without id come last.  Blank lines are neither counted nor removed; null and empty texts
    have none.  Rows that agree in id and text are one document and lose the same lines.  Further
    columns are not read.
    """
    places, gone = duplicates(df, id_col, text, threshold)
    rows = df.select(row_key(id_col, text).alias("key"))
    met = rows.join(places.groupBy("key").agg(F.count("*").alias("n_lines")), "key", "left").join(gone, "key", "left")
    return met.select(
        F.col("key.id").alias(id_col),
        F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
    )


def without_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """df with the removed lines taken out of its texts; all rows and columns stay.  A text whose
    lines all stand elsewhere is empty; null stays null."""
    _, gone = duplicates(df, id_col, text, threshold)
    found = gone.select(F.col("key").alias(KEY), F.col("removed").alias(_REMOVED))
    met = df.withColumn(KEY, row_key(id_col, text)).join(found, KEY, "left")
    kept = F.filter(F.split(F.col(text), "\n"), lambda line, n: ~F.array_contains(_REMOVED, n))
    new = F.when(F.col(_REMOVED).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    return met.withColumn(text, new).select(*df.columns)
