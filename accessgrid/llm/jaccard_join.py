"""Similarity join on word shingles by chosen paths.

Documents are sets of five-word shingles.  Each set has DRAWS sampled tokens (minima of random
orders: two sets agree in one with the probability of their Jaccard similarity).  A run splits all
sets by one sampled token, chosen by the run; buckets that stay large are split again by a token
chosen by the bucket, down to DEPTH.  Small buckets, and what is left at the last depth, are compared
whole, exactly, on the full shingle sets.  The runs repeat until a pair at the threshold is met in one
of them with the target recall.

Equal sets are folded to one before all else.  Buckets with the same members are compared once, pairs
in several buckets are counted in one of them.  A large bucket is cut in tiles that are compared two by
two, so no task holds more than two tiles.  A bucket's links leave its task as a spanning forest and
counts, never as pairs.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accessgrid.llm.common import KEY, ascii_tokens, freeing, row_key, written
from accessgrid.llm.components import components

WORDS = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.999
#: Sampled tokens of each set.
DRAWS = 32
#: Buckets up to this size are compared; larger ones are split once more, up to DEPTH times.
SMALL = 24
DEPTH = 3
#: Sets in a tile of a large bucket.
TILE = 256


def runs_needed(threshold: float, target: float, depth: int) -> int:
    """Runs until a pair at the threshold stays together to the last depth in one of them, with one
    token for each split; pairs in buckets that are compared earlier are found more often."""
    return max(1, math.ceil(math.log(1 - target) / math.log(1 - threshold**depth)))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bytes of a word that are hashed one by one over all words together; the rest of longer ones follows.
_TOGETHER = 64


def _word_hashes(words: pa.Array) -> np.ndarray:
    """64 bits for each word, from its bytes alone."""
    coded = words.dictionary_encode()
    data = np.frombuffer(coded.dictionary.buffers()[2] or b"", np.uint8)
    ends = np.frombuffer(coded.dictionary.buffers()[1], np.int32)[: len(coded.dictionary) + 1]
    lengths = np.diff(ends)
    out = _mix(lengths.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    for k in range(min(int(lengths.max(initial=0)), _TOGETHER)):
        here = np.flatnonzero(lengths > k)
        out[here] = _mix(out[here] * np.uint64(0x100000001B3) + data[ends[here] + k].astype(np.uint64))
    for w in np.flatnonzero(lengths > _TOGETHER):
        rest = bytes(data[ends[w] + _TOGETHER : ends[w + 1]])
        out[w] ^= np.uint64(xxhash.xxh3_64_intdigest(rest))
    return out[coded.indices.to_numpy(zero_copy_only=False)]


SETS = "fold binary, size int, draws array<int>, shingles binary"


def _sets_of(texts: pa.Array, words: int, draws: int) -> list[pa.Array]:
    tokens, rows = ascii_tokens(pc.fill_null(texts, ""))
    starts = np.searchsorted(rows, np.arange(len(texts) + 1))
    folds, sizes, mins, sets = [], [], [], []
    with np.errstate(over="ignore"):
        hashed = _word_hashes(tokens) if len(tokens) else np.empty(0, np.uint64)
        steps = _mix(np.arange(1, draws + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        for at in range(len(texts)):
            own = hashed[starts[at] : starts[at + 1]]
            width = min(words, len(own))
            code, low = np.empty(0, np.uint64), np.zeros(draws, np.int32)
            if width:
                code = np.zeros(len(own) - width + 1, np.uint64)
                for k in range(width):
                    code = code * np.uint64(0x9E3779B97F4A7C15) + own[k : k + len(code)]
                # A text of fewer words is one shingle, which holds its number of words.
                code = np.unique(_mix(code + np.uint64(width)))
                least = np.full(draws, np.iinfo(np.uint64).max)
                for cut in range(0, len(code), 4096):
                    least = np.minimum(least, (code[cut : cut + 4096, None] * steps).min(axis=0))
                low = (_mix(least) >> np.uint64(33)).astype(np.int32)
            fold = np.array([len(code), _fold(code, 1), _fold(code, 2)], np.uint64).tobytes()
            folds.append(fold), sizes.append(len(code)), mins.append(low), sets.append(code.tobytes())
    flat = np.concatenate(mins) if mins else np.empty(0, np.int32)
    offsets = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * draws)
    drawn = pa.ListArray.from_arrays(offsets, pa.array(flat))
    return [pa.array(folds, pa.binary()), pa.array(sizes, pa.int32()), drawn, pa.array(sets, pa.binary())]


def _fold(code: np.ndarray, seed: int) -> int:
    return int(_mix(code * np.uint64(2 * seed + 1) + np.uint64(seed)).sum(dtype=np.uint64)) if len(code) else 0


def shingle_sets(df: DataFrame, text: str, *keep: str, words: int = WORDS, draws: int = DRAWS, whole: bool = False) -> DataFrame:
    """keep and SETS: `fold` is equal for equal sets; `shingles`, the sorted 64-bit shingles, only if
    `whole`, else null."""
    schema = T.StructType(df.select(*keep).schema.fields + T.StructType.fromDDL(SETS).fields)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                cut = batch.slice(start, 1000)
                made = _sets_of(cut.column(len(keep)), words, draws)
                if not whole:
                    made[-1] = pa.nulls(cut.num_rows, pa.binary())
                yield pa.RecordBatch.from_arrays([*cut.columns[: len(keep)], *made], names=schema.names)

    return df.select(*keep, F.col(text).cast("string").alias("_text")).mapInArrow(freeing(run), schema)


def leaf_buckets(sets: DataFrame, runs: int, small: int = SMALL, depth: int = DEPTH) -> DataFrame:
    """(bucket, rep, n) for all buckets of two and more sets that are to be compared; sets: (rep, draws).

    A set's path depends on its own tokens and the run alone, so a level needs no more than the
    sizes of its buckets; the members of larger ones go on to the next level, where the bucket's
    number chooses the token that splits it.
    """
    run = F.explode(F.sequence(F.lit(1), F.lit(runs))).alias("run")
    now = sets.select("rep", "draws", run).select("rep", F.xxhash64("run", F.get("draws", F.col("run") - 1)).alias("bucket"))
    leaves = None
    for level in range(1, depth + 1):
        sizes = now.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
        met = written(now.join(sizes, "bucket"))
        found = met if level == depth else met.filter(F.col("n") <= small)
        leaves = found if leaves is None else leaves.unionByName(found)
        if level < depth:
            token = F.get("draws", F.pmod(F.xxhash64("bucket", F.lit(7)), F.size("draws")).cast("int"))
            now = met.filter(F.col("n") > small).join(sets, "rep").select("rep", F.xxhash64("bucket", token).alias("bucket"))
    return leaves


def _distinct_buckets(leaves: DataFrame) -> DataFrame:
    """Of buckets with the same members one stays."""
    marks = leaves.groupBy("bucket", "n").agg(
        F.sum(F.xxhash64("rep").cast("decimal(20,0)")).alias("s"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("x"), F.min("rep").alias("low")
    )
    one = marks.groupBy("n", "s", "x", "low").agg(F.min("bucket").alias("bucket")).select("bucket")
    return leaves.join(one, "bucket", "left_semi")


COMPARED = "rep long, root long, links long"
#: Shingles that more sets of a unit hold are counted by matrix products.
_DENSE = 8


def _common(shingles: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """Numbers of common shingles of the sets `rows` with all sets."""
    n = len(shingles)
    owner = np.repeat(np.arange(n), [len(x) for x in shingles])
    flat = np.concatenate(shingles)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    held = np.diff(np.concatenate([first, [len(flat)]]))
    out = np.zeros((n, n), np.int32)
    for size in range(2, min(_DENSE, n) + 1):
        members = owner[first[held == size][:, None] + np.arange(size)].astype(np.int64)
        for i in range(size):
            for j in range(size):
                if i != j:
                    out += np.bincount(members[:, i] * n + members[:, j], minlength=n * n).reshape(n, n).astype(np.int32)
    many = np.flatnonzero(held > _DENSE)
    out = out[rows]
    for cut in range(0, len(many), 4096):
        part = many[cut : cut + 4096]
        column = np.repeat(np.arange(len(part)), held[part])
        at = np.repeat(first[part] - np.cumsum(held[part]) + held[part], held[part]) + np.arange(held[part].sum())
        matrix = np.zeros((n, len(part)), np.float32)
        matrix[owner[at], column] = 1
        out += (matrix[rows] @ matrix.T).astype(np.int32)
    return out


def _compare_unit(t: pa.Table, threshold: float) -> pa.RecordBatch | None:
    """Links inside one tile, or between two: a spanning forest and counts by set."""
    t = t.take(pc.sort_indices(t.column("rep")))
    reps, sizes, weights, part = (t.column(c).to_numpy() for c in ("rep", "size", "weight", "part"))
    bucket, n = t.column("bucket")[0].as_py(), len(t)
    # A pair that meets in several buckets is compared in the smallest they share.
    here = np.ones((n, n), bool)
    np.fill_diagonal(here, False)
    if not t.column("one_tile")[0].as_py():
        here &= part[:, None] != part[None, :]
    lists = t.column("buckets").combine_chunks()
    others, other_rows = lists.flatten().to_numpy(), pc.list_parent_indices(lists).to_numpy()
    for smaller in np.unique(others[others < bucket]):
        inside = np.zeros(n, bool)
        inside[other_rows[others == smaller]] = True
        if inside.sum() > 1:
            here &= ~(inside[:, None] & inside[None, :])
    here &= 10**9 * np.minimum(sizes[:, None], sizes[None, :]).astype(np.int64) >= int(threshold * 10**9) * np.maximum(sizes[:, None], sizes[None, :])
    rows = np.flatnonzero(here.any(axis=1))
    if not len(rows):
        return None
    common = _common([np.frombuffer(x, np.uint64) for x in t.column("shingles").to_pylist()], rows)
    union = sizes[rows, None] + sizes[None, :] - common
    x, y = np.nonzero((common >= threshold * union - 1e-9) & here[rows])
    x = rows[x]
    if not len(x):
        return None
    links = np.zeros(n, np.int64)
    np.add.at(links, x, weights[y])
    parent = list(range(n))

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in zip(x.tolist(), y.tolist()):
        if i < j and (a := top(i)) != (b := top(j)):
            parent[max(a, b)] = min(a, b)
    some = np.unique(x)
    cols = [reps[some], reps[[top(i) for i in some]], links[some]]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["rep", "root", "links"])


def _compare(tiles: DataFrame, threshold: float) -> DataFrame:
    """Forest edges (rep, root) and link counts of each unit; tiles: sorted by unit."""

    def run(batches):
        held, last = [], None
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("unit")).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(ids)) + 1, [len(ids)]])
            for start, end in zip(cuts[:-1], cuts[1:]):
                if start == end:
                    continue
                if held and ids[start] != last:
                    if (made := _compare_unit(pa.Table.from_batches(held), threshold)) is not None:
                        yield made
                    held = []
                held.append(batch.slice(start, end - start))
                last = ids[start]
        if held and (made := _compare_unit(pa.Table.from_batches(held), threshold)) is not None:
            yield made

    return tiles.mapInArrow(freeing(run), COMPARED)


def _tiles(leaves: DataFrame, sets: DataFrame, tile: int) -> DataFrame:
    """A row for each set and pair of tiles it is in, with its shingles, dealt and sorted by unit."""
    own = leaves.groupBy("rep").agg(F.collect_list("bucket").alias("buckets"))  # at most one for each run
    dealt = leaves.withColumn("count", F.ceil(F.col("n") / tile).cast("int"))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("rep"), F.col("count")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("count") - 1)))
    # A tile is compared with itself in the unit (i, i), with another in (i, j).
    unit = F.xxhash64("bucket", F.least("part", "other"), F.greatest("part", "other"))
    units = dealt.select("bucket", "rep", "part", unit.alias("unit"), (F.col("part") == F.col("other")).alias("one_tile"))
    slim = units.join(sets.join(own, "rep"), "rep")
    slim = slim.select("unit", "bucket", "rep", "part", "one_tile", "size", "weight", "buckets", "shingles")
    return slim.repartition("unit").sortWithinPartitions("unit")


def classes(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = WORDS, threshold: float = THRESHOLD, recall: float = TARGET_RECALL
) -> DataFrame:
    """(key, class_key, n_links, n_copies), a row for each row of df; class_key is the smallest key of
    the class, key that of common.row_key.  For the rest see jaccard_join."""
    keyed = df.select(row_key(id_col, text).alias("key"), F.col(text).alias("_text"))
    rows = written(shingle_sets(keyed, "_text", "key", words=words).drop("shingles"))
    order = F.struct(F.col("key.id").isNull().alias("none"), F.col("key"))
    folds = rows.groupBy("fold").agg(F.min(order).alias("first"), F.count("*").alias("weight"), F.any_value("size").alias("size"), F.any_value("draws").alias("draws"))
    folds = written(folds.select("fold", "first", "weight", "size", "draws", F.xxhash64("fold").alias("rep")))
    found = leaf_buckets(folds.filter("size > 0").select("rep", "draws"), runs_needed(threshold, recall, DEPTH))
    leaves = written(_distinct_buckets(found))
    # Only sets in some bucket are made whole, each from one of its texts.
    needed = folds.join(leaves.select("rep").distinct(), "rep", "left_semi").select(F.col("first.key").alias("key"), "rep", "size", "weight")
    texts = keyed.join(needed, "key").dropDuplicates(["rep"])
    sets = shingle_sets(texts, "_text", "rep", "weight", words=words, draws=1, whole=True).select("rep", "weight", "size", "shingles")
    compared = written(_compare(_tiles(leaves, sets, TILE), threshold))
    roots = components(compared.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    links = compared.groupBy("rep").agg(F.sum("links").alias("links"))
    of_set = folds.select("fold", "first", "weight", "rep").join(links, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    of_set = of_set.withColumn("root", F.coalesce("root", "rep"))
    low = of_set.groupBy("root").agg(F.min("first").alias("low"))
    of_set = of_set.join(low, "root").select("fold", F.col("low.key").alias("class_key"), F.coalesce("links", F.lit(0)).alias("links"), "weight")
    joined = rows.select("key", "fold").join(of_set, "fold")
    return joined.select("key", "class_key", (F.col("links") + F.col("weight") - 1).alias("n_links"), (F.col("weight") - 1).alias("n_copies"))


def jaccard_join(df: DataFrame, id_col: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """(id, class_id, n_links, n_copies), a row for each row of df.

    class_id is the smallest id of all documents that are linked, through others too; n_links counts
    the other documents (copies too) with a similarity of at least the threshold.  Words are runs of
    characters other than ASCII white space, A-Z lower-cased.  Texts with equal shingle sets are
    copies; a text of fewer words is one shingle; null and empty texts are copies of one another.
    Rows without id have the class of their text; class_id is null if no row of the class has an id.
    Repeated rows are copies.  Further columns are not read.
    """
    found = classes(df, id_col, text, **how)
    return found.select(F.col("key.id").alias(id_col), F.col("class_key.id").alias("class_id"), "n_links", "n_copies")


def one_of_each(df: DataFrame, id_col: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of df that are the first of their class, each once, with all columns of df."""
    first = classes(df, id_col, text, **how).select(F.col("class_key").alias(KEY)).distinct()
    keyed = df.withColumn(KEY, row_key(id_col, text))
    return keyed.join(first, KEY, "left_semi").dropDuplicates([KEY]).select(*df.columns)
