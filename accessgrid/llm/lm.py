"""Probabilistic suffix tree over words.

Symbols are words and an end mark.  A context of one or two words is kept if what follows it diverges
from what follows its suffix (a likelihood-ratio test); its next-symbol distribution is smoothed by
absolute discounting, and the mass taken off goes to the suffix's distribution, down to the counts of
single words with one added to each.  A text is scored from the longest kept suffix at each place.

Counts are made from all training texts, and every sequence that stands there twice is part of the tree,
however large the corpus.  A text's score is a sum of one value for each of its words, pairs and triples
(see `_level`), so nothing but values by sequence has to be looked up.  Sequences that make up at least
HEAD_SHARE of all places are broadcast, at most 1 / HEAD_SHARE of them for each length, and at most
MAX_WORDS words; all others stay
in the cluster and meet the texts there.  Sequences of broadcast words are known by a code of the words'
numbers, others by a hash of 63 bits and the sign.  What is counted or looked up for each place travels
as sorted blocks of keys, of which only the steps from key to key are packed, dealt out by key to as many
parts as the places are worth.  Texts are split into words once, and written as numbers of each cut's words.
"""
from __future__ import annotations

import math
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accessgrid.llm.common import ascii_tokens, drop_table, freeing
from accessgrid.llm.common import written as written_as

#: Least share of all places that a sequence must make up to be part of the tree; two places it must have.
MIN_SHARE = 0.0
#: Least share of all places from which a sequence is broadcast, not joined.
HEAD_SHARE = 4e-6
#: Words that are broadcast with a number, at most: all that stand as often as some number of times.
MAX_WORDS = 500_000
#: A sequence's hash is that of all but its last word times this (odd) number, plus the last word's.
STEP = np.uint64(0x9E3779B97F4A7C15)
STEP_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Set in keys that are hashes.
HASHED = np.uint64(1 << 63)
#: Places whose keys make one part, and texts that are read at once.
PART_PLACES = 1_000_000
CUT = 2000
#: Taken off each count after a context.
DISCOUNT = 0.75
#: A context is kept if 2 * (log likelihood ratio against its suffix) exceeds this for each free symbol.
MIN_RATIO = 3.84
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Not a word: words hold no line feed.
END = "\n"


def written(df: DataFrame) -> DataFrame:
    """As in common; these tables are many, and compress well."""
    return written_as(df, compression="zstd")


def held_out(id_col: str) -> Column:
    """True where crc32(id as text) mod 7 is 2; rows without id are for training."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))


CODED = "cut bigint, training array<boolean>, lengths array<int>, words array<string>, symbols binary"


def coded(df: DataFrame, id_col: str, text: str, training: str) -> DataFrame:
    """A row for each CUT texts: their ids, the number of the first, whether they are for training, their symbols'
    number, the words of all (the end mark first), and the place in those of each symbol.

    Numbers of rows ascend by one or more, and so no cut's first number plus places in the cut are another's.
    They are fixed by writing the frame.
    """
    kind = df.select(F.col(id_col).alias("ids")).schema.fields[0].dataType
    schema = T.StructType([T.StructField("ids", T.ArrayType(kind))] + T.StructType.fromDDL(CODED).fields)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, CUT):
                part = batch.slice(start, CUT)
                n = part.num_rows
                words, rows = ascii_tokens(pc.fill_null(part.column(3), ""))
                found = words.dictionary_encode()
                lengths = np.bincount(rows, minlength=n) + 1
                symbols = np.zeros(len(rows) + n, np.uint64)
                symbols[np.arange(len(rows)) + rows] = found.indices.to_numpy(zero_copy_only=False) + 1
                columns = [part.column(0), part.column(2), pa.array(lengths, pa.int32()), pa.concat_arrays([pa.array([END]), found.dictionary])]
                ids, *lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns]
                yield pa.RecordBatch.from_arrays([ids, part.column(1).slice(0, 1), *lists, pa.array([_packed(symbols)], pa.binary())], names=schema.names)

    chosen = df.select(F.col(id_col), F.monotonically_increasing_id().alias("cut"), F.col(training), F.col(text).cast("string"))
    return chosen.mapInArrow(freeing(run), schema)


def _cuts(batches, only_training: bool = False):
    """(ids, number of the first, training, words, symbols as places among the words, text of each symbol) of coded rows."""
    for batch in batches:
        for i in range(batch.num_rows):
            ids, training, lengths, words = (batch.column(n)[i].values for n in (0, 2, 3, 4))
            symbols = _unpacked([batch.column(5)[i].as_py()], np.uint64).astype(np.int64)
            docs = np.repeat(np.arange(len(lengths)), lengths.to_numpy())
            training = training.to_numpy(zero_copy_only=False).astype(bool)
            if only_training and not training.all():
                chosen = training[docs]
                symbols, docs = symbols[chosen], docs[chosen]
            yield ids, batch.column(1)[i].as_py(), training, words, symbols, docs


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over all coded training texts, the end mark among the words; counted in tasks before the shuffle."""

    def run(batches):
        for _, _, _, words, symbols, _ in _cuts(batches, True):
            c = np.bincount(symbols, minlength=len(words))
            yield pa.RecordBatch.from_arrays([words.filter(pa.array(c > 0)), pa.array(c[c > 0], pa.int64())], names=["word", "c"])

    return texts.mapInArrow(freeing(run), "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _hashes(words: pa.Array) -> np.ndarray:
    """A hash of 64 bits for each word."""
    return hash_array(np.asarray(words.to_pylist(), object), categorize=False) if len(words) else np.zeros(0, np.uint64)


def _signed(keys: np.ndarray) -> pa.Array:
    return pa.array(keys.view(np.int64), pa.int64())


def _places(docs: np.ndarray, length: int) -> np.ndarray:
    """Places with `length` symbols before them in the same text."""
    return np.flatnonzero(docs[length:] == docs[: len(docs) - length]) + length


class Tree:
    """What is broadcast: frequent words, and for each length of context the frequent sequences."""

    def __init__(self, words: list[str], counts: np.ndarray, total: int, distinct: int, frequent: int):
        self.words, self.counts, self.total, self.distinct = pa.array(words, pa.string()), counts, total, distinct
        self.root = np.log10((counts + 1) / (total + distinct + 1))
        self.size = len(words) + 1  # 0 stands for any other word
        self.frequent = np.append(False, counts >= frequent)  # by number
        hashes = _hashes(self.words)
        self.by_hash = np.argsort(hashes)
        self.hashes = hashes[self.by_hash]
        # By length of context: codes of frequent context + symbol with what that adds to the log10
        # probability, and codes of kept contexts with the log10 factor of all symbols.
        self.next: list[tuple[np.ndarray, np.ndarray]] = []
        self.other: list[tuple[np.ndarray, np.ndarray]] = []
        self.rest: list[DataFrame] = []  # (key, v) of all rarer words and pairs, and of triples

    def __getstate__(self) -> dict:
        """Without the tables, which stay in the cluster."""
        return self.__dict__ | {"rest": []}

    def ids(self, words: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words from 1, 0 if they have none."""
        at = self.by_hash[np.minimum(np.searchsorted(self.hashes, hashes), self.size - 2)]
        same = pc.fill_null(pc.equal(self.words.take(pa.array(at)), words), False)
        return np.where(same.to_numpy(zero_copy_only=False), at + 1, 0).astype(np.int64)

    def bits(self, length: int) -> int:
        """Bits of the codes of `length` + 1 symbols."""
        return max(32, (self.size ** (length + 1) - 1).bit_length())

    def codes(self, ids: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
        """The code of the symbols at places and the `length` before each, 0 unless all are frequent."""
        code, fits = np.zeros(len(at), np.int64), np.ones(len(at), bool)
        for back in range(length, -1, -1):
            fits &= ids[at - back] > 0
            code = code * self.size + ids[at - back]
        return np.where(fits, code, 0)


def _value(values: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Whether the table holds each value, and what it says, else 0."""
    codes, said = table
    if not len(codes):
        return np.zeros(len(values), bool), np.zeros(len(values))
    at = np.minimum(np.searchsorted(codes, values), len(codes) - 1)
    held = codes[at] == values
    return held, np.where(held, said[at], 0.0)


def _log_p(tree: Tree, symbols: np.ndarray, length: int) -> np.ndarray:
    """log10 probability of sequences' last symbol after the rest, as far as the broadcast part goes."""
    logs = tree.root[symbols % tree.size - 1].copy()
    for n in range(1, length + 1):
        codes = symbols % tree.size ** (n + 1)
        logs += _value(codes // tree.size, tree.other[n - 1])[1] + _value(codes, tree.next[n - 1])[1]
    return logs


def _keys(tree: Tree, hashes: np.ndarray, ids: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """The key of the symbols at places and the `length` before each: a code, else a hash."""
    keys = tree.codes(ids, at, length).view(np.uint64)
    rare = np.flatnonzero(keys == 0)
    where = at[rare]
    key = hashes[where - length]
    for back in range(length - 1, -1, -1):
        key = key * STEP + hashes[where - back]
    keys[rare] = key | HASHED
    return keys


def _packed(values: np.ndarray) -> bytes:
    """8-byte values, byte by byte, without the upper bytes that none needs.

    First the number of values and of bytes each, then for each byte of all values its length and it, compressed if that is shorter.
    """
    whole = values.view(np.uint64)
    width = int(whole.max()).bit_length() + 7 >> 3 if len(whole) else 0
    out = [np.array([len(whole), width]).tobytes()]
    for plane in whole.view(np.uint8).reshape(-1, 8)[:, :width].T:
        plain = plane.tobytes()
        out += [b"", min(plain, pa.compress(plain, codec="zstd", asbytes=True), key=len)]
        out[-2] = np.int64(len(out[-1])).tobytes()
    return b"".join(out)


def _unpacked(packs: list[bytes], kind: type) -> np.ndarray:
    cut = []
    for p in packs:
        n, width = np.frombuffer(p, np.int64, 2)
        whole, at = np.zeros((n, 8), np.uint8), 16
        for byte in range(width):
            size = int(np.frombuffer(p, np.int64, 1, at)[0])
            plane = p[at + 8 : at + 8 + size]
            whole[:, byte] = np.frombuffer(plane if size == n else pa.decompress(plane, int(n), codec="zstd", asbytes=True), np.uint8)
            at += 8 + size
        cut.append(whole.view(kind)[:, 0])
    return np.concatenate(cut) if cut else np.zeros(0, kind)


def _steps(keys: np.ndarray) -> bytes:
    """Sorted keys: the first, and the steps from each to the next."""
    return keys[:1].tobytes() + _packed(np.append(np.uint64(1), np.diff(keys)))


def _walked(packs: list[bytes]) -> np.ndarray:
    cut = []
    for p in packs:
        keys = _unpacked([p[8:]], np.uint64)
        keys[0] = np.frombuffer(p, np.uint64, 1)[0]
        cut.append(np.cumsum(keys, dtype=np.uint64))
    return np.concatenate(cut) if cut else np.zeros(0, np.uint64)


def _mixed(keys: np.ndarray, bits: int) -> np.ndarray:
    """Keys with codes spread over their bits; hashes are as they are."""
    return np.where(keys >= HASHED, keys, keys * STEP & np.uint64((1 << bits) - 1))


def _unmixed(keys: np.ndarray, bits: int) -> np.ndarray:
    return np.where(keys >= HASHED, keys, keys * STEP_BACK & np.uint64((1 << bits) - 1))


def _blocks(mixed: np.ndarray, parts: int, bits: int) -> list[tuple[int, slice]]:
    """The parts of sorted mixed keys, by their upper bits: first those of codes, then those of hashes."""
    split, out = int(np.searchsorted(mixed, HASHED)), []
    for start, some, width in ((0, mixed[:split], bits), (split, mixed[split:] & ~HASHED, 63)):
        ends = start + np.searchsorted((some >> np.uint64(width - 32)) * np.uint64(parts) >> np.uint64(32), np.arange(parts + 1, dtype=np.uint64))
        out += [(n, slice(i, j)) for n, (i, j) in enumerate(zip(ends, ends[1:])) if j > i]
    return out


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int32()] + [pa.binary()] * (len(names) - 1)
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def _firsts(values: np.ndarray) -> np.ndarray:
    """Where each value of a sorted array stands first."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)


BLOCKS = "part int, keys binary, counts binary, contexts binary, suffixes binary"


def _parts(tree: Tree) -> int:
    return max(1, math.ceil(tree.total / PART_PLACES))


def sequence_blocks(texts: DataFrame, tree: Tree, length: int) -> DataFrame:
    """For each cut of the training texts and each part its sequences of length + 1 symbols, once with their number.

    Codes tell their context and suffix, so that only hashes come with both.
    """
    shared, parts, bits = texts.sparkSession.sparkContext.broadcast(tree), _parts(tree), tree.bits(length)

    def run(batches):
        tree = shared.value
        for _, _, _, words, symbols, docs in _cuts(batches, True):
            hashes = _hashes(words)
            ids, hashes = tree.ids(words, hashes)[symbols], hashes[symbols]
            at = _places(docs, length)
            keys = _keys(tree, hashes, ids, at, length)
            hashed = keys >= HASHED
            codes, at, keys = np.sort(_mixed(keys[~hashed], bits)), at[hashed], keys[hashed]
            order = np.argsort(keys)
            found = np.concatenate([codes, keys[order]])
            first = _firsts(found)
            n, found = np.diff(np.append(first, len(found))), found[first]
            at = at[order][first[first >= len(codes)] - len(codes)]
            rows, split = [], len(found) - len(at)
            for part, cut in _blocks(found, parts, bits):
                both = (None, None)
                if cut.start >= split:
                    places = at[cut.start - split : cut.stop - split]
                    both = tuple(_packed(_keys(tree, hashes, ids, p, length - 1)) for p in (places - 1, places))
                rows.append((part, _steps(found[cut]), _packed(n[cut]), *both))
            yield _rows(rows, ["part", "keys", "counts", "contexts", "suffixes"])

    return texts.mapInArrow(freeing(run), BLOCKS)


def sequence_counts(texts: DataFrame, tree: Tree, length: int, least: int) -> DataFrame:
    """(key, context, suffix, c) of sequences of length + 1 symbols that occur `least` times.

    Context and suffix are the keys of all but the last and all but the first symbol.
    """
    size, bits = np.uint64(tree.size), tree.bits(length)

    def summed(rows):
        keys, counts = _walked([r[0] for r in rows]), _unpacked([r[1] for r in rows], np.int64)
        order = np.argsort(keys)
        keys = keys[order]
        first = _firsts(keys)
        c = np.add.reduceat(counts[order], first) if len(first) else counts
        kept = first[c >= least]
        return keys[kept], c[c >= least], order[kept]

    def count(batches):
        coded, hashed = [], []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns[1:])):
                (coded if row[2] is None else hashed).append(row)
        mixed, c, _ = summed(coded)
        keys = _unmixed(mixed, bits)
        yield _counted(keys, keys // size, keys % size ** np.uint64(length), c)
        keys, c, at = summed(hashed)
        yield _counted(keys, *(_unpacked([r[n] for r in hashed], np.uint64)[at] for n in (2, 3)), c)

    def _counted(keys, context, suffix, c):
        return pa.RecordBatch.from_arrays([*map(_signed, (keys, context, suffix)), pa.array(c, pa.int64())], names=["key", "context", "suffix", "c"])

    blocks = sequence_blocks(texts, tree, length)
    return blocks.repartition(_parts(tree), "part").mapInArrow(freeing(count), "key long, context long, suffix long, c long")


def _keyed(counts: DataFrame, tree: Tree) -> DataFrame:
    """(key, c, log) of words: count, log10 probability of the word alone."""
    shared = counts.sparkSession.sparkContext.broadcast(tree)

    def run(batches):
        tree = shared.value
        for batch in batches:
            words, c = batch.columns
            hashes = _hashes(words)
            ids = tree.ids(words, hashes)
            keys = np.where(ids > 0, ids.astype(np.uint64), hashes | HASHED)
            logs = np.log10((c.to_numpy(zero_copy_only=False) + 1) / (tree.total + tree.distinct + 1))
            yield pa.RecordBatch.from_arrays([_signed(keys), c, pa.array(logs)], names=["key", "c", "log"])

    return counts.mapInArrow(freeing(run), "key long, c long, log double")


def _level(found: DataFrame, before: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Contexts of one length: tests, discounts, weights; before: (key, c, log) of sequences a word shorter.

    Gives (key, c, log, adds) of the sequences, and (key, c, factor) of kept contexts.
    The log10 probability of a symbol after a kept context is that after its suffix, plus the context's
    factor, plus, if the sequence is in the tree, what that adds.
    """
    n = before.select(F.col("key").alias("context"), F.col("c").alias("n"))
    lower = before.select(F.col("key").alias("suffix"), F.col("log").alias("lower"))
    found = written(found)  # what was shuffled to count goes before the joins
    rows = found.join(lower, "suffix").drop("suffix").join(n, "context")
    of = Window.partitionBy("context")
    p, below = F.col("c") / F.col("n"), F.pow(F.lit(10.0), "lower")
    sums = rows.select(
        "*",
        F.sum("c").over(of).alias("seen"),
        F.sum(below).over(of).alias("below"),
        F.sum(F.col("c") * F.log(p / below)).over(of).alias("gain"),
        F.count("*").over(of).alias("k"),
        F.sum((F.col("c") - DISCOUNT) / F.col("n")).over(of).alias("taken"),
        (F.min("key").over(of) == F.col("key")).alias("one"),
    )
    rest = F.col("n") - F.col("seen")
    rest_gain = F.when(rest > 0, rest * F.log(rest / F.col("n") / F.greatest(1 - F.col("below"), F.lit(1e-12)))).otherwise(0.0)
    kept = (2 * (F.col("gain") + rest_gain) > MIN_RATIO * F.col("k")) & (F.col("below") < 1)
    factor = F.when(kept, F.log10((1 - F.col("taken")) / (1 - F.col("below"))))
    own = F.log10((F.col("c") - DISCOUNT) / F.col("n"))
    levels = sums.withColumn("factor", factor).select(
        "key",
        "c",
        F.when(F.col("factor").isNull(), F.col("lower")).otherwise(own).alias("log"),
        F.when(F.col("factor").isNull(), 0.0).otherwise(own - F.col("lower") - F.col("factor")).alias("adds"),
        *(F.when(F.col("one") & F.col("factor").isNotNull(), F.col(x)).alias(x) for x in ("context", "n", "factor")),  # once for each kept context
    )
    levels = written(levels)
    drop_table(found)
    factors = levels.filter("factor IS NOT NULL").select(F.col("context").alias("key"), F.col("n").alias("c"), "factor")
    return levels.select("key", "c", "log", "adds"), factors


def _sorted(table: pd.DataFrame, value: str) -> tuple[np.ndarray, np.ndarray]:
    table = table.sort_values("key")
    return table["key"].to_numpy(np.int64), table[value].to_numpy(float)


def _least_numbered(counts: DataFrame, least: int, total: int) -> int:
    """How often a word must stand, at least, for all such words to be MAX_WORDS or fewer."""
    most, words = 1000, 0
    by = counts.filter(F.col("c") >= least).groupBy(F.least("c", F.lit(max(most, least))).alias("c")).count()
    for c, n in sorted(by.collect(), reverse=True):
        if words + n > MAX_WORDS:
            return c + 1 if c < most else max(least, total // MAX_WORDS + 1)
        words += n
    return least


def train(texts: DataFrame, min_share: float = MIN_SHARE) -> tuple[Tree, DataFrame]:
    """The frequent part of the tree, with the table of the rest, and the table (word, c) of all words' counts.

    texts: one column, or coded.  Three passes: words, pairs, triples; all that stand at least twice (and make up
    min_share) are in the tree.  What comes to the driver are the sequences above HEAD_SHARE.
    tree.rest has (key, v), at most two rows for a key: what every rarer word, pair or triple adds to the log10 probability
    of a text that holds it.
    """
    if "symbols" not in texts.columns:
        plain = texts.select(F.lit(0).alias("id"), F.col(texts.columns[0]).alias("text"), F.lit(True).alias("training"))
        texts = written(coded(plain, "id", "text", "training"))
    counts = written(word_counts(texts))
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    least = max(2, math.ceil(min_share * total))
    numbered = _least_numbered(counts, least, total)
    frequent = max(numbered, math.ceil(HEAD_SHARE * total))
    head = counts.filter((F.col("c") >= numbered) | (F.col("word") == END)).toPandas().sort_values(["c", "word"], ascending=[False, True])
    words = head["word"].tolist()
    if END not in words:
        words, head = [*words, END], pd.concat([head, pd.DataFrame({"word": [END], "c": [0]})])
    tree = Tree(words, head["c"].to_numpy(np.int64), int(total), int(distinct), frequent)
    before = _keyed(counts.filter(F.col("c") >= least), tree)
    values, tables = [], []
    for length in (1, 2):
        found, factors = _level(sequence_counts(texts, tree, length, least), before)
        # Frequent sequences have frequent words, so their keys are codes.
        tree.next.append(_sorted(found.filter(F.col("c") >= frequent).select("key", "adds").toPandas(), "adds"))
        tree.other.append(_sorted(factors.filter(F.col("c") >= frequent).toPandas(), "factor"))
        values += [factors.select("key", "c", F.col("factor").alias("v")), found.filter("adds != 0").select("key", "c", F.col("adds").alias("v"))]
        tables.append(found)
        before = found.select("key", "c", "log")
    rarer = [v.filter(F.col("c") < frequent).drop("c") for v in values]
    tree.rest = [written(reduce(DataFrame.unionAll, some)) for some in (rarer[:3], rarer[3:])]
    for table in tables:
        drop_table(table)
    return tree, counts


PARTS = "n_tokens long, known_head long, base_head double, score_head double, tail array<struct<word:string,n:int>>"


def scored_parts(texts: DataFrame, tree: Tree) -> DataFrame:
    """For each coded text what the broadcast tree can say, and the rarer words with their numbers."""
    shared = texts.sparkSession.sparkContext.broadcast(tree)
    kind = texts.schema["ids"].dataType.elementType
    schema = T.StructType([T.StructField("id", kind)] + T.StructType.fromDDL("_training boolean, _row long, " + PARTS).fields)

    def run(batches):
        tree = shared.value
        for ids, cut, training, words, symbols, docs in _cuts(batches):
            rows = pa.array(cut + np.arange(len(ids)))
            yield pa.RecordBatch.from_arrays([ids, pa.array(training), rows, *_score(tree, len(ids), words, symbols, docs)], names=schema.names)

    return texts.mapInArrow(freeing(run), schema)


def _score(tree: Tree, n: int, words: pa.Array, symbols: np.ndarray, docs: np.ndarray) -> list[pa.Array]:
    own = tree.ids(words, _hashes(words))  # by word
    ids = own[symbols]
    # A rare word has weight 0 here; its share of the root follows from the join.
    root = np.where(own > 0, np.append(tree.root, 0.0)[own - 1], 0.0)
    base, logs = root[symbols], (root + _value(own, tree.other[0])[1])[symbols]
    frequent = tree.frequent[own][symbols]
    for length in (1, 2):
        at = _places(docs, length)
        at = at[frequent[at] & frequent[at - 1] & frequent[at - length]]
        codes = tree.codes(ids, at, length)
        logs[at] += _value(codes, tree.next[length - 1])[1]
        if length == 1:
            logs[at] += _value(codes, tree.other[1])[1]
    known = np.bincount(docs[((own > 0) & (np.append(tree.counts, 0)[own - 1] > 0))[symbols]], minlength=n)
    rare = (own == 0)[symbols]
    pair, times = np.unique(docs[rare] * len(words) + symbols[rare], return_counts=True)
    tail = pa.StructArray.from_arrays([words.take(pa.array(pair % len(words))), pa.array(times, pa.int32())], names=["word", "n"])
    offsets = np.searchsorted(pair // len(words), np.arange(n + 1))
    sums = [np.bincount(docs, weights=x, minlength=n) for x in (base, logs)]
    return [
        pa.array(np.bincount(docs, minlength=n), pa.int64()),
        pa.array(known, pa.int64()),
        *[pa.array(x, pa.float64()) for x in sums],
        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), tail),
    ]


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Inside, what a query has shuffled goes as it ends, not when the driver next frees its memory."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLES_GO) if before is None else spark.conf.set(SHUFFLES_GO, before)


def rest_scores(texts: DataFrame, tree: Tree, told: DataFrame, lengths: list[int]) -> DataFrame:
    """(_row, rest_score): what the words (0), pairs (1) and triples (2) that are not broadcast add for each coded text."""
    shared = texts.sparkSession.sparkContext.broadcast(tree)
    parts, bits = math.ceil(_parts(tree) / 4), tree.bits(max(lengths))  # asks are taken a cut at a time
    names = ["part", "keys", "values", "cut"]

    def asked(batches):
        tree = shared.value
        for _, number, _, words, symbols, docs in _cuts(batches):
            hashes = _hashes(words)
            own = tree.ids(words, hashes)
            ids, hashes, frequent = own[symbols], hashes[symbols], tree.frequent[own][symbols]
            found = []
            for length in lengths:
                at = _places(docs, length)
                if length == 0:
                    at = at[~frequent]
                keys = _keys(tree, hashes, ids, at, length)
                if length:
                    held = frequent[at] & frequent[at - 1] & frequent[at - length]
                    held[held] = _value(keys[held].view(np.int64), tree.next[length - 1])[0]
                    at, keys = at[~held], keys[~held]
                found.append((_mixed(keys, bits), docs[at]))
            mixed, rows = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(mixed)
            mixed, rows = mixed[order], rows[order]
            yield _asked([(part, _steps(mixed[cut]), _packed(rows[cut]), number) for part, cut in _blocks(mixed, parts, bits)], names)

    def known(batches):
        for batch in batches:
            mixed = _mixed(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits)
            order = np.argsort(mixed)
            mixed, logs = mixed[order], batch.column(1).to_numpy(zero_copy_only=False)[order]
            yield _asked([(part, _steps(mixed[cut]), _packed(logs[cut]), None) for part, cut in _blocks(mixed, parts, bits)], names)

    def look_up(batches):
        found, asks = [], []
        for batch in batches:
            for _, keys, values, number in zip(*(c.to_pylist() for c in batch.columns)):
                (found if number is None else asks).append((keys, values, number))
        keys, logs = _walked([t[0] for t in found]), _unpacked([t[1] for t in found], np.float64)
        order = np.argsort(keys)
        keys, logs = keys[order], logs[order]
        first = _firsts(keys)  # a sequence may add, and be a context with a factor
        table = keys[first], np.add.reduceat(logs, first) if len(first) else logs
        for keys, docs, number in asks:
            held, logs = _value(_walked([keys]), table)
            yield _sums(number, np.bincount(_unpacked([docs], np.int64)[held], logs[held]))

    def add(batches):
        sums = {}
        for batch in batches:
            for number, packed in zip(*(c.to_pylist() for c in batch.columns)):
                some, so_far = _unpacked([packed], np.float64), sums.get(number, np.zeros(0))
                total = np.zeros(max(len(some), len(so_far)))
                total[: len(so_far)] += so_far
                total[: len(some)] += some
                sums[number] = total
        for number, some in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(number + np.arange(len(some))), pa.array(some)], names=["_row", "rest_score"])

    schema = "part int, keys binary, values binary, cut long"
    blocks = texts.mapInArrow(freeing(asked), schema).unionAll(told.mapInArrow(freeing(known), schema))
    sums = blocks.repartition(parts, "part").mapInArrow(freeing(look_up), "cut long, sums binary")
    return sums.repartition("cut").mapInArrow(freeing(add), "_row long, rest_score double")


def _asked(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def _sums(cut: int, sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([cut], pa.int64()), pa.array([_packed(sums.astype(float))], pa.binary())], names=["cut", "sums"])


def score(df: DataFrame, training: Column, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, training, n_tokens, n_known, train_tokens, base_score, score), a row for each row of df.

    Null and empty texts are the end mark alone.  Repeated rows score alike.  Without training texts
    all counts are 0.  Further columns are not read.
    """
    chosen = df.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("_text"), training.alias("_training"))
    with shuffles_removed(df.sparkSession):
        # Rows and their numbers are fixed by being written.
        texts = written(coded(chosen, "id", "_text", "_training"))
        tree, counts = train(texts)
        parts = written(scored_parts(texts, tree))
        # One after the other, so that what is shuffled for one goes before the next.
        rest = []
        for told, lengths in zip(tree.rest, ([0, 1], [2])):
            rest.append(written(rest_scores(texts, tree, told, lengths)))
            drop_table(told)
    rest = reduce(DataFrame.unionAll, rest).groupBy("_row").agg(F.sum("rest_score").alias("rest_score"))
    drop_table(texts)
    rare = parts.select("_row", F.explode("tail").alias("t")).select("_row", "t.word", "t.n")
    root = F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(float(tree.total + tree.distinct + 1)))
    tails = (
        rare.join(counts, "word", "left")
        .groupBy("_row")
        .agg(F.sum(F.col("n") * root).alias("tail_score"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("tail_known"))
    )
    added = parts.drop("tail").join(tails, "_row", "left").join(rest, "_row", "left").na.fill(0, ["tail_score", "tail_known", "rest_score"])
    return added.select(
        F.col("id").alias(id_col),
        F.col("_training").alias("training"),
        "n_tokens",
        (F.col("known_head") + F.col("tail_known")).cast("long").alias("n_known"),
        F.lit(tree.total).cast("long").alias("train_tokens"),
        (F.col("base_head") + F.col("tail_score")).alias("base_score"),
        (F.col("score_head") + F.col("tail_score") + F.col("rest_score")).alias("score"),
    )
