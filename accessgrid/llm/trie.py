"""Prefix trie of conversations from padded matrices of turn ids.

A turn's id is 128 bits of a digest of its role and text; a conversation is a row of ids.  Rows are
sorted and cut into range shards, a shard into slices of bounded size.  In a slice the ids stand in a
padded matrix: lexsort orders it, change masks OR-accumulated over columns mark where nodes begin, and
reduceat gives every depth its counts.  Only nodes that hold the first or the last row of a slice may go
on in another one: these leave as parts, are added up by key, and hand what they are worth to their
ancestors, which are such nodes, too.

Conversations of more than BLOCK turns are cut into blocks of that many.  A block hangs under the node
that its earlier turns lead to; the deepest blocks go first and hand their sums to the blocks above.
So no row, no group and no task grows with a conversation or with the number of its copies.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accessgrid.llm.common import freeing, numbered, written

#: Turns of a block, and cells of a slice's matrix.
BLOCK = 256
CELLS = 400_000
#: Conversations that share first turns stand under ids that this divides.
FAMILY = 20
#: Bytes of ids as text that are hashed together.
CHUNK = 1 << 16
ID = 16
ROOT = bytes(ID)

_PARTS = (
    "edge boolean, slice long, key binary, parent binary, parent_conv long, above array<binary>, depth long, conv long, n long, "
    "ends long, words long, children long, leaves long, saved long, more boolean, b_children long, b_leaves long, b_saved long"
)
_ENDS = "key binary, first long, ids string"


def _short(digest: bytes) -> bytes:
    return hashlib.sha256(digest).digest()[:ID]


def node_key(block: bytes, ids: bytes) -> bytes:
    """Key of the node that ids lead to from a block's root; the same as key_of makes."""
    return _short(block + _short(ids)) if ids else block


def short_digest(value: Column) -> Column:
    return F.unhex(F.substring(F.sha2(value, 256), 1, 2 * ID))


def key_of(block: Column, ids: Column) -> Column:
    return F.when(F.octet_length(ids) == 0, block).otherwise(short_digest(F.concat(block, short_digest(ids))))


def turns(df: DataFrame) -> DataFrame:
    """(conv_id, turn, id, words): null role or text is empty; rows without a conversation go."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = short_digest(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    known = df.filter(F.col("conv_id").isNotNull())
    return known.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("id"), words.alias("words"))


def rebuilt(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, at, id, words) of rebuilt conversations, and (conv_id, n) of all of them.

    The first h turns are those of the conversation that heads the family (conv_id less its remainder),
    h = CRC-32 of the id mod 4; its own turns after its first h follow.
    """
    sizes = written(placed.groupBy("conv_id").agg(F.min("place").alias("first"), F.count("*").alias("n")))
    h = (F.crc32(F.col("conv_id").cast("string")) % 4).alias("h")
    head = (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("head")
    heads = sizes.select(F.col("conv_id").alias("head"), F.col("n").alias("n_head"))
    taken = F.least(F.col("h"), F.coalesce("n_head", F.lit(0).cast("long"))).alias("taken")
    convs = sizes.select("*", h, head).join(heads, "head", "left").select(*sizes.columns, "h", "head", taken)
    convs = written(convs)

    own = placed.join(convs.select("conv_id", "first", "h", "taken"), "conv_id").withColumn("i", F.col("place") - F.col("first"))
    later = own.filter(F.col("i") >= F.col("h")).select("conv_id", (F.col("taken") + F.col("i") - F.col("h")).alias("at"), "id", "words")
    first = own.filter((F.col("conv_id") % FAMILY == 0) & (F.col("i") < 3)).select(F.col("conv_id").alias("head"), "i", "id", "words")
    lent = convs.filter(F.col("taken") > 0).select("conv_id", "head", "taken").join(first, "head")
    lent = lent.filter(F.col("i") < F.col("taken")).select("conv_id", F.col("i").alias("at"), "id", "words")
    zero = F.lit(0).cast("long")
    counts = convs.select("conv_id", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), zero)).alias("n"))
    return later.union(lent), counts


def blocks(rows: DataFrame, counts: DataFrame, block: int) -> tuple[DataFrame, int]:
    """(conv_id, block, root, ids, words, more): turns in blocks, each under the key of its first node.

    Turnless conversations are an empty block.  Also the number of blocks of the longest conversation.
    """
    each = rows.groupBy("conv_id", F.floor(F.col("at") / block).alias("block"))
    sorted_turns = F.array_sort(F.collect_list(F.struct("at", "id", "words")))
    ids = F.unhex(F.array_join(F.transform(F.col("t.id"), F.hex), ""))
    full = each.agg(sorted_turns.alias("t")).select("conv_id", "block", ids.alias("ids"), F.col("t.words").alias("words"))
    bare = counts.filter(F.col("n") == 0).select("conv_id", F.lit(0).cast("long"), F.lit(b""), F.array().cast("array<bigint>"))
    cut = written(full.union(bare).join(counts, "conv_id"))
    most = cut.agg(F.max("block")).first()[0]
    if most is None:
        return cut.select("conv_id", "block", F.lit(ROOT).alias("root"), "ids", "words", F.lit(False).alias("more")), 0
    more = (F.col("n") > (F.col("block") + 1) * block).alias("more")
    if most == 0:
        return cut.select("conv_id", "block", F.lit(ROOT).alias("root"), "ids", "words", more), 1
    # Keys of the blocks' first nodes, one after the other.
    long = cut.filter(F.col("n") > block).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("block", short_digest(F.col("ids")).alias("d")))).alias("ds"))
    chain = F.aggregate(F.slice(F.col("ds.d"), F.lit(1), F.size("ds") - 1), F.array(F.lit(ROOT)), lambda keys, d: F.concat(keys, F.array(short_digest(F.concat(F.element_at(keys, -1), d)))))
    keys = long.select("conv_id", F.posexplode(chain).alias("block", "key")).withColumn("block", F.col("block").cast("long"))
    root = F.coalesce("key", F.lit(ROOT)).alias("root")
    return written(cut.join(keys, ["conv_id", "block"], "left").select("conv_id", "block", root, "ids", "words", more)), int(most) + 1


@dataclass
class _Slice:
    """Rows of one slice, sorted; ids is (rows, columns, 2), padded with zeros."""

    roots: np.ndarray
    raw: list[bytes]
    ids: np.ndarray
    words: np.ndarray
    lens: np.ndarray
    conv: np.ndarray
    more: np.ndarray
    below: np.ndarray


def _padded(batch: pa.RecordBatch) -> _Slice:
    conv = batch.column(1).to_numpy(zero_copy_only=False)
    raw = batch.column(2).to_pylist()
    lens = np.array([len(x) // ID for x in raw], np.int64)
    n, width = len(raw), int(lens.max())
    row = np.repeat(np.arange(n), lens)
    col = np.arange(len(row)) - np.repeat(np.cumsum(lens) - lens, lens)
    ids = np.zeros((n, width, 2), np.uint64)
    flat = np.frombuffer(b"".join(raw), ">u8").reshape(-1, 2).astype(np.uint64)
    flat[(flat == 0).all(axis=1), 1] = 1
    ids[row, col] = flat
    words = np.zeros((n, width), np.int64)
    words[row, col] = pc.list_flatten(batch.column(3)).to_numpy(zero_copy_only=False)
    roots = np.frombuffer(b"".join(batch.column(0).to_pylist()), ">u8").reshape(-1, 2).astype(np.uint64)
    keys = [conv, *(ids[:, c, k] for c in range(width - 1, -1, -1) for k in (1, 0)), roots[:, 1], roots[:, 0]]
    order = np.lexsort(keys)
    below = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in (5, 6, 7)], axis=1)
    more = batch.column(4).to_numpy(zero_copy_only=False).astype(bool)
    return _Slice(roots[order], [raw[i] for i in order], ids[order], words[order], lens[order], conv[order], more[order], below[order])


def _nodes(s: _Slice, number: int, depth0: int, block: int) -> Iterator[dict[str, list]]:
    """Nodes of a slice by depth: whole ones, and the parts of those that hold its first or last row."""
    n, width = s.ids.shape[:2]
    root_bytes = s.roots.astype(">u8").tobytes()

    def root_of(row: int) -> bytes:
        return root_bytes[ID * row : ID * (row + 1)]

    new_root = np.ones(n, bool)
    new_root[1:] = (s.roots[1:] != s.roots[:-1]).any(axis=1)
    change = np.ones((n, width + 1), bool)
    change[:, 0] = new_root
    change[1:, 1:] = (s.ids[1:] != s.ids[:-1]).any(axis=2)
    change = np.logical_or.accumulate(change, axis=1)

    # Column d is depth d; column 0 the blocks' roots, which are always parts.
    starts, stops, real, edge, count, least, ends = [], [], [], [], [], [], []
    whole, leaf, saved = (np.zeros((n, width + 2), np.int64) for _ in range(3))
    for d in range(width + 1):
        at = np.flatnonzero(change[:, d])
        to = np.append(at[1:], n)
        starts.append(at), stops.append(to), real.append(s.lens[at] >= d)
        edge.append((at == 0) | (to == n) | (d == 0))
        count.append(to - at), least.append(np.minimum.reduceat(s.conv, at))
        ends.append(np.add.reduceat(((s.lens == d) & ~s.more).astype(np.int64), at))
        done = real[d] & ~edge[d]
        rows = at[done]
        whole[rows, d] = 1
        if d:
            leaf[rows, d] = ends[d][done] == count[d][done]
            saved[rows, d] = (count[d][done] - 1) * s.words[rows, d - 1]
        if d == block:
            below = np.stack([np.maximum.reduceat(s.below[:, k], at) for k in range(3)], axis=1)
            leaf[rows, d] += below[done, 1]
            saved[rows, d] += below[done, 2]
    leaf, saved = (np.cumsum(x[:, ::-1], axis=1)[:, ::-1] for x in (leaf, saved))

    # Keys of the nodes that hold the first and the last row.
    paths = {row: [node_key(root_of(row), s.raw[row][: ID * d]) for d in range(int(s.lens[row]) + 1)] for row in (0, n - 1)}
    for d in range(width + 1):
        which = np.flatnonzero(real[d])
        if not len(which):
            continue
        at, to, cut = starts[d][which], stops[d][which], edge[d][which]
        # Sums over all segments of the column; those of rows that ended before are left out.
        children = np.add.reduceat(whole[:, d + 1], starts[d])[which]
        leaves, kept = (np.add.reduceat(x[:, d], starts[d])[which] for x in (leaf, saved))
        goes_on, under = np.zeros(len(which), bool), np.zeros((len(which), 3), np.int64)
        if d == block:
            goes_on, under = np.logical_or.reduceat(s.more, starts[d])[which], below[which]
        over = np.zeros(len(which), np.int64) if d == 0 else np.searchsorted(starts[d - 1], at, "right") - 1
        ended = ends[d][which]
        key, parent, parent_conv, above = [], [], [], []
        for j in range(len(which)):
            row = int(at[j])
            if cut[j] and d:
                path = paths[0] if row == 0 else paths[n - 1]
                key.append(path[d]), above.append(path[:d])
            else:
                key.append(node_key(root_of(row), s.raw[row][: ID * d]) if d == 0 or ended[j] or goes_on[j] else None)
                above.append([] if d == 0 else None)
            if d == 0:
                parent.append(None), parent_conv.append(None)
            elif edge[d - 1][over[j]]:
                parent.append(node_key(root_of(row), s.raw[row][: ID * (d - 1)])), parent_conv.append(None)
            else:
                parent.append(None), parent_conv.append(int(least[d - 1][over[j]]))
        inside = ~cut
        yield {
            "edge": cut, "slice": np.full(len(which), number), "key": key, "parent": parent, "parent_conv": parent_conv, "above": above,
            "depth": np.full(len(which), depth0 + d), "conv": least[d][which], "n": count[d][which], "ends": ended,
            "words": s.words[at, d - 1] if d else np.zeros(len(which), np.int64), "children": children + under[:, 0] * inside,
            "leaves": leaves, "saved": kept, "more": goes_on,
            "b_children": under[:, 0], "b_leaves": under[:, 1], "b_saved": under[:, 2],
        }


def _slices(lens: np.ndarray) -> Iterator[slice]:
    """Runs of rows whose padded matrix has at most CELLS cells (a single row may have more)."""
    start, widest = 0, 0
    for at, n in enumerate(lens.tolist()):
        if at > start and max(widest, n, 1) * (at - start + 1) > CELLS:
            yield slice(start, at)
            start, widest = at, 0
        widest = max(widest, n)
    if start < len(lens):
        yield slice(start, len(lens))


def parts(rows: DataFrame, depth0: int, block: int) -> DataFrame:
    """Nodes and parts of nodes of one level of blocks, written; rows has what the blocks below are worth."""
    kinds = {"boolean": pa.bool_(), "binary": pa.binary(), "long": pa.int64(), "array<binary>": pa.list_(pa.binary())}

    def run(batches):
        arrow = pa.schema([(name, kinds[kind]) for name, kind in map(str.split, _PARTS.split(","))])
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            lens = pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False) // ID
            for cut in _slices(lens):
                part = _padded(batch.slice(cut.start, cut.stop - cut.start))
                for made in _nodes(part, number, depth0, block):
                    yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in arrow], schema=arrow)
                number += 1

    order = ["root", "ids", "conv_id"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    columns = ranged.select("root", "conv_id", "ids", "words", "more", "b_children", "b_leaves", "b_saved")
    return written(columns.mapInArrow(freeing(run), _PARTS))


def recombined(made: DataFrame) -> DataFrame:
    """Whole nodes of the parts: added up by key, with the sums of the parts' whole nodes and of one another."""
    total = [F.sum(c).alias(c) for c in ("n", "ends", "children", "leaves", "saved")]
    same = [F.max(c).alias(c) for c in ("depth", "words", "parent", "above", "more", "b_children", "b_leaves", "b_saved")]
    nodes = written(made.filter("edge").groupBy("key").agg(F.min("conv").alias("conv"), *total, *same))
    inner = F.size("above") > 0
    own_leaf = F.when(inner, (F.col("ends") == F.col("n")).cast("long") + F.col("b_leaves")).otherwise(0)
    own_saved = F.when(inner, (F.col("n") - 1) * F.col("words") + F.col("b_saved")).otherwise(0)
    to = F.explode(F.concat(F.array("key"), "above")).alias("key")
    worth = nodes.select(to, own_leaf.alias("l"), own_saved.alias("s")).groupBy("key").agg(F.sum("l").alias("l"), F.sum("s").alias("s"))
    children = nodes.filter(inner).groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("c"))
    met = nodes.join(worth, "key", "left").join(children, "key", "left")
    add = {"leaves": "l", "saved": "s", "children": "c"}
    met = met.withColumns({c: F.col(c) + F.coalesce(F.col(x), F.lit(0)) for c, x in add.items()})
    met = met.withColumn("children", F.col("children") + F.col("b_children")).drop("l", "s", "c")
    # Conversations without any turn: the root itself is the leaf.
    return written(met.withColumn("leaves", F.when(~inner & (F.col("children") == 0), F.lit(1).cast("long")).otherwise(F.col("leaves"))))


def end_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): digest of the ids, ascending and comma-joined, for each key.

    Ranges of (key, conv_id) make pieces of text; a key's pieces then run through one digest in order,
    so that a node where many conversations end is a stream of bytes, never a list.
    """

    def text(batches):
        key, first, ids, size = None, None, [], 0
        for batch in batches:
            out = []
            for k, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != key or size > CHUNK:
                    if ids:
                        out.append((key, first, ",".join(ids)))
                    key, first, ids, size = k, conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))], names=["key", "first", "ids"])
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([first], pa.int64()), pa.array([",".join(ids)])], names=["key", "first", "ids"])

    def digest(batches):
        key, state = None, None
        for batch in batches:
            out = []
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if k != key:
                    if key is not None:
                        out.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.string()))], names=["key", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], names=["key", "ends_sha256"])

    ranged = ends.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    pieces = ranged.mapInArrow(freeing(text), _ENDS)
    return pieces.repartition("key").sortWithinPartitions("key", "first").mapInArrow(freeing(digest), "key binary, ends_sha256 string")


def prefix_trie(df: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    df has conv_id, turn, role and text; other columns aren't read.  Turns go by `turn`, null first, equal
    ones by the digest of role and text, so repeated rows are turns of their own.  Null role or text is
    empty; rows without conv_id take no part.  Remainders of negative ids are as SQL has them.  Texts of
    any length are digested where they are read.  An empty table has no node, not even the root.
    """
    placed = numbered(turns(df), [F.col("conv_id"), F.col("turn"), F.col("id")], "place")
    rows, levels = blocks(*rebuilt(placed), block)
    if levels == 0:
        out = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
        return df.sparkSession.createDataFrame([], out)

    worth = ["b_children", "b_leaves", "b_saved"]
    made: list[DataFrame] = [None] * levels
    merged: list[DataFrame] = [None] * levels
    for level in range(levels - 1, -1, -1):
        here = rows.filter(F.col("block") == level)
        if level < levels - 1:
            roots = merged[level + 1].filter(F.size("above") == 0).select(F.col("key").alias("next"), *[F.col(x[2:]).alias(x) for x in worth])
            on, off = here.filter("more"), here.filter(~F.col("more"))
            on = on.withColumn("next", key_of(F.col("root"), F.col("ids"))).join(roots, "next", "left").drop("next")
            here = on.unionByName(off, allowMissingColumns=True).fillna(0, worth)
        else:
            here = here.withColumns({x: F.lit(0).cast("long") for x in worth})
        made[level] = parts(here, level * block, block)
        merged[level] = recombined(made[level])

    nodes = None
    for level in range(levels):
        # A block's root is a node of the level above, but for the first.
        known = merged[level].filter((F.size("above") > 0) | (F.lit(level) == 0)).select("key", "conv")
        if level:
            before = made[level - 1].filter(~F.col("edge") & F.col("more")).select("key", "conv")
            known = known.union(before).union(merged[level - 1].filter("more").select("key", "conv"))
        known = written(known.withColumnRenamed("conv", "parent_conv"))
        result = ["conv", "depth", "parent_conv", "n", "children", "leaves", "saved", "key"]
        # A slice's children ask their slice's own copy of a parent, as the root may have most of all nodes.
        copies = made[level].filter("edge").select("slice", "key").join(known, "key").withColumnRenamed("key", "parent")
        inner = made[level].filter(~F.col("edge"))
        under = inner.filter(F.col("parent").isNotNull()).drop("parent_conv").join(copies, ["slice", "parent"], "left").select(*result)
        parts_whole = merged[level].filter((F.size("above") > 0) | (F.lit(level) == 0)).drop("parent_conv")
        parts_whole = parts_whole.join(known.withColumnRenamed("key", "parent"), "parent", "left").select(*result)
        each = inner.filter(F.col("parent").isNull()).select(*result).union(under).union(parts_whole)
        nodes = each if nodes is None else nodes.union(each)
    nodes = written(nodes)

    ends = rows.filter(~F.col("more")).select(key_of(F.col("root"), F.col("ids")).alias("key"), "conv_id")
    met = nodes.filter(F.col("key").isNotNull()).join(end_digests(ends), "key", "left").select(*nodes.columns, "ends_sha256")
    rest = nodes.filter(F.col("key").isNull()).withColumn("ends_sha256", F.lit(None).cast("string"))
    return met.union(rest).select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent_conv").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
