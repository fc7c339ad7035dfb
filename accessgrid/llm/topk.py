"""Exact top-k search by inner product, pruned by segment statistics.

A vector cut into segments of width w has for each a mean m and a deviation s.  Between two vectors,
sum w * ((m - m')**2 + (s - s')**2) never exceeds the squared distance; finer segments come closer.
With the lengths known, a distance bound is a score bound: score = (|q|^2 + |x|^2 - distance^2) / 2.
A pair whose bound cannot reach the query's k-th best score is dropped, first on few wide segments,
then on narrow ones; the rest is scored exactly, on integers.

Rows that agree in id and vector are one with a count, so a block holds distinct rows however often one
is repeated; they come apart again among the k best.  Queries and candidates travel as blocks of bounded size that meet by an equi-join on the block's
number; each meeting gives k rows for each query at most.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accessgrid.llm.common import freeing, written

SCALE = 1024
QUERY_BLOCK, CANDIDATE_BLOCK = 2048, 4096
#: Segments of each level, coarse to fine.
LEVELS = (4, 16)
#: Candidates whose bounds are looked at together.
CHUNK = 1024
#: Products of floats below this are exact.
EXACT = float(2**53)


def usable(vec: str) -> Column:
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(vec).isNotNull() & (F.size(vec) > 0) & F.coalesce(fine, F.lit(False))


def quantised(df: DataFrame, id_col: str, vec: str) -> DataFrame:
    """(id, v): components as floor(1024 * x).  Rows without id, null or empty vectors, and vectors
    with null or non-finite components take no part."""
    whole = F.transform(vec, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return df.filter(F.col(id_col).isNotNull() & usable(vec)).select(F.col(id_col).cast("long").alias("id"), whole.alias("v"))


def _blocks(df: DataFrame, rows: int, size: int, prefix: str) -> DataFrame:
    """Rows packed by vector length and block; a block holds about `size` vectors."""
    count = max(1, -(-rows // size))
    block = F.pmod(F.xxhash64("id", "v"), F.lit(count)).cast("int")
    packed = df.groupBy(F.size("v").alias("dim"), block.alias(f"{prefix}_block"))
    return packed.agg(*[F.collect_list(c).alias(f"{prefix}_{c}") for c in df.columns])


def segment_statistics(x: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Widths, and means and deviations by row and segment; the last segments may be narrower."""
    edges = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int)
    widths = np.diff(edges).astype(float)
    mean = np.add.reduceat(x, edges[:-1], axis=1) / widths
    square = np.add.reduceat(x * x, edges[:-1], axis=1) / widths
    return widths, mean, np.sqrt(np.maximum(square - mean * mean, 0))


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of q with all of x, held at the limits of 64 bits."""
    most = np.abs(q.astype(float)).max(initial=0) * np.abs(x.astype(float)).max(initial=0) * q.shape[1]
    if most < EXACT:
        return (q.astype(float) @ x.astype(float).T).astype(np.int64)
    if most < 2.0**62:
        return q @ x.T
    return np.clip(q.astype(object) @ x.T.astype(object), -(2**63), 2**63 - 1).astype(np.int64)


def block_top_k(q_id, q, floor, x_id, x, x_n, k: int) -> list[tuple[int, int, int, int]]:
    """(query row, candidate id, score, times it occurs): the k best of this block for each query,
    fewer where the others cannot reach `floor`, the k-th best score known before."""
    best: list[tuple[np.ndarray, ...]] = [(np.empty(0, np.int64),) * 3] * len(q)
    floor = floor.astype(float).copy()
    qf = q.astype(float)
    q_len, q_stats = (qf * qf).sum(1), [segment_statistics(qf, s) for s in LEVELS]
    for start in range(0, len(x), CHUNK):
        ids, part, times = (a[start : start + CHUNK] for a in (x_id, x, x_n))
        pf = part.astype(float)
        p_len = (pf * pf).sum(1)
        alive = ids[None, :] != q_id[:, None]
        reach = q_len[:, None] + p_len[None, :]
        slack = 1e-9 * reach + 1e-6
        for (w, qm, qs), (_, pm, ps) in zip(q_stats, [segment_statistics(pf, s) for s in LEVELS]):
            lengths = ((qm * qm + qs * qs) @ w)[:, None] + ((pm * pm + ps * ps) @ w)[None, :]
            bound = lengths - 2 * ((qm * w) @ pm.T + (qs * w) @ ps.T)  # least squared distance
            alive &= bound <= reach - 2 * floor[:, None] + slack
        rows = np.flatnonzero(alive.any(1))
        if not len(rows):
            continue
        exact = _scores(q[rows], part)
        for at, row in enumerate(rows):
            keep = alive[row]
            s = np.concatenate([best[row][0], exact[at, keep]])
            i = np.concatenate([best[row][1], ids[keep]])
            n = np.concatenate([best[row][2], times[keep]])
            order = np.lexsort((i, -s))[:k]
            best[row] = (s[order], i[order], n[order])
            if len(order) == k:
                floor[row] = max(floor[row], float(s[order[-1]]))
    return [(row, int(i), int(s), int(n)) for row, found in enumerate(best) for s, i, n in zip(*found)]


def _search(pairs: DataFrame, k: int) -> DataFrame:
    """pairs: one row for each meeting of a query block with a candidate block."""
    schema = "query_id long, query_hash long, vec_id long, score long, times long"

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda name: batch.column(batch.schema.get_field_index(name))[row].values
                dim = batch.column(batch.schema.get_field_index("dim"))[row].as_py()
                ids, hashes, floor = (get(c).to_numpy() for c in ("q_id", "q_hash", "q_floor"))
                q = get("q_v").flatten().to_numpy().reshape(-1, dim)
                x = get("x_v").flatten().to_numpy().reshape(-1, dim)
                found = block_top_k(ids, q, floor, get("x_id").to_numpy(), x, get("x_times").to_numpy(), k)
                at = np.array([f[0] for f in found], np.int64)
                cols = [ids[at], hashes[at], *[np.array([f[n] for f in found], np.int64) for n in (1, 2, 3)]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query_id", "query_hash", "vec_id", "score", "times"])

    return pairs.mapInArrow(freeing(run), schema)


def top_k(vectors: DataFrame, queries: Column, id_col: str = "vec_id", vec: str = "embedding", k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each query row, never its own id.

    Ties go to the smaller id; components and scores beyond 64 bits are held at the limits.  Only vectors of the query's length are compared.  Queries that agree
    in id and vector are one query; repeated candidates count as often as they occur.  An empty table
    gives no rows; further columns are not read.
    """
    kept = written(quantised(vectors, id_col, vec).groupBy("id", "v").agg(F.count("*").alias("times")))
    asked = quantised(vectors.filter(queries), id_col, vec).distinct().withColumn("hash", F.xxhash64("v"))
    asked = written(asked.withColumn("floor", F.lit(float("-inf"))))
    n, n_asked = kept.count(), asked.count()
    blocks = _blocks(kept, n, CANDIDATE_BLOCK, "x")
    q_blocks = max(1, -(-n_asked // QUERY_BLOCK))

    def met(queries_with_floor: DataFrame, candidates: DataFrame) -> DataFrame:
        asked_blocks = _blocks(queries_with_floor, n_asked, QUERY_BLOCK, "q")
        dealt = candidates.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
        return _search(dealt.join(asked_blocks, ["dim", "q_block"]), k)

    # A first block gives each query a k-th best score to prune with; it bounds, it doesn't decide.
    first = met(asked, blocks.filter("x_block = 0"))
    key = ["query_id", "query_hash"]
    known = first.groupBy(*key).agg(F.min("score").cast("double").alias("f"), F.count("*").alias("n"))
    known = known.select(F.col("query_id").alias("id"), F.col("query_hash").alias("hash"), F.when(F.col("n") >= k, F.col("f")).alias("f"))
    primed = asked.join(known, ["id", "hash"], "left").withColumn("floor", F.coalesce("f", "floor")).select(asked.columns)
    found = met(written(primed), blocks)
    best = Window.partitionBy(*key).orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("times", F.lit(k)).cast("int"))))
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
