"""Byte-level BPE, encoded and decoded by recursive DuckDB queries inside each partition.

A piece's bytes are token-position rows.  Each step joins neighbours with the merge table, takes each
word's pair of least rank, the leftmost of equals, and contracts it; the last step's rows are the ids.
Decoding joins ids with the vocabulary and aggregates the bytes in order.

Texts are cut by the tokenizer's pattern in Python; a piece is encoded once for each task as long as
its cache holds, so the recursion sees distinct pieces only.  All texts are processed whole.
"""
from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accessgrid.llm.common import freeing

#: Bytes of pieces that one recursive query works on.
QUERY_BYTES = 400_000
#: Pieces, and spans of text between single spaces, that a worker remembers.
CACHE = 600_000
#: Longer pieces contract all occurrences of the least pair at once where that gives the same ids.
LONG = 64
#: Steps of one recursive query; what isn't finished by then goes into the next.
STEPS = 40
#: Tokens that one decoding query works on.
DECODE_TOKENS = 2_000_000

# A row carries the place q and the token n that come next, and its pair's key k (rank and place).  Each word's
# least key says which row takes the next one in; only pairs beside a merge are looked up again.
_STEP = """
WITH RECURSIVE r(step, w, p, q, t, n, k, done) AS (
  SELECT 0::INTEGER, w, p, q, t, n, (m.r::BIGINT << 32) + p, false
  FROM (SELECT w, p, t, lead(t) OVER o AS n, lead(p) OVER o AS q FROM start WINDOW o AS (PARTITION BY w ORDER BY p)) x
  LEFT JOIN merges m ON m.a = x.t AND m.b = x.n
  UNION ALL
  SELECT step + 1, w, p, q, t, n, CASE WHEN ta IS NULL THEN k ELSE (m.r::BIGINT << 32) + p END, gone
  FROM (SELECT r.step, r.w, r.p, r.k, b.best IS NULL AS gone,
               CASE WHEN r.p = b.p1 THEN b.q2 ELSE r.q END AS q,
               CASE WHEN r.p = b.p1 THEN b.id ELSE r.t END AS t,
               CASE WHEN r.p = b.p1 THEN b.n2 WHEN r.q = b.p1 THEN b.id ELSE r.n END AS n,
               CASE WHEN r.p = b.p1 THEN b.id WHEN r.q = b.p1 THEN r.t END AS ta
        FROM r JOIN (
          SELECT x.w, best, (best >> 32)::INTEGER AS id, (best & 4294967295)::INTEGER AS p1, x.q1, y.q AS q2, y.n AS n2
          FROM (SELECT w, min(k) AS best, arg_min(q, k) AS q1 FROM r WHERE NOT done AND step < {steps} GROUP BY w) x
          LEFT JOIN r y ON y.w = x.w AND y.p = x.q1) b ON b.w = r.w
        WHERE b.q1 IS NULL OR r.p <> b.q1) x
  LEFT JOIN merges m ON m.a = x.ta AND m.b = x.n)
SELECT w, p, t, done FROM r WHERE done OR step = {steps} ORDER BY w, p
"""

# The same with all occurrences of the least rank at once, unless the merged token is part of a pair
# of still smaller rank; of overlapping occurrences every other one, from the left.
_STEP_ALL = """
WITH RECURSIVE r(step, w, p, t, done) AS (
  SELECT 0::INTEGER, w, p, t, false FROM start
  UNION ALL
  SELECT step + 1, w, p, CASE WHEN taken THEN best ELSE t END, best IS NULL
  FROM (SELECT *, lag(taken) OVER (PARTITION BY w ORDER BY p) AS gone
        FROM (SELECT *, least_here AND (p = first_p OR (safe AND (row_number() OVER (PARTITION BY w, run ORDER BY p)) % 2 = 1)) AS taken
              FROM (SELECT *, min(CASE WHEN least_here THEN p END) OVER (PARTITION BY w) AS first_p,
                           sum(CASE WHEN least_here THEN 0 ELSE 1 END) OVER (PARTITION BY w ORDER BY p) * 2 + CASE WHEN least_here THEN 1 ELSE 0 END AS run
                    FROM (SELECT *, coalesce(rank = best, false) AS least_here
                          FROM (SELECT *, min(rank) OVER (PARTITION BY w) AS best
                                FROM (SELECT step, w, p, t, m.r AS rank, m.safe AS safe
                                      FROM (SELECT step, w, p, t, lead(t) OVER (PARTITION BY w ORDER BY p) AS n
                                            FROM r WHERE NOT done AND step < {steps}) x
                                      LEFT JOIN merges m ON m.a = x.t AND m.b = x.n)))))
  ) WHERE best IS NULL OR NOT coalesce(gone, false))
SELECT w, p, t, done FROM r WHERE done OR step = {steps} ORDER BY w, p
"""

_SPANS = re.compile(r" ?[^ \n]+|\n")


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}


def merge_table(ranks: dict[bytes, int]) -> pa.Table:
    """(a, b, r, safe): all pairs of tokens that join to a token."""
    a, b, r, least = [], [], [], {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                a.append(left), b.append(right), r.append(rank)
                for part in (left, right):
                    least[part] = min(least.get(part, rank), rank)
    safe = [least.get(x, x + 1) > x for x in r]
    return pa.table({"a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32()), "r": pa.array(r, pa.int32()), "safe": safe})


class Bpe:
    """One worker's tokenizer: its DuckDB tables and its caches."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        # Unicode white space, as the tokenizer's own engine has it; \s here also takes x1c-x1f.
        self.pieces = regex.compile(pattern.replace(r"\S", r"\P{White_Space}").replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}"))
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        self.db.register("given", merge_table(ranks))
        self.db.execute("CREATE TABLE merges AS SELECT * FROM given")
        order = sorted(ranks.items(), key=lambda x: x[1])
        self.db.register("given", pa.table({"id": pa.array([r for _, r in order], pa.int32()), "token": pa.array([t for t, _ in order], pa.binary())}))
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM given")
        self.db.unregister("given")
        self.known: dict[str, bytes] = {}
        self.spans: dict[str, bytes] = {}

    def forget(self) -> None:
        """Empty the caches: a worker outlives its task, and would hold them through stages without it."""
        self.known.clear()
        self.spans.clear()

    def _recurse(self, pieces: list[bytes], step: str) -> list[bytes]:
        """Ids of pieces as little-endian bytes."""
        lengths = np.array([len(p) for p in pieces])
        w = np.repeat(np.arange(len(pieces), dtype=np.int32), lengths)
        p = (np.arange(len(w)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
        t = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        out: list[bytes] = [b""] * len(pieces)
        while len(w):
            self.db.register("start", pa.table({"w": w, "p": p, "t": t}))
            rows = self.db.sql(step.format(steps=STEPS)).to_arrow_table()
            self.db.unregister("start")
            w, p, t, done = (rows.column(i).to_numpy() for i in range(4))
            ids, cuts = t[done].astype("<u4").tobytes(), np.flatnonzero(np.diff(w[done], prepend=-1))
            for word, start, end in zip(w[done][cuts].tolist(), (4 * cuts).tolist(), [*(4 * cuts[1:]).tolist(), len(ids)]):
                out[word] = ids[start:end]
            w, p, t = w[~done], p[~done], t[~done]
        return out

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode pieces that aren't known: whole tokens at once, the rest by recursion."""
        if len(self.known) > CACHE:
            self.known.clear()
        short, long = [], []
        for piece in set(pieces):
            if piece not in self.known:
                data = piece.encode()
                if data in self.ranks:
                    self.known[piece] = int(self.ranks[data]).to_bytes(4, "little")
                else:
                    (short if len(data) <= LONG else long).append((piece, data))
        for group, step in ((short, _STEP), (long, _STEP_ALL)):
            start = 0
            while start < len(group):
                end, size = start, 0
                while end < len(group) and (end == start or size + len(group[end][1]) <= QUERY_BYTES):
                    size += len(group[end][1])
                    end += 1
                for (piece, _), ids in zip(group[start:end], self._recurse([d for _, d in group[start:end]], step)):
                    self.known[piece] = ids
                start = end

    def cut(self, text: str) -> list[str]:
        """The text in spans that are tokenized each on its own: words with the space before them, and
        line feeds, if nothing else stands between words; else the pieces themselves."""
        words, gaps = text.split(), text.count(" ") + text.count("\n")
        if len(words) != gaps + 1 or sum(map(len, words)) + gaps != len(text):
            return self.pieces.findall(text)
        return _SPANS.findall(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.spans) > CACHE:
            self.spans.clear()
        spans = [self.cut(t) if t else [] for t in texts]
        unseen = set(chain.from_iterable(spans)).difference(self.spans)
        # Letters, after a space or not, are one piece.
        single = {s for s in unseen if s.isalpha() or (s[:1] == " " and s[1:].isalpha())}
        split = {s: tuple(self.pieces.findall(s)) for s in unseen - single}
        self.learn(chain(single, chain.from_iterable(split.values())))
        self.spans.update((s, self.known[s]) for s in single)
        self.spans.update((s, b"".join([self.known[p] for p in pieces])) for s, pieces in split.items())
        get = self.spans.__getitem__
        return [b"".join(map(get, doc)) for doc in spans]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """Bytes of each id sequence, by a join with the vocabulary in the order of the ids.

        The joined column's bytes stand one after the other, so a text is a slice of them.
        """
        out: list[bytes] = [b""] * len(ids)
        start = 0
        while start < len(ids):
            end, size = start, 0
            while end < len(ids) and (end == start or size + len(ids[end]) // 4 <= DECODE_TOKENS):
                size += len(ids[end]) // 4
                end += 1
            flat = np.frombuffer(b"".join(ids[start:end]), "<u4").astype(np.int32)
            self.db.register("coded", pa.table({"pos": np.arange(len(flat), dtype=np.int32), "id": flat}))
            rows = self.db.sql("SELECT pos, token FROM coded JOIN vocabulary USING (id)").to_arrow_table()
            self.db.unregister("coded")
            if len(rows) != len(flat):
                raise ValueError("an id is not in the vocabulary")
            if (np.diff(rows.column("pos").to_numpy()) < 0).any():
                rows = rows.sort_by("pos")
            tokens = pa.concat_arrays(rows.column("token").chunks) if len(rows) else pa.array([], pa.binary())
            ends = np.cumsum(pc.binary_length(tokens).to_numpy(), dtype=np.int64)
            whole = pc.binary_join(pa.ListArray.from_arrays([0, len(tokens)], tokens), b"")[0].as_py()
            cuts = np.append(0, ends)[np.cumsum([0, *(len(x) // 4 for x in ids[start:end])])].tolist()
            out[start:end] = [whole[a:b] for a, b in zip(cuts, cuts[1:])]
            start = end
        return out


_workers: dict[tuple, Bpe] = {}


def _worker(path: str, pattern: str) -> Bpe:
    """Built once for each Python worker; the vocabulary file is part of the environment."""
    if (path, pattern) not in _workers:
        _workers[path, pattern] = Bpe(load_ranks(path), pattern)
    return _workers[path, pattern]


#: Characters of texts that are encoded together.
BATCH_CHARS = 4_000_000


def _groups(texts: list[str]) -> Iterator[slice]:
    start = size = 0
    for at, text in enumerate(texts):
        if size and size + len(text) > BATCH_CHARS:
            yield slice(start, at)
            start, size = at, 0
        size += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def encode(df: DataFrame, text: str, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """Adds `ids`: binary, the text's token ids as little-endian unsigned 32-bit integers.

    Null and empty texts have no ids.  Special tokens are ordinary text.  Other columns pass through;
    a column named as `ids` is replaced.
    """
    return _mapped(df, text, ids, lambda bpe, values: bpe.encode([v or "" for v in values]), path, pattern)


def decode(df: DataFrame, ids: str, path: str, pattern: str, out: str = "decoded") -> DataFrame:
    """Adds `out`: binary, the bytes that the ids stand for; null ids are none.  An unknown id is an error."""
    return _mapped(df, ids, out, lambda bpe, values: bpe.decode([v or b"" for v in values]), path, pattern)


def _mapped(df: DataFrame, source: str, target: str, call, path: str, pattern: str) -> DataFrame:
    kept = df.drop(target) if target != source else df
    schema = kept.select("*", F.lit(b"").alias(target)).schema

    def run(batches):
        bpe = _worker(path, pattern)
        for batch in batches:
            values = batch.column(batch.schema.get_field_index(source)).to_pylist()
            for part in _groups([v or "" for v in values]):
                cut = batch.slice(part.start, part.stop - part.start)
                made = pa.array(call(bpe, values[part]), pa.binary())
                yield pa.RecordBatch.from_arrays([*cut.columns, made], names=[*cut.schema.names, target])
        bpe.forget()

    return kept.mapInArrow(freeing(run), schema)


def round_trip(df: DataFrame, text: str, path: str, pattern: str, *keep: str) -> DataFrame:
    """(keep, n_tokens, ids_sha256, decoded_sha256): texts encoded, and the ids decoded again.

    Null and empty texts have no tokens and the digests of nothing.
    """
    schema = df.select(*keep).schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")

    def run(batches):
        bpe = _worker(path, pattern)
        for batch in batches:
            texts = [t or "" for t in batch.column(len(keep)).to_pylist()]
            for part in _groups(texts):
                ids = bpe.encode(texts[part])
                back = bpe.decode(ids)
                digests = [[hashlib.sha256(x).hexdigest() for x in xs] for xs in (ids, back)]
                made = [pa.array([len(x) // 4 for x in ids], pa.int64()), *map(pa.array, digests)]
                cut = batch.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([*cut.columns[: len(keep)], *made], names=schema.names)
        bpe.forget()

    return df.select(*keep, F.col(text).alias("_text")).mapInArrow(freeing(run), schema)
