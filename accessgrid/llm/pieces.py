"""SentencePiece encoding and decoding by a table of distinct marked words.

No piece holds a white-space mark behind another character, so no merge crosses the place before a
mark, and none crosses a line feed where no piece holds one.  A text is therefore cut there into marked
words; each distinct one is segmented once and its ids go back to all places where the word stands.
The table lives in a Python worker and fills as texts pass, so no text is shuffled; it is emptied when
it holds CACHE words, which costs time and changes no result.  Texts are processed whole.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accessgrid.llm.common import freeing

#: Distinct marked words that a worker remembers, and the longest that it keeps for later texts.
CACHE = 400_000
LONGEST_KEPT = 200
#: Characters of texts that are worked on together.
BATCH_CHARS = 4_000_000

#: Not a name that a table has.
_SOURCE = "text of this step"
_MARK = "▁"
_WORDS = re.compile(" +[^ ]*")
_WORDS_AND_LINES = re.compile(" +[^ \n]*|\n[^ \n]*")


class Pieces:
    """One worker's model and its table of distinct marked words."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        if any(_MARK in name.lstrip(_MARK) for name in names):
            raise ValueError("the model's pieces cross white-space marks: words can't be segmented on their own")
        if self.model.normalize(" ﬁ  a ") != f"{_MARK}{_MARK}ﬁ{_MARK}{_MARK}a{_MARK}":
            raise ValueError("the model changes texts before it segments them")
        self.words = _WORDS if any("\n" in name for name in names) else _WORDS_AND_LINES
        one, two = self.model.encode(["\n", "\n\n"])
        self.mark = one[: 2 * len(one) - len(two)]
        #: Decimal ids with commas, and the text that they stand for.
        self.table: dict[str, tuple[bytes, bytes]] = {}
        names = [f"{i}".encode() for i in range(self.model.vocab_size())]
        self.decimal = names.__getitem__

    def cut(self, text: str | None) -> list[str]:
        """Marked words of a text, marks as spaces; the first has the mark that the model puts before all."""
        if not text:
            return []
        return self.words.findall(" " + (text.replace(_MARK, " ") if _MARK in text else text))

    def segment(self, words: list[str]) -> list[list[int]]:
        """Ids of marked words.  The model itself puts one mark before what it is given."""
        coded = self.model.encode([w[1:] if w[0] == " " else w for w in words], num_threads=1)
        return [self.mark if w == " " else ids if w[0] == " " else ids[len(self.mark) :] for w, ids in zip(words, coded)]

    def learn(self, words: Iterable[str]) -> list[str]:
        """Fill the table with what it lacks.  Gives back the words that are too long to be kept after this."""
        if len(self.table) > CACHE:
            self.table.clear()
        new = list(set(words).difference(self.table))
        if not new:
            return []
        coded = self.segment(new)
        # Decoding takes the first mark away.
        back = self.model.decode(coded, num_threads=1)
        self.table.update((w, (b",".join(map(self.decimal, ids)), (" " + t if w[0] == " " else t).encode())) for w, ids, t in zip(new, coded, back))
        return [w for w in new if len(w) > LONGEST_KEPT]

    def forget(self, words: list[str]) -> None:
        for word in words:
            del self.table[word]

    def digests(self, texts: list[str | None]) -> tuple[list[int], list[str], list[str]]:
        """Number of ids, digest of the ids and digest of the decoded text, for each text."""
        cut = [self.cut(t) for t in texts]
        long = self.learn(chain.from_iterable(cut))
        counts, coded, decoded = [], [], []
        for words in cut:
            found = list(map(self.table.__getitem__, words))
            joined = b",".join([ids for ids, _ in found])
            counts.append(joined.count(b",") + 1 if joined else 0)
            coded.append(hashlib.sha256(joined).hexdigest())
            decoded.append(hashlib.sha256(b"".join([text for _, text in found])[1:]).hexdigest())
        self.forget(long)
        return counts, coded, decoded

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self.cut(t) for t in texts]
        long = self.learn(chain.from_iterable(cut))
        made = [b",".join([self.table[w][0] for w in words]) for words in cut]
        self.forget(long)
        return [np.array(x.split(b","), "<u4").tobytes() if x else b"" for x in made]

    def decode(self, ids: list[bytes | None]) -> list[str]:
        return self.model.decode([np.frombuffer(x or b"", "<u4").tolist() for x in ids], num_threads=1)


_workers: dict[str, Pieces] = {}


def _worker(path: str) -> Pieces:
    """Built once for each Python worker; the model's file is part of the environment."""
    if path not in _workers:
        _workers[path] = Pieces(path)
    return _workers[path]


def _slices(sizes: list[int]) -> Iterator[slice]:
    start = size = 0
    for at, n in enumerate(sizes):
        if size and size + n > BATCH_CHARS:
            yield slice(start, at)
            start, size = at, 0
        size += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def _mapped(df: DataFrame, schema, call: Callable[[Pieces, list], list[pa.Array]], path: str) -> DataFrame:
    """The columns of df but the last, and what call makes of the last."""
    n = len(schema.names)

    def run(batches):
        pieces = _worker(path)
        for batch in batches:
            values = batch.column(batch.num_columns - 1).to_pylist()
            for part in _slices([len(v) if v else 0 for v in values]):
                cut = batch.slice(part.start, part.stop - part.start)
                made = call(pieces, values[part])
                yield pa.RecordBatch.from_arrays([*cut.columns[: n - len(made)], *made], names=schema.names)

    return df.mapInArrow(freeing(run), schema)


def encode(df: DataFrame, text: str, path: str, ids: str = "ids") -> DataFrame:
    """Adds `ids`: binary, the text's ids as little-endian unsigned 32-bit integers, without begin or end.

    Null and empty texts have no ids.  Repeated rows stay.  Other columns pass through; a column named
    as `ids` (in any case) is replaced.
    """
    kept = df.drop(ids)
    schema = kept.select("*", F.lit(b"").alias(ids)).schema
    rows = df.select(*[kept[c] for c in kept.columns], df[text].alias(_SOURCE))
    return _mapped(rows, schema, lambda p, values: [pa.array(p.encode(values), pa.binary())], path)


def decode(df: DataFrame, ids: str, path: str, out: str = "decoded") -> DataFrame:
    """Adds `out`: the text that the ids stand for; null and empty ids are the empty text.

    An unknown id is an error.  Other columns pass through; a column named as `out` is replaced.
    """
    kept = df.drop(out)
    schema = kept.select("*", F.lit("").alias(out)).schema
    rows = df.select(*[kept[c] for c in kept.columns], df[ids].alias(_SOURCE))
    return _mapped(rows, schema, lambda p, values: [pa.array(p.decode(values), pa.string())], path)


def round_trip(df: DataFrame, text: str, path: str, *keep: str) -> DataFrame:
    """(keep, n_tokens, ids_sha256, decoded_sha256): texts encoded, and the ids decoded again.

    Ids are hashed as decimals with commas, the decoded text as UTF-8.  Null and empty texts have no
    ids and the digests of nothing.  A row for each row, repeated ones too; columns that aren't kept
    are not read, whatever their names.  An empty table gives an empty one.
    """
    schema = df.select(*keep).schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")

    def made(pieces: Pieces, texts: list) -> list[pa.Array]:
        counts, coded, decoded = pieces.digests(texts)
        return [pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())]

    return _mapped(df.select(*keep, F.col(text).alias(_SOURCE)), schema, made, path)
