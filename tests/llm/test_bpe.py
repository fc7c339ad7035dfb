import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from accessgrid.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def known():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    return bpe.Bpe(bpe.load_ranks(PATH), P.PATTERN)


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


def nasty():
    rng = random.Random(5)
    alphabet = ["a", "b", "the", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x1f", "\x85", " ", " ", "　", "'s", "'", "1", "٣", "é", "ß", "日本", "\U0001f600", "́", ".", "--", "<|endoftext|>", "_", "\x00"]
    out = ["", " ", "\n", "a" * 3000, " " * 700 + "x", "ab" * 900, "=" * 1001, "\n" * 129, "日" * 400, "".join(rng.choice("ACGT") for _ in range(1500))]
    out += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)) for n in (63, 64, 65, 300)]
    return out + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 30))) for _ in range(3000)]


def test_nasty_texts(own, known):
    texts = nasty()
    got = own.encode(texts)
    bad = [t for t, g in zip(texts, got) if ids_of(g) != known.encode_ordinary(t)]
    assert bad == []
    assert own.decode(got) == [t.encode() for t in texts]


def test_all_at_once_and_leftmost_agree(own):
    rng = random.Random(6)
    pieces = [bytes(rng.choice(b"aeinrst h.") for _ in range(rng.randint(2, 90))) for _ in range(400)]
    pieces += [bytes(rng.randrange(256) for _ in range(60)) for _ in range(100)] + [b"a" * n for n in range(2, 60)]
    assert own._recurse(pieces, bpe._STEP) == own._recurse(pieces, bpe._STEP_ALL)


def test_small_cache(known, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 5)
    monkeypatch.setattr(bpe, "QUERY_BYTES", 40)
    own, texts = bpe.Bpe(bpe.load_ranks(PATH), P.PATTERN), nasty()[:600]
    for start in range(0, len(texts), 50):
        assert [ids_of(x) for x in own.encode(texts[start : start + 50])] == [known.encode_ordinary(t) for t in texts[start : start + 50]]


def expected(known, rows):
    out = []
    for i, t in rows:
        ids = known.encode_ordinary(t or "")
        out.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_documents(docs, odd, none, known):
    for df in (docs, odd):
        got = bpe.round_trip(df, "text", PATH, P.PATTERN, "doc_id").collect()
        assert sorted(map(tuple, got), key=str) == expected(known, [(r["doc_id"], r["text"]) for r in df.collect()])
    assert bpe.round_trip(none, "text", PATH, P.PATTERN, "doc_id").count() == 0


def test_columns(odd, known):
    coded = bpe.decode(bpe.encode(odd, "text", PATH, P.PATTERN, ids="fold"), "fold", PATH, P.PATTERN, out="text")
    assert set(coded.columns) == set(odd.columns)
    rows = coded.collect()
    assert sorted((r["text"] or b"").decode() for r in rows) == sorted(r["text"] or "" for r in odd.collect())


def test_unknown_id(own):
    with pytest.raises(ValueError):
        own.decode([np.array([50_300], "<u4").tobytes()])


def test_decoding_joins_in_order_without_aggregates(own, monkeypatch):
    """Texts without ids among others, several queries, and rows that the join returns in any order."""
    queries = []

    class Backwards:
        def __init__(self, db):
            self.register, self.unregister, self.sql_of = db.register, db.unregister, db.sql

        def sql(self, text):
            queries.append(text)
            return self.sql_of(text + " ORDER BY pos DESC")

    texts = ["", "one two\nthree", "", "Žluťoučký kůň 1234", "x" * 300, ""]
    ids = own.encode(texts)
    monkeypatch.setattr(own, "db", Backwards(own.db))
    monkeypatch.setattr(bpe, "DECODE_TOKENS", 10)
    assert own.decode(ids) == [t.encode() for t in texts]
    assert len(queries) > 2 and not any("agg" in q for q in queries)
