import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F

from accessgrid.llm import pieces, queries

PATH = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def known():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def expected(known, rows):
    out = []
    for doc_id, text in rows:
        ids = known.encode(text or "")
        back = known.decode(ids)
        out.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    return sorted(out, key=str)


def nasty():
    rng = random.Random(4)
    alphabet = ["a", "b", "the", " ", "  ", "\n", "\t", "\r\n", "▁", "▁▁", "\x85", "\u00a0", "\u3000", "'s", "1", "é", "ß", "日本", "\U0001f600", "\u0301", "\ufffd", ".", "<s>", "</s>", "<unk>", "<0x0A>", "\x00", "\u200b"]
    out = ["", " ", "  ", "\n", "\n\n", " \n", "\n ", "▁", "▁a", "a▁", "a" * 3000, " " * 700 + "x" + " " * 40, "ab" * 900, "日" * 400, "\U0001f600" * 50]
    return out + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 30))) for _ in range(5000)]


def test_nasty_texts(known):
    texts, own = nasty(), pieces.Pieces(PATH)
    got = own.encode(texts)
    assert [t for t, g in zip(texts, got) if np.frombuffer(g, "<u4").tolist() != known.encode(t)] == []
    assert own.decode(got) == [known.decode(known.encode(t)) for t in texts]
    made = list(zip(texts, *own.digests(texts)))
    assert sorted(made, key=str) == expected(known, [(t, t) for t in texts])


def test_small_table(known, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE", 5)
    monkeypatch.setattr(pieces, "LONGEST_KEPT", 3)
    own, texts = pieces.Pieces(PATH), nasty()[:600]
    for start in range(0, len(texts), 50):
        some = texts[start : start + 50]
        assert sorted(zip(some, *own.digests(some)), key=str) == expected(known, [(t, t) for t in some])
        assert all(len(w) <= 3 for w in own.table)


def test_each_distinct_word_is_segmented_once(monkeypatch):
    own, seen = pieces.Pieces(PATH), []
    real = own.segment
    monkeypatch.setattr(own, "segment", lambda words: seen.extend(words) or real(words))
    own.digests(["to be or not to be", "to be\nor not"])
    own.digests(["be or not"])
    assert sorted(seen) == sorted([" to", " be", " or", " not", "\nor"])


def test_documents(spark, docs, odd, none, known):
    for df in (docs, odd):
        got = pieces.round_trip(df, "text", PATH, "doc_id").collect()
        assert sorted(map(tuple, got), key=str) == expected(known, [(r["doc_id"], r["text"]) for r in df.collect()])
    assert pieces.round_trip(none, "text", PATH, "doc_id").count() == 0


def test_query_returns_a_row_for_each_document(spark, sf_dir, docs):
    out = queries.QUERIES["op11_pieces"](spark, sf_dir)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert out.count() == docs.count()


def test_encode_and_decode_keep_other_columns(odd, known):
    clash = odd.withColumn("IDS", F.lit("x"))
    coded = pieces.encode(clash, "text", PATH)
    back = pieces.decode(coded, "ids", PATH)
    assert back.columns == [*odd.columns, "ids", "decoded"]
    for r in back.collect():
        assert np.frombuffer(r["ids"], "<u4").tolist() == known.encode(r["text"] or "")
        assert r["decoded"] == known.decode(known.encode(r["text"] or ""))


def test_a_model_that_the_method_does_not_fit(monkeypatch):
    class Crossing(sentencepiece.SentencePieceProcessor):
        def id_to_piece(self, i):
            return "a▁b" if i == 5 else super().id_to_piece(i)

    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Crossing)
    with pytest.raises(ValueError, match="cross"):
        pieces.Pieces(PATH)
