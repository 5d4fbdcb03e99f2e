import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from cases import LONG, TEXTS, frame, plain, rows
from martline.llm import pieces
from martline.llm.pieces import PieceEncoder, default_model, piece_digests, piece_round_trip
from martline.llm.queries import QUERIES

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=default_model())
HARD = ["", " ", "  ", "a  b   c    d", "\n\n x\ty \r\n", "▁▁a▁ b", "<s></s><unk><0x41>", "日本語 テスト 😀 한국어", "x\x00y",
        "   around   ", "aaaa" * 50, " " * 1000, " " * 77 + "word" + " " * 33, "1234567 12.5%", "İ ẞ é é", "the▁the"]


def check(texts, encoder=None):
    encoder = encoder or PieceEncoder.of(default_model())
    for text, (ids, decoded) in zip(texts, encoder.encode_all(texts), strict=True):
        want = LIBRARY.encode(text, num_threads=1)
        assert ids.decode() == ",".join(map(str, want)), text[:200]
        assert decoded.decode() == LIBRARY.decode(want)


def test_hard_texts_equal_the_library():
    check([*HARD, LONG[:100_000], "a" * 5000, *[t or "" for _, t, _ in TEXTS if t is None or len(t) < 1000]])


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz", "the and ing of to", "acgt", " ▁a", "éèüß日本の中国 .,-'\"\n\t", "ABCdef012 "])
def test_random_texts_equal_the_library(letters):
    rnd = random.Random(letters)
    check(["".join(rnd.choice(letters) for _ in range(rnd.choice([1, 3, 20, 65, 130, 400]))) for _ in range(500)])


def test_long_words_and_short_ones_merge_alike(monkeypatch):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdeilnorst") for _ in range(rnd.randint(1, 300))) for _ in range(300)]
    encoder = PieceEncoder.of(default_model())
    whole = encoder.cut(words)
    for limit in (0, 10_000):
        monkeypatch.setattr(pieces, "SHORT_WORD", limit)
        assert all(np.array_equal(a, b) for a, b in zip(whole, encoder.cut(words)))


def test_small_memory_gives_the_same(monkeypatch):
    encoder = PieceEncoder(default_model())
    for words, kept, chars in ((5, 7, 3), (1, 1, 40)):
        monkeypatch.setattr(pieces, "CHUNK_WORDS", words)
        monkeypatch.setattr(pieces, "CACHE_WORDS", kept)
        monkeypatch.setattr(pieces, "CACHE_CHARS", chars)
        encoder.known.clear()
        check([*HARD, "one two three one two three four five six " * 3], encoder)
        assert len(encoder.known) <= max(kept, words)


def test_round_trip_and_digests(spark):
    texts = HARD + ["plain words here"]
    got = {r.doc_id: r for r in piece_round_trip(plain(spark, texts)).collect()}
    short = {r.doc_id: r for r in piece_digests(plain(spark, texts)).collect()}
    for n, text in enumerate(texts):
        ids = LIBRARY.encode(text)
        assert (got[n].ids, got[n].n_tokens, got[n].decoded) == (",".join(map(str, ids)), len(ids), LIBRARY.decode(ids))
        assert short[n].ids_sha256 == hashlib.sha256(got[n].ids.encode()).hexdigest()
        assert short[n].decoded_sha256 == hashlib.sha256(got[n].decoded.encode()).hexdigest()


def test_odd_rows(spark):
    got = piece_digests(frame(spark)).collect()
    assert len(got) == len(rows()) and {"doc_id", "SPANS", "score"} <= set(got[0].asDict())
    assert {r.n_tokens for r in got if not r.text} == {0}
    assert piece_digests(frame(spark, [])).count() == 0


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(open(default_model(), "rb").read())
    model.trainer_spec.model_type = model.trainer_spec.UNIGRAM
    (tmp_path / "other.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        PieceEncoder(str(tmp_path / "other.model"))


def test_query(spark, sf_small):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    got = QUERIES["op13_piece_round_trip"](spark, sf_small).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = LIBRARY.encode(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest())
