import random
import zlib

import numpy as np
import pytest

from cases import LONG, TEXTS, frame, plain, rows
from martline.llm import wordbpe
from martline.llm.bpe import PrefixEncoder, bpe_digests, bpe_round_trip
from martline.llm.packing import curve_keys, hilbert_key, pack_digests, pack_documents
from martline.llm.wordbpe import default_vocabulary, library, plain_chunks

TOK = library(default_vocabulary())
HARD = ["", " ", "it's We'll 'stupid ''s x_y", "Σίσυφος ΟΔΟΣ", "naïve café café É", "İstanbul ŉ ſ ẞ",
        "a" * 3000, "x\x1cy\x85z w v", "½ ² ៣ 123", "<|startoftext|>a<|endoftext|><|endoftext", "\x00\x01 tab\tnew\r\nline"]


def want(text):
    return TOK.encode(text or "", add_special_tokens=False).ids


def test_round_trip_equals_the_library(spark):
    texts = HARD + [t for _, t, _ in TEXTS]
    got = {r.doc_id: r for r in bpe_round_trip(plain(spark, texts)).collect()}
    for n, text in enumerate(texts):
        ids = want(text)
        assert got[n].ids == " ".join(map(str, ids)) and got[n].n_tokens == len(ids)
        assert got[n].decoded == TOK.decode(ids, skip_special_tokens=False)


def test_random_words_equal_the_library():
    encoder, rnd = PrefixEncoder.of(default_vocabulary()), random.Random(6)
    for _ in range(3000):
        word = "".join(rnd.choice("abcdefghijklmnoprstuéüß'.,-é日ж") for _ in range(rnd.randint(1, 16)))
        assert encoder.encode(word)[0].decode() == " ".join(map(str, want(word)))


def test_long_plain_texts_are_cut_at_white_space(monkeypatch):
    monkeypatch.setattr(wordbpe, "CHUNK_CHARS", 50)
    for text in (LONG[:5000], "x" * 300 + " y", "a\n" * 200):
        assert [c for part in plain_chunks(text) for c in part] == text.lower().split()


def test_library_ids_with_a_small_cache(monkeypatch):
    texts = HARD + [t or "" for _, t, _ in TEXTS] + ["again and again, " * 50]
    for chunks, chars in ((1 << 19, 1 << 22), (20, 100), (3, 7)):
        monkeypatch.setattr(wordbpe, "CACHE_CHUNKS", chunks)
        monkeypatch.setattr(wordbpe, "CHUNK_CHARS", chars)
        cutter = wordbpe.LibraryIds(default_vocabulary())
        short = [t[:20_000] for t in texts]
        assert [np.frombuffer(cutter.encode(t), dtype="<u2").tolist() for t in short] == [want(t) for t in short]
        assert len(cutter.chunks) <= chunks


def test_bpe_odd_rows(spark):
    assert bpe_digests(frame(spark)).count() == len(rows())
    assert bpe_digests(frame(spark, [])).count() == 0


@pytest.mark.parametrize("dimensions,bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_key_visits_neighbours(dimensions, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij"), -1).reshape(-1, dimensions)
    keys = hilbert_key(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    assert np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1).max() == 1


def check_packing(got, texts, capacity):
    pieces, sequences = {}, {}
    for r in got:
        pieces.setdefault(r.n, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for n, text in enumerate(texts):
        ids = np.array(want(text) + [2], dtype="<u4")
        at = 0
        for r in sorted(pieces[n], key=lambda r: r.start):
            assert r.start == at and bytes(r.ids) == ids[at:at + r.length].tobytes() and r.doc_tokens == len(ids)
            at += r.length
        assert at == len(ids)
    for s, own in sequences.items():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at == capacity or s == max(sequences)
    assert sorted(sequences) == list(range(len(sequences)))


@pytest.mark.parametrize("capacity", [64, 4096])
def test_every_id_lies_in_one_piece(spark, capacity):
    texts = HARD + [t for _, t, _ in TEXTS] + ["same words here"] * 50
    docs = spark.createDataFrame([(n, t, "x") for n, t in enumerate(texts)], "n long, text string, ids string")
    check_packing(pack_documents(docs, capacity=capacity).collect(), texts, capacity)


def test_neighbours_on_the_curve_share_words(spark):
    kinds = {"sea": "ship wave harbour sail anchor tide fish", "sky": "cloud wing rain storm thunder bird sun"}
    ids = [np.array(want(" ".join(random.Random(n).choices(kinds[k].split(), k=200))), dtype="<u4").tobytes()
           for n, k in enumerate(["sea", "sky"] * 40)]
    order = np.argsort(curve_keys(ids, 4))
    changes = np.count_nonzero(np.diff(order % 2))
    assert changes < 20  # 40 by chance


def test_packing_odd_rows(spark):
    got = pack_documents(frame(spark)).collect()
    assert sum(r.length for r in got) == sum(len(want(r[1])) + 1 for r in rows())
    assert pack_documents(frame(spark, [])).count() == 0
    crcs = {(r.doc_id, r.start, r.ids_crc32) for r in pack_digests(frame(spark)).collect()}
    assert crcs == {(r.doc_id, r.start, zlib.crc32(bytes(r.ids))) for r in got}
