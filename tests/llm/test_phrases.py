import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import frame
from martline.llm import phrases
from martline.llm.phrases import _exact_score, chunks_of, collocations, frequent_phrases, phrase_dictionary, score_phrases


def pieces_of(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def counted(docs, most=5):
    counts = Counter()
    for lang, text in docs:
        for words in pieces_of(text):
            counts[lang or "und", ""] += len(words)
            for k in range(1, most + 1):
                counts.update((lang or "und", " ".join(words[i:i + k])) for i in range(len(words) - k + 1))
    return counts


def brute(docs, least, top, percent=100):
    f = {x: n for x, n in counted(docs).items() if n >= least or not x[1]}
    found = []
    candidates = [x for x in f if " " in x[1]]
    longer = Counter()
    for lang, phrase in candidates:
        words = phrase.split(" ")
        for i in range(len(words)):
            for j in range(i + 2, len(words) + 1):
                if j - i < len(words):
                    part = lang, " ".join(words[i:j])
                    longer[part] = max(longer[part], f[lang, phrase])
    for lang, phrase in candidates:
        words, a, n = phrase.split(" "), f[lang, phrase], f[lang, ""]
        if 100 * longer[lang, phrase] >= percent * a:
            continue
        cuts = [(f[lang, " ".join(words[:k])], f[lang, " ".join(words[k:])]) for k in range(1, len(words))]
        score, _, left, right = min((1000 * a * n // (x * y), k, x, y) for k, (x, y) in enumerate(cuts))
        found.append((lang, phrase, a, left, right, n, score))
    out = []
    for lang in {x[0] for x in found}:
        own = sorted((x for x in found if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        out += [(x[0], rank, *x[1:]) for rank, x in enumerate(own[:top], 1)]
    return sorted(out)


def random_docs(seed, n=60):
    rnd = random.Random(seed)
    vocabulary = [rnd.choice("abcdeéß日") * rnd.randint(1, 3) for _ in range(12)] + ["The", "new york", "\x00x", "a b"]
    docs = [(rnd.choice(["en", "de", None, "und"]), rnd.choice([" ", "  ", "\t"]).join(
        rnd.choice(vocabulary) + rnd.choice(["", "", "", "", ".", ", ", "\n", "!?"]) for _ in range(rnd.randint(0, 120)))) for _ in range(n)]
    return docs + docs[:20] + [("en", None), (None, ""), ("en", "x " * 300)]


def test_chunks_hold_every_phrase_once(monkeypatch):
    for longest, block in ((4096, 1 << 22), (50, 100), (7, 11)):
        monkeypatch.setattr(phrases, "LONGEST_CHUNK", longest)
        monkeypatch.setattr(phrases, "BLOCK_BYTES", block)
        for _, text in random_docs(longest):
            found = Counter()
            for chunk, own in chunks_of(text or "", 4):
                words = chunk.split(b" ")
                assert own == len(words) - 4 <= longest
                for k in range(1, 6):
                    found.update(b" ".join(words[i:i + k]).decode() for i in range(own) if b"\xff" not in words[i:i + k])
            want = counted([("x", text)])
            assert found == Counter({p: n for (_, p), n in want.items() if p})


def test_equal_passages_share_chunks(spark):
    passage = " ".join(f"w{i * 7919 % 10007}" for i in range(3000))
    rnd = random.Random(2)
    docs = [(f"{' '.join(str(rnd.random()) for _ in range(50))} {passage}", "en") for _ in range(20)]
    rows = phrase_dictionary(spark.createDataFrame(docs, "text string, lang string")).collect()
    assert sum(r.own * r.times for r in rows if r.times == 20) > 20 * 2500


@pytest.mark.parametrize("seed,least,top,percent,bits", [(1, 5, 2000, 100, 1 << 26), (2, 3, 7, 60, 1 << 15), (3, 20, 50, 100, 1 << 15)])
def test_collocations_equal_brute_force(spark, seed, least, top, percent, bits):
    docs = random_docs(seed)
    df = spark.createDataFrame(docs, "lang string, text string").repartition(5)
    got = collocations(df, least=least, top=top, absorbed_percent=percent, bits=bits)
    assert sorted(tuple(r) for r in got.collect()) == brute(docs, least, top, percent)


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    docs = random_docs(4)
    monkeypatch.setattr(phrases, "_filter_bits", lambda buckets, bits: np.full(bits // 8, 255, dtype=np.uint8))
    got = collocations(spark.createDataFrame(docs, "lang string, text string"), least=4)
    assert sorted(tuple(r) for r in got.collect()) == brute(docs, 4, 2000)


def test_scores_are_exact_beyond_64_bits(spark):
    rows = [(10**16 + 7, 10**18 + 9, 10**16 + 11, 10**16 + 13), (10**15 + 3, 10**16 + 9, 10**8 + 7, 10**15 + 37), (100, 10**17, 100, 100), (3, 7, 5, 11)]
    got = spark.createDataFrame(rows, "a long, n long, l long, r long").select(_exact_score("a", "n", "l", "r").alias("s"))
    assert [r.s for r in got.collect()] == [1000 * a * n // (x * y) for a, n, x, y in rows]


def test_ties_go_to_the_earliest_cut(spark):
    f = spark.createDataFrame([("en", "", 0, 1000), ("en", "a", 1, 10), ("en", "b", 1, 10), ("en", "c", 1, 10), ("en", "a b", 2, 10),
                               ("en", "b c", 2, 10), ("en", "a b c", 3, 10)], "lang string, phrase string, words int, f long")
    rows = score_phrases(f).collect()
    assert [(r.phrase, r.l, r.r, r.score) for r in rows] == [("a b c", 10, 10, 100_000)]


def test_odd_rows(spark):
    got = collocations(frame(spark), least=2)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and got.count() > 0
    assert collocations(frame(spark, []), least=2).count() == 0
    frequent = frequent_phrases(phrase_dictionary(frame(spark)), least=1)
    assert frequent.filter((F.col("words") == 1) & (F.col("phrase") == "école")).first().f == 2


def test_sums_by_bucket_and_hashes_of_long_words():
    from martline.llm.phrases import LONG_WORD, _Sums, _Words
    rng = np.random.default_rng(4)
    for most in (5, 1 << 40):
        sums, want = _Sums(1 << 26), Counter()
        for _ in range(5):
            buckets, times = rng.integers(0, 50, 300), rng.integers(1, most, 300)
            sums.add(buckets, times)
            for b, t in zip(buckets.tolist(), times.tolist()):
                want[b] += t
        assert dict(zip(*map(np.ndarray.tolist, sums.total()))) == want
    long = [b"x" * LONG_WORD + bytes([c]) for c in b"abc"] + [b"x" * (LONG_WORD + n) for n in range(3)]
    words = _Words(b" ".join(long + [b"a", b"a", b"b"] + long))
    for which in (0, 1):
        hashes = words.hashes(which).tolist()
        assert hashes[:6] == hashes[9:] and len(set(hashes)) == 8 and hashes[6] == hashes[7] == _Words(b"a").hashes(which)[0]
