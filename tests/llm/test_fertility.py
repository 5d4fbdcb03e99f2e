import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from cases import LONG, frame, plain, rows
from martline.llm import fertility
from martline.llm.fertility import BANDS, OTHER, Cutter, default_model, default_pieces, duplicate_lines, judge, keep_quality, quality_verdicts
from martline.llm.fertility import repeated_words, script_of
from dataclasses import asdict


def brute_repeated(words):
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    return len(covered)


def test_repeated_words():
    rnd = random.Random(2)
    for _ in range(300):
        words = [rnd.randrange(4) for _ in range(rnd.randint(0, 30))]
        assert repeated_words(np.array(words, dtype=np.int64)) == brute_repeated(words)


def test_duplicate_lines():
    assert duplicate_lines(b"a\n\n\na\n b\nb\na") == 2
    assert duplicate_lines(b"") == 0


def test_counts_of_one_text():
    cutter = Cutter.of(default_model(), default_pieces())
    text = "Ünder #a|b <x>\x1f  $$\nÜnder"
    got = dict(zip(fertility._NAMES, judge(text, cutter, {k: asdict(v) for k, v in BANDS.items()}, asdict(OTHER))))
    words = ["Ünder", "#a|b", "<x>\x1f ", "$$", "Ünder"]
    assert (got["n_words"], got["word_chars"]) == (5, sum(map(len, words)))
    assert got["n_symbols"] == 6 and got["base_failed"]


def test_words_are_cut_alone_and_the_cache_is_bounded(monkeypatch):
    cutter = Cutter(default_model(), default_pieces())
    words = [w.encode() for w in LONG.split()[:3000]]
    whole = cutter.cut(words)
    monkeypatch.setattr(fertility, "CACHE_WORDS", 50)
    monkeypatch.setattr(fertility, "CHUNK_WORDS", 70)
    small = Cutter(default_model(), default_pieces())
    assert small.cut(words) == whole and len(small.known) <= 70
    for word, (ids, pieces) in zip(words, whole):
        assert np.frombuffer(ids, dtype="<u2").tolist() == cutter.model.encode(word.decode())
        assert pieces == len(cutter.pieces.encode_ordinary(" " + word.decode()))


def test_scripts():
    assert script_of("plain text") == "Latin" and script_of("слово x") == "Cyrillic"
    assert script_of("日本") == "Han" and script_of("123 !?") == "none" and script_of("") == "none"


def test_rejects_junk_and_keeps_prose(spark):
    rnd = random.Random(4)
    vocab = "the of and to people water because house morning every during school little number always place".split()
    prose = [" ".join(rnd.choice(vocab) for _ in range(120)) for _ in range(300)]
    codes = [" ".join(f"{rnd.randint(0, 9)}#{rnd.choice('xqz')}%" for _ in range(120)) for _ in range(10)]
    got = quality_verdicts(plain(spark, prose + codes)).collect()
    kept = {r.doc_id for r in got if r.kept}
    assert len(kept & set(range(300))) >= 297 and not kept & set(range(300, 310))


def test_junk_is_rejected_in_small_tables_and_rare_languages(spark):
    rnd = random.Random(6)
    vocab = "the of and to people water because house morning every during school little number always place".split()
    prose = lambda: " ".join(rnd.choice(vocab) for _ in range(400))
    junk = " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(400))
    for lang, n in (("en", 5), ("en", 150), ("en", 300), ("fi", 150), ("fi", 300)):
        docs = spark.createDataFrame([(i, prose(), lang) for i in range(n)] + [(n, junk, lang)], "doc_id long, text string, lang string")
        got = {r.doc_id: r for r in quality_verdicts(docs).collect()}
        assert not got[n].base_failed and got[n].chars_per_token > BANDS["Latin"].min_chars_per_token
        assert not got[n].kept and sum(got[i].kept for i in range(n)) >= 0.99 * n, (lang, n)


#: First and last letter of a script, and prose in it.
SCRIPTS = {
    "Latin": ("a", "z", "The weather is very nice today, so I went for a walk in the park with my friends."),
    "Cyrillic": ("а", "я", "Сегодня хорошая погода, и мы с друзьями пошли гулять в парк."),
    "Greek": ("α", "ω", "Σήμερα ο καιρός είναι καλός και πήγα βόλτα στο πάρκο με τους φίλους μου."),
    "Arabic": ("ء", "ي", "ذهبت مع أصدقائي إلى الحديقة اليوم لأن الطقس كان جميلا"),
    "Hebrew": ("א", "ת", "היום מזג האוויר יפה מאוד והלכתי עם חברים שלי לפארק"),
    "Han": ("一", "龥", "今天天气很好，我和朋友们一起去公园散步。我们应该努力学习新的知识。"),
    "Hiragana": ("ぁ", "ん", "今日は天気がとても良いので、友達と一緒に公園を散歩しました。"),
    "Hangul": ("가", "힣", "오늘은 날씨가 좋아서 친구들과 함께 공원에 갔다."),
    "Devanagari": ("अ", "ह", "आज मौसम बहुत अच्छा है और मैं अपने दोस्तों के साथ पार्क में घूमने गया।"),
    "Thai": ("ก", "ะ", "วันนี้อากาศดีมาก ฉันกับเพื่อนไปเดินเล่นที่สวนสาธารณะ")}


@pytest.mark.parametrize("script", SCRIPTS)
def test_random_letters_of_a_script_are_rejected_and_prose_is_in_band(script):
    first, last, prose = SCRIPTS[script]
    rnd, cutter = random.Random(5), Cutter.of(default_model(), default_pieces())
    bands, other = {k: asdict(v) for k, v in BANDS.items()}, asdict(OTHER)
    noise = " ".join("".join(chr(rnd.randint(ord(first), ord(last))) for _ in range(rnd.randint(2, 9))) for _ in range(300))
    verdicts = [dict(zip(fertility._NAMES, judge(t, cutter, bands, other))) for t in (noise, prose)]
    assert [v["script"] for v in verdicts] == [script, script]
    assert [v["in_band"] for v in verdicts] == [False, True]


def test_a_text_is_judged_by_itself(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    whole = {r.doc_id: r for r in quality_verdicts(docs).collect()}
    some = docs.filter("doc_id % 40 = 3")
    assert all(r == whole[r.doc_id] for r in quality_verdicts(some).collect())


def test_verdicts_equal_the_rules(spark, sf_small):
    """Every measure and the verdict from the libraries' own results on each word."""
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    cutter = Cutter(default_model(), default_pieces())
    for r in quality_verdicts(spark.read.parquet(f"{sf_small}/documents.parquet")).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id])
        ids = [i for w in words for i in cutter.model.encode(w)]
        pieces = sum(len(cutter.pieces.encode_ordinary(" " + w)) for w in words)
        chars, counts, n = sum(map(len, words)), Counter(ids), max(1, len(ids))
        entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
        share = sum(map(cutter.model.is_byte, ids)) / n
        band = BANDS.get(r.script, OTHER)
        within = (band.min_chars_per_token <= chars / n <= band.max_chars_per_token and share <= band.max_byte_share
                  and entropy >= band.min_entropy * math.log2(max(2, len(ids))) and chars / max(1, pieces) >= band.min_chars_per_piece)
        assert (r.n_tokens, r.chars_per_token, r.byte_share, r.chars_per_piece) == (len(ids), chars / n, share, chars / max(1, pieces))
        assert r.entropy == pytest.approx(entropy) and r.kept == (within and not r.base_failed)


def test_odd_rows(spark):
    docs = frame(spark)
    got = quality_verdicts(docs).collect()
    assert len(got) == len(rows()) and all(isinstance(r.kept, bool) for r in got)
    assert sum(r.n_words == 0 and r.base_failed and not r.kept for r in got) == sum(not (r[1] or "").split() for r in rows())
    assert keep_quality(docs).schema == docs.schema
    assert quality_verdicts(frame(spark, [])).count() == 0


def test_known_words_are_looked_up_once():
    class Counted(dict):
        lookups = 0

        def __contains__(self, key):
            Counted.lookups += 1
            return super().__contains__(key)

        def __getitem__(self, key):
            Counted.lookups += 1
            return super().__getitem__(key)

        def get(self, key):
            Counted.lookups += 1
            return super().get(key)

    cutter = Cutter(default_model(), default_pieces())
    words = [b"one", b"two", b"one", b"w" * 100]
    first = cutter.cut(words)
    cutter.known = Counted(cutter.known)
    assert cutter.cut(words[:3]) == first[:3] and Counted.lookups == 3
    assert cutter.cut(words) == first and words[3] not in cutter.known
