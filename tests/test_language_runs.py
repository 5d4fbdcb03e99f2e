"""Texts with long runs without letters, or in two scripts, get their language and do not end the executor."""

from martline.operators.enrich import detect_language


def test_long_runs_without_letters(spark):
    """Alternatives in a pattern took a stack frame a character: some three thousand ended the whole process."""
    runs = ["1", " ", "-", "☀", "\U0001F3E0", "\U00020000", "1 -"]
    df = spark.createDataFrame([(f"the house {r * 100_000} on the hill",) for r in runs] + [("7" * 100_000,)], "t string")
    got = [r[0] for r in detect_language(df, "t").select("lang_detected").collect()]
    assert got == ["en"] * 5 + ["zh", "en", None]


def test_scripts_are_counted_by_letters(spark):
    """Most letters win, ties go to the smaller code, kana makes Han Japanese, and Latin needs as many letters as the script."""
    texts = {"дом house": "en", "дома house": "en", "домами house": "ru", "αβγ дом": "el", "αβγ дома": "ru", "家家家 ab": "zh", "家家 abcd": None,
             "家の abc": None, "家のの ab": "ja", "\U00020000\U00020000 a": "zh", "بيت a": "ar", "": None}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.lang_detected for r in detect_language(df, "t").collect()}
    unsure = {t for t, lang in texts.items() if lang is None and t}
    assert all(got[t] not in ("zh", "ja") for t in unsure)
    assert {t: got[t] for t in texts if t not in unsure} == {t: lang for t, lang in texts.items() if t not in unsure}
