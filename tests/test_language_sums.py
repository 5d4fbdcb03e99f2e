"""Scores of languages are the plain sums of weights, and take one pass for two languages."""

import re

import pytest
from pyspark.sql import functions as F

from martline.functions.language import BUCKETS, MARGIN, latin_language, letter_groups


def plain_groups(text):
    codes = [ord(c) for c in " " + " ".join(re.findall(r"[^\W\d_]+", text.lower())) + "  "]
    out = [(a * 31 + b) % BUCKETS for a, b in zip(codes, codes[1:])]
    out += [(a * 961 + b * 31 + c + 7) % BUCKETS for a, b, c in zip(codes, codes[1:], codes[2:])]
    return out + [(a * 29791 + b * 961 + c * 31 + d + 13) % BUCKETS for a, b, c, d in zip(codes, codes[1:], codes[2:], codes[3:])]


@pytest.mark.parametrize("spread", [0, 3000, 1 << 20])
@pytest.mark.parametrize("languages", ["a", "ab", "abc"])
def test_scores_are_those_of_one_sum_a_language(spark, languages, spread):
    """Odd and even numbers of languages; weights that share a long and ones too far apart for it."""
    profiles = {lang: [-(i * (7 + k) + k) % 2000 - 2500 + (spread if (i + k) % 5 == 0 else 0) for i in range(BUCKETS)]
                for k, lang in enumerate(languages)}
    texts = ["x", "Guten Tag", "the house on the hill", "ￜￜￜￜￜ z", "ab ab ab " * 50]
    df = spark.createDataFrame([(t,) for t in [*texts, "12 .", "", None]], "t string")
    got = df.select("t", letter_groups(F.col("t")).alias("g"), latin_language(F.col("t"), profiles).alias("lang")).collect()
    for row in got:
        if row.t not in texts:
            assert not row.g and row.lang is None
            continue
        assert row.g == plain_groups(row.t)
        ranked = sorted((-sum(profiles[lang][g] for g in set(row.g)), lang) for lang in languages)
        clear = len(ranked) < 2 or ranked[1][0] - ranked[0][0] >= MARGIN
        assert row.lang == (ranked[0][1] if clear else None)


def test_language_sums_two_profiles_at_a_time(spark):
    """Seven languages take four passes over a text's groups (seven before)."""
    profiles = {lang: [-1] * BUCKETS for lang in "abcdefg"}
    plan = spark.range(1).select(latin_language(F.col("id").cast("string"), profiles).alias("lang"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("aggregate(") == 4
