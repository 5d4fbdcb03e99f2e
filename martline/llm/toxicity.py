"""Toxicity by a weighted lexicon over folded texts.

Terms (words and word beginnings) get the log ratio of their rates in toxic and
clean training documents; phrases that hold a term but belong to clean
documents are exceptions.  A text's score comes from the weight of its matches
against its length, through a small logistic curve.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.llm.common import unpacked, with_text, written
from martline.llm.lexicon import Lexicon, TermCounter, folded_words

#: A term needs so many toxic training documents, whatever their number.
MIN_DOCS = 3
#: Least log ratio of rates, and its least z-value. All terms that reach them make the lexicon.
MIN_WEIGHT, MIN_Z = 1.0, 4.0
#: A phrase needs so many clean documents to be an exception.
MIN_EXCEPTION_DOCS = 5
#: Terms a worker counts before it passes them on.
FLUSH_TERMS = 1 << 20


def train_toxicity(texts: DataFrame, exceptions: tuple[str, ...] = ()) -> dict:
    """Model from ``texts`` with columns ``id, text, label`` (1 toxic, 0 clean; other labels are passed over).

    ``texts`` is a bounded table (``common.training_rows``): three numbers of each row reach the driver.

    Without a label of either kind the lexicon is empty and every score is the
    share of toxic rows, with one row of each added.
    """
    texts = texts.filter("label IN (0, 1)")
    sizes = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    prior = (toxic + 1) / (toxic + clean + 2)
    if not toxic or not clean:
        return {"weights": {}, "exceptions": list(exceptions), "outside": [], "curve": [math.log(prior / (1 - prior))] + [0.0] * N_FEATURES}
    weights = _weights(written(_counts(texts), "toxicity-terms"), toxic, clean)
    outside = _at_start_only(written(_inside(texts, weights), "toxicity-inside"), toxic, clean)
    matched = written(_matched(texts, weights, exceptions, outside), "toxicity-matches")
    spared = _exceptions(matched, toxic, clean)
    spare = frozenset(spared)

    @F.pandas_udf("double")
    def live(hits: pd.Series) -> pd.Series:
        return pd.Series([sum(h["weight"] for h in row if h["before"] not in spare and h["after"] not in spare) for row in hits], dtype=float)

    sample = matched.select("label", "words", live("hits").alias("weight")).toPandas()
    curve = fit_logistic(features(sample["weight"].to_numpy(float), sample["words"].to_numpy(float)),
                         sample["label"].to_numpy(float))
    return {"weights": weights, "exceptions": [*exceptions, *spared], "outside": outside, "curve": curve.tolist()}


def score_toxicity(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """Input columns plus ``score`` (0 to 1), ``matches`` and ``weight``.

    Null texts score as empty ones.  Repeated rows score alike; an empty table
    gives an empty result.  Input columns with a result's name are replaced.
    """
    weights, exceptions, outside, curve = model["weights"], model["exceptions"], model["outside"], np.array(model["curve"])

    @F.pandas_udf("score double, matches long, weight double")
    def score(texts: pd.Series) -> pd.DataFrame:
        lexicon = _lexicon(weights, exceptions, outside)
        rows = []
        for text in texts:
            words = folded_words(text)
            hits = lexicon.hits(words)[1]
            rows.append((len(words), len(hits), sum(hits.values())))
        n, matches, weight = np.array(rows, dtype=float).reshape(-1, 3).T
        z = curve[0] + features(weight, n) @ curve[1:]
        return pd.DataFrame({"score": 1 / (1 + np.exp(-z.clip(-50, 50))), "matches": matches.astype(np.int64), "weight": weight})

    scored = with_text(docs, text_col, keep=True).withColumn("_scored", score("_text"))
    return unpacked(scored, {n: F.col("_scored").getField(n) for n in ("score", "matches", "weight")})


N_FEATURES = 4


def features(weight: np.ndarray, words: np.ndarray) -> np.ndarray:
    """What the curve sees: total weight, weight by length, and length alone."""
    return np.stack([np.minimum(weight, 40) / 10, np.log1p(weight), np.minimum(100 * weight / np.maximum(words, 10), 40) / 10,
                     np.log1p(words)], axis=1)


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Intercept and coefficients of a ridge-penalised logistic regression, by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    beta, keep = np.zeros(x.shape[1]), np.diag([0.0] + [penalty] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ beta).clip(-30, 30)))
        slope = x.T @ (y - p) - keep @ beta
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep + 1e-9 * np.eye(len(beta)), slope)
        beta = beta + step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return beta


_OPEN: dict[int, Lexicon] = {}


def _lexicon(weights: dict[str, float], exceptions: list[str], outside: list[str]) -> Lexicon:
    """One per Python worker and model."""
    key = hash((frozenset(weights.items()), tuple(exceptions), tuple(outside)))
    if key not in _OPEN:
        _OPEN.clear()
        _OPEN[key] = Lexicon(weights, exceptions, outside)
    return _OPEN[key]


def _inside(texts: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``label, terms``: the terms that stand inside a word of each row."""
    @F.pandas_udf("array<string>")
    def inside(batch: pd.Series) -> pd.Series:
        lexicon = _lexicon(weights, [], [])
        return pd.Series([sorted(lexicon.inside(f" {' '.join(folded_words(text))} ")) for text in batch], dtype=object)

    return texts.select("label", inside(F.coalesce("text", F.lit(""))).alias("terms"))


def _at_start_only(inside: DataFrame, toxic: int, clean: int) -> list[str]:
    """Terms that stand inside words of clean documents as well: they count only at a word's beginning."""
    counts = inside.select("label", F.explode("terms").alias("term")).groupBy("term").agg(
        F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good"))
    rows = counts.filter((F.col("good") > 0) & (F.col("bad") / toxic < math.exp(MIN_WEIGHT) * F.col("good") / clean)).select("term").collect()
    return sorted(r["term"] for r in rows)


def _counts(texts: DataFrame) -> DataFrame:
    """``term`` with documents and occurrences by label; each worker adds up before anything is shuffled.

    The empty term stands for all words.
    """
    schema = pa.schema([("term", pa.string()), ("label", pa.int32()), ("docs", pa.int64()), ("times", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = [TermCounter(), TermCounter()]
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1)):
                counter = counters[label.as_py()]
                words = folded_words(text.as_py())
                counter.add(words)
                counter.grams[""] += len(words)
                counter.docs[""] += 1
                if len(counter.docs) > FLUSH_TERMS:
                    yield table(label.as_py(), counter.take())
        for label, counter in enumerate(counters):
            yield table(label, counter.take())

    def table(label: int, rows: list[tuple[str, int, int]]) -> pa.RecordBatch:
        terms, docs, times = zip(*rows) if rows else ([], [], [])
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip((terms, [label] * len(rows), docs, times), schema.types)],
                                          schema=schema)

    def total(value: str, label: int) -> Column:
        return F.sum(F.when(F.col("label") == label, F.col(value)).otherwise(0))

    return (texts.select("text", F.col("label").cast("int")).mapInArrow(count, "term string, label int, docs long, times long")
            .groupBy("term").agg(total("docs", 1).alias("bad_docs"), total("times", 1).alias("bad_times"),
                                 total("docs", 0).alias("good_docs"), total("times", 0).alias("good_times"))
            .filter(F.col("bad_docs") >= MIN_DOCS))


def _weights(counts: DataFrame, toxic: int, clean: int) -> dict[str, float]:
    """Log ratios of rates of the terms that tell toxic from clean; only these are collected."""
    words = counts.filter("term = ''").first()
    if words is None:
        return {}

    def half(name: str) -> Column:
        return F.col(name) + 0.5

    weight = F.log(half("bad_times") / max(1, words["bad_times"])) - F.log(half("good_times") / max(1, words["good_times"]))
    odds = F.log(half("bad_docs") / (toxic + 1)) - F.log(half("good_docs") / (clean + 1))
    z = odds / F.sqrt(1 / half("bad_docs") + 1 / half("good_docs"))
    rows = counts.filter("term <> ''").select("term", weight.alias("weight"), z.alias("z"))
    rows = rows.filter((F.col("weight") >= MIN_WEIGHT) & (F.col("z") >= MIN_Z)).select("term", "weight").collect()
    return {r["term"]: r["weight"] for r in sorted(rows, key=lambda r: (-r["weight"], r["term"]))}


def _matched(texts: DataFrame, weights: dict[str, float], exceptions: tuple[str, ...], outside: list[str]) -> DataFrame:
    """Each row's number of words and matches, with the phrases they stand in."""
    @F.pandas_udf("words long, hits array<struct<weight:double,before:string,after:string>>")
    def match(batch: pd.Series) -> pd.DataFrame:
        lexicon, rows = _lexicon(weights, list(exceptions), outside), []
        for text in batch:
            words = folded_words(text)
            line, hits = lexicon.hits(words)
            found = []
            for start, weight in hits.items():
                end = line.index(" ", start + 1)
                first = line.rfind(" ", 0, start + 1)  # the blank before the word that holds the match
                # Inside a word, the word itself may be the exception.
                before = line[line.rfind(" ", 0, start) + 1:end] if start else ""
                after = line[first + 1:_next(line, end)] if end + 1 < len(line) else ""
                found.append({"weight": weight, "before": before, "after": after})
            rows.append((len(words), found))
        return pd.DataFrame(rows, columns=["words", "hits"])

    return texts.withColumn("_m", match(F.coalesce("text", F.lit("")))).select("id", "label", "_m.*")


def _next(line: str, end: int) -> int:
    return line.index(" ", end + 1)


def _exceptions(matched: DataFrame, toxic: int, clean: int) -> list[str]:
    """Two-word phrases around a match, and words around one inside them, that clean documents use more than toxic ones.

    All that pass; the bounded training table bounds their number.
    """
    phrase: Column = F.explode(F.array_distinct(F.flatten(F.transform("hits", lambda h: F.array(h["before"], h["after"])))))
    counts = (matched.select("label", phrase.alias("phrase")).filter("phrase <> ''")
              .groupBy("phrase").agg(F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good")))
    rows = (counts.filter((F.col("good") >= MIN_EXCEPTION_DOCS) & (F.col("good") / clean > 2 * F.col("bad") / toxic))
            .select("phrase").collect())
    return sorted(r["phrase"] for r in rows)
