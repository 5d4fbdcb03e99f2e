"""Quality classifier: random Fourier features of document statistics.

Cosines of random projections approximate a Gaussian kernel over standardised
statistics.  Each partition adds up its part of the normal equations, fold by
fold; the sums give a ridge regression on all folds and one without each fold,
whose scores of the fold left out train an isotonic calibration.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.llm.common import unpacked, with_text, written
from martline.session import default_parallelism

#: Random features, width of the kernel in standardised units a root dimension, and ridge penalty.
FEATURES, WIDTH, RIDGE = 256, 1.0, 0.1
#: Folds for calibration; width of a score's bin there.
FOLDS, BIN = 4, 0.002
#: Partial sums (each of FOLDS matrices) that are shuffled, on a small cluster.
PARTIAL_SUMS = 64
#: Statistics beyond so many standard deviations count as that many.
CLIP = 5.0

_UPPER, _LOWER, _DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789"
_SYMBOLS, _STOPS, _HIGH = b"#*$%&|<>{}[]=_~^\\/@+", b".,;:!?", bytes(range(128, 256))

STATISTICS = ("log_words", "log_bytes", "mean_word", "sd_word", "long_words", "distinct", "top_word", "upper", "lower",
              "digits", "symbols", "stops", "shouts", "high_bytes", "bars", "words_a_line", "repeated_lines", "packs_to", "entropy",
              "sentences")


def statistics(text: str | None) -> list[float]:
    """The statistics of a whole text; all zero for an empty one."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n, size = len(words), len(raw)
    if not n:
        return [0.0] * len(STATISTICS)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    counts = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    share = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256) / size
    seen = share[share > 0]
    of = lambda chars: float(share[list(chars)].sum())
    return [
        np.log1p(n), np.log1p(size), float(lengths.mean()), float(lengths.std()), float((lengths > 12).mean()),
        np.log1p(len(counts)) / np.log1p(n), counts.most_common(1)[0][1] / n, of(_UPPER), of(_LOWER), of(_DIGITS),
        of(_SYMBOLS), of(_STOPS), of(b"!"), of(_HIGH), of(b"|"), np.log1p(n / len(lines)),
        1 - len(set(lines)) / len(lines), len(zlib.compress(raw, 1)) / size, float(-(seen * np.log2(seen)).sum()),
        raw.count(b".") / n]


def document_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The input row (without the text) as ``_row``, and ``_stats``; written once."""
    @F.pandas_udf("array<double>")
    def stats(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts], dtype=object)

    return written(with_text(docs, text_col, keep=False).select("_row", stats("_text").alias("_stats")), "statistics")


def train_quality(rows: DataFrame, seed: int = 1) -> dict:
    """Model from ``rows`` with columns ``id, stats, label`` (0 or 1; other labels are passed over).

    Without rows of both labels every score is the share of label 1, with one
    row of each added.
    """
    rows = rows.filter("label IN (0, 1)")
    d = len(STATISTICS)
    first = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("ones"), *[
        f(F.col("stats")[i]).alias(f"{name}{i}") for i in range(d) for name, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    prior = (first["ones"] + 1) / (first["n"] + 2)
    if first["ones"] in (0, first["n"]):
        return {"prior": prior}
    random = np.random.default_rng(seed)
    model = {
        "mean": np.array([first[f"m{i}"] for i in range(d)]),
        "scale": np.maximum(np.array([first[f"s{i}"] for i in range(d)]), 1e-9),
        "directions": random.standard_normal((d, FEATURES)) / (WIDTH * np.sqrt(d)),
        "phases": random.uniform(0, 2 * np.pi, FEATURES)}
    fold = F.pmod(F.xxhash64("id"), F.lit(FOLDS)).cast("int")
    rows = rows.select("stats", F.col("label").cast("double").alias("label"), fold.alias("fold"))
    gram, right = _normal_equations(rows, model)
    ridge = RIDGE * np.eye(FEATURES + 1)
    ridge[0, 0] = 1e-6
    solve = lambda keep: np.linalg.solve(gram[keep].sum(axis=0) + ridge, right[keep].sum(axis=0))
    model["beta"] = solve(np.ones(FOLDS, dtype=bool))
    without = np.stack([solve(np.arange(FOLDS) != f) for f in range(FOLDS)])
    model["knots"], model["levels"] = _calibration(rows, model, without)
    return model


def random_features(stats: np.ndarray, model: dict) -> np.ndarray:
    """A constant and the cosines for each row of statistics."""
    z = ((stats - model["mean"]) / model["scale"]).clip(-CLIP, CLIP)
    waves = np.sqrt(2 / FEATURES) * np.cos(z @ model["directions"] + model["phases"])
    return np.concatenate([np.ones((len(stats), 1)), waves], axis=1)


def score_quality(rows: DataFrame, model: dict) -> DataFrame:
    """The input columns of ``document_statistics`` plus ``score`` (0 to 1).

    Empty and null texts score by their statistics, all zero.  Repeated rows score alike; an
    empty table gives an empty result.  An input column named ``score`` is replaced.
    """
    if "beta" not in model:
        return unpacked(rows, {"score": F.lit(float(model["prior"]))})

    @F.pandas_udf("double")
    def score(stats: pd.Series) -> pd.Series:
        raw = random_features(np.stack(stats.to_numpy()), model) @ model["beta"] if len(stats) else np.zeros(0)
        return pd.Series(np.interp(raw, model["knots"], model["levels"]))

    return unpacked(rows.withColumn("_score", score("_stats")), {"score": F.col("_score")})


def _normal_equations(rows: DataFrame, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Gram matrix and right-hand side of each fold: FOLDS x (FEATURES + 1) rows reach the driver."""
    width = FEATURES + 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((FOLDS, width, width + 1))
        for batch in batches:
            if batch.num_rows:
                x = random_features(np.stack(batch.column(0).to_numpy(zero_copy_only=False)), model)
                y, fold = batch.column(1).to_numpy(), batch.column(2).to_numpy()
                for f in range(FOLDS):
                    own = x[fold == f]
                    sums[f] += own.T @ np.column_stack([own, y[fold == f]])
        yield _sums_batch((f * width + i, sums[f, i]) for f in range(FOLDS) for i in range(width))

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[key] = sums.get(key, 0) + np.frombuffer(value)
        yield _sums_batch(sums.items())

    schema = "at int, sums binary"
    # As many sums as tasks can run twice over: their number grows with the cluster, not with the rows.
    parts = rows.coalesce(max(PARTIAL_SUMS, 2 * default_parallelism(rows.sparkSession))).mapInArrow(partial, schema)
    found = parts.repartition("at").mapInArrow(total, schema).collect()
    sums = np.zeros((FOLDS * width, width + 1))
    for r in found:
        sums[r["at"]] = np.frombuffer(r["sums"])
    sums = sums.reshape(FOLDS, width, width + 1)
    return sums[:, :, :-1], sums[:, :, -1]


def _sums_batch(rows) -> pa.RecordBatch:
    rows = list(rows)
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()),
                                       pa.array([v.tobytes() for _, v in rows], pa.binary())], names=["at", "sums"])


def _calibration(rows: DataFrame, model: dict, without: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic curve through the labels of rows scored by the regression that has not seen their fold.

    Scores are counted in bins (3 / BIN of them at most), so a bounded table reaches the driver.
    """
    @F.pandas_udf("int")
    def bins(stats: pd.Series, fold: pd.Series) -> pd.Series:
        x = random_features(np.stack(stats.to_numpy()), model) if len(stats) else np.zeros((0, FEATURES + 1))
        raw = (x * without[fold.to_numpy()]).sum(axis=1)
        return pd.Series(np.round(raw.clip(-1, 2) / BIN).astype(np.int32))

    counts = (rows.select("label", bins("stats", "fold").alias("bin")).groupBy("bin")
              .agg(F.sum("label").alias("ones"), F.count("*").alias("n")).orderBy("bin").collect())
    return isotonic(np.array([r["bin"] * BIN for r in counts]), np.array([r["ones"] for r in counts], dtype=float),
                    np.array([r["n"] for r in counts], dtype=float))


def isotonic(at: np.ndarray, ones: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising step means by pooling adjacent violators, as knots and levels to interpolate between.

    Each pooled block is drawn towards one half by one row of each label, so
    no level is exactly 0 or 1.
    """
    blocks: list[list[float]] = []
    for x, o, k in zip(at, ones, n):
        blocks.append([x * k, o, k])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    knots = np.array([b[0] / b[2] for b in blocks])
    levels = np.maximum.accumulate(np.array([(b[1] + 0.5) / (b[2] + 1) for b in blocks]))
    return knots, levels
