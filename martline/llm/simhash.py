"""SimHash near-duplicates through an inverted index of byte positions.

A fingerprint has eight bytes.  Two of them that differ in at most three bits
differ in at most three bytes, so they share at least five positional bytes:
that is the guaranteed minimum of the count filter.  A list of one positional
byte would hold a 256th of all fingerprints and pairs would grow with the square of the
input; a list here is keyed by four positional bytes at once.  The fourteen
sets of four positions come from the Steiner system S(3, 4, 8): whichever
three bytes differ, one set avoids them, so no pair is lost.  Inside a list
the shared positional bytes of a pair are tallied, pairs below the minimum go,
and the rest are verified by their bit distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.llm.common import unpacked, with_text, written
from martline.llm.components import connected_components
from martline.llm.textstats import simhash
from martline.session import checked_broadcast

#: Sets of four byte positions whose numbers cancel under xor: every three positions lie in exactly one.
POSITION_SETS = [c for c in combinations(range(8), 4) if c[0] ^ c[1] ^ c[2] ^ c[3] == 0]
#: Largest bit distance for which the sets lose no pair.
MAX_DISTANCE = 3
#: Longest list that one step compares; longer ones are compared block by block.
BLOCK = 4096
#: Lists up to this length give their pairs, longer ones a spanning forest of them.
SMALL_LIST = 16


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                       max_distance: int = MAX_DISTANCE, seed: int = 42) -> DataFrame:
    """Input columns but the text, then ``fingerprint`` (16 hex digits) and ``component_id``.

    Fingerprints at ``max_distance`` or fewer differing bits are linked;
    ``component_id`` is the smallest id reachable.  Null and empty texts have
    fingerprint zero and are linked like any other.  Null ids are passed over
    by the minimum (null if a component has no other).  Repeated rows are all
    returned; an empty table gives an empty result.  Input columns with a
    result's name are replaced.
    """
    rows, member = _grouped(docs, id_col, text_col, shingle, max_distance, seed, keep_text=False)
    return unpacked(rows.join(member, "_fp"), {
        "fingerprint": F.lower(F.lpad(F.hex("_fp"), 16, "0")), "component_id": F.col("_component_id")})


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                     max_distance: int = MAX_DISTANCE) -> DataFrame:
    """One row of each component, that with the smallest id; input columns only.

    Of rows that share that id (or have none) one stays.
    """
    rows, member = _grouped(docs, id_col, text_col, shingle, max_distance, 42, keep_text=True)
    small = rows.select("_at", "_fp", F.col("_row").getField(id_col).alias("_id")).join(member, "_fp")
    first = (small.filter(F.col("_id").eqNullSafe(F.col("_component_id")))
             .groupBy("_root").agg(F.min("_at").alias("_at")).select("_at"))
    # The rows that go are written first: a number each, broadcast within a bound of bytes, else joined by shuffle.
    gone = written(small.select("_at").join(first, "_at", "left_anti"), "near-copies")
    return unpacked(rows.join(checked_broadcast(gone), "_at", "left_anti"))


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_distance: int, seed: int,
             keep_text: bool) -> tuple[DataFrame, DataFrame]:
    """The rows with their fingerprint and number, and ``_fp, _root, _component_id`` of each fingerprint."""
    if not 0 <= max_distance <= MAX_DISTANCE:
        raise ValueError(f"max_distance must be 0 to {MAX_DISTANCE}")

    @F.pandas_udf("long")
    def fingerprint(texts: pd.Series) -> pd.Series:
        prints = np.fromiter((simhash(t, shingle, seed) for t in texts), dtype=np.uint64, count=len(texts))
        return pd.Series(prints.view(np.int64))

    rows = written(with_text(docs, text_col, keep_text).select("_row", fingerprint("_text").alias("_fp"),
                                                               F.monotonically_increasing_id().alias("_at")), "fingerprints")
    nodes = written(rows.groupBy("_fp").agg(F.min(F.col("_row").getField(id_col)).alias("_least")), "fingerprint-nodes")
    roots = connected_components(fingerprint_links(nodes, "_fp", max_distance))
    member = nodes.join(roots, F.col("_fp") == F.col("node"), "left").select(
        "_fp", "_least", F.coalesce("root", "_fp").alias("_root"))
    least = member.groupBy("_root").agg(F.min("_least").alias("_component_id"))
    return rows, member.drop("_least").join(least, "_root")


def fingerprint_links(nodes: DataFrame, fp_col: str, max_distance: int = MAX_DISTANCE, block: int = BLOCK) -> DataFrame:
    """``(a, b)`` links that join every two distinct fingerprints within reach, directly or over others."""
    fp = F.col(fp_col)
    byte = [F.shiftrightunsigned(fp, 8 * (7 - p)).bitwiseAND(F.lit(255)) for p in range(8)]
    keys = []
    for n, places in enumerate(POSITION_SETS):
        key = F.lit(n).cast("long")
        for p in places:
            key = key * 256 + byte[p]
        keys.append(key)
    postings = nodes.select(fp.alias("_fp"), F.explode(F.array(*keys)).alias("_key"))
    sizes = postings.groupBy("_key").agg(F.count("*").alias("_n")).filter("_n > 1")
    blocks = F.ceil(F.col("_n") / block).cast("int")
    own = F.pmod(F.xxhash64("_fp"), F.col("_blocks")).cast("int")
    cells = (postings.join(sizes, "_key")
             .withColumn("_blocks", blocks).withColumn("_own", own)
             .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
             .select("_key", F.least("_own", "_other").alias("_lo"), F.greatest("_own", "_other").alias("_hi"), "_fp"))
    return (cells.repartition("_key", "_lo", "_hi").sortWithinPartitions("_key", "_lo", "_hi", "_fp")
            .mapInArrow(_linker(max_distance), "a long, b long").distinct())


def _linker(max_distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not len(cols[0]):
                continue
            if rest is not None:
                cols = [np.concatenate(x) for x in zip(rest, cols)]
            new = np.ones(len(cols[0]), dtype=bool)
            new[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]) | (cols[2][1:] != cols[2][:-1])
            last = int(np.flatnonzero(new)[-1])  # the last list may go on in the next batch
            yield from _linked(cols[3][:last].view(np.uint64), new[:last], max_distance)
            rest = [c[last:] for c in cols]
        if rest is not None:
            new = np.zeros(len(rest[0]), dtype=bool)
            new[:1] = True
            yield from _linked(np.ascontiguousarray(rest[3]).view(np.uint64), new, max_distance)

    return run


def _near(x: np.ndarray, max_distance: int) -> np.ndarray:
    """Where xors of fingerprints pass the count filter and then the bit distance."""
    shared = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    ok = shared >= 8 - max_distance
    ok[ok] = np.bitwise_count(x[ok]) <= max_distance
    return ok


def _linked(fps: np.ndarray, new: np.ndarray, max_distance: int) -> Iterator[pa.RecordBatch]:
    if not len(fps):
        return
    starts = np.flatnonzero(new)
    lengths = np.diff(np.append(starts, len(fps)))
    end = np.repeat(starts + lengths, lengths)
    small = np.repeat(lengths <= SMALL_LIST, lengths)
    for step in range(1, min(SMALL_LIST, int(lengths.max()))):
        at = np.flatnonzero(small[:-step] & (np.arange(step, len(fps)) < end[:-step]))
        at = at[_near(fps[at] ^ fps[at + step], max_distance)]
        yield _pairs(fps[at], fps[at + step])
    for s, n in zip(starts[lengths > SMALL_LIST].tolist(), lengths[lengths > SMALL_LIST].tolist()):
        yield _forest(fps[s:s + n], max_distance)


def _forest(fps: np.ndarray, max_distance: int) -> pa.RecordBatch:
    """A spanning forest of the links in one list: fewer links than members."""
    left, a, b = fps.copy(), [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            hit = _near(left ^ at, max_distance)
            found, left = left[hit], left[~hit]
            a.append(np.full(len(found), at, dtype=np.uint64))
            b.append(found)
            queue.extend(found)
    return _pairs(np.concatenate(a), np.concatenate(b)) if a else _pairs(fps[:0], fps[:0])


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], names=["a", "b"])
